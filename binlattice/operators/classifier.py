"""A classifier of events: features, labels, cross-validated boosted trees, reliability and importance."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from binlattice.functions.storage import stored

#: The feature columns, in the order of the model.
FEATURES = [
    "n_bins", "segment_weight", "segment_mean_signal", "segment_median_signal", "segment_mean_robust_z", "segment_median_robust_z", "segment_abs_max_robust_z",
    "calibrated_mean_z", "calibrated_median_z", "empirical_pvalue", "empirical_qvalue", "priority_score", "chrom_fraction", "is_gain", "is_loss", "is_autosome",
    "is_sex_chromosome", "flag_count", "has_edge_flag", "has_weak_support_flag", "has_par_flag",
]


def event_features(events: DataFrame) -> DataFrame:
    """(event_id, sample_id, chrom, state, the features as doubles); a column that events lack is null."""
    flags = F.coalesce(F.col("artifact_flags"), F.lit("")) if "artifact_flags" in events.columns else F.lit("")
    end = F.col("end_bin").cast("double")
    sex = F.col("chrom").isin("chrX", "chrY")
    made = {
        "chrom_fraction": (end - F.col("start_bin") + 1) / F.greatest(end + 1, F.lit(1.0)),
        "is_gain": F.col("state") == "gain",
        "is_loss": F.col("state") == "loss",
        "is_autosome": ~sex,
        "is_sex_chromosome": sex,
        "flag_count": F.size(F.filter(F.split(flags, ","), lambda x: x != "")),
        "has_edge_flag": flags.contains("edge_event"),
        "has_weak_support_flag": flags.contains("weak_empirical_support"),
        "has_par_flag": flags.contains("par_overlap"),
    }
    value = lambda c: (made[c] if c in made else F.col(c) if c in events.columns else F.lit(None)).cast("double").alias(c)
    return events.select("event_id", "sample_id", "chrom", "state", *[value(c) for c in FEATURES])


def attach_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """features with label, joined on event_id where labels have it, else on sample, chromosome and state."""
    keys = ["event_id"] if "event_id" in labels.columns else ["sample_id", "chrom", "state"]
    return features.join(labels.select(*keys, "label"), keys, "left")


def stratified_folds(rows: DataFrame, k: int, seed: int = 1) -> DataFrame:
    """rows with fold: dealt out in the order of a seeded hash within each label and hash bucket, so that no label passes through one task."""
    mixed = rows.withColumn("__h", F.xxhash64(F.lit(seed), "event_id"))
    w = Window.partitionBy("label", F.pmod("__h", F.lit(64))).orderBy("__h", "event_id")
    return mixed.withColumn("fold", F.pmod(F.row_number().over(w) - 1 + F.pmod("__h", F.lit(64)), F.lit(k))).drop("__h")


def _fit(rows: DataFrame, **params: float) -> PipelineModel:
    filled = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = GBTClassifier(featuresCol="features", labelCol="label", seed=1, **params).fit(filled.transform(rows.fillna(0.0, FEATURES)))
    return PipelineModel(stages=[filled, model])


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows with y_score, the probability of label 1."""
    out = model.transform(rows.fillna(0.0, FEATURES))
    return out.withColumn("y_score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def _ranking(scored: DataFrame) -> DataFrame:
    """Area under the curve and average precision of each fold from counts per distinct score, ties taken together."""
    per = scored.groupBy("fold", "y_score").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q"))
    w = Window.partitionBy("fold").orderBy(F.desc("y_score"))
    run = per.withColumns({"tp": F.sum("p").over(w), "fp": F.sum("q").over(w)})
    total = run.groupBy("fold").agg(F.sum("p").alias("P"), F.sum("q").alias("Q"), F.sum(F.col("q") * (F.col("tp") - F.col("p") / 2)).alias("above"), F.sum(F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("ap"))
    return total.select("fold", F.try_divide("above", F.col("P") * F.col("Q")).alias("roc_auc"), F.try_divide("ap", "P").alias("average_precision"))


def fold_metrics(scored: DataFrame) -> DataFrame:
    """Seven metrics a fold from label and y_score, the cut being 0.5; a ratio over nothing is 0, an area without both labels null."""
    y, hit = F.col("label"), (F.col("y_score") >= 0.5).cast("int")
    sums = scored.groupBy("fold").agg(F.count("*").alias("n"), F.sum(y * hit).alias("tp"), F.sum((1 - y) * hit).alias("fp"), F.sum(y * (1 - hit)).alias("fn"), F.avg((y == hit).cast("double")).alias("accuracy"), F.avg((F.col("y_score") - y) ** 2).alias("brier"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    out = sums.select("fold", "n", "accuracy", ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"), "brier")
    return out.join(_ranking(scored), "fold")


def train_event_classifier(labelled: DataFrame, cv_folds: int = 5, seed: int = 1, **params: float) -> tuple[PipelineModel, DataFrame] | None:
    """(model of all labelled rows, predictions of each row by a model of the other folds); None with fewer than two labels.

    A row is held against its own label. Rows and predictions are written once, since every fold reads them.
    """
    rows = stored(stratified_folds(labelled.where("label IS NOT NULL").withColumn("label", F.col("label").cast("double")), max(2, cv_folds), seed))
    if rows.select("label").distinct().count() < 2:
        return None
    held = None
    for fold in range(max(2, cv_folds)):
        rest = rows.where(F.col("fold") != fold)
        part = predict(_fit(rest, **params), rows.where(F.col("fold") == fold))
        held = part if held is None else held.unionByName(part)
    return _fit(rows, **params), stored(held)


def reliability_curve(scored: DataFrame, n: int = 10) -> DataFrame:
    """Mean score and share of label 1 in each of n bins of equal width that holds rows."""
    place = F.least(F.floor(F.col("y_score") * n), F.lit(n - 1)).cast("int")
    return scored.groupBy(place.alias("bin")).agg(F.avg("y_score").alias("mean_predicted"), F.avg("label").alias("observed_positive_rate"), F.count("*").alias("n"))


def feature_importance(model: PipelineModel) -> DataFrame:
    """(feature, importance), the largest first."""
    trees: GBTClassificationModel = model.stages[-1]
    rows = [(f, float(v)) for f, v in zip(FEATURES, trees.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
