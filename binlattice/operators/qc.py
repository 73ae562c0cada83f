"""Sample quality: uniformity, leave-one-out cohort statistics, decisions, masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binlattice.functions.stats import clean, correlations, gini, over

AUTOSOME = r"^chr([1-9]|1[0-9]|2[0-2])$"


def uniformity_metrics(bins: DataFrame) -> DataFrame:
    """Zero fraction, CV, MAD of differences of neighbouring bins in genome order, Gini index, counts."""
    w = Window.partitionBy("sample_id").orderBy("chrom_rank", "bin_index")
    step = bins.withColumn("d", (F.col("raw_count") - F.lag("raw_count").over(w)).cast("double"))
    step = step.withColumn("dm", F.median("d").over(over(["sample_id"])))
    mean = F.avg("raw_count")
    out = step.groupBy("sample_id").agg(
        F.avg((F.col("raw_count") == 0).cast("double")).alias("zero_fraction"),
        F.when(mean > 0, F.stddev_pop("raw_count") / mean).alias("cv"),
        F.median(F.abs(F.col("d") - F.col("dm"))).alias("adjacent_mad"),
        F.sum("raw_count").alias("mapped_fragments"),
        F.count("*").alias("n_bins"),
    )
    return out.join(gini(bins, "raw_count", ["sample_id"]), "sample_id")


def _mid(at, n: Column, skip: Column) -> Column:
    """Median of n values in order without the one at position ``skip`` (from 0); at(i) is the value at i."""
    m = n - 1
    pick = lambda i: at(F.when(i >= skip, i + 1).otherwise(i))
    return (pick(F.floor((m - 1) / 2).cast("int")) + pick(F.floor(m / 2).cast("int"))) / 2


def leave_one_out(signals: DataFrame, value: str) -> DataFrame:
    """For each sample and bin the median and 1.4826 * MAD of all other samples, the latter floored per sample.

    The floor is the 5th percentile of the sample's positive sigmas, 1e-3 without any. A bin's values, one a
    sample, are sorted once. Leaving one out, their median is one of at most three; for each of these the deviations are
    sorted once, with the place of the value they belong to, and a sample's MAD skips its own: n log n a bin of n samples.
    """
    place = F.struct(clean(value).alias("v"), "sample_id")
    per = signals.where(clean(value).isNotNull()).groupBy("chrom", "bin_index").agg(F.sort_array(F.collect_list(place)).alias("all")).where(F.size("all") > 1)
    n = F.size("all")

    def median_without(i: Column) -> Column:
        return _mid(lambda j: F.get(F.col("all"), j)["v"], n, i)

    # the middles without a low, a middle and a high value: all that can occur
    centers = F.array_distinct(F.transform(F.array(F.lit(0), F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int"), n - 1), median_without))
    per = per.withColumn("centers", centers)
    far = lambda c: F.sort_array(F.transform("all", lambda x, i: F.struct(F.abs(x["v"] - c).alias("d"), i.alias("i"))))
    per = per.withColumn("spreads", F.transform("centers", lambda c: F.struct(c.alias("c"), far(c).alias("far"))))
    # the place of each value's deviation among those of a center
    ranks = lambda s: F.transform(F.sort_array(F.transform(s["far"], lambda x, r: F.struct(x["i"].alias("i"), r.alias("r")))), lambda x: x["r"])
    per = per.withColumn("spreads", F.transform("spreads", lambda s: F.struct(s["c"].alias("c"), F.transform(s["far"], lambda x: x["d"]).alias("d"), ranks(s).alias("r"))))

    def others(x: Column, i: Column) -> Column:
        center = median_without(i)
        own = lambda s: F.struct(x["sample_id"].alias("sample_id"), x["v"].alias("v"), s["c"].alias("ref_median"), (1.4826 * _mid(lambda j: F.get(s["d"], j), n, F.get(s["r"], i))).alias("sigma"))
        return F.get(F.transform(F.filter("spreads", lambda s: s["c"] == center), own), F.lit(0))

    rows = per.select("chrom", "bin_index", F.inline(F.transform("all", others)))
    floor = F.coalesce(F.percentile(F.when(F.col("sigma") > 0, F.col("sigma")), 0.05).over(over(["sample_id"])), F.lit(1e-3))
    return rows.withColumn("ref_sigma", F.greatest("sigma", floor)).select("sample_id", "chrom", "bin_index", "v", "ref_median", "ref_sigma")


def reference_deviation(loo: DataFrame) -> DataFrame:
    """z of each bin against the others, summed up per sample, with correlations to the reference profile."""
    z = F.abs((F.col("v") - F.col("ref_median")) / F.col("ref_sigma"))
    out = loo.withColumn("z", z).groupBy("sample_id").agg(F.median("z").alias("median_abs_z"), F.avg((F.col("z") > 3).cast("double")).alias("over_3"), F.avg((F.col("z") > 5).cast("double")).alias("over_5"))
    return out.join(correlations(loo, "ref_median", "v", ["sample_id"]).select("sample_id", "pearson", "spearman"), "sample_id")


#: The checks of a sample in order, each with the value from which on it warns and fails.
DEFAULT_CHECKS = [
    ("mapped_fragments", "min", 2000000, 1000000),
    ("zero_bin_fraction", "max", 0.15, 0.3),
    ("bin_cv", "max", 1.5, 2.5),
    ("adjacent_diff_mad", "max", 0.35, 0.55),
    ("gini_coefficient", "max", 0.28, 0.35),
    ("pearson_r", "min", 0.92, 0.85),
    ("spearman_r", "min", 0.9, 0.83),
    ("median_abs_z", "max", 1.0, 1.5),
    ("outlier_frac_abs_z_gt_3", "max", 0.15, 0.3),
]


def qc_decision(metrics: DataFrame, checks: list[tuple[str, str, float, float]] = DEFAULT_CHECKS) -> DataFrame:
    """PASS, WARN or FAIL by checks of (column, 'min' or 'max', warn, fail) in order; null fails as ``name=nan``.

    Reasons name the check and the limit, such as ``pearson_r<0.85``: those that fail, else those that warn.
    """
    fails, warns = [], []
    for name, kind, warn, fail in checks:
        x, sign = F.col(name), "<" if kind == "min" else ">"
        beyond = (lambda x, t: x < t) if kind == "min" else (lambda x, t: x > t)
        fails.append(F.when(x.isNull(), F.lit(f"{name}=nan")).when(beyond(x, fail), F.lit(f"{name}{sign}{fail}")))
        warns.append(F.when(beyond(x, warn), F.lit(f"{name}{sign}{warn}")))
    out = metrics.withColumn("__f", F.array_compact(F.array(*fails))).withColumn("__w", F.array_compact(F.array(*warns)))
    decision = F.when(F.size("__f") > 0, "FAIL").when(F.size("__w") > 0, "WARN").otherwise("PASS")
    reason = F.when(F.size("__f") > 0, F.concat_ws(";", "__f")).when(F.size("__w") > 0, F.concat_ws(";", "__w")).otherwise("all_metrics_within_default_heuristic_thresholds")
    return out.withColumn("qc_decision", decision).withColumn("qc_reason", reason).drop("__f", "__w")


def autosome_fractions(bins: DataFrame) -> DataFrame:
    """Share of each autosome in a sample's autosomal counts, 0 for a total of 0."""
    per = bins.where(F.col("chrom").rlike(AUTOSOME)).groupBy("sample_id", "chrom").agg(F.sum("raw_count").alias("n"))
    total = F.sum("n").over(over(["sample_id"]))
    return per.select("sample_id", "chrom", F.when(total > 0, F.col("n") / total).otherwise(0.0).alias("fraction"))


def chromosome_bias(fractions: DataFrame, stable: DataFrame | None = None) -> DataFrame:
    """Deviation of a sample's chromosome shares in robust units of the cohort: the largest, and the three chromosomes with the largest.

    The cohort is the samples of ``stable``, or all where none of them is there. A spread of 0 counts as 1e-6.
    """
    marked = fractions.withColumn("__in", F.lit(False)) if stable is None else fractions.join(stable.select("sample_id").distinct().withColumn("__in", F.lit(True)), "sample_id", "left").withColumn("__in", F.coalesce("__in", F.lit(False)))
    none = marked.agg((~F.coalesce(F.bool_or("__in"), F.lit(False))).alias("__none"))  # one row
    cohort = marked.crossJoin(F.broadcast(none)).where(F.col("__in") | F.col("__none"))
    mid = cohort.withColumn("m", F.median("fraction").over(over(["chrom"]))).groupBy("chrom").agg(F.max("m").alias("m"), (1.4826 * F.median(F.abs(F.col("fraction") - F.col("m")))).alias("s"))
    z = F.abs(F.col("fraction") - F.col("m")) / F.when(F.col("s") > 0, F.col("s")).otherwise(1e-6)
    top = F.sort_array(F.collect_list(F.struct((-F.col("z")).alias("z"), "chrom")))  # 22 a sample
    per = fractions.join(mid, "chrom").withColumn("z", z).groupBy("sample_id").agg(F.max("z").alias("max_abs_z"), top.alias("top"))
    return per.select("sample_id", "max_abs_z", *[F.coalesce(F.get("top", F.lit(i))["chrom"], F.lit("")).alias(f"top_chrom_{i + 1}") for i in range(3)])


def input_qc(bins: DataFrame, least_total: float = 1e6, least_nonzero: float = 0.4, most_mad: float = 1.2) -> DataFrame:
    """Total, non-zero share and MAD of ln(1 + count) per sample, with PASS or the reasons against."""
    x = bins.withColumn("l", F.log1p("raw_count")).withColumn("m", F.median("l").over(over(["sample_id"])))
    out = x.groupBy("sample_id").agg(F.sum("raw_count").alias("total"), F.avg((F.col("raw_count") > 0).cast("double")).alias("nonzero_fraction"), F.median(F.abs(F.col("l") - F.col("m"))).alias("log_mad"))
    reasons = F.concat_ws(",", F.when(F.col("total") < least_total, "low_total"), F.when(F.col("nonzero_fraction") < least_nonzero, "low_nonzero"), F.when(F.col("log_mad") > most_mad, "high_mad"))
    return out.withColumn("status", F.when(reasons == "", "PASS").otherwise(reasons))


def sample_correlations(bins: DataFrame, value: str) -> DataFrame:
    """Pearson correlation of every two samples' profiles.

    The bins of a chromosome are gathered to an array for each bin; each pair of samples is added up once, from sums of products that tasks combine
    before anything moves, and reported in both orders; with itself a sample correlates to 1 (null without variance).
    """
    per = bins.where(clean(value).isNotNull()).groupBy("chrom", "bin_index").agg(F.sort_array(F.collect_list(F.struct("sample_id", clean(value).alias("v")))).alias("all"))
    pairs = F.flatten(F.transform("all", lambda x, i: F.transform(F.slice("all", i + 1, F.size("all")), lambda y: F.struct(x["sample_id"].alias("sample_a"), y["sample_id"].alias("sample_b"), x["v"].alias("a"), y["v"].alias("b")))))
    half = per.select(F.inline(pairs)).groupBy("sample_a", "sample_b").agg(F.corr("a", "b").alias("pearson"))
    ends = F.when(F.col("sample_a") == F.col("sample_b"), F.array(F.struct("sample_a", "sample_b"))).otherwise(F.array(F.struct("sample_a", "sample_b"), F.struct(F.col("sample_b").alias("sample_a"), F.col("sample_a").alias("sample_b"))))
    return half.select(F.inline(ends), "pearson")


def dynamic_bin_metrics(scored: DataFrame) -> DataFrame:
    """Per bin over samples: share of |z| > 3, median |z|, samples."""
    z = F.abs("z")
    return scored.groupBy("chrom", "bin_index").agg(F.avg((z > 3).cast("double")).alias("z_frac_over_3"), F.median(z).alias("median_abs_z"), F.count("*").alias("n_samples"))


def combined_mask(bins: DataFrame) -> DataFrame:
    """Hard, soft, dynamic or pass, in this precedence, with the reason; a missing GC is never soft."""
    hard = F.coalesce(F.col("n_fraction") >= 0.2, F.lit(False))
    gc = F.coalesce("gc_fraction", F.lit(0.5))
    soft = (gc < 0.2) | (gc > 0.8)
    dynamic = F.coalesce((F.col("z_frac_over_3") >= 0.05) | (F.col("median_abs_z") >= 1.5), F.lit(False))
    return bins.withColumn("mask_label", F.when(hard, "hard").when(soft, "soft").when(dynamic, "dynamic").otherwise("pass")).withColumn(
        "mask_reason",
        F.when(hard, F.format_string("n_fraction=%.4f", "n_fraction")).when(soft, F.format_string("gc_fraction=%.4f", "gc_fraction")).when(dynamic, F.format_string("z_frac=%.4f;median_abs_z=%.4f", "z_frac_over_3", "median_abs_z")).otherwise(""),
    )


def mask_summary(mask: DataFrame) -> DataFrame:
    return mask.groupBy("mask_label").count().withColumnRenamed("count", "n_bins")


def annotate_region_risk(bins: DataFrame) -> DataFrame:
    """risk_score, risk_class, region_risk_weight, variance_inflation and the three eligibility flags of a bin."""
    f = lambda c: F.coalesce(F.col(f"{c}_overlap_fraction"), F.lit(0.0))
    clip = lambda x, a, b: F.greatest(F.lit(a), F.least(F.lit(b), x))
    mapping = F.greatest(f("low_mappability"), clip((0.85 - F.coalesce("mappability_score", F.lit(1.0))) / 0.5, 0.0, 1.0))
    repeat = F.greatest(f("segmental_duplication"), 0.85 * f("repeat_rich"), f("blacklist"), f("gap_centromere_telomere"))
    homology = F.greatest(f("par"), f("xtr"), f("sex_homology"), f("ambiguous_alignment"))
    mask = F.col("mask_label")
    penalty = F.when(mask == "soft", 0.2).when(mask == "dynamic", 0.55).when(mask == "hard", 0.95).otherwise(0.0)
    raw = 0.35 * F.col("c_map") + 0.30 * F.col("c_rep") + 0.25 * F.col("c_hom") + 0.10 * penalty
    score = clip(F.greatest(raw, f("blacklist"), f("gap_centromere_telomere"), 0.95 * f("ambiguous_alignment")), 0.0, 1.0)
    out = bins.withColumns({"c_map": mapping, "c_rep": repeat, "c_hom": homology}).withColumn("risk_score", score)
    high = (F.col("risk_score") >= 0.75) | (f("blacklist") > 0) | (f("gap_centromere_telomere") > 0) | (f("ambiguous_alignment") >= 0.25) | mask.isin("hard", "dynamic")
    moderate = (F.col("risk_score") >= 0.35) | (F.col("c_hom") > 0) | (F.col("c_rep") > 0) | (F.col("c_map") > 0) | mask.isin("soft", "dynamic")
    unfit = (f("blacklist") > 0) | (f("gap_centromere_telomere") > 0) | (f("ambiguous_alignment") > 0) | (F.col("c_map") >= 0.75) | (f("segmental_duplication") >= 0.75) | (F.col("c_hom") >= 0.25) | mask.isin("hard", "dynamic")
    unseeded = high | (f("ambiguous_alignment") > 0) | (mask == "hard")
    out = out.withColumn("region_risk_class", F.when(high, "high").when(moderate, "moderate").otherwise("clean"))
    return out.withColumns(
        {
            "region_risk_weight": clip(F.exp(-2 * F.col("risk_score")), 0.1, 1.0),
            "variance_inflation": 1 + 2.5 * F.col("risk_score") + F.when(high, 0.5).otherwise(0.0),
            "correction_fit_eligible": (~unfit).cast("int"),
            "calling_seed_eligible": (~unseeded).cast("int"),
            "null_eligible": (F.col("chrom").rlike(AUTOSOME) & ~high & ~moderate & ~mask.isin("soft", "dynamic", "hard")).cast("int"),
        }
    ).drop("c_map", "c_rep", "c_hom")
