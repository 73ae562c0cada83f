"""Event evaluation, truth matching, sex inference, cohort choice and run history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binlattice.functions.ordering import with_next
from binlattice.functions.stats import clean
from binlattice.operators.grid import overlap_join, runs


def call_runs(scored: DataFrame, threshold: float = 1.0, min_bins: int = 2) -> DataFrame:
    """Events: runs of bins whose z is beyond ``threshold`` on one side, with their z statistics."""
    state = F.when(F.col("robust_z") >= threshold, "gain").when(F.col("robust_z") <= -threshold, "loss")
    rows = runs(scored, state.isNotNull(), state)
    z = F.col("robust_z")
    return (
        rows.groupBy("sample_id", "chrom", "label", "run")
        .agg(F.min("bin_index").alias("start_bin"), F.max("bin_index").alias("end_bin"), F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.count("*").alias("n_bins"), F.avg(z).alias("mean_z"), F.median(z).alias("median_z"), F.max(F.abs(z)).alias("max_abs_z"))
        .where(F.col("n_bins") >= min_bins)
        .select(F.concat_ws("_", "sample_id", "chrom", F.col("start_bin").cast("string")).alias("event_id"), "sample_id", "chrom", F.col("label").alias("state"), "start_bin", "end_bin", "start_pos", "end_pos", "n_bins", "mean_z", "median_z", "max_abs_z")
    )


def normalize_state(state: Column) -> Column:
    """gain or loss for their synonyms; anything else in lower case."""
    s = F.lower(F.trim(state))
    return F.when(s.isin("dup", "duplication", "amplification", "gain", "+"), "gain").when(s.isin("del", "deletion", "loss", "-"), "loss").otherwise(s)


def normalize_chrom(chrom: Column) -> Column:
    return F.when(F.startswith(chrom, F.lit("chr")), chrom).otherwise(F.concat(F.lit("chr"), chrom))


def event_support_z(*columns: str) -> Column:
    """Largest |z| of the columns, nulls skipped."""
    return F.greatest(*[F.abs(clean(c)) for c in columns]) if len(columns) > 1 else F.abs(clean(columns[0]))


SUPPORT = ["calibrated_mean_z", "calibrated_median_z", "event_corr_adjusted_z"]


def kept_events(events: DataFrame) -> DataFrame:
    """Kept events with chromosome and state as truth tables are read, and support_z."""
    kept = events.where(F.coalesce(F.col("keep_event"), F.lit(0)) == 1)
    return kept.withColumns({"chrom": normalize_chrom(F.col("chrom")), "state": normalize_state(F.col("state")), "support_z": event_support_z(*SUPPORT)})


def event_metrics(events: DataFrame) -> DataFrame:
    """Events by chromosome, state and status: all, kept, median priority and median |calibrated z|."""
    return events.groupBy("chrom", "state", "artifact_status").agg(F.count("*").alias("event_count"), F.sum("keep_event").alias("kept_event_count"), F.median("priority_score").alias("median_priority_score"), F.median(F.abs("calibrated_mean_z")).alias("median_abs_calibrated_z"))


#: The labels of the q bins, which are closed at the right.
Q_BINS = ["<=0.01", "0.01-0.05", "0.05-0.10", "0.10-0.25", ">0.25"]


def qvalue_calibration(events: DataFrame) -> DataFrame:
    """Events, kept events and median priority per q bin, empty bins present; a null q counts as 1."""
    q = F.coalesce("empirical_qvalue", F.lit(1.0))
    label = F.when(q <= 0.01, Q_BINS[0]).when(q <= 0.05, Q_BINS[1]).when(q <= 0.10, Q_BINS[2]).when(q <= 0.25, Q_BINS[3]).otherwise(Q_BINS[4])
    bins = events.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in Q_BINS])).alias("qvalue_bin"))
    per = events.groupBy(label.alias("qvalue_bin")).agg(F.count("*").alias("n"), F.sum("keep_event").alias("kept"), F.median("priority_score").alias("median_priority_score"))
    return bins.join(per, "qvalue_bin", "left").select("qvalue_bin", F.coalesce("n", F.lit(0)).alias("event_count"), F.coalesce("kept", F.lit(0)).alias("kept_event_count"), "median_priority_score")


TRUTH_KEYS = ["sample_id", "chrom", "state"]


def truth_hits(truth: DataFrame, found: DataFrame, rank: Column, bucket: int = 100_000) -> DataFrame:
    """Truth rows with n, their matches in ``found``, and ``best``, the least ``rank`` of these: same sample, chromosome and state and,
    where the truth has both bounds, an overlap of at least one base counting both ends.

    Rows of ``found`` at one place are summed up first, and truth rows at one place are matched once, so that only different places that overlap make
    pairs; truth rows without bounds take the sums of their key, the only ones that rows of ``found`` without bounds match. n is 0 where nothing matches.
    """
    per = found.groupBy(*TRUTH_KEYS, F.col("start_pos").alias("r_start"), (F.col("end_pos") + 1).alias("r_end")).agg(F.count("*").alias("n"), F.min(rank).alias("best"))
    both = [F.sum("n").alias("n"), F.min("best").alias("best")]
    bounded = F.col("t_start").isNotNull() & F.col("t_end").isNotNull()
    places = truth.where(bounded).select(*TRUTH_KEYS, F.col("t_start").alias("start_pos"), (F.col("t_end") + 1).alias("end_pos")).distinct()
    met = overlap_join(places, per, bucket, tuple(TRUTH_KEYS)).groupBy(*TRUTH_KEYS, F.col("start_pos").alias("t_start"), (F.col("end_pos") - 1).alias("t_end")).agg(*both)
    held = truth.where(bounded).join(met, [*TRUTH_KEYS, "t_start", "t_end"], "left")
    free = truth.where(~bounded).join(per.groupBy(*TRUTH_KEYS).agg(*both), TRUTH_KEYS, "left")
    return held.unionByName(free).withColumn("n", F.coalesce("n", F.lit(0)))


def truth_metrics(events: DataFrame, truth: DataFrame, support: float = 2.5) -> DataFrame:
    """All rows of a truth table as load_truth() reads it, with their matches among the kept events: same sample, chromosome and state and,
    where the truth has both bounds, an overlap of at least one base counting both ends."""
    met = truth_hits(truth, kept_events(events).where(F.col("event_id").isNotNull()), -F.col("support_z"))
    top = -F.min("best")
    return met.groupBy("truth_id", *TRUTH_KEYS).agg((F.max("n") > 0).cast("int").alias("matched"), F.coalesce(top >= support, F.lit(False)).cast("int").alias("detected"), top.alias("top_support_z"))


def evaluation_summary(events: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row: samples and events by status and support, and how many truth rows are matched and detected."""
    n = lambda test, name: F.count_if(F.coalesce(test, F.lit(False))).alias(name)
    status = F.col("artifact_status")
    found = events.agg(
        F.count_distinct("sample_id").alias("sample_count"), F.count("*").alias("event_count"), n(F.col("keep_event") == 1, "kept_event_count"), n(status == "pass", "pass_event_count"), n(status == "review", "review_event_count"), n(status == "artifact", "artifact_event_count"),
        n(F.col("high_risk_bin_fraction") >= 0.5, "high_risk_event_count"), n(F.col("clean_bin_fraction") >= 0.5, "clean_supported_event_count"),
    )
    truth = metrics.agg(F.count("*").alias("truth_row_count"), F.coalesce(F.sum("matched"), F.lit(0)).alias("truth_match_count"), F.coalesce(F.sum("detected"), F.lit(0)).alias("truth_detected_count"), F.avg("matched").alias("truth_match_rate"), F.avg("detected").alias("truth_recall"))
    return found.crossJoin(truth)  # one row each


def relative_depths(counts: DataFrame) -> DataFrame:
    """X and Y depth of each sample relative to its median autosome, their ratio, and the sex these say."""
    per = counts.where("length > 0").withColumn("depth", F.col("mapped") / F.col("length"))
    auto = F.median(F.when(~F.col("chrom").isin("chrX", "chrY"), F.col("depth")))
    one = lambda c: F.max(F.when(F.col("chrom") == c, F.col("depth")))
    out = per.groupBy("sample_id").agg(auto.alias("autosome_depth"), one("chrX").alias("__x"), one("chrY").alias("__y"))
    relative = lambda d: F.when(F.col("autosome_depth") > 0, F.col(d) / F.col("autosome_depth"))
    out = out.withColumns({"x_depth": relative("__x"), "y_depth": relative("__y"), "y_to_x_ratio": F.when(F.col("__x") > 0, F.col("__y") / F.col("__x"))}).drop("__x", "__y")
    x, y = F.col("x_depth"), F.col("y_depth")
    return out.withColumn("sex_call", F.when(x.isNull() | y.isNull(), "unavailable").when(x >= 0.95, "XX").when((x <= 0.80) & (y >= 0.20), "XY").when(y <= 0.15, "XX").otherwise("ambiguous"))


def y_fraction(bins: DataFrame) -> DataFrame:
    return bins.groupBy("sample_id").agg((F.sum(F.when(F.col("chrom") == "chrY", F.col("raw_count")).otherwise(0)) / F.sum("raw_count")).alias("y_fraction"))


def largest_gap_cutoff(values: DataFrame, value: str) -> DataFrame:
    """The middle of the widest gap between ordered values, the first of equally wide ones; no row without a gap."""
    gaps = with_next(values.select(F.col(value).alias("x")), "x", "y").where("y > x")
    return gaps.agg(F.max_by(F.struct(((F.col("x") + F.col("y")) / 2).alias("cutoff"), (F.col("y") - F.col("x")).alias("gap")), F.struct(F.col("y") - F.col("x"), -F.col("x"))).alias("g")).where("g IS NOT NULL").select("g.cutoff", "g.gap")


def upsert_latest(existing: DataFrame, new: DataFrame, key: list[str], recency: list[str]) -> DataFrame:
    """One row a key: a new row replaces the existing one, and of several new (or several existing) ones the most recent stays."""
    w = Window.partitionBy(*key).orderBy(F.desc("__new"), *[F.col(c).desc() for c in recency])
    rows = existing.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    return rows.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "__new")


#: What runs are summed up by.
RUN_KEYS = ["module", "rule_name", "sample_bucket", "threads", "binsize", "pca_components"]


def runtime_summary(runs_: DataFrame) -> DataFrame:
    """Runs with a wall time that ended well, by RUN_KEYS (null is a value): minutes at p50, p80 and most, and after how many to look."""
    good = runs_.where(F.col("status").isin("success", "log_complete") & clean("wall_seconds").isNotNull())
    m = F.col("wall_seconds") / 60
    out = good.groupBy(*RUN_KEYS).agg(F.count("*").alias("n_runs"), F.percentile(m, 0.5).alias("p50_minutes"), F.percentile(m, 0.8).alias("p80_minutes"), F.max(m).alias("max_minutes"))
    return out.withColumn("recommended_check_after_minutes", F.ceil(F.greatest(1.2 * F.col("p50_minutes"), F.col("p80_minutes"))))


def low_fraction_detection(rows: DataFrame, thresholds: list[float], fraction: str, detected: str) -> DataFrame:
    """Detection among rows with a fraction up to each threshold; null where there are none."""
    pick = rows.select(F.col(fraction).alias("f"), F.col(detected).cast("double").alias("d"))
    upto = [F.struct(F.lit(x).alias("threshold"), F.count_if(F.col("f") <= x).alias("n"), F.avg(F.when(F.col("f") <= x, F.col("d"))).alias("rate")).alias(f"t{i}") for i, x in enumerate(thresholds)]
    return pick.agg(*upto).select(F.inline(F.array(*[f"t{i}" for i in range(len(thresholds))])))


#: The labels of fraction bins, which are closed at the right.
FRACTION_BINS = [(0.05, "<=5%"), (0.10, "5-10%"), (0.15, "10-15%"), (0.20, "15-20%"), (0.30, "20-30%")]


def fraction_bin(fraction: Column) -> Column:
    """The label of a fraction; unknown without one."""
    label = F.when(fraction.isNull() | F.isnan(fraction.cast("double")), "unknown")
    for top, name in FRACTION_BINS:
        label = label.when(fraction <= top, name)
    return label.otherwise(">30%")
