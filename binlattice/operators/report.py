"""Cohort tables: sample metrics, benchmark against truth, display, validation, table differences, QC roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binlattice.functions.stats import clean
from binlattice.operators.evaluate import TRUTH_KEYS, event_support_z, fraction_bin, normalize_chrom, normalize_state, truth_hits  # noqa: F401

SEX = ["chrX", "chrY"]
#: The names that a truth table's fraction may have, the first one present counting.
FRACTION_ALIASES = ["abnormal_cell_fraction", "expected_abnormal_cell_fraction", "expected_fraction", "truth_fraction", "mosaic_fraction", "abnormal_fraction"]


def sample_metrics(events: DataFrame, sexes: DataFrame | None = None, quality: DataFrame | None = None) -> DataFrame:
    """Per sample with events their counts by status and support, top priority and largest |calibrated z|, with the sample's sex and quality columns."""
    n = lambda test, name: F.count_if(F.coalesce(test, F.lit(False))).alias(name)
    out = events.groupBy("sample_id").agg(
        F.count("*").alias("total_events"), F.sum("keep_event").alias("kept_events"), n(F.col("artifact_status") == "pass", "pass_events"), n(F.col("artifact_status") == "review", "review_events"), F.max("priority_score").alias("top_priority_score"),
        F.max(F.abs(clean("calibrated_mean_z"))).alias("max_abs_calibrated_z"), n(F.col("high_risk_bin_fraction") >= 0.5, "high_risk_events"), n(F.col("clean_bin_fraction") >= 0.5, "clean_supported_events"),
    )
    for more in (sexes, quality):
        if more is not None:
            out = out.join(more, "sample_id", "left")
    return out


def load_truth(truth: DataFrame, aliases: list[str] = FRACTION_ALIASES) -> DataFrame:
    """The first fraction column that exists, as a double, and its name; what is no number is null. Chromosomes and states are read in any spelling."""
    found = next((c for c in aliases if c in truth.columns), None)
    value = clean(F.col(found).cast("string").try_cast("double")) if found else F.lit(None).cast("double")
    return truth.withColumns({"truth_fraction": value, "truth_fraction_source": F.lit(found or ""), "chrom": normalize_chrom(F.trim("chrom")), "state": normalize_state(F.col("state"))})


def load_external(segments: DataFrame) -> DataFrame:
    """Segments of another caller (sample_id, chrom, kind, start_pos, end_pos, zscore) with state and |z|."""
    return segments.select("sample_id", normalize_chrom(F.trim("chrom")).alias("chrom"), normalize_state(F.col("kind")).alias("state"), "start_pos", "end_pos", "zscore", F.abs("zscore").alias("abs_zscore"))


def match_truth(events: DataFrame, truth: DataFrame, external: DataFrame, support: float = 2.5, external_support: float = 5.0) -> DataFrame:
    """Truth rows with both callers' matches: their number, top support and whether that detects; of the own caller the top event's fraction and interval too.

    Matches have the same sample, chromosome and state and, where the truth has both bounds, share a base with it. Ties go to the smallest event_id.
    """
    rank = F.struct((-F.coalesce("support_z", F.lit(float("-inf")))).alias("low"), "event_id", "support_z", "fraction_point", "fraction_ci_low", "fraction_ci_high", "fraction_status")
    met = truth_hits(truth, events.where(F.col("event_id").isNotNull()), rank)
    own = met.groupBy("truth_id", *TRUTH_KEYS, "truth_fraction").agg(F.sum("n").alias("n_matched"), F.min("best").alias("top"))
    other = truth_hits(truth, external.where(F.col("abs_zscore").isNotNull()), -F.col("abs_zscore"))
    other = other.groupBy("truth_id").agg(F.sum("n").alias("external_n_matched"), (-F.min("best")).alias("external_top_z"))
    reaches = lambda z, least: F.coalesce(F.col(z) >= least, F.lit(False)).cast("int")
    out = own.join(other, "truth_id").withColumns({"top_event_id": F.col("top.event_id"), "top_z": F.col("top.support_z"), "point": F.col("top.fraction_point"), "ci_low": F.col("top.fraction_ci_low"), "ci_high": F.col("top.fraction_ci_high"), "fraction_status": F.col("top.fraction_status")})
    return out.withColumns({"detected": reaches("top_z", support), "external_detected": reaches("external_top_z", external_support)}).drop("top")


def fraction_errors(matched: DataFrame) -> DataFrame:
    """Error of the top event's fraction, and whether its interval holds the truth; null where either is missing."""
    err = F.col("point") - F.col("truth_fraction")
    inside = (F.col("truth_fraction") >= F.col("ci_low")) & (F.col("truth_fraction") <= F.col("ci_high"))
    return matched.withColumn("fraction_error", err).withColumn("abs_error", F.abs(err)).withColumn("ci_covers", F.when(err.isNotNull(), inside.cast("int")))


def fraction_error_summary(errors: DataFrame) -> DataFrame:
    return errors.agg(F.count("abs_error").alias("n"), F.avg("abs_error").alias("mae"), F.sqrt(F.avg(F.col("abs_error") * F.col("abs_error"))).alias("rmse"), F.median("abs_error").alias("median_abs_error"), F.avg("ci_covers").alias("coverage"))


def admixture_grid(matched: DataFrame, levels: list[float], support: float = 2.5, external_support: float = 5.0) -> DataFrame:
    """Every truth row at every level: both callers' z and the fraction scaled by it, detection, target fraction, where that is from and its bin."""
    rows = matched.select("*", F.explode(F.array(*[F.lit(x) for x in levels])).alias("level"))
    scaled = lambda c: F.col(c) * F.col("level")
    z, x, t, p = scaled("top_z"), scaled("external_top_z"), scaled("truth_fraction"), scaled("point")
    target = F.coalesce(t, p)
    source = F.when(t.isNotNull(), "truth_fraction").when(p.isNotNull(), "branch_b_estimate").otherwise("")
    reaches = lambda v, least: F.coalesce(v >= least, F.lit(False)).cast("int")
    return rows.select(
        "truth_id", "sample_id", "chrom", "state", "level", z.alias("scaled_z"), reaches(z, support).alias("detected"), x.alias("external_scaled_z"), reaches(x, external_support).alias("external_detected"),
        t.alias("truth_fraction"), p.alias("fraction_proxy"), target.alias("target_fraction"), source.alias("fraction_source"), fraction_bin(target).alias("fraction_bin"),
    )


def detection_by_level(grid: DataFrame) -> DataFrame:
    return grid.groupBy("level").agg(F.avg("detected").alias("detection_rate"), F.avg("external_detected").alias("external_detection_rate"), F.count("*").alias("truth_event_count"))


def risk_bucket_counts(events: DataFrame) -> DataFrame:
    bucket = F.when(F.coalesce(F.col("high_risk_bin_fraction") >= 0.5, F.lit(False)), "high_risk").otherwise("clean_or_mixed")
    return events.where("keep_event = 1").groupBy(bucket.alias("risk_bucket")).agg(F.count("*").alias("n_events"))


def _suppressed() -> Column:
    return F.coalesce((F.col("keep_event") == 1) & (F.col("artifact_status") == "review") & F.col("chrom").isin(*SEX), F.lit(False))


def sample_event_rollup(events: DataFrame) -> DataFrame:
    """Counts per sample, and how many kept review events on sex chromosomes are not shown."""
    return events.groupBy("sample_id").agg(
        F.count("*").alias("n_events"), F.sum("keep_event").alias("n_kept"), F.count_if(F.col("artifact_status") == "pass").alias("n_pass"), F.count_if(F.col("artifact_status") == "review").alias("n_review"), F.max("priority_score").alias("top_priority"), F.count_if(_suppressed()).alias("n_suppressed")
    )


def top_display_event(events: DataFrame) -> DataFrame:
    """The kept event to show of each sample, by priority, bins and end, as text, with its fraction in percent where there is one, flags and reasons."""
    w = Window.partitionBy("sample_id").orderBy(F.desc("priority_score"), F.desc("n_bins"), F.desc("end_pos"), "event_id")
    shown = events.where((F.col("keep_event") == 1) & ~_suppressed()).withColumn("__r", F.row_number().over(w)).where("__r = 1")
    text = F.format_string("%s:%d-%d %s [%s/%s]", "chrom", "start_pos", "end_pos", "state", "artifact_status", "technical_confidence")
    percent = lambda c: 100 * F.col(c)
    point, low, high = (F.col(c).isNotNull() for c in ("fraction_point", "fraction_ci_low", "fraction_ci_high"))
    return shown.select(
        "sample_id", "event_id", text.alias("top_event"),
        F.when(point, F.format_string("%.1f%%", percent("fraction_point"))).otherwise("").alias("top_fraction"),
        F.when(low & high, F.format_string("%.1f%% to %.1f%%", percent("fraction_ci_low"), percent("fraction_ci_high"))).otherwise("").alias("top_fraction_ci"),
        F.col("artifact_flags").alias("top_flags"), F.col("downgrade_reason").alias("top_downgrade_reason"),
    )


def sample_conclusions(samples: DataFrame, rollup: DataFrame, shown: DataFrame, external: DataFrame) -> DataFrame:
    """The technical and the biological line of text of each sample with events, from its roll-up, the event shown, the other caller's (sample_id, top_event) and the samples' qc_status and sex_call."""
    other = external.select("sample_id", F.col("top_event").alias("external_event"))
    df = rollup.join(shown, "sample_id", "left").join(other, "sample_id", "left").join(samples, "sample_id", "left")
    hidden = F.coalesce("n_suppressed", F.lit(0)) > 0
    said = lambda c, some, none: F.coalesce(F.nullif(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("")), F.when(hidden, some).otherwise(none))
    # fixed values: the sentences
    technical = F.format_string(
        "Branch B kept %d events; top event: %s; fraction=%s; flags=%s; downgrade=%s; sex_review_suppressed=%d; QC=%s; sex=%s",
        F.coalesce("n_kept", F.lit(0)), said("top_event", "suppressed_sex_chromosome_review", "none"), said("top_fraction", "not_estimated", "not_estimated"), said("top_flags", "sex_chromosome_event", "none"),
        said("top_downgrade_reason", "sex_chromosome_review_suppressed", "none"), F.coalesce("n_suppressed", F.lit(0)), said("qc_status", "NA", "NA"), said("sex_call", "NA", "NA"),
    )
    some = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    biological = F.coalesce(some("top_event"), some("external_event"), F.when(hidden, "Branch B top event suppressed (sex-chromosome review only)").otherwise("No A-branch event"))
    return df.select("sample_id", technical.alias("technical_conclusion"), biological.alias("biological_conclusion"))


def validate_truth(truth: DataFrame, required: tuple[str, ...] = ("sample_id", "chrom", "expected_state")) -> DataFrame:
    """One row: counts of complete, missing and invalid fractions and of repeated keys, with a status."""
    if [c for c in required if c not in truth.columns] or "abnormal_cell_fraction" not in truth.columns:
        return truth.agg(F.count("*").alias("n_rows"), *[F.lit(None).cast("bigint").alias(c) for c in ("n_complete", "n_missing", "n_invalid", "n_duplicate_keys")], F.lit("invalid_schema").alias("status"))
    text = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in truth.columns else F.lit("")
    raw = text("abnormal_cell_fraction")
    value = raw.try_cast("double")
    ok = F.coalesce((value >= 0) & (value <= 1), F.lit(False))
    keys = [text("sample_id").alias("k1"), text("chrom").alias("k2"), F.lower(text("expected_state")).alias("k3"), text("start").alias("k4"), text("end").alias("k5")]
    per = truth.select(*keys, (raw == "").alias("gone"), ok.alias("ok")).groupBy("k1", "k2", "k3", "k4", "k5").agg(F.count("*").alias("n"), F.count_if("ok").alias("good"), F.count_if("gone").alias("gone"))
    all_ = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (("n", "n_rows"), ("good", "n_complete"), ("gone", "n_missing"))], F.count_if(F.col("n") > 1).alias("n_duplicate_keys"))
    all_ = all_.withColumn("n_invalid", F.col("n_rows") - F.col("n_complete") - F.col("n_missing"))
    return all_.withColumn("status", F.when((F.col("n_missing") > 0) | (F.col("n_invalid") > 0), "incomplete").when(F.col("n_duplicate_keys") > 0, "needs_review").otherwise("ok"))


#: The keys by which tables are compared where none are given, the first all of whose columns exist.
KEY_CANDIDATES = [["sample_id", "chrom", "start", "end", "state"], ["sample_id", "chrom", "start", "end", "expected_state"], ["sample_id"]]


def diff_tables(a: DataFrame, b: DataFrame, keys: list[str] | None = None, tolerance: float = 1e-9, ignore: tuple[str, ...] = ()) -> DataFrame:
    """One row: what differs between two tables, and the largest difference of a number.

    schema_changed if the columns or their order differ; row_count_changed; value_changed if anything but numbers differs, or rows have no partner;
    float_tolerance_only if only numbers differ, by more than ``tolerance``; else identical. Rows are partners by their keys (KEY_CANDIDATES if none are given), each of
    which should occur once, rather than by their places in sorted tables. A column of numbers with a null on either side is compared as values.
    """
    spark = a.sparkSession
    fixed = lambda status: spark.range(1).select(F.lit(status).alias("status"), F.lit(None).cast("bigint").alias("n_rows_differ"), F.lit(None).cast("double").alias("max_abs_diff"))
    if a.columns != b.columns:
        return fixed("schema_changed")
    keys = keys or next((k for k in KEY_CANDIDATES if set(k) <= set(a.columns)), None)
    if not keys:
        raise ValueError("tables without key columns: name the keys")
    kind = dict(a.dtypes)
    values = [c for c in a.columns if c not in ignore and c not in keys]
    number = [c for c in values if kind[c] in ("double", "float", "int", "bigint", "smallint", "tinyint") or kind[c].startswith("decimal")]
    x = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in values], F.lit(1).alias("in_a"))
    y = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in values], F.lit(1).alias("in_b"))
    both = x.join(y, keys, "full")
    gap = lambda c: F.abs(F.col(f"a_{c}").cast("double") - F.col(f"b_{c}").cast("double"))
    differs = lambda c: ~F.equal_null(F.col(f"a_{c}"), F.col(f"b_{c}"))
    some = lambda tests: F.exists(F.array(F.lit(False), *tests), lambda v: v)
    alone = F.col("in_a").isNull() | F.col("in_b").isNull()
    per = []
    for i, c in enumerate(values):
        per.append(F.count_if(~alone & differs(c)).alias(f"differ{i}"))
        if c in number:
            per += [F.count_if(~alone & (F.col(f"a_{c}").isNull() | F.col(f"b_{c}").isNull())).alias(f"null{i}"), F.max(F.when(~alone, gap(c))).alias(f"far{i}")]
    n = both.agg(F.count("in_a").alias("left"), F.count("in_b").alias("right"), F.count_if(alone).alias("alone"), F.count_if(alone | some([differs(c) for c in values])).alias("differ"), *per)
    plain = lambda i, c: (c in number) and F.col(f"null{i}") == 0
    changed = [(F.col(f"differ{i}") > 0) & (~plain(i, c) if c in number else F.lit(True)) for i, c in enumerate(values)]
    moved = [plain(i, c) & (F.coalesce(f"far{i}", F.lit(0.0)) > tolerance) for i, c in enumerate(values) if c in number]
    far = F.array_max(F.array(F.lit(0.0), *[F.coalesce(f"far{i}", F.lit(0.0)) for i, c in enumerate(values) if c in number]))
    status = F.when(F.col("left") != F.col("right"), "row_count_changed").when((F.col("alone") > 0) | some(changed), "value_changed").when(some(moved), "float_tolerance_only").otherwise("identical")
    return n.select(status.alias("status"), F.col("differ").alias("n_rows_differ"), far.alias("max_abs_diff"))


def run_status(logs: DataFrame, failed: list[str], done: list[str]) -> DataFrame:
    """Status per run_key from log lines and whether outputs exist: success, log_failed, log_complete, benchmark_only or output_missing."""
    has = lambda words: F.coalesce(F.bool_or(F.lower("line").rlike("|".join(words))), F.lit(False))
    status = F.when(F.bool_and("outputs_exist"), "success").when(has(failed), "log_failed").when(has(done), "log_complete").when(F.count("line") > 0, "benchmark_only").otherwise("output_missing")
    return logs.groupBy("run_key").agg(status.alias("status"))


def batch_group(name: Column) -> Column:
    """The batch that a sample's id says: E and digits, digits, one letter A to H, or other."""
    # fixed values: the names of the groups
    return F.when(name.rlike("^E[0-9]+$"), "batch5_E").when(name.rlike("^[0-9]+$"), "batch3_num").when(name.rlike("^[A-H]$"), "batch2_AH").otherwise("other")


def decision_rank(decision: Column) -> Column:
    return F.when(decision == "PASS", 0).when(decision == "WARN", 1).when(decision == "FAIL", 2).otherwise(3)


def binsize_summary(rows: DataFrame, medians: list[str]) -> DataFrame:
    """Per bin label the samples by decision, and medians."""
    count = lambda d: F.count_if(F.col("qc_decision") == d).alias(f"n_{d.lower()}")
    return rows.groupBy("bin_label").agg(*[count(d) for d in ("PASS", "WARN", "FAIL")], *[F.median(c).alias(f"median_{c}") for c in medians])


def sample_decision_matrix(rows: DataFrame, labels: list[str]) -> DataFrame:
    """A column of decisions for each bin label, fails and warnings, the worst rank, and whether all are PASS (a missing one is not)."""
    wide = rows.groupBy("sample_id").pivot("bin_label", labels).agg(F.first("qc_decision"))
    cells = F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit("missing")) for c in labels])
    n = lambda d: F.size(F.filter(cells, lambda x: x == d))
    worst = F.array_max(F.transform(F.filter(cells, lambda x: x != "missing"), decision_rank))
    return wide.withColumns({"n_fail": n("FAIL"), "n_warn": n("WARN"), "worst_rank": worst, "stable_retained": (n("PASS") == len(labels)).cast("int")})


def resolve_sex(calls: DataFrame, method: str = "hybrid") -> DataFrame:
    """Final sex, gender (F, M or empty) and where they are from, of model_call and depth_call.

    model_only: the model's call. depth_only: the depth's where it is XX or XY, else the model's. hybrid: a depth call of XX or XY
    that disagrees with the model, or finds none, overrides it.
    """
    m, d = F.col("model_call"), F.col("depth_call")
    sure = F.coalesce(d.isin("XX", "XY"), F.lit(False))
    if method == "model_only":
        final, source = m, F.lit("model_only")
    elif method == "depth_only":
        final, source = F.when(sure, d).otherwise(m), F.when(sure, "depth_only").otherwise("depth_only_fallback_model")
    elif method == "hybrid":
        final = F.when(sure, d).otherwise(m)
        source = F.when(sure & F.coalesce(m != d, F.lit(True)), "depth_override").when(sure, "model_depth_consensus").otherwise("model_fallback")
    else:
        raise ValueError(f"unknown method {method}")
    gender = F.when(final == "XX", "F").when(final == "XY", "M").otherwise("")
    return calls.withColumns({"sex": final, "gender": gender, "sex_source": source})


def cutoff_applicability(values: DataFrame, value: str, cutoff: float) -> DataFrame:
    """Whether all values of a group are strictly on one side of the cut-off."""
    return values.groupBy("group").agg((F.bool_and(F.col(value) < cutoff) | F.bool_and(F.col(value) > cutoff)).cast("int").alias("applicable"))
