"""Calibration of events against an empirical null, and abnormal fractions of autosomal events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binlattice.functions.stats import autocorrelation, benjamini_hochberg, clean, over, two_sided_p
from binlattice.operators.grid import events_to_bins
from binlattice.operators.qc import AUTOSOME


def null_bins(bins: DataFrame, least: int = 200, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """The bins of the null: neutral and eligible; under ``least`` the eligible (or all) between two quantiles of z; under ``least`` again, all."""
    w = over(["sample_id"])
    eligible = F.coalesce(F.col("null_eligible") == 1, F.lit(False))
    df = bins.withColumn("__e", eligible).withColumn("__n", eligible & (F.col("hmm_state") == "neutral"))
    df = df.withColumn("__p", F.col("__e") | ~F.bool_or("__e").over(w))
    z = F.when(F.col("__p"), clean("robust_z"))
    mid = F.col("__p") & (F.col("robust_z") >= F.percentile(z, low).over(w)) & (F.col("robust_z") <= F.percentile(z, high).over(w))
    df = df.withColumn("__m", F.coalesce(mid, F.lit(False))).withColumn("__cn", F.count_if("__n").over(w)).withColumn("__cm", F.count_if("__m").over(w))
    keep = F.when(F.col("__cn") >= least, F.col("__n")).when(F.col("__cm") >= least, F.col("__m")).otherwise(True)
    return df.where(keep).drop("__e", "__n", "__p", "__m", "__cn", "__cm")


def empirical_null(bins: DataFrame, least: int = 200) -> DataFrame:
    """Per sample: size, median and scale max(1.4826 * MAD, population deviation, 1e-6) of the null."""
    mid = null_bins(bins, least).withColumn("__m", F.median(clean("robust_z")).over(over(["sample_id"])))
    scale = F.greatest(1.4826 * F.median(F.abs(clean("robust_z") - F.col("__m"))), F.stddev_pop(clean("robust_z")), F.lit(1e-6))
    return mid.groupBy("sample_id").agg(F.count("*").alias("n_null"), F.median(clean("robust_z")).alias("null_median"), scale.alias("null_scale"))


def calibrate_bins(bins: DataFrame, null: DataFrame) -> DataFrame:
    return bins.join(null, "sample_id").withColumn("calibrated_z", (F.col("robust_z") - F.col("null_median")) / F.col("null_scale"))


def null_autocorrelation(bins: DataFrame, least: int = 200, max_lag: int = 5) -> DataFrame:
    """Autocorrelation of the null's bins; a shift and scale of z doesn't change it."""
    return autocorrelation(null_bins(bins, least), "robust_z", ["sample_id"], "chrom", "bin_index", max_lag)


def event_support(events: DataFrame, calibrated: DataFrame, rho: DataFrame, overlaps: list[str]) -> DataFrame:
    """Weighted support of each event by its bins: Stouffer's z, the same with autocorrelation taken out, risk shares, overlaps.

    Effective bins never exceed bins, so the inflation takes the number of bins.
    """
    w = F.greatest("calling_weight", F.lit(0.1))
    share = lambda k: (F.sum(F.when(F.col("region_risk_class") == k, w).otherwise(0.0)) / F.sum(w)).alias(f"{'clean' if k == 'clean' else k + '_risk'}_bin_fraction")
    size = F.greatest((F.col("end_pos") - F.col("start_pos")).cast("double"), F.lit(1.0))
    ends = F.min_by("region_risk_class", "bin_index") != F.max_by("region_risk_class", "bin_index")
    mixed = F.bool_or(F.col("region_risk_class") == "clean") & F.bool_or(F.col("region_risk_class") == "high")
    per = events_to_bins(events, calibrated).groupBy("event_id", "sample_id").agg(
        F.count("*").alias("n"), (F.sum(w * F.col("calibrated_z")) / F.sqrt(F.sum(w * w))).alias("event_weighted_z"), (F.sum(w) * F.sum(w) / F.sum(w * w)).alias("effective_bin_count"),
        share("clean"), share("moderate"), share("high"), (F.sum(F.col("risk_score") * w) / F.sum(w)).alias("region_risk_score_mean"), F.max("risk_score").alias("region_risk_score_max"),
        (ends & mixed).cast("int").alias("high_risk_boundary_crossing"), *[(F.sum(F.col(c) * size) / F.sum(size)).alias(c) for c in overlaps],
    )
    lags = rho.groupBy("sample_id").agg(F.collect_list(F.struct("lag", "rho")).alias("lags"))
    total = F.aggregate(F.filter("lags", lambda x: x["lag"] < F.col("n")), F.lit(0.0), lambda s, x: s + x["rho"] * (1 - x["lag"] / F.col("n")))
    out = per.join(lags, "sample_id", "left").withColumn("autocorr_inflation", F.greatest(F.lit(1.0), 1 + 2 * F.coalesce(total, F.lit(0.0))))
    return out.withColumn("event_corr_adjusted_z", F.col("event_weighted_z") / F.sqrt("autocorr_inflation")).drop("lags", "n", "sample_id")


def event_significance(events: DataFrame, support: DataFrame, null: DataFrame, least_z: float = 2.5, most_q: float = 0.25, p: Callable[[Column], Column] = two_sided_p) -> DataFrame:
    """Events with calibrated z, p, q within the sample, and whether to keep them: q small or any z large."""
    out = events.join(support, "event_id", "left").join(null, "sample_id")
    for c in ("mean", "median"):
        out = out.withColumn(f"calibrated_{c}_z", (F.col(f"segment_{c}_robust_z") - F.col("null_median")) / F.col("null_scale"))
    out = benjamini_hochberg(out.withColumn("empirical_pvalue", p(F.col("event_corr_adjusted_z"))), "empirical_pvalue", ["sample_id"], ["event_id"], "empirical_qvalue")
    big = F.greatest(*[F.abs(c) for c in ("calibrated_mean_z", "calibrated_median_z", "event_corr_adjusted_z")]) >= least_z
    return out.withColumn("keep_event", F.coalesce((F.col("empirical_qvalue") <= most_q) | big, F.lit(False)).cast("int"))


def calibration_summary(null: DataFrame, significant: DataFrame) -> DataFrame:
    per = significant.groupBy("sample_id").agg(F.count("*").alias("n_events"), F.sum("keep_event").alias("n_kept"))
    return null.join(per, "sample_id", "left").fillna(0, ["n_events", "n_kept"])


def neutral_baseline(bins: DataFrame, signal: str = "normalized_signal", least: int = 200) -> DataFrame:
    """Per sample the median signal of neutral eligible clean autosomal bins; under ``least`` of any risk class, then of all autosomal bins."""
    x = F.when(F.col("chrom").rlike(AUTOSOME), clean(signal))
    fit = F.when((F.col("hmm_state") == "neutral") & (F.col("null_eligible") == 1), x)
    tidy = F.when(F.col("region_risk_class") == "clean", fit)
    pick = lambda f: F.when(F.count(tidy) >= least, f(tidy)).when(F.count(fit) >= least, f(fit)).otherwise(f(x))
    return bins.groupBy("sample_id").agg(pick(F.median).alias("baseline"), pick(F.count).alias("n_baseline"))


def _clip(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def abnormal_fraction(events: DataFrame, bins: DataFrame, baseline: DataFrame, signal: str = "normalized_signal", least_effective: float = 5.0, least_log2: float = 0.03) -> DataFrame:
    """Fraction of abnormal cells of autosomal gains and losses with its 95 % interval, a status and reasons.

    The ratio is one of signals on the log scale, as the statistic is defined. Events that can't be estimated stay with the first reason that holds.
    """
    w = F.when(clean(signal).isNotNull(), F.greatest("calling_weight", F.lit(0.1)))
    x = clean(signal)
    all_w = F.greatest("calling_weight", F.lit(0.1))
    held = events_to_bins(events, bins)
    means = held.groupBy("event_id").agg((F.sum(x * w) / F.sum(w)).alias("m"))
    # the variance about the mean in a second pass: a difference of squares leaves noise where all signals are the same
    per = held.join(means, "event_id").groupBy("event_id").agg(F.first("m").alias("m"), (F.sum(w * (x - F.col("m")) * (x - F.col("m"))) / F.sum(w)).alias("variance"), (F.sum(all_w) * F.sum(all_w) / F.sum(all_w * all_w)).alias("ess"))
    df = events.join(per, "event_id", "left").join(baseline, "sample_id", "left")
    ratio = F.greatest(F.round(F.col("m") / F.col("baseline"), 12), F.lit(1e-6))  # rounded: the order of a sum must not decide whether it is 1
    sound = F.col("m").isNotNull() & (F.col("baseline") > 0)
    usable = F.col("state").isin("gain", "loss") & F.col("chrom").rlike(AUTOSOME) & F.coalesce(sound, F.lit(False))
    df = df.withColumn("event_copy_ratio", F.when(usable, ratio)).withColumn("event_log2_ratio", F.log2("event_copy_ratio"))
    r = F.col("event_copy_ratio")
    why = (
        F.when(~F.coalesce(F.col("state").isin("gain", "loss"), F.lit(False)), "unsupported_state").when(~F.col("chrom").rlike(AUTOSOME), "non_autosomal_event").when(F.col("ess").isNull(), "event_bins_unavailable")
        .when(~F.coalesce(sound, F.lit(False)), "invalid_signal_baseline").when(F.col("ess") < least_effective, "effective_bins_below_minimum").when((F.col("state") == "gain") & (r <= 1), "gain_without_ratio_shift")
        .when((F.col("state") == "loss") & (r >= 1), "loss_without_ratio_shift").when(F.abs("event_log2_ratio") < least_log2, "log2_ratio_below_minimum")
    )
    df = df.withColumn("__why", why)
    good = F.col("__why").isNull()
    point = 2 * F.abs(r - 1)
    half = 1.96 * 2 * F.sqrt("variance") / F.sqrt(F.greatest("ess", F.lit(1.0))) / F.col("baseline")
    df = df.withColumn("fraction_point", F.when(good, _clip(point))).withColumn("fraction_ci_low", F.when(good, _clip(point - half))).withColumn("fraction_ci_high", F.when(good, _clip(point + half)))
    dirty, risky, small = F.coalesce(F.col("clean_bin_fraction") < 0.5, F.lit(False)), F.coalesce(F.col("high_risk_bin_fraction") > 0.25, F.lit(False)), F.col("fraction_point") < 0.15
    text = F.concat_ws(";", F.when(dirty, "clean_support_below_threshold"), F.when(risky, "high_risk_fraction_above_threshold"), F.when(small, "fraction_below_low_level_threshold"))
    status = F.when(~good, "not_estimated").when(small, "low_level_signal").when(dirty | risky, "estimated_low_confidence").otherwise("estimated")
    df = df.withColumn("fraction_status", status).withColumn("fraction_reliable", (status == "estimated").cast("int"))
    return df.withColumn("fraction_reason", F.when(~good, F.col("__why")).when(text != "", text).otherwise("supported_autosomal_single_copy_model")).drop("__why", "m", "variance", "ess", "baseline", "n_baseline")


def fraction_summary(fractions: DataFrame) -> DataFrame:
    return fractions.groupBy("fraction_status").agg(F.count("*").alias("n_events"), F.sum("fraction_reliable").alias("n_reliable"))
