"""Robust, weighted and ordered-series statistics on long tables.

All operators take the grouping keys as a list, treat NaN like null (see
clean()), and stay inside Catalyst.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def clean(value: Column | str) -> Column:
    """The value as a double, with NaN and infinities as null."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def over(keys: list[str]) -> Window:
    return Window.partitionBy(*keys)


def normalize_log1p_cpm(bins: DataFrame, keys: list[str], count: str = "raw_count") -> DataFrame:
    """ln(1 + counts per million) and bin_weight = sqrt(max(count, 1)); a total of 0 or less counts as 1."""
    total = F.sum(count).over(over(keys))
    return bins.withColumn("normalized_signal", F.log1p(F.col(count) / F.when(total <= 0, 1.0).otherwise(total) * 1e6)).withColumn("bin_weight", F.sqrt(F.greatest(F.col(count), F.lit(1)).cast("double")))


def normalize_log2_cpm(bins: DataFrame, keys: list[str], count: str = "raw_count") -> DataFrame:
    """log2(counts per million + 1); a group without counts is an error."""
    total = F.sum(count).over(over(keys))
    checked = F.when(total > 0, total).otherwise(F.raise_error(F.lit("a sample has no counts")).cast("double"))
    return bins.withColumn("signal_log2cpm", F.log2(F.col(count) / checked * 1e6 + 1))


def robust_z(df: DataFrame, value: str, keys: list[str], out: str = "robust_z", strict: bool = False) -> DataFrame:
    """(x - median) / (1.4826 * MAD); where MAD is 0 the population deviation scales, unless ``strict``, and 0 if that is 0 too."""
    w = over(keys)
    mid = df.withColumn("__m", F.median(clean(value)).over(w))
    mid = mid.withColumn("__mad", F.median(F.abs(clean(value) - F.col("__m"))).over(w) * 1.4826)
    spread = F.when(F.col("__mad") > 0, F.col("__mad"))
    if not strict:
        spread = F.coalesce(spread, F.stddev_pop(clean(value)).over(w))
    return mid.withColumn("__s", spread).withColumn(out, F.when(F.col("__s") > 0, (clean(value) - F.col("__m")) / F.col("__s")).when(clean(value).isNotNull(), 0.0)).drop("__m", "__mad", "__s")


def robust_center_scale(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Per group: median, and max(1.4826 * MAD, population deviation, 1e-6); (0, 1) without values."""
    mid = df.withColumn("__m", F.median(clean(value)).over(over(keys)))
    out = mid.groupBy(*keys).agg(F.median(clean(value)).alias("center"), F.median(F.abs(clean(value) - F.col("__m"))).alias("__mad"), F.stddev_pop(clean(value)).alias("__sd"))
    return out.select(*keys, F.coalesce("center", F.lit(0.0)).alias("center"), F.when(F.col("center").isNull(), 1.0).otherwise(F.greatest(1.4826 * F.col("__mad"), F.col("__sd"), F.lit(1e-6))).alias("scale"))


def _usable(value: str, weight: str) -> tuple[Column, Column]:
    ok = clean(value).isNotNull() & (clean(weight) > 0)
    return F.when(ok, clean(value)), F.when(ok, clean(weight))


def weighted_stats(df: DataFrame, value: str, weight: str, keys: list[str]) -> DataFrame:
    """Weighted mean and population deviation, effective sample size and Stouffer's z; rows without value or weight are skipped."""
    x, w = _usable(value, weight)
    rows = df.select(*keys, x.alias("__x"), w.alias("__w"))
    x, w = F.col("__x"), F.col("__w")
    sums = rows.groupBy(*keys).agg(F.sum(w).alias("w"), F.sum(w * w).alias("ww"), F.sum(w * x).alias("wx")).withColumn("mean", F.col("wx") / F.col("w"))
    # the variance about the mean in a second pass: a difference of squares leaves noise where all values are the same
    apart = x - F.col("mean")
    same = reduce(and_, [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    whole = rows.alias("r").join(sums.alias("s"), same, "right").select(*[F.col(f"s.{k}").alias(k) for k in keys], "__x", "__w", "w", "ww", "wx", "mean")
    per = whole.groupBy(*keys, "w", "ww", "wx", "mean").agg((F.sum(w * apart * apart) / F.first("w")).alias("variance"))
    return per.select(
        *keys,
        F.col("mean").alias("weighted_mean"),
        F.sqrt("variance").alias("weighted_std"),
        F.coalesce(F.col("w") * F.col("w") / F.col("ww"), F.lit(0.0)).alias("effective_sample_size"),
        (F.col("wx") / F.sqrt("ww")).alias("stouffer_z"),
    )


def autocorrelation(df: DataFrame, value: str, sample: list[str], chrom: str, order: str, max_lag: int = 5) -> DataFrame:
    """(sample.., lag, rho): mean over chromosomes with at least 3 values and some variance, clipped to 0.95 either way.

    Neighbours are neighbours in the list of values that are present, not on the genome. A variance of 1e-20 or less is what rounding leaves of equal values.
    """
    keys = [*sample, chrom]
    here = df.where(clean(value).isNotNull()).select(*keys, order, clean(value).alias("x"))
    here = here.select(*keys, order, (F.col("x") - F.avg("x").over(over(keys))).alias("x"), F.count("*").over(over(keys)).alias("n"))
    w = Window.partitionBy(*keys).orderBy(order)
    lags = F.array(*[F.struct(F.lit(k).alias("lag"), (F.col("x") * F.lag("x", k).over(w)).alias("xx")) for k in range(1, max_lag + 1)])
    rows = here.withColumn("lags", lags).select(*keys, "n", "x", F.inline("lags"))
    per = rows.groupBy(*keys, "lag", "n").agg(F.sum("xx").alias("xx"), F.avg(F.col("x") * F.col("x")).alias("var")).where((F.col("n") >= 3) & (F.col("var") > 1e-20) & (F.col("n") > F.col("lag")))
    return per.groupBy(*sample, "lag").agg(F.greatest(F.lit(-0.95), F.least(F.lit(0.95), F.avg(F.col("xx") / ((F.col("n") - F.col("lag")) * F.col("var"))))).alias("rho"))


def autocorr_inflation(rho: DataFrame, sample: list[str], n: int) -> DataFrame:
    """max(1, 1 + 2 * sum of rho_k * (1 - k / n) for k < n)."""
    term = F.sum(F.when(F.col("lag") < n, F.col("rho") * (1 - F.col("lag") / n)))
    return rho.groupBy(*sample).agg(F.greatest(F.lit(1.0), 1 + 2 * F.coalesce(term, F.lit(0.0))).alias("inflation"))


def benjamini_hochberg(df: DataFrame, p: str, keys: list[str], tie: list[str], out: str = "q_value") -> DataFrame:
    """q = reverse running minimum of p * n / rank within a family, clipped to [0, 1]; null p stays null."""
    has = clean(p).isNotNull()
    n = F.count(clean(p)).over(over(keys))
    order = Window.partitionBy(*keys).orderBy(clean(p).asc_nulls_last(), *tie)
    ranked = df.withColumn("__r", F.row_number().over(order)).withColumn("__q", F.when(has, clean(p) * n / F.col("__r")))
    rest = Window.partitionBy(*keys).orderBy("__r").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return ranked.withColumn(out, F.when(has, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.min("__q").over(rest))))).drop("__r", "__q")


def gini(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Gini index; values are shifted to 0 if any is negative; 0 for a total of 0."""
    low = F.min(value).over(over(keys))
    x = df.select(*keys, (F.col(value) - F.least(low, F.lit(0))).cast("double").alias("x"))
    i = F.row_number().over(Window.partitionBy(*keys).orderBy("x"))
    sums = x.withColumn("i", i).groupBy(*keys).agg(F.sum(F.col("i") * F.col("x")).alias("ix"), F.sum("x").alias("s"), F.count("*").alias("n"))
    return sums.select(*keys, F.when(F.col("s") > 0, 2 * F.col("ix") / (F.col("n") * F.col("s")) - (F.col("n") + 1) / F.col("n")).otherwise(0.0).alias("gini"))


def mad(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Median absolute deviation from the median."""
    mid = df.withColumn("__m", F.median(clean(value)).over(over(keys)))
    return mid.groupBy(*keys).agg(F.median(F.abs(clean(value) - F.col("__m"))).alias("mad"))


#: Coefficients of the published rational Chebyshev fit of ln(erfc(x) / t) + x^2 in t = 1 / (1 + x / 2), relative error under 1.2e-7 for all x >= 0.
ERFC = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]


def two_sided_p(z: Column | str) -> Column:
    """erfc(|z| / sqrt 2) with a relative error under 1.2e-7; a missing z counts as 0, so p is 1."""
    z = F.col(z) if isinstance(z, str) else z
    x = F.abs(F.coalesce(z, F.lit(0.0))) / math.sqrt(2)
    t = 1 / (1 + x / 2)
    fit = F.lit(ERFC[-1])
    for c in reversed(ERFC[:-1]):
        fit = c + t * fit
    return F.least(F.lit(1.0), t * F.exp(fit - x * x))


def average_rank(value: str, keys: list[str]) -> Column:
    """Rank with ties at their mean."""
    return F.rank().over(Window.partitionBy(*keys).orderBy(value)) + (F.count("*").over(Window.partitionBy(*keys, value)) - 1) / 2


def correlations(df: DataFrame, x: str, y: str, keys: list[str]) -> DataFrame:
    """Mean of x, Pearson and Spearman correlation and least-squares slope of y on x; null under 3 pairs."""
    pairs = df.where(clean(x).isNotNull() & clean(y).isNotNull()).select(*keys, clean(x).alias("x"), clean(y).alias("y"))
    pairs = pairs.withColumn("rx", average_rank("x", keys)).withColumn("ry", average_rank("y", keys))
    enough = F.count("*") >= 3
    return pairs.groupBy(*keys).agg(
        F.when(enough, F.avg("x")).alias("mean_x"),
        F.when(enough, F.corr("x", "y")).alias("pearson"),
        F.when(enough, F.corr("rx", "ry")).alias("spearman"),
        F.when(enough, F.regr_slope("y", "x")).alias("slope"),
    )


def linear_percentile(df: DataFrame, value: str, q: float, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.percentile(clean(value), q).alias("percentile"))
