"""Removing the trend of the signal over base composition and mappability.

The local fits take one sample's bins in a task: their number is bounded by the
genome, and cohorts run in parallel over samples. Within a task the fits are
made in blocks of rows, so memory does not grow with the square of the bins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from binlattice.functions.stats import clean, over
from binlattice.operators.qc import AUTOSOME

CELLS = 1 << 20  # numbers of a block's rows by neighbours
FLAT = 1e-14  # weighted spread of x below which a local line has no slope


def _blocks(n: int, width: int) -> Iterator[slice]:
    step = max(1, CELLS // max(width, 1))
    return (slice(i, min(i + step, n)) for i in range(0, n, step))


def _tricube(u: np.ndarray) -> np.ndarray:
    v = 1 - u * u * u
    return v * v * v


def _line_at_zero(dx: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Value at dx = 0 of each row's weighted line; the shortest solution where a row has one x only, its plain mean under 2 weights."""
    sw = w.sum(1)
    safe = np.where(sw > 0, sw, 1)
    mx, my = (w * dx).sum(1) / safe, (w * y).sum(1) / safe
    c = dx - mx[:, None]
    sxx = (w * c * c).sum(1)
    flat = sxx <= FLAT * safe
    fit = np.where(flat, my / (1 + mx * mx), my - mx * (w * c * y).sum(1) / np.where(flat, 1, sxx))
    return np.where((w > 0).sum(1) < 2, y.mean(1), fit)


def smooth_positions(x: np.ndarray, y: np.ndarray, frac: float, robust_iters: int) -> np.ndarray:
    """Local lines over windows of neighbouring places of sorted x, reweighted ``robust_iters`` times by bisquare residuals.

    A window has max(3, ceil(frac * n)) places and is shifted at the ends; under 3 values y is its own trend.
    """
    n = len(x)
    if n < 3:
        return y.copy()
    size = min(n, max(3, math.ceil(frac * n)))
    full = max(3, math.ceil(frac * n))
    right = np.minimum(n, np.maximum(0, np.arange(n) - full // 2) + full)
    start = np.maximum(0, right - full)
    robust, fit = np.ones(n), np.empty(n)
    for turn in range(robust_iters + 1):
        for rows in _blocks(n, size):
            at = start[rows, None] + np.arange(size)
            dx = x[at] - x[rows, None]
            reach = np.abs(dx).max(1, keepdims=True)
            w = _tricube(np.abs(dx) / np.where(reach > 0, reach, 1)) * robust[at]
            fit[rows] = np.where(reach[:, 0] > 0, _line_at_zero(dx, y[at], w), y[at].mean(1))
        if turn < robust_iters:
            residual = y - fit
            scale = np.median(np.abs(residual))
            robust = np.where(np.abs(residual) < 6 * scale, (1 - (residual / (6 * scale)) ** 2) ** 2, 0.0) if scale > 0 else np.ones(n)
    return fit


def gc_loess(bins: DataFrame, value: str, gc: str, order: list[str], keys: list[str], frac: float = 0.2, robust_iters: int = 1) -> DataFrame:
    """(keys.., order.., gc_trend) for the bins with value and GC; equal GC keeps the order of the bins."""
    rows = bins.select(*keys, *order, clean(gc).alias("x"), clean(value).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    kinds = dict(bins.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, *order]) + ", gc_trend double"

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["x", *order], kind="stable")
        group["gc_trend"] = smooth_positions(group["x"].to_numpy(), group["y"].to_numpy(), frac, robust_iters)
        return group[[*keys, *order, "gc_trend"]]

    return rows.groupBy(*keys).applyInPandas(fit, schema)


def gc_poly(bins: DataFrame, value: str, gc: str, order: list[str], keys: list[str], degree: int = 2) -> DataFrame:
    """(keys.., order.., gc_trend) of the least-squares polynomial of degree 1 or 2, from sums of powers of the centred GC.

    With fewer distinct GC values than coefficients the degree falls, which leaves the fitted values those of least squares.
    """
    if degree not in (1, 2):
        raise ValueError("degree is 1 or 2")
    rows = bins.select(*keys, *order, clean(gc).alias("g"), clean(value).alias("y")).where("g IS NOT NULL AND y IS NOT NULL")
    rows = rows.withColumn("m", F.avg("g").over(over(keys))).withColumn("x", F.col("g") - F.col("m"))
    x, y = F.col("x"), F.col("y")
    sums = rows.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(x**k).alias(f"s{k}") for k in (2, 3, 4)], *[F.sum(x**k * y).alias(f"t{k}") for k in (0, 1, 2)], F.count_distinct("g").alias("values"))
    n, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ("n", "s2", "s3", "s4", "t0", "t1", "t2"))
    # With s1 = 0, removing mean and line from x^2 leaves q = x^2 - s2/n - (s3/s2) x.
    spread = s4 - s2 * s2 / n - s3 * s3 / s2
    bend = F.when((F.col("values") >= 3) & F.lit(degree == 2), (t2 - s2 / n * t0 - s3 / s2 * t1) / spread).otherwise(0.0)
    slope = F.when(F.col("values") >= 2, t1 / s2 - bend * s3 / s2).otherwise(0.0)
    fits = sums.select(*keys, bend.alias("c2"), slope.alias("c1"), (t0 / n - bend * s2 / n).alias("c0"))
    trend = F.col("c0") + F.col("c1") * x + F.col("c2") * x * x
    return rows.join(fits, keys).select(*keys, *order, trend.alias("gc_trend"))


def apply_gc_correction(bins: DataFrame, value: str, gc: str, method: str, order: list[str], keys: list[str], frac: float = 0.2, degree: int = 2, min_valid: int = 200, robust_iters: int = 1) -> DataFrame:
    """bins with gc_trend, signal_corrected = value - trend + median, gc_correction_applied (0/1) and gc_correction_valid_bins.

    Groups with fewer than max(3, min_valid) bins that have value and GC, and such bins themselves, keep their value and a null trend.
    """
    has = clean(value).isNotNull() & clean(gc).isNotNull()
    counted = bins.withColumn("gc_correction_valid_bins", F.count_if(has).over(over(keys)))
    enough = F.col("gc_correction_valid_bins") >= max(3, min_valid)
    fit = counted.where(enough)
    if method == "loess":
        trend = gc_loess(fit, value, gc, order, keys, max(0.05, min(frac, 1.0)), robust_iters)
    elif method == "poly2":
        trend = gc_poly(fit, value, gc, order, keys, degree)
    elif method == "none":
        return counted.withColumns({"gc_trend": F.lit(None).cast("double"), "signal_corrected": clean(value), "gc_correction_applied": F.lit(0)})
    else:
        raise ValueError(f"no GC correction named {method}")
    middle = F.median(F.when(has, clean(value))).over(over(keys))
    out = counted.join(trend, [*keys, *order], "left").withColumn("__m", middle)
    return out.withColumn("signal_corrected", F.coalesce(clean(value) - F.col("gc_trend") + F.col("__m"), clean(value))).withColumn("gc_correction_applied", enough.cast("int")).drop("__m")


def _planes(train: np.ndarray, y: np.ndarray, w: np.ndarray, query: np.ndarray, frac: float) -> np.ndarray:
    """Height at each query of the weighted plane through its nearest training points, from weighted sums of products."""
    n = len(train)
    k = min(n, max(25, min(n, math.ceil(max(frac, 0.01) * n))))
    out = np.empty(len(query))
    fallback = np.average(y, weights=np.maximum(w, 1e-6))
    a, b = train.T
    terms = np.column_stack([np.ones(n), a, b, a * a, a * b, b * b, y, a * y, b * y])
    for rows in _blocks(len(query), n):
        p, q = query[rows].T
        far = np.hypot(a - p[:, None], b - q[:, None])
        radius = np.partition(far, k - 1, axis=1)[:, k - 1 : k]
        for i in np.flatnonzero(radius[:, 0] <= 0):
            radius[i] = far[i][far[i] > 0].min() if (far[i] > 0).any() else 1.0
        kernel = _tricube(np.minimum(far / radius, 1)) * w
        s, sa, sb, saa, sab, sbb, sy, say, sby = (kernel @ terms).T
        # Sums around the query instead of the origin.
        da, db = sa - p * s, sb - q * s
        daa, dab, dbb = saa - 2 * p * sa + p * p * s, sab - p * sb - q * sa + p * q * s, sbb - 2 * q * sb + q * q * s
        left = np.stack([s, da, db, da, daa, dab, db, dab, dbb], axis=1).reshape(-1, 3, 3)
        right = np.stack([sy, say - p * sy, sby - q * sy], axis=1)
        heights = np.einsum("qj,qj->q", np.linalg.pinv(left, rcond=1e-12, hermitian=True)[:, 0], right)
        out[rows] = np.where(s > 0, heights, fallback)
    return out


def loess_2d(train: np.ndarray, y: np.ndarray, base: np.ndarray, query: np.ndarray, frac: float = 0.2, robust_iters: int = 2) -> np.ndarray:
    """Prediction at the queries after max(robust_iters, 1) rounds of bisquare weights from median-centred residuals."""
    robust = np.ones(len(y))
    for _ in range(max(robust_iters, 1)):
        residual = y - _planes(train, y, base * robust, train, frac)
        residual = np.abs(residual - np.median(residual))
        scale = 6 * 1.4826 * np.median(residual)
        robust = np.where(residual < scale, (1 - (residual / scale) ** 2) ** 2, 0.0) if scale > 0 else np.ones(len(y))
    return _planes(train, y, base * robust, query, frac)


def correct_signal_2d(bins: DataFrame, frac: float = 0.2, robust_iters: int = 2, min_valid: int = 200, labels: tuple[str, ...] = ("pass", "soft")) -> DataFrame:
    """bins with correction_expected_signal, correction_residual, signal_for_calling and correction_applied, per sample.

    Fitted on autosomal bins with one of the mask labels that are fit for it and have GC and mappability; predicted for
    all bins, a missing feature counting as the median. With fewer than min_valid such bins the signal stays as it is.
    """
    value, gc, mapped = clean("normalized_signal"), clean("gc_fraction"), F.coalesce(clean("mappability_score"), F.lit(1.0))
    fit = F.col("chrom").rlike(AUTOSOME) & F.coalesce(F.col("mask_label"), F.lit("pass")).isin(*labels) & (F.col("correction_fit_eligible") == 1) & gc.isNotNull() & value.isNotNull()
    weight = F.greatest(F.col("bin_weight") * F.col("region_risk_weight"), F.lit(0.25))
    rows = bins.select("sample_id", "chrom", "bin_index", value.alias("y"), gc.alias("gc"), mapped.alias("mapped"), weight.alias("w"), F.coalesce(fit, F.lit(False)).alias("fit"))
    kinds = dict(bins.dtypes)
    schema = f"sample_id {kinds['sample_id']}, chrom string, bin_index {kinds['bin_index']}, expected double, level double, correction_applied int"

    def surface(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["chrom", "bin_index"])
        chosen = group["fit"].to_numpy()
        out = group[["sample_id", "chrom", "bin_index"]].copy()
        if chosen.sum() < max(min_valid, 1):
            out["expected"] = out["level"] = group["y"].median()
            return out.assign(correction_applied=0)
        raw = group[["gc", "mapped"]].to_numpy()
        z = (raw - np.median(raw[chosen], axis=0)) / np.maximum(raw[chosen].std(axis=0), 1e-6)
        z = np.nan_to_num(z, nan=0.0)
        y = group["y"].to_numpy()
        out["expected"] = loess_2d(z[chosen], y[chosen], group["w"].to_numpy()[chosen], z, frac, robust_iters)
        return out.assign(level=np.median(y[chosen]), correction_applied=1)

    found = rows.groupBy("sample_id").applyInPandas(surface, schema)
    done = F.col("correction_applied") == 1
    return bins.join(found, ["sample_id", "chrom", "bin_index"]).withColumns(
        {
            "correction_expected_signal": F.col("expected"),
            "correction_residual": F.when(done, value - F.col("expected")).otherwise(0.0),
            "signal_for_calling": F.when(done, value - F.col("expected") + F.col("level")).otherwise(value),
        }
    ).drop("expected", "level")


def correction_summary(corrected: DataFrame, labels: tuple[str, ...] = ("pass", "soft")) -> DataFrame:
    """Per sample the bins the fit could use, those eligible, bins by risk class, and the median before and after."""
    usable = F.col("chrom").rlike(AUTOSOME) & F.coalesce(F.col("mask_label"), F.lit("pass")).isin(*labels) & (F.col("correction_fit_eligible") == 1) & clean("gc_fraction").isNotNull()
    risk: list[Column] = [F.count_if(F.col("region_risk_class") == c).alias(f"n_{c}") for c in ("clean", "moderate", "high")]
    return corrected.groupBy("sample_id").agg(
        F.count_if(usable).alias("valid_bin_count"),
        F.sum("correction_fit_eligible").alias("fit_eligible_bin_count"),
        *risk,
        F.median("normalized_signal").alias("signal_median_before"),
        F.median("signal_for_calling").alias("signal_median_after"),
        F.when(F.max("correction_applied") == 1, "applied").otherwise("skipped").alias("correction_status"),
    )
