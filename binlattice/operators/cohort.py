"""Choosing reference samples and bin sizes from count matrices of a cohort.

A matrix is a long table (sample_id, chrom, bin_index, raw_count). A cohort has
far fewer samples than bins, so components come from the samples' Gram matrix:
each task adds up the products of its own bins, one tile of TILE x TILE samples
at a time. Up to GATHERED samples the tiles are gathered and solved at once;
beyond, they stay a stored table, and components come by orthogonal iteration on
it, with a number for each sample and component on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binlattice.functions.stats import over, robust_z
from binlattice.functions.storage import stored
from binlattice.operators.qc import AUTOSOME

#: Samples on a side of a tile of products.
TILE = 512
#: Samples whose products, 32 MB of them, are solved on the driver.
GATHERED = 2_000
#: Further vectors that orthogonal iteration carries beside those wanted.
BESIDE = 12
BIN = ["chrom", "bin_index"]


def select_cohort(summary: DataFrame, decisions: list[str]) -> DataFrame:
    """Distinct sample ids with one of the decisions, whatever their case."""
    wanted = [d.strip().upper() for d in decisions]
    return summary.where(F.upper(F.trim("qc_decision")).isin(*wanted)).select("sample_id").distinct()


def drop_unusable_samples(bins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bins of samples with any count, the sample ids without)."""
    total = bins.groupBy("sample_id").agg(F.coalesce(F.sum("raw_count"), F.lit(0)).alias("total"))
    return bins.join(total.where("total > 0").select("sample_id"), "sample_id", "left_semi"), total.where("total <= 0").select("sample_id")


def align_matrix(bins: DataFrame, min_features: int = 100) -> DataFrame:
    """Autosomal bins of all samples, each chromosome cut to its shortest vector; a sample without the chromosome has zeros there.

    A mixture of bin sizes or fewer than min_features bins is an error.
    """
    rows = bins.where(F.col("chrom").rlike(AUTOSOME))
    shortest = rows.groupBy("sample_id", "chrom").agg(F.max("bin_index").alias("last")).groupBy("chrom").agg(F.min("last").alias("last"))
    places = shortest.select("chrom", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last").cast("bigint"))).alias("bin_index"))
    found = places.agg(F.count("*").alias("n"))
    if "bin_size" in bins.columns:
        found = found.crossJoin(bins.agg(F.count_distinct("bin_size").alias("sizes")))  # one row each
    checked = found.first()
    if checked["n"] < min_features:
        raise ValueError(f"{checked['n']} bins shared by all samples, {min_features} needed")
    if "bin_size" in bins.columns and checked["sizes"] > 1:
        raise ValueError("samples of different bin sizes")
    dense = rows.select("sample_id").distinct().crossJoin(places)  # samples x bins is the matrix itself
    have = rows.select("sample_id", "chrom", F.col("bin_index").cast("bigint").alias("bin_index"), "raw_count")
    return dense.join(have, ["sample_id", *BIN], "left").withColumn("raw_count", F.greatest(F.coalesce("raw_count", F.lit(0)).cast("double"), F.lit(0.0)))


def with_signal(matrix: DataFrame) -> DataFrame:
    """The matrix with x = ln(1 + counts per million) of each sample."""
    total = F.sum("raw_count").over(over(["sample_id"]))
    return matrix.withColumn("x", F.log1p(F.col("raw_count") / F.when(total <= 0, 1.0).otherwise(total) * 1e6))


@dataclass
class Products:
    """Products of the samples' standardised bins: an array, or a stored table of tile rows (i, c, v), v holding columns c to c + TILE."""

    n: int
    bins: int
    diagonal: np.ndarray
    array: np.ndarray | None = None
    tiles: DataFrame | None = None

    def times(self, q: np.ndarray) -> np.ndarray:
        if self.array is not None:
            return self.array @ q

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame({"i": batch["i"], "y": [np.asarray(v) @ q[c : c + len(v)] for c, v in zip(batch["c"], batch["v"], strict=True)]})

        y = self.tiles.select("i", "c", "v").mapInPandas(part, "i bigint, y array<double>").groupBy("i")
        out = np.zeros(q.shape)
        for r in y.agg(F.array(*[F.sum(F.get("y", F.lit(j))) for j in range(q.shape[1])]).alias("y")).toLocalIterator():
            out[r["i"]] = r["y"]
        return out

    def top(self, k: int, fit: np.ndarray | None = None, tolerance: float = 1e-9, turns: int = 1_000) -> tuple[np.ndarray, np.ndarray]:
        """(the k greatest eigenvalues, their vectors) of the products of the samples ``fit``; vectors are 0 elsewhere."""
        inside = np.ones(self.n, bool) if fit is None else fit
        if self.array is not None:
            values, found = np.linalg.eigh(self.array[np.ix_(inside, inside)])
            vectors = np.zeros((self.n, min(k, len(values))))
            vectors[inside] = found[:, ::-1][:, :k]
            return np.maximum(values[::-1][:k], 0), vectors
        width = min(k + BESIDE, int(inside.sum()))
        q = np.linalg.qr(np.where(inside[:, None], np.random.default_rng(0).normal(size=(self.n, width)), 0))[0]
        for _ in range(turns):
            y = np.where(inside[:, None], self.times(q), 0)
            values, turn = np.linalg.eigh((q.T @ y + y.T @ q) / 2)
            values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
            if np.linalg.norm(y @ turn - q @ turn * values, axis=0).max() <= tolerance * max(values[0], 1e-300):
                return np.maximum(values, 0), q @ turn
            q = np.linalg.qr(y)[0]
        raise ArithmeticError(f"components did not settle in {turns} turns")


def _products(signal: DataFrame, ids: list[str], trains: list[set[str] | None]) -> list[Products]:
    """The products for each set of samples that bins are standardised over, None for all, from one scan of the signal.

    A task deals its bins to pairs of tiles, sorts them by pair (Spark spills them) and adds up one pair at a time.
    """
    n = len(ids)
    if not n:
        return [Products(0, 0, np.zeros(0), array=np.zeros((0, 0))) for _ in trains]
    fits = [np.array([train is None or i in train for i in ids]) for train in trains]
    pair = F.struct("sample_id", "x")
    per = signal.where(F.col("sample_id").isin(*ids)).groupBy(*BIN).agg(F.transform(F.sort_array(F.collect_list(pair)), lambda p: p["x"]).alias("x"))
    starts = range(0, n, TILE)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for batch in (whole[i : i + 256] for i in range(0, len(whole), 256)):
                m = np.stack(batch["x"].to_list())
                for turn, fit in enumerate(fits):
                    sd = m[:, fit].std(axis=1, keepdims=True)
                    z = (m - m[:, fit].mean(axis=1, keepdims=True)) / np.where(sd > 1e-12, sd, 1.0)
                    for a in starts:
                        for c in starts:
                            if a <= c:
                                yield pd.DataFrame({"turn": turn, "a": a, "c": c, "left": list(z[:, a : a + TILE]), "right": list(z[:, c : c + TILE])})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, total, bins = None, None, 0

        def tile() -> Iterator[pd.DataFrame]:
            if key is not None:
                turn, a, c = key
                yield pd.DataFrame({"turn": turn, "i": np.arange(a, a + len(total)), "c": c, "v": list(total), "bins": bins})
                if a < c:
                    yield pd.DataFrame({"turn": turn, "i": np.arange(c, c + total.shape[1]), "c": a, "v": list(total.T), "bins": bins})

        for batch in batches:
            for here, rows in batch.groupby(["turn", "a", "c"], sort=True):
                part = np.stack(rows["left"].to_list()).T @ np.stack(rows["right"].to_list())
                if here == key:
                    total, bins = total + part, bins + len(rows)
                else:
                    yield from tile()
                    key, total, bins = here, part, len(rows)
        yield from tile()

    dealt = per.select("x").mapInPandas(deal, "turn int, a bigint, c bigint, left array<double>, right array<double>").sortWithinPartitions("turn", "a", "c")
    parts = dealt.mapInPandas(add, "turn int, i bigint, c bigint, v array<double>, bins bigint").groupBy("turn", "i", "c")
    tiles = parts.agg(F.array(*[F.sum(F.get("v", F.lit(j))) for j in range(min(TILE, n))]).alias("v"), F.sum("bins").alias("bins"))
    tiles = tiles.withColumn("v", F.slice("v", F.lit(1), F.least(F.lit(TILE).cast("bigint"), F.lit(n) - F.col("c")).cast("int")))
    if n > GATHERED:
        tiles = stored(tiles)
        own = tiles.where("i >= c AND i < c + size(v)").select("turn", "i", "bins", F.get("v", (F.col("i") - F.col("c")).cast("int")).alias("d"))
        out = [Products(n, 0, np.zeros(n), tiles=tiles.where(F.col("turn") == turn)) for turn in range(len(trains))]
        for r in own.toLocalIterator():
            out[r["turn"]].diagonal[r["i"]], out[r["turn"]].bins = r["d"], r["bins"]
        return out
    arrays, bins = np.zeros((len(trains), n, n)), 0
    for r in tiles.toLocalIterator():
        arrays[r["turn"], r["i"], r["c"] : r["c"] + len(r["v"])] = r["v"]
        bins = r["bins"]
    return [Products(n, bins, np.diag(x).copy(), array=x) for x in arrays]


def _ids(signal: DataFrame) -> list[str]:
    return sorted(r[0] for r in signal.select("sample_id").distinct().collect())  # one value a sample


def _explained(products: Products, limit: int) -> tuple[np.ndarray, np.ndarray]:
    total = products.diagonal.sum()
    if total <= 0:
        raise ValueError("the samples do not vary")
    share = products.top(min(limit, products.n))[0] / total
    return share, np.cumsum(share)


def pca_profile(signal: DataFrame, max_components: int) -> DataFrame:
    """(component from 1, explained, cumulative) of the standardised bins."""
    share, cumulative = _explained(_products(signal, _ids(signal), [None])[0], max_components)
    rows = [(i + 1, float(e), float(c)) for i, (e, c) in enumerate(zip(share, cumulative))]
    return signal.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double")


def elbow_component(profile: DataFrame) -> DataFrame:
    """One row: the component farthest from the chord of the cumulative curve, the smallest of equals; the last one up to 2."""
    ends = profile.agg(F.min("component").alias("x1"), F.max("component").alias("x2"), F.min_by("cumulative", "component").alias("y1"), F.max_by("cumulative", "component").alias("y2"))
    x, y = F.col("component"), F.col("cumulative")
    dy, dx = F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")
    far = F.abs(dy * x - dx * y + F.col("x2") * F.col("y1") - F.col("y2") * F.col("x1")) / F.hypot(dy, dx)
    rows = profile.crossJoin(ends)  # one row
    return rows.agg(F.when(F.max("x2") <= 2, F.max("x2")).otherwise(F.max_by("component", F.struct(F.round(far, 12), -x))).alias("elbow"))


def choose_components(profile: DataFrame, min_components: int, min_explained: float = 0.0) -> DataFrame:
    """One row (elbow, selected): the larger of elbow, minimum and the first component that reaches min_explained, within the profile."""
    reach = F.min(F.when((F.col("cumulative") >= min_explained) & F.lit(min_explained > 0), F.col("component")))
    found = profile.agg(reach.alias("reach"), F.max("component").alias("last")).crossJoin(elbow_component(profile))  # one row each
    return found.select("elbow", F.least("last", F.greatest("elbow", F.lit(min_components), "reach")).alias("selected"))


def profile_distance(signal: DataFrame) -> DataFrame:
    """Per sample reads, correlation with the median profile (0 where one is flat) and MAD of the residual around its median."""
    mid = signal.withColumn("m", F.median("x").over(over(BIN))).withColumn("r", F.col("x") - F.col("m"))
    mid = mid.withColumn("rm", F.median("r").over(over(["sample_id"])))
    corr = F.when((F.stddev_pop("x") > 1e-12) & (F.stddev_pop("m") > 1e-12), F.corr("x", "m")).otherwise(0.0)
    return mid.groupBy("sample_id").agg(F.sum("raw_count").alias("reads"), corr.alias("corr_to_median"), F.median(F.abs(F.col("r") - F.col("rm"))).alias("noise_mad"))


def _with_errors(signal: DataFrame, distance: DataFrame, ids: list[str], errors: np.ndarray) -> DataFrame:
    table = signal.sparkSession.createDataFrame([(i, float(e)) for i, e in zip(ids, errors)], "sample_id string, reconstruction_error double")
    out = distance.join(table, "sample_id").withColumn("__all", F.lit(0))  # one value a sample
    for c in ("reconstruction_error", "noise_mad"):
        out = robust_z(out, c, ["__all"], out=f"{c}_z", strict=True)
    return out.drop("__all")


def _errors(products: Products, k: int) -> np.ndarray:
    values, vectors = products.top(k)
    return np.maximum(products.diagonal - (vectors**2) @ values, 0) / products.bins


def cohort_sample_metrics(signal: DataFrame, k: int) -> DataFrame:
    """Reads, correlation, noise and mean squared error of k components per sample, the last two also as strict robust z."""
    ids = _ids(signal)
    return _with_errors(signal, profile_distance(signal), ids, _errors(_products(signal, ids, [None])[0], k))


def label_outliers(metrics: DataFrame, min_reads: float = 3e6, min_corr: float = 0.9, max_recon_z: float = 3.5, max_noise_z: float = 3.5) -> DataFrame:
    """is_outlier and the reasons joined by commas, PASS without any."""
    tests = [("low_reads", F.col("reads") < min_reads), ("low_corr", F.col("corr_to_median") < min_corr), ("high_recon_z", F.col("reconstruction_error_z") > max_recon_z), ("high_noise_z", F.col("noise_mad_z") > max_noise_z)]
    reasons = F.concat_ws(",", *[F.when(test, F.lit(name)) for name, test in tests])
    return metrics.withColumn("is_outlier", (reasons != "").cast("int")).withColumn("reasons", F.when(reasons == "", "PASS").otherwise(reasons))


def iterative_prefilter(signal: DataFrame, max_iterations: int = 3, min_samples: int = 8, min_components: int = 2, max_components: int = 20, **limits: float) -> DataFrame:
    """Metrics of the last round for every sample, with is_outlier, reasons and removed_iteration.

    A round measures the samples that are left and removes its outliers, unless fewer than min_samples would stay: that
    round removes nobody and is the last. Samples removed before the last round carry their reads and zeros.
    """
    spark, ids = signal.sparkSession, _ids(signal)
    left, removed, last = list(ids), {}, []
    for turn in range(1, max_iterations + 1):
        here = signal.where(F.col("sample_id").isin(*left))
        top = min(max_components, len(left) - 1)
        if top < 1:
            break
        products = _products(here, left, [None])[0]
        _, cumulative = _explained(products, top)
        profile = spark.createDataFrame([(i + 1, 0.0, float(c)) for i, c in enumerate(cumulative)], "component int, explained double, cumulative double")
        k = choose_components(profile, min(min_components, top)).first()["selected"]
        last = label_outliers(_with_errors(here, profile_distance(here), left, _errors(products, k)), **limits).collect()  # one row a sample
        out = {r["sample_id"]: r["reasons"] for r in last if r["is_outlier"]}
        if not out or len(left) - len(out) < min_samples:
            break
        removed |= {i: (turn, why) for i, why in out.items()}
        left = [i for i in left if i not in out]
    if len(left) < min_samples:
        raise ValueError(f"{len(left)} samples left, {min_samples} needed")
    names = ["corr_to_median", "noise_mad", "noise_mad_z", "reconstruction_error", "reconstruction_error_z"]
    measured = {r["sample_id"]: [float(r[c]) for c in names] for r in last}
    rows = [(i, *measured.get(i, [0.0] * 5), int(i in removed), removed.get(i, (0, "PASS"))[1], removed.get(i, (0, ""))[0]) for i in ids]
    schema = "sample_id string, " + ", ".join(f"{c} double" for c in names) + ", is_outlier int, reasons string, removed_iteration int"
    return signal.groupBy("sample_id").agg(F.sum("raw_count").alias("reads")).join(spark.createDataFrame(rows, schema), "sample_id")


def merge_inliers(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.select("sample_id").union(second.select("sample_id")).distinct()


def folds(ids: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """Folds of near equal size by the rank of the MD5 of seed and sample id, which any engine can take."""
    ranked = ids.withColumn("__all", F.lit(0))  # one value a sample
    place = F.row_number().over(Window.partitionBy("__all").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "sample_id")), "sample_id"))
    return ranked.withColumn("fold", (place - 1) % k).drop("__all")


def cv_reconstruction_mse(signal: DataFrame, components: list[int], n_folds: int = 5, seed: int = 0) -> dict[int, float | None]:
    """Mean over folds of the held-out samples' mean squared error with k components of the others, for each k.

    Bins are standardised on the fold's training samples; the products of all folds come from one scan. None under 3 samples or where a fold trains on k samples or fewer.
    """
    ids = _ids(signal)
    if len(ids) < 3:
        return {k: None for k in components}
    of = {r["sample_id"]: r["fold"] for r in folds(signal.select("sample_id").distinct(), min(n_folds, len(ids)), seed).collect()}
    trains = [t for t in ({i for i in ids if of[i] != fold} for fold in sorted(set(of.values()))) if len(t) > 1]
    errors: dict[int, list[float]] = {k: [] for k in components}
    for train, products in zip(trains, _products(signal, ids, trains), strict=True):
        fit = np.array([i in train for i in ids])
        most = min(len(train) - 1, products.bins)
        values, vectors = products.top(min(max(components), most), fit)
        scores = products.times(vectors)[~fit]
        for k in components:
            if k > most:
                errors[k].append(float("nan"))
                continue
            real = values[:k] > 1e-9 * values[0]
            score = scores[:, :k][:, real] / np.sqrt(values[:k][real])
            errors[k].append(float(np.mean(products.diagonal[~fit] - (score**2).sum(1)) / products.bins))
    return {k: None if not e or np.isnan(e).any() else float(np.mean(e)) for k, e in errors.items()}


GRID = (
    "bin_size bigint, pca_components int, selected_pca int, elbow_pca int, component_var double, component_cum_var double, is_selected_pca int, "
    "cv_mse double, inliers int, outliers int, outlier_fraction double, samples int, features bigint, status string"
)


def tuning_grid(signals: dict[int, DataFrame], min_components: int = 2, max_components: int = 20, min_explained: float = 0.0, min_samples: int = 8, max_outlier_fraction: float = 0.25, n_folds: int = 5, **limits: float) -> DataFrame:
    """A row per bin size and number of components, measured on all usable samples: outliers, cross-validated error and a status.

    ``signals`` maps a bin size to its matrix with signal. Statuses are those of the checks in order; PASS has an error.
    """
    spark, rows = next(iter(signals.values())).sparkSession, []
    for size, signal in sorted(signals.items()):
        ids = _ids(signal)
        n = len(ids)
        empty = lambda status: rows.append((size, 0, 0, 0, 0.0, 0.0, 0, None, 0, n, 1.0 if n else 0.0, n, 0, status))  # noqa: B023, E731
        if n < 3:
            empty("FAIL_USABLE_SAMPLE_COUNT")
            continue
        products = _products(signal, ids, [None])[0]
        bins = products.bins
        top = min(max_components, n - 1, bins)
        if top < 1:
            empty("INVALID_PCA_COMPONENTS")
            continue
        share, cumulative = _explained(products, top)
        low = min(max(1, min_components), top)
        profile = spark.createDataFrame([(i + 1, float(e), float(c)) for i, (e, c) in enumerate(zip(share, cumulative))], "component int, explained double, cumulative double")
        chosen = choose_components(profile, min(min_components, top), min_explained).first()
        distance = spark.createDataFrame(profile_distance(signal).collect(), "sample_id string, reads double, corr_to_median double, noise_mad double")  # one row a sample
        found, by_inliers = {}, {}
        for k in range(low, top + 1):
            labelled = label_outliers(_with_errors(signal, distance, ids, _errors(products, k)), **limits).where("is_outlier = 0").select("sample_id").collect()
            found[k] = tuple(sorted(r[0] for r in labelled))
            if len(found[k]) >= min_samples and (n - len(found[k])) / n <= max_outlier_fraction and k <= min(len(found[k]) - 1, bins):
                by_inliers.setdefault(found[k], []).append(k)
        mse = {}
        for inliers, ks in by_inliers.items():  # components with the same inliers share their folds
            mse |= cv_reconstruction_mse(signal.where(F.col("sample_id").isin(*inliers)), ks, n_folds)
        for k, inliers in found.items():
            out = (n - len(inliers)) / n
            if len(inliers) < min_samples:
                status = "FAIL_INLIER_COUNT"
            elif out > max_outlier_fraction:
                status = "FAIL_OUTLIER_FRACTION"
            elif k not in mse:
                status = "FAIL_EFFECTIVE_PCA"
            else:
                status = "FAIL_CV" if mse[k] is None else "PASS"
            rows.append((size, k, chosen["selected"], chosen["elbow"], float(share[k - 1]), float(cumulative[k - 1]), int(k == chosen["selected"]), mse.get(k), len(inliers), n - len(inliers), out, n, bins, status))
    return spark.createDataFrame(rows, GRID)


def rank_bin_sizes(grid: DataFrame) -> DataFrame:
    """The best row of each bin size, and the rank of the sizes that pass: most inliers, least outliers, least error, smallest size."""
    good = (F.col("status") == "PASS") & F.col("cv_mse").isNotNull()
    ranked = lambda c: F.when(good, c)
    best = Window.partitionBy("bin_size").orderBy(
        good.desc(), F.desc("is_selected_pca"), ranked(-F.col("inliers")), ranked(F.col("outlier_fraction")), ranked(F.col("cv_mse")), F.when(~good, F.col("status")), "pca_components"
    )
    rows = grid.withColumn("__r", F.row_number().over(best)).where("__r = 1").drop("__r").withColumn("passes", good.cast("int"))
    sizes = Window.partitionBy("passes").orderBy(F.desc("inliers"), "outlier_fraction", "cv_mse", "bin_size")
    return rows.withColumn("selection_rank", F.when(F.col("passes") == 1, F.row_number().over(sizes)).otherwise(0)).withColumn("is_best_binsize", (F.col("selection_rank") == 1).cast("int")).drop("passes")


def canonical_text(table: DataFrame) -> Column:
    """A row as text that any engine can write: ``column=value`` by name of the column, joined by a line feed; nulls are left out.

    Numbers with fractions have six decimals, times are to the second, in UTC.
    """

    def text(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("double", "float") or kind.startswith("decimal"):
            c = F.format_string("%.6f", c.cast("double"))
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        return F.concat(F.lit(f"{name}="), c.cast("string"))

    return F.concat_ws("\n", *[F.when(F.col(f"`{n}`").isNotNull(), text(n, k)) for n, k in sorted(table.dtypes)])


def table_digest(table: DataFrame) -> Column:
    """A digest of the rows as a multiset: the sums of the first and second 15 hexadecimal digits of the MD5 of each row's canonical text."""
    md5 = F.md5(canonical_text(table))
    lane = lambda at: F.coalesce(F.sum(F.conv(F.substring(md5, at, 15), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").cast("string")
    return F.concat_ws("-", lane(1), lane(16))


def snapshot_inventory(tables: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Group, name, rows and digest of each table, with the tables of the group; rows alike count each."""
    parts = [t.agg(F.lit(group).alias("group"), F.lit(name).alias("name"), F.count("*").alias("n_rows"), table_digest(t).alias("digest"), F.lit(len(named)).alias("n_tables")) for group, named in tables.items() for name, t in named.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
