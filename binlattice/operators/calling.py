"""Event calling on scored bins: weights, chromosome-aware z, segmentation, merging, dosage and rescue events."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binlattice.functions.stats import clean, robust_z
from binlattice.functions.storage import stored
from binlattice.operators.grid import runs, seed_blocks

CHROM = ["sample_id", "chrom"]


def calling_weight(bins: DataFrame) -> DataFrame:
    """bin_weight * region_risk_weight, 0.1 at least."""
    return bins.withColumn("calling_weight", F.greatest(F.col("bin_weight") * F.col("region_risk_weight"), F.lit(0.1)))


def _middle(ordered: Column) -> Column:
    n = F.size(ordered)
    return (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2


def _center_scale(df: DataFrame, values: str, center: str, scale: str) -> DataFrame:
    """Median and max(1.4826 * MAD, population deviation, 1e-6) of a sorted array; (0, 1) if it is empty."""
    x = F.col(values)
    df = df.withColumn("__c", _middle(x)).withColumn("__avg", F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / F.greatest(F.size(x), F.lit(1)))
    df = df.withColumn("__d", F.sort_array(F.transform(x, lambda v: F.abs(v - F.col("__c")))))
    square = F.aggregate(x, F.lit(0.0), lambda s, v: s + (v - F.col("__avg")) * (v - F.col("__avg")))
    spread = F.greatest(1.4826 * _middle(F.col("__d")), F.sqrt(square / F.greatest(F.size(x), F.lit(1))), F.lit(1e-6))
    some = F.size(x) > 0
    return df.withColumn(center, F.when(some, F.col("__c")).otherwise(0.0)).withColumn(scale, F.when(some, spread).otherwise(1.0)).drop("__c", "__avg", "__d")


def _left_out(x: np.ndarray, chrom: np.ndarray, tier: np.ndarray) -> list[tuple[str | None, float, float]]:
    """(chromosome, centre, scale) of the values of all others, and of all values for None; of the first tier that holds any, or (0, 1) without values."""
    out = []
    for own in (None, *np.unique(chrom)):
        others = chrom != own if own is not None else np.ones(len(x), dtype=bool)
        if not others.any():
            others = ~others
        if not len(x):
            out.append((own, 0.0, 1.0))
            continue
        # tiers: seeds on autosomes, other autosomal bins, other seeds, the rest
        held = x[others & (tier == tier[others].min())]
        center = float(np.median(held))
        out.append((own, center, max(1.4826 * float(np.median(np.abs(held - center))), float(held.std()), 1e-6)))
    return out


def _all_left_out(values: pd.Series, chroms: pd.Series, tiers: pd.Series) -> pd.Series:
    found = [_left_out(np.asarray(x, dtype=float), np.asarray(c, dtype=object), np.asarray(t, dtype=int)) for x, c, t in zip(values, chroms, tiers)]
    return pd.Series([[dict(zip(("chrom", "center", "scale"), f)) for f in per] for per in found])


def score_bins(bins: DataFrame, signal: str = "normalized_signal") -> DataFrame:
    """Bins with the z against other chromosomes, within the own one, the chromosome's shift, and their sum over variance_inflation.

    A sample's signal is gathered once, one value a bin of the genome; a task takes the median and spread of what each chromosome leaves of it.
    calling_weight of bins that are no seeds is halved after the chromosome means are taken.
    """
    seed, auto = F.coalesce(F.col("calling_seed_eligible") == 1, F.lit(True)), F.coalesce(F.col("is_autosome") == 1, F.lit(False))
    x, w = clean(signal), F.col("calling_weight")
    ok = x.isNotNull() & (clean("calling_weight") > 0)
    tier = F.when(auto & seed, 1).when(auto, 2).when(seed, 3).otherwise(4)
    pool = bins.groupBy("sample_id").agg(F.collect_list(F.when(x.isNotNull(), F.struct(x.alias("v"), F.col("chrom").alias("chrom"), tier.alias("tier")))).alias("pool"))
    backgrounds = F.pandas_udf(_all_left_out, "array<struct<chrom:string,center:double,scale:double>>")("pool.v", "pool.chrom", "pool.tier")
    mean = (F.sum(F.when(ok, x * w)) / F.sum(F.when(ok, w))).alias("mean")
    chroms = bins.groupBy(*CHROM).agg(mean, F.bool_or(auto).alias("auto")).groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("mean", "chrom", "auto"))).alias("chroms"))
    whole = pool.select("sample_id", backgrounds.alias("all")).join(chroms, "sample_id")
    of = lambda name: F.get(F.filter("all", lambda b: b["chrom"].eqNullSafe(name)), F.lit(0))
    per = whole.withColumn("own", F.explode("chroms")).withColumn("one", F.coalesce(of(F.col("own.chrom")), of(F.lit(None)))).withColumn("every", of(F.lit(None)))
    per = per.select("sample_id", "chroms", "own", F.col("one.center").alias("g_center"), F.col("one.scale").alias("g_scale"), F.col("every.center").alias("background_center"), F.col("every.scale").alias("background_scale"))
    rest = F.filter("chroms", lambda c: (c["chrom"] != F.col("own.chrom")) & c["mean"].isNotNull())
    per = per.withColumn("rest", rest).withColumn("peers", F.filter("rest", lambda c: c["auto"] | ~F.col("own.auto")))
    per = per.withColumn("means", F.transform(F.when(F.size("peers") > 0, F.col("peers")).otherwise(F.col("rest")), lambda c: c["mean"]))
    per = _center_scale(per, "means", "s_center", "s_scale")
    shift = (F.col("own.mean") - F.col("s_center")) / F.greatest("s_scale", "background_scale", F.lit(1e-6))
    per = per.select("sample_id", F.col("own.chrom").alias("chrom"), "g_center", "g_scale", "background_center", "background_scale", F.coalesce(shift, F.lit(0.0)).alias("chrom_shift_z"))
    local = robust_z(bins, signal, CHROM, out="raw_local_robust_z").join(per, CHROM)
    raw = F.col("raw_local_robust_z") + F.col("chrom_shift_z")
    return (
        local.withColumn("global_robust_z", (x - F.col("g_center")) / F.col("g_scale"))
        .withColumn("raw_robust_z", raw)
        .withColumn("robust_z", raw / F.col("variance_inflation"))
        .withColumn("calling_weight", F.when(seed, w).otherwise(w * 0.5))
        .drop("g_center", "g_scale")
    )


BLOCK = [*CHROM, "block_index"]


def _block_rows(bins: DataFrame, min_len: int) -> DataFrame:
    """The bins of all seed blocks with their place i in the block, the bin before, and the sums of weights and weighted z before and up to them."""
    blocks = seed_blocks(bins, F.col("calling_seed_eligible") == 1, min_len)
    spread = blocks.select(*CHROM, (F.col("block_index") + 1).alias("block_index"), F.explode(F.sequence("left_bin", F.col("right_bin") - 1)).alias("bin_index"))
    z, w = F.coalesce(clean("robust_z"), F.lit(0.0)), F.greatest("calling_weight", F.lit(1e-6))
    rows = spread.join(bins.select(*CHROM, "bin_index", z.alias("z"), w.alias("w")), [*CHROM, "bin_index"])
    order = Window.partitionBy(*BLOCK).orderBy("bin_index")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("i", F.row_number().over(order) - 1).withColumn("bin_before", F.lag("bin_index").over(order)).withColumn("w1", F.sum("w").over(upto)).withColumn("z1", F.sum(F.col("w") * F.col("z")).over(upto))
    before = lambda c: F.coalesce(F.lag(c).over(order), F.lit(0.0))
    return rows.withColumn("w0", before("w1")).withColumn("z0", before("z1")).select(*BLOCK, "i", "bin_index", "bin_before", "w0", "w1", "z0", "z1")


def segment_series(bins: DataFrame, min_bins: int = 5, min_event_bins: int = 3, threshold: float = 2.5, max_segments: int = 12) -> DataFrame:
    """(sample_id, chrom, block_index from 1, segment_index from 1, left_bin, right_bin): binary splits of each block of seed bins.

    The open segments of all blocks of all samples are split level by level, each where the weighted means of its sides differ most, weighed by
    sqrt(w1 * w2 / (w1 + w2)), if that is ``threshold`` at least; of equal places the first. With running sums in the rows a level is one join of the rows
    with the open segments and one aggregation, and writes one table of the new segments. A block has ``max_segments`` at most: first come the
    segments of the level before, from the left. There are never more levels than ``max_segments`` - 1.
    """
    rows = stored(_block_rows(bins, max(min_bins, min_event_bins)))
    first = rows.groupBy(*BLOCK).agg(
        F.lit(0).alias("a"), F.count("*").cast("int").alias("b"), F.lit(0.0).alias("wa"), F.max_by("w1", "i").alias("wb"), F.lit(0.0).alias("za"), F.max_by("z1", "i").alias("zb"),
        F.min("bin_index").alias("left_bin"), (F.max("bin_index") + 1).alias("right_bin"), F.lit(1).cast("bigint").alias("n"),
    )
    levels = [stored(first)]
    for _ in range(max_segments - 1):
        open_ = levels[-1].where((F.col("b") - F.col("a") >= 2 * min_bins) & (F.col("n") < max_segments))
        inside = rows.join(open_, BLOCK).where((F.col("i") >= F.col("a") + min_bins) & (F.col("i") <= F.col("b") - min_bins))
        left, right = F.col("w0") - F.col("wa"), F.col("wb") - F.col("w0")
        score = F.abs((F.col("z0") - F.col("za")) / left - (F.col("zb") - F.col("z0")) / right) * F.sqrt(left * right / (left + right))
        split = F.struct("i", "w0", "z0", "bin_index", (F.col("bin_before") + 1).alias("end_bin"))
        best = inside.withColumn("score", score).groupBy(*open_.columns).agg(F.max("score").alias("score"), F.max_by(split, F.struct("score", -F.col("i"))).alias("at")).where((F.col("score") >= threshold) & (F.col("score") > 0))
        block = Window.partitionBy(*BLOCK)
        taken = best.withColumn("nth", F.row_number().over(block.orderBy("a"))).where(F.col("n") + F.col("nth") <= max_segments)
        taken = taken.withColumn("n", F.col("n") + F.count("*").over(block))
        side = lambda **ends: F.struct(*[ends.get(c, F.col(c)).alias(c) for c in ("a", "b", "wa", "wb", "za", "zb", "left_bin", "right_bin")])
        lower = side(b=F.col("at.i"), wb=F.col("at.w0"), zb=F.col("at.z0"), right_bin=F.col("at.end_bin"))
        upper = side(a=F.col("at.i"), wa=F.col("at.w0"), za=F.col("at.z0"), left_bin=F.col("at.bin_index"))
        levels.append(stored(taken.select(*BLOCK, "n", F.inline(F.array(lower, upper))).select(*open_.columns)))
        if levels[-1].isEmpty():
            break
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    # of the segments that begin at a place the shortest was not split
    leaves = every.groupBy(*BLOCK, "left_bin").agg(F.min("right_bin").alias("right_bin"))
    return leaves.select(*BLOCK, F.row_number().over(Window.partitionBy(*BLOCK).orderBy("left_bin")).alias("segment_index"), "left_bin", "right_bin")


def in_segments(segments: DataFrame, bins: DataFrame) -> DataFrame:
    """Bins with the block and segment that hold them."""
    spread = segments.select(*CHROM, "block_index", "segment_index", F.explode(F.sequence("left_bin", F.col("right_bin") - 1)).alias("bin_index"))
    return spread.join(bins, [*CHROM, "bin_index"])


def event_stats(z: str = "robust_z", floor: float = 1e-6) -> list[Column]:
    """Place and signal statistics of the bins of an event; weights are ``floor`` at least."""
    w = F.greatest("calling_weight", F.lit(floor))
    x = clean("normalized_signal")
    return [
        F.min("bin_index").alias("start_bin"), F.max("bin_index").alias("end_bin"), F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.count("*").alias("n_bins"),
        F.sum(w).alias("segment_weight"), (F.sum(x * w) / F.sum(F.when(x.isNotNull(), w))).alias("segment_mean_signal"), F.median(x).alias("segment_median_signal"),
        (F.sum(F.col(z) * w) / F.sum(w)).alias("segment_mean_robust_z"), F.median(z).alias("segment_median_robust_z"), F.max(F.abs(z)).alias("segment_abs_max_robust_z"),
    ]


def reconcile_state(mean_z: Column, median_z: Column, least: float = 1.5) -> Column:
    """The sign of the larger of mean and median, neutral under ``least``. A hidden state that disagrees always yields to it, so none is needed."""
    main = F.when(F.abs(mean_z) >= F.abs(median_z), mean_z).otherwise(median_z)
    return F.when(F.coalesce(F.abs(main) < least, F.lit(True)), "neutral").when(main > 0, "gain").otherwise("loss")


def segment_states(segments: DataFrame, bins: DataFrame, least: float = 1.5) -> DataFrame:
    """Segments with weighted mean and median z and the state these say."""
    w = F.greatest("calling_weight", F.lit(1e-6))
    keys = [*CHROM, "block_index", "segment_index"]
    per = in_segments(segments, bins).groupBy(*keys).agg((F.sum(F.col("robust_z") * w) / F.sum(w)).alias("mean_z"), F.median("robust_z").alias("median_z"), F.count("*").alias("n_bins"))
    return segments.join(per, keys).withColumn("state", reconcile_state(F.col("mean_z"), F.col("median_z"), least))


def with_hmm_state(bins: DataFrame, states: DataFrame) -> DataFrame:
    """Bins with the state of the segment that holds them as ``hmm_state``; bins of no segment are neutral."""
    spread = states.select(*CHROM, F.col("state").alias("hmm_state"), F.explode(F.sequence("left_bin", F.col("right_bin") - 1)).alias("bin_index"))
    return bins.drop("hmm_state").join(spread, [*CHROM, "bin_index"], "left").fillna("neutral", ["hmm_state"])


def _best_path(z: np.ndarray, centers: np.ndarray, keep: float, move: float) -> list[int]:
    """Forward with a back pointer for each state, then back from the best end; of equal ways the one from the earlier state."""
    sigma = max(float(z.std()), 1.0)
    moves = np.where(np.eye(3, dtype=bool), keep, move)
    score, back = np.zeros(3), np.zeros((len(z), 3), dtype=np.int8)
    for i, x in enumerate(z):
        if i:
            came = score[:, None] + moves
            back[i] = came.argmax(axis=0)
            score = came.max(axis=0)
        score = score - (x - centers) ** 2 / (2 * sigma * sigma)
    path = [int(score.argmax())]
    for i in range(len(z) - 1, 0, -1):
        path.append(int(back[i, path[-1]]))
    return path[::-1]


def viterbi_states(segments: DataFrame, shift: float = 2.5, stay: float = 0.995) -> DataFrame:
    """(sample_id, chrom, path): most likely loss, neutral or gain of a chromosome's segments in order; ties go to the earlier state. A diagnostic only.

    Time and memory are linear in the segments of a chromosome, which max_segments of each block bounds.
    """
    names, centers = ["loss", "neutral", "gain"], np.array([-shift, 0.0, shift])
    keep, move = float(np.log(stay)), float(np.log((1 - stay) / 2))

    @F.pandas_udf("array<string>")
    def paths(series: pd.Series) -> pd.Series:
        return pd.Series([[names[i] for i in _best_path(np.asarray(z, dtype=float), centers, keep, move)] for z in series])

    ordered = F.sort_array(F.collect_list(F.struct(F.col("left_bin").alias("at"), F.col("mean_z").alias("z"))))
    return segments.groupBy(*CHROM).agg(ordered["z"].alias("z")).select(*CHROM, paths("z").alias("path"))


def merge_adjacent(calls: DataFrame) -> DataFrame:
    """Neighbouring calls of one block and state whose edges touch become one, numbered within the chromosome; means are weighted by width."""
    w = Window.partitionBy(*CHROM).orderBy("left_bin")
    new = ~F.coalesce((F.lag("right_bin").over(w) == F.col("left_bin")) & (F.lag("state").over(w) == F.col("state")) & (F.lag("block_index").over(w) == F.col("block_index")), F.lit(False))
    numbered = calls.withColumn("merged", F.sum(new.cast("int")).over(w)).withColumn("__n", F.col("right_bin") - F.col("left_bin"))
    mean = lambda c: (F.sum(F.col(c) * F.col("__n")) / F.sum("__n")).alias(c)
    return numbered.groupBy(*CHROM, "block_index", "state", "merged").agg(F.min("left_bin").alias("left_bin"), F.max("right_bin").alias("right_bin"), F.count("*").alias("n_segments"), mean("mean_z"), mean("median_z"))


def segment_events(bins: DataFrame, min_event_bins: int = 3, least: float = 1.5, states: DataFrame | None = None, **splits) -> DataFrame:
    """Segments with a state and enough bins, merged, as events with statistics over all their bins; ``states`` if segment_states() was run before."""
    if states is None:
        states = segment_states(segment_series(bins, min_event_bins=min_event_bins, **splits), bins, least)
    calls = merge_adjacent(states.where((F.col("state") != "neutral") & (F.col("n_bins") >= min_event_bins)))
    name = F.concat(F.col("chrom"), F.lit("_block"), F.col("block_index").cast("string"), F.lit("_merged"), F.col("merged").cast("string"))
    spread = calls.select(*CHROM, "state", name.alias("segment_id"), F.explode(F.sequence("left_bin", F.col("right_bin") - 1)).alias("bin_index"))
    per = spread.join(bins, [*CHROM, "bin_index"]).groupBy(*CHROM, "state", "segment_id").agg(*event_stats())
    return per.withColumn("event_id", F.concat_ws(".", "sample_id", "segment_id", "state")).withColumn("caller_stage", F.lit("segment_level"))


def run_calls(bins: DataFrame, threshold: float, min_bins: int) -> DataFrame:
    """Events of neighbouring bins with hmm_state gain or loss, a plain stand-in for segmentation."""
    rows = runs(bins, F.col("hmm_state").isin("gain", "loss"), F.col("hmm_state"))
    per = rows.groupBy(*CHROM, F.col("label").alias("state"), "run").agg(*event_stats()).where((F.col("n_bins") >= min_bins) & (F.col("segment_abs_max_robust_z") >= threshold)).drop("run")
    return per.withColumn("event_id", F.concat_ws(".", "sample_id", "chrom", F.col("start_bin").cast("string"), "state")).withColumn("caller_stage", F.lit("segment_level"))


def dosage_events(bins: DataFrame, least_shift: float = 2.5, least_effective: float = 10.0, least_clean: float = 0.3) -> DataFrame:
    """One event for each whole chromosome that is shifted, with enough effective and clean bins."""
    w = F.greatest("calling_weight", F.lit(1e-6))
    per = bins.groupBy(*CHROM).agg(*event_stats(), F.first("chrom_shift_z").alias("shift"), (F.sum(w) * F.sum(w) / F.sum(w * w)).alias("ess"), F.avg((F.col("region_risk_class") == "clean").cast("double")).alias("clean"))
    per = per.where((F.abs("shift") >= least_shift) & (F.col("ess") >= least_effective) & (F.col("clean") >= least_clean)).withColumn("state", F.when(F.col("shift") > 0, "gain").otherwise("loss"))
    name = F.concat_ws(".", "sample_id", "chrom", F.lit("chr_dosage"), "state")
    return per.withColumn("event_id", name).withColumn("segment_id", F.concat("chrom", F.lit("_chr_dosage"))).withColumn("caller_stage", F.lit("chromosome_dosage")).drop("shift", "ess", "clean")


def gap_rescue_events(bins: DataFrame, least_shift: float = 0.75, least_z: float = 1.8, least_median: float = 4.0, min_bins: int = 3) -> DataFrame:
    """Runs of hard-masked gap bins far out against the chromosome's shift; z here is local to the chromosome."""
    local = robust_z(bins, "normalized_signal", CHROM, out="local_z").where(F.abs("chrom_shift_z") >= least_shift)
    sign = F.when(F.col("chrom_shift_z") > 0, -1.0).otherwise(1.0)
    keep = (F.col("mask_label") == "hard") & (F.coalesce("gap_centromere_telomere_overlap_fraction", F.lit(0.0)) > 0) & (sign * F.col("local_z") >= least_z)
    state = F.when(F.col("chrom_shift_z") > 0, "loss").otherwise("gain")
    per = runs(local.withColumn("state", state), keep).groupBy(*CHROM, "state", "run").agg(*event_stats("local_z"), F.median(F.abs("local_z")).alias("mid")).where(F.col("n_bins") >= min_bins)
    per = per.withColumn("i", F.row_number().over(Window.partitionBy(*CHROM).orderBy("start_bin")).cast("string")).where(F.col("mid") >= least_median)
    name = F.concat(F.lit("masked_gap_rescue_"), F.col("i"))
    return (
        per.withColumn("event_id", F.concat_ws(".", "sample_id", "chrom", name, "state")).withColumn("segment_id", F.concat(F.col("chrom"), F.lit("_"), name)).withColumn("caller_stage", F.lit("masked_gap_rescue")).drop("run", "mid", "i")
    )


def interval_iou(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Overlap over union of two inclusive bin intervals."""
    both = F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0) + 1)
    return both / (a1 - a0 + b1 - b0 + 2 - both)


def fuse_events(dosage: DataFrame, others: DataFrame, threshold: float = 0.8) -> DataFrame:
    """All dosage events, and the others that none of them of the same state covers to ``threshold``.

    The other callers' events are disjoint and dosage has the highest priority, so a greedy merge in order gives the same; ``threshold`` must be over 0.
    """
    d = dosage.select(*CHROM, "state", F.col("start_bin").alias("d0"), F.col("end_bin").alias("d1"))
    met = others.join(d, [*CHROM, "state"], "left")
    alone = met.where(F.coalesce(interval_iou(F.col("start_bin"), F.col("end_bin"), F.col("d0"), F.col("d1")) < threshold, F.lit(True)))
    return dosage.unionByName(alone.drop("d0", "d1"), allowMissingColumns=True)


def calling_summary(bins: DataFrame, events: DataFrame) -> DataFrame:
    """Per sample: bins, events, median effective bins of a chromosome, centre and scale of the whole background, shifts by chromosome and the largest."""
    w = F.greatest("calling_weight", F.lit(1e-6))
    per = bins.groupBy(*CHROM).agg(F.count("*").alias("n"), (F.sum(w) * F.sum(w) / F.sum(w * w)).alias("ess"), F.first("chrom_shift_z").alias("shift"), F.first("background_center").alias("background_center"), F.first("background_scale").alias("background_scale"))
    shifts = F.map_from_entries(F.sort_array(F.collect_list(F.struct("chrom", "shift")))).alias("chrom_shift_z")
    out = per.groupBy("sample_id").agg(F.sum("n").alias("n_bins"), F.median("ess").alias("median_effective_bins"), F.max(F.abs("shift")).alias("max_abs_shift"), shifts, F.first("background_center").alias("background_center"), F.first("background_scale").alias("background_scale"))
    return out.join(events.groupBy("sample_id").agg(F.count("*").alias("n_events")), "sample_id", "left").fillna(0, ["n_events"])
