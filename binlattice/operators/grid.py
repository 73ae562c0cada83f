"""Bin grids, base composition and interval joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from binlattice.functions.storage import stored

DEFAULT_FRACTIONS = ["par", "xtr", "sex_homology", "segmental_duplication", "low_mappability", "repeat_rich", "gap_centromere_telomere", "blacklist", "ambiguous_alignment"]


def make_bin_grid(chrom_sizes: DataFrame, bin_size: int, level: str) -> DataFrame:
    """ceil(length / size) bins a chromosome, the last one truncated."""
    at = F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("length") / bin_size) - 1)).alias("bin_index")
    bins = chrom_sizes.where("length > 0").select("chrom", "length", at)
    start, end = F.col("bin_index") * bin_size, F.least((F.col("bin_index") + 1) * bin_size, F.col("length"))
    return bins.select(
        F.lit(level).alias("bin_level"),
        F.concat(F.lit(level), F.lit(":"), "chrom", F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string")).alias("bin_id"),
        "chrom",
        "bin_index",
        start.alias("start_pos"),
        end.alias("end_pos"),
        F.lit(bin_size).cast("bigint").alias("bin_size"),
        (end - start).alias("effective_size"),
    )


def multi_level_grid(chrom_sizes: DataFrame, levels: dict[str, int]) -> DataFrame:
    """The grids of all levels."""
    grids = [make_bin_grid(chrom_sizes, size, name) for name, size in levels.items()]
    out = grids[0]
    for g in grids[1:]:
        out = out.unionByName(g)
    return out


def count_fragments(alignments: DataFrame, grid: DataFrame, bin_size: int, mapq: int = 30) -> DataFrame:
    """Counted reads per sample and bin, 0 where there are none.

    Unmapped, secondary, supplementary, duplicate and failed reads don't count, nor reads under ``mapq``;
    of a pair only read 1. A position outside its chromosome is in no bin of the grid and so dropped rather than counted on the next one.
    The alignments are read once: bins where no read counts are kept too, so that a sample without any read that counts still has its bins.
    """
    out = F.col("is_unmapped") | F.col("is_secondary") | F.col("is_supplementary") | F.col("is_duplicate") | F.col("is_qcfail")
    good = ~out & (F.col("mapq") >= mapq) & (~F.col("is_paired") | F.col("is_read1"))
    counted = stored(alignments.groupBy("sample_id", "chrom", F.floor(F.col("pos") / bin_size).alias("bin_index")).agg(F.count_if(good).alias("n")))
    dense = counted.select("sample_id").distinct().crossJoin(grid.select("chrom", "bin_index", "start_pos", "end_pos"))
    return dense.join(counted, ["sample_id", "chrom", "bin_index"], "left").select("sample_id", "chrom", "bin_index", "start_pos", "end_pos", F.coalesce("n", F.lit(0)).alias("raw_count"))


BASES = "ACGTN"


def _letter_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of each letter of BASES, of both cases, in ``piece``, with the other columns, by bytes: no other character has a byte of these in UTF-8."""
    for batch in batches:
        text = batch.column("piece").cast(pa.large_binary())
        _, where, data = text.buffers()
        at = np.frombuffer(where, np.int64)[text.offset : text.offset + len(text) + 1]
        raw = np.frombuffer(data or b"", np.uint8)
        counts, i = np.zeros((len(BASES), len(text)), np.int64), 0
        while i < len(text):  # about a million bytes at a time
            j = max(i + 1, int(np.searchsorted(at, at[i] + (1 << 20), "right")) - 1)
            lower = raw[at[i] : at[j]] | 0x20
            for k, b in enumerate(BASES):
                counts[k, i:j] = np.diff(np.searchsorted(np.flatnonzero(lower == ord(b.lower())), at[i : j + 1] - at[i]))
            i = j
        rest = [n for n in batch.schema.names if n != "piece"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], *map(pa.array, counts)], [*rest, *[f"n_{b.lower()}" for b in BASES]])


def base_composition(chunks: DataFrame, grid: DataFrame, bin_size: int) -> DataFrame:
    """Base counts and GC, N and ACGT fractions per bin; GC is null without any base.

    A chunk is cut where bins begin, so each piece is counted in one bin. Both cases of a letter are counted in the text as it is: upper()
    makes some letters two (ß becomes SS), which would move all that follows. The letters of a batch are found in its bytes at once, as a replace()
    for each of them copies the whole text ten times.
    """
    end = F.col("chunk_start") + F.length("seq")
    cut = chunks.where(F.length("seq") > 0).select("chrom", "chunk_start", "seq", F.explode(F.sequence(F.floor(F.col("chunk_start") / bin_size), F.floor((end - 1) / bin_size))).alias("bin_index"))
    first = F.greatest(F.lit(0), F.col("bin_index") * bin_size - F.col("chunk_start"))
    last = (F.col("bin_index") + 1) * bin_size - F.col("chunk_start")
    piece = cut.select("chrom", "bin_index", F.substring("seq", (first + 1).cast("int"), (last - first).cast("int")).alias("piece"))
    kind = StructType([*piece.schema.fields[:2], *[StructField(f"n_{b.lower()}", LongType()) for b in BASES]])
    counts = piece.mapInArrow(_letter_counts, kind).groupBy("chrom", "bin_index").agg(*[F.sum(f"n_{b.lower()}").alias(f"n_{b.lower()}") for b in BASES])
    acgt = F.col("n_a") + F.col("n_c") + F.col("n_g") + F.col("n_t")
    joined = grid.join(counts, ["chrom", "bin_index"], "left").fillna(0, [f"n_{b}" for b in "acgtn"])
    size = F.greatest(F.col("effective_size"), F.lit(1))
    return joined.select(
        "chrom", "bin_index", "start_pos", "end_pos", "effective_size", *[f"n_{b}" for b in "acgtn"],
        F.when(acgt > 0, (F.col("n_g") + F.col("n_c")) / acgt).alias("gc_fraction"), (F.col("n_n") / size).alias("n_fraction"), (acgt / size).alias("atgc_fraction"), (acgt / size).alias("mappability_score"),
    )


#: Buckets of overlap_join are 16 times as wide from level to level; the last level takes all longer intervals.
LEVELS = 4


def _width(level: Column, bucket: int) -> Column:
    return F.lit(bucket).cast("bigint") * F.pow(F.lit(16), level).cast("bigint")


def _own_level(start: str, end: str, bucket: int) -> Column:
    """The narrowest level whose buckets are no shorter than the interval, which then touches two of them at most."""
    level = F.lit(LEVELS)
    for k in range(LEVELS - 1, -1, -1):
        level = F.when(F.col(end) - F.col(start) <= bucket * 16**k, F.lit(k)).otherwise(level)
    return level


def _dealt(rows: DataFrame, start: str, end: str, bucket: int, levels: DataFrame | None = None) -> DataFrame:
    """``rows`` in the buckets of their own level, or of the levels that ``levels`` (__own, __level and more) gives for it."""
    rows = rows.withColumn("__level", F.col("__own")) if levels is None else rows.join(F.broadcast(levels), "__own")
    rows = rows.withColumn("__width", _width(F.col("__level"), bucket))
    return rows.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col(start) / F.col("__width")), F.floor((F.col(end) - 1) / F.col("__width"))))).drop("__own")


def overlap_join(left: DataFrame, right: DataFrame, bucket: int, on: tuple[str, ...] = ("chrom",)) -> DataFrame:
    """Pairs of half-open intervals of the same chromosome (or of equal columns ``on``) that overlap, as an equi-join.

    ``left`` has start_pos, end_pos; ``right`` has r_start, r_end. An interval's own level is the narrowest one as wide as itself, so
    that even one as long as a chromosome lies in two buckets. Two intervals meet on the wider of their levels: there the wider one is in its own
    buckets, and the other is dealt to the one or two that it touches. A pair counts only in the first bucket it has in common, so no distinct is needed.
    Whose level the wider one is belongs to the key, so one join holds all pairs; a side is read once for it and once for its levels.
    """
    x = left.where("end_pos > start_pos").withColumn("__own", _own_level("start_pos", "end_pos", bucket))
    y = right.where("r_end > r_start").withColumn("__own", _own_level("r_start", "r_end", bucket))
    held = lambda rows, name: rows.agg(F.collect_set("__own").alias(name))  # noqa: E731  (LEVELS + 1 numbers at most)
    both = held(x, "__x").crossJoin(F.broadcast(held(y, "__y"))).select(F.explode("__x").alias("__x"), "__y").select("__x", F.explode("__y").alias("__y"))
    levels = lambda own: both.select(F.col(own).alias("__own"), F.greatest("__x", "__y").alias("__level"), (F.col("__x") >= F.col("__y")).alias("__by_left")).distinct()
    at = [*on, "__level", "__by_left", "__bucket"]
    met = _dealt(x, "start_pos", "end_pos", bucket, levels("__x")).join(_dealt(y, "r_start", "r_end", bucket, levels("__y")).drop("__width"), at)
    first = F.floor(F.greatest("start_pos", "r_start") / F.col("__width"))
    return met.where((F.col("start_pos") < F.col("r_end")) & (F.col("r_start") < F.col("end_pos")) & (F.col("__bucket") == first)).drop("__level", "__by_left", "__bucket", "__width")


def overlap_bp() -> Column:
    return F.least("end_pos", "r_end") - F.greatest("start_pos", "r_start")


def overlap_fraction(bins: DataFrame, intervals: DataFrame, bucket: int, classes: list[str]) -> DataFrame:
    """Per bin the share that intervals of each class overlap, at most 1; overlapping intervals add up."""
    right = intervals.select("chrom", F.col("start_pos").alias("r_start"), F.col("end_pos").alias("r_end"), "region_class")
    met = overlap_join(bins.select("chrom", "start_pos", "end_pos"), right, bucket)
    size = F.greatest(F.col("end_pos") - F.col("start_pos"), F.lit(1))
    wide = met.groupBy("chrom", "start_pos", "end_pos").agg(*[F.sum(F.when(F.col("region_class") == c, overlap_bp())).alias(c) for c in classes])
    share = [F.least(F.coalesce(F.col(c), F.lit(0)) / size, F.lit(1.0)).alias(f"{c}_overlap_fraction") for c in classes]
    return bins.join(wide, ["chrom", "start_pos", "end_pos"], "left").select(*bins.columns, *share)


def region_flags(bins: DataFrame, classes: list[str]) -> DataFrame:
    """overlaps_<class> = 1 where the fraction is over 0."""
    return bins.withColumns({f"overlaps_{c}": (F.col(f"{c}_overlap_fraction") > 0).cast("int") for c in classes})


def grid_level_summary(grid: DataFrame, classes: list[str]) -> DataFrame:
    return grid.groupBy("bin_level").agg(F.count("*").alias("n_bins"), F.median("gc_fraction").alias("median_gc"), F.median("n_fraction").alias("median_n"), *[F.sum(f"overlaps_{c}").alias(f"n_{c}") for c in classes])


def project_annotations(bins: DataFrame, source: DataFrame, values: list[str], flags: list[str], bucket: int) -> DataFrame:
    """Values of source bins averaged onto other bins by overlap / span, not renormalised where coverage is partial.

    On a chromosome that the source lacks values are null; on one it has, bins that it doesn't touch get 0. Flags are 1 if any overlapping bin has them.
    """
    right = source.select("chrom", F.col("start_pos").alias("r_start"), F.col("end_pos").alias("r_end"), *values, *flags)
    met = overlap_join(bins.select("chrom", "start_pos", "end_pos"), right, bucket)
    share = overlap_bp() / F.greatest(F.col("end_pos") - F.col("start_pos"), F.lit(1))
    got = met.groupBy("chrom", "start_pos", "end_pos").agg(*[F.sum(F.col(v) * share).alias(v) for v in values], *[F.max(f).alias(f) for f in flags], F.lit(True).alias("met"))
    there = source.select("chrom").distinct().withColumn("known", F.lit(True))
    out = bins.select("chrom", "start_pos", "end_pos").join(got, ["chrom", "start_pos", "end_pos"], "left").join(there, "chrom", "left")
    value = lambda v: F.when(F.col("met"), F.col(v)).when(F.col("known"), 0.0)
    return out.select("chrom", "start_pos", "end_pos", *[value(v).alias(v) for v in values], *[F.coalesce(f, F.lit(0)).alias(f) for f in flags])


def coarsen_bins(bins: DataFrame, size: int, sample: str = "sample_id") -> DataFrame:
    """Counts summed to bins of ``size``; GC is the mean over bins that have one, weighted by their length."""
    span = F.col("end_pos") - F.col("start_pos")
    known = F.when(F.col("gc_fraction").isNotNull(), span)
    return bins.groupBy(sample, "chrom", F.floor(F.col("start_pos") / size).alias("bin_index")).agg(
        F.sum("raw_count").alias("raw_count"), F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), (F.sum(F.col("gc_fraction") * span) / F.sum(known)).alias("gc_fraction")
    )


def bin_size_label(size: Column) -> Column:
    """1mb, 500kb or 750bp."""
    return (
        F.when(size % 1_000_000 == 0, F.concat((size / 1_000_000).cast("bigint").cast("string"), F.lit("mb")))
        .when(size % 1000 == 0, F.concat((size / 1000).cast("bigint").cast("string"), F.lit("kb")))
        .otherwise(F.concat(size.cast("string"), F.lit("bp")))
    )


def events_to_bins(events: DataFrame, bins: DataFrame) -> DataFrame:
    """The bins from start_bin to end_bin, both included, of each event."""
    spread = events.select("event_id", "sample_id", "chrom", F.explode(F.sequence("start_bin", "end_bin")).alias("bin_index"))
    return spread.join(bins, ["sample_id", "chrom", "bin_index"])


def runs(bins: DataFrame, keep: Column, label: Column | None = None) -> DataFrame:
    """Maximal runs of neighbouring rows of a chromosome for which ``keep`` holds, and ``label`` is the same."""
    label = label if label is not None else F.lit(0)
    marked = bins.withColumn("__k", F.coalesce(keep, F.lit(False))).withColumn("__l", label)
    w = Window.partitionBy("sample_id", "chrom").orderBy("bin_index")
    return marked.withColumn("__i", F.row_number().over(w)).where("__k").withColumn("run", F.col("__i") - F.row_number().over(Window.partitionBy("sample_id", "chrom", "__l").orderBy("bin_index"))).withColumnRenamed("__l", "label").drop("__k", "__i")


def seed_blocks(bins: DataFrame, keep: Column, min_len: int) -> DataFrame:
    """(sample_id, chrom, block_index, left, right): runs of at least ``min_len`` bins, numbered among those kept."""
    kept = runs(bins, keep).groupBy("sample_id", "chrom", "run").agg(F.min("bin_index").alias("left_bin"), (F.max("bin_index") + 1).alias("right_bin"), F.count("*").alias("n_bins")).where(F.col("n_bins") >= min_len)
    return kept.withColumn("block_index", F.row_number().over(Window.partitionBy("sample_id", "chrom").orderBy("left_bin")) - 1).drop("run")


def project_mask(bins: DataFrame, mask: DataFrame, bucket: int) -> DataFrame:
    """The mask of each bin by the shares of mask labels in it, with the reason that covers most (ties: the longer, then the later text)."""
    right = mask.select("chrom", F.col("start_pos").alias("r_start"), F.col("end_pos").alias("r_end"), F.coalesce("mask_label", F.lit("pass")).alias("label"), F.coalesce("mask_reason", F.lit("")).alias("reason"))
    target = bins.select("chrom", "start_pos", "end_pos").distinct()
    place = ["chrom", "start_pos", "end_pos"]
    per = overlap_join(target, right, bucket).groupBy(*place, "label", "reason").agg(F.sum(overlap_bp()).alias("bp"))
    reasons = per.groupBy(*place, "reason").agg(F.sum("bp").alias("bp"), *[F.sum(F.when(F.col("label") == k, F.col("bp")).otherwise(0)).alias(k) for k in ("hard", "dynamic", "soft")])
    top = F.max_by("reason", F.when(F.col("reason") != "", F.struct("bp", F.length("reason"), "reason")))
    done = reasons.groupBy(*place).agg(top.alias("mask_reason"), *[F.sum(k).alias(k) for k in ("hard", "dynamic", "soft")])
    span = F.greatest(F.col("end_pos") - F.col("start_pos"), F.lit(1))
    part = lambda k: F.coalesce(F.col(k), F.lit(0)) / span
    label = F.when(part("hard") >= 0.5, "hard").when(part("dynamic") >= 0.3, "dynamic").when(part("soft") >= 0.3, "soft").when((part("hard") > 0) | (part("dynamic") > 0), "dynamic").when(part("soft") > 0, "soft").otherwise("pass")
    return target.join(done, place, "left").select(*place, label.alias("mask_label"), F.coalesce("mask_reason", F.lit("")).alias("mask_reason"))


def escalate_hotspots(bins: DataFrame) -> DataFrame:
    """Raises masks at acrocentric gaps, X/Y homology and duplication-rich chromosomes; never lowers one. Classes without a column count as 0."""
    f = lambda c: F.coalesce(F.col(f"{c}_overlap_fraction"), F.lit(0.0)) if f"{c}_overlap_fraction" in bins.columns else F.lit(0.0)
    # Chromosomes and the names of reasons.
    gap = F.col("chrom").isin("chr13", "chr14", "chr15", "chr21", "chr22") & (f("gap_centromere_telomere") >= 0.5)
    repeat = F.col("chrom").isin("chr9", "chr16") & (f("segmental_duplication") >= 0.35)
    alike = F.when(F.col("chrom").isin("chrX", "chrY"), F.greatest(f("par"), f("xtr"), f("sex_homology"), f("ambiguous_alignment"))).otherwise(0.0)
    want = F.when(gap | (alike >= 0.5), "hard").when(repeat | (alike >= 0.1), "dynamic")
    why = F.when(gap, "branch_b_hotspot:acrocentric_gap").when(alike >= 0.1, "branch_b_hotspot:xy_homology").otherwise("branch_b_hotspot:repeat_hotspot")
    rank = lambda x: F.when(x == "hard", 3).when(x == "dynamic", 2).when(x == "soft", 1).otherwise(0)
    df = bins.withColumn("__up", F.coalesce(rank(want) > rank(F.col("mask_label")), F.lit(False)))
    df = df.withColumn("mask_reason", F.when(F.col("__up"), F.concat_ws(";", F.nullif(F.coalesce("mask_reason", F.lit("")), F.lit("")), why)).otherwise(F.col("mask_reason")))
    return df.withColumn("mask_label", F.when(F.col("__up"), want).otherwise(F.coalesce("mask_label", F.lit("pass")))).drop("__up")
