"""Mixing sources to target weights by Pfair scheduling of their blocks."""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LONG_MIN, cut, seal, small_table

MAX_SOURCES = 4096
#: Most slots of a schedule: with more rows blocks grow, so that the driver's part stays the same.
MAX_SLOTS = 1 << 18
_UNIT = 1 << 40


def whole_weights(weights: dict[str, float]) -> dict[str, int]:
    """Weights as integers with 40 bits for their sum: what rounding changes is under a millionth of a block over MAX_SLOTS."""
    total = sum(weights.values())
    return {s: max(1, round(w / total * _UNIT)) for s, w in weights.items()}


def pfair_schedule(blocks: dict[str, int], weights: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, phase) of every slot, by earliest deadline first among the blocks released.

    Within a phase of sources with the weights w and their sum W, block j (from
    0) of a source is released at slot floor(j * W / w) of the phase and due by
    ceil((j + 1) * W / w). The weights fill every slot, so each slot has a
    released block, no deadline is missed, and after any number of slots a source is
    less than one block from its share. A phase ends with the last block of a
    source; the others begin a new one without it.
    """
    left = {s: n for s, n in blocks.items() if n}
    at: list[tuple[str, int, int]] = []
    taken, phase = dict.fromkeys(left, 0), 0
    while left:
        whole, first = sum(weights[s] for s in left), len(at)
        due = lambda s, j: -(-(j + 1) * whole // weights[s])  # noqa: E731, B023  used within the phase only
        waiting: list[tuple[int, str, int]] = []
        ready = [(due(s, 0), s, 0) for s in left]
        heapq.heapify(ready)
        while True:
            now = len(at) - first
            while waiting and waiting[0][0] <= now:
                _, s, j = heapq.heappop(waiting)
                heapq.heappush(ready, (due(s, j), s, j))
            _, s, j = heapq.heappop(ready)
            at.append((s, taken[s], phase))
            taken[s] += 1
            if taken[s] == left[s]:
                del left[s]
                break
            heapq.heappush(waiting, ((j + 1) * whole // weights[s], s, j + 1))
        phase += 1
    return at


def slot_table(rows: dict[str, int], weights: dict[str, int], block_rows: int) -> list[dict]:
    """The schedule as a row for each source and phase: first block, slots, and the rows before each slot that its number doesn't say.

    A block that isn't full ends a phase, so the rows missing before a slot are the same within a phase.
    """
    table: dict[tuple[str, int], dict] = {}
    missing, short = 0, 0
    for slot, (s, block, phase) in enumerate(pfair_schedule({s: -(-n // block_rows) for s, n in rows.items()}, weights)):
        if slot and phase != before:  # noqa: F821  set by the slot before
            missing += short
        row = table.setdefault((s, phase), {"mix_src": s, "phase": phase, "first": block, "missing": missing, "slots": []})
        row["slots"].append(slot)
        before, short = phase, max(0, (block + 1) * block_rows - rows[s])  # noqa: F841
    return list(table.values())


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    alpha: float = 0.5,
    block_rows: int = 32,
    source: str = "source",
    id_col: str = "doc_id",
    text: str = "text",
    rows_per_bucket: int = 2048,
) -> DataFrame:
    """``docs`` plus ``mix_phase``, ``mix_block``, ``mix_slot``, ``mix_pos``: all rows, interleaved to target weights.

    Rows of a source are shuffled by a hash and cut into blocks of
    ``block_rows``. ``weights`` gives the target of each source; a source it
    doesn't name, and every source if it is None, weighs rows ** ``alpha``
    relative to the others. Blocks are placed by Pfair scheduling: within a
    phase every prefix of slots holds each source's share, by the target weights
    themselves, to less than one block. When a source has no more blocks a
    phase ends, and the others share its slots by their weights. mix_pos counts rows
    from 0 without gaps in the mixed order.

    The driver schedules at most MAX_SLOTS blocks: over MAX_SLOTS * block_rows rows (8 million by
    default) blocks are larger in proportion. The schedule is a table of so many rows, which is
    broadcast. No source is gathered in a task: a row's place within its source is
    its place in a bucket of the hash (about ``rows_per_bucket`` rows, as many buckets as the
    source needs) plus the rows of the source's earlier buckets, which are counted beforehand.

    Defined cases: null is a source of its own; null ids and texts are hashed
    as such, and a text's length doesn't matter; rows equal in id and text are ordered arbitrarily among
    themselves; an empty table gives an empty result; input columns with the
    names of the results are replaced, and all others are returned as they are. A weight that is not
    positive, or more than MAX_SOURCES sources, is an error, as the schedule is made on the driver.
    """
    spark = docs.sparkSession
    named = F.when(docs[source].isNull(), "n").otherwise(F.concat(F.lit("s"), docs[source].cast("string")))
    hashed, back = seal(docs, ["mix_phase", "mix_block", "mix_slot", "mix_pos"], mix_src=named, mix_h=F.xxhash64(F.lit(17), docs[id_col], docs[text]), id=docs[id_col])
    sizes = {r.mix_src: r["count"] for r in hashed.groupBy("mix_src").count().limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    given = {f"s{k}" if k is not None else "n": w for k, w in (weights or {}).items()}
    if any(w <= 0 for w in given.values()):
        raise ValueError("weights must be positive")
    by_size = {s: n**alpha for s, n in sizes.items()}
    wanted = {s: given.get(s, by_size[s] / sum(by_size.values())) for s in sizes}
    block_rows = max(block_rows, -(-sum(sizes.values()) // max(1, MAX_SLOTS - len(sizes))))
    schedule = small_table(spark, slot_table(sizes, whole_weights(wanted), block_rows) if sizes else [], "mix_src: string, phase: int, first: bigint, missing: bigint, slots: array<bigint>")
    slots = schedule.select("mix_src", "phase", "missing", "first", F.posexplode("slots").alias("nth", "slot")).select("mix_src", (F.col("first") + F.col("nth")).alias("block"), "phase", "missing", "slot")
    slots = cut(slots, "mix-slots")

    bits = [{"mix_src": s, "bits": max(0, math.ceil(math.log2(n / rows_per_bucket)))} for s, n in sizes.items()]
    hashed = hashed.join(F.broadcast(small_table(spark, bits, "mix_src: string, bits: int")), "mix_src")
    unsigned = F.col("mix_h").bitwiseXOR(F.lit(LONG_MIN))
    bucket = F.when(F.col("bits") > 0, F.call_function("shiftrightunsigned", unsigned, (64 - F.col("bits")).cast("int"))).otherwise(F.lit(0).cast("bigint"))
    hashed = hashed.withColumn("bucket", bucket).drop("bits")
    held = hashed.groupBy("mix_src", "bucket").count()
    before = F.sum("count").over(Window.partitionBy("mix_src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = held.select("mix_src", "bucket", F.coalesce(before, F.lit(0)).alias("before"))

    place = F.row_number().over(Window.partitionBy("mix_src", "bucket").orderBy("mix_h", "id")) - 1 + F.col("before")
    placed = hashed.join(starts, ["mix_src", "bucket"]).withColumn("place", place).withColumn("block", F.floor(F.col("place") / block_rows))
    return placed.join(F.broadcast(slots), ["mix_src", "block"]).select(
        *back,
        F.col("phase").alias("mix_phase"),
        F.col("block").alias("mix_block"),
        F.col("slot").alias("mix_slot"),
        (F.col("slot") * block_rows + F.col("place") % block_rows - F.col("missing")).alias("mix_pos"),
    )
