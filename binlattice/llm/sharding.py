"""Sharding by histogram sort: exact byte counts below probes choose the splitters, then rows move once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LONG_MIN, constant, cut, seal, small_table

_SPAN = 1 << 64
#: Most sums that a round brings to the driver, and most buckets that the driver keeps bounds of.
MAX_SUMS, MAX_BUCKETS = 1 << 20, 1 << 16
#: Up to so many open cells stand as literals in a round's filter; more are joined.
_LITERALS = 512


@dataclass(frozen=True)
class Splitters:
    """Lower bounds of buckets 1.. as (key, tie) pairs, and how many rows lie in each bucket."""

    bounds: list[tuple[int, int]]
    rounds: int


def _flip(column: str) -> Column:
    # the order of signed longs as the order of unsigned bit patterns
    return F.col(column).bitwiseXOR(F.lit(LONG_MIN))


def _cell(column: str, shift: int) -> Column:
    return F.shiftrightunsigned(_flip(column), shift) if shift < 64 else F.lit(0).cast("bigint")


def find_splitters(keys: DataFrame, targets: list[float], slack: float, bits: int = 6) -> Splitters:
    """Splitters whose exact bytes below are within ``slack`` of each target.

    ``keys`` has bigint ``k0``, ``k1`` and long ``size``. Each round lays 2**bits
    cells over every interval still open and sums the sizes in them, across all
    partitions, in one aggregation; an interval closes when an edge of a cell is
    near enough. What is left at single values of ``k0`` (a hot key) goes on
    within that value by ``k1``. The driver gets at most len(targets) * 2**bits
    sums a round, however large the data, and at most MAX_SUMS: with many targets
    cells are coarser and rounds more.
    """
    while bits > 1 and len(targets) << bits > MAX_SUMS:
        bits -= 1
    bounds: list[tuple[int, int] | None] = [None] * len(targets)
    ends = keys.agg(F.min(_flip("k0")).alias("a"), F.max(_flip("k0")).alias("b"), F.min("k0").alias("lo"), F.max("k0").alias("hi")).first()
    if ends.lo is None or not targets:
        return Splitters([], 0)
    low, high = ends.lo + 2**63, ends.hi + 2**63
    top = (low ^ high).bit_length()
    # open intervals: (value of k0 once it is fixed, parent cell) -> [(target index, bytes below)]
    level, shift, rounds = 0, top, 0
    open_at: dict[tuple[int | None, int], list[tuple[int, int]]] = {(None, low >> top): [(i, 0) for i in range(len(targets))]}
    later: dict[int, list[tuple[int, int]]] = {}
    while open_at or later:
        if not open_at:  # the next column, within the values of k0 that hold a target
            level, shift = 1, 64
            open_at, later = {(k, 0): v for k, v in later.items()}, {}
        rounds += 1
        finer = max(0, shift - bits)
        column = f"k{level}"
        rows = keys
        if level == 0:
            if shift < top:
                rows = _inside(rows, [_cell("k0", shift)], [(_signed(p),) for _, p in open_at])
            group = [F.lit(None).cast("bigint").alias("fixed")]
        else:
            rows = _inside(rows, [F.col("k0")], sorted({(k - 2**63,) for k, _ in open_at}))
            group = [_flip("k0").alias("fixed")]
            if shift < 64:
                rows = _inside(rows, [F.col("k0"), _cell("k1", shift)], [(k - 2**63, _signed(p)) for k, p in open_at])
        counted = rows.groupBy(*group, _cell(column, finer).alias("cell")).agg(F.sum("size").alias("bytes")).collect()
        cells: dict[tuple[int | None, int], list[tuple[int, int]]] = {}
        for r in counted:
            cell = r.cell % _SPAN
            fixed_key = None if level == 0 else r.fixed % _SPAN
            cells.setdefault((fixed_key, cell >> (shift - finer)), []).append((cell, r.bytes))
        still: dict[tuple[int | None, int], list[tuple[int, int]]] = {}
        for parent, wanted in open_at.items():
            inside = sorted(cells.get(parent, []))
            for i, below in wanted:
                before = below
                for at, (cell, held) in enumerate(inside):
                    after = before + held
                    if after >= targets[i] or at == len(inside) - 1:
                        break
                    before = after
                near_left = targets[i] - before <= after - targets[i]
                miss = min(abs(targets[i] - before), abs(after - targets[i]))
                last = finer == 0 and level == 1
                if miss <= slack or last:
                    edge = (cell if near_left else cell + 1) << finer
                    bounds[i] = (edge, 0) if level == 0 else (parent[0], edge)
                elif finer == 0:
                    later.setdefault(cell, []).append((i, before))
                else:
                    still.setdefault((parent[0], cell), []).append((i, before))
        open_at, shift = still, finer
    return Splitters([(a, b) for a, b in bounds], rounds)


def _signed(value: int) -> int:
    return value - _SPAN if value >= 2**63 else value


def _inside(rows: DataFrame, of: list[Column], wanted: list[tuple[int, ...]]) -> DataFrame:
    """The rows whose values ``of`` are among ``wanted``, at most MAX_BUCKETS of them."""
    if len(wanted) <= _LITERALS:
        number = lambda v: F.lit(v).cast("bigint")
        return rows.where(F.struct(*of).isin([F.struct(*map(number, w)) for w in wanted]) if len(of) > 1 else of[0].isin([w[0] for w in wanted]))
    names = [f"in{i}" for i in range(len(of))]
    table = small_table(rows.sparkSession, [dict(zip(names, w, strict=True)) for w in wanted], ", ".join(f"{n}: bigint" for n in names))
    same = [c.alias(f"at{i}") for i, c in enumerate(of)]
    met = rows.select("*", *same).join(F.broadcast(table), [F.col(f"at{i}") == F.col(n) for i, n in enumerate(names)], "left_semi")
    return met.drop(*[f"at{i}" for i in range(len(of))])


def bucket_of(bounds: list[tuple[int, int]]) -> Column:
    """How many of the ordered bounds are at or below (k0, k1), by binary search."""
    if not bounds:
        return F.lit(0)
    # an edge beyond the last value of its column is beyond every row with that prefix
    first = constant([min(a, _SPAN - 1) - 2**63 for a, _ in bounds], "bigint")
    second = constant([min(b, _SPAN - 1) - 2**63 for _, b in bounds], "bigint")
    open_end = constant([a >= _SPAN or b >= _SPAN for a, b in bounds], "boolean")
    steps = [1 << j for j in reversed(range(len(bounds).bit_length()))]

    def reached(at: Column) -> Column:
        a, b, end = F.get(first, at - 1), F.get(second, at - 1), F.get(open_end, at - 1)
        beyond = F.when(end, F.col("k0") > a).otherwise((F.col("k0") > a) | ((F.col("k0") == a) & (F.col("k1") >= b)))
        return (at <= len(bounds)) & beyond

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(reached(at + s), at + s).otherwise(at))


def histogram_shard(docs: DataFrame, n_shards: int, key: Column | str = "doc_id", text: str = "text", tolerance: float = 0.01, bucket_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` plus ``size``, ``shard`` and ``slot``: a global sort by ``key``, cut into shards of near equal bytes.

    size is the UTF-8 bytes of the text plus 1 (null text: 1). Shard boundaries
    miss their targets by at most ``tolerance`` of a shard, or by one row. slot
    counts from 0 without gaps in key order within a shard.

    A shard is dealt out as several buckets of about ``bucket_bytes``, found in
    the same rounds, and each bucket is a shuffle partition of its own, so that no
    task sorts a whole shard; a slot is the place in the bucket plus the rows of the
    shard's earlier buckets. Rows move once. From MAX_BUCKETS buckets on (4 TB
    with the default size) they grow with the data instead; Spark's sort spills.

    Defined cases: a null key sorts before all others; rows with equal keys are
    ordered, and may be divided, by a hash of all their columns, so a hot key
    is no obstacle; rows equal in all columns are interchangeable and stay
    together; texts of any length are rows like others, and a shard may exceed its
    share by one of them; an empty table gives an empty result; input columns called
    size, shard or slot are replaced, and all others are returned as they are.
    """
    key_col = F.col(key) if isinstance(key, str) else key
    sized, back = seal(
        docs,
        ["size", "shard", "slot"],
        k0=F.coalesce(key_col.cast("bigint"), F.lit(LONG_MIN)),
        k1=F.xxhash64(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in ("size", "shard", "slot")]),
        size=(F.coalesce(F.octet_length(docs[text]), F.lit(0)) + 1).cast("bigint"),
    )
    keys = cut(sized.select("k0", "k1", "size"), "shard-keys")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    per_shard = max(1, min(-(-total // (n_shards * bucket_bytes)), MAX_BUCKETS // n_shards))
    n_buckets = n_shards * per_shard
    # the boundaries of shards are held to the tolerance; the others only balance tasks
    edges = [i * total / n_shards for i in range(1, n_shards)]
    bounds = sorted(find_splitters(keys, edges, tolerance * total / n_shards).bounds)
    if per_shard > 1:
        inner = [i * total / n_buckets for i in range(1, n_buckets) if i % per_shard]
        bounds = _nested(bounds, find_splitters(keys, inner, 0.25 * total / n_buckets).bounds, per_shard)
    counts = dict(keys.groupBy(bucket_of(bounds).alias("bucket")).count().collect())
    starts: list[int] = []
    for b in range(n_buckets):
        starts.append(0 if b % per_shard == 0 else starts[-1] + counts.get(b - 1, 0))
    dealt = sized.withColumn("bucket", bucket_of(bounds)).repartitionById(n_buckets, F.col("bucket")).sortWithinPartitions("k0", "k1")
    # partition b holds bucket b and nothing else: the low 33 bits count its rows in order
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + F.get(constant(starts, "bigint"), F.col("bucket"))
    return dealt.select(*back, "size", F.floor(F.col("bucket") / per_shard).cast("int").alias("shard"), place.cast("bigint").alias("slot"))


def _nested(edges: list[tuple[int, int]], inner: list[tuple[int, int]], per_shard: int) -> list[tuple[int, int]]:
    """Bounds of buckets, per_shard a shard: the inner ones kept between the edges of their shard."""
    lowest, highest = (0, 0), (_SPAN, 0)
    out, inner = [], sorted(inner)
    if not edges and not inner:
        return []
    for s in range(len(edges) + 1):
        low = edges[s - 1] if s else lowest
        high = edges[s] if s < len(edges) else highest
        out += [min(max(b, low), high) for b in inner[s * (per_shard - 1) : (s + 1) * (per_shard - 1)]]
        out += edges[s : s + 1]
    return out
