"""MinHash near-duplicates: fast similarity sketching, banding, exact verification, components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LONG_MIN, cut, seal
from .text_arrays import chunks, mix, shingle_sets

#: Coordinates of a sketch.
SIZE = 128
#: Rounds in which each open bucket's most connected class meets the others, before what is left is compared in blocks.
HUB_ROUNDS = 2
#: Classes of a bucket that are compared at once with as many others; a bucket of more than two blocks is banded again first.
BLOCK = 512
#: Shingles of the classes that are compared at once with as many others; longer texts make smaller blocks.
BLOCK_SHINGLES = 1 << 20
#: Shingles, and bytes of text, that a task works on at a time beside the sets of its block.
SLICE = 1 << 18
SIGNATURE = [f"s{i}" for i in range(SIZE // 16)]


@dataclass(frozen=True)
class Banding:
    """The first bands * rows coordinates are banded; likely: least number of equal 4-bit coordinates, of SIZE, of a candidate."""

    bands: int
    rows: int
    likely: int


def banding(percent: int, miss: float = 4e-6) -> Banding:
    """The longest bands with which a pair of similarity ``percent`` shares none with a probability of ``miss`` at most.

    ``likely`` lies four and a half standard deviations below the mean number of equal 4-bit coordinates of such a pair, which it
    misses about as rarely. At 80 percent: 24 bands of 4 and 84 coordinates; at 50: 44 bands of 2 and 42.
    """
    s = percent / 100
    if s >= 1:
        return Banding(1, SIZE, SIZE)
    counts = {r: math.ceil(math.log(miss) / math.log1p(-(s**r))) for r in range(1, SIZE + 1) if s**r > 1e-12}
    fits = [(r, b) for r, b in counts.items() if r * b <= SIZE]
    if not fits:
        raise ValueError(f"sketches of {SIZE} coordinates are too short for {percent} percent")
    rows, bands = max(fits)
    equal = s + (1 - s) / 16
    return Banding(bands, rows, math.floor(SIZE * equal - 4.5 * math.sqrt(SIZE * equal * (1 - equal))))


def sketches(sets: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """Fast similarity sketches of non-empty sets, one row each.

    In round i every element is thrown into a bin by a hash of that round and
    offers i plus a fraction; a bin keeps its least offer, so earlier rounds win.
    A set is done when all its bins are filled, after about one round if it
    is large. From round ``size`` on, round i throws all elements into bin i - size:
    2 * size rounds fill everything. Two sets agree in a bin with probability
    their Jaccard similarity, and a set's coordinates are concentrated at least
    as well as independent ones.
    """
    empty = np.uint64(2**64 - 1)
    kept = np.full(len(sets) * size, empty, np.uint64)
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for i in range(2 * size):
        if not len(elements):
            break
        h = mix(elements + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64))
        bins = (h >> np.uint64(40)).astype(np.int64) % size if i < size else np.full(len(h), i - size)
        offers = (np.uint64(i) << np.uint64(40)) | (h & np.uint64(2**40 - 1))
        np.minimum.at(kept, owner * size + bins, offers)
        open_sets = (kept.reshape(-1, size) == empty).any(axis=1)
        still = open_sets[owner]
        elements, owner = elements[still], owner[still]
    return kept.reshape(-1, size)


def _bands(coords: np.ndarray, plan: Banding) -> np.ndarray:
    """A hash for each band of each sketch."""
    salt = mix(np.arange(plan.bands, dtype=np.uint64) + np.uint64(7))
    band = np.broadcast_to(salt, (len(coords), plan.bands)).copy()
    for r in range(plan.rows):
        band = mix(band + coords[:, r : plan.bands * plan.rows : plan.rows])
    return band.astype(np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch], k: int, plan: Banding) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in chunks(batch.column("text").fill_null("")):
            sets = shingle_sets(data, offsets, k)
            sizes = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(sizes)
            coords = sketches([sets[i] for i in some])
            names = np.array([mix(sets[i]).sum(dtype=np.uint64) for i in some], np.uint64)
            names = mix(names + sizes[some].astype(np.uint64)).astype(np.int64)
            nibbles = coords & np.uint64(15)
            packed = [np.zeros(len(some), np.uint64) for _ in SIGNATURE]
            for j in range(SIZE):
                packed[j // 16] |= nibbles[:, j] << np.uint64(4 * (j % 16))
            full = np.zeros((b - a, plan.bands), np.int64)
            full[some] = _bands(coords, plan)
            name, known = np.zeros(b - a, np.int64), np.zeros(b - a, bool)
            name[some], known[some] = names, True
            columns = {
                "doc": batch.column("doc").slice(a, b - a),
                "mark": batch.column("mark").slice(a, b - a),
                "n": pa.array(sizes),
                "name": pa.array(name, mask=~known),
                "bands": pa.ListArray.from_arrays(np.arange(0, (b - a + 1) * plan.bands, plan.bands, dtype=np.int32), pa.array(full.reshape(-1))),
            }
            for column, values in zip(SIGNATURE, packed, strict=True):
                whole = np.zeros(b - a, np.int64)
                whole[some] = values.astype(np.int64)
                columns[column] = pa.array(whole)
            yield pa.RecordBatch.from_pydict(columns)


def _second_bands(batches: Iterator[pa.RecordBatch], k: int, plan: Banding) -> Iterator[pa.RecordBatch]:
    """(name, bands) by sketches independent of the first ones."""
    for batch in batches:
        for a, b, data, offsets in chunks(batch.column("text").fill_null("")):
            sets = [mix(s ^ np.uint64(0xA0761D6478BD642F)) for s in shingle_sets(data, offsets, k)]
            band = _bands(sketches(sets), plan).reshape(-1)
            lists = pa.ListArray.from_arrays(np.arange(0, (b - a + 1) * plan.bands, plan.bands, dtype=np.int32), pa.array(band))
            yield pa.RecordBatch.from_pydict({"name": batch.column("name").slice(a, b - a), "bands": lists})


def _short_slices(batch: pa.RecordBatch, texts: tuple[str, ...], rows: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``rows`` rows and about 4 * SLICE bytes in the columns ``texts``, or of one longer row."""
    held = sum(np.cumsum(pc.binary_length(batch.column(c)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) for c in texts)
    at = 0
    while at < len(batch):
        before = held[at - 1] if at else 0
        end = max(at + 1, min(at + rows, int(np.searchsorted(held, before + 4 * SLICE, "right"))))
        yield batch.slice(at, end - at)
        at = end


def _verified(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in (small for whole in batches for small in _short_slices(whole, ("text_a", "text_b"), 64)):
        sets = {}
        for side in ("text_a", "text_b"):
            sets[side] = [s for _, _, data, offsets in chunks(batch.column(side).fill_null("")) for s in shingle_sets(data, offsets, k)]
        linked = []
        for x, y in zip(sets["text_a"], sets["text_b"], strict=True):
            common = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * common >= percent * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(linked, pa.bool_()))


def _alike(percent: int, likely: int) -> Column:
    """Whether two rows l and r can be ``percent`` similar: by set sizes, and by 4-bit coordinates of their sketches."""
    equal = F.lit(0)
    for s in SIGNATURE:
        x = F.col(f"l.{s}").bitwiseXOR(F.col(f"r.{s}"))
        any_bit = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3))
        equal = equal + 16 - F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111)))
    by_size = (100 * F.col("l.n") >= percent * F.col("r.n")) & (100 * F.col("r.n") >= percent * F.col("l.n"))
    return by_size & (equal >= likely)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component of edges (a, b), by large and small stars.

    Both operations keep components and turn them into stars around their least
    nodes in O(log^2 n) rounds. A round is two aggregations to the least
    neighbour, with map-side combining, and joins; no task holds a node's
    neighbours together. Each round is written to the shared folder.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = cut(both.join(least, "u").where("v > u AND v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        edges = cut(small.where("u > v").distinct(), "small-star")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
        before = state


def near_duplicates(docs: DataFrame, shingle: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, n_shingles, component_id, kept, is_first): components of documents linked by shingle similarity.

    A document's set holds the distinct ``shingle``-word shingles of its whole text,
    A-Z lower-cased, words being runs outside [\\x20\\x09-\\x0D]; with fewer words
    their whole sequence; without words it is empty and linked with nothing.
    Documents are linked if 100 * |intersection| >= ``percent`` * |union|.

    Documents with equal sets become one class, named by a 64-bit hash of the
    set, as its shingles are 64-bit hashes of their words: among n different sets or shingles two are taken for one with a
    probability of n^2 / 2^65. Classes are sketched and banded as ``percent`` needs, see banding(). In each bucket with several classes the most
    connected one, usually the text the others were copied from, meets the
    others: pairs that sizes and sketches allow are verified on full sets, and
    components are formed. Buckets that still hold several components do so
    again, with the most connected class outside their largest component. A bucket that is still open with more than
    2 * BLOCK classes is parted by bands of a second, independent sketch, if that spares most of its pairs. What is then
    open is compared in blocks of at most 2 * BLOCK classes, fewer where texts are long (2 * BLOCK_SHINGLES shingles and a text): sketches first, then, of the classes with a
    likely partner in the block, full sets, by counting common shingles of all of them at once; only links between components
    come out. So every pair that shares a band is verified or already
    connected, without a row for each pair. Most groups of copies are connected after
    the first round; the blocks meet texts that share much but less than ``percent``.

    Defined cases: null text counts as empty; a null id is reported as null and
    only counts as its component's id if the component has no other; rows
    sharing an id are told apart by ``mark``, the hash of their text; of rows equal in
    id and text all are reported, alike; a very long text is hashed in pieces, whole, and its set is held by one task; an empty table gives an empty result;
    other columns aren't used. kept is id = component_id; is_first also
    tells rows apart that share the component's id, by the least mark, and holds for
    every document without words.
    """
    plan = banding(percent)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    kinds = "doc bigint, mark bigint, n bigint, name bigint, bands array<bigint>, " + ", ".join(f"{s} bigint" for s in SIGNATURE)
    sketched = cut(rows.mapInArrow(lambda it: _sketch_batches(it, shingle, plan), kinds), "sketches")
    # the least id that is not null, if there is one, and the least mark with it
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "mark")
    classes = cut(
        sketched.where("name IS NOT NULL")
        .groupBy("name")
        .agg(F.min(place).alias("at"), F.first("n").alias("n"), F.first("bands").alias("bands"), *[F.first(s).alias(s) for s in SIGNATURE]),
        "classes",
    )
    banded = classes.select("name", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    shared = cut(banded.join(sizes, "bucket"), "buckets")  # classes that share a bucket
    # the text that others were copied from shares the most buckets with the most classes
    weight = shared.groupBy("name").agg(F.sum("held").alias("weight"))
    open_rows = cut(shared.select("bucket", "name").join(weight, "name").withColumn("root", F.col("name")), "open-buckets")
    facts = classes.select("name", "n", *SIGNATURE)
    texts = _texts(rows, classes, weight)

    edges = None
    for turn in range(HUB_ROUNDS):
        hub = F.max_by(F.struct("name", "root"), F.struct("weight", "name"))
        if turn:
            main = F.max_by("root", F.struct("here", "root")).alias("main")
            main = open_rows.groupBy("bucket", "root").agg(F.count("*").alias("here")).groupBy("bucket").agg(main)
            hubs = open_rows.join(main, "bucket").where("root <> main").groupBy("bucket").agg(hub.alias("hub"))
        else:
            hubs = open_rows.groupBy("bucket").agg(hub.alias("hub"))
        met = open_rows.join(hubs, "bucket").where(F.col("root") != F.col("hub.root"))
        pairs = met.select(F.least("name", "hub.name").alias("a"), F.greatest("name", "hub.name").alias("b")).distinct()
        linked = cut(_links(_likely(pairs, facts, percent, plan.likely), texts, shingle, percent), "links")
        edges = linked if edges is None else edges.unionAll(linked)
        roots = components(edges)
        edges = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        open_rows = _still_open(open_rows, roots)

    open_rows = _parted(open_rows, texts, shingle, plan)
    further = cut(_links_within(open_rows, facts, texts, shingle, percent, plan.likely), "more-links")
    if not further.isEmpty():
        roots = components(edges.unionAll(further))

    of_class = classes.select("name", "at").join(roots.withColumnRenamed("node", "name"), "name", "left").select("name", "at", F.coalesce("root", "name").alias("root"))
    of_class = cut(of_class, "class-roots")
    found = of_class.groupBy("root").agg(F.min("at").alias("first"))
    of_class = cut(of_class.join(found, "root").select("name", "first"), "class-components")
    alone, first = F.col("name").isNull(), F.col("first")
    return sketched.select("doc", "mark", "n", "name").join(of_class, "name", "left").select(
        F.col("doc").alias(id_col),
        "mark",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc")).otherwise(first["doc"]).alias("component_id"),
        (alone | F.col("doc").eqNullSafe(first["doc"])).alias("kept"),
        (alone | (F.col("doc").eqNullSafe(first["doc"]) & F.col("mark").eqNullSafe(first["mark"]))).alias("is_first"),
    )


def _texts(rows: DataFrame, classes: DataFrame, names: DataFrame) -> DataFrame:
    """(name, text) of the named classes: the text of one document each, written once."""
    wanted = classes.join(names, "name", "left_semi").select("name", F.coalesce("at.doc", F.lit(LONG_MIN)).alias("doc"), F.col("at.mark").alias("wanted"))
    texts = rows.select(F.coalesce("doc", F.lit(LONG_MIN)).alias("doc"), "mark", "text")
    return cut(texts.join(wanted, (texts["doc"] == wanted["doc"]) & texts["mark"].eqNullSafe(F.col("wanted"))).select("name", "text").dropDuplicates(["name"]), "texts")


def _still_open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows (bucket, name, weight, root) with new roots, of the buckets that hold more than one component."""
    renewed = rows.drop("root").join(roots.withColumnRenamed("node", "name"), "name", "left")
    renewed = cut(renewed.withColumn("root", F.coalesce("root", "name")), "labelled")
    mixed = renewed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return cut(renewed.join(mixed, "bucket", "left_semi"), "open-buckets")


def _parted(rows: DataFrame, texts: DataFrame, shingle: int, plan: Banding) -> DataFrame:
    """``rows`` with buckets of more than 2 * BLOCK classes parted by bands of second sketches, where that leaves a quarter of the pairs or less.

    Classes that are nearly similar enough, as texts of one template, share most second bands too: their bucket stays as it is.
    """
    large = rows.groupBy("bucket").agg(F.count("*").alias("held")).where(F.col("held") > 2 * BLOCK)
    inside = cut(rows.join(large.select("bucket"), "bucket", "left_semi"), "large-buckets")
    if inside.isEmpty():
        return rows
    bands = texts.join(inside.select("name").distinct(), "name", "left_semi").mapInArrow(lambda it: _second_bands(it, shingle, plan), "name bigint, bands array<bigint>")
    finer = inside.join(bands, "name").select("bucket", F.explode("bands").alias("band"), "name", "weight", "root")
    finer = cut(finer.select("bucket", F.xxhash64("bucket", "band").alias("finer"), "name", "weight", "root"), "finer-buckets")
    pairs = finer.groupBy("bucket", "finer").agg(F.count("*").cast("double").alias("n")).groupBy("bucket").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
    apart = pairs.join(large, "bucket").where(4 * F.col("pairs") <= F.col("held").cast("double") * F.col("held")).select("bucket")
    taken = finer.join(apart, "bucket", "left_semi").select(F.col("finer").alias("bucket"), "name", "weight", "root")
    mixed = taken.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return cut(rows.join(apart, "bucket", "left_anti").select("bucket", "name", "weight", "root").unionByName(taken.join(mixed, "bucket", "left_semi").select("bucket", "name", "weight", "root")), "parted-buckets")


def _links_within(rows: DataFrame, facts: DataFrame, texts: DataFrame, shingle: int, percent: int, likely: int) -> DataFrame:
    """Links (a, b) between different roots of the same bucket, at most one for each two roots of a block."""
    by_rows, by_shingles = F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)
    held = rows.join(facts.select("name", "n"), "name").groupBy("bucket").agg(F.greatest(by_rows, by_shingles).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("name"), F.col("parts").cast("bigint")).cast("int")
    dealt = rows.join(held, "bucket").withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "name", "root")
    grouped = lambda df: df.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    sketched = grouped(dealt.join(facts, "name")).select("bucket", "i", "j", "part", "name", "root", "n", *SIGNATURE)
    kind = "bucket bigint, i int, j int, part int, name bigint, root bigint"
    hopeful = cut(sketched.mapInArrow(lambda it: _block_likely(it, percent, likely), kind), "likely-in-blocks")
    blocks = grouped(hopeful.join(texts, "name"))
    return blocks.select("bucket", "i", "j", "part", "name", "root", "text").mapInArrow(lambda it: _block_links(it, shingle, percent), "a bigint, b bigint").distinct()


def _block_likely(batches: Iterator[pa.RecordBatch], percent: int, likely: int) -> Iterator[pa.RecordBatch]:
    """The rows of each block with a partner of another root that sizes and sketches allow."""
    kinds = pa.schema([("bucket", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("part", pa.int32()), ("name", pa.int64()), ("root", pa.int64())])

    def hopeful(block: pa.Table) -> pa.RecordBatch:
        part, root, n = (block.column(c).to_numpy() for c in ("part", "root", "n"))
        sketch = np.stack([block.column(c).to_numpy().view(np.uint64) for c in SIGNATURE], 1)
        within, found = part.min() == part.max(), np.zeros(len(n), bool)
        for at in range(0, len(n), 64):
            some = slice(at, at + 64)
            pair = (root[some, None] != root[None, :]) & (within | (part[some, None] != part[None, :]))
            pair &= (100 * n[some, None] >= percent * n[None, :]) & (100 * n[None, :] >= percent * n[some, None])
            x, y = np.nonzero(pair)
            differ = sketch[some][x] ^ sketch[y]
            differ |= differ >> np.uint64(1)
            differ |= differ >> np.uint64(2)
            close = SIZE - np.bitwise_count(differ & np.uint64(0x1111111111111111)).sum(1, dtype=np.int64) >= likely
            found[at + x[close]] = found[y[close]] = True
        return block.filter(pa.array(found)).select(kinds.names).cast(kinds)

    key, held = None, []
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("bucket", "i", "j")], 1)
        turns = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for a, b in zip([0, *turns.tolist()], [*turns.tolist(), len(keys)], strict=True):
            if a == b:
                continue
            if held and tuple(keys[a]) != key:
                yield from hopeful(pa.Table.from_batches(held)).to_batches()
                held = []
            key = tuple(keys[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield from hopeful(pa.Table.from_batches(held)).to_batches()


def _block_links(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    key, rows = None, []
    for batch in batches:
        at = 0
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "i", "j", "part", "name", "root")]
        # sets are kept, not texts: of one block and of one slice of the batch at a time
        for small in _short_slices(batch, ("text",), 256):
            sets = [s for _, _, data, offsets in chunks(small.column("text").fill_null("")) for s in shingle_sets(data, offsets, k)]
            for s in sets:
                here = tuple(c[at] for c in columns[:3])
                if here != key:
                    yield from _linked(rows, percent)
                    key, rows = here, []
                rows.append((*(c[at] for c in columns[3:]), s))
                at += 1
    yield from _linked(rows, percent)


def _linked(rows: list[tuple], percent: int) -> Iterator[pa.RecordBatch]:
    """Links of one block of (part, name, root, set)."""
    if len(rows) < 2:
        return
    part, name, root = (np.array([r[c] for r in rows], np.int64) for c in range(3))
    sets = [r[3] for r in rows]
    sizes = np.array([len(s) for s in sets], np.int64)
    common = np.zeros((len(rows), len(rows)), np.int64)
    # ranges of the shingles' hashes, each of about SLICE shingles: beside the sets only one range is worked on
    ranges = -(-int(sizes.sum()) // SLICE)
    ends = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    cuts = np.array([[0, *np.searchsorted(s, ends), len(s)] for s in sets], np.int64)
    for turn in range(ranges):
        inside = [s[c[turn] : c[turn + 1]] for s, c in zip(sets, cuts, strict=True)]
        _, code, often = np.unique(np.concatenate(inside), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(rows)), [len(s) for s in inside])
        shared = often[code] > 1
        code, owner = (np.cumsum(often > 1) - 1)[code[shared]], owner[shared]
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        for first in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
            a, b = np.searchsorted(code, (first, first + 4096))
            table = np.zeros((len(rows), 4096), np.float32)
            table[owner[a:b], code[a:b] - first] = 1
            common += (table @ table.T).astype(np.int64)
    apart = (root[:, None] != root[None, :]) & ((part[:, None] != part[None, :]) | (part.min() == part.max()))
    x, y = np.nonzero(np.triu(apart & (100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)), 1))
    if len(x):
        ends = np.sort(np.stack([root[x], root[y]], 1), axis=1)
        _, one = np.unique(ends, axis=0, return_index=True)
        yield pa.RecordBatch.from_pydict({"a": name[x[one]], "b": name[y[one]]})


def _likely(pairs: DataFrame, facts: DataFrame, percent: int, likely: int) -> DataFrame:
    """Those of the pairs (a, b) that sizes and sketches allow."""
    left = pairs.alias("p").join(facts.alias("l"), F.col("p.a") == F.col("l.name"))
    return left.join(facts.alias("r"), (F.col("p.b") == F.col("r.name")) & _alike(percent, likely)).select("a", "b")


def _links(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    one = texts.select(F.col("name").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("name").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(lambda it: _verified(it, shingle, percent), "a bigint, b bigint")


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component of near_duplicates(), columns unchanged. Of rows equal in id and text one stays."""
    found = cut(near_duplicates(docs, shingle, percent).select("doc_id", "mark", "is_first"), "near-duplicates")
    some = lambda c: F.coalesce(c.cast("bigint"), F.lit(LONG_MIN))
    out = found.where("NOT is_first").select(some(F.col("doc_id")).alias("doc"), "mark").distinct()
    table, back = seal(docs, doc=some(docs["doc_id"]), mark=F.xxhash64(docs["text"]))
    kept = table.join(out, ["doc", "mark"], "left_anti")
    repeated = not found.where("is_first").groupBy("doc_id", "mark").count().where("count > 1").isEmpty()
    return (kept.dropDuplicates(["doc", "mark"]) if repeated else kept).select(*back)
