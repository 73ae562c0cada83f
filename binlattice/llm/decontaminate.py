"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LONG_MIN, cut, let, row_key, seal, windows_hash

SHINGLE = 5
BLOCKS = 8
#: Tables of at most so many rows, or words of items, are broadcast after they were counted; larger ones are joined by shuffles.
SMALL = 1_000_000


def near_bits(threshold: float) -> int:
    """The distance within a block of 8 bits that is looked up exactly, for windows as similar as ``threshold``.

    Fingerprints within BLOCKS * (near + 1) - 1 bits have a block within ``near`` bits. Of two windows of one length and
    similarity s the cosine is 2s / (1 + s), and a bit differs with a probability of its angle over pi: the radius
    lies four and a half standard deviations beyond the mean. At 0.8 the mean is under 10 bits, near is 2, the radius 23.
    """
    differ = math.acos(min(1.0, 2 * threshold / (1 + threshold))) / math.pi
    most = 64 * differ + 4.5 * math.sqrt(64 * differ * (1 - differ))
    return next(near for near in range(9) if BLOCKS * (near + 1) - 1 >= math.floor(most))


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(ws: Column) -> Column:
    """Shingle hashes of a word array, with multiplicity; of fewer than SHINGLE words, one for the whole."""

    def of(wh: Column) -> Column:
        out = F.when(F.size(wh) >= SHINGLE, windows_hash(wh, SHINGLE))
        for n in range(1, SHINGLE):
            out = out.when(F.size(wh) == n, windows_hash(wh, n))
        return out.otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(ws, lambda w: F.xxhash64(w)), of)


def _texts(ws: Column) -> Column:
    """The same shingles as strings."""
    return F.when(
        F.size(ws) >= SHINGLE,
        F.transform(F.sequence(F.lit(1), F.size(ws) - SHINGLE + 1), lambda i: F.array_join(F.slice(ws, i, F.lit(SHINGLE)), " ")),
    ).otherwise(F.array(F.array_join(ws, " ")))


def _majority(hashes: Column, width: int) -> Column:
    """Bits that more than half of the hashes have, counted in lanes of ``width`` bits.

    ``width`` sums, each of 64 / width lanes, count all 64 bits in one pass.
    """
    lanes = sum(1 << (width * j) for j in range(64 // width))
    top = width - 2  # the highest bit would overflow a signed long
    zero = F.array(*[F.lit(0).cast("bigint") for _ in range(width)])
    summed = F.aggregate(hashes, zero, lambda acc, h: F.array(*[F.get(acc, F.lit(k)) + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(lanes)) for k in range(width)]))

    def folded(acc: Column) -> Column:
        # a count over n div 2 reaches bit ``top`` of its lane once 2**top - 1 - n div 2 is added
        lift = (F.lit((1 << top) - 1).cast("bigint") - F.floor(F.size(hashes) / 2)) * F.lit(lanes)
        out = F.lit(0).cast("bigint")
        for k in range(width):
            out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(F.get(acc, F.lit(k)) + lift, top).bitwiseAND(F.lit(lanes)), k))
        return out

    return let(summed, folded)


def simhash(hashes: Column) -> Column:
    """64 bits; bit b is set where more than half of the hashes, with multiplicity, have it."""
    return let(hashes, lambda h: F.when(F.size(h) <= 30_000, _majority(h, 16)).otherwise(_majority(h, 32)))


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two shingle arrays, weights being multiplicities."""

    def of(a: Column, b: Column) -> Column:
        count = lambda arr, s: F.size(F.filter(arr, lambda x: x == s))
        common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, s: n + F.least(count(a, s), count(b, s)))
        return let(common, lambda c: c / (F.size(a) + F.size(b) - c))

    return let(a, lambda x: let(b, lambda y: of(x, y)))


def _anchors(ordered: Column, size: Column, missing: float) -> Column:
    """The first distinct shingles of an item in the given order, so many that a window missing at most the share ``missing`` of all has one.

    A window of the item's length has the same number m of shingles. With e of the item's missing, similarity is
    (m - e) / (m + e) at most, so a similar window misses at most m * (1 - threshold) / (1 + threshold). A shorter one
    may have no others, which gives (m - e) / m, so it misses at most m * (1 - threshold). Any such number of shingles will do.
    """
    return F.slice(ordered, F.lit(1), (F.floor(size * missing + 1e-9) + 1).cast("int"))


def _first_near_block(a: Column, b: Column, near: int) -> Column:
    """The first block in which two fingerprints differ by at most ``near`` bits."""
    differ = a.bitwiseXOR(b)
    return F.coalesce(*[F.when(F.bit_count(F.shiftrightunsigned(differ, 8 * k).bitwiseAND(F.lit(255))) <= near, F.lit(k)) for k in range(BLOCKS)])


def _blocks(fp: Column) -> Column:
    return F.array(*[F.shiftrightunsigned(fp, 8 * k).bitwiseAND(F.lit(255)) for k in range(BLOCKS)])


def _sized(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= SMALL else table.hint("shuffle_hash")


def _indexed(benchmark: DataFrame, threshold: float) -> DataFrame:
    """(item_no, item_id, item_words, n, item_sh, item_fp, anchors, few_anchors) of the items with words, once each.

    Anchors are the shingles that the fewest items have: what many items share is the likeliest to be in many documents.
    """
    words_ = benchmark.select("item_id", words(F.col("text")).alias("item_words")).where(F.size("item_words") > 0)
    plain = words_.select("item_id", "item_words", F.size("item_words").alias("n"), _shingles(F.col("item_words")).alias("item_sh"), F.xxhash64("item_id", "item_words").alias("item_no")).dropDuplicates(["item_no"])
    plain = cut(plain, "items")
    each = plain.select("item_no", F.explode(F.array_distinct("item_sh")).alias("h"))
    rare = each.join(each.groupBy("h").agg(F.count("*").alias("held")), "h").groupBy("item_no").agg(F.transform(F.sort_array(F.collect_list(F.struct("held", "h"))), lambda x: x["h"]).alias("ordered"))
    size = F.size("item_sh")
    # for documents shorter than the item; where not a shingle may be missing, none of them is similar
    few = F.when(size * (1 - threshold) >= 1 - 1e-9, _anchors(F.col("ordered"), size, 1 - threshold)).otherwise(F.array().cast("array<bigint>"))
    return cut(
        plain.join(rare, "item_no").select("item_no", "item_id", "item_words", "n", "item_sh", simhash(F.col("item_sh")).alias("item_fp"), _anchors(F.col("ordered"), size, (1 - threshold) / (1 + threshold)).alias("anchors"), few.alias("few_anchors")),
        "indexed-items",
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, batch_anchors: int = 100_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, item_id, similarity, start_word, n_words): documents holding a window like a benchmark item.

    A window is as long, in words, as the item; a document shorter than the item
    is one window for it. Its SimHash is compared with
    those of the items of that length: 8 blocks of 8 bits, in one of which two
    fingerprints within the radius differ by at most near_bits() bits, so an equi-join on
    (length, block, value) finds all of them: 23 bits at a threshold of 0.8. Weighted Jaccard similarity of the
    5-word shingles (multiplicities as weights) then decides exactly.

    Fingerprints are made only for windows that can qualify: a window as
    similar as ``threshold`` holds one of an item's anchors (see _anchors), so windows
    without any anchor are left out before, without loss. Anchors go into
    the scan as a literal set of about ``batch_anchors``; a larger benchmark takes several scans.

    The words of a document with anchors are written once. From there on a window is its place and its
    fingerprint, and its words are looked at again only where a fingerprint is near an item's. The index and the
    items' words are broadcast only if they are counted to be small; what grows with the documents never is by a hint.

    One row for each document and item, with its most similar, then first,
    window. ``mark`` is the hash of the text, which tells documents with the same id apart.

    Defined cases: null and empty texts hold nothing; items without words match
    nothing; items under 5 words are one shingle, matched as a whole; a document
    shorter than an item is compared as a whole, n_words being its own words; a text of any length
    is searched as a whole, in one task; items equal in text with different ids
    are each reported; a null id is reported as null; rows equal in id and text
    are reported once; other columns aren't used.
    """
    near = near_bits(threshold)
    radius = BLOCKS * (near + 1) - 1
    items = _indexed(benchmark, threshold)
    held = items.agg(F.sum(F.size("anchors") + F.size("few_anchors")).alias("anchors"), F.max("n").alias("longest"), F.count("*").alias("items"), F.sum("n").alias("words")).first()
    doc, mark = row_key(docs, id_col, text_col)
    base = docs.select(doc.alias("doc"), mark.alias("mark"), words(F.col(text_col)).alias("w"))
    batches = max(1, -(-(held.anchors or 0) // batch_anchors))
    anchored, found = [], []
    for b in range(batches):
        batch = items.where(F.pmod("item_no", F.lit(batches)) == b)
        anchored.append(cut(_anchored(base, batch, held.longest or 1), "anchored-documents"))
        found.append(_windows(anchored[-1], batch, threshold))
    windows = cut(reduce(DataFrame.unionAll, found), "windows")
    with_words = reduce(DataFrame.unionAll, anchored).select("doc", "mark", "w").dropDuplicates(["doc", "mark"])

    masks = [m for m in range(256) if m.bit_count() <= near]
    index = items.select("item_no", "n", "item_fp", F.posexplode(_blocks(F.col("item_fp"))).alias("block", "own")).select(
        "item_no", "n", "item_fp", "block", F.explode(F.transform(F.array(*[F.lit(m).cast("bigint") for m in masks]), lambda m: m.bitwiseXOR(F.col("own")))).alias("value")
    )
    prints = windows.select("n", "fp").distinct().select("n", "fp", F.posexplode(_blocks(F.col("fp"))).alias("block", "value"))
    matches = cut(
        prints.join(_sized(index, held["items"] * BLOCKS * len(masks)), ["n", "block", "value"])
        .where((F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius) & (F.col("block") == _first_near_block(F.col("fp"), F.col("item_fp"), near)))
        .select("n", "fp", "item_no"),
        "near-fingerprints",
    )
    places = windows.join(matches, ["n", "fp"]).groupBy("doc", "mark", "item_no").agg(F.collect_set("start").alias("starts"))
    pairs = places.join(with_words, ["doc", "mark"]).join(_sized(items.select("item_no", "item_id", "item_words", "item_sh", "n"), held["words"] or 0), "item_no")

    def compared(start: Column) -> Column:
        """(similarity, -start, words) of a window; no similarity where too few of its hashes are among the item's for the exact sum to matter."""
        return let(F.slice(F.col("w"), start + 1, F.col("n")), lambda ws: F.struct(F.when(_hopeful(ws, threshold), similarity(_texts(ws), _texts(F.col("item_words")))).alias("similarity"), (-start).alias("rank"), F.size(ws).alias("n_words")))

    scored = cut(pairs.select("doc", "mark", "item_id", "item_no", F.array_max(F.transform("starts", compared)).alias("best")), "compared-windows")
    return (
        scored.where(F.col("best.similarity") >= threshold - 1e-9)
        .select(
            F.when(F.col("doc") != LONG_MIN, F.col("doc")).alias(id_col),
            "mark",
            "item_id",
            F.col("best.similarity").alias("similarity"),
            (-F.col("best.rank")).cast("bigint").alias("start_word"),
            F.col("best.n_words").cast("bigint").alias("n_words"),
        )
    )


def _hopeful(ws: Column, threshold: float) -> Column:
    enough = lambda c, n: c >= threshold * (n + F.size("item_sh") - c) - 1e-9
    return let(_shingles(ws), lambda sh: let(F.size(F.filter(sh, lambda h: F.array_contains("item_sh", h))), lambda c: enough(c, F.size(sh))))


def _anchored(base: DataFrame, items: DataFrame, longest: int) -> DataFrame:
    """(doc, mark, w, hits): the documents with anchors of these items, and the (place, hash, words) of each."""
    anchors = items.select(F.explode("anchors").alias("h"), "n", F.lit(False).alias("few")).union(items.select(F.explode("few_anchors"), "n", F.lit(True))).distinct()
    known = [(r.h, min(r.n, SHINGLE), r.few) for r in anchors.collect()]  # at most a batch
    sets = {k: sorted({h for h, size, few in known if size == k and not few}) for k in range(1, SHINGLE + 1)}
    # the lowest long has no literal of its own
    listed = lambda own: ",".join(f"{h}L" if h > LONG_MIN else f"({h + 1}L - 1L)" for h in own) or "null"
    tests = {k: f"h IN ({listed(own)})" for k, own in sets.items() if own} or {SHINGLE: "false"}
    # only items of more than SHINGLE words have these, and only documents shorter than the longest item are asked for them
    more = sorted({h for h, _, few in known if few} - set(sets[SHINGLE]))

    hashes = let(F.transform(F.col("w"), lambda w: F.xxhash64(w)), lambda wh: F.struct(F.size(wh).alias("n"), *[windows_hash(wh, k).alias(f"hs{k}") for k in tests]))
    if more:
        tests = {k: f"{test} OR (hs.n < {longest} AND h IN ({listed(more)}))" if k == SHINGLE else test for k, test in tests.items()}
    found = ", ".join(f"array_compact(transform(hs.hs{k}, (h, i) -> if({test}, named_struct('p', i, 'h', h, 'k', {k}), null)))" for k, test in tests.items())
    # as a generator, the search is neither repeated in a filter nor taken apart by one
    one = F.expr(f"transform(array(hs), hs -> concat({found}))")
    return base.withColumn("hs", hashes).select("doc", "mark", "w", F.explode(F.filter(one, lambda hits: F.size(hits) > 0)).alias("hits"))


def _windows(anchored: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """(doc, mark, n, start, fp): all windows of items' lengths around the anchors of these items.

    ``n`` is the item's length; a document of fewer words is one window, if it has shingles enough to be similar. A
    document's windows of a length are found from the places of its anchors, each once.
    """
    anchors = items.select(F.explode("anchors").alias("h"), "n", F.lit(False).alias("few")).union(items.select(F.explode("few_anchors"), "n", F.lit(True))).distinct()
    hits = anchored.select("doc", "mark", F.size("w").alias("words"), F.inline("hits"))
    short = F.col("words") < F.col("n")
    alike = F.col("words") - (SHINGLE - 1) >= threshold * (F.col("n") - (SHINGLE - 1)) - 1e-9
    fits = (F.col("few") == short) & (~short | alike) & (F.least("n", F.lit(SHINGLE)) == F.col("k"))
    placed = hits.join(anchors, "h").where(fits).groupBy("doc", "mark", "n").agg(F.collect_set("p").alias("places"))
    n = F.col("n")

    def starts(size: Column) -> Column:
        around = lambda p: F.sequence(F.greatest(F.lit(0), p - (n - F.least(n, F.lit(SHINGLE)))), F.least(p, size - n))
        return F.when(size < n, F.array(F.lit(0))).otherwise(F.array_distinct(F.flatten(F.transform("places", around))))

    # of items of SHINGLE words or more the hashes of a whole document's shingles are made once and cut to windows
    usual = (n >= SHINGLE) & (F.size("w") >= n)
    by_slice = let(
        let(F.transform(F.col("w"), lambda w: F.xxhash64(w)), lambda wh: windows_hash(wh, SHINGLE)),
        lambda hs: F.transform(starts(F.size("w")), lambda s: F.struct(s.alias("start"), simhash(F.slice(hs, s + 1, n - (SHINGLE - 1))).alias("fp"))),
    )
    by_words = F.transform(starts(F.size("w")), lambda s: F.struct(s.alias("start"), simhash(_shingles(F.slice(F.col("w"), s + 1, n))).alias("fp")))
    met = placed.join(anchored.select("doc", "mark", "w").dropDuplicates(["doc", "mark"]), ["doc", "mark"])
    return met.select("doc", "mark", "n", F.inline(F.when(usual, by_slice).otherwise(by_words)))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without a window like a benchmark item, columns unchanged; see find_leaks."""
    leaks = find_leaks(docs, benchmark, threshold, id_col=id_col, text_col=text_col)
    bad = leaks.select(F.coalesce(F.col(id_col), F.lit(LONG_MIN)).alias("doc"), "mark").distinct()
    doc, mark = row_key(docs, id_col, text_col)
    table, back = seal(docs, doc=doc, mark=mark)
    return table.join(bad, ["doc", "mark"], "left_anti").select(*back)
