"""Periodic runs of words: a descending-LCP Kruskal over the suffixes of each text."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import let, seal, words_of

RUN = "start:bigint,length:bigint,period:bigint"
#: Texts of a batch are taken together up to so many words; a longer text is alone.
TOGETHER = 500_000


def _ranks(ids: np.ndarray) -> list[np.ndarray]:
    """By k: each position's rank among all stretches of 2**k symbols, equal stretches sharing one; up to the k at which all differ.

    Prefix doubling that sorts only positions whose stretch isn't unique yet. A unique position's rank no longer changes, so one array a level is kept.
    """
    n = len(ids)
    _, inverse, sizes = np.unique(ids, return_inverse=True, return_counts=True)
    first = np.cumsum(sizes) - sizes
    rank = first[inverse].astype(np.int64)
    levels, active, h = [rank], np.flatnonzero(sizes[inverse] > 1), 1
    while len(active):
        ahead = active + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1) + 1
        key = rank[active] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        key, at = key[order], active[order]
        new = np.r_[True, key[1:] != key[:-1]]
        old = rank[at]
        fresh = np.r_[True, old[1:] != old[:-1]]
        here = np.arange(len(at))
        begin = np.maximum.accumulate(np.where(new, here, 0))
        group = np.maximum.accumulate(np.where(fresh, here, 0))
        rank = rank.copy()
        rank[at] = old + begin - group
        single = new & np.r_[new[1:], True]
        active = np.sort(at[~single])
        levels.append(rank)
        h *= 2
    return levels


def _neighbours(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix of each with the next): those that share ``least`` symbols with another; 0 where less is shared."""
    levels = _ranks(ids)
    last = levels[-1]
    k = min(least.bit_length() - 1, len(levels) - 1)
    _, inverse, sizes = np.unique(levels[k], return_inverse=True, return_counts=True)
    at = np.flatnonzero(sizes[inverse] > 1)
    at = at[np.argsort(last[at])]
    a, b = at[:-1], at[1:]
    common = np.zeros(len(a), dtype=np.int64)
    for power in range(len(levels) - 1, -1, -1):
        # a text ends with a symbol of its own, so nothing common passes the end
        level = levels[power]
        common += np.where(level[a + common] == level[b + common], 1 << power, 0)
    return at, np.where(common >= least, common, 0)


def runs_of(ids: np.ndarray, least_length: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all runs with length >= max(least_length, exponent * period), in no order. Every text in ``ids`` ends with a symbol of its own.

    Classes of suffixes, at first one a suffix, are united by falling length of their common prefix. Where two positions x < y become neighbours
    in a class of common prefix l >= y - x, the stretch from x to y + l has period y - x and can't go on; a shorter period would have put
    another position of the class between them. It is a run if the symbol before x doesn't continue the period either.
    """
    # a run of period q shares length - q symbols with itself: (exponent - 1) * q, or least_length - q, whichever is more
    least = min(max((exponent - 1) * q, least_length - q) for q in range(1, least_length + 1))
    at, common = _neighbours(ids, max(least, 1))
    order = np.argsort(-common, kind="stable")[: np.count_nonzero(common)]
    if not len(order):
        return []
    places, parent, members, after, out = at.tolist(), list(range(len(at))), {}, {}, []
    lengths, pairs = common[order].tolist(), order.tolist()

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    i, n = 0, len(pairs)
    while i < n:
        level, before = lengths[i], {}
        while i < n and lengths[i] == level:
            a, b = find(pairs[i]), find(pairs[i] + 1)
            i += 1
            big, small = members.get(a) or [places[a]], members.get(b) or [places[b]]
            if len(big) < len(small):
                a, b, big, small = b, a, small, big
            for x in small:
                k = bisect_left(big, x)
                if k:
                    before.setdefault(big[k - 1], after.get(big[k - 1]))
                    after[big[k - 1]] = x
                if k < len(big):
                    before.setdefault(x, after.get(x))
                    after[x] = big[k]
                big.insert(k, x)
            parent[b] = a
            members[a] = big
            members.pop(b, None)
        for x, old in before.items():
            q = after[x] - x
            if after[x] != old and q * (exponent - 1) <= level and q + level >= least_length and ids[x - 1] != ids[x + q - 1]:
                out.append((x, q + level, q))
    return out


def _batched(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    begin, held = 0, 0
    for i, words in enumerate(texts):
        if held and held + len(words) > TOGETHER:
            yield begin, i
            begin, held = i, 0
        held += len(words) + 1
    if begin < len(texts):
        yield begin, len(texts)


def runs_in_texts(texts: list[list[bytes]], least_length: int, exponent: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start and then period. Words are numbered within their text, so texts share no suffix class."""
    out: list[list[tuple[int, int, int]]] = []
    for a, b in _batched(texts):
        ids, ends, base = [], [], 0
        for words in texts[a:b]:
            own: dict[bytes, int] = {}
            ids += [base + own.setdefault(w, len(own)) for w in words]
            base += len(own) + 1
            ids.append(base - 1)
            ends.append(len(ids))
        found = [[] for _ in range(b - a)]
        begins = np.array([0, *ends[:-1]])
        runs = runs_of(np.array(ids, dtype=np.int64), least_length, exponent)
        for (start, length, period), t in zip(runs, np.searchsorted(ends, [r[0] for r in runs], "right").tolist(), strict=True):
            found[t].append((start - int(begins[t]), length, period))
        out += [sorted(r, key=lambda r: (r[0], r[2])) for r in found]
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    keep = np.cumsum(edges[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def find_runs(docs: DataFrame, least_length: int = 6, exponent: int = 4, text: str = "text") -> DataFrame:
    r"""``docs`` plus ``runs``, an array of (start, length, period) by start and then period, and ``collapsed``, the text without the repetitions.

    Words are maximal stretches outside ``[\x20\x09-\x0D]``, numbered from 0. A run is a stretch of words with smallest period q, no shorter than
    ``least_length`` and ``exponent`` times q (2 or more), that no neighbouring word extends keeping period q. ``collapsed`` joins the words by one
    space without those that a run holds after its first q words. Each text is worked on whole, in the task that reads it: nothing is shuffled.
    A task holds some numbers a word of up to half a million words of a batch, for each doubling up to the longest repetition.

    Defined cases: null and empty texts have no runs and an empty ``collapsed``; equal rows each get their own result; a very long text takes memory
    with its words; input columns with the names of the results are replaced; an empty table gives an empty result.
    """
    table, back = seal(docs, ["runs", "collapsed"], text=F.col(f"`{text}`").cast("string"))
    carried = table.schema.names[:-1]
    run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.split() parts at exactly the white space of the contract
            texts = [t.encode().split() if t else [] for t in batch.column(len(carried)).to_pylist()]
            found = runs_in_texts(texts, least_length, exponent)
            offsets = np.cumsum([0, *map(len, found)])
            flat = np.array([r for runs in found for r in runs], dtype=np.int64).reshape(-1, 3)
            runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, i].copy()) for i in range(3)], fields=list(run)))
            kept = pa.array([_collapsed(w, r).decode() for w, r in zip(texts, found, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carried)], runs, kept], [*carried, "runs", "collapsed"])

    numbers = StructType([StructField(f.name, LongType()) for f in run])
    schema = StructType([*table.schema.fields[:-1], StructField("runs", ArrayType(numbers)), StructField("collapsed", StringType())])
    return table.mapInArrow(searched, schema).select(*back, "runs", "collapsed")


def plant_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with a periodic end in every tenth text, by the hash of its id: words from place a on repeat the p words there."""
    table, back = seal(docs, [text], id=F.col(f"`{id_col}`"), text=F.col(f"`{text}`").cast("string"))
    h = F.crc32(F.col("id").cast("string").cast("binary"))
    n, g = F.size("words").cast("bigint"), F.floor(h / 10)

    def periodic(words: Column) -> Column:
        a = g % n
        return let(F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p")), lambda c: F.array_join(F.transform(words, lambda w, i: F.when(i < c["a"], w).otherwise(F.get(words, (c["a"] + (i - c["a"]) % c["p"]).cast("int")))), " "))

    planted = table.withColumn("words", F.when(h % 10 == 0, words_of(F.col("text"))))
    return planted.select(*back, F.when(F.size("words") > 0, let(F.col("words"), periodic)).otherwise(F.col("text")).alias(text))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of find_runs(): number of runs, the one of greatest exponent, and hashes of all runs and of the collapsed text."""
    greater = lambda a, r: a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"])
    best = F.aggregate("runs", F.lit(None).cast(f"struct<{RUN}>"), lambda a, r: F.when(greater(a, r), r).otherwise(a))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    rows = found.withColumn("best", best)
    return rows.select(
        id_col, F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
