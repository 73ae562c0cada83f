"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LONG_MIN, cut, seal
from .text_arrays import RUN_CLASS, chunks, mix, run_hashes


@dataclass(frozen=True)
class Params:
    """buckets: of the hashed features. tempered_at: number of features from which on a text's weight is tempered, see resample().
    max_labelled: labelled rows used, those of the smallest id hashes. held_out: one in so many of them only calibrates.
    spare: how many times worse it is to lose a good share of rows than to keep as large a share of bad ones.
    smoothing: added to each bucket's counts."""

    buckets: int = 1 << 16
    tempered_at: int = 200
    max_labelled: int = 50_000
    held_out: int = 5
    spare: float = 5.0
    smoothing: float = 1.0


def features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each feature, first feature of each row and the end).

    Tokens are runs of letters and digits or of other characters, case kept. A
    token gives itself and the pair with its successor in the row; a token that
    repeats itself gives one common pair whatever it is.
    """
    words, first = run_hashes(data, offsets, RUN_CLASS)
    if not len(words):
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    following = np.append(words[1:], np.uint64(0))
    pairs = mix(mix(words) + following)
    pairs[words == following] = np.uint64(12345)
    ends = first[1:][first[1:] > first[:-1]] - 1  # the last token of a row has no successor
    pairs[ends] = mix(words[ends] + np.uint64(99))
    both = np.empty(2 * len(words), np.uint64)
    both[0::2], both[1::2] = words, pairs
    return (mix(both) % np.uint64(buckets)).astype(np.int64), 2 * first


def _counts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for batch in batches:
        goal = np.asarray(batch.column("fit").fill_null(False))
        for a, b, data, offsets in chunks(batch.column("text")):
            found, first = features(data, offsets, buckets)
            raw += np.bincount(found, minlength=buckets)
            row = np.repeat(goal[a:b], np.diff(first))
            target += np.bincount(found[row], minlength=buckets)
    held = np.flatnonzero(raw)
    yield pa.RecordBatch.from_pydict({"bucket": held, "raw": raw[held], "target": target[held]})


def _scores(batches: Iterator[pa.RecordBatch], ratio: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, n = np.zeros(len(batch)), np.zeros(len(batch), np.int64)
        for a, b, data, offsets in chunks(batch.column("text")):
            found, first = features(data, offsets, len(ratio))
            n[a:b] = np.diff(first)
            some = np.flatnonzero(n[a:b])
            if len(some):  # each row by itself, so that its sum doesn't depend on the rows beside it
                total[a + some] = np.add.reduceat(ratio[found], first[some])
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "mark": batch.column("mark"), "log_ratio": total, "n_features": n, "held": batch.column("held")})


def gumbel(*keys: Column) -> Column:
    """A standard Gumbel variate that the keys decide, the same in every run and attempt."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(20), *keys), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def top_k_cut(scores: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest value of ``key``, exactly, by counting in ever finer cells; None if k is 0."""
    if k <= 0:
        return None
    ends = scores.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    low, high, above = ends.lo, ends.hi, 0
    while high > low:
        step = (high - low) / 1024
        if low + step <= low or high - step >= high:
            break
        cell = F.least(F.lit(1023), F.floor((F.col(key) - low) / step)).cast("int")
        inside = scores.where((F.col(key) >= low) & (F.col(key) <= high)).groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
        for r in sorted(inside, key=lambda r: -r.cell):
            if above + r.n >= k:
                low, high = r.lo, r.hi
                break
            above += r.n
    return low


def best_cut(good: list[float], bad: list[float], spare: float) -> float:
    """The cut with the least share of bad rows at or above it plus ``spare`` times the share of good rows below it.

    Between equally good neighbouring values it takes the middle of the widest gap.
    """
    if not good or not bad:
        return -math.inf
    g, b = np.sort(good), np.sort(bad)
    values = np.unique(np.concatenate([g, b]))
    below = np.searchsorted(g, values, "left") / len(g)
    kept = 1 - np.searchsorted(b, values, "left") / len(b)
    loss = spare * below + kept
    gap = np.diff(values, prepend=values[0] - 1)
    at = max(np.flatnonzero(loss <= loss.min() + 1e-12), key=lambda i: gap[i])
    return float(values[at] - gap[at] / 2)


def resample(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """(doc_id, mark, log_weight, sort_key, kept): importance resampling of documents towards the text labelled good.

    Two generative models of hashed unigrams and bigrams are counted over all
    documents (raw) and over those labelled quality 1 (target). A document's log
    importance weight is the log ratio of its probabilities under target and raw, the sum over all its
    features, divided by a temperature of 1 for up to ``tempered_at`` features and of n / tempered_at for n of them:
    long texts weigh as a text of that length with the same mix of features would, as in the published method, which
    cuts all texts to one length. Gumbel noise
    added to it makes the top k a sample without replacement with probabilities
    in proportion to the weights. k is the number of documents whose weight
    reaches the cut that parts good from bad held-out labelled rows best, so
    junk decides how many documents go, not a quota.

    Labels are fitted on at most ``max_labelled`` rows, which are broadcast;
    counts and scores cover all documents. ``mark`` is the hash of the text.

    Defined cases: null and empty texts have weight 0; a very long text is hashed in pieces, whole; rows equal in id and text
    are treated alike and have the same key; ties at the cut are kept; without
    good or without bad held-out rows, or with no document, everything is kept; labels that
    contradict each other or are null count as not good; other columns aren't used.
    """
    p = params
    rated = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("quality"))
    sample = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_labelled)
    aside = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(p.held_out)) == 0
    sample = sample.select("doc_id", (~aside & (F.col("quality") == 1)).alias("fit"), F.when(aside, F.col("quality")).alias("held"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).join(F.broadcast(sample), "doc_id", "left")
    counted = texts.select("text", "fit").mapInArrow(lambda it: _counts(it, p.buckets), "bucket bigint, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.full(p.buckets, p.smoothing), np.full(p.buckets, p.smoothing)
    for r in counted.collect():  # at most one row a bucket
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    # shrunk towards the raw model, so that a bucket the target has not met by chance says little
    rate = raw / raw.sum()
    ratio = np.log((target + 5 * rate * p.buckets) / (target.sum() + 5 * p.buckets)) - np.log(rate)
    scored = cut(
        texts.select("doc_id", "text", "mark", "held").mapInArrow(lambda it: _scores(it, ratio), "doc_id bigint, mark bigint, log_ratio double, n_features bigint, held int"),
        "scores",
    )
    temperature = F.greatest(F.lit(1.0), F.col("n_features") / p.tempered_at)
    weighed = scored.withColumn("log_weight", F.col("log_ratio") / temperature)
    rated_rows = weighed.where("held IS NOT NULL").select("log_weight", "held").collect()  # those held out of max_labelled
    floor = best_cut([r.log_weight for r in rated_rows if r.held == 1], [r.log_weight for r in rated_rows if r.held != 1], p.spare)
    keyed = weighed.withColumn("sort_key", F.col("log_weight") + gumbel(F.col("doc_id"), F.col("mark")))
    k = weighed.where(F.col("log_weight") >= F.lit(floor)).count()
    least = top_k_cut(keyed, "sort_key", k)
    kept = F.col("sort_key") >= F.lit(least) if least is not None else F.lit(False)
    return keyed.select("doc_id", "mark", "log_weight", "sort_key", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents that resample() keeps, columns unchanged."""
    some = lambda c: F.coalesce(c, F.lit(LONG_MIN))
    out = resample(docs, labels, params).where("NOT kept").select(some(F.col("doc_id")).alias("doc"), "mark").distinct()
    table, back = seal(docs, doc=some(docs["doc_id"].cast("bigint")), mark=F.xxhash64(docs["text"]))
    return table.join(out, ["doc", "mark"], "left_anti").select(*back)
