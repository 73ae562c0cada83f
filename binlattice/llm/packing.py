"""Best-fit packing of token pieces into sequences: bin completion over the histogram of lengths."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: The pre-token pattern of byte-level BPE, and the part of it that matters only where white space follows white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LOOKAHEAD = r"|\s+(?!\S)"
#: White space other than space and line feed, in any Unicode version or regex dialect; and the pairs of those two.
RARE_BLANK = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
BLANK_PAIRS = ("  ", " \n", "\n ", "\n\n")


def _vocabulary_bytes() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_ranks(tokenizer_file: str) -> dict[bytes, int] | None:
    """The ranks of a byte-level BPE file if merging by rank gives what the file's merges give, else None.

    That holds for the fixed pre-token pattern without normaliser, with merges in the order of their ids. Checked on the driver, once.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        given = json.load(f)
    model, cutter = given["model"], given["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not given["normalizer"] and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter["add_prefix_space"]
    if not plain or model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    byte_of, added = _vocabulary_bytes(), {t["content"] for t in given["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"]["".join(p)] for p in pairs]
    return ranks if ids == sorted(ids) and len(ranks) == 256 + len(set(ids)) else None


class Encoder:
    """Ids of a tokenizer file as little-endian unsigned 32-bit bytes, as the tokenizers library gives them without added special tokens.

    Where ``ranks`` are given (see byte_ranks), texts go through tiktoken, which is some times faster: with the whole pattern, or without its
    look-ahead where no white space follows white space, as the look-ahead can't match there. Texts that hold a special string go to the library.
    """

    def __init__(self, tokenizer_file: str, ranks: dict[bytes, int] | None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.whole = self.fast = None
        if ranks:
            import tiktoken

            self.whole = tiktoken.Encoding("whole", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self.fast = tiktoken.Encoding("fast", pat_str=PATTERN.replace(LOOKAHEAD, ""), mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        if self.whole is None or any(s in text for s in self.special):
            found = self.library.encode(text, add_special_tokens=False).ids
        elif any(p in text for p in BLANK_PAIRS) or RARE_BLANK.search(text):
            found = self.whole(text)
        else:
            found = self.fast(text)
        return np.array(found, dtype="<u4").tobytes()


def _pieces(tokenizer_file: str, ranks: dict[bytes, int] | None, limit: int, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, last = Encoder(tokenizer_file, ranks), np.array([end], dtype="<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            at, piece, start, length, ids, rank = [], [], array("q"), array("q"), [], array("q")
            for i, text in enumerate(batch.column(1).to_pylist()):
                raw = encoder.ids(text or "") + last
                n = len(raw) // 4
                # only the first piece may be short
                bounds = [0, *range(n % limit or limit, n + 1, limit)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    at.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    ids.append(raw[4 * a : 4 * b])
                    rank.append(seen[b - a])
                    seen[b - a] += 1
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
            columns += [pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array([task] * len(at), pa.int32()), pa.array(rank, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids", "crc", "task", "rank"])

    return run


Plan = list[tuple[tuple[int, ...], int]]


def least_sequences(counts: dict[int, int], limit: int) -> int:
    """No packing has fewer sequences (Martello and Toth's second bound): over all k, what lengths above limit - k and above limit / 2 need, and what of lengths from k on does not fit beside them."""
    n = np.zeros(limit + 2, dtype=object)
    for length, c in counts.items():
        n[length] = c
    n_upto, mass_upto = np.cumsum(n), np.cumsum(n * np.arange(limit + 2))
    half, best = limit // 2, 0
    for k in range(half + 1):
        n_huge = n_upto[limit] - n_upto[limit - k]
        n_large, large = n_upto[limit - k] - n_upto[half], mass_upto[limit - k] - mass_upto[half]
        small = mass_upto[half] - (mass_upto[k - 1] if k else 0)
        best = max(best, n_huge + n_large + max(0, -(-(small - (n_large * limit - large)) // limit)))
    return int(best)


def best_fit_decreasing(counts: dict[int, int], limit: int) -> Plan:
    """Longest first, each into the fullest sequence that takes it; equal sequences are filled together."""
    open_, rooms = {}, []  # room: {filling: number}; rooms in order

    def put(filling: tuple[int, ...], room: int, times: int) -> None:
        if room not in open_:
            rooms.insert(bisect_right(rooms, room), room)
        group = open_.setdefault(room, Counter())
        group[filling] += times

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_right(rooms, length - 1)
            room = rooms[i] if i < len(rooms) else limit
            each = room // length
            filling, times = ((), left) if i == len(rooms) else next(iter(open_[room].items()))
            if left < each:
                each = left
            used = min(times, left // each)
            if i < len(rooms):
                open_[room][filling] -= used
                if not open_[room][filling]:
                    del open_[room][filling]
                if not open_[room]:
                    del open_[room], rooms[i]
            put(filling + (length,) * each, room - each * length, used)
            left -= used * each
    return [(filling, times) for group in open_.values() for filling, times in group.items()]


class _Lengths:
    """How many pieces of each length are left, and the lengths that are left in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: c for k, c in counts.items() if c}
        self.have = sorted(self.counts)

    def take(self, filling: tuple[int, ...], times: int) -> None:
        for length, uses in Counter(filling).items():
            left = self.counts.get(length, 0) - uses * times
            if length not in self.counts:
                self.have.insert(bisect_right(self.have, length), length)
            self.counts[length] = left
            if not left:
                del self.counts[length]
                self.have.remove(length)

    def fillings(self, limit: int, width: int, steps: int) -> list[tuple[int, tuple[int, ...]]]:
        """(waste, lengths): undominated fillings of a sequence that holds the longest piece, least waste first, at most ``width``.

        A filling is dominated if a piece that is left fits into its waste, or if a longer piece could take the place of one of its own: whoever
        passes over a length for a shorter one must end with less waste than their difference. ``steps`` bounds the search.
        """
        longest, have, counts = self.have[-1], self.have, self.counts
        found: list[tuple[int, tuple[int, ...]]] = []
        budget = [steps]

        def fill(room: int, top: int, chosen: tuple[int, ...], below: int) -> None:
            budget[0] -= 1
            i, first = bisect_right(have, min(room, top)) - 1, 0
            while i >= 0 and budget[0] > 0 and sum(w == 0 for w, _ in found[-width:]) < width:
                x = have[i]
                i -= 1
                if counts[x] <= chosen.count(x):
                    continue
                fill(room - x, x, (*chosen, x), min(below, first - x) if first else below)
                first = first or x
            if not first and room < below:
                found.append((room, chosen))

        fill(limit - longest, longest, (longest,), limit + 1)
        if not found:  # the steps ran out inside the first filling: fill on greedily
            room, chosen = limit - longest, Counter([longest])
            while (i := next((i for i in range(bisect_right(have, room) - 1, -1, -1) if counts[have[i]] > chosen[have[i]]), -1)) >= 0:
                uses = min(room // have[i], counts[have[i]] - chosen[have[i]])
                chosen[have[i]] += uses
                room -= uses * have[i]
            found.append((room, tuple(sorted(chosen.elements(), reverse=True))))
        return sorted(found, key=lambda f: (f[0], len(f[1])))[:width]


def plan_sequences(counts: dict[int, int], limit: int, nodes: int = 20_000, width: int = 4, steps: int = 400) -> Plan:
    """Fillings and how often each is used, so that all pieces are placed in as few sequences as the search finds.

    Bin completion: a node takes the longest piece left, completes its sequence in an undominated way and repeats that filling as often as the
    counts allow. A branch ends where the waste so far and the least waste of the rest leave no fewer sequences than the best plan known, which
    is best-fit decreasing at first. The search ends when a plan meets the lower bound, or after ``nodes`` nodes.
    """
    counts = {k: c for k, c in counts.items() if c}
    if not counts:
        return []
    size = lambda plan: sum(times for _, times in plan)
    best, bound, mass = best_fit_decreasing(counts, limit), least_sequences(counts, limit), sum(k * c for k, c in counts.items())
    left, path, waste = _Lengths(counts), [], 0
    options = [iter(left.fillings(limit, width, steps))]
    while options and nodes and size(best) > bound:
        option = next(options[-1], None)
        if option is None:
            options.pop()
            if path:
                filling, times, lost = path.pop()
                left.take(filling, -times)
                waste -= lost
            continue
        nodes -= 1
        filling = option[1]
        times = min(left.counts[x] // uses for x, uses in Counter(filling).items())
        left.take(filling, times)
        path.append((filling, times, option[0] * times))
        waste += option[0] * times
        rest = sum(k * c for k, c in left.counts.items())
        ahead = least_sequences(left.counts, limit) * limit - rest if nodes % 16 == 0 and rest else 0
        more = iter(())
        if waste + ahead <= (size(best) - 1) * limit - mass:
            if left.have:
                more = iter(left.fillings(limit, width, steps))
            elif sum(p[1] for p in path) < size(best):
                best = [(f, t) for f, t, _ in path]
        options.append(more)
    return best


def _placement(plan: Plan) -> dict[str, np.ndarray]:
    """The plan by (length, place among the pieces of that length): intervals of places, with the sequence and offset at which each begins."""
    used, first, rows = Counter(), 0, []
    for filling, times in plan:
        offset = 0
        for length, uses in sorted(Counter(filling).items(), reverse=True):
            rows.append((length, used[length], first, uses, offset))
            used[length] += uses * times
            offset += uses * length
        first += times
    return dict(zip(("length", "place", "sequence", "uses", "offset"), np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T, strict=True))


def pack(docs: DataFrame, tokenizer_file: str, limit: int = 2048, end: int = 0, nodes: int = 20_000, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The token pieces of all documents with their places in as few sequences of at most ``limit`` tokens as the search finds.

    Returns a row a piece: the id, ``piece`` (from 0), ``start`` (tokens of its document before it), ``length``, ``ids`` (little-endian unsigned
    32-bit), ``ids_crc32``, ``sequence_id`` and ``offset``. A document's ids are the library's, without added special tokens, then ``end``; only
    longer documents are cut, into pieces of ``limit`` tokens of which the first may be shorter. sequences() joins the pieces.

    The tasks that cut the pieces number those of each length and write them to the shared folder. Only the counts by length, at most ``limit``
    numbers, go to the driver, where the search runs (see plan_sequences); its plan goes back to the tasks as intervals of numbers. Pieces of one
    length are interchangeable, so a length that many documents share is numbered by tasks and is no hot group: no text or id is shuffled.

    Defined cases: null text is empty (one piece, ``end`` alone); equal rows are documents of their own; a null id stays null; texts of any length
    are encoded whole, in one task each; other columns aren't returned; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids binary, crc bigint, task int, rank bigint"
    pieces = cut(given.mapInArrow(_pieces(tokenizer_file, byte_ranks(tokenizer_file), limit, end), schema), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    by_length = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_sequences({k: c for k, c in by_length.items() if k < limit}, limit, nodes)
    plan += [((limit,), by_length[limit])] if limit in by_length else []
    placement = spark.sparkContext.broadcast(_placement(plan))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def placed(length: pd.Series, place: pd.Series) -> pd.DataFrame:
        p = placement.value
        at = np.searchsorted((p["length"] << 48) + p["place"], (length.to_numpy() << 48) + place.to_numpy(), "right") - 1
        repeat, k = np.divmod(place.to_numpy() - p["place"][at], p["uses"][at])
        return pd.DataFrame({"sequence_id": p["sequence"][at] + repeat, "offset": p["offset"][at] + k * length.to_numpy()})

    numbered = pieces.join(before, ["length", "task"]).withColumn("at", placed("length", F.col("rank") + F.col("before")))
    return numbered.select(F.col("id").alias(id_col), "piece", "start", "length", "ids", F.col("crc").alias("ids_crc32"), "at.sequence_id", "at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences of pack(): sequence_id, n_tokens and ids, the pieces' ids one after the other; a sequence is a group of bounded size."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), held.alias("held"))
    return joined.select("sequence_id", "n_tokens", F.aggregate("held", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
