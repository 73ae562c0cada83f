"""Packing, conversation repair and periodic runs against plain models; odd input."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from binlattice.llm import chat, near_dup, packing, quality, queries, repair, repetition

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def held(plan):
    return Counter(x for filling, times in plan for x in filling * times)


def fewest(items, limit):
    """The least number of sequences, by trying every set that holds the longest piece."""

    @cache
    def least(left):
        if not left:
            return 0
        best, rest = len(left), left[1:]
        for mask in range(1 << len(rest)):
            if left[0] + sum(x for i, x in enumerate(rest) if mask >> i & 1) <= limit:
                best = min(best, 1 + least(tuple(x for i, x in enumerate(rest) if not mask >> i & 1)))
        return best

    return least(tuple(sorted(items, reverse=True)))


def test_bin_completion_finds_the_fewest_sequences():
    rng = random.Random(11)
    for _ in range(150):
        limit = rng.choice([10, 20, 60])
        items = [rng.randint(1, limit - 1) for _ in range(rng.randint(1, 9))]
        plan = packing.plan_sequences(Counter(items), limit)
        assert held(plan) == Counter(items) and all(sum(f) <= limit for f, _ in plan)
        assert sum(t for _, t in plan) == fewest(items, limit) >= packing.least_sequences(Counter(items), limit)


def test_bin_completion_beats_best_fit():
    rng = random.Random(4)
    counts = Counter(rng.randint(300, 1000) for _ in range(3000))
    size = lambda plan: sum(t for _, t in plan)
    first, plan = packing.best_fit_decreasing(counts, 2048), packing.plan_sequences(counts, 2048, nodes=2000)
    assert held(first) == held(plan) == counts and packing.least_sequences(counts, 2048) <= size(plan) < size(first)


def test_encoder_gives_the_librarys_ids():
    encoder = packing.Encoder(BYTES, packing.byte_ranks(BYTES))
    assert encoder.whole
    rng = random.Random(2)
    parts = ["word", " ", "  ", "\n", "\t", "\r\n", "é", "世界", "123", "!?", "'s", "　", " ", " ", "​", "\x85", "\x1c", "᠎", "<|endoftext|>", "<|im_end|>", "😀", "ﬁ", "é", "_", "Ⅻ", "²"]
    for text in ["", *("".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000))]:
        assert encoder.ids(text) == np.array(encoder.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_packing(spark):
    library = Tokenizer.from_file(BYTES)
    texts = [None, "", "one", "one", "one", "a few more words " * 9, "long " * 500, "<|endoftext|> x", "é" * 80] + [f"text {i} " * (i % 37) for i in range(200)]
    rows = [(None if i == 3 else i % 150, t, "clash", 0) for i, t in enumerate(texts)]
    packed = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string, piece string, ids int"), BYTES, limit=64).cache()
    got = packed.collect()
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 0]
    pieces = Counter()
    for i, t, *_ in rows:
        x = ids(t)
        cuts = [0, *range(len(x) % 64 or 64, len(x) + 1, 64)] if len(x) > 64 else [0, len(x)]
        pieces.update((i, k, a, tuple(x[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == pieces
    assert all(r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4 for r in got)
    at = {}
    for r in got:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    for s in at.values():
        assert [o for o, _, _ in sorted(s)] == [sum(n for _, n, _ in sorted(s)[:i]) for i in range(len(s))] and sum(n for _, n, _ in s) <= 64
    assert len(at) == packing.least_sequences(Counter(len(p[3]) for p in pieces.elements()), 64)
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert whole == {k: b"".join(x for _, _, x in sorted(s)) for k, s in at.items()}
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string"), BYTES).count() == 0


def plain_edits(codes, state, exits):
    """(cost, letters, end) by going back over all rows and states."""
    after = [(exits[q], "", q) for q in range(4)]
    for i in range(len(codes) - 1, -1, -1):
        step = [min((c + after[s][0], x + after[s][1], after[s][2]) for x, c, _, s in repair._arcs(codes, i, q) if x != "I") for q in range(4)]
        now = step
        for _ in range(3):
            now = [min(step[q], (repair.INSERT + now[repair.NEXT[q]][0], "I" + now[repair.NEXT[q]][1], now[repair.NEXT[q]][2])) for q in range(4)]
        after = now
    return after[state]


def test_auction_finds_the_least_letters_of_the_cheapest_edits():
    rng = random.Random(1)
    for _ in range(4000):
        codes = [rng.randrange(4) + 4 * rng.choice([0, 0, 0, 1, 2]) for _ in range(rng.randint(0, 12))]
        exits = repair.AT_END if rng.random() < 0.5 else [rng.randint(0, 9) for _ in range(4)]
        want = [plain_edits(codes, q, exits) for q in range(4)]
        assert [repair.auction_path(codes, q, exits) for q in range(4)] == want == repair._from_all(codes, exits)
        for end in (2, 3):
            to = [repair.FAR * (e != end) for e in range(4)]
            assert [x[0] for x in repair._from_all(codes, to)] == [plain_edits(codes, q, to)[0] for q in range(4)]


FIELDS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_repair(rows):
    """The digest of one conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", (r[2] or "")[:64], hashlib.sha256((r[2] or "").encode()).hexdigest()))
    seen, codes, faults = set(), [], Counter()
    for _, role, text in rows:
        bare = (text or "").strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults[fault] += 1
        codes.append({"s": 0, "u": 1, "a": 2}.get((role or "")[:1], 3) + 4 * {None: 0, "truncated": 1}.get(fault, 2))
    cost, letters, end = plain_edits(codes, repair.EMPTY, repair.AT_END)
    letters += repair.END_LETTERS[end]
    out, q, at = [], repair.EMPTY, 0
    for x in letters:
        role, text = (rows[at][1] or "", rows[at][2] or "") if x in "KRD" else ("", "")
        if x != "D":
            q = repair.AFTER[q][codes[at] & 3] if x == "K" else repair.NEXT[q]
            out.append((role if x == "K" else "assistant" if q == repair.ASSISTANT else "user") + ":" + text)
        at += x != "I"
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [(r[1] or "")[:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, letters, hashlib.sha256("\n".join(out).encode()).hexdigest()


@pytest.mark.parametrize("bits", [2, 6])
def test_repair_of_short_and_long_conversations(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    rows = []
    for conv in [None, 7, *range(20)]:
        for _ in range(rng.choice([0, 1, 3, 9, 150])):
            turn = rng.choice([None, *range(12)])
            rows.append((conv, turn, rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None]), rng.choice(["Yes.", "no", " \n", "", None, "What?", "long " * 300 + ".", "a" * 70 + "1.", "a" * 70 + "2."]), "x"))
    rows += [(50, 1, "user", "same.", "x")] * 300
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, audit string")
    got = {r.conv_id: tuple(r[f] for f in FIELDS[1:]) for r in repair.digest(table, table).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append((r[1], r[2] or "", r[3] or ""))
    assert got == {k: plain_repair(v) for k, v in by.items()}


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert repair.digest(none, none).count() == 0 and repair.repair(none).count() == 0
    some = spark.createDataFrame([(1, 2, "user", "a")], "conv_id bigint, turn bigint, role string, text string")
    assert repair.digest(some, none).first()[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_damage(spark):
    rows = [(c, t, ["user", "assistant", None][t % 3] if t is not None else "user", f"Text {c}? {t}." if t != 5 else None) for c in (1, 2, None) for t in (*range(60), None)]
    got = Counter(map(tuple, repair.damage(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()))
    want = Counter()
    for c, t, role, text in rows:
        h, role, text = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20, role or " ", " " if text is None else text
        if h:
            row = (c, t, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
            want[row] += 1 + (h == 3)
    assert got == want


def plain_runs(w, least, exponent):
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q) and (i, j - i + q) not in [r[:2] for r in out]:
                out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng, most=80):
    k, out = rng.randint(1, 3), []
    while rng.random() < 0.9 and len(out) < most:
        out += [b"%d" % rng.randrange(k) for _ in range(rng.randint(1, 5))] * rng.choice([1, 1, 2, 4, 5, 7])
    return out


@pytest.mark.parametrize(("least", "exponent"), [(6, 4), (2, 2), (3, 2), (1, 3)])
def test_runs_are_all_and_only_the_maximal_ones(monkeypatch, least, exponent):
    monkeypatch.setattr(repetition, "TOGETHER", 500)
    rng = random.Random(least)
    texts = [some_words(rng) for _ in range(600)] + [[], [b"a"], [b"a"] * 5000]
    for words, found in zip(texts, repetition.runs_in_texts(texts, least, exponent), strict=True):
        assert found == ([(0, 5000, 1)] if len(words) == 5000 else plain_runs(words, least, exponent))


def test_periodic_runs(spark):
    rng = random.Random(9)
    texts = [None, "", " \n ", "a " * 7, "x　y " * 6, "word", "word"] + [b" ".join(some_words(rng, 300)).decode() for _ in range(300)] + ["  ".join(f"w{i}" for i in range(3000))]
    rows = [(None if i == 5 else i, t, i, "clash") for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, extra int, runs string")
    found = repetition.find_runs(repetition.plant_runs(table)).collect()
    assert sorted(r.extra for r in found) == list(range(len(rows)))
    digests = {r.doc_id: r for r in repetition.digest(repetition.find_runs(repetition.plant_runs(table))).collect()}
    planted = 0
    for r in found:
        words = (texts[r.extra] or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1, len(words)
        g = h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words, 6, 4)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert [tuple(x) for x in r.runs] == runs and r.collapsed.encode() == kept
        d, best = digests[r.doc_id], max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        if r.doc_id is not None:
            assert (d.n_runs, d.start, d.length, d.period, d.exponent_milli) == (len(runs), *best, 1000 * best[1] // best[2] if runs else None)
            assert d.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest() and d.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
    assert planted > 10
    assert repetition.find_runs(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize("name", ["op6_chat_targets", "op8_rule_cascade", "op12_conversation_repair", "op13_periodic_runs"])
def test_queries_give_the_rows_of_their_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    for t in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    got = queries.queries()[name](spark, "/root/testdata/sf0.001")
    want = duck.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, want.fetchall())) == sorted(map(repr, map(tuple, got.select(*columns).collect())))


def test_cheap_rules_depend_on_the_sample(spark):
    """Line rules are dear for texts of many short lines and cheap for texts of one line; the rule of letters costs a step a character."""
    rules = [r for r in quality.production_rules() if r.name in ("unfinished_lines", "few_letters")]
    order = lambda text: [e.rule.name for e in quality.estimate(spark.createDataFrame([(text,)] * 4, "text string"), rules)]
    assert order("12345 67890 " * 50 + "...") == ["unfinished_lines", "few_letters"]
    assert order("1...\n" * 200) == ["few_letters", "unfinished_lines"]


def test_rejection_is_that_of_rows_that_reach_a_rule(spark):
    rules = [quality.Rule("marks", ("n_marks",), lambda m: m["n_marks"] > 0), quality.Rule("same", ("n_symbols",), lambda m: m["n_symbols"] > 0), quality.Rule("few", ("n_lines",), lambda m: m["n_lines"] > 1)]
    texts = ["!#"] * 5 + ["!"] + ["a\nb"] + ["plain"] * 3
    found = quality.estimate(spark.createDataFrame([(t,) for t in texts], "text string"), rules)
    assert [e.rule.name for e in found] == ["marks", "few", "same"]
    assert [e.rejected for e in found] == [0.6, 0.25, 0.0]


def test_chat_with_clashing_columns_and_a_long_conversation(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"<|im_end|> {i} <\\| é" * (i % 3), "x", 7) for i in range(200)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted string, example int")
    got = chat.expand_targets(table).orderBy("example").collect()
    assert [r.n_turns for r in got] == list(range(2, 201, 2)) and [r.example for r in got] == list(range(100))
    for r, (_, _, _, text, *_) in zip(got, rows[1::2], strict=True):
        assert got[-1].formatted.startswith(r.formatted)
        assert r.formatted[r.loss_start : r.loss_end].replace("<\\|", "<|").replace("<\\\\", "<\\") == text
    back = spark.createDataFrame([(got[-1].formatted,)], "f string").select(chat.read_turns(F.col("f")).alias("t")).first().t
    assert [(x.role, x.text) for x in back] == [(r[2], r[3]) for r in rows]


@pytest.mark.parametrize("slice_size", [1 << 18, 1_000, 77])
def test_links_of_a_block_do_not_depend_on_slices(monkeypatch, slice_size):
    monkeypatch.setattr(near_dup, "SLICE", slice_size)
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 2_000).astype(np.uint64)
    rows = []
    for i in range(40):
        s = base.copy()
        changed = int(rng.integers(0, 700))
        s[rng.choice(2_000, changed, False)] = rng.integers(0, 2**63, changed)
        s[:5] |= np.uint64(1 << 63)
        rows.append((i % 2, i, i, np.unique(s)))
    want = set()
    for x, y in itertools.combinations(rows, 2):
        common = len(np.intersect1d(x[3], y[3]))
        if x[0] != y[0] and 100 * common >= 80 * (len(x[3]) + len(y[3]) - common):
            want.add((x[1], y[1]))
    got = {(a, b) for r in near_dup._linked(rows, 80) for a, b in zip(r["a"].to_pylist(), r["b"].to_pylist(), strict=True)}
    assert want and got == want


def test_short_slices_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(near_dup, "SLICE", 77)
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * n if n is not None else None for n in (3, None, 500, 2, 2, 900, 1)])})
    assert [len(b) for b in near_dup._short_slices(batch, ("text",), 4)] == [2, 1, 2, 1, 1]
    assert [len(b) for b in near_dup._short_slices(batch.slice(2), ("text",), 1)] == [1] * 5 and not list(near_dup._short_slices(batch.slice(7), ("text",), 4))
