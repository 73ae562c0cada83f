"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from binlattice.llm import chat, common, decontaminate, lines, mixing, near_dup, quality, resample, sharding, tokens, warc

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"
MORE = "size string, shard string, slot string, mix_pos string, Kept string, n_words string, failed_rule string, n_tokens string, bucket string, mark string"
LONG_LINE = "a line that is long enough to be counted as one of the repeated lines"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    out = [(None, None), (None, "alpha beta"), (None, "alpha beta"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (5, "two words"), (-7, "one")]
    out += [(i, prose(60) + "\n" + LONG_LINE) for i in range(10, 30)]
    base = prose(120).split()
    for i in range(30, 40):
        words = list(base)
        words[i] = "changed"
        out.append((i, " ".join(words)))
    out.append((40, prose(20_000)))
    out.append((41, "x" * 50_000))
    out += [(42, "A  b\tC\r\n\n▁ é 世界 \x00 <s> <|im_start|>")] * 3
    return [(i, t, "en", ["src0", "src1", None][n % 3] if n < 40 else "src0", len(t or "")) for n, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    odd = [(*r, *["odd"] * 10) for r in rows]
    return common.cut(spark.createDataFrame(odd, f"{KIND}, {MORE}"), "test-docs")


@pytest.fixture(scope="module")
def nothing(spark):
    return common.cut(spark.createDataFrame([], KIND), "test-nothing")


def test_sharding(docs, nothing, rows):
    got = sharding.histogram_shard(docs, 4).collect()
    assert len(got) == len(rows)
    assert sorted(str(r.doc_id) + str(r.text) for r in got) == sorted(str(r[0]) + str(r[1]) for r in rows)
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    ordered = [r.doc_id if r.doc_id is not None else -(2**63) for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)
    assert all(r.size == len((r.text or "").encode()) + 1 for r in got)
    assert sharding.histogram_shard(nothing, 4).count() == 0


def test_sharding_divides_a_hot_key(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 10**14 - 10**17).alias("doc_id"), F.concat(F.lit("t"), F.col("id") + 1000).alias("text"))
    got = sharding.histogram_shard(hot, 8, bucket_bytes=500).groupBy("shard").agg(F.sum("size").alias("n"), F.max("slot").alias("top"), F.count("*").alias("rows")).collect()
    mean = sum(r.n for r in got) / 8
    assert len(got) == 8 and all(abs(r.n - mean) < 0.05 * mean and r.top == r.rows - 1 for r in got)


def test_mixing(docs, nothing, rows):
    got = mixing.mix_sources(docs, block_rows=2, rows_per_bucket=8).collect()
    assert sorted(r.mix_pos for r in got) == list(range(len(rows)))
    assert mixing.mix_sources(nothing).count() == 0


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 0.7, "b": 0.2, "c": 1e-4}, {"a": 500, "b": 333.3, "c": 166.1, "d": 0.01}])
def test_schedule_stays_within_a_block(weights):
    blocks = {"a": 300, "b": 40, "c": 7, "d": 3}
    slots = mixing.pfair_schedule({s: blocks[s] for s in weights}, mixing.whole_weights(weights))
    assert Counter(s for s, _, _ in slots) == {s: blocks[s] for s in weights}
    deviation(slots, weights)


def deviation(slots, weights):
    """Every prefix of a phase holds each source's share of the target weights to less than a block."""
    live, at, held = set(weights), 0, Counter()
    for i, (s, block, phase) in enumerate(slots):
        at, held = at + 1, held + Counter([s])
        whole = sum(weights[x] for x in live)
        assert all(abs(held[x] - at * weights[x] / whole) < 1 + 1e-6 for x in live)
        if i + 1 < len(slots) and slots[i + 1][2] != phase:
            live, at, held = live - {s}, 0, Counter()


def test_mixing_follows_the_weights(spark):
    sizes = {"big": 4000, "mid": 700, "tiny": 30, None: 5}
    rows = [(f"{s}-{i}", f"text {s} {i}", s) for s, n in sizes.items() for i in range(n)]
    table = spark.createDataFrame([(n, t, s) for n, (_, t, s) in enumerate(rows)], "doc_id bigint, text string, source string")
    got = mixing.mix_sources(table, weights={"big": 0.613, "tiny": 0.1}, block_rows=16, rows_per_bucket=64).collect()
    assert sorted(r.mix_pos for r in got) == list(range(len(rows)))
    slots = {}
    for r in got:
        slots.setdefault(r.mix_slot, set()).add((r.source, r.mix_block, r.mix_phase))
    assert all(len(x) == 1 for x in slots.values()) and sorted(slots) == list(range(len(slots)))
    by_size = {s: n**0.5 for s, n in sizes.items()}
    weights = {"big": 0.613, "tiny": 0.1} | {s: by_size[s] / sum(by_size.values()) for s in ("mid", None)}
    deviation([next(iter(slots[k])) for k in sorted(slots)], weights)
    for source in sizes:  # a source's rows fill its blocks in order
        mine = sorted((r for r in got if r.source == source), key=lambda r: r.mix_pos)
        assert [r.mix_block for r in mine] == [i // 16 for i in range(len(mine))]
    with pytest.raises(ValueError):
        mixing.mix_sources(table, weights={"big": 0})


def test_shards_are_a_sorted_list_cut_by_bytes(spark):
    rng = random.Random(9)
    rows = [(rng.choice([5, rng.randrange(-(2**60), 2**60)]), "x" * rng.choice([0, 10, 300, 5000]) + str(i)) for i in range(3000)] + [(None, None)] * 4
    got = sharding.histogram_shard(spark.createDataFrame(rows, "doc_id bigint, text string"), 7, bucket_bytes=20_000).orderBy("shard", "slot").collect()
    ids = [r.doc_id if r.doc_id is not None else -(2**63) for r in got]
    assert ids == sorted(ids) and Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    total, below, longest = sum(r.size for r in got), 0, max(r.size for r in got)
    for s in range(7):
        mine = [r for r in got if r.shard == s]
        assert [r.slot for r in mine] == list(range(len(mine)))
        below += sum(r.size for r in mine)
        assert abs(below - (s + 1) * total / 7) <= max(0.01 * total / 7, longest)


INTERNAL = "k0 k1 size bucket c0 c1 mix_src mix_h mix_place mix_p place bits before slots phase doc mark bad_doc bad_mark text_a name word_counts taken w hs judged id batch hashes"


def test_columns_of_any_name_survive(spark, docs):
    names = [f"`{n}`" for n in INTERNAL.split()] + ["`odd.name`", "`Mix_H`"]
    own = {n.strip("`") for n in names} - {"Mix_H", "size"}
    wide = docs.select("doc_id", "text", "source", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n.strip("`")) for n in names if n not in ("`size`", "`Mix_H`")])
    wide = common.cut(wide, "test-wide")
    before = Counter(str(sorted(r.asDict().items(), key=str)) for r in wide.collect())
    labels = spark.createDataFrame([(10, 1), (11, 1), (40, 0), (41, 0)], "doc_id bigint, quality int")
    bench = spark.createDataFrame([(1, "one")], "item_id bigint, text string")
    model = public_tokenizers.path("piece_bpe_32k.model")
    whole = [sharding.histogram_shard(wide, 3), mixing.mix_sources(wide), quality.measure(wide), quality.cascade(wide.drop("taken"), quality.base_rules()), tokens.count_tokens(wide, model)]
    for out in whole:
        kept = [c for c in wide.columns if c in out.columns]
        assert own - set(kept) <= {"taken"}
        want = Counter(str(sorted((k, v) for k, v in r.asDict().items() if k in kept and k != "taken")) for r in wide.collect())
        assert Counter(str(sorted((k, v) for k, v in r.asDict().items() if k in kept and k != "taken")) for r in out.collect()) == want
    for out in (resample.keep_good(wide, labels), near_dup.keep_one(wide), decontaminate.remove_leaks(wide, bench)):
        assert out.columns == wide.columns
        found = Counter(str(sorted(r.asDict().items(), key=str)) for r in out.collect())
        assert found and not found - before


def test_decontamination(spark, docs, nothing, rows):
    long = rows[11][1].split("\n")[0]
    items = [(1, long), (2, "one"), (3, None), (4, " "), (5, "two WORDS!"), (6, "never seen before at all here"), (7, long + " and five more words here"), (1, long)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    want = set()
    for d, t, *_ in rows:
        words = split(t)
        for item, text in items:
            n = len(split(text))
            grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
            for at in range(len(words) - n + 1 if n else 0):
                a, b = grams(words[at : at + n]), grams(split(text))
                common_n = sum((a & b).values())
                if common_n >= 0.8 * (a.total() + b.total() - common_n) - 1e-9:
                    want.add((d, item))
    assert got == want
    assert (10, 1) in got
    bad = {d for d, _ in got}
    kept = decontaminate.remove_leaks(docs, bench).collect()
    assert len(kept) == sum(1 for r in rows if not any(r[0] == d for d in bad)) + sum(1 for r in rows if r[0] == 5 and not split(r[1]))
    assert decontaminate.find_leaks(nothing, bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def test_decontamination_of_documents_shorter_than_the_item(spark):
    rng = random.Random(8)
    new = lambda n: ["".join(rng.choices("abcdefghij", k=8)) for _ in range(n)]
    items = {i: new(n) for i, n in enumerate((57, 15, 29, 9, 8, 5, 300))}
    docs = {}
    for i, ws in items.items():
        for lost in range(1, len(ws) // 4 + 2):
            docs[(i, lost, "end")] = ws[:-lost]
            docs[(i, lost, "start")] = ws[lost:]
            docs[(i, lost, "swap")] = [*ws[: len(ws) // 2], "other", *ws[len(ws) // 2 + 1 : -lost]]
    want = set()
    for n, ws in enumerate(docs.values()):
        for i, item in items.items():
            grams = lambda w: Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4)))
            windows = [ws[j : j + len(item)] for j in range(len(ws) - len(item) + 1)] or [ws]
            best = max((grams(w) & grams(item)).total() / (grams(w) | grams(item)).total() for w in windows)
            if best >= 0.8 - 1e-9:
                want.add((n, i, min(len(ws), len(item)), round(best, 9)))
    table = spark.createDataFrame([(n, " ".join(ws)) for n, ws in enumerate(docs.values())], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, " ".join(ws)) for i, ws in items.items()], "item_id bigint, text string")
    found = decontaminate.find_leaks(table, bench).collect()
    assert {(r.doc_id, r.item_id, r.n_words, round(r.similarity, 9)) for r in found} == want
    numbers = {key: n for n, key in enumerate(docs)}
    assert {(numbers[(0, 5, "end")], 0), (numbers[(1, 2, "end")], 1)} <= {w[:2] for w in want}
    gone = {w[0] for w in want}
    assert {r.doc_id for r in decontaminate.remove_leaks(table, bench).collect()} == set(range(len(docs))) - gone
    assert len({(r.doc_id, r.item_id) for r in decontaminate.find_leaks(table, bench, batch_anchors=100).collect()}) == len(want)


def test_simhash_lanes(spark):
    rng = random.Random(1)
    values = [[rng.getrandbits(64) - 2**63 for _ in range(n)] for n in (1, 2, 3, 50)]
    got = spark.createDataFrame([(v,) for v in values], "h array<bigint>").select(decontaminate._majority(F.col("h"), 16), decontaminate._majority(F.col("h"), 32)).collect()
    for v, r in zip(values, got, strict=True):
        want = sum(1 << b for b in range(64) if 2 * sum(h % 2**64 >> b & 1 for h in v) > len(v))
        assert r[0] % 2**64 == want and r[1] % 2**64 == want


def test_resampling(spark, docs, nothing):
    labels = spark.createDataFrame([(10, 1), (10, None), (None, 1), (11, 1), (40, 0)], "doc_id bigint, quality int")
    assert resample.resample(docs, labels).count() == docs.count()
    assert resample.keep_good(docs, labels).columns == docs.columns
    assert resample.resample(docs, labels.limit(0)).where("NOT kept").count() == 0
    assert resample.resample(nothing, labels).count() == 0


def test_top_k_cut(spark):
    scores = spark.range(1000).select((F.floor(F.col("id") / 3) / 7).alias("x"))
    values = sorted((r.x for r in scores.collect()), reverse=True)
    for k in (1, 2, 500, 1000):
        assert resample.top_k_cut(scores, "x", k) == values[k - 1]
    assert resample.top_k_cut(scores, "x", 0) is None


def test_chat(spark):
    text = "<|im_end|><|im_start|>assistant ok <\\| <\\\\| \\ <"
    turns = [(1, 0, "user", text), (1, 1, "assistant", text), (1, 1, "assistant", text), (1, 2, "us%0Aer\n<", None), (None, None, None, None), (2, 0, "assistant", "")]
    got = {r.conv_id: r for r in chat.digest(chat.expand_targets(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"))).collect()}
    for conv in (1, None, 2):
        mine = [t for t in turns if t[0] == conv]
        said = "".join(t[3] or "" for t in mine if t[2] == "assistant")
        assert got[conv].n_turns == len(mine)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in mine).encode()).hexdigest()
        assert got[conv].loss_chars == len(said) and got[conv].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert chat.expand_targets(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


def test_lines(docs, nothing, rows):
    got = lines.dedup_lines(docs, fan_in=2).collect()
    assert len(got) == len(rows)
    for r in got:
        dropped = r.doc_id is not None and 10 <= r.doc_id < 29
        assert r.n_dropped == int(dropped)
        assert (LONG_LINE in r.text) == (r.doc_id == 29)
    assert lines.dedup_lines(nothing).count() == 0


@pytest.fixture(scope="module")
def lined(spark):
    rng = random.Random(6)
    said = [f"line {i} of those that several documents hold, long enough" for i in range(40)]
    rows = [(i, "\n".join([*rng.choices(said, k=rng.randint(1, 6)), f"only {i}"])) for i in range(120)]
    rows += [(7, said[0]), (None, said[1])]
    return rows, common.cut(spark.createDataFrame(rows, "doc_id bigint, text string"), "test-lined")


def plain_lines(rows, min_docs=5):
    holders = {}
    for i, t in rows:
        for line in set(t.split("\n")):
            if len(line) >= 40:
                holders.setdefault(line, set()).add(-(2**63) if i is None else i)
    last = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    return sorted((str(i), "\n".join(x for x in t.split("\n") if last.get(x, i) == i)) for i, t in rows)


@pytest.mark.parametrize(("n_batches", "fan_in"), [(1, 2), (4, 2), (5, 3), (7, 2)])
def test_lines_against_a_plain_model(lined, n_batches, fan_in):
    rows, table = lined
    got = lines.dedup_lines(table, n_batches=n_batches, fan_in=fan_in).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == plain_lines(rows)


def test_runs_hold_a_key_once(spark):
    runs = lines.LineRuns(spark, fan_in=2)
    for at in (90, 60, 30, 0):
        keys = spark.range(at, at + 40).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("h"), F.lit(1).alias("n_docs"), F.col("id").alias("last_doc"))
        runs.add(keys.groupBy("h").agg(F.count("*").alias("n_docs"), F.max("last_doc").alias("last_doc")))
    assert len(runs.runs()) == 1 and runs.runs()[0].count() == 130 == runs.runs()[0].where("last_doc IS NOT NULL").count()
    assert runs.frequent(2).count() == 30
    runs.drop()


def test_lines_need_the_anti_join(lined, monkeypatch):
    rows, table = lined
    monkeypatch.setattr(lines.LineRuns, "unknown", lambda self, keys: keys.withColumn("is_new", F.lit(True)))
    assert sorted((str(r.doc_id), r.text) for r in lines.dedup_lines(table, n_batches=4).collect()) != plain_lines(rows)


def test_hot_lines_are_matched_apart(lined, monkeypatch):
    rows, table = lined
    monkeypatch.setattr(lines, "HEAVY", 20)
    assert sorted((str(r.doc_id), r.text) for r in lines.dedup_lines(table).collect()) == plain_lines(rows)


def test_quality(docs, nothing, rows):
    measured = quality.measure(docs)
    rules = [*quality.base_rules(), *quality.production_rules()]
    got = quality.cascade(measured, rules).collect()
    assert len(got) == len(rows)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
    assert quality.cascade(quality.measure(nothing), rules).count() == 0


def test_cascade_takes_no_measure_after_its_verdict(spark):
    rules = [*quality.base_rules(), *quality.production_rules()]
    texts = ["word " * 5, "$ " * 40, "a good sentence of ordinary words follows here. " * 2 + "and it ends with quite other words than before"] * 20
    table = spark.createDataFrame(enumerate(texts), "doc_id bigint, text string")
    orders = {tuple(e.rule.name for e in quality.estimate(table.repartition(n), rules)) for n in (1, 2, 3, 5)}
    assert len(orders) == 1
    order = list(orders.pop())
    spent = {e.rule.name: e.work for e in quality.estimate(table, rules)}
    assert order.index("too_few_words") < order.index("repeated_windows") and sum(spent.values()) > 0
    for r in quality.cascade(table, rules, keep=quality.MEASURES).collect():
        taken = {n for n in quality.MEASURES if r.taken[n] is not None}
        passed = order[: order.index(r.failed_rule) + 1] if r.failed_rule else order
        needs = quality._with_needs(n for rule in rules if rule.name in passed for n in rule.needs)
        assert taken == set(needs) & set(quality.MEASURES)


def test_near_duplicates(docs, nothing, rows):
    got = near_dup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    sets = {}
    for d, t, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans(common.UPPER, common.LOWER)))
        sets[(d, t)] = {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()
    assert sorted(r.n_shingles for r in got) == sorted(len(sets[(r[0], r[1])]) for r in rows)
    assert {r.component_id for r in got if r.doc_id is not None and 30 <= r.doc_id < 40} == {30}
    assert {r.component_id for r in got if r.doc_id == 4} == {-7}
    assert {r.component_id for r in got if r.doc_id is None} == {None}
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns and kept.where("doc_id BETWEEN 30 AND 39").count() == 1 and kept.where("text = 'one'").count() == 1
    assert near_dup.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("percent", [50, 70, 80])
def test_planted_pairs_are_linked(spark, percent):
    rng = random.Random(percent)
    new = lambda n: ["".join(rng.choices("abcdefghijkl", k=7)) for _ in range(n)]
    grams = lambda w: {tuple(w[i : i + 4]) for i in range(len(w) - 3)}
    texts = []
    while len(texts) < 120:
        one = new(150)
        two = list(one)
        for _ in range(rng.randint(1, 22)):
            two[rng.randrange(150)] = new(1)[0]
        a, b = grams(one), grams(two)
        if percent <= 100 * len(a & b) / len(a | b) < percent + 6:
            texts += [one, two]
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(table, percent=percent).collect()}
    assert sum(got[i + 1] == i for i in range(0, 120, 2)) >= 0.95 * 60
    assert all(got[i] in (i, i - i % 2) for i in got)


def test_large_open_buckets_lose_no_link(spark, monkeypatch):
    rng = random.Random(2)
    new = lambda: "".join(rng.choices("abcdefghijkl", k=7))
    grams = lambda w: {tuple(w[i : i + 4]) for i in range(len(w) - 3)}
    base, texts = [new() for _ in range(200)], []
    for _ in range(90):  # a template: all alike, few similar enough
        w = list(base)
        for i in rng.sample(range(200), 6):
            w[i] = new()
        texts.append(w)
    texts += [[*w[:99], new(), *w[100:]] for w in texts[:12]]
    sets, root = [grams(w) for w in texts], list(range(102))
    for i in range(102):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if 100 * c >= 80 * (len(sets[i]) + len(sets[j]) - c):
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 300)
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(table).collect()} == dict(enumerate(root))


def test_runs_are_hashed_alike_in_pieces():
    import numpy as np

    from binlattice.llm import text_arrays

    rng = random.Random(3)
    for _ in range(100):
        texts = ["".join(rng.choices("ab  \n!?é", k=rng.randint(0, 40))).encode() for _ in range(rng.randint(1, 6))]
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts]).astype(np.int64)
        whole = text_arrays.run_hashes(data, offsets, text_arrays.RUN_CLASS)
        for piece in (1, 3, 8):
            parts = text_arrays.run_hashes(data, offsets, text_arrays.RUN_CLASS, piece)
            assert (parts[0] == whole[0]).all() and list(parts[1]) == list(whole[1])


def test_weights_are_those_of_a_plain_model(spark):
    import numpy as np

    from binlattice.llm.text_arrays import chunks

    rng = random.Random(4)
    good, junk = [f"good{i}" for i in range(50)], [f"zz{i}" for i in range(50)]
    texts = [" ".join(rng.choices(good if i % 4 else junk, k=rng.choice([3, 40, 400]))) for i in range(200)]
    docs = spark.createDataFrame(enumerate(texts), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 200, 2)], "doc_id bigint, quality int")
    p = resample.Params(buckets=4096)
    got = {r.doc_id: r for r in resample.resample(docs, labels, p).collect()}
    fit = {r.doc_id for r in labels.where((F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(p.held_out)) != 0) & (F.col("quality") == 1)).collect()}
    import pyarrow as pa

    raw, target, features = np.ones(p.buckets), np.ones(p.buckets), []
    for i, t in enumerate(texts):
        (_, _, data, offsets), = chunks(pa.array([t]))
        f, _ = resample.features(data, offsets, p.buckets)
        features.append(f)
        np.add.at(raw, f, 1)
        if i in fit:
            np.add.at(target, f, 1)
    rate = raw / raw.sum()
    ratio = np.log((target + 5 * rate * p.buckets) / (target.sum() + 5 * p.buckets)) - np.log(rate)
    want = [ratio[f].sum() / max(1.0, len(f) / p.tempered_at) for f in features]
    assert all(abs(got[i].log_weight - w) < 1e-6 for i, w in enumerate(want))
    ranked = sorted(got.values(), key=lambda r: -r.sort_key)
    k = sum(r.kept for r in ranked)
    assert 0 < k < 200 and all(r.kept for r in ranked[:k])
    # of texts of a few words noise decides, of longer ones the weight
    long = [r for r in ranked if len(features[r.doc_id]) > 300]
    assert len(long) > 30 and all(r.kept == (r.doc_id % 4 > 0) for r in long)


def test_sketches_agree_as_often_as_sets_do():
    import numpy as np

    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 900).astype(np.uint64)
    pairs = [near_dup.sketches([a[:i], a[i // 9 : i]]) for i in (9, 90, 900)]
    for s in pairs:
        assert abs((s[0] == s[1]).mean() - 8 / 9) < 0.12


def test_tokens(docs, nothing):
    model = public_tokenizers.path("piece_bpe_32k.model")
    plain = sentencepiece.SentencePieceProcessor(model_file=model)
    for r in tokens.count_tokens(docs, model, limit=100).collect():
        assert r.n_tokens == len(plain.encode(r.text or "")) and r.n_bytes == len((r.text or "").encode()) and r.over_limit == (r.n_tokens > 100)
    assert tokens.count_tokens(nothing, model).count() == 0


def test_tokens_of_odd_texts():
    model = public_tokenizers.path("piece_bpe_32k.model")
    counter, rng = tokens.Counter(model, memory=100), random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", "\t", "\r", "▁", "é", "the", "<s>", "0", "　", "世", "😀", "\x00", "foo", "{", "}", ";"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        assert counter.count(text) == len(counter.processor.encode(text)), repr(text)


def test_warc(spark, tmp_path):
    big = "<html>" + "x" * 200
    pages = [(None, None, None), (None, "http://a/ b\r\n", big), (3, "http://c", big), (1, "http://d", big), (1, "http://d", big), (2, "", "small"), (4, None, "small"), (5, "u", "é" * 60_000), (6, "u", "é" * 60_000)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    p = warc.Params(shard_bytes=100_000, file_bytes=300)
    digests = []
    for n, table in enumerate((df, df.repartition(3))):
        folder = f"file://{tmp_path}/w{n}"
        manifest = warc.write_archives(table, folder, p)
        digests.append(sorted((r.file, r.sha256) for r in manifest.collect()))
        got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_archives(spark, folder).collect()), key=str)
        size = lambda h: len((h or "").encode())
        first = {3: 1, 6: 5}
        assert got == sorted(((i, size(h), "revisit" if i in first else "response", first.get(i)) for i, _, h in pages), key=str)
        texts = {r.payload.decode() for r in warc.read_archives(spark, folder, with_payload=True).where("record_type = 'response'").collect()}
        assert texts == {h or "" for _, _, h in pages}
    assert digests[0] == digests[1] and len(digests[0]) > 3
    empty = warc.write_archives(df.limit(0), f"file://{tmp_path}/none")
    assert empty.count() == 0 and warc.read_archives(spark, f"file://{tmp_path}/none").count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(10, 1), (11, 1), (41, 0)], "doc_id bigint, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench = spark.createDataFrame([(1, "two words")], "item_id bigint, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    at, ids = docs, [Counter(r.doc_id for r in docs.collect())]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = common.cut(stage(spark, at, str(tmp_path)), "test-stage")
        assert at.columns == docs.columns, name
        ids.append(Counter(r.doc_id for r in at.collect()))
    # a document of each group of copies stays, those with the benchmark's words go, mixing loses none
    assert all(not after - before for before, after in zip(ids, ids[1:], strict=False))
    assert sum(ids[2][i] for i in range(30, 40)) == 1 and ids[1][5] == 3 and ids[2][5] == 1 and ids[3][5] == 0
    assert set(ids[2]) - set(ids[3]) == {5} and ids[3] == ids[4] and ids[4][29] == ids[1][29]
    mixed = [r.text for r in at.orderBy("_metadata.file_name", "_metadata.row_index").collect()]
    last = corpus_pipeline.STAGES[-1][1](spark, at, str(tmp_path)).orderBy("shard", "slot").collect()
    assert [r.text for r in last] == mixed and len(mixed) > 20
    mark = common.named_folders()
    whole = corpus_pipeline.run(spark, str(tmp_path)).orderBy("shard", "slot").collect()
    assert Counter(r.text for r in whole) == Counter(mixed) and common.named_folders() - mark == 2
    with pytest.warns(UserWarning):
        assert corpus_pipeline.sharding_stage(spark, docs.where("doc_id > 5").limit(3).union(docs.limit(0)).distinct(), str(tmp_path)).count() <= 3
