"""Quality rules as a short-circuit cascade ordered by rejection per cost."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, let, seal, windows_hash, words_of
from .lines import lines_of

#: The characters that count as symbols, and what a line of a list begins with.
SYMBOLS = "#*$%&|<>"
BULLETS = ["•", "‣", "-", "*", "–"]
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
WINDOW = 8


def _covered(places: Column, k: int) -> Column:
    """How many words the windows of ``k`` words at the ordered places cover."""
    return F.aggregate(
        F.sequence(F.lit(0), F.size(places) - 1),
        F.lit(0),
        lambda n, i: n + F.least(F.lit(k), F.coalesce(F.get(places, i + 1) - F.get(places, i), F.lit(k))),
    )


def _repeats(hashes: Column, k: int) -> Column:
    """Words in windows whose hash occurs more than once."""

    def places(s: Column) -> Column:
        twice = lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"]))

    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(by_hash, lambda s: let(places(s), lambda p: _covered(p, k))))


Known = dict[str, Column]


@dataclass(frozen=True)
class Measure:
    """A value taken of a text, from it and from other measures that it ``needs``.

    ``work`` gives its steps a character, a line, a word and a window of words of the text; how many of each texts have, a sample tells.
    """

    needs: tuple[str, ...]
    of: Callable[[Column, Known], Column]
    work: tuple[float, float, float, float]


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE))


def _filled_lines(text: Column) -> Column:
    return F.filter(lines_of(text), lambda line: _bare(line) != "")


def _lines_where(test: Callable[[Column], Column]) -> Callable[[Column, Known], Column]:
    return lambda t, m: F.size(F.filter(lines_of(t), lambda line: test(_bare(line))))


#: What SIZES counts of a text.
SIZES = ("chars", "lines", "words", "windows")
#: Steps of a pass that drops or counts characters, one by a regular expression, splitting into lines and looking at each, splitting into words and
#: hashing them, hashing and looking up windows of words.
PASS, REGEX, LINES, WORDS, WINDOWS = (1.0, 0.0, 0.0, 0.0), (6.0, 0.0, 0.0, 0.0), (2.0, 25.0, 0.0, 0.0), (2.0, 0.0, 30.0, 0.0), (0.0, 0.0, 0.0, 100.0)

#: Texts are not null here. Words are runs outside [\\x20\\x09-\\x0D]; n_repeat_words counts the words in windows of
#: WINDOW words that the text holds at least twice: windows are hashed, and sorted only where a hash occurs again.
TAKEN = {
    "some_words": Measure((), lambda t, m: F.size(F.filter(F.split(t, r"[\x20\x09-\x0D]+", 22), lambda w: w != "")), (0.5, 0.0, 0.0, 0.0)),
    "word_hashes": Measure((), lambda t, m: F.transform(words_of(t), lambda w: F.xxhash64(w)), WORDS),
    "n_words": Measure(("word_hashes",), lambda t, m: F.size(m["word_hashes"]).cast("bigint"), (0.0, 0.0, 0.0, 0.0)),
    "n_repeat_words": Measure(("word_hashes",), lambda t, m: let(windows_hash(m["word_hashes"], WINDOW), lambda h: _repeats(h, WINDOW)).cast("bigint"), WINDOWS),
    "word_chars": Measure((), lambda t, m: F.length(F.translate(t, WHITE, "")).cast("bigint"), PASS),
    "n_symbols": Measure((), lambda t, m: (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint"), PASS),
    "n_marks": Measure((), lambda t, m: F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit(""))), PASS),
    "n_lines": Measure((), lambda t, m: F.size(lines_of(t)), LINES),
    "n_dup_lines": Measure((), lambda t, m: let(_filled_lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"), (4.0, 50.0, 0.0, 0.0)),
    "n_bullets": Measure((), _lines_where(lambda line: F.substring(line, 1, 1).isin(*BULLETS)), (4.0, 50.0, 0.0, 0.0)),
    "n_trailing": Measure((), _lines_where(lambda line: F.endswith(line, F.lit("...")) | F.endswith(line, F.lit("…"))), (4.0, 50.0, 0.0, 0.0)),
    "n_letters": Measure((), lambda t, m: F.length(F.regexp_replace(t, r"[^\p{L}]+", "")), REGEX),
    "n_capitals": Measure((), lambda t, m: F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")), REGEX),
}


def _with_needs(names: Iterable[str], known: Iterable[str] = ()) -> list[str]:
    """The measures to take for those named, in an order in which each finds what it needs."""
    out: list[str] = []
    for name in names:
        for x in [*_with_needs(TAKEN[name].needs, [*known, *out]), name]:
            if x not in known and x not in out:
                out.append(x)
    return out


def _taking(names: list[str], text: Column, known: Known, body: Callable[[Known], Column]) -> Column:
    """``body`` with the measures named taken, each once."""
    if not names:
        return body(known)
    return let(TAKEN[names[0]].of(text, known), lambda v: _taking(names[1:], text, known | {names[0]: v}, body))


def taken_alone(name: str, text: Column) -> Column:
    """One measure of a text that is not null."""
    return _taking(_with_needs([name]), text, {}, lambda m: m[name])


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus MEASURES of the whole text, null text counting as empty; input columns of these names are replaced, all others stay."""
    table, back = seal(docs, MEASURES, text=F.coalesce(docs[text], F.lit("")))
    taken = _taking(_with_needs(MEASURES), F.col("text"), {}, lambda m: F.struct(*[m[n].alias(n) for n in MEASURES]))
    return table.withColumn("taken", taken).select(*back, *[F.col(f"taken.{n}").alias(n) for n in MEASURES])


@dataclass(frozen=True)
class Rule:
    """A named test that is true for texts to reject, on the measures that it needs."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Known], Column]


def base_rules() -> list[Rule]:
    # of some_words, the first 20 words are counted and no more
    return [
        Rule("too_few_words", ("some_words",), lambda m: m["some_words"] < 20),
        Rule("repeated_windows", ("n_words", "n_repeat_words"), lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    ]


def production_rules() -> list[Rule]:
    """Each is meant to spare any ordinary prose. None rejects an empty text."""
    return [
        Rule("word_length", ("n_words", "word_chars"), lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"])),
        Rule("symbols", ("n_words", "n_symbols"), lambda m: 10 * m["n_symbols"] > m["n_words"]),
        Rule("exclamations", ("n_words", "n_marks"), lambda m: 5 * m["n_marks"] > m["n_words"]),
        Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda m: 10 * m["n_dup_lines"] > 3 * m["n_lines"]),
        Rule("bullet_lines", ("n_lines", "n_bullets"), lambda m: 10 * m["n_bullets"] > 9 * m["n_lines"]),
        Rule("unfinished_lines", ("n_lines", "n_trailing"), lambda m: 10 * m["n_trailing"] > 3 * m["n_lines"]),
        Rule("few_letters", ("n_letters", "word_chars"), lambda m: 2 * m["n_letters"] < m["word_chars"]),
        Rule("capitals", ("n_letters", "n_capitals"), lambda m: 2 * m["n_capitals"] > m["n_letters"]),
    ]


@dataclass(frozen=True)
class Estimate:
    """rejected: share of the sample's rows that reach the rule. work: their mean steps for what the rules before have not taken already."""

    rule: Rule
    rejected: float
    work: float


def estimate(docs: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = 2000) -> list[Estimate]:
    """The rules in falling order of rejection per cost, with the estimates that decide it.

    The sample is the rows whose hash of the text falls in a fixed share, about ``sample_rows`` of them (all of a smaller table). All rules are tried
    on it where it is; a row for each set of rules that reject a text reaches the driver, 2**rules at most, with the number of such texts and their
    characters, lines, words and windows. From these the rules are taken one after the other: each time the one with the most rejections per step
    among the rows that no rule before rejects, its steps being those of its measures that no rule before takes, on those rows. Steps are counted, not
    timed, so the same rows give the same order in every run. Only the order of evaluation rests on the sample, never a verdict.
    """
    share = max(1, docs.count() // sample_rows)
    t = F.coalesce(F.col(text), F.lit(""))
    sampled = docs.where(F.pmod(F.xxhash64(F.col(text)), F.lit(share)) == 0) if share > 1 else docs
    hits = _taking(_with_needs([n for r in rules for n in r.needs] + ["n_words", "n_lines"]), t, {}, lambda m: F.struct(
        F.array(*[r.rejects(m) for r in rules]).alias("hits"), F.length(t).alias("chars"), m["n_lines"].alias("lines"), m["n_words"].alias("words"), F.greatest(m["n_words"] - WINDOW + 1, F.lit(0)).alias("windows"),
    ))
    found = sampled.select(hits.alias("m")).select("m.*").groupBy("hits").agg(F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in SIZES]).collect()
    order: list[Estimate] = []
    left, known = dict(enumerate(rules)), []
    while left:
        rows = sum(f.rows for f in found)
        sizes = [sum(f[c] for f in found) / max(1, rows) for c in SIZES]
        rejected = {i: sum(f.rows for f in found if f.hits[i]) / max(1, rows) for i in left}
        works = {i: sum(x * y for n in _with_needs(r.needs, known) for x, y in zip(TAKEN[n].work, sizes, strict=True)) for i, r in left.items()}
        best = min(left, key=lambda i: (-rejected[i] / (works[i] + 1), works[i], left[i].name))
        order.append(Estimate(left[best], rejected[best], works[best]))
        known += _with_needs(left.pop(best).needs, known)
        found = [f for f in found if not f.hits[best]]
    return order


def all_taken(taken: Column, text: Column) -> Column:
    """What a cascade has taken of a row, with all that it has not taken: then all MEASURES are taken in one go, each once."""
    some_missing = F.greatest(*[taken[n].isNull() for n in MEASURES])
    anew = _taking(_with_needs(MEASURES), F.coalesce(text, F.lit("")), {}, lambda m: F.struct(*[m[n].alias(n) for n in MEASURES]))
    return F.when(some_missing, anew).otherwise(taken)


def cascade(docs: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = 2000, keep: Iterable[str] = ()) -> DataFrame:
    """``docs`` plus ``failed_rule``, the first rule, in the estimated order, that rejects the row, else null, and ``taken``.

    A rule's measures are taken when its turn comes, each once for all rules, so of a row that an early rule rejects
    the dearer ones are never taken. ``taken`` is a struct of the measures in ``keep``: what the cascade has taken of the row,
    null where it came to a verdict before. Which rule is named depends on the order and so on the
    sample; whether one is named doesn't.

    Defined cases: null text counts as empty; equal rows get equal verdicts; a text of any length is measured
    as a whole, in one task; input columns called failed_rule or taken are replaced, others stay; an empty table gives an empty result.
    """
    order = [e.rule for e in estimate(docs, rules, text, sample_rows)]
    keep = list(keep)

    def outcome(name: Column, known: Known) -> Column:
        return F.struct(name.alias("failed_rule"), F.struct(*[(known[n] if n in known else F.lit(None).cast("bigint")).alias(n) for n in keep] or [F.lit(None).alias("none")]).alias("taken"))

    def verdict(left: list[Rule], known: Known) -> Column:
        if not left:
            return outcome(F.lit(None).cast("string"), known)
        missing = _with_needs(left[0].needs, known)
        return _taking(missing, F.col("text"), known, lambda m: F.when(left[0].rejects(m), outcome(F.lit(left[0].name), m)).otherwise(verdict(left[1:], m)))

    table, back = seal(docs, ["failed_rule", "taken"], text=F.coalesce(docs[text], F.lit("")))
    return table.withColumn("judged", verdict(order, {})).select(*back, F.col("judged.failed_rule").alias("failed_rule"), F.col("judged.taken").alias("taken"))
