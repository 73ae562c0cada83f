"""Token counts with a whole-token shortcut."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

#: SentencePiece's mark for a space.
SPACE = "▁"


#: Texts that a normaliser which isn't the identity (up to a first space mark and the marks for spaces) would change.
PROBES = ["a", " a", "a  b ", "ﬁ", "Ａ", "é", "e\u0301", "①", "a\tb", "a\nb", "\u3000", "\u200b", "ﷺ", "A\r", "\x01", "\ufeff"]


def prove_whole(processor) -> tuple[set[str], bool]:
    """(vocabulary strings that encode alone as one token, whether texts may be cut into pre-tokens).

    Cutting is exact if no piece joins what a cut parts: no piece has a space
    mark after another character, or holds a line feed or a tab, and the
    normaliser leaves every character as it is, which PROBES test. Then no merge
    crosses a cut, and a text's tokens are those of its pre-tokens. A vocabulary
    string counts as proven only if encoding it gives one token. This is done once, on the driver.
    """
    plain = (i for i in range(processor.get_piece_size()) if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i)))
    pieces = [processor.id_to_piece(i) for i in plain]
    plain_text = all(processor.normalize(t) == SPACE + t.replace(" ", SPACE) for t in PROBES)
    cuttable = plain_text and not any(SPACE in p.lstrip(SPACE) or "\n" in p or "\t" in p for p in pieces)
    # a pre-token is kept without its first space mark, which encoding puts back
    words = [p[1:] for p in pieces if len(p) > 1 and p.startswith(SPACE) and SPACE not in p[1:]]
    whole = {w for w, ids in zip(words, processor.encode(words, num_threads=1), strict=True) if len(ids) == 1}
    return whole, cuttable


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text that isn't empty.

    Each is a word with the space mark before it left out and any further marks
    as spaces ("" is a lone mark), or a line feed with what follows it up to a
    space. A tab is cut like a line feed and is a token of its own like one.
    """
    out: list[str] = []
    for i, line in enumerate(text.replace(SPACE, " ").replace("\t", "\n").split("\n")):
        words = line.split(" ")
        if i:
            words[0] = "\n" + words[0]
        if "" in words:
            joined, spaces = [], 0
            for w in words[:-1]:
                if w:
                    joined.append(" " * spaces + w)
                    spaces = 0
                else:
                    spaces += 1
            words = [*joined, " " * spaces + words[-1]]
        out += words
    return out


class Counter:
    """Counts tokens with a SentencePiece model. It remembers at most ``memory`` pre-tokens, none over 64 characters."""

    def __init__(self, model: str, proof: tuple[set[str], bool] | None = None, memory: int = 400_000):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        self.whole, self.cuttable = proof or prove_whole(self.processor)
        self.memory = memory
        self.known = dict.fromkeys(self.whole, 1) | {"": 1}

    def _encoded(self, words: list[str]) -> dict[str, int]:
        counts = map(len, self.processor.encode(words, num_threads=1))
        # a pre-token after a line feed has no space mark of its own; encoding adds one
        return {w: 1 if not w else n - (w[0] == "\n") for w, n in zip(words, counts, strict=True)}

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.cuttable:
            return len(self.processor.encode(text))
        words = pre_tokens(text)
        known = self.known
        missing = [w for w in set(words) if w not in known]
        if missing:
            if len(known) + len(missing) > self.memory:
                known = self.known = dict.fromkeys(self.whole, 1) | {"": 1}
                missing = [w for w in set(words) if w not in known]
            known.update(self._encoded(missing))
        total = sum(map(known.__getitem__, words))
        for w in missing:
            if len(w) > 64:
                del known[w]
        return total


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """``docs`` plus ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (n_tokens > limit) of the whole text.

    Tokens are those of the SentencePiece model without begin or end: pre-tokens
    proven to be one token count as one, others are merged once and remembered.
    A model whose pieces cross the cuts is run over whole texts instead. ``model``
    is a path that every executor has.

    Defined cases: null counts as empty (0 bytes, 0 tokens); special strings in
    a text are ordinary text; there is no truncation, so a very long text is
    counted whole by the task that reads it; equal rows each get their own count; input columns with the
    names of the results are replaced; an empty table gives an empty result.
    """
    docs = without(docs, ["n_bytes", "n_tokens", "over_limit"])
    first = Counter(model)
    proof = (first.whole, first.cuttable)  # at most the vocabulary, which goes to the tasks with the function

    @F.pandas_udf("bigint")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(model, proof)
        for batch in batches:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    out = docs.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")).withColumn("n_tokens", counted(F.col(text)))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
