"""Conversation structure repair: cheapest edits by an auction for the shortest path through a lattice of rows and roles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_BREAK, cut

#: States of a conversation that is repaired up to some row: nothing yet, after the system row, after a user row, after an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: By state: the state after a user or assistant row that may follow, and the state after a row of role initial s, u, a or another (-1: not allowed).
NEXT = (USER, USER, ASSISTANT, USER)
AFTER = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
#: Costs of the edits; a truncated row that stays costs REROLE more.
DELETE, INSERT, REROLE = 4, 3, 3
#: A row's code is its role initial (0 s, 1 u, 2 a, 3 other) + 4 * fault (0 none, 1 truncated, 2 blank or duplicate).
#: A conversation is solved in blocks of at most 2**BLOCK_BITS rows.
BLOCK_BITS = 6
#: Stands for no way. More than any way through a block and what its end state could cost later; small, as prices of nodes without a way climb to it.
FAR = 16 << BLOCK_BITS


def _arcs(codes: list[int], row: int, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, row, state) of the edits at a node, by letter."""
    role, fault = codes[row] & 3, codes[row] >> 2
    out = [("D", DELETE, row + 1, state), ("I", INSERT, row, NEXT[state])]
    if fault < 2:
        more = REROLE * fault
        if AFTER[state][role] >= 0:
            out.append(("K", more, row + 1, AFTER[state][role]))
        if role != (2 if NEXT[state] == ASSISTANT else 1):
            out.append(("R", more + REROLE, row + 1, NEXT[state]))
    return out


def first_prices(codes: list[int], exits: list[int]) -> list[list[int]]:
    """For every node what the rows from there on cost at least, each by itself; behind the last row ``exits``."""
    prices = [list(exits)]
    for code in reversed(codes):
        fault, odd = code >> 2, code & 3 == 3
        least = DELETE if fault == 2 else min(DELETE, REROLE * (fault + odd))
        prices.append([min(prices[-1]) + least] * 4)
    return prices[::-1]


def auction_path(codes: list[int], state: int, exits: list[int], prices: list[list[int]] | None = None) -> tuple[int, str, int]:
    """(cost, letters, state at the end) of the cheapest edits of a block from ``state`` on, of the cheapest the ASCII-least.

    ``exits`` are the prices of the four states behind the last row: what the rows after it cost from there.
    The auction keeps a path from the first node and prices p with p(i) <= cost(i, j) + p(j) on every arc. At the path's last node it extends by a
    tight arc, or where none is tight raises the price to the least cost(i, j) + p(j) and gives the node up. Prices start at what each row from
    there on costs at least, which satisfies the condition. When the path reaches the end all its arcs are tight, hence it is a shortest one, and
    so is every path of tight arcs to the end. Of tight arcs the first letter is taken; as prices only rise and those of nodes on the path stand
    still, an arc passed over as not tight stays so: the path that is left is the least in letters. ``prices`` are those that an auction from another
    state has left; they are raised further.
    """
    n = len(codes)
    prices = prices or first_prices(codes, exits)
    arcs: dict[tuple[int, int], list] = {}
    path, letters = [(0, state)], []
    while path[-1][0] < n:
        i, q = path[-1]
        out = arcs.get((i, q)) or arcs.setdefault((i, q), _arcs(codes, i, q))
        least = min(cost + prices[r][s] for _, cost, r, s in out)
        if least > prices[i][q]:
            prices[i][q] = least
            if letters:
                path.pop()
                letters.pop()
        else:
            letter, _, r, s = next(a for a in out if a[1] + prices[a[2]][a[3]] == least)
            path.append((r, s))
            letters.append(letter)
    return prices[0][state], "".join(letters), path[-1][1]


#: What is left to do behind the last row: a user and an assistant row after a system row, an assistant row after a user row.
AT_END = [0, 2 * INSERT, INSERT, 0]
END_LETTERS = ["", "II", "I", ""]


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of conversations, some of them damaged by the hash of conversation and turn; a null role or text becomes one space, as does a null in the hash.

    Of twenty hashes 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row and 4 makes its role user.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20).alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("h") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("h > 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _placed(rows: DataFrame) -> DataFrame:
    """The rows in order, with ``place``, ``fault`` and ``code``, stored.

    Ranges of the order are dealt to tasks with a random last key, so that neither a conversation nor a row that is repeated very often is one
    task's; ``place`` is the task and the row's number in it. Of rows alike in role and text all but the one with the first place are duplicates.
    """
    given = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = given.select("*", F.substring("text", 1, 64).alias("head"), F.sha2("text", 256).alias("digest"), F.rand(7).alias("lot"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "head", "digest", "lot")]
    ordered = cut(keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()).drop("head", "lot"), "placed-rows")
    firsts = ordered.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("is_first"))
    bare = F.regexp_replace("text", f"^{WORD_BREAK}|{WORD_BREAK}$", "")
    fault = F.when(bare == "", "blank").when(F.col("is_first").isNull(), "duplicate").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3) + F.when(F.col("fault") == "truncated", 4).when(F.col("fault").isNotNull(), 8).otherwise(0)
    judged = ordered.join(firsts, "place", "left").withColumn("fault", fault)
    return cut(judged.select("conv_id", "place", "turn", "role", "text", "fault", code.alias("code")), "judged-rows")


def _blocks(placed: DataFrame) -> DataFrame:
    """(conv_id, key, places, codes): what a conversation has of each stretch of places, at most 2**BLOCK_BITS rows; ``key`` is the first place."""
    held = F.sort_array(F.collect_list(F.struct("place", "code")))
    rows = placed.groupBy("conv_id", F.shiftright("place", BLOCK_BITS).alias("stretch")).agg(held.alias("held"))
    return rows.select("conv_id", F.get("held", F.lit(0))["place"].alias("key"), F.col("held.place").alias("places"), F.col("held.code").alias("codes"))


def _alone(codes: pd.Series) -> pd.DataFrame:
    solved = [auction_path(c.tolist(), EMPTY, AT_END) for c in codes]
    return pd.DataFrame({"state": [EMPTY] * len(solved), "letters": [letters + END_LETTERS[end] for _, letters, end in solved]})


def _from_all(codes: list[int], exits: list[int]) -> list[tuple[int, str, int]]:
    """auction_path() from each state."""
    prices = first_prices(codes, exits)
    return [auction_path(codes, q, exits, prices) for q in range(4)]


def _crossing(codes: pd.Series) -> pd.Series:
    """The costs from each state to each, 4 * from + to; FAR where there is no way.

    A conversation stays empty, or with its system row alone, only by deletions; auctions find the ways to the other two states, which all states reach.
    """
    out = []
    for rows in map(np.ndarray.tolist, codes):
        gone = DELETE * len(rows)
        first = min((REROLE * (c >> 2) - DELETE for c in rows if c in (0, 4)), default=FAR)
        ends = [[way[0] for way in _from_all(rows, [FAR * (e != end) for e in range(4)])] for end in (USER, ASSISTANT)]
        few = [[gone, min(FAR, gone + first)], [FAR, gone], [FAR, FAR], [FAR, FAR]]
        out.append([cost for q in range(4) for cost in (*few[q], ends[0][q], ends[1][q])])
    return pd.Series(out, dtype=object)


def _ways(codes: pd.Series, exits: pd.Series) -> pd.Series:
    return pd.Series([[{"letters": letters, "end": end} for _, letters, end in _from_all(c.tolist(), e.tolist())] for c, e in zip(codes, exits)], dtype=object)


def _edits(codes: pd.Series, state: pd.Series, letters: pd.Series) -> pd.Series:
    out = []
    for rows, q, word in zip(map(np.ndarray.tolist, codes), state, letters):
        edits, row = [], 0
        for letter in word:
            to, cost, role = q, DELETE, None
            if letter in "IR":
                to, cost = NEXT[q], REROLE if letter == "R" else INSERT
                role = "assistant" if to == ASSISTANT else "user"
            elif letter == "K":
                to, cost = AFTER[q][rows[row] & 3], 0
            if letter in "KR":
                cost += REROLE * (rows[row] >> 2)
            edits.append({"edit": letter, "cost": cost, "row": min(row, len(rows) - 1), "new_role": role})
            q, row = to, row + (letter != "I")
        out.append(edits)
    return pd.Series(out, dtype=object)


def _solved(blocks: DataFrame) -> DataFrame:
    """``blocks`` with the state in which its conversation enters each, and the letters of its edits.

    A conversation within one block is solved at once. One of several takes three steps: what it costs to cross a block from each state to each;
    from the last block back, the prices of the states behind each block; then each block's edits from all four states, of which those are kept
    that the blocks before lead to. The folds hold 16 and 4 numbers a block.
    """
    counted = blocks.groupBy(F.col("conv_id").alias("c")).agg(F.count("*").alias("n_blocks"), F.max("key").alias("last"))
    known = blocks.join(counted, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    single = known.where("n_blocks = 1").withColumn("s", F.pandas_udf(_alone, "state int, letters string")("codes")).select("key", "places", "codes", "s.state", "s.letters", "conv_id")
    # few rows of much work each: dealt to as many tasks as a shuffle has, which are not joined to one
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    several = cut(known.where("n_blocks > 1").repartition(tasks, "key").withColumn("cost", F.pandas_udf(_crossing, "array<bigint>")("codes")), "block-costs")

    exits_of = "array<struct<key:bigint,exits:array<bigint>>>"
    through = lambda cost, exits: F.array(*[F.array_min(F.array(*[F.get(cost, F.lit(4 * q + e)) + F.get(exits, F.lit(e)) for e in range(4)])) for q in range(4)])
    start = F.struct(F.array().cast(exits_of).alias("out"), F.array(*[F.lit(x).cast("bigint") for x in AT_END]).alias("exits"))
    back = lambda a, b: F.struct(F.concat(a["out"], F.array(F.struct(b["key"].alias("key"), a["exits"].alias("exits")))).alias("out"), through(b["cost"], a["exits"]).alias("exits"))
    costs = several.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("key", "cost")), False).alias("held"))
    exits = costs.select(F.inline(F.aggregate("held", start, back)["out"]))
    ways = cut(several.join(exits, "key").repartition(tasks, "key").withColumn("ways", F.pandas_udf(_ways, "array<struct<letters:string,end:int>>")("codes", "exits")), "block-ways")

    states_of = "array<struct<key:bigint,state:int>>"
    begin = F.struct(F.array().cast(states_of).alias("out"), F.lit(EMPTY).alias("state"))
    on = lambda a, b: F.struct(F.concat(a["out"], F.array(F.struct(b["key"].alias("key"), a["state"].alias("state")))).alias("out"), F.get(b["ends"], a["state"]).alias("state"))
    ends = ways.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("key", F.col("ways.end").alias("ends")))).alias("held"))
    states = ends.select(F.inline(F.aggregate("held", begin, on)["out"]))
    way = F.get("ways", F.col("state"))
    tail = F.when(F.col("key") == F.col("last"), F.get(F.array(*map(F.lit, END_LETTERS)), way["end"])).otherwise("")
    joined = ways.join(states, "key").select("key", "places", "codes", "state", F.concat(way["letters"], tail).alias("letters"), "conv_id")
    return single.unionByName(joined)


def _edit_rows(placed: DataFrame, blocks: DataFrame) -> DataFrame:
    edits = _solved(blocks).withColumn("edits", F.pandas_udf(_edits, "array<struct<edit:string,cost:int,row:int,new_role:string>>")("codes", "state", "letters")).select("conv_id", "key", "places", F.posexplode("edits").alias("step", "e"))
    # an inserted row carries the place of a row beside it, so that the join has no key without rows
    found = edits.select("conv_id", "key", "step", F.get("places", F.col("e.row")).alias("place"), "e.edit", "e.cost", "e.new_role")
    text, inserted = placed.select("place", "turn", "role", "text", "fault"), F.col("edit") == "I"
    own = lambda c: F.when(~inserted, F.col(c)).alias(c)
    return found.join(text, "place").select("conv_id", "key", "step", "edit", F.col("cost").cast("bigint").alias("cost"), own("turn"), F.coalesce("new_role", "role").alias("role"), F.when(inserted, "").otherwise(F.col("text")).alias("text"), own("fault"))


def repair(conversations: DataFrame) -> DataFrame:
    r"""The cheapest edits that give every conversation the role initials ``(s?(ua)+)?``: one row an edit, in the order of (key, step) within conv_id.

    Input: conv_id, turn, role, text. Output: conv_id, key, step, ``edit`` (K keep, D delete, I insert, R rerole), its ``cost``, and the row that
    results, or that goes: turn, role, text, with its ``fault`` as given: blank (nothing outside ``[ 	-
]``), else duplicate (role and text
    seen earlier in the conversation), else truncated (the last such character is none of ``.!?``). Keep costs 0, rerole to user or assistant 3,
    delete 4, which blank and duplicate rows require, insert a user or assistant row without text 3; a truncated row that stays costs 3 more. Of the
    cheapest ways the one with the ASCII-least letters is taken, which is unique. It is found by auctions, see auction_path(), in blocks of 64 rows.

    Rows of a turn are ordered by role, the first 64 characters of the text and its hash; null turns come first. Defined cases: null role or text is
    an empty string; a null conv_id is a conversation; rows alike in all columns are rows of their own (duplicates, but for the first); a long
    conversation is dealt to tasks in blocks, of which folds hold 20 numbers each; a long text goes through joins as it is; other columns aren't returned; an empty table
    gives an empty result.
    """
    placed = _placed(conversations)
    return _edit_rows(placed, _blocks(placed))


def _digested(edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): letters and the hash of the rows that stay, read in order, a row at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, letters, sha, empty = None, [], None, True
        for batch in batches:
            done = []
            for conv, opens, letter, line in zip(batch["conv_id"].tolist(), batch["opens"], batch["edit"], batch["line"]):
                if opens:
                    if sha:
                        done.append((now, "".join(letters), sha.hexdigest()))
                    now, letters, sha, empty = conv, [], hashlib.sha256(), True
                letters.append(letter)
                if line is not None:
                    sha.update((line if empty else "\n" + line).encode())
                    empty = False
            yield pd.DataFrame(done, columns=["conv_id", "audit", "repaired_sha256"])
        if sha:
            yield pd.DataFrame([(now, "".join(letters), sha.hexdigest())], columns=["conv_id", "audit", "repaired_sha256"])

    first = F.lag("step").over(Window.partitionBy("conv_id").orderBy("key", "step")).isNull()
    lines = edits.select(F.col("conv_id").cast("string").alias("conv_id"), "key", "step", "edit", F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text")).alias("line"))
    return lines.select("conv_id", first.alias("opens"), "edit", "line").mapInPandas(run, "conv_id string, audit string, repaired_sha256 string")


def digest(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """One row for every conv_id of ``conversations``: counts of the faults of ``damaged``, cost and letters of its repair, and a hash of the result.

    A conversation's rows are read in order by one task, a row at a time, as a hash of their sequence requires; only its letters are held.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    placed = _placed(damaged)
    blocks = cut(_blocks(placed), "blocks")
    edits = cut(_edit_rows(placed, blocks), "edits")
    zero = lambda *names: [F.lit(0).cast("bigint").alias(n) for n in names]
    none = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
    faults, turns, out = ("blank", "duplicate", "truncated"), ("turns", "low", "high"), ("audit", "repaired_sha256")
    pair = F.transform(F.sequence(F.lit(1), F.size("codes") - 1), lambda i: 4 * F.get("codes", i - 1).bitwiseAND(3) + F.get("codes", i).bitwiseAND(3))
    wrong = lambda p: ~p.isin(1, 6, 9)
    before = F.lag("last").over(Window.partitionBy("conv_id").orderBy("key"))
    seen = blocks.select("conv_id", "key", F.get("codes", F.lit(0)).bitwiseAND(3).alias("first"), F.get("codes", F.size("codes") - 1).bitwiseAND(3).alias("last"), F.when(F.size("codes") > 1, F.size(F.filter(pair, wrong))).otherwise(0).alias("inside"))
    illegal = seen.select("conv_id", (F.col("inside") + F.coalesce(wrong(4 * before + F.col("first")).cast("int"), F.lit(0))).cast("bigint").alias("illegal"))
    parts = [
        conversations.select("conv_id", *zero(*faults), *none("bigint", *turns), *zero("illegal", "cost"), *none("string", *out)),
        placed.select("conv_id", *[F.coalesce((F.col("fault") == f).cast("bigint"), F.lit(0)).alias(f) for f in faults], *none("bigint", *turns), *zero("illegal", "cost"), *none("string", *out)),
        placed.where("turn IS NOT NULL").groupBy("conv_id", "turn").count().select("conv_id", *zero(*faults), F.lit(1).cast("bigint").alias("turns"), F.col("turn").cast("bigint").alias("low"), F.col("turn").cast("bigint").alias("high"), *zero("illegal", "cost"), *none("string", *out)),
        illegal.select("conv_id", *zero(*faults), *none("bigint", *turns), "illegal", *zero("cost"), *none("string", *out)),
        edits.select("conv_id", *zero(*faults), *none("bigint", *turns), *zero("illegal"), "cost", *none("string", *out)),
        _digested(edits).select(F.col("conv_id").cast(kind).alias("conv_id"), *zero(*faults), *none("bigint", *turns), *zero("illegal", "cost"), *out),
    ]
    union = parts[0]
    for p in parts[1:]:
        union = union.union(p)
    sums = [F.sum(c).alias(c) for c in (*faults, "turns", "illegal", "cost")]
    found = union.groupBy("conv_id").agg(*sums, F.min("low").alias("low"), F.max("high").alias("high"), *[F.max(c).alias(c) for c in out])
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    return found.select("conv_id", gaps, *faults, "illegal", "cost", F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
