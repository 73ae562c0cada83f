"""Helpers that the corpus operators share."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of all word and line contracts here, [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

LONG_MIN = -(2**63)


#: Folders that shared_dir() has named in this driver, oldest first; see release().
_named: list[str] = []


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's ``spark.checkpoint.dir``.

    Where that setting is absent a temporary folder of this machine takes its
    place, but only if driver and tasks are one process, as in local tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith(("local[", "local ")) and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="binlattice-")
    _named.append(f"{base.rstrip('/')}/binlattice/{label}-{uuid.uuid4().hex}")
    return _named[-1]


def named_folders() -> int:
    """How many folders shared_dir() has named; a mark for release()."""
    return len(_named)


def last_named() -> list[str]:
    """The folder that shared_dir() named last, such as that of the last cut()."""
    return _named[-1:]


def release(spark: SparkSession, since: int, keep: Iterable[str] = ()) -> None:
    """Delete the folders named since a mark, but those to keep. Tables in them must not be read any more."""
    kept = set(keep)
    for path in _named[since:]:
        if path not in kept:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _named[since:] = [p for p in _named[since:] if p in kept]


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which ends its lineage there."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def seal(df: DataFrame, out: Iterable[str] = (), **more: Column) -> tuple[DataFrame, list[Column]]:
    """(table, back): the columns of ``df`` as c0, c1, .. beside ``more``, and what gives them their names again.

    Within an operator no name of the input can then clash with one of its own.
    ``back`` leaves out the input's columns that have a name in ``out``, whatever
    its case: the operator's column of that name replaces them.
    """
    taken = {n.lower() for n in out}
    table = df.select("*", *[c.alias(n) for n, c in more.items()]).toDF(*[f"c{i}" for i in range(len(df.columns))], *more)
    return table, [F.col(f"c{i}").alias(n) for i, n in enumerate(df.columns) if n.lower() not in taken]


def constant(values: Sequence, kind: str) -> Column:
    """A driver-side list as one literal of the type ``array<kind>``, however long it is."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def small_table(spark: SparkSession, rows: Sequence[dict], kind: str) -> DataFrame:
    """A table of driver-side rows of bounded number, made by Spark itself from one literal."""
    return spark.range(1).select(F.inline(constant(rows, f"struct<{kind}>")))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns whose names an operator is about to produce.

    The rule for clashing names throughout: the operator's column replaces the
    input's column of that name, whatever its case.
    """
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A column that a lambda refers to would be inlined and evaluated again for
    every element; as the variable of an outer lambda it is a value.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Maximal runs of characters outside ``WHITE``; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def windows_hash(hashes: Column, k: int) -> Column:
    """Hash of each run of ``k`` neighbouring elements; empty with fewer than ``k``."""
    return F.when(
        F.size(hashes) >= k,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - k),
            lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def row_key(df: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """(id, hash of the text): tells rows apart that share an id; null ids count as one id."""
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(LONG_MIN)), F.xxhash64(F.col(text_col))
