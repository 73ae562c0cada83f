"""Order over a whole table without one task that sees it all: ranges of the sort key, with what carries over from one range to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binlattice.functions.storage import stored


def _dealt(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` with the sort keys __k0, __k1, .. and the number of the range that holds the row; stored, as ranges come from a sample that is drawn anew each time."""
    keyed = df.withColumns({f"__k{i}": c for i, c in enumerate(order)})
    return stored(keyed.repartitionByRange(*[f"__k{i}" for i in range(len(order))]).withColumn("__range", F.spark_partition_id()))


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` plus each row's place, from 1: that within its range plus the rows of the ranges before, of which there is one number a range."""
    dealt = _dealt(df, order)
    keys = [f"__k{i}" for i in range(len(order))]
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("n")).agg(F.collect_list(F.struct("__range", "n")).alias("__sizes"))
    before = F.aggregate(F.filter("__sizes", lambda s: s["__range"] < F.col("__range")), F.lit(0).cast("bigint"), lambda a, s: a + s["n"])
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*keys)) + before
    return dealt.crossJoin(F.broadcast(sizes)).withColumn(name, place).drop(*keys, "__range", "__sizes")


def with_next(df: DataFrame, value: str, name: str) -> DataFrame:
    """``df`` plus the value that follows in ascending order; a range's last value is followed by the first of the next range. Nulls are left out."""
    dealt = _dealt(df.where(F.col(value).isNotNull()), [F.col(value)])
    firsts = dealt.groupBy("__range").agg(F.min(value).alias("first")).agg(F.collect_list(F.struct("__range", "first")).alias("__firsts"))
    beyond = F.array_min(F.transform(F.filter("__firsts", lambda s: s["__range"] > F.col("__range")), lambda s: s["first"]))
    here = F.lead(value).over(Window.partitionBy("__range").orderBy(value))
    return dealt.crossJoin(F.broadcast(firsts)).withColumn(name, F.coalesce(here, beyond)).drop("__k0", "__range", "__firsts")
