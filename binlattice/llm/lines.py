"""Line deduplication against levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, ascii_lower, cut, let, row_key, shared_dir

#: A key of more than one in so many occurrences is looked up by broadcast; there are fewer than that many of them.
HEAVY = 4096


def lines_of(text: Column) -> Column:
    """The lines of a whole text, split at line feeds; null and empty text: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(text: Column, min_chars: int) -> Column:
    """One element a line: the MD5 (16 bytes) of the line's key, null for keys under ``min_chars`` code points."""
    key = lambda line: F.btrim(line, F.lit(WHITE))
    return F.transform(lines_of(ascii_lower(text)), lambda line: let(key(line), lambda k: F.when(F.length(k) >= min_chars, F.unhex(F.md5(k)))))


class LineRuns:
    """Levelled sorted runs of line hashes.

    Rows are (h, n_docs, last_doc). Batches come in falling order of ids, so the batch in
    which a key is new holds the largest id it will ever have: its row carries that id as
    last_doc. A batch is merged with the runs, an anti-join on h: keys that no run knows are
    added with their last_doc, further sightings of known keys add to n_docs only and have none.
    So each key has one last_doc in all runs together, and no later batch can change it.

    A batch is added as a run of level 0; ``fan_in`` runs of a level are compacted into one
    of the next, so that a key is rewritten log(batches) times and a batch meets
    fewer than fan_in runs a level. Runs are Parquet tables in the shared folder,
    bucketed and sorted by h into as many buckets as the session has shuffle
    partitions: a merge reads them without moving them again. Losing an executor loses none.
    """

    def __init__(self, spark: SparkSession, fan_in: int = 4):
        self.spark, self.fan_in = spark, fan_in
        self.root = shared_dir(spark, "line-runs")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.tables: list[str] = []

    def _write(self, run: DataFrame, level: int) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        # the rows come out of a join or an aggregation on h: each bucket is in one task
        run.write.bucketBy(self.buckets, "h").sortBy("h").option("path", f"{self.root}/level-{level}/{name}").saveAsTable(name)
        self.tables.append(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def unknown(self, keys: DataFrame) -> DataFrame:
        """``keys`` with is_new: whether no run holds h. Both sides are partitioned by h, so only sorted runs are merged."""
        for i, run in enumerate(self.runs()):
            seen = run.where("last_doc IS NOT NULL").select("h", F.lit(True).alias(f"in{i}"))
            keys = keys.join(seen, "h", "left")
        found = [F.col(f"in{i}") for i in range(len(self.runs()))]
        return keys.select("h", "n_docs", "last_doc", (F.coalesce(*found, F.lit(False)) == F.lit(False)).alias("is_new"))

    def add(self, keys: DataFrame) -> None:
        """Add a batch of (h, n_docs, last_doc) with one row a key; all its ids are smaller than those added before."""
        own = F.when(F.col("is_new"), F.col("last_doc")).alias("last_doc")
        self.levels[0].append(self._write(self.unknown(keys).select("h", "n_docs", own), 0))
        level = 0
        while len(self.levels[level]) >= self.fan_in:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(self.merged([self.spark.table(t) for t in self.levels[level]]), level + 1))
            self.levels[level] = []
            level += 1

    @staticmethod
    def merged(runs: list[DataFrame]) -> DataFrame:
        """One row a key: sorted runs merged by full joins on h. Of a key's rows one has a last_doc, as the anti-join sees to.

        Not a union with an aggregation: Spark 4.1 takes a union of bucketed tables to be partitioned as each of them is, and
        then leaves a key's rows in several groups.
        """
        out = runs[0].select("h", "n_docs", "last_doc")
        for run in runs[1:]:
            both = out.join(run.select("h", F.col("n_docs").alias("n"), F.col("last_doc").alias("last")), "h", "full")
            out = both.select("h", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n_docs"), F.coalesce("last", "last_doc").alias("last_doc"))
        return out

    def frequent(self, min_docs: int) -> DataFrame:
        """(h, n_docs, last_doc) of the keys that at least ``min_docs`` documents hold; the id is that of the run in which the key was new."""
        return self.merged(self.runs()).where(F.col("n_docs") >= min_docs)

    def drop(self) -> None:
        """Forget the tables; their files go with the shared folder."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _kept(lines: Column, dropped: Column) -> Column:
    # a dropped position sorts right before its line, so one pass over the sorted array finds the lines to keep
    both = F.concat(
        F.transform(lines, lambda x, i: F.struct(i.alias("i"), F.lit(1).alias("is_line"), x.alias("line"))),
        F.transform(dropped, lambda p: F.struct(p.alias("i"), F.lit(0).alias("is_line"), F.lit("").alias("line"))),
    )
    return let(
        F.sort_array(both),
        lambda s: F.array_join(
            F.transform(
                F.filter(s, lambda x, k: (x["is_line"] == 1) & ~F.coalesce(F.get(s, k - 1)["i"] == x["i"], F.lit(False))),
                lambda x: x["line"],
            ),
            "\n",
        ),
    )


def _matched(lines: DataFrame, frequent: DataFrame, occurrences: int) -> DataFrame:
    """``lines`` with the last_doc of their frequent keys, others left out.

    n_docs adds up to ``occurrences`` at most, so fewer than HEAVY keys have more than their HEAVY-th
    part: those meet their lines by broadcast, wherever these are. No other key has enough lines to fill a task.
    """
    heavy = F.col("n_docs") > occurrences // HEAVY
    hot = lines.join(F.broadcast(frequent.where(heavy).select("h", F.col("last_doc").alias("hot"))), "h", "left")
    rest = hot.where("hot IS NULL").drop("hot").join(frequent.where(~heavy).select("h", "last_doc"), "h")
    return hot.where("hot IS NOT NULL").withColumnRenamed("hot", "last_doc").unionByName(rest)


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, n_batches: int = 4, fan_in: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_lines, n_dropped) of all documents, repeated lines taken out of the texts.

    A line's key is the line without white space at both ends, A-Z lower-cased.
    Keys of at least ``min_chars`` code points found in at least ``min_docs``
    documents lose all their lines but those of the largest id that holds
    them. Line hashes are written once, dealt by ranges of ids to
    ``n_batches`` batches, which go through LineRuns from the largest ids to the smallest; then every
    line is matched with the frequent keys. Texts move once, to meet the positions they lose.

    Defined cases: null text counts as empty, with one empty line; rows that share an id are one document
    when documents are counted, and all rows of the largest id keep a line; a null id is
    smaller than all others and stays null in the result; equal rows are treated alike; a text
    may have any number of lines, whose hashes are one row; an
    empty table gives no rows; other columns aren't used. A key that repeats within a document counts
    it once. Where one id has most rows, its batch is larger than the others.
    """
    spark = docs.sparkSession
    doc, mark = row_key(docs, id_col, text_col)
    keyed = docs.select(doc.alias("doc"), mark.alias("mark"), F.col(text_col).alias("text"))
    # ranges of ids: their bounds only balance the batches
    shares = F.array(*[F.lit(i / n_batches) for i in range(1, n_batches)]) if n_batches > 1 else F.array(F.lit(0.5))
    bounds = (keyed.agg(F.percentile_approx("doc", shares, 1000).alias("b")).first().b or [])[: n_batches - 1]
    batch = reduce(lambda n, b: n + (F.col("doc") < F.lit(b)).cast("int"), bounds, F.lit(0))
    path = shared_dir(spark, "line-hashes")
    hashes = keyed.select("doc", "mark", line_hashes(F.col("text"), min_chars).alias("hashes")).where(F.exists("hashes", lambda h: h.isNotNull()))
    hashes.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    table = spark.read.schema("doc bigint, mark bigint, hashes array<binary>, batch int").parquet(path)
    repeated = not keyed.groupBy("doc").count().where("count > 1").isEmpty()

    runs = LineRuns(spark, fan_in)
    for number in range(len(bounds) + 1):
        held = table.where(F.col("batch") == number).select("doc", F.explode(F.array_distinct(F.array_compact("hashes"))).alias("h"))
        held = held.distinct() if repeated else held
        runs.add(held.groupBy("h").agg(F.count("*").alias("n_docs"), F.max("doc").alias("last_doc")))
    frequent = cut(runs.frequent(min_docs), "frequent-lines")
    runs.drop()

    occurrences = table.agg(F.sum(F.size("hashes")).alias("n")).first().n or 0
    lines = table.select("doc", "mark", F.posexplode("hashes").alias("pos", "h")).where(F.col("h").isNotNull())
    dropped = _matched(lines, frequent, occurrences).where(F.col("doc") < F.col("last_doc")).groupBy("doc", "mark").agg(F.collect_set("pos").alias("dropped"))
    lines_here = lines_of(F.col("text"))
    return (
        docs.select(F.col(id_col).alias("id"), doc.alias("doc"), mark.alias("mark"), F.col(text_col).alias("text"))
        .join(dropped, ["doc", "mark"], "left")
        .select(
            F.col("id").alias(id_col),
            F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(_kept(lines_here, F.col("dropped"))).alias(text_col),
            F.size(lines_here).cast("bigint").alias("n_lines"),
            F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        )
    )
