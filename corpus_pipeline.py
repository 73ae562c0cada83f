"""From raw documents to training shards: the corpus operators as five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame that is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents.

Every stage takes null, empty and very long texts, repeated rows, empty tables
and further columns of any name, which it returns as they are; what becomes of each
case is stated at the operator that the stage calls.
"""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from binlattice.llm.common import cut, last_named, named_folders, release
from binlattice.llm.decontaminate import remove_leaks
from binlattice.llm.mixing import mix_sources
from binlattice.llm.near_dup import keep_one
from binlattice.llm.resample import keep_good
from binlattice.llm.sharding import histogram_shard


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the good labelled text rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents at similarity 0.8 on 5-word shingles, the one with the smallest id stays."""
    return keep_one(docs, shingle=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window like a benchmark item go."""
    return remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: its decision is the order of rows in the files it is written to."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return mix_sources(docs).orderBy("mix_pos").select(*columns)


def _place(docs: DataFrame) -> Column | str:
    """A row's place in the files of the stage before: number of the file, number of its part, row.

    Files that Spark didn't write come first, in no order among them. Rows that come from no file have no place: they are
    ordered by id instead, with a warning.
    """
    name = F.col("_metadata.file_name")
    number = lambda pattern: F.coalesce(F.regexp_extract(name, pattern, 1).try_cast("bigint"), F.lit(0))
    # a file of less than 2**32 rows; less than 2**11 files a task, as with a limit of rows a file
    place = number(r"part-(\d+)") * (1 << 43) + number(r"-c(\d+)\.") * (1 << 32) + F.col("_metadata.row_index")
    try:
        docs.select(place).schema
    except AnalysisException:
        warnings.warn("the documents come from no files: shards follow their ids, not the mixture", stacklevel=3)
        return "doc_id"
    return place


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """16 shards of near equal bytes, each a stretch of the mixture: the sort key is the place in the mixed order."""
    return histogram_shard(docs, 16, key=_place(docs))


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: SQL has no counterpart of the sampled classifier and the hashed orders; tests compare the stages with plain models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir. What a stage read and wrote for itself is deleted once its output is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), named_folders()
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = cut(stage(spark, docs, sf_dir), f"stage-{i}")
        release(spark, before, keep=last_named())
    return STAGES[-1][1](spark, docs, sf_dir)
