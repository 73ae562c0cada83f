"""The classifier on labelled rows that it was not fitted on."""

from pyspark.sql import functions as F

from binlattice.llm import resample


def test_resampling_parts_labelled_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    unseen = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    found = resample.resample(docs, labels.where(~unseen)).join(labels.where(unseen), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in found}
    assert kept[1] > 0.97 and kept[0] < 0.1
