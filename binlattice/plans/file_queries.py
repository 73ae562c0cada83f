"""Queries of readers and writers: given tables go to the shared folder in the readers' formats and are read back; each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from binlattice.functions.storage import shared_folder
from binlattice.operators import evaluate
from binlattice.plans import adapters as a
from binlattice.plans.registry import TRUTH, query
from binlattice.sources import ingest


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _reports(spark, lines, name):
    """The folder with the lines (sample, value) as text files, in a folder for each sample."""
    path = shared_folder(spark, name)
    lines.select("sample", "value").write.partitionBy("sample").text(path)
    return path


def _read_reports(spark, path):
    return ingest.with_sample_from_path(spark.read.text(path).select("value", "_metadata"), "folder").drop("_metadata")


@query("SELECT 'par' AS region_class, 'chr' || CAST(o_custkey % 22 + 1 AS VARCHAR) AS chrom, CAST(o_orderkey AS BIGINT) AS start_pos, CAST(o_orderkey + 50 AS BIGINT) AS end_pos FROM orders WHERE o_orderkey % 10 > 2")
def s3_read_bed(spark, sf):
    """Three lines of ten are a comment, a line of two fields and a blank one."""
    line = r"CASE o_orderkey % 10 WHEN 0 THEN concat('# chr1 1 ', o_orderkey) WHEN 1 THEN concat('chr1\t', o_orderkey) WHEN 2 THEN '' ELSE concat('chr', o_custkey % 22 + 1, ' ', o_orderkey, '\t', o_orderkey + 50, '\tname') END AS value"
    path = shared_folder(spark, "bed")
    _table(spark, sf, "orders").selectExpr(line).write.text(path)
    return ingest.read_bed(spark, path, "par")


@query("SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_mktsegment, CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM customer")
def s5_read_table(spark, sf):
    path = shared_folder(spark, "table")
    ingest.write_outputs(_table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), path, ("tsv",))
    return ingest.read_table(spark, f"{path}/tsv", "c_custkey bigint, c_mktsegment string, c_acctbal double", required=("c_custkey",), empty_ok=False)


@query("SELECT 'c' || CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS nation FROM customer UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), NULL, CAST(s_nationkey AS VARCHAR) FROM supplier")
def s6_read_tables(spark, sf):
    """Two tables of different columns; a third has no rows and a fourth does not exist."""
    path = shared_folder(spark, "tables")
    parts = {
        "customer": _table(spark, sf, "customer").selectExpr("concat('c', c_custkey) AS id", "c_mktsegment AS segment"),
        "supplier": _table(spark, sf, "supplier").selectExpr("concat('s', s_suppkey) AS id", "s_nationkey AS nation"),
        "empty": _table(spark, sf, "supplier").where("false").selectExpr("s_suppkey AS other"),
    }
    for name, df in parts.items():
        ingest.write_outputs(df, f"{path}/{name}", ("tsv",))
    return ingest.read_tables(spark, [f"{path}/{name}/tsv" for name in (*parts, "missing")])


@query("SELECT CAST(l_suppkey AS BIGINT) AS sample_id, CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) = 1")
def s8_first_row_per_sample(spark, sf):
    rows = _table(spark, sf, "lineitem").selectExpr("CAST(l_suppkey AS BIGINT) AS sample_id", "CAST(l_orderkey AS BIGINT) AS l_orderkey", "CAST(l_linenumber AS BIGINT) AS l_linenumber")
    return ingest.first_row_per_sample(rows, ["l_orderkey", "l_linenumber"])


@query("""SELECT 'sample=S' || CAST(l_suppkey AS VARCHAR) AS sample_id, CAST(count(*) AS DOUBLE) AS before_total_reads, 0.5 AS before_q30_rate, CAST(NULL AS DOUBLE) AS before_gc_content, CAST(count(*) FILTER (WHERE l_returnflag <> 'R') AS DOUBLE) AS after_total_reads, CAST(NULL AS DOUBLE) AS after_q30_rate,
  CASE WHEN l_suppkey % 3 > 0 THEN 0.25 END AS after_gc_content, CASE WHEN l_suppkey % 2 = 0 THEN 0.125 END AS duplication_rate, CAST(max(l_quantity) AS DOUBLE) AS insert_peak, CAST(NULL AS DOUBLE) AS insert_unknown FROM lineitem GROUP BY l_suppkey""")
def s9_library_metrics(spark, sf):
    """A report a sample; fields that a report lacks are null."""
    per = _table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") != "R").alias("kept"), F.max(F.col("l_quantity").cast("double")).alias("peak"))
    report = """to_json(named_struct('summary', named_struct('before_filtering', named_struct('total_reads', n, 'q30_rate', 0.5D), 'after_filtering', named_struct('total_reads', kept, 'gc_content', CASE WHEN l_suppkey % 3 > 0 THEN 0.25D END)),
      'duplication', CASE WHEN l_suppkey % 2 = 0 THEN named_struct('rate', 0.125D) END, 'insert_size', named_struct('peak', peak))) AS value"""
    return ingest.library_metrics(spark, _reports(spark, per.selectExpr("concat('S', l_suppkey) AS sample", report), "library"))


@query("""SELECT 'sample=S' || CAST(l_suppkey AS VARCHAR) AS sample_id, count(*) AS total_reads_bam, count(*) FILTER (WHERE l_quantity > 1) AS mapped_reads_bam, count(*) FILTER (WHERE l_linenumber < 7) AS paired_reads_bam, count(*) FILTER (WHERE l_linenumber < 6) AS properly_paired_reads_bam, CAST(NULL AS BIGINT) AS singleton_reads_bam,
  count(*) FILTER (WHERE l_linenumber = 2) AS mate_diff_chr_mapq5_reads_bam, count(*) FILTER (WHERE l_linenumber = 1) AS mate_diff_chr_reads_bam FROM lineitem GROUP BY l_suppkey""")
def s10_flagstat_metrics(spark, sf):
    """Reports without a line of singletons, named by their folders."""
    counts = {"in total (QC-passed reads + QC-failed reads)": "true", "mapped (90.00% : N/A)": "l_quantity > 1", "paired in sequencing": "l_linenumber < 7", "properly paired (80.00% : N/A)": "l_linenumber < 6", "with itself and mate mapped": "true", "with mate mapped to a different chr": "l_linenumber = 1", "with mate mapped to a different chr (mapQ>=5)": "l_linenumber = 2"}
    per = _table(spark, sf, "lineitem").groupBy("l_suppkey").agg(*[F.expr(f"count_if({test})").alias(f"n{i}") for i, test in enumerate(counts.values())])
    lines = F.array(*[F.concat(F.col(f"n{i}").cast("string"), F.lit(f" + 0 {phrase}")) for i, phrase in enumerate(counts)])
    path = _reports(spark, per.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("sample"), F.explode(lines).alias("value")), "flagstat")
    return ingest.flagstat_metrics(_read_reports(spark, path))


@query("SELECT 'sample=S' || CAST(l_suppkey % 8 AS VARCHAR) AS sample_id, 'chr' || CAST(l_linenumber AS VARCHAR) AS chrom, CAST(2520000 AS BIGINT) AS length, count(*) AS mapped, count(*) FILTER (WHERE l_quantity < 5) AS unmapped FROM lineitem GROUP BY l_suppkey % 8, l_linenumber")
def s11_idxstats_table(spark, sf):
    """Every sample also has a line of five fields, which is no row."""
    per = _table(spark, sf, "lineitem").groupBy((F.col("l_suppkey") % 8).alias("s"), "l_linenumber").agg(F.count("*").alias("n"), F.expr("count_if(l_quantity < 5)").alias("u"))
    lines = per.selectExpr("concat('S', s) AS sample", r"explode(array(concat('chr', l_linenumber, '\t2520000\t', n, '\t', u), concat('chr', l_linenumber, '\t1\t2\t3\t4'))) AS value")
    return ingest.idxstats_table(_read_reports(spark, _reports(spark, lines, "idxstats")))


@query(" UNION ALL ".join(f"SELECT '{f}' AS format, CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name FROM supplier" for f in ("parquet", "tsv", "json")))
def s12_write_outputs(spark, sf):
    path = shared_folder(spark, "outputs")
    ingest.write_outputs(_table(spark, sf, "supplier").selectExpr("CAST(s_suppkey AS BIGINT) AS s_suppkey", "s_name"), path, ("parquet", "tsv", "json"))
    schema = "s_suppkey bigint, s_name string"
    read = {"parquet": spark.read.parquet(f"{path}/parquet"), "tsv": ingest.read_table(spark, f"{path}/tsv", schema), "json": spark.read.json(f"{path}/json", schema=schema)}
    return ingest.union_tables([df.select(F.lit(f).alias("format"), "s_suppkey", "s_name") for f, df in read.items()])


@query(f"WITH {TRUTH} SELECT truth_id, chrom, state FROM truth")
def s16_normalize_state(spark, sf):
    return a.truth(spark, sf).select("truth_id", evaluate.normalize_chrom(F.col("chrom")).alias("chrom"), evaluate.normalize_state(F.col("state")).alias("state"))
