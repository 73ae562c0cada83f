"""Readers, writers and clean-up of input tables. Every reader is a Spark scan; paths may be files, folders or lists."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from binlattice.operators.grid import DEFAULT_FRACTIONS
from binlattice.operators.qc import AUTOSOME


def explode_count_vectors(vectors: DataFrame) -> DataFrame:
    """Bins from (sample_id, binsize, bins MAP<STRING, ARRAY<DOUBLE>>) for chromosomes 1 to 22, X and Y.

    23 and 24 stand for X and Y where these hold no data; NaN, infinity and null count 0. A sample without any bin is an error. The last bin isn't cut.
    """
    pairs = vectors.select("sample_id", "binsize", F.explode_outer("bins").alias("key", "values"))
    name = F.upper(F.regexp_replace("key", "^(?i)chr", ""))
    alias = F.when(name == "23", "X").when(name == "24", "Y").otherwise(name)
    known = pairs.withColumn("c", alias).withColumn("rank", (name != F.col("c")).cast("int"))
    known = known.withColumn("ok", F.coalesce(F.col("c").rlike("^([1-9]|1[0-9]|2[0-2]|X|Y)$") & (F.size("values") > 0), F.lit(False)))
    some = F.bool_or("ok").over(Window.partitionBy("sample_id"))
    known = known.withColumn("ok", F.when(some, F.col("ok")).otherwise(F.raise_error(F.concat(F.lit("no bins for sample "), F.col("sample_id"))).cast("boolean"))).where("ok")
    first = known.withColumn("__r", F.row_number().over(Window.partitionBy("sample_id", "c").orderBy("rank", "key"))).where("__r = 1")
    bins = first.select("sample_id", "binsize", F.concat(F.lit("chr"), F.col("c")).alias("chrom"), F.posexplode("values").alias("bin_index", "x"))
    good = F.when(F.isnan("x") | (F.abs("x") == float("inf")), 0.0).otherwise(F.coalesce("x", F.lit(0.0)))
    start = F.col("bin_index").cast("bigint") * F.col("binsize")
    return bins.select("sample_id", "chrom", "bin_index", start.alias("start_pos"), (start + F.col("binsize")).alias("end_pos"), good.alias("raw_count"))


def read_bed(spark: SparkSession, path: str, region_class: str) -> DataFrame:
    """Intervals of a BED file; blank lines, comments and lines with under 3 fields are skipped. No path: no rows; a missing file is an error."""
    if not path:
        return spark.createDataFrame([], "region_class string, chrom string, start_pos bigint, end_pos bigint")
    part = F.split(F.trim("value"), r"\s+")
    lines = spark.read.text(path).where(~F.trim("value").startswith("#")).withColumn("p", part).where("size(p) >= 3")
    return lines.select(F.lit(region_class).alias("region_class"), F.col("p")[0].alias("chrom"), F.col("p")[1].cast("bigint").alias("start_pos"), F.col("p")[2].cast("bigint").alias("end_pos"))


def parse_region_specs(df: DataFrame, column: str) -> DataFrame:
    """chrom, start_pos and end_pos of ``chrom:start-end``; anything else is an error."""
    form = r"^\s*([^:\s]+):(\d+)-(\d+)\s*$"
    ok = F.coalesce(F.col(column).rlike(form), F.lit(False))
    spec = F.when(ok, F.col(column)).otherwise(F.raise_error(F.concat(F.lit("malformed region: "), F.coalesce(column, F.lit("null")))).cast("string"))
    part = lambda i: F.regexp_extract(spec, form, i)
    return df.select("*", part(1).alias("chrom"), part(2).cast("bigint").alias("start_pos"), part(3).cast("bigint").alias("end_pos"))


def read_table(spark: SparkSession, path: str | list[str], schema: str | None = None, required: tuple[str, ...] = (), empty_ok: bool = True) -> DataFrame:
    """A tab-separated table with header. Missing required columns raise ValueError, as does a table without rows unless ``empty_ok``."""
    df = spark.read.csv(path, sep="\t", header=True, schema=schema)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if not empty_ok and df.isEmpty():
        raise ValueError("the table has no rows")
    return df


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """All rows, columns matched by name, null where a table lacks one. No table at all is a ValueError."""
    if not tables:
        raise ValueError("no tables")
    out, *rest = tables
    for t in rest:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def read_tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """union_tables of the tables at the paths; missing ones and those without rows are skipped, columns included. None left: no rows, no columns."""
    found = []
    for path in paths:
        try:
            found.append(read_table(spark, path, empty_ok=False))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        except ValueError:
            pass
    return union_tables(found) if found else spark.createDataFrame([], "")


def sample_from_path(path: Column, kind: str = "stem") -> Column:
    """The sample's name in a path: ``stem`` up to the first dot, ``prefix`` up to the first underscore, ``folder`` the parent folder."""
    form = {"stem": r"([^/.]+)[^/]*$", "prefix": r"([^/_]+)[^/]*$", "folder": r"([^/]+)/[^/]*$"}[kind]
    return F.regexp_extract(path, form, 1)


def with_sample_from_path(df: DataFrame, kind: str = "stem") -> DataFrame:
    """Adds sample_id from the file a row was read from, unless there is one."""
    return df if "sample_id" in df.columns else df.withColumn("sample_id", sample_from_path(F.col("_metadata.file_path"), kind))


def first_row_per_sample(df: DataFrame, order: list[str]) -> DataFrame:
    w = Window.partitionBy("sample_id").orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def library_metrics(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Reads, Q30 and GC before and after filtering, duplication and insert size from library reports; null where absent."""
    side = "STRUCT<total_reads: DOUBLE, q30_rate: DOUBLE, gc_content: DOUBLE>"
    schema = f"summary STRUCT<before_filtering: {side}, after_filtering: {side}>, duplication STRUCT<rate: DOUBLE>, insert_size STRUCT<peak: DOUBLE, unknown: DOUBLE>"
    df = spark.read.json(path, schema=schema, multiLine=True)
    both = [F.col(f"summary.{s}_filtering.{f}").alias(f"{s}_{f}") for s in ("before", "after") for f in ("total_reads", "q30_rate", "gc_content")]
    return df.select(sample_from_path(F.col("_metadata.file_path"), "folder").alias("sample_id"), *both, F.col("duplication.rate").alias("duplication_rate"), F.col("insert_size.peak").alias("insert_peak"), F.col("insert_size.unknown").alias("insert_unknown"))


#: The columns, in the order in which phrases of a line are looked for.
FLAGSTAT = ["total_reads_bam", "mapped_reads_bam", "paired_reads_bam", "properly_paired_reads_bam", "singleton_reads_bam", "mate_diff_chr_mapq5_reads_bam", "mate_diff_chr_reads_bam"]


def flagstat_metrics(lines: DataFrame) -> DataFrame:
    """One row a sample from (sample_id, value) lines of flag statistics: the number before the plus, named by the line's phrase."""
    has = lambda x: F.contains(F.col("value"), F.lit(x))
    tests = [has(" in total "), has(" mapped (") & ~has("mate mapped"), has(" paired in sequencing"), has(" properly paired "), has(" singletons "), has(" with mate mapped to a different chr (mapQ>=5)"), has(" with mate mapped to a different chr")]
    kind = F.coalesce(*[F.when(t, name) for t, name in zip(tests, FLAGSTAT, strict=True)])
    count = F.trim(F.substring_index("value", "+", 1)).try_cast("bigint")
    return lines.where(has("+")).select("sample_id", kind.alias("kind"), count.alias("n")).groupBy("sample_id").pivot("kind", FLAGSTAT).agg(F.max("n"))


def idxstats_table(lines: DataFrame) -> DataFrame:
    """chrom, length, mapped and unmapped of lines with exactly 4 tab-separated fields."""
    p = F.split("value", "\t")
    rows = lines.where(F.size(p) == 4)
    return rows.select("sample_id", p[0].alias("chrom"), *[p[i].try_cast("bigint").alias(n) for i, n in ((1, "length"), (2, "mapped"), (3, "unmapped"))])


def write_outputs(df: DataFrame, path: str, formats: tuple[str, ...] = ("parquet",)) -> None:
    """The table in folders path/parquet, path/tsv (with header) and path/json (a record a line)."""
    for f in formats:
        out = df.write.mode("overwrite")
        if f == "tsv":
            out.csv(f"{path}/tsv", sep="\t", header=True)
        else:
            out.format(f).save(f"{path}/{f}")


def with_default_columns(bins: DataFrame) -> DataFrame:
    """Overlap fractions (0) and flags (0), mask_label (pass), is_autosome and mappability_score, added where missing, clipped to [0, 1]."""
    have = set(bins.columns)
    clip = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    part = {f"{c}_overlap_fraction": clip(F.coalesce(F.col(f"{c}_overlap_fraction").cast("double"), F.lit(0.0))) if f"{c}_overlap_fraction" in have else F.lit(0.0) for c in DEFAULT_FRACTIONS}
    flag = {f"overlaps_{c}": F.coalesce(F.col(f"overlaps_{c}").cast("int"), F.lit(0)) if f"overlaps_{c}" in have else F.lit(0) for c in DEFAULT_FRACTIONS}
    source = next((c for c in ("mappability_score", "mappability_proxy", "atgc_fraction") if c in have), None)
    score = clip(F.coalesce(F.col(source).cast("double"), F.lit(1.0))) if source else F.lit(1.0)
    label = F.coalesce(F.col("mask_label"), F.lit("pass")) if "mask_label" in have else F.lit("pass")
    return bins.withColumns(part | flag | {"mask_label": label, "mappability_score": score, "is_autosome": F.col("chrom").rlike(AUTOSOME).cast("int")})


def expand_id_ranges(manifest: DataFrame, column: str) -> DataFrame:
    """A row for each id of lists such as ``1-5, A-H, E1-E9, E1-9``; bounds may be swapped, dashes and commas of any width. What is no range stays one id."""
    text = F.translate(F.col(column), "–—−－，、；;", "----,,,,")
    items = manifest.withColumn("__i", F.explode(F.split(text, ","))).withColumn("__i", F.regexp_replace("__i", r"\s+", "")).where("__i <> ''")
    form = r"^([A-Za-z]*)([0-9]+)-([A-Za-z]*)([0-9]+)$"
    p = lambda i: F.regexp_extract("__i", form, i)
    a, b = p(2).try_cast("bigint"), p(4).try_cast("bigint")
    numbers = F.col("__i").rlike(form) & ((F.upper(p(1)) == F.upper(p(3))) | ((p(1) != "") & (p(3) == "")))
    counted = F.transform(F.sequence(F.least(a, b), F.greatest(a, b)), lambda x: F.concat(F.upper(p(1)), x.cast("string")))
    x, y = F.ascii(F.upper(F.substring("__i", 1, 1))), F.ascii(F.upper(F.substring("__i", 3, 1)))
    letters = F.transform(F.sequence(F.least(x, y), F.greatest(x, y)), lambda i: F.char(i.cast("bigint")))
    ids = F.when(numbers, counted).when(F.col("__i").rlike("^[A-Za-z]-[A-Za-z]$"), letters).otherwise(F.array(F.when(F.col("__i").rlike("^[A-Za-z]+$"), F.upper("__i")).otherwise(F.col("__i"))))
    return items.withColumn("id", F.explode(ids)).drop("__i")


def sample_sex_map(manifest: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(id, sex) with XY looked for before XX; an id with two sexes, or a wanted id without one, is an error."""
    sex = F.upper("sex")
    found = manifest.select("id", F.when(F.contains(sex, F.lit("XY")), "XY").when(F.contains(sex, F.lit("XX")), "XX").alias("sex")).where("sex IS NOT NULL")
    per = found.groupBy("id").agg(F.min("sex").alias("low"), F.max("sex").alias("high"))
    one = per.select("id", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.raise_error(F.concat(F.lit("two sexes for "), F.col("id").cast("string"))).cast("string")).alias("sex"))
    if wanted is None:
        return one
    return wanted.select("id").distinct().join(one, "id", "left").select("id", F.coalesce("sex", F.raise_error(F.concat(F.lit("no sex for "), F.col("id").cast("string"))).cast("string")).alias("sex"))


def natural_sort_key(column: Column, fold: bool = False) -> Column:
    """An array to order by: runs of digits as numbers, before text."""
    text = F.lower(column) if fold else column
    part = lambda x: F.struct((~x.rlike("^[0-9]")).cast("int").alias("kind"), x.try_cast("decimal(38,0)").alias("num"), x.alias("text"))
    return F.transform(F.regexp_extract_all(text, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1)), part)
