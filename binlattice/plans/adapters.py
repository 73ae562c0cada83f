"""Views of general tables as the inputs of the genomic operators.

The steps that read whole tables (bins, annotated) write their few rows once, so that a query reads its tables as often as it calls them, not as often as
later steps look at them. ``counted`` is the result of bins() where a query has it already.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from binlattice.functions.stats import normalize_log1p_cpm, robust_z, two_sided_p
from binlattice.functions.storage import stored
from binlattice.operators import artifact, calibrate, calling, evaluate, grid, qc, report

BIN, N_BINS, MAPQ = 90_000, 28, 10
CLASSES = ["segmental_duplication", "low_mappability", "repeat_rich", "gap_centromere_telomere", "blacklist"]
OVERLAPS = [f"{c}_overlap_fraction" for c in CLASSES]

_SAMPLE = "concat('S', CAST({0} AS STRING))"
_CHROM = "concat('chr', CASE {0} WHEN 22 THEN 'X' WHEN 23 THEN 'Y' ELSE CAST({0} + 1 AS STRING) END)"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _linear(days: str) -> str:
    """A position from days, some outside the chromosome."""
    return f"((CAST({days} AS BIGINT) + 2520) % 2520 * 1000 - CASE WHEN l_orderkey % 64 = 0 THEN 2520000 ELSE 0 END)"


def _position(days: str, linear: str | None = None) -> str:
    """A position from days, or from a column that holds _linear() of them, with signal in two samples: reads of S2 on two chromosomes gather in six bins, and those of S5 leave nine bins of two others for nine more."""
    linear = linear or _linear(days)
    gain = "l_suppkey % 8 = 2 AND l_partkey % 24 IN (4, 10) AND l_linenumber % 2 = 1"
    loss = "l_suppkey % 8 = 5 AND l_partkey % 24 IN (7, 13)"
    return f"CASE WHEN {linear} >= 0 AND {gain} THEN 630000 + {linear} % 540000 WHEN {linear} >= 1350000 AND {linear} < 2160000 AND {loss} THEN {linear} - 900000 ELSE {linear} END"


def _reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignments with samples and chromosomes by number."""
    days = "datediff(l_shipdate, DATE'1995-01-01')"
    return _table(spark, sf_dir, "lineitem").selectExpr("*", f"{_linear(days)} AS linear").selectExpr(
        "l_suppkey % 8 AS sample_id",
        "l_partkey % 24 AS chrom",
        f"{_position(days, 'linear')} AS pos",
        "CAST(l_quantity + 5 AS INT) AS mapq",
        "(l_returnflag = 'R' AND l_linestatus = 'O') AS is_duplicate",
        "(l_linenumber = 7) AS is_secondary",
        "(l_linenumber = 5 AND l_linestatus = 'F') AS is_supplementary",
        "(l_tax > 0.07 AND l_quantity < 20) AS is_unmapped",
        "(l_discount > 0.09) AS is_qcfail",
        "(l_linenumber % 4 = 0) AS is_paired",
        "(l_tax < 0.05) AS is_read1",
    )


def _named(numbered: DataFrame) -> DataFrame:
    return numbered.withColumns({"sample_id": F.expr(_SAMPLE.format("sample_id")), "chrom": F.expr(_CHROM.format("chrom"))})


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(_reads(spark, sf_dir))


def _numbered_sizes(spark: SparkSession, length: int) -> DataFrame:
    return spark.range(24).selectExpr("id AS chrom", f"CAST({length} AS BIGINT) AS length")


def chrom_sizes(spark: SparkSession, length: int = BIN * N_BINS) -> DataFrame:
    return _numbered_sizes(spark, length).withColumn("chrom", F.expr(_CHROM.format("chrom")))


def seen_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chromosomes as long as their last alignment says."""
    return alignments(spark, sf_dir).groupBy("chrom").agg((F.max("pos") + 1).alias("length"))


def bin_grid(spark: SparkSession) -> DataFrame:
    return grid.make_bin_grid(chrom_sizes(spark), BIN, "analysis")


def _numbered_grid(spark: SparkSession) -> DataFrame:
    return grid.make_bin_grid(_numbered_sizes(spark, BIN * N_BINS), BIN, "analysis")


def bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all samples and bins, with the chromosome's place in genome order, written once. Reads are counted by number, as text is slower to group by, and the few bins are named."""
    counted = _named(grid.count_fragments(_reads(spark, sf_dir), _numbered_grid(spark), BIN, MAPQ))
    name = F.substring("chrom", 4, 2)
    return stored(counted.withColumn("chrom_rank", F.when(name == "X", 23).when(name == "Y", 24).otherwise(name.try_cast("int"))))


#: Where the intervals of each class lie: gaps in the middle of a chromosome, the others in one of up to three bins elsewhere.
_PLACE = "CASE o_orderpriority WHEN '1-URGENT' THEN 4 + (o_custkey % 24) % 3 WHEN '2-HIGH' THEN 9 + (o_custkey % 24) % 2 WHEN '3-MEDIUM' THEN 20 + (o_custkey % 24) % 3 WHEN '4-NOT SPECIFIED' THEN 13 + o_orderkey % 2 ELSE 25 + (o_custkey % 24) % 3 END"


def _numbered_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One interval an order, with chromosomes by number."""
    start = f"CAST(({_PLACE}) * 90000 + (o_orderkey * 37) % 85000 AS BIGINT)"
    return _table(spark, sf_dir, "orders").selectExpr(
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'segmental_duplication' WHEN '2-HIGH' THEN 'low_mappability' WHEN '3-MEDIUM' THEN 'repeat_rich' WHEN '4-NOT SPECIFIED' THEN 'gap_centromere_telomere' ELSE 'blacklist' END AS region_class",
        "o_custkey % 24 AS chrom",
        f"{start} AS start_pos",
        f"{start} + (o_orderkey % 5 + 1) * 100 AS end_pos",
    )


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One interval an order."""
    return _numbered_intervals(spark, sf_dir).withColumn("chrom", F.expr(_CHROM.format("chrom")))


def external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of another caller, with its spellings of states and chromosomes."""
    return _table(spark, sf_dir, "orders").selectExpr(
        "concat('S', CAST(o_custkey % 8 AS STRING)) AS sample_id",
        f"replace({_CHROM.format('(o_orderkey % 24)')}, 'chr', '') AS chrom",
        "CASE WHEN o_custkey % 2 = 0 THEN 'dup' ELSE '-' END AS kind",
        "CAST((o_orderkey % 28) * 90000 AS BIGINT) AS start_pos",
        "CAST((o_orderkey % 28) * 90000 + 200000 AS BIGINT) AS end_pos",
        "CAST(o_custkey % 17 - 8 AS DOUBLE) AS zscore",
    )


def _numbered_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").selectExpr("doc_id % 24 AS chrom", "((doc_id DIV 24) % 28) * 90000 AS chunk_start", "text AS seq")


def sequence_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered_chunks(spark, sf_dir).withColumn("chrom", F.expr(_CHROM.format("chrom")))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr(
        "event_id", "event_type AS rule_name", "CAST(user_id % 4 AS INT) AS threads", "value AS wall_seconds", "CASE event_type WHEN 'error' THEN 'log_failed' ELSE 'success' END AS status", "ts AS created_at", "user_id",
        "CASE user_id % 3 WHEN 0 THEN 'qc' ELSE 'predict' END AS module", "CASE WHEN user_id % 5 = 0 THEN '1' ELSE '2-8' END AS sample_bucket", "CAST(event_id % 2 * 500000 + 500000 AS BIGINT) AS binsize", "CASE WHEN event_id % 3 > 0 THEN CAST(event_id % 3 AS INT) END AS pca_components",
    )


#: Fractions of the sequence that was seen in a bin: n in every thirteenth bin, less of it elsewhere; a lower GC in every tenth; less mappability in every eleventh.
N_SHARE = "n_n / nullif(n_a + n_c + n_g + n_t + n_n, 0) * CASE WHEN bin_index % 13 = 0 THEN 1.0D ELSE 0.25D END"
GC_SHARE = "(n_g + n_c) / nullif(n_a + n_c + n_g + n_t, 0) + CASE WHEN bin_index % 10 = 2 THEN 0.0D ELSE 0.15D END"
MAPPABLE = "1 - n_n / nullif(n_a + n_c + n_g + n_t + n_n, 0) * 0.25D - CASE WHEN bin_index % 11 = 5 THEN 0.3D ELSE 0.0D END"


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of the grid with composition, overlap fractions and flags, written once. Chromosomes are numbers until the few bins are named."""
    composed = grid.base_composition(_numbered_chunks(spark, sf_dir), _numbered_grid(spark), BIN)
    seen = composed.withColumns({"n_fraction": F.expr(N_SHARE), "gc_fraction": F.expr(GC_SHARE), "mappability_score": F.expr(MAPPABLE)})
    met = grid.overlap_fraction(seen, _numbered_intervals(spark, sf_dir), 30_000, CLASSES).withColumn("chrom", F.expr(_CHROM.format("chrom")))
    return stored(grid.region_flags(met, CLASSES))


def normalized(spark: SparkSession, sf_dir: str, counted: DataFrame | None = None) -> DataFrame:
    return normalize_log1p_cpm(counted or bins(spark, sf_dir), ["sample_id"])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins with a robust z of the signal within the chromosome."""
    return robust_z(normalized(spark, sf_dir), "normalized_signal", ["sample_id", "chrom"])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.call_runs(scored(spark, sf_dir))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A truth table with optional bounds and fractions."""
    return _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS truth_id",
        "concat('S', CAST(c_custkey % 8 AS STRING)) AS sample_id",
        f"CASE WHEN c_custkey % 7 = 0 THEN replace({_CHROM.format('(c_nationkey % 24)')}, 'chr', '') ELSE {_CHROM.format('(c_nationkey % 24)')} END AS chrom",
        "CASE c_custkey % 6 WHEN 0 THEN 'gain' WHEN 1 THEN 'loss' WHEN 2 THEN ' DUP' WHEN 3 THEN 'Deletion' WHEN 4 THEN '+' ELSE '-' END AS state",
        "CASE WHEN c_custkey % 3 > 0 THEN (c_custkey % 28) * 90000 END AS t_start",
        "CASE WHEN c_custkey % 3 > 0 THEN (c_custkey % 28) * 90000 + 500000 END AS t_end",
        "CASE WHEN c_custkey % 5 > 0 THEN (c_custkey % 60) / 100.0D END AS expected_fraction",
    )


def loaded_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.load_truth(truth(spark, sf_dir))


def depths(spark: SparkSession, sf_dir: str, counted: DataFrame | None = None) -> DataFrame:
    """Relative depths of the sex chromosomes, from counted bins."""
    counts = (counted or bins(spark, sf_dir)).groupBy("sample_id", "chrom").agg(F.sum("raw_count").alias("mapped"), F.lit(BIN * N_BINS).alias("length"))
    return evaluate.relative_depths(counts)


def leave_one_out(spark: SparkSession, sf_dir: str, counted: DataFrame | None = None) -> DataFrame:
    return qc.leave_one_out(normalized(spark, sf_dir, counted), "normalized_signal")


def cohort_z() -> Column:
    """z against the other samples, halved, as a deviation of seven values is often far too small; none of the two cases, which are no reference."""
    return F.when(~F.col("sample_id").isin("S2", "S5"), 0.5 * (F.col("v") - F.col("ref_median")) / F.col("ref_sigma")).alias("z")


def masked(spark: SparkSession, sf_dir: str, counted: DataFrame | None = None) -> DataFrame:
    """Annotated bins with the cohort's dynamic metrics and the combined mask."""
    metrics = qc.dynamic_bin_metrics(leave_one_out(spark, sf_dir, counted).select("chrom", "bin_index", cohort_z()))
    return qc.combined_mask(annotated(spark, sf_dir).join(metrics, ["chrom", "bin_index"], "left"))


def risk(spark: SparkSession, sf_dir: str, counted: DataFrame | None = None) -> DataFrame:
    """Masked bins with risk; overlap classes without intervals are 0."""
    absent = {f"{c}_overlap_fraction": F.lit(0.0) for c in ("par", "xtr", "sex_homology", "ambiguous_alignment")}
    return qc.annotate_region_risk(masked(spark, sf_dir, counted).withColumns(absent))


def calling_bins(spark: SparkSession, sf_dir: str, counted: DataFrame | None = None) -> DataFrame:
    """All samples' bins with signal, risk and calling weight, written once."""
    counted = counted or bins(spark, sf_dir)
    fixed = risk(spark, sf_dir, counted).drop("start_pos", "end_pos")
    joined = normalized(spark, sf_dir, counted).join(fixed, ["chrom", "bin_index"])
    return stored(calling.calling_weight(joined.withColumn("is_autosome", F.col("chrom").rlike(qc.AUTOSOME).cast("int"))))


#: Least difference of a split and least z of a segment, for the given tables, whose signal is noise.
LEAST_SPLIT, LEAST_Z = 1.0, 0.5


def scored_bins(spark: SparkSession, sf_dir: str, counted: DataFrame | None = None) -> DataFrame:
    return calling.score_bins(calling_bins(spark, sf_dir, counted))


def called(spark: SparkSession, sf_dir: str, counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(scored bins with the state of their segment, segments with their states), each written once."""
    bins_ = stored(scored_bins(spark, sf_dir, counted))
    states = stored(calling.segment_states(calling.segment_series(bins_, threshold=LEAST_SPLIT), bins_, LEAST_Z))
    return stored(calling.with_hmm_state(bins_, states)), states


def candidates(bins_: DataFrame, states: DataFrame) -> DataFrame:
    return calling.segment_events(bins_, states=states)


def supported(bins_: DataFrame, states: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidate events, null model, support of the events), each written once."""
    null, found = stored(calibrate.empirical_null(bins_)), stored(candidates(bins_, states))
    return found, null, stored(calibrate.event_support(found, calibrate.calibrate_bins(bins_, null), calibrate.null_autocorrelation(bins_), OVERLAPS))


def significant(spark: SparkSession, sf_dir: str, p: Callable[[Column], Column] = two_sided_p, parts: tuple[DataFrame, DataFrame, DataFrame] | None = None) -> DataFrame:
    """Candidate events with support, p, q and the decision to keep them."""
    found, null, support = parts or supported(*called(spark, sf_dir))
    return calibrate.event_significance(found, support, null, p=p)


def classified(spark: SparkSession, sf_dir: str, parts: tuple[DataFrame, DataFrame, DataFrame] | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Significant events after the artifact rules; sexes by sample number, the first 300 kb of X and Y as PAR."""
    sex = F.when(F.substring("sample_id", 2, 1).cast("int") % 2 == 0, "XX").otherwise("XY")
    par = spark.createDataFrame([("chrX", 0, 300_000), ("chrY", 0, 300_000)], "chrom string, start_pos bigint, end_pos bigint")
    parts = parts or supported(*called(spark, sf_dir, counted))
    events_ = artifact.par_overlap(significant(spark, sf_dir, parts=parts).withColumn("sex_call", sex).withColumn("chrom_bins", F.lit(N_BINS)), par)
    return stored(artifact.classify_events(artifact.priority_score(artifact.artifact_flags(events_))))


def with_fractions(spark: SparkSession, sf_dir: str, counted: DataFrame | None = None) -> DataFrame:
    """Classified events with their abnormal fractions."""
    bins_, states = called(spark, sf_dir, counted)
    parts = supported(bins_, states)
    shares = calibrate.abnormal_fraction(parts[0].join(parts[2], "event_id"), bins_, calibrate.neutral_baseline(bins_), least_effective=1.5)
    return stored(classified(spark, sf_dir, parts).join(shares.select("event_id", "fraction_point", "fraction_ci_low", "fraction_ci_high", "fraction_status"), "event_id"))
