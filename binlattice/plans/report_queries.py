"""Queries of the tables over samples and of the event classifier, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from pyspark.sql import functions as F

from binlattice.operators import classifier, qc, report
from binlattice.operators import sample_report as sr
from binlattice.plans import adapters as a
from binlattice.plans.registry import _LOO, _MASK, BINS, EVENTS, TRUTH, query, r6

_U = f"""{BINS}, u AS (SELECT sample_id, avg(CAST(raw_count = 0 AS INT)) AS zf, CAST(sum(raw_count) AS BIGINT) AS mf, count(*) AS nb FROM bins GROUP BY ALL),
  dec AS (SELECT *, CASE WHEN zf > 0.58 OR mf < 200 THEN 'FAIL' WHEN zf > 0.01 OR mf < 600 THEN 'WARN' ELSE 'PASS' END AS d, CASE WHEN right(sample_id, 1) < '4' THEN 'low' ELSE 'high' END AS batch FROM u)"""


def _decided(spark, sf):
    checks = [("zero_fraction", "max", 0.01, 0.58), ("mapped_fragments", "min", 600, 200)]
    batch = F.when(F.substring("sample_id", -1, 1) < "4", "low").otherwise("high")
    return qc.qc_decision(qc.uniformity_metrics(a.bins(spark, sf)), checks).withColumn("batch_group", batch)


@query(f"WITH {_U} SELECT a.sample_id, b.sample_id AS ref_sample_id, b.mf AS mapped_fragments, b.nb AS usable_bins, round(b.zf, 6) AS zero_bin_fraction FROM u a JOIN u b ON a.sample_id <> b.sample_id")
def q5_reference_sample_table(spark, sf):
    metrics = qc.uniformity_metrics(a.bins(spark, sf))
    return r6(sr.reference_sample_table(metrics, metrics))


@query(f"WITH {_U} SELECT sample_id, d AS qc_decision, row_number() OVER (ORDER BY CASE d WHEN 'PASS' THEN 0 WHEN 'WARN' THEN 1 ELSE 2 END, sample_id) AS place FROM dec")
def q6_rank_samples_by_decision(spark, sf):
    return sr.rank_samples_by_decision(_decided(spark, sf)).select("sample_id", "qc_decision", "place")


@query(f"WITH {_U} SELECT CASE WHEN d = 'PASS' THEN 'retained' ELSE 'outlier' END AS part, sample_id FROM dec")
def q7_split_retained_outliers(spark, sf):
    kept, out = sr.split_retained_outliers(_decided(spark, sf))
    return kept.select(F.lit("retained").alias("part"), "sample_id").union(out.select(F.lit("outlier"), "sample_id"))


@query(f"WITH {_U} SELECT batch AS batch_group, count(*) AS n_samples, count(*) FILTER (WHERE d = 'PASS') AS n_pass, count(*) FILTER (WHERE d = 'WARN') AS n_warn, count(*) FILTER (WHERE d = 'FAIL') AS n_fail, median(mf) AS median_mapped_fragments, round(median(zf), 6) AS median_zero_fraction FROM dec GROUP BY ALL")
def q9_batch_decision_distribution(spark, sf):
    return r6(sr.batch_decision_distribution(_decided(spark, sf), ["mapped_fragments", "zero_fraction"]))


_PROF = f"{_LOO}, prof AS (SELECT sample_id, chrom, bin_index, (v - ref_median) / ref_sigma AS z FROM loo), pc0 AS (SELECT sample_id, chrom, abs(median(z)) AS m FROM prof GROUP BY ALL), pc1 AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY m DESC, chrom) AS r FROM pc0)"


def _profile(spark, sf, counted=None):
    return a.leave_one_out(spark, sf, counted).select("sample_id", "chrom", "bin_index", ((F.col("v") - F.col("ref_median")) / F.col("ref_sigma")).alias("z"))


@query(f"""WITH {_PROF} SELECT * FROM (SELECT sample_id, round(median(abs(z)), 6) AS global_median_abs_z FROM prof GROUP BY ALL) JOIN (SELECT sample_id, round(max(m), 6) AS max_chrom_abs_median_z, round(avg(CAST(m >= 1 AS INT)), 6) AS broad_noise_fraction,
  max(CASE WHEN r = 1 THEN chrom END) AS top_chr_1, max(CASE WHEN r = 2 THEN chrom END) AS top_chr_2, max(CASE WHEN r = 3 THEN chrom END) AS top_chr_3 FROM pc1 GROUP BY ALL) USING (sample_id)""")
def q14_profile_chromosome_summary(spark, sf):
    return r6(sr.profile_chromosome_summary(_profile(spark, sf), ["sample_id"]))


_SM = """s AS (SELECT s_suppkey AS sample_id, CASE s_suppkey % 4 WHEN 0 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS worst_decision, CAST(s_suppkey % 4 = 2 AS INT) AS stable_retained, s_suppkey % 3 AS fail_count FROM supplier),
  lib AS (SELECT l_suppkey AS sample_id, CAST(sum(l_quantity) AS DOUBLE) AS raw_reads, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END) AS DOUBLE) AS clean_reads, round(avg(CAST(l_discount AS DOUBLE)), 9) AS duplication_rate, round(avg(CAST(l_quantity AS DOUBLE)) * 6, 9) AS insert_peak FROM lineitem GROUP BY ALL),
  fl AS (SELECT l_suppkey AS sample_id, count(*) AS total_reads, count(*) FILTER (WHERE l_quantity > 1) AS mapped_reads, count(*) FILTER (WHERE l_linenumber < 7) AS paired_reads, count(*) FILTER (WHERE l_linenumber < 7 AND l_quantity > 2) AS properly_paired_reads, count(*) FILTER (WHERE l_linenumber < 7 AND l_quantity = 1) AS singleton_reads,
    count(*) FILTER (WHERE l_linenumber = 1 AND l_quantity = 2) AS mate_diff_chr_reads FROM lineitem GROUP BY ALL),
  bi AS (SELECT l_suppkey AS sample_id, CAST(max(l_linenumber) + min(l_linenumber) - 3 AS DOUBLE) AS max_chr_fraction_dev_z FROM lineitem GROUP BY ALL), pr AS (SELECT ps_suppkey AS sample_id, CASE ps_partkey % 2 WHEN 0 THEN '1mb' ELSE '500kb' END AS bin_label, count(*) / 60.0 AS broad_noise_fraction, count(*) / 15.0 AS max_chrom_abs_median_z FROM (SELECT l_suppkey AS ps_suppkey, l_partkey AS ps_partkey FROM lineitem) GROUP BY ALL),
  j AS (SELECT s.*, lib.* EXCLUDE (sample_id), fl.* EXCLUDE (sample_id), max_chr_fraction_dev_z, broad_noise_fraction, max_chrom_abs_median_z FROM s LEFT JOIN lib USING (sample_id) LEFT JOIN fl USING (sample_id) LEFT JOIN bi USING (sample_id) LEFT JOIN (SELECT sample_id, broad_noise_fraction, max_chrom_abs_median_z FROM pr WHERE bin_label = '1mb') p USING (sample_id)),
  m AS (SELECT *, clean_reads / nullif(raw_reads, 0) AS clean_read_rate, mapped_reads / nullif(total_reads, 0) AS mapping_rate, properly_paired_reads / nullif(paired_reads, 0) AS proper_pair_rate, singleton_reads / nullif(paired_reads, 0) AS singleton_rate, mate_diff_chr_reads / nullif(paired_reads, 0) AS diff_chr_rate FROM j)"""


def _sample_metrics(spark, sf):
    items = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("q", F.col("l_quantity").cast("double"))
    key = F.col("l_suppkey").alias("sample_id")
    samples = spark.read.parquet(f"{sf}/supplier.parquet").selectExpr("s_suppkey AS sample_id", "CASE s_suppkey % 4 WHEN 0 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS worst_decision", "CAST(s_suppkey % 4 = 2 AS INT) AS stable_retained", "s_suppkey % 3 AS fail_count")
    library = items.groupBy(key).agg(
        F.sum("q").alias("raw_reads"), F.sum(F.when(F.col("l_returnflag") != "R", F.col("q")).otherwise(0.0)).alias("clean_reads"), F.round(F.avg(F.col("l_discount").cast("double")), 9).alias("duplication_rate"), F.round(F.avg("q") * 6, 9).alias("insert_peak")
    )
    n = lambda c, name: F.expr(f"count_if({c})").alias(name)
    flag = items.groupBy(key).agg(
        F.count("*").alias("total_reads"), n("q > 1", "mapped_reads"), n("l_linenumber < 7", "paired_reads"), n("l_linenumber < 7 AND q > 2", "properly_paired_reads"), n("l_linenumber < 7 AND q = 1", "singleton_reads"), n("l_linenumber = 1 AND q = 2", "mate_diff_chr_reads")
    )
    bias = items.groupBy(key).agg((F.max("l_linenumber") + F.min("l_linenumber") - 3).cast("double").alias("max_chr_fraction_dev_z"))
    label = F.when(F.col("l_partkey") % 2 == 0, "1mb").otherwise("500kb").alias("bin_label")
    profile = items.groupBy(key, label).agg((F.count("*") / 60.0).alias("broad_noise_fraction"), (F.count("*") / 15.0).alias("max_chrom_abs_median_z"))
    return sr.join_sample_metrics(samples, library, flag, bias, profile)


@query(f"WITH {_SM} SELECT sample_id, worst_decision, round(clean_read_rate, 6) AS clean_read_rate, round(mapping_rate, 6) AS mapping_rate, round(proper_pair_rate, 6) AS proper_pair_rate, round(singleton_rate, 6) AS singleton_rate, round(diff_chr_rate, 6) AS diff_chr_rate, round(broad_noise_fraction, 6) AS broad_noise_fraction FROM m")
def q16_join_sample_metrics(spark, sf):
    return r6(_sample_metrics(spark, sf).select("sample_id", "worst_decision", "clean_read_rate", "mapping_rate", "proper_pair_rate", "singleton_rate", "diff_chr_rate", "broad_noise_fraction"))


@query(f"""WITH {_SM}, co AS (SELECT * FROM m WHERE CASE WHEN (SELECT count(*) FROM m WHERE stable_retained = 1) > 0 THEN stable_retained = 1 ELSE worst_decision = 'PASS' END), cm AS (SELECT median(insert_peak) AS im, median(duplication_rate) AS dm FROM co),
  cd AS (SELECT im, dm, (SELECT median(abs(insert_peak - im)) FROM co, cm) AS id, (SELECT median(abs(duplication_rate - dm)) FROM co, cm) AS dd FROM cm),
  t AS (SELECT m.*, coalesce(duplication_rate - dm > greatest(0.01, 3 * dd), false) AS dup, coalesce(abs(insert_peak - im) > greatest(25.0, 3 * id), false) AS ins, coalesce(max_chr_fraction_dev_z >= 4, false) AS cb, coalesce(max_chrom_abs_median_z >= 1.8, false) AS cp, coalesce(mapping_rate >= 0.985, false) AS mo, coalesce(proper_pair_rate >= 0.96, false) AS po, coalesce(broad_noise_fraction >= 0.25, false) AS bn FROM m, cd)
  SELECT sample_id, worst_decision, fail_count, CASE WHEN cb AND cp AND mo AND po AND NOT dup AND NOT ins THEN '{sr.DIAGNOSES["dna"]}' WHEN bn OR dup OR ins OR NOT mo OR NOT po THEN '{sr.DIAGNOSES["library"]}' ELSE '{sr.DIAGNOSES["noise"]}' END AS diagnosis FROM t WHERE worst_decision <> 'PASS'""")
def q17_diagnose_failed_samples(spark, sf):
    return sr.diagnose_failed_samples(_sample_metrics(spark, sf))


_SUM = f"""{_MASK}, prof AS (SELECT sample_id, chrom, bin_index, (v - ref_median) / ref_sigma AS z FROM loo), rk AS (SELECT *, rank() OVER (PARTITION BY sample_id ORDER BY ref_median) + (count(*) OVER (PARTITION BY sample_id, ref_median) - 1) / 2 AS rx, rank() OVER (PARTITION BY sample_id ORDER BY v) + (count(*) OVER (PARTITION BY sample_id, v) - 1) / 2 AS ry FROM loo),
  su AS (SELECT sample_id, median(abs((v - ref_median) / ref_sigma)) AS mz2, corr(rx, ry) AS sp FROM rk GROUP BY ALL), sh AS (SELECT p.sample_id, avg(CAST(mask_label <> 'pass' AS INT)) AS mfr FROM prof p JOIN mask USING (chrom, bin_index) GROUP BY ALL),
  cs AS (SELECT sample_id, max(m) AS shift, arg_max(chrom, (m, chrom)) AS top FROM (SELECT sample_id, chrom, abs(median(z)) AS m FROM prof GROUP BY ALL) GROUP BY ALL), al AS (SELECT * FROM su LEFT JOIN sh USING (sample_id) LEFT JOIN cs USING (sample_id)),
  qe AS (SELECT sample_id, 'profile_missing' AS event_type, 'no-call' AS status, 'profile_tsv_missing' AS detail FROM al WHERE mfr IS NULL
    UNION ALL SELECT sample_id, 'correlation_drop', CASE WHEN sp < 0.83 THEN 'fail' ELSE 'review' END, printf('spearman_r=%.4f', sp) FROM al WHERE mfr IS NOT NULL AND sp < 0.9
    UNION ALL SELECT sample_id, 'broad_noise', CASE WHEN mz2 >= 1.5 THEN 'fail' ELSE 'review' END, printf('median_abs_z=%.4f', mz2) FROM al WHERE mfr IS NOT NULL AND mz2 >= 1
    UNION ALL SELECT sample_id, 'masked_bin_burden', CASE WHEN mfr >= 0.2 THEN 'fail' ELSE 'review' END, printf('masked_fraction=%.4f', mfr) FROM al WHERE mfr >= 0.1
    UNION ALL SELECT sample_id, 'chromosome_shift_hint', CASE WHEN shift >= 4 THEN 'fail' ELSE 'review' END, top || printf(' median_abs_z=%.4f', shift) FROM al WHERE shift >= 2.5)"""


def _summary(spark, sf):
    """Samples with their deviation, their profiles and the mask."""
    counted = a.bins(spark, sf)
    return qc.reference_deviation(a.leave_one_out(spark, sf, counted)), _profile(spark, sf, counted), a.masked(spark, sf, counted)


@query(f"WITH {_SUM} SELECT sample_id, event_type, status, detail FROM qe")
def q18_qc_events(spark, sf):
    return sr.qc_events(*_summary(spark, sf))


@query(f"WITH {_MASK} SELECT chrom, bin_index, CASE WHEN mask_label IN ('soft', 'dynamic') THEN 'review' WHEN mask_label = 'hard' THEN 'no-call' ELSE 'pass' END AS qc_status FROM mask")
def q19_bin_qc_status(spark, sf):
    return sr.bin_qc_status(a.masked(spark, sf)).select("chrom", "bin_index", "qc_status")


_EV = "SELECT CAST(user_id % 40 AS BIGINT) AS sample_id, CASE event_type WHEN 'error' THEN 'fail' WHEN 'purchase' THEN 'no-call' ELSE 'review' END AS status FROM events"
_ESC = f"""qs AS (SELECT CAST(i AS BIGINT) AS sample_id, CASE i % 5 WHEN 0 THEN 'WARN' WHEN 1 THEN 'FAIL' WHEN 2 THEN 'odd' ELSE 'PASS' END AS d FROM (SELECT DISTINCT user_id % 40 AS i FROM events)), ee AS ({_EV}),
  fg AS (SELECT sample_id, bool_or(status = 'fail') AS f, bool_or(status = 'review') AS r, bool_or(status = 'no-call') AS n FROM ee GROUP BY ALL), bs AS (SELECT *, CASE d WHEN 'PASS' THEN 'pass' WHEN 'FAIL' THEN 'fail' ELSE 'review' END AS o FROM qs),
  st AS (SELECT sample_id, CASE WHEN coalesce(f, false) THEN 'fail' WHEN coalesce(n, false) THEN 'no-call' WHEN coalesce(r, false) AND o = 'pass' THEN 'review' ELSE o END AS status FROM bs LEFT JOIN fg USING (sample_id))"""


def _escalated(spark, sf):
    table = spark.read.parquet(f"{sf}/events.parquet")
    found = table.selectExpr("CAST(user_id % 40 AS BIGINT) AS sample_id", "CASE event_type WHEN 'error' THEN 'fail' WHEN 'purchase' THEN 'no-call' ELSE 'review' END AS status")
    summary = table.selectExpr("CAST(user_id % 40 AS BIGINT) AS sample_id").distinct().selectExpr("*", "CASE sample_id % 5 WHEN 0 THEN 'WARN' WHEN 1 THEN 'FAIL' WHEN 2 THEN 'odd' ELSE 'PASS' END AS qc_decision")
    return sr.escalate_sample_status(summary, found), found


@query(f"WITH {_ESC} SELECT sample_id, status FROM st")
def q20_escalate_sample_status(spark, sf):
    return _escalated(spark, sf)[0]


_N = lambda t, c, s, out: f"(SELECT count(*) FROM {t} WHERE {c} = '{s}') AS {out}"


@query(f"""WITH {_MASK}, {_ESC}, bq AS (SELECT CASE WHEN mask_label IN ('soft', 'dynamic') THEN 'review' WHEN mask_label = 'hard' THEN 'no-call' ELSE 'pass' END AS q FROM mask) SELECT (SELECT count(*) FROM st) AS sample_count,
  {', '.join(_N('st', 'status', s, s.replace('-', '_') + '_count') for s in ('pass', 'review', 'fail', 'no-call'))}, {', '.join(_N('bq', 'q', s, 'bin_' + s.replace('-', '_') + '_count') for s in ('pass', 'review', 'no-call'))}, (SELECT count(*) FROM ee) AS event_count,
  CASE WHEN EXISTS (SELECT 1 FROM st WHERE status = 'fail') THEN 'fail' WHEN EXISTS (SELECT 1 FROM st WHERE status = 'review') THEN 'review' ELSE 'pass' END AS status""")
def q21_run_rollup(spark, sf):
    status, found = _escalated(spark, sf)
    return sr.run_rollup(status, sr.bin_qc_status(a.masked(spark, sf)), found)


_PX = "SELECT CAST(l_suppkey AS BIGINT) AS sample_id, CAST(l_linenumber AS VARCHAR) AS chrom, CAST(l_orderkey AS BIGINT) * 100 AS start_pos, CAST(l_orderkey AS BIGINT) * 100 + CAST(l_partkey AS BIGINT) AS end_pos, CASE WHEN l_returnflag = 'R' THEN 'gain' ELSE 'loss' END AS kind, CAST(l_quantity AS DOUBLE) - 26 AS zscore FROM lineitem"


@query(f"""WITH x AS ({_PX}), y AS (SELECT *, 'chr' || chrom || ':' || start_pos || '-' || end_pos || ' ' || kind AS tx FROM x), g AS (SELECT sample_id, count(*) AS n, arg_max(tx, (abs(zscore), end_pos, tx)) AS t FROM y GROUP BY ALL)
  SELECT CAST(s_suppkey AS BIGINT) AS sample_id, coalesce(n, 0) AS event_count, coalesce(t, '') AS top_event FROM supplier LEFT JOIN g ON s_suppkey = sample_id""")
def p3_top_external_event(spark, sf):
    samples = spark.read.parquet(f"{sf}/supplier.parquet").selectExpr("CAST(s_suppkey AS BIGINT) AS sample_id")
    found = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        "CAST(l_suppkey AS BIGINT) AS sample_id", "CAST(l_linenumber AS STRING) AS chrom", "CAST(l_orderkey AS BIGINT) * 100 AS start_pos", "CAST(l_orderkey AS BIGINT) * 100 + CAST(l_partkey AS BIGINT) AS end_pos",
        "CASE WHEN l_returnflag = 'R' THEN 'gain' ELSE 'loss' END AS kind", "CAST(l_quantity AS DOUBLE) - 26 AS zscore",
    )
    return sr.top_external_event(samples, found)


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'XX' ELSE 'XY' END AS sex_call, CASE WHEN c_custkey % 3 = 0 THEN 'M' WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, CASE WHEN c_nationkey % 2 = 0 THEN 'ref_xx' ELSE 'ref_xy' END AS reference FROM customer""")
def x4_route_reference(spark, sf):
    calls = spark.read.parquet(f"{sf}/customer.parquet").selectExpr("c_custkey", "CASE WHEN c_nationkey % 2 = 0 THEN ' xx' ELSE 'XY' END AS sex_call", "CASE c_custkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN '' END AS predict_gender")
    references = spark.createDataFrame([("XX", "ref_xx"), ("XY", "ref_xy")], "sex_call string, reference string")
    return sr.route_reference(calls, references).drop("predict_gender")


_FL = "concat_ws(',', CASE WHEN start_bin <= 2 THEN 'edge_event' END, CASE WHEN max_abs_z < 1.5 THEN 'weak_empirical_support' END, CASE WHEN chrom = 'chrX' AND start_bin < 4 THEN 'par_overlap' END)"
_FEAT = f"""{EVENTS}, fe AS (SELECT event_id, sample_id, chrom, state, CAST(n_bins AS DOUBLE) AS n_bins, mean_z AS segment_mean_robust_z, (end_bin - start_bin + 1) / greatest(end_bin + 1, 1) AS chrom_fraction, CAST(state = 'gain' AS DOUBLE) AS is_gain, CAST(chrom IN ('chrX', 'chrY') AS DOUBLE) AS is_sex_chromosome,
  CAST(CASE WHEN {_FL} = '' THEN 0 ELSE len(string_split({_FL}, ',')) END AS DOUBLE) AS flag_count, CAST(start_bin <= 2 AS DOUBLE) AS has_edge_flag, CAST(max_abs_z < 1.5 AS DOUBLE) AS has_weak_support_flag, CAST(chrom = 'chrX' AND start_bin < 4 AS DOUBLE) AS has_par_flag FROM ev)"""
_SHOWN = ["n_bins", "segment_mean_robust_z", "chrom_fraction", "is_gain", "is_sex_chromosome", "flag_count", "has_edge_flag", "has_weak_support_flag", "has_par_flag"]
_SHOW = "event_id, sample_id, chrom, state, " + ", ".join(f"round({c}, 6) AS {c}" for c in _SHOWN)


def _features(spark, sf):
    flags = F.expr(_FL)
    named = a.events(spark, sf).withColumns({"artifact_flags": flags, "segment_mean_robust_z": F.col("mean_z"), "segment_median_robust_z": F.col("median_z"), "segment_abs_max_robust_z": F.col("max_abs_z")})
    return classifier.event_features(named)


@query(f"WITH {_FEAT} SELECT {_SHOW} FROM fe")
def l1_event_features(spark, sf):
    return r6(_features(spark, sf).select("event_id", "sample_id", "chrom", "state", *_SHOWN))


def _labels(spark, sf):
    return a.loaded_truth(spark, sf).groupBy("sample_id", "chrom", "state").agg(F.max(F.col("truth_id") % 2).cast("int").alias("label"))


@query(f"WITH {_FEAT}, {TRUTH}, lb AS (SELECT sample_id, chrom, state, CAST(max(truth_id % 2) AS INT) AS label FROM truth GROUP BY ALL) SELECT event_id, label FROM fe LEFT JOIN lb USING (sample_id, chrom, state)")
def l2_attach_labels(spark, sf):
    return classifier.attach_labels(_features(spark, sf), _labels(spark, sf)).select("event_id", "label")


def _trained(spark, sf):
    """A model of labels that follow from two of the features, so its scores show that training works and nothing more."""
    rows = _features(spark, sf)
    label = ((F.col("state") == "gain") & (F.col("segment_abs_max_robust_z") > 1.4)).cast("int")
    return classifier.train_event_classifier(classifier.attach_labels(rows, rows.select("event_id", label.alias("label"))), 3, maxIter=5)


@query(None)
def l3_classifier_folds(spark, sf):
    return r6(classifier.fold_metrics(_trained(spark, sf)[1]))


@query(f"""WITH {EVENTS}, s AS (SELECT round(1 / (1 + max_abs_z), 9) AS y, CAST(state = 'gain' AS INT) AS l FROM ev) SELECT CAST(least(floor(y * 10), 9) AS INT) AS bin, round(avg(y), 6) AS mean_predicted, round(avg(l), 6) AS observed_positive_rate, count(*) AS n FROM s GROUP BY 1""")
def l4_reliability_curve(spark, sf):
    scored = a.events(spark, sf).select(F.round(1 / (1 + F.col("max_abs_z")), 9).alias("y_score"), (F.col("state") == "gain").cast("int").alias("label"))
    return r6(classifier.reliability_curve(scored))


@query(None)
def l5_feature_importance(spark, sf):
    return r6(classifier.feature_importance(_trained(spark, sf)[0]))


@query("""SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'batch5_E' WHEN 1 THEN 'batch3_num' WHEN 2 THEN 'batch2_AH' ELSE 'other' END AS batch_group FROM customer""")
def q8_batch_group(spark, sf):
    name = "CASE c_custkey % 7 WHEN 0 THEN concat('E', c_custkey) WHEN 1 THEN CAST(c_custkey AS STRING) WHEN 2 THEN char(65 + c_custkey % 8) WHEN 3 THEN concat('E', c_custkey, 'x') WHEN 4 THEN concat(c_custkey, '-a') WHEN 5 THEN 'K' ELSE 'c' END"
    return spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", report.batch_group(F.expr(name)).alias("batch_group"))


@query("""WITH c AS (SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'XX' ELSE 'XY' END AS m, CASE c_custkey % 4 WHEN 0 THEN 'XX' WHEN 1 THEN 'XY' WHEN 2 THEN 'ambiguous' END AS d FROM customer),
  h AS (SELECT c_custkey, 'hybrid' AS method, CASE WHEN d IN ('XX', 'XY') THEN d ELSE m END AS sex, CASE WHEN d IN ('XX', 'XY') AND d <> m THEN 'depth_override' WHEN d IN ('XX', 'XY') THEN 'model_depth_consensus' ELSE 'model_fallback' END AS sex_source FROM c
    UNION ALL SELECT c_custkey, 'depth_only', CASE WHEN d IN ('XX', 'XY') THEN d ELSE m END, CASE WHEN d IN ('XX', 'XY') THEN 'depth_only' ELSE 'depth_only_fallback_model' END FROM c UNION ALL SELECT c_custkey, 'model_only', m, 'model_only' FROM c)
  SELECT *, CASE sex WHEN 'XX' THEN 'F' WHEN 'XY' THEN 'M' ELSE '' END AS gender FROM h""")
def x3_resolve_sex(spark, sf):
    calls = spark.read.parquet(f"{sf}/customer.parquet").selectExpr("c_custkey", "CASE WHEN c_nationkey % 2 = 0 THEN 'XX' ELSE 'XY' END AS model_call", "CASE c_custkey % 4 WHEN 0 THEN 'XX' WHEN 1 THEN 'XY' WHEN 2 THEN 'ambiguous' END AS depth_call")
    each = [report.resolve_sex(calls, m).select("c_custkey", F.lit(m).alias("method"), "sex", "gender", "sex_source") for m in ("hybrid", "depth_only", "model_only")]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query("""SELECT CAST(c_nationkey AS BIGINT) AS "group", CAST(bool_and(c_acctbal < 9000) OR bool_and(c_acctbal > 9000) AS INT) AS applicable FROM customer GROUP BY ALL""")
def r16_cutoff_applicability(spark, sf):
    values = spark.read.parquet(f"{sf}/customer.parquet").selectExpr("CAST(c_nationkey AS BIGINT) AS `group`", "c_acctbal")
    return report.cutoff_applicability(values, "c_acctbal", 9000)
