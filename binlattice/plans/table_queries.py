"""Queries of ingest, masks, benchmark, report and validation operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from binlattice.operators import classifier, evaluate, grid, qc, report
from binlattice.operators import sample_report as sr
from binlattice.functions.ordering import numbered
from binlattice.plans import adapters as a
from binlattice.plans.calling_queries import _FR, AR, SU
from binlattice.plans.registry import _CH, _MASK, BINS, TRUTH, X1, query, r6
from binlattice.sources import ingest


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("""WITH s AS (SELECT l_suppkey AS sample_id, CASE l_linenumber WHEN 1 THEN 'chr1' WHEN 2 THEN '2' WHEN 3 THEN 'X' WHEN 4 THEN '23' WHEN 5 THEN '24' WHEN 6 THEN 'chrM' ELSE 'Y' END AS k, list(CAST(l_quantity AS DOUBLE) ORDER BY l_orderkey, l_partkey, l_quantity) AS v FROM lineitem GROUP BY ALL),
  u AS (SELECT sample_id, CASE k WHEN '23' THEN 'chrX' WHEN '24' THEN 'chrY' WHEN '2' THEN 'chr2' WHEN 'X' THEN 'chrX' WHEN 'Y' THEN 'chrY' ELSE k END AS chrom, CASE WHEN k IN ('23', '24') THEN 1 ELSE 0 END AS r, v FROM s WHERE k <> 'chrM'),
  f AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY sample_id, chrom ORDER BY r) = 1) SELECT CAST(sample_id AS BIGINT) AS sample_id, chrom, i - 1 AS bin_index, (i - 1) * 1000 AS start_pos, i * 1000 AS end_pos, v[i] AS raw_count FROM f, unnest(range(1, len(v) + 1)) t(i)""")
def s1_explode_count_vectors(spark, sf):
    key = "CASE l_linenumber WHEN 1 THEN 'chr1' WHEN 2 THEN '2' WHEN 3 THEN 'X' WHEN 4 THEN '23' WHEN 5 THEN '24' WHEN 6 THEN 'chrM' ELSE 'Y' END AS k"
    rows = _table(spark, sf, "lineitem").selectExpr("CAST(l_suppkey AS BIGINT) AS sample_id", key, "l_orderkey", "l_partkey", "CAST(l_quantity AS DOUBLE) AS q")
    vectors = rows.groupBy("sample_id", "k").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_orderkey", "l_partkey", "q"))), lambda x: x["q"]).alias("v")).groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("bins"))
    return ingest.explode_count_vectors(vectors.withColumn("binsize", F.lit(1000)))


@query("SELECT o_orderkey, 'chr' || CAST(o_custkey % 22 + 1 AS VARCHAR) AS chrom, CAST(o_orderkey AS BIGINT) AS start_pos, CAST(o_orderkey + 50 AS BIGINT) AS end_pos FROM orders")
def s4_parse_region_specs(spark, sf):
    spec = _table(spark, sf, "orders").selectExpr("o_orderkey", "concat('chr', CAST(o_custkey % 22 + 1 AS STRING), ':', o_orderkey, '-', o_orderkey + 50) AS spec")
    return ingest.parse_region_specs(spec, "spec").drop("spec")


@query(f"""WITH {_MASK} SELECT chrom, bin_index, least(1.0, greatest(0.0, round(blacklist_overlap_fraction, 6))) AS blacklist_overlap_fraction, 0.0 AS par_overlap_fraction, CAST(blacklist_overlap_fraction > 0 AS INT) AS overlaps_blacklist, 0 AS overlaps_par, 'pass' AS mask_label,
  round(least(1.0, (n_a + n_c + n_g + n_t) / 90000.0), 6) AS mappability_score, CAST(regexp_matches(chrom, '^chr([1-9]|1[0-9]|2[0-2])$') AS INT) AS is_autosome FROM mask""")
def s13_with_default_columns(spark, sf):
    out = ingest.with_default_columns(a.annotated(spark, sf).drop("mappability_score"))
    return r6(out.select("chrom", "bin_index", "blacklist_overlap_fraction", "par_overlap_fraction", "overlaps_blacklist", "overlaps_par", "mask_label", "mappability_score", "is_autosome"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'E' END || CAST(i AS VARCHAR) AS id FROM customer, unnest(range(c_custkey % 7, c_custkey % 7 + 4)) t(i) WHERE c_custkey % 3 < 2 UNION ALL SELECT c_custkey, chr(CAST(65 + i AS INT)) FROM customer, unnest(range(0, 8)) t(i) WHERE c_custkey % 3 = 2")
def s14_expand_id_ranges(spark, sf):
    spec = "CASE c_custkey % 3 WHEN 0 THEN concat(c_custkey % 7 + 3, '–', c_custkey % 7) WHEN 1 THEN concat('e', c_custkey % 7, '-', c_custkey % 7 + 3) ELSE 'h-A' END AS ids"
    return ingest.expand_id_ranges(_table(spark, sf, "customer").selectExpr("c_custkey", spec), "ids").drop("ids")


@query("SELECT c_nationkey AS id, CASE WHEN c_nationkey % 2 = 0 THEN 'XX' ELSE 'XY' END AS sex FROM customer GROUP BY ALL")
def s15_sample_sex_map(spark, sf):
    return ingest.sample_sex_map(_table(spark, sf, "customer").selectExpr("c_nationkey AS id", "CASE WHEN c_nationkey % 2 = 0 THEN '46,xx' ELSE '46,XY' END AS sex"))


@query("SELECT c_custkey, row_number() OVER (ORDER BY lower(c_mktsegment), c_custkey) AS place FROM customer")
def s17_natural_order(spark, sf):
    named = _table(spark, sf, "customer").withColumn("name", F.concat("c_mktsegment", F.lit("-"), F.col("c_custkey").cast("string")))
    return numbered(named, [ingest.natural_sort_key(F.col("name"))], "place").select("c_custkey", "place")


_B8 = f"""{_MASK}, mr AS (SELECT *, CASE WHEN mask_label = 'pass' THEN '' ELSE mask_label || ':' || CAST(bin_index % 3 AS VARCHAR) END AS why FROM mask), tb AS (SELECT DISTINCT chrom, i * 250000 AS s, least((i + 1) * 250000, 2520000) AS e FROM mask, range(11) y(i)),
  ov AS (SELECT tb.*, mask_label, why, least(end_pos, e) - greatest(start_pos, s) AS bp FROM tb JOIN mr ON mr.chrom = tb.chrom AND start_pos < e AND end_pos > s), rs AS (SELECT chrom, s, e, why, sum(bp) AS bp FROM ov WHERE why <> '' GROUP BY ALL),
  tp AS (SELECT chrom, s, e, arg_max(why, (bp, length(why), why)) AS why FROM rs GROUP BY ALL), pf AS (SELECT chrom, s, e, {', '.join(f"coalesce(sum(bp) FILTER (WHERE mask_label = '{k}'), 0) / (e - s) AS {k[0]}" for k in ('hard', 'dynamic'))}, coalesce(sum(bp) FILTER (WHERE mask_label = 'soft'), 0) / (e - s) AS f FROM ov GROUP BY chrom, s, e)"""


@query(f"WITH {_B8} SELECT pf.chrom, pf.s AS start_pos, pf.e AS end_pos, CASE WHEN h >= 0.5 THEN 'hard' WHEN d >= 0.3 THEN 'dynamic' WHEN f >= 0.3 THEN 'soft' WHEN h > 0 OR d > 0 THEN 'dynamic' WHEN f > 0 THEN 'soft' ELSE 'pass' END AS mask_label, coalesce(why, '') AS mask_reason FROM pf LEFT JOIN tp ON tp.chrom = pf.chrom AND tp.s = pf.s")
def b8_project_mask(spark, sf):
    why = F.when(F.col("mask_label") == "pass", "").otherwise(F.concat("mask_label", F.lit(":"), (F.col("bin_index") % 3).cast("string")))
    return grid.project_mask(grid.make_bin_grid(a.chrom_sizes(spark), 250_000, "wide"), a.masked(spark, sf).withColumn("mask_reason", why), 90_000)


_GAP, _REP = "chrom IN ('chr13', 'chr14', 'chr15', 'chr21', 'chr22') AND gap_centromere_telomere_overlap_fraction >= 0.5", "chrom IN ('chr9', 'chr16') AND segmental_duplication_overlap_fraction >= 0.35"


@query(f"""WITH {_MASK}, w AS (SELECT *, coalesce({_GAP}, false) AS g, coalesce({_REP}, false) AS r FROM mask) SELECT chrom, bin_index, CASE WHEN g THEN 'hard' WHEN r AND mask_label IN ('pass', 'soft') THEN 'dynamic' ELSE mask_label END AS mask_label,
  CASE WHEN g AND mask_label <> 'hard' THEN 'branch_b_hotspot:acrocentric_gap' WHEN r AND mask_label IN ('pass', 'soft') THEN 'branch_b_hotspot:repeat_hotspot' ELSE '' END AS mask_reason FROM w""")
def b9_escalate_hotspots(spark, sf):
    return grid.escalate_hotspots(a.masked(spark, sf).withColumn("mask_reason", F.lit(""))).select("chrom", "bin_index", "mask_label", "mask_reason")


_AE = f"{AR}, ae AS (SELECT ar.*, e.chrom, e.state, e.start_pos, e.end_pos, e.f_high, e.f_clean, e.cmz, e.qv, greatest(abs(cmz), abs(cdz), abs(az)) AS support FROM ar JOIN a0 e ON e.event_id = ar.event_id)"
_VALUES = "segment_weight segment_mean_signal segment_median_signal segment_mean_robust_z segment_median_robust_z segment_abs_max_robust_z".split()
_NAMED = "cmz AS calibrated_mean_z, cdz AS calibrated_median_z, pv AS empirical_pvalue, qv AS empirical_qvalue, prio AS priority_score"
_ALL = f"""{AR}, af AS (SELECT a3.event_id, a3.sample_id, a3.chrom, a3.state, CAST(a3.n_bins AS DOUBLE) AS n_bins, {', '.join(_VALUES)}, {_NAMED}, (end_bin - start_bin + 1) / greatest(end_bin + 1, 1) AS chrom_fraction, CAST(state = 'gain' AS DOUBLE) AS is_gain, CAST(state = 'loss' AS DOUBLE) AS is_loss,
  CAST(chrom NOT IN ('chrX', 'chrY') AS DOUBLE) AS is_autosome, CAST(chrom IN ('chrX', 'chrY') AS DOUBLE) AS is_sex_chromosome, CAST(CASE WHEN ar.artifact_flags = '' THEN 0 ELSE len(string_split(ar.artifact_flags, ',')) END AS DOUBLE) AS flag_count,
  {', '.join(f"CAST(contains(ar.artifact_flags, '{flag}') AS DOUBLE) AS {out}" for flag, out in (('edge_event', 'has_edge_flag'), ('weak_empirical_support', 'has_weak_support_flag'), ('par_overlap', 'has_par_flag')))} FROM a3 JOIN ar ON ar.event_id = a3.event_id)"""


@query(f"WITH {_ALL} SELECT event_id, sample_id, chrom, state, {', '.join(f'round({c}, 6) AS {c}' for c in classifier.FEATURES)} FROM af")
def l1_classified_features(spark, sf):
    """All features, from events after the artifact rules."""
    return r6(classifier.event_features(a.classified(spark, sf)))


_IN = "least(e.end_pos, t_end) - greatest(e.start_pos, t_start) + 1 > 0"
_E4 = f"""{_AE}, {TRUTH}, tj AS (SELECT t.*, e.support, e.event_id IS NOT NULL AND (t_start IS NULL OR t_end IS NULL OR {_IN}) AS hit FROM truth t LEFT JOIN (SELECT * FROM ae WHERE keep_event = 1) e ON e.sample_id = t.sample_id AND e.chrom = t.chrom AND e.state = t.state),
  tm AS (SELECT truth_id, sample_id, chrom, state, CAST(bool_or(hit) AS INT) AS matched, CAST(coalesce(max(support) FILTER (WHERE hit) >= 2.5, false) AS INT) AS detected, max(support) FILTER (WHERE hit) AS top FROM tj GROUP BY ALL)"""


@query(f"WITH {_AE} SELECT chrom, state, artifact_status, count(*) AS event_count, CAST(sum(keep_event) AS BIGINT) AS kept_event_count, round(median(priority_score), 6) AS median_priority_score, round(median(abs(cmz)), 6) AS median_abs_calibrated_z FROM ae GROUP BY ALL")
def e1_event_metrics(spark, sf):
    return r6(evaluate.event_metrics(a.classified(spark, sf)))


@query(f"""WITH {_AE}, k(lo, hi, label) AS (VALUES (-1, 0.01, '<=0.01'), (0.01, 0.05, '0.01-0.05'), (0.05, 0.10, '0.05-0.10'), (0.10, 0.25, '0.10-0.25'), (0.25, 1, '>0.25'))
  SELECT label AS qvalue_bin, count(event_id) AS event_count, CAST(coalesce(sum(keep_event), 0) AS BIGINT) AS kept_event_count, round(median(priority_score), 6) AS median_priority_score FROM k LEFT JOIN ae ON coalesce(qv, 1) > lo AND coalesce(qv, 1) <= hi GROUP BY label""")
def e3_qvalue_calibration(spark, sf):
    return r6(evaluate.qvalue_calibration(a.classified(spark, sf)))


@query(f"WITH {_E4} SELECT truth_id, sample_id, chrom, state, matched, detected, round(top, 6) AS top_support_z FROM tm")
def e4_truth_metrics(spark, sf):
    return r6(evaluate.truth_metrics(a.classified(spark, sf), a.loaded_truth(spark, sf)))


@query(f"""WITH {_E4}, ta AS (SELECT count(*) AS truth_row_count, CAST(sum(matched) AS BIGINT) AS truth_match_count, CAST(sum(detected) AS BIGINT) AS truth_detected_count, round(avg(matched), 6) AS truth_match_rate, round(avg(detected), 6) AS truth_recall FROM tm)
  SELECT count(DISTINCT sample_id) AS sample_count, count(*) AS event_count, count(*) FILTER (WHERE keep_event = 1) AS kept_event_count, {', '.join(f"count(*) FILTER (WHERE artifact_status = '{k}') AS {k}_event_count" for k in ('pass', 'review', 'artifact'))},
  count(*) FILTER (WHERE f_high >= 0.5) AS high_risk_event_count, count(*) FILTER (WHERE f_clean >= 0.5) AS clean_supported_event_count, any_value(ta.truth_row_count) AS truth_row_count, any_value(ta.truth_match_count) AS truth_match_count, any_value(ta.truth_detected_count) AS truth_detected_count,
  any_value(ta.truth_match_rate) AS truth_match_rate, any_value(ta.truth_recall) AS truth_recall FROM ae, ta""")
def e5_evaluation_summary(spark, sf):
    found = a.classified(spark, sf)
    return r6(evaluate.evaluation_summary(found, evaluate.truth_metrics(found, a.loaded_truth(spark, sf))))


def _matched(spark, sf):
    kept = evaluate.kept_events(a.with_fractions(spark, sf))
    return report.match_truth(kept, a.loaded_truth(spark, sf), report.load_external(a.external(spark, sf)))


# fractions follow the events' support: the SQL of both begins alike
_AF = f"{_AE}{_FR[len(SU) :]}, ke AS (SELECT ae.*, fp, lo, hi, fstatus FROM ae JOIN f5 USING (event_id))"
_T2 = f"""{_AF}, {TRUTH}, xt AS (SELECT 'S' || CAST(o_custkey % 8 AS VARCHAR) AS sample_id, {_CH.format('(o_orderkey % 24)')} AS chrom, CASE WHEN o_custkey % 2 = 0 THEN 'gain' ELSE 'loss' END AS state, (o_orderkey % 28) * 90000 AS start_pos, (o_orderkey % 28) * 90000 + 200000 AS end_pos, abs(o_custkey % 17 - 8) AS z FROM orders),
  th AS (SELECT t.*, e.event_id, e.support, fp, lo, hi, e.event_id IS NOT NULL AND (t_start IS NULL OR t_end IS NULL OR {_IN}) AS hit FROM truth t LEFT JOIN (SELECT * FROM ke WHERE keep_event = 1) e ON e.sample_id = t.sample_id AND e.chrom = t.chrom AND e.state = t.state),
  mt AS (SELECT truth_id, sample_id, chrom, state, fraction AS tf, count(*) FILTER (WHERE hit) AS n_matched, arg_min(event_id, (-support, event_id)) FILTER (WHERE hit) AS top_event_id, max(support) FILTER (WHERE hit) AS tz FROM th GROUP BY ALL),
  mx AS (SELECT truth_id, count(*) FILTER (WHERE e.z IS NOT NULL AND (t_start IS NULL OR t_end IS NULL OR {_IN})) AS xn, CAST(max(e.z) FILTER (WHERE t_start IS NULL OR t_end IS NULL OR {_IN}) AS DOUBLE) AS xz FROM truth t LEFT JOIN xt e ON e.sample_id = t.sample_id AND e.chrom = t.chrom AND e.state = t.state GROUP BY ALL),
  mp AS (SELECT mt.*, xn, xz, ke.fp AS point, ke.lo, ke.hi, ke.fstatus FROM mt JOIN mx USING (truth_id) LEFT JOIN ke ON ke.event_id = mt.top_event_id)"""


@query(f"WITH {_T2} SELECT truth_id, n_matched, top_event_id, round(tz, 6) AS top_z, round(point, 6) AS point, fstatus AS fraction_status, round(tf, 6) AS truth_fraction, CAST(coalesce(tz >= 2.5, false) AS INT) AS detected, xn AS external_n_matched, xz AS external_top_z, CAST(coalesce(xz >= 5, false) AS INT) AS external_detected FROM mp")
def t2_match_truth(spark, sf):
    return r6(_matched(spark, sf).select("truth_id", "n_matched", "top_event_id", "top_z", "point", "fraction_status", "truth_fraction", "detected", "external_n_matched", "external_top_z", "external_detected"))


@query(f"WITH {_T2}, e AS (SELECT abs(point - tf) AS e, CASE WHEN point - tf IS NOT NULL THEN CAST(tf >= lo AND tf <= hi AS INT) END AS c FROM mp) SELECT count(e) AS n, round(avg(e), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(median(e), 6) AS median_abs_error, round(avg(c), 6) AS coverage FROM e")
def t4_fraction_errors(spark, sf):
    return r6(report.fraction_error_summary(report.fraction_errors(_matched(spark, sf))))


_BIN = "CASE WHEN {0} IS NULL THEN 'unknown' WHEN {0} <= 0.05 THEN '<=5%' WHEN {0} <= 0.10 THEN '5-10%' WHEN {0} <= 0.15 THEN '10-15%' WHEN {0} <= 0.20 THEN '15-20%' WHEN {0} <= 0.30 THEN '20-30%' ELSE '>30%' END"
_T5 = f"""{_T2}, ad AS (SELECT truth_id, CAST(l AS DOUBLE) AS level, tz * l AS scaled_z, CAST(coalesce(tz * l >= 2.5, false) AS INT) AS detected, xz * l AS external_scaled_z, CAST(coalesce(xz * l >= 5, false) AS INT) AS external_detected, point * l AS fraction_proxy, coalesce(tf * l, point * l) AS target_fraction,
  CASE WHEN tf IS NOT NULL THEN 'truth_fraction' WHEN point IS NOT NULL THEN 'branch_b_estimate' ELSE '' END AS fraction_source FROM mp, (VALUES (CAST(1 AS DOUBLE)), (0.5), (0.25)) v(l))"""


def _admixture(spark, sf):
    return report.admixture_grid(_matched(spark, sf), [1.0, 0.5, 0.25])


@query(f"WITH {_T5} SELECT truth_id, level, round(scaled_z, 6) AS scaled_z, detected, external_scaled_z, external_detected, round(fraction_proxy, 6) AS fraction_proxy, round(target_fraction, 6) AS target_fraction, fraction_source, {_BIN.format('target_fraction')} AS fraction_bin FROM ad")
def t5_admixture_grid(spark, sf):
    return r6(_admixture(spark, sf).select("truth_id", "level", "scaled_z", "detected", "external_scaled_z", "external_detected", "fraction_proxy", "target_fraction", "fraction_source", "fraction_bin"))


@query(f"WITH {_T5} SELECT level, round(avg(detected), 6) AS detection_rate, round(avg(external_detected), 6) AS external_detection_rate, count(*) AS truth_event_count FROM ad GROUP BY ALL")
def t6_detection_by_level(spark, sf):
    return r6(report.detection_by_level(_admixture(spark, sf)))


@query(f"WITH {_T5} SELECT CAST(x AS DOUBLE) AS threshold, count(CASE WHEN target_fraction <= x THEN 1 END) AS n, round(avg(CASE WHEN target_fraction <= x THEN detected END), 6) AS rate FROM ad, (VALUES (CAST(0.05 AS DOUBLE)), (0.1), (0.15), (0.2), (0.3)) v(x) GROUP BY x")
def t7_low_fraction_detection(spark, sf):
    return r6(evaluate.low_fraction_detection(_admixture(spark, sf), [0.05, 0.1, 0.15, 0.2, 0.3], "target_fraction", "detected"))


@query(f"WITH {_AE} SELECT CASE WHEN f_high >= 0.5 THEN 'high_risk' ELSE 'clean_or_mixed' END AS risk_bucket, count(*) AS n_events FROM ae WHERE keep_event = 1 GROUP BY ALL")
def t9_risk_bucket_counts(spark, sf):
    return report.risk_bucket_counts(a.classified(spark, sf))


_IQ = """lq AS (SELECT *, ln(1 + raw_count) AS l FROM bins), mq AS (SELECT *, median(l) OVER (PARTITION BY sample_id) AS m FROM lq), iq AS (SELECT sample_id, sum(raw_count) AS total, avg(CAST(raw_count > 0 AS INT)) AS nz, median(abs(l - m)) AS md FROM mq GROUP BY ALL),
  ql AS (SELECT sample_id, nz, md, CASE WHEN total >= 2000 AND nz >= 0.4 AND md <= 1.2 THEN 'PASS' ELSE concat_ws(',', CASE WHEN total < 2000 THEN 'low_total' END, CASE WHEN nz < 0.4 THEN 'low_nonzero' END, CASE WHEN md > 1.2 THEN 'high_mad' END) END AS qc_status FROM iq)"""


def _quality(counted):
    return qc.input_qc(counted, least_total=2000).select("sample_id", F.col("status").alias("qc_status"), "log_mad", "nonzero_fraction")


@query(f"""WITH {_AE}, {X1}, {_IQ}, es AS (SELECT sample_id, count(*) AS total_events, CAST(sum(keep_event) AS BIGINT) AS kept_events, count(*) FILTER (WHERE artifact_status = 'pass') AS pass_events, count(*) FILTER (WHERE artifact_status = 'review') AS review_events, round(max(priority_score), 6) AS top_priority_score,
  round(max(abs(cmz)), 6) AS max_abs_calibrated_z, count(*) FILTER (WHERE f_high >= 0.5) AS high_risk_events, count(*) FILTER (WHERE f_clean >= 0.5) AS clean_supported_events FROM ae GROUP BY ALL)
  SELECT es.*, sex_call, qc_status, round(md, 6) AS log_mad, round(nz, 6) AS nonzero_fraction FROM es LEFT JOIN sx USING (sample_id) LEFT JOIN ql USING (sample_id)""")
def e2_sample_metrics(spark, sf):
    counted = a.bins(spark, sf)
    return r6(report.sample_metrics(a.classified(spark, sf, counted=counted), a.depths(spark, sf, counted).select("sample_id", "sex_call"), _quality(counted)))


@query(f"WITH {_AE} SELECT event_id, round(greatest(abs(cmz), abs(cdz), abs(az)), 6) AS support_z FROM a0")
def e6_event_support_z(spark, sf):
    return r6(a.significant(spark, sf).select("event_id", report.event_support_z("calibrated_mean_z", "calibrated_median_z", "event_corr_adjusted_z").alias("support_z")))


_SUP = "keep_event = 1 AND artifact_status = 'review' AND chrom IN ('chrX', 'chrY')"


@query(f"WITH {_AE} SELECT sample_id, count(*) AS n_events, CAST(sum(keep_event) AS BIGINT) AS n_kept, count(*) FILTER (WHERE artifact_status = 'pass') AS n_pass, count(*) FILTER (WHERE artifact_status = 'review') AS n_review, round(max(priority_score), 6) AS top_priority, count(*) FILTER (WHERE {_SUP}) AS n_suppressed FROM ae GROUP BY ALL")
def p1_sample_event_rollup(spark, sf):
    return r6(report.sample_event_rollup(a.classified(spark, sf)))


_P2 = f"""{_AF}, dp AS (SELECT sample_id, event_id, chrom || ':' || start_pos || '-' || end_pos || ' ' || state || ' [' || artifact_status || '/' || technical_confidence || ']' AS top_event, CASE WHEN fp IS NOT NULL THEN printf('%.1f%%', 100 * fp) ELSE '' END AS top_fraction,
  CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN printf('%.1f%% to %.1f%%', 100 * lo, 100 * hi) ELSE '' END AS top_fraction_ci, artifact_flags AS top_flags, downgrade_reason AS top_downgrade_reason
  FROM ke WHERE keep_event = 1 AND NOT ({_SUP}) QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY priority_score DESC, n_bins DESC, end_pos DESC, event_id) = 1)"""


@query(f"WITH {_P2} SELECT * FROM dp")
def p2_top_display_event(spark, sf):
    return report.top_display_event(a.with_fractions(spark, sf))


@query(f"""WITH {_P2}, {X1}, {_IQ}, ro AS (SELECT sample_id, sum(keep_event) AS k, count(*) FILTER (WHERE {_SUP}) AS h FROM ke GROUP BY ALL), xs AS (SELECT 'S' || CAST(o_custkey % 8 AS VARCHAR) AS sample_id, arg_max('chr' || replace({_CH.format('(o_orderkey % 24)')}, 'chr', '') || ':' || (o_orderkey % 28) * 90000 || '-' || ((o_orderkey % 28) * 90000 + 200000) || ' ' || CASE WHEN o_custkey % 2 = 0 THEN 'dup' ELSE '-' END,
    (abs(o_custkey % 17 - 8), (o_orderkey % 28) * 90000 + 200000, 'chr' || replace({_CH.format('(o_orderkey % 24)')}, 'chr', '') || ':' || (o_orderkey % 28) * 90000 || '-' || ((o_orderkey % 28) * 90000 + 200000) || ' ' || CASE WHEN o_custkey % 2 = 0 THEN 'dup' ELSE '-' END)) AS ext FROM orders GROUP BY ALL)
  SELECT ro.sample_id, 'Branch B kept ' || k || ' events; top event: ' || coalesce(top_event, CASE WHEN h > 0 THEN 'suppressed_sex_chromosome_review' ELSE 'none' END) || '; fraction=' || coalesce(nullif(top_fraction, ''), 'not_estimated') || '; flags=' || coalesce(nullif(top_flags, ''), CASE WHEN h > 0 THEN 'sex_chromosome_event' ELSE 'none' END)
    || '; downgrade=' || coalesce(nullif(top_downgrade_reason, ''), CASE WHEN h > 0 THEN 'sex_chromosome_review_suppressed' ELSE 'none' END) || '; sex_review_suppressed=' || h || '; QC=' || qc_status || '; sex=' || sex_call AS technical_conclusion,
    coalesce(top_event, ext, CASE WHEN h > 0 THEN 'Branch B top event suppressed (sex-chromosome review only)' ELSE 'No A-branch event' END) AS biological_conclusion FROM ro LEFT JOIN dp USING (sample_id) LEFT JOIN xs USING (sample_id) LEFT JOIN sx USING (sample_id) LEFT JOIN ql USING (sample_id)""")
def p4_sample_conclusions(spark, sf):
    counted = a.bins(spark, sf)
    found = a.with_fractions(spark, sf, counted)
    samples = a.depths(spark, sf, counted).select("sample_id", "sex_call").join(_quality(counted).select("sample_id", "qc_status"), "sample_id")
    other = sr.top_external_event(samples.select("sample_id"), a.external(spark, sf))
    return report.sample_conclusions(samples, report.sample_event_rollup(found), report.top_display_event(found), other)


@query("""WITH t AS (SELECT c_nationkey AS k, c_mktsegment AS s, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN '1.5' ELSE '0.25' END AS f FROM customer), g AS (SELECT k, s, count(*) AS n FROM t GROUP BY ALL) SELECT count(*) AS n_rows, count(*) FILTER (WHERE f = '0.25') AS n_complete, count(*) FILTER (WHERE f = '') AS n_missing,
  count(*) FILTER (WHERE f IN ('x', '1.5')) AS n_invalid, (SELECT count(*) FROM g WHERE n > 1) AS n_duplicate_keys, 'incomplete' AS status FROM t""")
def v1_validate_truth(spark, sf):
    raw = "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN '1.5' ELSE '0.25' END AS abnormal_cell_fraction"
    return report.validate_truth(_table(spark, sf, "customer").selectExpr("c_nationkey AS sample_id", "'chr1' AS chrom", "c_mktsegment AS expected_state", raw))


@query("""WITH d AS (SELECT CASE WHEN c_custkey % 10 = 0 THEN 5.0 ELSE 0.0 END AS far, c_mktsegment = 'BUILDING' AS word FROM customer), n AS (SELECT max(far) AS far, count(*) FILTER (WHERE far > 0) AS moved, count(*) FILTER (WHERE word) AS words, count(*) FILTER (WHERE word OR far > 0) AS either FROM d)
  SELECT 'numbers' AS what, CASE WHEN far > 1 THEN 'float_tolerance_only' ELSE 'identical' END AS status, moved AS n_rows_differ, CAST(far AS DOUBLE) AS max_abs_diff FROM n UNION ALL SELECT 'within', CASE WHEN far > 10 THEN 'float_tolerance_only' ELSE 'identical' END, moved, CAST(far AS DOUBLE) FROM n
  UNION ALL SELECT 'words', CASE WHEN words > 0 THEN 'value_changed' WHEN far > 1 THEN 'float_tolerance_only' ELSE 'identical' END, either, CAST(far AS DOUBLE) FROM n""")
def v2_diff_tables(spark, sf):
    base = _table(spark, sf, "customer").selectExpr("c_custkey AS sample_id", "c_mktsegment AS word", "floor(CAST(c_acctbal AS DOUBLE)) AS x")
    moved = base.withColumn("x", F.col("x") + F.when(F.col("sample_id") % 10 == 0, 5).otherwise(0))
    said = moved.withColumn("word", F.when(F.col("word") == "BUILDING", "other").otherwise(F.col("word")))
    cases = {"numbers": (moved, 1.0), "within": (moved, 10.0), "words": (said, 1.0)}
    found = [report.diff_tables(base, other, tolerance=t).withColumn("what", F.lit(name)) for name, (other, t) in cases.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("SELECT user_id AS run_key, CASE WHEN bool_or(event_type = 'error') THEN 'log_failed' WHEN bool_or(event_type = 'purchase') THEN 'log_complete' ELSE 'benchmark_only' END AS status FROM events GROUP BY ALL")
def u3_run_status(spark, sf):
    return report.run_status(_table(spark, sf, "events").selectExpr("user_id AS run_key", "event_type AS line", "false AS outputs_exist"), ["error"], ["purchase"])


_Q12 = f"{BINS}, sz AS (SELECT sample_id, chrom, z, start_pos // (z * 90000) AS b, sum(raw_count) AS n FROM bins, (VALUES (1), (2), (4)) v(z) GROUP BY ALL), qd AS (SELECT sample_id, CAST(z * 90 AS VARCHAR) || 'kb' AS bin_label, avg(CAST(n = 0 AS INT)) AS zf, median(n) AS md FROM sz GROUP BY ALL), q2 AS (SELECT *, CASE WHEN zf > 0.05 THEN 'FAIL' WHEN zf > 0.001 THEN 'WARN' ELSE 'PASS' END AS d FROM qd)"


def _by_size(spark, sf):
    sizes = a.bins(spark, sf).select("*", F.explode(F.array(*[F.lit(k) for k in (1, 2, 4)])).alias("z"))
    counts = sizes.groupBy("sample_id", "chrom", "z", F.floor(F.col("start_pos") / (F.col("z") * 90_000)).alias("b")).agg(F.sum("raw_count").alias("n"))
    per = counts.groupBy("sample_id", grid.bin_size_label(F.col("z") * 90_000).alias("bin_label")).agg(F.avg((F.col("n") == 0).cast("double")).alias("zero_fraction"), F.median("n").alias("count"))
    return qc.qc_decision(per, [("zero_fraction", "max", 0.001, 0.05)])


@query(f"WITH {_Q12} SELECT bin_label, count(*) FILTER (WHERE d = 'PASS') AS n_pass, count(*) FILTER (WHERE d = 'WARN') AS n_warn, count(*) FILTER (WHERE d = 'FAIL') AS n_fail, round(median(zf), 6) AS median_zero_fraction, round(median(md), 6) AS median_count FROM q2 GROUP BY ALL")
def q11_binsize_summary(spark, sf):
    return r6(report.binsize_summary(_by_size(spark, sf), ["zero_fraction", "count"]))


@query(f"WITH {_Q12} SELECT sample_id, max(d) FILTER (WHERE bin_label = '90kb') AS d90, max(d) FILTER (WHERE bin_label = '360kb') AS d360, count(*) FILTER (WHERE d = 'FAIL') AS n_fail, count(*) FILTER (WHERE d = 'WARN') AS n_warn, max(CASE d WHEN 'PASS' THEN 0 WHEN 'WARN' THEN 1 ELSE 2 END) AS worst_rank, CAST(count(*) FILTER (WHERE d = 'PASS') = 3 AS INT) AS stable_retained FROM q2 GROUP BY ALL")
def q12_sample_decision_matrix(spark, sf):
    out = report.sample_decision_matrix(_by_size(spark, sf), ["90kb", "180kb", "360kb"])
    return out.select("sample_id", F.col("90kb").alias("d90"), F.col("360kb").alias("d360"), "n_fail", "n_warn", "worst_rank", "stable_retained")
