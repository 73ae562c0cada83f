"""Queries of calling, calibration, fractions and artifact rules, each with the SQL that gives the same rows."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from binlattice.operators import artifact, calibrate, calling
from binlattice.plans import adapters as a
from binlattice.plans.registry import _C1, AUTO, _erfc, _robust, query, r6

_OV = ", ".join(a.OVERLAPS)
CB = f"""{_C1}, {_robust('norm', 'sample_id, chrom', 'scored')}, rk AS (SELECT chrom, bin_index, s AS risk, CASE WHEN hi THEN 'high' WHEN mo THEN 'moderate' ELSE 'clean' END AS cls, least(1.0, greatest(0.1, exp(-2 * s))) AS rw,
  1 + 2.5 * s + CASE WHEN hi THEN 0.5 ELSE 0 END AS vi, NOT (hi OR mask_label = 'hard') AS seed, {AUTO} AND NOT hi AND NOT mo AND mask_label NOT IN ('soft', 'dynamic', 'hard') AS nul, mask_label, {_OV} FROM c2),
  cb AS (SELECT n.sample_id, chrom, bin_index, n.start_pos, n.end_pos, n.x, n.z AS lz, greatest(n.w * rw, 0.1) AS cw0, {AUTO} AS au, rk.* EXCLUDE (chrom, bin_index) FROM scored n JOIN rk USING (chrom, bin_index))"""
SC0 = f"""{CB}, tg AS (SELECT DISTINCT sample_id, chrom AS tgt FROM cb UNION ALL SELECT DISTINCT sample_id, '' FROM cb),
  bg AS (SELECT tg.sample_id, tgt, x, au, seed, min(CASE WHEN au AND seed THEN 1 WHEN au THEN 2 WHEN seed THEN 3 ELSE 4 END) OVER (PARTITION BY tg.sample_id, tgt) AS t FROM tg JOIN cb ON cb.sample_id = tg.sample_id AND cb.chrom <> tgt),
  bm AS (SELECT *, median(x) OVER (PARTITION BY sample_id, tgt) AS m FROM bg WHERE t = 4 OR (t = 1 AND au AND seed) OR (t = 2 AND au) OR (t = 3 AND seed)),
  gs AS (SELECT sample_id, tgt, max(m) AS gc, greatest(1.4826 * median(abs(x - m)), stddev_pop(x), 1e-6) AS gsc FROM bm GROUP BY ALL),
  cm AS (SELECT sample_id, chrom, au, sum(cw0 * x) / sum(cw0) AS mn FROM cb GROUP BY ALL),
  sm AS (SELECT p.sample_id, p.chrom, p.mn, o.mn AS y, median(o.mn) OVER (PARTITION BY p.sample_id, p.chrom) AS m FROM cm p JOIN cm o ON o.sample_id = p.sample_id AND o.chrom <> p.chrom AND (o.au OR NOT p.au)),
  ss AS (SELECT sample_id, chrom, max(mn) - max(m) AS d, greatest(1.4826 * median(abs(y - m)), stddev_pop(y), 1e-6) AS s FROM sm GROUP BY ALL),
  sh AS (SELECT ss.sample_id, ss.chrom, d / greatest(s, gsc) AS shift FROM ss JOIN gs ON gs.sample_id = ss.sample_id AND tgt = ''),
  sc0 AS (SELECT cb.*, (x - gc) / gsc AS gz, shift, (lz + shift) / vi AS z, CASE WHEN seed THEN cw0 ELSE cw0 * 0.5 END AS cw FROM cb JOIN sh ON sh.sample_id = cb.sample_id AND sh.chrom = cb.chrom JOIN gs ON gs.sample_id = cb.sample_id AND gs.tgt = cb.chrom)"""
# the level-wise segmentation as a recursive query: each level splits the segments of the level before where their means differ most
_AT = "{0}.sample_id = {1}.sample_id AND {0}.chrom = {1}.chrom"
_HELD = _AT + " AND {1}.bin_index >= {0}.lb AND {1}.bin_index < {0}.rb"
SEG = f"""yg1 AS (SELECT sample_id, chrom, bin_index, z, greatest(cw, 1e-6) AS w, seed, row_number() OVER (PARTITION BY sample_id, chrom ORDER BY bin_index) AS ri FROM sc0),
  yg2 AS (SELECT *, ri - row_number() OVER (PARTITION BY sample_id, chrom ORDER BY bin_index) AS run FROM yg1 WHERE seed), yg3 AS (SELECT *, count(*) OVER (PARTITION BY sample_id, chrom, run) AS bn FROM yg2),
  yg4 AS (SELECT *, dense_rank() OVER (PARTITION BY sample_id, chrom ORDER BY run) AS blk FROM yg3 WHERE bn >= 5),
  yg5 AS (SELECT sample_id, chrom, blk, bin_index, row_number() OVER o - 1 AS i, lag(bin_index) OVER o AS pb, sum(w) OVER o AS w1, sum(w * z) OVER o AS z1 FROM yg4 WINDOW o AS (PARTITION BY sample_id, chrom, blk ORDER BY bin_index)),
  ysr AS (SELECT *, coalesce(lag(w1) OVER o, 0) AS w0, coalesce(lag(z1) OVER o, 0) AS z0 FROM yg5 WINDOW o AS (PARTITION BY sample_id, chrom, blk ORDER BY i)),
  ysg(sample_id, chrom, blk, a, b, wa, wb, za, zb, lb, rb, n) AS (
    SELECT sample_id, chrom, blk, CAST(0 AS BIGINT), count(*), CAST(0 AS DOUBLE), max(w1), CAST(0 AS DOUBLE), arg_max(z1, i), min(bin_index), max(bin_index) + 1, CAST(1 AS BIGINT) FROM ysr GROUP BY sample_id, chrom, blk
    UNION ALL
    SELECT sample_id, chrom, blk, CASE WHEN low THEN a ELSE i END, CASE WHEN low THEN i ELSE b END, CASE WHEN low THEN wa ELSE w0 END, CASE WHEN low THEN w0 ELSE wb END, CASE WHEN low THEN za ELSE z0 END, CASE WHEN low THEN z0 ELSE zb END,
           CASE WHEN low THEN lb ELSE bin_index END, CASE WHEN low THEN pb + 1 ELSE rb END, n + k
    FROM (SELECT *, count(*) OVER (PARTITION BY sample_id, chrom, blk) AS k FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, chrom, blk ORDER BY a) AS nth FROM (
      SELECT *, row_number() OVER (PARTITION BY sample_id, chrom, blk, a ORDER BY score DESC, i) AS best FROM (
        SELECT g.*, r.i, r.w0, r.z0, r.bin_index, r.pb, abs((z0 - za) / (w0 - wa) - (zb - z0) / (wb - w0)) * sqrt((w0 - wa) * (wb - w0) / (w0 - wa + (wb - w0))) AS score
        FROM ysg g JOIN ysr r ON {_AT.format('r', 'g')} AND r.blk = g.blk AND r.i >= g.a + 5 AND r.i <= g.b - 5)) WHERE best = 1 AND score >= 1.0) WHERE n + nth <= 12), (VALUES (true), (false)) t(low)),
  ysl AS (SELECT sample_id, chrom, blk, lb, min(rb) AS rb FROM ysg GROUP BY ALL),
  ys0 AS (SELECT ysl.*, sum(z * greatest(cw, 1e-6)) / sum(greatest(cw, 1e-6)) AS mean_z, median(z) AS median_z, count(*) AS nb FROM ysl JOIN sc0 ON {_HELD.format('ysl', 'sc0')} GROUP BY ALL),
  ys1s AS (SELECT *, CASE WHEN abs(mean_z) >= abs(median_z) THEN mean_z ELSE median_z END AS main FROM ys0),
  seg AS (SELECT *, CASE WHEN abs(main) < 0.5 THEN 'neutral' WHEN main > 0 THEN 'gain' ELSE 'loss' END AS state FROM ys1s)"""
SC = f"""{SC0}, {SEG}, sc AS (SELECT sc0.*, coalesce(seg.state, 'neutral') AS st FROM sc0 LEFT JOIN seg ON {_HELD.format('seg', 'sc0')})"""
_ES = """min(bin_index) AS start_bin, max(bin_index) AS end_bin, min(start_pos) AS start_pos, max(end_pos) AS end_pos, count(*) AS n_bins, sum(cw) AS segment_weight, sum(x * cw) / sum(cw) AS segment_mean_signal, median(x) AS segment_median_signal,
  sum({z} * cw) / sum(cw) AS segment_mean_robust_z, median({z}) AS segment_median_robust_z, max(abs({z})) AS segment_abs_max_robust_z"""
_NUM = ["segment_weight", "segment_mean_signal", "segment_median_signal", "segment_mean_robust_z", "segment_median_robust_z", "segment_abs_max_robust_z"]
_INT = ["start_bin", "end_bin", "start_pos", "end_pos", "n_bins"]
_OUT = "event_id, chrom, state, " + ", ".join(_INT) + ", " + ", ".join(f"round({c}, 6) AS {c}" for c in _NUM)
_COLS = ["event_id", "chrom", "state", *_INT, *_NUM]
EV = f"""{SC}, mc0 AS (SELECT *, coalesce(lag(rb) OVER o = lb AND lag(state) OVER o = state AND lag(blk) OVER o = blk, false) AS joined FROM seg WHERE state <> 'neutral' AND nb >= 3 WINDOW o AS (PARTITION BY sample_id, chrom ORDER BY lb)),
  mc1 AS (SELECT *, CAST(sum(CAST(NOT joined AS INT)) OVER (PARTITION BY sample_id, chrom ORDER BY lb) AS BIGINT) AS merged FROM mc0), mc AS (SELECT sample_id, chrom, blk, state, merged, min(lb) AS lb, max(rb) AS rb FROM mc1 GROUP BY ALL),
  ev AS (SELECT mc.sample_id || '.' || mc.chrom || '_block' || CAST(blk AS VARCHAR) || '_merged' || CAST(merged AS VARCHAR) || '.' || state AS event_id, mc.sample_id, mc.chrom, state, {_ES.format(z='z')} FROM mc JOIN sc ON {_HELD.format('mc', 'sc')} GROUP BY mc.sample_id, mc.chrom, blk, merged, state)"""
# runs of one state, without the segments
RUNS = f"""{SC}, l1 AS (SELECT *, row_number() OVER (PARTITION BY sample_id, chrom ORDER BY bin_index) AS i FROM sc), l2 AS (SELECT *, i - row_number() OVER (PARTITION BY sample_id, chrom, st ORDER BY bin_index) AS run FROM l1 WHERE st <> 'neutral'),
  ru AS (SELECT sample_id || '.' || chrom || '.' || CAST(min(bin_index) AS VARCHAR) || '.' || st AS event_id, sample_id, chrom, st AS state, {_ES.format(z='z')} FROM l2 GROUP BY sample_id, chrom, st, run HAVING count(*) >= 2 AND max(abs(z)) >= 0.6)"""


@query(f"WITH {CB} SELECT sample_id, chrom, bin_index, round(cw0, 6) AS calling_weight FROM cb")
def c2_calling_weight(spark, sf):
    return r6(a.calling_bins(spark, sf).select("sample_id", "chrom", "bin_index", "calling_weight"))


@query(f"WITH {SC} SELECT sample_id, chrom, bin_index, round(gz, 6) AS global_robust_z, round(lz, 6) AS raw_local_robust_z, round(shift, 6) AS chrom_shift_z, round(z, 6) AS robust_z, round(cw, 6) AS calling_weight FROM sc")
def c4_score_bins(spark, sf):
    return r6(a.scored_bins(spark, sf).select("sample_id", "chrom", "bin_index", "global_robust_z", "raw_local_robust_z", "chrom_shift_z", "robust_z", "calling_weight"))


@query(f"WITH {SC} SELECT sample_id, chrom, blk AS block_index, row_number() OVER (PARTITION BY sample_id, chrom, blk ORDER BY lb) AS segment_index, lb AS left_bin, rb AS right_bin FROM ysl")
def c6_segment_series(spark, sf):
    return calling.segment_series(a.stored(a.scored_bins(spark, sf)), threshold=a.LEAST_SPLIT)


@query(f"WITH {SC} SELECT sample_id, chrom, bin_index, st AS hmm_state FROM sc")
def c6_bin_states(spark, sf):
    return a.called(spark, sf)[0].select("sample_id", "chrom", "bin_index", "hmm_state")


def _viterbi_sql() -> str:
    # scores and paths of the three states along a chromosome's segments
    names, keep, move = ["loss", "neutral", "gain"], repr(math.log(0.995)), repr(math.log((1 - 0.995) / 2))
    emit = lambda i: f"- (q.mean_z - ({0.5 * (i - 1)})) ** 2 / (2 * q.sigma * q.sigma)"
    came = lambda i: [f"v.s{j} + {keep if i == j else move}" for j in range(3)]
    first = ", ".join(f"0 {emit(i)} AS s{i}, '{name}' AS p{i}" for i, name in enumerate(names))
    step = ", ".join(
        f"greatest({', '.join(came(i))}) {emit(i)}, CASE greatest({', '.join(came(i))}) WHEN {came(i)[0]} THEN v.p0 WHEN {came(i)[1]} THEN v.p1 ELSE v.p2 END || ',{name}'" for i, name in enumerate(names)
    )
    return f"""WITH {SC}, q AS (SELECT sample_id, chrom, mean_z, row_number() OVER (PARTITION BY sample_id, chrom ORDER BY lb) AS i, count(*) OVER (PARTITION BY sample_id, chrom) AS n, greatest(stddev_pop(mean_z) OVER (PARTITION BY sample_id, chrom), 1.0) AS sigma FROM seg),
  v AS (SELECT sample_id, chrom, i, n, {first} FROM q WHERE i = 1 UNION ALL SELECT q.sample_id, q.chrom, q.i, q.n, {step} FROM v JOIN q ON {_AT.format('q', 'v')} AND q.i = v.i + 1)
  SELECT sample_id, chrom, CASE greatest(s0, s1, s2) WHEN s0 THEN p0 WHEN s1 THEN p1 ELSE p2 END AS path FROM v WHERE i = n"""


@query(_viterbi_sql())
def c7_viterbi(spark, sf):
    return calling.viterbi_states(a.called(spark, sf)[1], shift=0.5).select("sample_id", "chrom", F.concat_ws(",", "path").alias("path"))


@query(f"WITH {EV} SELECT {_OUT} FROM ev")
def c10_segment_events(spark, sf):
    return r6(a.candidates(*a.called(spark, sf)).select(*_COLS))


@query(f"WITH {RUNS} SELECT {_OUT} FROM ru")
def c10_state_runs(spark, sf):
    return r6(calling.run_calls(a.called(spark, sf)[0], 0.6, 2).select(*_COLS))


_DOS = f"{SC}, dos AS (SELECT sample_id || '.' || chrom || '.chr_dosage.' || CASE WHEN max(shift) > 0 THEN 'gain' ELSE 'loss' END AS event_id, sample_id, chrom, CASE WHEN max(shift) > 0 THEN 'gain' ELSE 'loss' END AS state, {_ES.format(z='z')} FROM sc GROUP BY sample_id, chrom HAVING abs(max(shift)) >= 0.15 AND sum(cw) ** 2 / sum(cw * cw) >= 10 AND avg(CAST(cls = 'clean' AS INT)) >= 0.3)"


@query(f"WITH {_DOS} SELECT {_OUT} FROM dos")
def c11_dosage_events(spark, sf):
    return r6(calling.dosage_events(a.scored_bins(spark, sf), least_shift=0.15).select(*_COLS))


def _hard_gaps(bins):
    return bins.withColumn("mask_label", F.when(F.col("gap_centromere_telomere_overlap_fraction") > 0, "hard").otherwise(F.col("mask_label")))


_RESCUE = f"""g1r AS (SELECT *, gap_centromere_telomere_overlap_fraction > 0 AND CASE WHEN shift > 0 THEN -lz ELSE lz END >= 0.1 AS k, row_number() OVER (PARTITION BY sample_id, chrom ORDER BY bin_index) AS i FROM sc WHERE abs(shift) >= 0.05),
  g2r AS (SELECT *, i - row_number() OVER (PARTITION BY sample_id, chrom ORDER BY bin_index) AS run, CASE WHEN shift > 0 THEN 'loss' ELSE 'gain' END AS state FROM g1r WHERE k),
  g3r AS (SELECT sample_id, chrom, state, run, median(abs(lz)) AS mid, {_ES.format(z='lz')} FROM g2r GROUP BY sample_id, chrom, state, run HAVING count(*) >= 2),
  g4r AS (SELECT *, sample_id || '.' || chrom || '.masked_gap_rescue_' || CAST(row_number() OVER (PARTITION BY sample_id, chrom ORDER BY start_bin) AS VARCHAR) || '.' || state AS event_id FROM g3r)"""


@query(f"WITH {SC}, {_RESCUE} SELECT {_OUT} FROM g4r WHERE mid >= 0.2")
def c12_gap_rescue_events(spark, sf):
    return r6(calling.gap_rescue_events(_hard_gaps(a.scored_bins(spark, sf)), 0.05, 0.1, 0.2, 2).select(*_COLS))


@query(f"""WITH {EV}, {_DOS[len(SC) + 2:]}, {_RESCUE}, al AS (SELECT e.* FROM (SELECT event_id, sample_id, chrom, state, start_bin, end_bin, n_bins FROM ev UNION ALL SELECT event_id, sample_id, chrom, state, start_bin, end_bin, n_bins FROM g4r WHERE mid >= 0.2) e LEFT JOIN dos d ON d.sample_id = e.sample_id AND d.chrom = e.chrom AND d.state = e.state WHERE d.chrom IS NULL OR greatest(0, least(e.end_bin, d.end_bin) - greatest(e.start_bin, d.start_bin) + 1) / (greatest(e.end_bin, d.end_bin) - least(e.start_bin, d.start_bin) + 1) < 0.1)
  SELECT event_id, chrom, state, n_bins FROM al UNION ALL SELECT event_id, chrom, state, n_bins FROM dos""")
def c14_fuse_events(spark, sf):
    bins, states = a.called(spark, sf)
    dosage = calling.dosage_events(bins, least_shift=0.15)
    rescue = calling.gap_rescue_events(_hard_gaps(bins), 0.05, 0.1, 0.2, 2)
    return calling.fuse_events(dosage, a.candidates(bins, states).unionByName(rescue), 0.1).select("event_id", "chrom", "state", "n_bins")


@query(f"""WITH {EV}, p AS (SELECT sample_id, chrom, count(*) AS n, sum(cw) ** 2 / sum(cw * cw) AS ess, max(shift) AS sh FROM sc GROUP BY ALL),
  q AS (SELECT sample_id, CAST(sum(n) AS BIGINT) AS n_bins, median(ess) AS e, max(abs(sh)) AS m, string_agg(chrom || '=' || printf('%.6f', sh + 0.0), ',' ORDER BY chrom) AS shifts FROM p GROUP BY ALL)
  SELECT q.sample_id, n_bins, round(e, 6) AS median_effective_bins, round(m, 6) AS max_abs_shift, shifts, round(gc, 6) AS background_center, round(gsc, 6) AS background_scale, (SELECT count(*) FROM ev WHERE ev.sample_id = q.sample_id) AS n_events FROM q JOIN gs ON gs.sample_id = q.sample_id AND tgt = ''""")
def c15_calling_summary(spark, sf):
    bins, states = a.called(spark, sf)
    found = calling.calling_summary(bins, a.candidates(bins, states))
    listed = F.array_join(F.transform(F.array_sort(F.map_entries("chrom_shift_z")), lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.6f", e["value"] + 0.0))), ",")
    return r6(found.withColumn("shifts", listed).drop("chrom_shift_z"))


NU = f"""{EV}, k1 AS (SELECT *, nul OR NOT bool_or(nul) OVER (PARTITION BY sample_id) AS p, nul AND st = 'neutral' AS n FROM sc), kq AS (SELECT sample_id, quantile_cont(z, 0.1) AS lo, quantile_cont(z, 0.9) AS hi FROM k1 WHERE p GROUP BY ALL),
  k2 AS (SELECT k1.*, p AND z >= lo AND z <= hi AS md FROM k1 JOIN kq USING (sample_id)), k3 AS (SELECT *, sum(CAST(n AS INT)) OVER (PARTITION BY sample_id) AS cn, sum(CAST(md AS INT)) OVER (PARTITION BY sample_id) AS cmd FROM k2),
  k4 AS (SELECT *, median(z) OVER (PARTITION BY sample_id) AS zm FROM k3 WHERE CASE WHEN cn >= 200 THEN n WHEN cmd >= 200 THEN md ELSE true END),
  nu AS (SELECT sample_id, count(*) AS n_null, max(zm) AS null_median, greatest(1.4826 * median(abs(z - zm)), stddev_pop(z), 1e-6) AS null_scale FROM k4 GROUP BY ALL)"""


@query(f"WITH {NU} SELECT sample_id, n_null, round(null_median, 6) AS null_median, round(null_scale, 6) AS null_scale FROM nu")
def k1_empirical_null(spark, sf):
    return r6(calibrate.empirical_null(a.called(spark, sf)[0]))


@query(f"WITH {NU} SELECT sample_id, chrom, bin_index, round((z - null_median) / null_scale, 6) AS calibrated_z FROM sc JOIN nu USING (sample_id)")
def k2_calibrate_bins(spark, sf):
    bins = a.called(spark, sf)[0]
    return r6(calibrate.calibrate_bins(bins, calibrate.empirical_null(bins)).select("sample_id", "chrom", "bin_index", "calibrated_z"))


SU = f"""{NU}, ac AS (SELECT *, z - avg(z) OVER (PARTITION BY sample_id, chrom) AS d, count(*) OVER (PARTITION BY sample_id, chrom) AS nn FROM k4),
  al2 AS (SELECT *, d * lag(d, CAST(k AS INT)) OVER (PARTITION BY sample_id, chrom, k ORDER BY bin_index) AS dd FROM ac, range(1, 6) t(k)), ap AS (SELECT sample_id, chrom, k, nn, sum(dd) AS dd, avg(d * d) AS v FROM al2 GROUP BY ALL),
  rho AS (SELECT sample_id, k, greatest(-0.95, least(0.95, avg(dd / ((nn - k) * v)))) AS rho FROM ap WHERE nn >= 3 AND v > 1e-20 AND nn > k GROUP BY sample_id, k),
  eb AS (SELECT e.event_id, b.*, (z - null_median) / null_scale AS cz FROM ev e JOIN sc b ON b.sample_id = e.sample_id AND b.chrom = e.chrom AND b.bin_index BETWEEN start_bin AND end_bin JOIN nu ON nu.sample_id = b.sample_id),
  s1 AS (SELECT event_id, sample_id, count(*) AS n, sum(greatest(cw, 0.1) * cz) / sqrt(sum(greatest(cw, 0.1) ** 2)) AS ewz, sum(greatest(cw, 0.1)) ** 2 / sum(greatest(cw, 0.1) ** 2) AS ess, {', '.join(f"sum(CASE WHEN cls = '{k}' THEN greatest(cw, 0.1) ELSE 0 END) / sum(greatest(cw, 0.1)) AS f_{k}" for k in ('clean', 'moderate', 'high'))},
    sum(risk * greatest(cw, 0.1)) / sum(greatest(cw, 0.1)) AS rmean, max(risk) AS rmax, CAST(arg_min(cls, bin_index) <> arg_max(cls, bin_index) AND bool_or(cls = 'clean') AND bool_or(cls = 'high') AS INT) AS crossing, {', '.join(f'avg({c}) AS {c}' for c in a.OVERLAPS)} FROM eb GROUP BY ALL),
  su AS (SELECT s1.*, greatest(1.0, 1 + 2 * coalesce((SELECT sum(rho * (1 - k / n)) FROM rho WHERE rho.sample_id = s1.sample_id AND k < n), 0)) AS infl FROM s1)"""


@query(f"""WITH {SU} SELECT event_id, round(ewz, 6) AS event_weighted_z, round(ess, 6) AS effective_bin_count, round(f_clean, 6) AS clean_bin_fraction, round(f_moderate, 6) AS moderate_risk_bin_fraction, round(f_high, 6) AS high_risk_bin_fraction,
  round(rmean, 6) AS region_risk_score_mean, round(rmax, 6) AS region_risk_score_max, crossing AS high_risk_boundary_crossing, {', '.join(f'round({c}, 6) AS {c}' for c in a.OVERLAPS)}, round(infl, 6) AS autocorr_inflation, round(ewz / sqrt(infl), 6) AS event_corr_adjusted_z FROM su""")
def k3_event_support(spark, sf):
    bins, states = a.called(spark, sf)
    null = calibrate.empirical_null(bins)
    return r6(calibrate.event_support(a.candidates(bins, states), calibrate.calibrate_bins(bins, null), calibrate.null_autocorrelation(bins), a.OVERLAPS))


_SIG = ["event_id", "calibrated_mean_z", "calibrated_median_z", "empirical_pvalue", "empirical_qvalue", "keep_event"]


SG = f"""{SU}, g0 AS (SELECT ev.*, su.* EXCLUDE (event_id, sample_id), null_median, null_scale, n_null, (segment_mean_robust_z - null_median) / null_scale AS cmz, (segment_median_robust_z - null_median) / null_scale AS cdz, ewz / sqrt(infl) AS az, {_erfc('abs(ewz / sqrt(infl)) / sqrt(CAST(2 AS DOUBLE))')} AS pv
    FROM ev JOIN su ON su.event_id = ev.event_id JOIN nu ON nu.sample_id = ev.sample_id), g1 AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY pv, event_id) AS r, count(*) OVER (PARTITION BY sample_id) AS fam FROM g0),
  sg2 AS (SELECT *, least(1.0, min(pv * fam / r) OVER (PARTITION BY sample_id ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS qv, greatest(abs(cmz), abs(cdz), abs(az)) AS mz FROM g1)"""


#: The same with a rational p.
_SGR = SG.replace(f"{_erfc('abs(ewz / sqrt(infl)) / sqrt(CAST(2 AS DOUBLE))')} AS pv", "1 / (1 + (ewz / sqrt(infl)) ** 2) AS pv")


@query(f"WITH {SG} SELECT event_id, round(cmz, 6) AS calibrated_mean_z, round(cdz, 6) AS calibrated_median_z, round(pv, 6) AS empirical_pvalue, round(qv, 6) AS empirical_qvalue, CAST(qv <= 0.25 OR mz >= 2.5 AS INT) AS keep_event FROM sg2")
def k4_event_significance(spark, sf):
    return r6(a.significant(spark, sf).select(*_SIG))


@query(f"WITH {_SGR} SELECT event_id, round(cmz, 6) AS calibrated_mean_z, round(cdz, 6) AS calibrated_median_z, round(pv, 6) AS empirical_pvalue, round(qv, 6) AS empirical_qvalue, CAST(qv <= 0.25 OR mz >= 2.5 AS INT) AS keep_event FROM sg2")
def k4_significance_rational(spark, sf):
    return r6(a.significant(spark, sf, lambda z: 1 / (1 + z * z)).select(*_SIG))


@query(f"WITH {SG} SELECT sample_id, n_null, round(null_median, 6) AS null_median, round(null_scale, 6) AS null_scale, count(event_id) AS n_events, CAST(coalesce(sum(CAST(qv <= 0.25 OR mz >= 2.5 AS INT)), 0) AS BIGINT) AS n_kept FROM nu LEFT JOIN sg2 USING (sample_id, n_null, null_median, null_scale) GROUP BY ALL")
def k5_calibration_summary(spark, sf):
    found, null, support = a.supported(*a.called(spark, sf))
    return r6(calibrate.calibration_summary(null, calibrate.event_significance(found, support, null)))


BL = f"""{SU}, bt AS (SELECT sample_id, count(*) FILTER (WHERE st = 'neutral' AND nul AND cls = 'clean') AS n1, count(*) FILTER (WHERE st = 'neutral' AND nul) AS n2, count(*) AS n3, median(x) FILTER (WHERE st = 'neutral' AND nul AND cls = 'clean') AS m1,
  median(x) FILTER (WHERE st = 'neutral' AND nul) AS m2, median(x) AS m3 FROM sc WHERE {AUTO} GROUP BY ALL), bl AS (SELECT sample_id, CASE WHEN n1 >= 200 THEN m1 WHEN n2 >= 200 THEN m2 ELSE m3 END AS baseline, CASE WHEN n1 >= 200 THEN n1 WHEN n2 >= 200 THEN n2 ELSE n3 END AS n_baseline FROM bt)"""


@query(f"WITH {BL} SELECT sample_id, round(baseline, 6) AS baseline, n_baseline FROM bl")
def f1_neutral_baseline(spark, sf):
    return r6(calibrate.neutral_baseline(a.called(spark, sf)[0]))


_FR = f"""{BL}, f0 AS (SELECT event_id, sum(x * greatest(cw, 0.1)) / sum(greatest(cw, 0.1)) AS m FROM eb GROUP BY ALL), f1 AS (SELECT event_id, max(m) AS m, sum(greatest(cw, 0.1) * (x - m) ** 2) / sum(greatest(cw, 0.1)) AS mm FROM eb JOIN f0 USING (event_id) GROUP BY ALL),
  f2 AS (SELECT ev.event_id, ev.chrom, ev.state, ess, f_clean, f_high, m, mm, baseline, CASE WHEN {AUTO.replace('chrom', 'ev.chrom')} AND baseline > 0 THEN greatest(round(m / baseline, 12), 1e-6) END AS r FROM ev JOIN f1 USING (event_id) JOIN su ON su.event_id = ev.event_id JOIN bl ON bl.sample_id = ev.sample_id),
  f3 AS (SELECT *, CASE WHEN NOT {AUTO} THEN 'non_autosomal_event' WHEN NOT coalesce(baseline > 0, false) THEN 'invalid_signal_baseline' WHEN ess < 1.5 THEN 'effective_bins_below_minimum' WHEN state = 'gain' AND r <= 1 THEN 'gain_without_ratio_shift' WHEN state = 'loss' AND r >= 1 THEN 'loss_without_ratio_shift' WHEN abs(log2(r)) < 0.03 THEN 'log2_ratio_below_minimum' END AS why,
    2 * abs(r - 1) AS pt, 3.92 * sqrt(mm) / sqrt(greatest(ess, 1)) / baseline AS h FROM f2),
  f4 AS (SELECT *, CASE WHEN why IS NULL THEN least(1.0, pt) END AS fp, CASE WHEN why IS NULL THEN least(1.0, greatest(0.0, pt - h)) END AS lo, CASE WHEN why IS NULL THEN least(1.0, greatest(0.0, pt + h)) END AS hi FROM f3),
  f5 AS (SELECT *, CASE WHEN why IS NOT NULL THEN 'not_estimated' WHEN fp < 0.15 THEN 'low_level_signal' WHEN f_clean < 0.5 OR f_high > 0.25 THEN 'estimated_low_confidence' ELSE 'estimated' END AS fstatus FROM f4)"""


def _fractions(spark, sf):
    bins, states = a.called(spark, sf)
    found, null = a.candidates(bins, states), calibrate.empirical_null(bins)
    support = calibrate.event_support(found, calibrate.calibrate_bins(bins, null), calibrate.null_autocorrelation(bins), a.OVERLAPS)
    return calibrate.abnormal_fraction(found.join(support, "event_id"), bins, calibrate.neutral_baseline(bins), least_effective=1.5)


@query(f"""WITH {_FR} SELECT event_id, round(r, 6) AS event_copy_ratio, round(fp, 6) AS fraction_point, round(lo, 6) AS fraction_ci_low, round(hi, 6) AS fraction_ci_high, fstatus AS fraction_status, coalesce(why, nullif(concat_ws(';', CASE WHEN f_clean < 0.5 THEN 'clean_support_below_threshold' END,
  CASE WHEN f_high > 0.25 THEN 'high_risk_fraction_above_threshold' END, CASE WHEN fp < 0.15 THEN 'fraction_below_low_level_threshold' END), ''), 'supported_autosomal_single_copy_model') AS fraction_reason FROM f5""")
def f2_abnormal_fraction(spark, sf):
    return r6(_fractions(spark, sf).select("event_id", "event_copy_ratio", "fraction_point", "fraction_ci_low", "fraction_ci_high", "fraction_status", "fraction_reason"))


@query(f"WITH {_FR} SELECT fstatus AS fraction_status, count(*) AS n_events, CAST(sum(CAST(fstatus = 'estimated' AS INT)) AS BIGINT) AS n_reliable FROM f5 GROUP BY ALL")
def f3_fraction_summary(spark, sf):
    return calibrate.fraction_summary(_fractions(spark, sf))


def _o(c: str) -> str:
    return f"{c}_overlap_fraction" if c in a.CLASSES else "0.0"


_MAXO = f"greatest({', '.join(a.OVERLAPS)})"
_SEX = "(chrom IN ('chrX', 'chrY'))"
# Names of flags and reasons.
_SQL_RULES = [  # flag, condition, effect: H hard, R review, - none; reason
    ("too_few_bins", "n_bins < 3", "H", "bin_count_below_minimum"), ("low_calibrated_signal", "mz < 2", "H", "signal_support_below_minimum"), ("broad_chrom_fraction", f"part > 0.35 AND {_SEX}", "R", "broad_sex_chromosome_event"),
    ("broad_chrom_fraction", f"part > 0.35 AND NOT {_SEX} AND broad", "R", "broad_event_preserved_by_internal_support"), ("broad_chrom_fraction", f"part > 0.35 AND NOT {_SEX} AND NOT broad", "H", "chromosome_fraction_too_large"),
    ("edge_event", "start_bin <= 2 OR 28 - end_bin - 1 <= 2", "R", "chromosome_edge_contact"), ("weak_empirical_support", "qv > 0.25", "R", "empirical_qvalue_above_threshold"), ("sex_chromosome_event", _SEX, "-", None),
    ("par_overlap", "par_bp > 0", "P", "par_overlap"), ("mixed_par_nonpar", "par_f > 0 AND par_f < 1", "R", "mixed_par_nonpar_boundary"), ("xx_chrY_unexpected_signal", "sex = 'XX' AND chrom = 'chrY'", "H", "xx_sample_with_chrY_signal"),
    (None, "sex = 'XY' AND chrom = 'chrY'", "R", "xy_chrY_default_review"), ("segmental_duplication_overlap", f"{_o('segmental_duplication')} >= 0.25 AND f_clean < 0.5", "H", "segmental_duplication_overlap_with_limited_clean_support"),
    ("segmental_duplication_overlap", f"{_o('segmental_duplication')} >= 0.25 AND f_clean >= 0.5", "R", "segmental_duplication_overlap"), ("low_mappability_overlap", f"{_o('low_mappability')} >= 0.25", "R", "low_mappability_overlap"), ("repeat_rich_overlap", f"{_o('repeat_rich')} >= 0.25", "R", "repeat_rich_overlap"),
    ("gap_centromere_telomere_overlap", f"{_o('gap_centromere_telomere')} > 0", "R", "gap_centromere_telomere_overlap"), ("blacklist_overlap", f"{_o('blacklist')} > 0", "H", "blacklist_region_overlap"), ("high_risk_region_burden", "f_high >= 0.5", "R", "high_risk_bin_fraction"),
    ("clean_support_low", "f_clean <= 0.2 AND f_high >= 0.5 AND mz < 4", "H", "clean_bin_support_too_low"), ("high_risk_boundary_crossing", "crossing = 1", "R", "high_risk_boundary_crossing"),
]
_list = lambda rows: "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{v}' END" for c, v in rows if v) + "], lambda x: x IS NOT NULL)"
_any = lambda kind: "(" + " OR ".join(f"({c})" for _, c, k, _ in _SQL_RULES if k == kind) + ")"
AR = f"""{SG}, a0 AS (SELECT *, CASE WHEN CAST(substr(sample_id, 2, 1) AS INT) % 2 = 0 THEN 'XX' ELSE 'XY' END AS sex, CASE WHEN {_SEX} THEN greatest(0, least(end_pos, 300000) - start_pos) ELSE 0 END AS par_bp, n_bins / 28.0 AS part, greatest(mz, abs(segment_mean_robust_z), abs(segment_median_robust_z), segment_abs_max_robust_z) AS sup FROM sg2),
  a1 AS (SELECT *, par_bp / (end_pos - start_pos) AS par_f, part > 0.35 AND sup >= 4 AND ess >= 10 AND f_clean >= 0.3 AND qv <= 0.25 AS broad, sup >= 4 AND f_clean + 0.5 * f_moderate >= 0.5 AND f_high < 0.2 AND {_MAXO} <= 0.15 AND rmax <= 0.35 AND qv <= 0.25 AS tidy,
    part <= 0.1 AND sup >= 6 AND f_clean + 0.5 * f_moderate >= 0.5 AND f_high <= 0.05 AND {_MAXO} <= 0.25 AND rmax <= 0.2 AND greatest({', '.join(c for c in a.OVERLAPS if not c.startswith('seg'))}) = 0 AND qv <= 0.25 AS focal FROM a0),
  a2 AS (SELECT *, list_filter([{', '.join(f"CASE WHEN {c} THEN '{f}' END" for f, c, _, _ in _SQL_RULES if f)}], lambda x: x IS NOT NULL) AS fl, {_list([(c, v) for _, c, k, v in _SQL_RULES if k in 'RP'])} AS dn, {_list([(c, v) for _, c, k, v in _SQL_RULES if k == 'H'])} AS fi, {_any('H')} AS hard0, {_any('R')} AS rev0,
    mz * ln(1 + greatest(ess, 1)) AS base FROM a1),
  a3 AS (SELECT *, base * greatest(f_clean, 0.1) * greatest(0.1, 1 - (0.6 * f_high + 0.25 * {_MAXO} + 0.2 * rmean + 0.1 * rmax)) * greatest(0, 1 - qv) AS prio FROM a2),
  a4 AS (SELECT *, NOT hard0 AND rev0 AND len(fl) = 1 AND fl[1] = 'edge_event' AND prio < 2 AS weak FROM a3), a5 AS (SELECT *, hard0 OR weak AS hard, (rev0 AND NOT weak) OR len(fl) > 0 AS held, mz >= 15 AND ess >= 8 AND qv <= 0.001 AS ultra FROM a4),
  a6 AS (SELECT *, CASE WHEN hard THEN 'artifact' WHEN held THEN 'review' WHEN ultra THEN 'pass' WHEN tidy OR focal THEN 'review' ELSE 'artifact' END AS artifact_status, NOT hard AND NOT held AND NOT ultra AS below FROM a5),
  ar AS (SELECT event_id, sample_id, n_bins, artifact_status, prio AS priority_score, prio - base AS priority_delta, CAST(artifact_status <> 'artifact' AS INT) AS keep_event, CASE artifact_status WHEN 'artifact' THEN 'rejected' WHEN 'pass' THEN 'high' ELSE CASE WHEN mz >= 4 THEN 'moderate' ELSE 'low' END END AS technical_confidence,
    CASE WHEN below THEN 'clean_event_below_ultra_pass' ELSE array_to_string(fl, ',') END AS artifact_flags, array_to_string(CASE WHEN below AND (tidy OR focal) THEN list_append(dn, CASE WHEN focal AND NOT tidy THEN 'focal_low_risk_event_preserved_below_ultra_pass' ELSE 'low_risk_event_preserved_below_ultra_pass' END) ELSE dn END, ';') AS downgrade_reason,
    array_to_string(CASE WHEN weak THEN list_append(fi, 'edge_event_priority_below_keep_threshold') WHEN below AND NOT (tidy OR focal) THEN list_append(fi, 'clean_event_below_ultra_pass_gate') ELSE fi END, ';') AS filter_reason FROM a6)"""


@query(f"WITH {AR} SELECT event_id, par_bp, round(par_f, 6) AS par_fraction FROM a1")
def a1_par_overlap(spark, sf):
    return r6(a.classified(spark, sf).select("event_id", "par_bp", "par_fraction"))


@query(f"WITH {AR} SELECT event_id, artifact_flags, downgrade_reason, filter_reason FROM ar")
def a2_artifact_flags(spark, sf):
    return a.classified(spark, sf).select("event_id", "artifact_flags", "downgrade_reason", "filter_reason")


def _sentence(rule: str) -> str:
    text = artifact.SAID[rule.removesuffix("_with_limited_clean_support")]
    share = {"par_overlap": "par_f", "high_risk_bin_fraction": "f_high"}.get(rule)
    return f"printf('{text.replace('{}', '%.1f%%')}', 100 * {share})" if share else f"'{text}'"


_LAST = "CASE WHEN weak THEN '{weak_edge}' WHEN below AND (tidy OR focal) THEN '{saved}' WHEN below THEN '{below}' WHEN artifact_status = 'pass' THEN '{pass}' END".format_map(artifact.SAID_LAST)


@query(f"WITH {AR} SELECT event_id, array_to_string(list_filter([{', '.join(f'CASE WHEN {c} THEN {_sentence(why or flag)} END' for flag, c, _, why in _SQL_RULES)}, {_LAST}], lambda x: x IS NOT NULL), ' ') AS artifact_explanations FROM a6")
def a2_artifact_explanations(spark, sf):
    return a.classified(spark, sf).select("event_id", "artifact_explanations")


@query(f"WITH {AR} SELECT event_id, round(priority_score, 6) AS priority_score, round(priority_delta, 6) AS priority_delta FROM ar")
def a3_priority_score(spark, sf):
    return r6(a.classified(spark, sf).select("event_id", "priority_score", "priority_delta"))


@query(f"WITH {AR} SELECT event_id, artifact_status, keep_event, technical_confidence FROM ar")
def a4_classify_events(spark, sf):
    return a.classified(spark, sf).select("event_id", "artifact_status", "keep_event", "technical_confidence")


@query(f"WITH {AR}, k AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY keep_event DESC, artifact_status, priority_score DESC, n_bins DESC, event_id) AS event_rank FROM ar) SELECT sample_id, event_id, event_rank FROM k WHERE event_rank <= 5")
def a5_rank_events(spark, sf):
    return artifact.rank_events(a.classified(spark, sf)).select("sample_id", "event_id", "event_rank")


@query(f"WITH {AR} SELECT sample_id, artifact_status, count(*) AS n_events, CAST(sum(keep_event) AS BIGINT) AS n_kept, round(max(priority_score), 6) AS top_priority FROM ar GROUP BY ALL")
def a6_artifact_summary(spark, sf):
    return r6(artifact.artifact_summary(a.classified(spark, sf)))
