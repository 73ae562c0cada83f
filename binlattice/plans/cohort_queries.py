"""Queries of trend correction and cohort selection; SQL where it can follow (it has no two-dimensional local fit)."""

from __future__ import annotations

from pyspark.sql import functions as F

from binlattice.operators import cohort, correction, qc
from binlattice.plans import adapters as a
from binlattice.plans.registry import _C1, ANN, AUTO, BINS, GRID, NORM, query, r6

ORDER = ["chrom_rank", "bin_index"]
LIMITS = {"min_reads": 100.0, "min_corr": 0.0, "max_recon_z": 3.5, "max_noise_z": 3.5}


def _gc_bins(spark, sf):
    return a.normalized(spark, sf).join(a.annotated(spark, sf).select("chrom", "bin_index", "gc_fraction"), ["chrom", "bin_index"])


_GC = f"{NORM}, {ANN[len(GRID) + 2:]}, gcb AS (SELECT norm.*, gc_fraction FROM norm JOIN ann USING (chrom, bin_index)), v AS (SELECT *, count(*) OVER (PARTITION BY sample_id) AS n, row_number() OVER (PARTITION BY sample_id ORDER BY gc_fraction, chrom_rank, bin_index) - 1 AS i FROM gcb WHERE gc_fraction IS NOT NULL)"
_WIN = "(least(n, greatest(0, i - CAST(greatest(3, ceil(0.2 * n)) AS BIGINT) // 2) + CAST(greatest(3, ceil(0.2 * n)) AS BIGINT)))"


def _local(source: str, out: str) -> str:
    return f"""{out}_p AS (SELECT a.sample_id, a.i, b.x AS y, b.gc_fraction - a.gc_fraction AS dx, b.r, max(abs(b.gc_fraction - a.gc_fraction)) OVER (PARTITION BY a.sample_id, a.i) AS reach
    FROM {source} a JOIN {source} b ON b.sample_id = a.sample_id AND b.i < a.hi AND b.i >= greatest(0, a.hi - CAST(greatest(3, ceil(0.2 * a.n)) AS BIGINT))),
  {out}_w AS (SELECT *, CASE WHEN reach > 0 THEN (1 - (abs(dx) / reach)**3)**3 * r ELSE 0 END AS w FROM {out}_p),
  {out}_s AS (SELECT *, sum(w) OVER g AS sw, sum(w * dx) OVER g / nullif(sum(w) OVER g, 0) AS mx, sum(w * y) OVER g / nullif(sum(w) OVER g, 0) AS my FROM {out}_w WINDOW g AS (PARTITION BY sample_id, i)),
  {out} AS (SELECT sample_id, i, CASE WHEN max(reach) <= 0 OR count(*) FILTER (WHERE w > 0) < 2 THEN avg(y) WHEN sum(w * (dx - mx)**2) <= 1e-14 * max(sw) THEN max(my) / (1 + max(mx)**2)
    ELSE max(my) - max(mx) * sum(w * (dx - mx) * y) / sum(w * (dx - mx)**2) END AS fit FROM {out}_s GROUP BY ALL)"""


_LOESS = f"""{_GC}, p0 AS (SELECT *, {_WIN} AS hi, 1.0 AS r FROM v), {_local('p0', 'f0')}, rs AS (SELECT p0.* EXCLUDE (r), x - fit AS res, median(abs(x - fit)) OVER (PARTITION BY sample_id) AS sc FROM p0 JOIN f0 USING (sample_id, i)),
  p1 AS (SELECT *, CASE WHEN sc > 0 THEN CASE WHEN abs(res) < 6 * sc THEN (1 - (res / (6 * sc))**2)**2 ELSE 0.0 END ELSE 1.0 END AS r FROM rs), {_local('p1', 'f1')}"""


@query(f"WITH {_LOESS} SELECT sample_id, chrom, bin_index, round(fit, 6) AS gc_trend FROM p1 JOIN f1 USING (sample_id, i)")
def g1_gc_loess(spark, sf):
    return r6(correction.gc_loess(_gc_bins(spark, sf), "normalized_signal", "gc_fraction", [*ORDER, "chrom"], ["sample_id"]).drop("chrom_rank"))


_POLY = f"""{_GC}, c AS (SELECT *, gc_fraction - avg(gc_fraction) OVER (PARTITION BY sample_id) AS u FROM v), s AS (SELECT sample_id, count(*) AS k, sum(u**2) AS s2, sum(u**3) AS s3, sum(u**4) AS s4, sum(x) AS t0, sum(u * x) AS t1, sum(u**2 * x) AS t2, median(x) AS md FROM c GROUP BY ALL),
  b AS (SELECT *, (t2 - s2 / k * t0 - s3 / s2 * t1) / (s4 - s2 * s2 / k - s3 * s3 / s2) AS c2 FROM s), q AS (SELECT c.*, md, (t0 - c2 * s2) / k + (t1 / s2 - c2 * s3 / s2) * u + c2 * u**2 AS tr FROM c JOIN b USING (sample_id))"""


@query(f"WITH {_POLY} SELECT sample_id, chrom, bin_index, round(tr, 6) AS gc_trend FROM q")
def g2_gc_poly(spark, sf):
    return r6(correction.gc_poly(_gc_bins(spark, sf), "normalized_signal", "gc_fraction", ["chrom", "bin_index"], ["sample_id"]))


@query(f"""WITH {_POLY} SELECT g.sample_id, g.chrom, g.bin_index, round(tr, 6) AS gc_trend, round(coalesce(g.x - tr + md, g.x), 6) AS signal_corrected, CAST(tr IS NOT NULL OR max(q.n) OVER (PARTITION BY g.sample_id) >= 100 AS INT) AS gc_correction_applied,
  coalesce(max(q.n) OVER (PARTITION BY g.sample_id), 0) AS gc_correction_valid_bins FROM gcb g LEFT JOIN q ON q.sample_id = g.sample_id AND q.chrom = g.chrom AND q.bin_index = g.bin_index""")
def g3_apply_gc_correction(spark, sf):
    out = correction.apply_gc_correction(_gc_bins(spark, sf), "normalized_signal", "gc_fraction", "poly2", ["chrom", "bin_index"], ["sample_id"], min_valid=100)
    return r6(out.select("sample_id", "chrom", "bin_index", "gc_trend", "signal_corrected", "gc_correction_applied", "gc_correction_valid_bins"))


def _corrected(spark, sf):
    """Corrected bins; all but hard ones may be fitted, since in these tables composition leaves hardly a bin fit by risk."""
    open_ = a.calling_bins(spark, sf).withColumn("correction_fit_eligible", (F.col("mask_label") != "hard").cast("int"))
    return correction.correct_signal_2d(open_, min_valid=100, labels=("pass", "soft", "dynamic"))


@query(None)
def g7_correct_signal_2d(spark, sf):
    return r6(_corrected(spark, sf).select("sample_id", "chrom", "bin_index", "correction_expected_signal", "correction_residual", "signal_for_calling", "correction_applied"))


_FIT = "NOT (blacklist_overlap_fraction > 0 OR gap_centromere_telomere_overlap_fraction > 0 OR cm >= 0.75 OR segmental_duplication_overlap_fraction >= 0.75 OR mask_label IN ('hard', 'dynamic'))"
_G8 = f"""{_C1}, fe AS (SELECT *, CAST({_FIT} AS INT) AS elig FROM c2) SELECT sample_id, count(*) FILTER (WHERE {AUTO} AND mask_label IN ('pass', 'soft') AND elig = 1 AND gc_fraction IS NOT NULL) AS valid_bin_count,
  CAST(sum(elig) AS BIGINT) AS fit_eligible_bin_count, count(*) FILTER (WHERE NOT hi AND NOT mo) AS n_clean, count(*) FILTER (WHERE mo AND NOT hi) AS n_moderate, count(*) FILTER (WHERE hi) AS n_high, round(median(x), 6) AS signal_median_before FROM norm JOIN fe USING (chrom, bin_index) GROUP BY ALL"""


@query(f"WITH {_G8}")
def g8_correction_summary(spark, sf):
    plain = a.calling_bins(spark, sf).withColumn("correction_applied", F.lit(0)).withColumn("signal_for_calling", F.col("normalized_signal"))
    return r6(correction.correction_summary(plain).drop("signal_median_after", "correction_status"))


def _checked(spark, sf):
    checks = [("zero_fraction", "max", 0.01, 0.5), ("mapped_fragments", "min", 3000, 200)]
    return qc.qc_decision(qc.uniformity_metrics(a.bins(spark, sf)), checks)


_U = f"{BINS}, u AS (SELECT sample_id, avg(CAST(raw_count = 0 AS INT)) AS zf, CAST(sum(raw_count) AS BIGINT) AS mf FROM bins GROUP BY ALL), dec AS (SELECT *, CASE WHEN zf > 0.5 OR mf < 200 THEN 'FAIL' WHEN zf > 0.01 OR mf < 3000 THEN 'WARN' ELSE 'PASS' END AS d FROM u)"


@query(f"WITH {_U} SELECT sample_id FROM dec WHERE d IN ('PASS', 'WARN')")
def r1_select_cohort(spark, sf):
    return cohort.select_cohort(_checked(spark, sf), ["pass", "Warn"])


_ALIGN = f"""{BINS}, use AS (SELECT * FROM bins WHERE sample_id IN (SELECT sample_id FROM bins GROUP BY sample_id HAVING sum(raw_count) > 0)), sh AS (SELECT chrom, min(last) AS last FROM (SELECT sample_id, chrom, max(bin_index) AS last FROM use WHERE {AUTO} GROUP BY ALL) GROUP BY chrom),
  al AS (SELECT s.sample_id, g.chrom, g.bin_index, CAST(coalesce(use.raw_count, 0) AS DOUBLE) AS c FROM (SELECT DISTINCT sample_id FROM use) s CROSS JOIN (SELECT chrom, i AS bin_index FROM sh, range(28) t(i) WHERE i <= last) g LEFT JOIN use ON use.sample_id = s.sample_id AND use.chrom = g.chrom AND use.bin_index = g.bin_index)"""
_SIG = f"{_ALIGN}, sg0 AS (SELECT *, ln(1 + c / sum(c) OVER (PARTITION BY sample_id) * 1e6) AS x FROM al)"


@query(f"WITH {_ALIGN} SELECT sample_id, chrom, bin_index, c AS raw_count FROM al")
def r2_align_matrix(spark, sf):
    return cohort.align_matrix(cohort.drop_unusable_samples(a.bins(spark, sf))[0])


@query(f"WITH {BINS} SELECT sample_id, CAST(sum(raw_count) AS BIGINT) AS total FROM bins GROUP BY ALL HAVING sum(raw_count) <= 0")
def r3_drop_unusable_samples(spark, sf):
    empty = cohort.drop_unusable_samples(a.bins(spark, sf))[1]
    return empty.withColumn("total", F.lit(0).cast("bigint"))


def _signal(spark, sf):
    """The matrix of the cohort, written once: its users read it many times."""
    return a.stored(cohort.with_signal(cohort.align_matrix(cohort.drop_unusable_samples(a.bins(spark, sf))[0])))


#: Squarings after which the products of a table are the projector on their greatest component, if it stands out at all.
SQUARINGS = 45


def _standard(rows: str, keys: str, chosen: str) -> str:
    """x of ``rows`` standardised within ``keys`` over the rows that are ``chosen``."""
    over = f"FILTER (WHERE {chosen}) OVER (PARTITION BY {keys})"
    return f"SELECT *, (x - avg(x) {over}) / CASE WHEN stddev_pop(x) {over} > 1e-12 THEN stddev_pop(x) {over} ELSE 1 END AS z FROM {rows}"


def _powers(source: str, most: int) -> str:
    """CTE comps (turn, comp, p, lam, g): the ``most`` greatest components of each symmetric list of lists g of ``source`` (turn, g).

    The matrix is squared and scaled until it is the projector p on one component, of eigenvalue lam, which is then taken off:
    g is what is left.
    """
    trace = lambda m: f"list_sum(list_transform(range(1, len({m}) + 1), lambda i: {m}[i][i]))"
    return f"""pw AS (SELECT turn, 0 AS comp, 0 AS step, g, g AS m, CAST(NULL AS DOUBLE[][]) AS p, CAST(0 AS DOUBLE) AS lam FROM {source}
    UNION ALL SELECT turn, CAST(comp + done AS INT), CASE WHEN done = 1 THEN 0 ELSE step + 1 END, g2, CASE WHEN done = 1 THEN g2 ELSE list_transform(sq, lambda r: list_transform(r, lambda v: v / {trace('sq')})) END, CASE WHEN done = 1 THEN m END, lam2
    FROM (SELECT *, CASE WHEN done = 1 THEN list_transform(range(1, len(g) + 1), lambda i: list_transform(range(1, len(g) + 1), lambda j: g[i][j] - lam2 * m[i][j])) ELSE g END AS g2
      FROM (SELECT turn, comp, step, g, m, CAST(step = {SQUARINGS} AS INT) AS done, list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c))) AS sq, list_sum(list_transform(range(1, len(g) + 1), lambda i: list_dot_product(m[i], g[i]))) AS lam2
        FROM pw WHERE comp < {most}))),
  comps AS (SELECT turn, comp, p, lam, g FROM pw WHERE comp > 0 AND step = 0)"""


_PCA = f"""{_SIG}, zs AS ({_standard('sg0', 'chrom, bin_index', 'true')}), pr AS (SELECT a.sample_id AS i, b.sample_id AS j, sum(a.z * b.z) AS v, count(*) AS n FROM zs a JOIN zs b USING (chrom, bin_index) GROUP BY ALL),
  gm AS (SELECT 0 AS turn, list(v ORDER BY i) AS g, max(n) AS n FROM (SELECT i, list(v ORDER BY j) AS v, max(n) AS n FROM pr GROUP BY i)), tr AS (SELECT sum(v) AS total FROM pr WHERE i = j)"""


@query(f"WITH {_PCA}, {_powers('gm', 6)}, ex AS (SELECT comp AS component, lam / total AS e FROM comps, tr) SELECT component, round(e, 6) AS explained, round(sum(e) OVER (ORDER BY component), 6) AS cumulative FROM ex")
def r4_pca_profile(spark, sf):
    return r6(cohort.pca_profile(_signal(spark, sf), 6))


def _shares(spark, sf):
    """A falling series of shares, one a chromosome, as a profile."""
    share = a.bins(spark, sf).groupBy("chrom_rank").agg(F.sum("raw_count").alias("n"))
    rows = share.selectExpr("CAST(row_number() OVER (ORDER BY n DESC, chrom_rank) AS INT) AS component", "n / sum(n) OVER () AS explained")
    return rows.selectExpr("component", "explained", "sum(explained) OVER (ORDER BY component) AS cumulative")


_SH = f"""{BINS}, sh AS (SELECT row_number() OVER (ORDER BY sum(raw_count) DESC, chrom_rank) AS k, sum(raw_count) / sum(sum(raw_count)) OVER () AS e FROM bins GROUP BY chrom_rank), pf AS (SELECT k, e, sum(e) OVER (ORDER BY k) AS c FROM sh),
  en AS (SELECT min(k) AS x1, max(k) AS x2, min(c) AS y1, max(c) AS y2 FROM pf), el AS (SELECT CAST(k AS INT) AS elbow FROM pf, en ORDER BY round(abs((y2 - y1) * k - (x2 - x1) * c + x2 * y1 - y2 * x1) / sqrt((y2 - y1)**2 + (x2 - x1)**2), 12) DESC, k LIMIT 1)"""


@query(f"WITH {_SH} SELECT elbow FROM el")
def r5_elbow_component(spark, sf):
    return cohort.elbow_component(_shares(spark, sf))


@query(f"WITH {_SH} SELECT elbow, CAST(least(24, greatest(elbow, 4, (SELECT min(k) FROM pf WHERE c >= 0.6))) AS INT) AS selected FROM el")
def r6_choose_components(spark, sf):
    return cohort.choose_components(_shares(spark, sf), 4, 0.6)


@query(f"""WITH {_SIG}, m AS (SELECT *, median(x) OVER (PARTITION BY chrom, bin_index) AS m FROM sg0), r AS (SELECT *, median(x - m) OVER (PARTITION BY sample_id) AS rm FROM m)
  SELECT sample_id, sum(c) AS reads, round(CASE WHEN stddev_pop(x) > 1e-12 AND stddev_pop(m) > 1e-12 THEN corr(x, m) ELSE 0 END, 6) AS corr_to_median, round(median(abs(x - m - rm)), 6) AS noise_mad FROM r GROUP BY ALL""")
def r7_profile_distance(spark, sf):
    return r6(cohort.profile_distance(_signal(spark, sf)))


_DISTANCE = """md AS (SELECT *, median(x) OVER (PARTITION BY chrom, bin_index) AS m FROM sg0), rs AS (SELECT *, median(x - m) OVER (PARTITION BY sample_id) AS rm FROM md),
  ds AS (SELECT sample_id, sum(c) AS reads, CASE WHEN stddev_pop(x) > 1e-12 AND stddev_pop(m) > 1e-12 THEN corr(x, m) ELSE 0 END AS corr_to_median, median(abs(x - m - rm)) AS noise_mad FROM rs GROUP BY ALL)"""
_STRICT = lambda c: f"CASE WHEN {c}_s > 0 THEN ({c} - {c}_m) / {c}_s ELSE 0 END"


@query(f"""WITH {_PCA}, {_powers('gm', 2)}, {_DISTANCE}, ix AS (SELECT sample_id, row_number() OVER (ORDER BY sample_id) AS i FROM (SELECT DISTINCT sample_id FROM sg0)),
  er AS (SELECT ds.*, greatest(comps.g[i][i], 0) / n AS reconstruction_error FROM ds JOIN ix USING (sample_id), comps, gm WHERE comp = 2),
  mm AS (SELECT *, median(reconstruction_error) OVER () AS reconstruction_error_m, median(noise_mad) OVER () AS noise_mad_m FROM er),
  ss AS (SELECT *, 1.4826 * median(abs(reconstruction_error - reconstruction_error_m)) OVER () AS reconstruction_error_s, 1.4826 * median(abs(noise_mad - noise_mad_m)) OVER () AS noise_mad_s FROM mm)
  SELECT sample_id, reads, round(corr_to_median, 6) AS corr_to_median, round(noise_mad, 6) AS noise_mad, round(reconstruction_error, 6) AS reconstruction_error, round({_STRICT('reconstruction_error')}, 6) AS reconstruction_error_z, round({_STRICT('noise_mad')}, 6) AS noise_mad_z FROM ss""")
def r7_cohort_sample_metrics(spark, sf):
    return r6(cohort.cohort_sample_metrics(_signal(spark, sf), 2))


@query(f"""WITH {_U}, z AS (SELECT sample_id, mf AS reads, 1 - zf AS corr_to_median, zf * 100 AS reconstruction_error_z, zf * 50 AS noise_mad_z FROM dec)
  SELECT sample_id, CAST(reads < 740 OR corr_to_median < 0.6 OR reconstruction_error_z > 35 OR noise_mad_z > 20 AS INT) AS is_outlier, CASE WHEN reads < 740 OR corr_to_median < 0.6 OR reconstruction_error_z > 35 OR noise_mad_z > 20 THEN
  concat_ws(',', CASE WHEN reads < 740 THEN 'low_reads' END, CASE WHEN corr_to_median < 0.6 THEN 'low_corr' END, CASE WHEN reconstruction_error_z > 35 THEN 'high_recon_z' END, CASE WHEN noise_mad_z > 20 THEN 'high_noise_z' END) ELSE 'PASS' END AS reasons FROM z""")
def r8_label_outliers(spark, sf):
    rows = qc.uniformity_metrics(a.bins(spark, sf)).selectExpr("sample_id", "mapped_fragments AS reads", "1 - zero_fraction AS corr_to_median", "zero_fraction * 100 AS reconstruction_error_z", "zero_fraction * 50 AS noise_mad_z")
    return cohort.label_outliers(rows, 740, 0.6, 35, 20).select("sample_id", "is_outlier", "reasons")


@query(None)
def r9_iterative_prefilter(spark, sf):
    return r6(cohort.iterative_prefilter(_signal(spark, sf), min_samples=4, **LIMITS))


@query(f"WITH {BINS} SELECT DISTINCT sample_id FROM bins WHERE chrom = 'chrY' AND raw_count > 0 OR chrom = 'chrX' AND raw_count > 3")
def r10_merge_inliers(spark, sf):
    bins = a.bins(spark, sf)
    return cohort.merge_inliers(bins.where("chrom = 'chrY' AND raw_count > 0"), bins.where("chrom = 'chrX' AND raw_count > 3"))


_FOLDS = f"""{_SIG}, fo AS (SELECT sample_id, (row_number() OVER (ORDER BY md5('0:' || sample_id), sample_id) - 1) % 5 AS fold FROM (SELECT DISTINCT sample_id FROM sg0)),
  ff AS (SELECT sg0.*, k.fold AS turn, fo.fold <> k.fold AS fit FROM sg0 JOIN fo USING (sample_id), (SELECT DISTINCT fold FROM fo) k), zs AS ({_standard('ff', 'turn, chrom, bin_index', 'fit')}),
  pr AS (SELECT a.turn, a.sample_id AS i, b.sample_id AS j, a.fit AS fi, b.fit AS fj, sum(a.z * b.z) AS v, count(*) AS n FROM zs a JOIN zs b USING (turn, chrom, bin_index) GROUP BY ALL),
  gm AS (SELECT turn, list(v ORDER BY i) AS g FROM (SELECT turn, i, list(v ORDER BY j) AS v FROM pr WHERE fi AND fj GROUP BY turn, i) GROUP BY turn), {_powers('gm', 3)},
  te AS (SELECT turn, i, list(v ORDER BY j) FILTER (WHERE fj) AS t, max(v) FILTER (WHERE i = j) AS own, max(n) AS n FROM pr WHERE NOT fi GROUP BY turn, i),
  le AS (SELECT turn, i, comp, own, n, list_dot_product(t, list_transform(p, lambda r: list_dot_product(r, t))) / lam AS got FROM te JOIN comps USING (turn)),
  cu AS (SELECT turn, i, comp, (own - sum(got) OVER (PARTITION BY turn, i ORDER BY comp)) / n AS e FROM le)"""


@query(f"WITH {_FOLDS} SELECT comp AS pca_components, round(avg(e), 6) AS cv_mse FROM (SELECT turn, comp, avg(e) AS e FROM cu GROUP BY ALL) GROUP BY ALL")
def r11_cross_validation(spark, sf):
    found = cohort.cv_reconstruction_mse(_signal(spark, sf), [1, 2, 3])
    return r6(spark.createDataFrame(list(found.items()), "pca_components int, cv_mse double"))


def _pooled(counted, by: int):
    """Counts in bins ``by`` times as long."""
    wide = counted.withColumn("bin_index", F.floor(F.col("bin_index") / by).cast("bigint"))
    return wide.groupBy("sample_id", "chrom", "bin_index").agg(F.sum("raw_count").alias("raw_count"))


@query(None)
def r12_tuning_grid(spark, sf):
    counted = a.bins(spark, sf)
    signals = {a.BIN * by: a.stored(cohort.with_signal(cohort.align_matrix(_pooled(counted, by), 50))) for by in (1, 4)}
    return r6(cohort.tuning_grid(signals, min_samples=4, max_components=4, max_outlier_fraction=0.5, **LIMITS))


@query("""WITH g AS (SELECT CAST(l_suppkey % 5 + 1 AS BIGINT) * 100000 AS bin_size, CAST(l_linenumber AS INT) AS pca_components, CAST(l_linenumber = 3 AS INT) AS is_selected_pca, count(*) AS inliers, round(avg(CAST(l_discount AS DOUBLE)), 9) AS outlier_fraction,
  CASE WHEN min(l_orderkey) % 4 > 0 THEN round(avg(CAST(l_tax AS DOUBLE)), 9) END AS cv_mse, CASE WHEN min(l_orderkey) % 3 = 0 THEN 'FAIL_CV' ELSE 'PASS' END AS status FROM lineitem GROUP BY l_suppkey % 5, l_linenumber),
  o AS (SELECT *, status = 'PASS' AND cv_mse IS NOT NULL AS ok FROM g), b AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY bin_size ORDER BY ok DESC, is_selected_pca DESC, CASE WHEN ok THEN -inliers END, CASE WHEN ok THEN outlier_fraction END, CASE WHEN ok THEN cv_mse END, CASE WHEN NOT ok THEN status END, pca_components) = 1),
  k AS (SELECT *, CASE WHEN ok THEN row_number() OVER (PARTITION BY ok ORDER BY inliers DESC, outlier_fraction, cv_mse, bin_size) ELSE 0 END AS r FROM b) SELECT bin_size, pca_components, status, inliers, CAST(r AS INT) AS selection_rank, CAST(r = 1 AS INT) AS is_best_binsize FROM k""")
def r13_rank_bin_sizes(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy(((F.col("l_suppkey") % 5 + 1).cast("bigint") * 100000).alias("bin_size"), F.col("l_linenumber").cast("int").alias("pca_components")).agg(
        F.count("*").alias("inliers"), F.round(F.avg(F.col("l_discount").cast("double")), 9).alias("outlier_fraction"), F.round(F.avg(F.col("l_tax").cast("double")), 9).alias("mse"), F.min("l_orderkey").alias("k")
    )
    grid = rows.selectExpr("*", "CAST(pca_components = 3 AS INT) AS is_selected_pca", "CASE WHEN k % 4 > 0 THEN mse END AS cv_mse", "CASE WHEN k % 3 = 0 THEN 'FAIL_CV' ELSE 'PASS' END AS status")
    return cohort.rank_bin_sizes(grid).select("bin_size", "pca_components", "status", "inliers", "selection_rank", "is_best_binsize")


def _digested(group: str, table: str, columns: dict[str, str]) -> str:
    text = ", ".join(f"'{name}=' || {form}" for name, form in sorted(columns.items()))
    lanes = " || '-' || ".join(f"CAST(coalesce(sum(CAST('0x' || substr(m, {at}, 15) AS BIGINT)), 0) AS VARCHAR)" for at in (1, 16))
    return f"SELECT '{group}' AS \"group\", '{table}' AS name, count(*) AS n_rows, {lanes} AS digest FROM (SELECT md5(concat_ws(chr(10), {text})) AS m FROM {table})"


_TABLES = [
    ("geo", "region", {"r_regionkey": "r_regionkey", "r_name": "r_name"}),
    ("geo", "nation", {"n_nationkey": "n_nationkey", "n_name": "n_name", "n_regionkey": "n_regionkey"}),
    ("sales", "orders", {c: c for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")} | {"o_totalprice": "printf('%.6f', o_totalprice)", "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"}),
]


@query(f"""WITH t AS ({' UNION ALL '.join(_digested(*t) for t in _TABLES)}) SELECT "group", name, n_rows, digest, CAST(count(*) OVER (PARTITION BY "group") AS INT) AS n_tables FROM t""")
def r17_snapshot_inventory(spark, sf):
    read = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    return cohort.snapshot_inventory({"geo": {n: read(n) for n in ("region", "nation")}, "sales": {"orders": read("orders")}})
