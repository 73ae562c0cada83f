"""The registered queries of the library's operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from binlattice.functions import stats
from binlattice.operators import evaluate, grid, qc
from binlattice.plans import adapters as a

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql.replace("WITH ", "WITH RECURSIVE ", 1) if sql.startswith("WITH ") else sql
        return f

    return put


def r6(df: DataFrame) -> DataFrame:
    """Doubles to 6 decimals, as in the SQL; booleans as integers."""
    kind = dict(df.dtypes)
    col = lambda c: F.round(F.col(c), 6).alias(c) if kind[c] == "double" else F.col(c).cast("int").alias(c) if kind[c] == "boolean" else F.col(c)
    return df.select(*[col(c) for c in df.columns])


_CH = "('chr' || CASE {0} WHEN 22 THEN 'X' WHEN 23 THEN 'Y' ELSE CAST({0} + 1 AS VARCHAR) END)"
ALN = f"""aln AS (SELECT 'S' || CAST(l_suppkey % 8 AS VARCHAR) AS sample_id, {_CH.format('(l_partkey % 24)')} AS chrom,
  {a._position("date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))")} AS pos, CAST(l_quantity + 5 AS INT) AS mapq,
  (l_returnflag = 'R' AND l_linestatus = 'O') AS dup, l_linenumber = 7 OR (l_linenumber = 5 AND l_linestatus = 'F') AS sec, l_tax > 0.07 AND l_quantity < 20 AS lost, l_discount > 0.09 AS bad, l_linenumber % 4 = 0 AS paired, l_tax < 0.05 AS read1 FROM lineitem)"""
GRID = f"grid AS (SELECT {_CH.format('c')} AS chrom, c + 1 AS chrom_rank, i AS bin_index, i * 90000 AS start_pos, (i + 1) * 90000 AS end_pos FROM range(24) t(c), range(28) u(i))"
BINS = f"""{ALN}, {GRID}, bins AS (SELECT s.sample_id, g.*, coalesce(n, 0) AS raw_count FROM (SELECT DISTINCT sample_id FROM aln) s CROSS JOIN grid g
  LEFT JOIN (SELECT sample_id, chrom, pos // 90000 AS bin_index, count(*) AS n FROM aln WHERE NOT (dup OR sec OR bad OR lost) AND mapq >= 10 AND (NOT paired OR read1) AND pos >= 0 GROUP BY ALL) c
  ON c.sample_id = s.sample_id AND c.chrom = g.chrom AND c.bin_index = g.bin_index)"""
NORM = f"{BINS}, norm AS (SELECT *, ln(1 + raw_count / CASE WHEN sum(raw_count) OVER (PARTITION BY sample_id) <= 0 THEN 1 ELSE sum(raw_count) OVER (PARTITION BY sample_id) END * 1e6) AS x, sqrt(greatest(raw_count, 1)) AS w FROM bins)"


def _robust(rel: str, keys: str, out: str, strict: bool = False) -> str:
    fallback = "0" if strict else "sd"
    return f"""{out}_m AS (SELECT *, median(x) OVER (PARTITION BY {keys}) AS m, stddev_pop(x) OVER (PARTITION BY {keys}) AS sd FROM {rel}),
  {out}_d AS (SELECT *, 1.4826 * median(abs(x - m)) OVER (PARTITION BY {keys}) AS md FROM {out}_m),
  {out} AS (SELECT *, CASE WHEN md > 0 THEN (x - m) / md WHEN {fallback} > 0 THEN (x - m) / {fallback} ELSE 0.0 END AS z FROM {out}_d)"""


SCORED = f"{NORM}, {_robust('norm', 'sample_id, chrom', 'scored')}"
EVENTS = f"""{SCORED}, lab AS (SELECT *, CASE WHEN z >= 1 THEN 'gain' WHEN z <= -1 THEN 'loss' END AS state, row_number() OVER (PARTITION BY sample_id, chrom ORDER BY bin_index) AS i FROM scored),
  isl AS (SELECT *, i - row_number() OVER (PARTITION BY sample_id, chrom, state ORDER BY bin_index) AS run FROM lab WHERE state IS NOT NULL),
  ev AS (SELECT sample_id || '_' || chrom || '_' || CAST(min(bin_index) AS VARCHAR) AS event_id, sample_id, chrom, state, min(bin_index) AS start_bin, max(bin_index) AS end_bin, min(start_pos) AS start_pos,
         max(end_pos) AS end_pos, count(*) AS n_bins, avg(z) AS mean_z, median(z) AS median_z, max(abs(z)) AS max_abs_z FROM isl GROUP BY sample_id, chrom, state, run HAVING count(*) >= 2)"""
IVS = f"""iv AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'segmental_duplication' WHEN '2-HIGH' THEN 'low_mappability' WHEN '3-MEDIUM' THEN 'repeat_rich' WHEN '4-NOT SPECIFIED' THEN 'gap_centromere_telomere' ELSE 'blacklist' END AS k,
  {_CH.format('(o_custkey % 24)')} AS chrom, ({a._PLACE}) * 90000 + (o_orderkey * 37) % 85000 AS s, ({a._PLACE}) * 90000 + (o_orderkey * 37) % 85000 + (o_orderkey % 5 + 1) * 100 AS e FROM orders)"""
COMP = f"""{GRID}, ch AS (SELECT {_CH.format('(doc_id % 24)')} AS chrom, ((doc_id // 24) % 28) * 90000 AS cs, upper(text) AS seq FROM documents),
  pc AS (SELECT g.chrom, g.bin_index, substr(seq, CAST(greatest(0, start_pos - cs) + 1 AS BIGINT), CAST(least(end_pos, cs + length(seq)) - greatest(start_pos, cs) AS BIGINT)) AS p FROM ch JOIN grid g ON ch.chrom = g.chrom AND cs < end_pos AND cs + length(seq) > start_pos),
  cnt AS (SELECT chrom, bin_index, {', '.join(f"sum(length(p) - length(replace(p, '{b}', ''))) AS n_{b.lower()}" for b in 'ACGTN')} FROM pc GROUP BY ALL),
  comp AS (SELECT g.chrom, g.bin_index, g.start_pos, g.end_pos, {', '.join(f"CAST(coalesce(n_{b}, 0) AS BIGINT) AS n_{b}" for b in 'acgtn')} FROM grid g LEFT JOIN cnt c ON c.chrom = g.chrom AND c.bin_index = g.bin_index)"""
FRAC = ", ".join(f"least(coalesce(sum(least(end_pos, e) - greatest(start_pos, s)) FILTER (WHERE k = '{c}'), 0) / 90000.0, 1.0) AS {c}_overlap_fraction" for c in a.CLASSES)
FRACS = f"{IVS}, fr AS (SELECT g.chrom, g.bin_index, g.start_pos, g.end_pos, {FRAC} FROM grid g LEFT JOIN iv ON iv.chrom = g.chrom AND s < end_pos AND e > start_pos GROUP BY ALL)"
ANN = f"""{COMP}, {FRACS}, ann AS (SELECT comp.*, {', '.join(f'{c}_overlap_fraction' for c in a.CLASSES)}, {a.GC_SHARE.replace('D ', ' ')} AS gc_fraction, {a.N_SHARE.replace('D ', ' ')} AS n_fraction, {a.MAPPABLE.replace('D ', ' ')} AS atgc
  FROM comp JOIN fr USING (chrom, bin_index))"""
RUNS = "runs AS (SELECT event_id, event_type AS rule_name, CAST(user_id % 4 AS INT) AS threads, value AS wall_seconds, CASE event_type WHEN 'error' THEN 'log_failed' ELSE 'success' END AS status, ts AS created_at, user_id, CASE user_id % 3 WHEN 0 THEN 'qc' ELSE 'predict' END AS module, CASE WHEN user_id % 5 = 0 THEN '1' ELSE '2-8' END AS sample_bucket, CAST(event_id % 2 * 500000 + 500000 AS BIGINT) AS binsize, CASE WHEN event_id % 3 > 0 THEN CAST(event_id % 3 AS INT) END AS pca_components FROM events)"
TRUTH = f"""truth AS (SELECT c_custkey AS truth_id, 'S' || CAST(c_custkey % 8 AS VARCHAR) AS sample_id, {_CH.format('(c_nationkey % 24)')} AS chrom, CASE WHEN c_custkey % 2 = 0 THEN 'gain' ELSE 'loss' END AS state,
  CASE WHEN c_custkey % 3 > 0 THEN (c_custkey % 28) * 90000 END AS t_start, CASE WHEN c_custkey % 3 > 0 THEN (c_custkey % 28) * 90000 + 500000 END AS t_end, CASE WHEN c_custkey % 5 > 0 THEN (c_custkey % 60) / 100.0 END AS fraction FROM customer)"""
AUTO = "regexp_matches(chrom, '^chr([1-9]|1[0-9]|2[0-2])$')"


@query(f"WITH {BINS} SELECT sample_id, chrom, bin_index, start_pos, end_pos, raw_count FROM bins")
def s2_count_fragments(spark, sf):
    return a.bins(spark, sf).drop("chrom_rank")


@query(f"WITH {NORM} SELECT sample_id, chrom, bin_index, round(x, 6) AS normalized_signal, round(w, 6) AS bin_weight FROM norm")
def n1_log1p_cpm(spark, sf):
    return r6(a.normalized(spark, sf).select("sample_id", "chrom", "bin_index", "normalized_signal", "bin_weight"))


@query(f"WITH {BINS} SELECT sample_id, chrom, bin_index, round(log2(raw_count / sum(raw_count) OVER (PARTITION BY sample_id) * 1e6 + 1), 6) AS signal_log2cpm FROM bins")
def n2_log2_cpm(spark, sf):
    return r6(stats.normalize_log2_cpm(a.bins(spark, sf), ["sample_id"]).select("sample_id", "chrom", "bin_index", "signal_log2cpm"))


@query(f"WITH {SCORED} SELECT sample_id, chrom, bin_index, round(z, 6) AS robust_z FROM scored")
def n3_robust_z(spark, sf):
    return r6(a.scored(spark, sf).select("sample_id", "chrom", "bin_index", "robust_z"))


@query(f"WITH {NORM}, {_robust('norm', 'sample_id, chrom', 'scored', True)} SELECT sample_id, chrom, bin_index, round(z, 6) AS robust_z FROM scored")
def n4_robust_z_strict(spark, sf):
    return r6(stats.robust_z(a.normalized(spark, sf), "normalized_signal", ["sample_id", "chrom"], strict=True).select("sample_id", "chrom", "bin_index", "robust_z"))


@query(f"WITH {SCORED} SELECT sample_id, chrom, round(max(m), 6) AS center, round(greatest(max(md), max(sd), 1e-6), 6) AS scale FROM scored GROUP BY ALL")
def n5_center_scale(spark, sf):
    return r6(stats.robust_center_scale(a.normalized(spark, sf), "normalized_signal", ["sample_id", "chrom"]))


@query(f"""WITH {NORM}, wm AS (SELECT sample_id, chrom, sum(w * x) / sum(w) AS m FROM norm GROUP BY ALL) SELECT sample_id, chrom, round(max(m), 6) AS weighted_mean, round(sqrt(sum(w * (x - m) ** 2) / sum(w)), 6) AS weighted_std,
  round(sum(w)*sum(w)/sum(w*w), 6) AS effective_sample_size, round(sum(w*x)/sqrt(sum(w*w)), 6) AS stouffer_z FROM norm JOIN wm USING (sample_id, chrom) GROUP BY ALL""")
def n6_weighted_stats(spark, sf):
    return r6(stats.weighted_stats(a.normalized(spark, sf), "normalized_signal", "bin_weight", ["sample_id", "chrom"]))


_RHO = f"""{NORM}, cen AS (SELECT *, x - avg(x) OVER (PARTITION BY sample_id, chrom) AS d, count(*) OVER (PARTITION BY sample_id, chrom) AS n FROM norm),
  lags AS (SELECT *, k AS lag_no, d * lag(d, CAST(k AS INT)) OVER (PARTITION BY sample_id, chrom, k ORDER BY bin_index) AS dd FROM cen, range(1, 6) t(k)),
  per AS (SELECT sample_id, chrom, lag_no, n, sum(dd) AS dd, avg(d * d) AS v FROM lags GROUP BY ALL),
  rho AS (SELECT sample_id, CAST(lag_no AS INT) AS lag, greatest(-0.95, least(0.95, avg(dd / ((n - lag_no) * v)))) AS rho FROM per WHERE n >= 3 AND v > 1e-20 AND n > lag_no GROUP BY sample_id, lag_no)"""


@query(f"WITH {_RHO} SELECT sample_id, lag, round(rho, 6) AS rho FROM rho")
def n9_autocorrelation(spark, sf):
    return r6(stats.autocorrelation(a.normalized(spark, sf), "normalized_signal", ["sample_id"], "chrom", "bin_index"))


@query(f"WITH {_RHO} SELECT sample_id, round(greatest(1.0, 1 + 2 * sum(rho * (1 - lag / 28.0))), 6) AS inflation FROM rho GROUP BY ALL")
def n10_autocorr_inflation(spark, sf):
    rho = stats.autocorrelation(a.normalized(spark, sf), "normalized_signal", ["sample_id"], "chrom", "bin_index")
    return r6(stats.autocorr_inflation(rho, ["sample_id"], 28))


_PV = f"{EVENTS}, pv AS (SELECT *, round(1 / (1 + max_abs_z * n_bins), 6) AS p FROM ev)"
_QV = f"""{_PV}, rk AS (SELECT *, p * count(*) OVER (PARTITION BY sample_id) / row_number() OVER (PARTITION BY sample_id ORDER BY p, event_id) AS q0, row_number() OVER (PARTITION BY sample_id ORDER BY p, event_id) AS r FROM pv),
  qv AS (SELECT *, least(1.0, min(q0) OVER (PARTITION BY sample_id ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS q_value FROM rk)"""


def _with_q(spark, sf):
    p = F.round(1 / (1 + F.col("max_abs_z") * F.col("n_bins")), 6)
    return stats.benjamini_hochberg(a.events(spark, sf).withColumn("p", p), "p", ["sample_id"], ["event_id"])


@query(f"WITH {_QV} SELECT event_id, p, round(q_value, 6) AS q_value FROM qv")
def n11_benjamini_hochberg(spark, sf):
    return r6(_with_q(spark, sf).select("event_id", "p", "q_value"))


_GINI = "SELECT sample_id, CASE WHEN sum(x) > 0 THEN 2 * sum(i * x) / (count(*) * sum(x)) - (count(*) + 1) / count(*) ELSE 0 END AS gini FROM (SELECT sample_id, raw_count AS x, row_number() OVER (PARTITION BY sample_id ORDER BY raw_count) AS i FROM bins) GROUP BY ALL"


@query(f"WITH {BINS} SELECT sample_id, round(gini, 6) AS gini FROM ({_GINI})")
def n12_gini(spark, sf):
    return r6(stats.gini(a.bins(spark, sf), "raw_count", ["sample_id"]))


@query(f"WITH {BINS}, m AS (SELECT *, median(raw_count) OVER (PARTITION BY sample_id) AS m FROM bins) SELECT sample_id, round(median(abs(raw_count - m)), 6) AS mad FROM m GROUP BY ALL")
def n13_mad(spark, sf):
    return r6(stats.mad(a.bins(spark, sf), "raw_count", ["sample_id"]))


@query(f"WITH {BINS} SELECT sample_id, round(quantile_cont(CAST(raw_count AS DOUBLE), 0.8), 6) AS percentile FROM bins GROUP BY ALL")
def n14_linear_percentile(spark, sf):
    return r6(stats.linear_percentile(a.bins(spark, sf), "raw_count", 0.8, ["sample_id"]))


def _erfc(x: str) -> str:
    """The rational fit of erfc for x >= 0, as in stats.two_sided_p."""
    t = f"(1 / (1 + ({x}) / 2))"
    fit = repr(stats.ERFC[-1])
    for c in reversed(stats.ERFC[:-1]):
        fit = f"({c!r} + {t} * {fit})"
    return f"least(1.0, {t} * exp({fit} - ({x}) * ({x})))"


@query(f"WITH {SCORED}, t AS (SELECT sample_id, chrom, bin_index, abs(coalesce(z, 0.0)) / sqrt(CAST(2 AS DOUBLE)) AS y FROM scored) SELECT sample_id, chrom, bin_index, round({_erfc('y')}, 6) AS p_value FROM t")
def n15_two_sided_p(spark, sf):
    return r6(a.scored(spark, sf).select("sample_id", "chrom", "bin_index", stats.two_sided_p("robust_z").alias("p_value")))


@query(f"""WITH {NORM}, {COMP[len(GRID) + 2:]}, j AS (SELECT n.sample_id, n.x AS y, (n_g + n_c) / nullif(n_a + n_c + n_g + n_t, 0) AS g FROM norm n JOIN comp c USING (chrom, bin_index)),
  k AS (SELECT *, rank() OVER (PARTITION BY sample_id ORDER BY g) + (count(*) OVER (PARTITION BY sample_id, g) - 1) / 2 AS rg, rank() OVER (PARTITION BY sample_id ORDER BY y) + (count(*) OVER (PARTITION BY sample_id, y) - 1) / 2 AS ry FROM j WHERE g IS NOT NULL)
  SELECT sample_id, round(avg(g), 6) AS mean_x, round(corr(g, y), 6) AS pearson, round(corr(rg, ry), 6) AS spearman, round(regr_slope(y, g), 6) AS slope FROM k GROUP BY ALL HAVING count(*) >= 3""")
def g4_gc_bias(spark, sf):
    gc = grid.base_composition(a.sequence_chunks(spark, sf), a.bin_grid(spark), a.BIN).select("chrom", "bin_index", "gc_fraction")
    return r6(stats.correlations(a.normalized(spark, sf).join(gc, ["chrom", "bin_index"]), "gc_fraction", "normalized_signal", ["sample_id"]))


_LV = {"atomic": 100_000, "analysis": 90_000, "qc": 700_000}


@query(f"WITH {ALN}, ln AS (SELECT chrom, max(pos) + 1 AS n FROM aln GROUP BY ALL), g AS (" + " UNION ALL ".join(f"SELECT '{k}' AS bin_level, chrom, i AS bin_index, i * {v} AS start_pos, least((i + 1) * {v}, n) AS end_pos FROM ln, unnest(range(CAST(ceil(greatest(n, 0) / {v}) AS BIGINT))) u(i)" for k, v in _LV.items()) + ") SELECT bin_level, bin_level || ':' || chrom || ':' || CAST(start_pos AS VARCHAR) || '-' || CAST(end_pos AS VARCHAR) AS bin_id, bin_index, end_pos - start_pos AS effective_size FROM g")
def b2_multi_level_grid(spark, sf):
    return grid.multi_level_grid(a.seen_sizes(spark, sf), _LV).select("bin_level", "bin_id", "bin_index", "effective_size")


@query(f"WITH {COMP} SELECT chrom, bin_index, n_a, n_c, n_g, n_t, n_n, round((n_g + n_c) / nullif(n_a + n_c + n_g + n_t, 0), 6) AS gc_fraction, round(n_n / 90000.0, 6) AS n_fraction FROM comp")
def b3_base_composition(spark, sf):
    return r6(grid.base_composition(a.sequence_chunks(spark, sf), a.bin_grid(spark), a.BIN).select("chrom", "bin_index", *[f"n_{b}" for b in "acgtn"], "gc_fraction", "n_fraction"))


@query(f"WITH {GRID}, {FRACS} SELECT chrom, bin_index, {', '.join(f'round({c}_overlap_fraction, 6) AS {c}_overlap_fraction, CAST({c}_overlap_fraction > 0 AS INT) AS overlaps_{c}' for c in a.CLASSES)} FROM fr")
def b4_overlap_fraction(spark, sf):
    out = grid.region_flags(grid.overlap_fraction(a.bin_grid(spark).select("chrom", "bin_index", "start_pos", "end_pos"), a.intervals(spark, sf), 30_000, a.CLASSES), a.CLASSES)
    return r6(out.drop("start_pos", "end_pos"))


@query(f"WITH {ANN} SELECT 'analysis' AS bin_level, count(*) AS n_bins, round(median(gc_fraction), 6) AS median_gc, round(median(n_fraction), 6) AS median_n, {', '.join(f'sum(CAST({c}_overlap_fraction > 0 AS INT)) AS n_{c}' for c in a.CLASSES)} FROM ann")
def b6_grid_level_summary(spark, sf):
    return r6(grid.grid_level_summary(a.annotated(spark, sf).withColumn("bin_level", F.lit("analysis")), a.CLASSES))


@query(f"""WITH {ANN}, t AS (SELECT {_CH.format('c')} AS chrom, i * 250000 AS s, least((i + 1) * 250000, 2520000) AS e FROM range(24) x(c), range(11) y(i)),
  src AS (SELECT * FROM ann)
  SELECT t.chrom, t.s AS start_pos, t.e AS end_pos, round(sum(gc_fraction * (least(end_pos, t.e) - greatest(start_pos, t.s)) / (t.e - t.s)), 6) AS gc_fraction,
  round(sum(n_fraction * (least(end_pos, t.e) - greatest(start_pos, t.s)) / (t.e - t.s)), 6) AS n_fraction,
  coalesce(max(CAST(blacklist_overlap_fraction > 0 AS INT)), 0) AS overlaps_blacklist FROM t LEFT JOIN src ON src.chrom = t.chrom AND start_pos < t.e AND end_pos > t.s GROUP BY t.chrom, t.s, t.e""")
def b7_project_annotations(spark, sf):
    source = a.annotated(spark, sf)
    target = grid.make_bin_grid(a.chrom_sizes(spark), 250_000, "wide")
    return r6(grid.project_annotations(target, source, ["gc_fraction", "n_fraction"], ["overlaps_blacklist"], 90_000))


@query(f"""WITH {BINS}, {COMP[len(GRID) + 2:]}, j AS (SELECT b.*, (n_g + n_c) / nullif(n_a + n_c + n_g + n_t, 0) AS g FROM bins b JOIN comp c USING (chrom, bin_index))
  SELECT sample_id, chrom, start_pos // 360000 AS bin_index, CAST(sum(raw_count) AS BIGINT) AS raw_count, min(start_pos) AS start_pos, max(end_pos) AS end_pos, round(sum(g * 90000) / sum(CASE WHEN g IS NOT NULL THEN 90000 END), 6) AS gc_fraction FROM j GROUP BY sample_id, chrom, start_pos // 360000""")
def b10_coarsen_bins(spark, sf):
    gc = grid.base_composition(a.sequence_chunks(spark, sf), a.bin_grid(spark), a.BIN).select("chrom", "bin_index", "gc_fraction")
    return r6(grid.coarsen_bins(a.bins(spark, sf).join(gc, ["chrom", "bin_index"]), 360_000))


@query("WITH s AS (SELECT DISTINCT p_size * CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 1000 ELSE 1000000 END AS n FROM part) SELECT n, CASE WHEN n % 1000000 = 0 THEN CAST(n // 1000000 AS VARCHAR) || 'mb' WHEN n % 1000 = 0 THEN CAST(n // 1000 AS VARCHAR) || 'kb' ELSE CAST(n AS VARCHAR) || 'bp' END AS label FROM s")
def b11_bin_size_label(spark, sf):
    n = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_size * CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 1000 ELSE 1000000 END AS n").distinct()
    return n.withColumn("label", grid.bin_size_label(F.col("n")))


@query(f"WITH {EVENTS} SELECT event_id, b.bin_index, raw_count FROM ev JOIN bins b ON b.sample_id = ev.sample_id AND b.chrom = ev.chrom AND b.bin_index BETWEEN start_bin AND end_bin")
def b12_events_to_bins(spark, sf):
    return grid.events_to_bins(a.events(spark, sf), a.bins(spark, sf)).select("event_id", "bin_index", "raw_count")


@query(f"""WITH {SCORED}, l AS (SELECT *, abs(z) < 1.5 AS ok, row_number() OVER (PARTITION BY sample_id, chrom ORDER BY bin_index) AS i FROM scored), r AS (SELECT *, i - row_number() OVER (PARTITION BY sample_id, chrom ORDER BY bin_index) AS run FROM l WHERE ok),
  b AS (SELECT sample_id, chrom, min(bin_index) AS left_bin, max(bin_index) + 1 AS right_bin, count(*) AS n_bins FROM r GROUP BY sample_id, chrom, run HAVING count(*) >= 3) SELECT *, row_number() OVER (PARTITION BY sample_id, chrom ORDER BY left_bin) - 1 AS block_index FROM b""")
def c5_seed_blocks(spark, sf):
    return grid.seed_blocks(a.scored(spark, sf), F.abs("robust_z") < 1.5, 3)


@query(f"WITH {EVENTS} SELECT event_id, sample_id, chrom, state, start_bin, end_bin, start_pos, end_pos, n_bins, round(mean_z, 6) AS mean_z, round(median_z, 6) AS median_z, round(max_abs_z, 6) AS max_abs_z FROM ev")
def c10_run_events(spark, sf):
    return r6(a.events(spark, sf))


@query(f"""WITH {BINS}, s AS (SELECT *, raw_count - lag(raw_count) OVER (PARTITION BY sample_id ORDER BY chrom_rank, bin_index) AS d FROM bins), m AS (SELECT *, median(d) OVER (PARTITION BY sample_id) AS dm FROM s),
  u AS (SELECT sample_id, avg(CAST(raw_count = 0 AS INT)) AS zero_fraction, stddev_pop(raw_count) / avg(raw_count) AS cv, median(abs(d - dm)) AS adjacent_mad, CAST(sum(raw_count) AS BIGINT) AS mapped_fragments, count(*) AS n_bins FROM m GROUP BY ALL)
  SELECT sample_id, round(zero_fraction, 6) AS zero_fraction, round(cv, 6) AS cv, round(adjacent_mad, 6) AS adjacent_mad, mapped_fragments, n_bins, round(gini, 6) AS gini FROM u JOIN ({_GINI}) USING (sample_id)""")
def q1_uniformity(spark, sf):
    return r6(qc.uniformity_metrics(a.bins(spark, sf)))


_LOO = f"""{NORM}, pr AS (SELECT p.sample_id, p.chrom, p.bin_index, p.x AS v, o.x AS y FROM norm p JOIN norm o ON o.chrom = p.chrom AND o.bin_index = p.bin_index AND o.sample_id <> p.sample_id),
  md AS (SELECT *, median(y) OVER (PARTITION BY sample_id, chrom, bin_index) AS m FROM pr), sg AS (SELECT sample_id, chrom, bin_index, max(v) AS v, max(m) AS ref_median, 1.4826 * median(abs(y - m)) AS s FROM md GROUP BY ALL),
  fl AS (SELECT sample_id, coalesce(quantile_cont(CASE WHEN s > 0 THEN s END, 0.05), 0.001) AS f FROM sg GROUP BY ALL), loo AS (SELECT sg.*, greatest(s, f) AS ref_sigma FROM sg JOIN fl USING (sample_id))"""


@query(f"WITH {_LOO} SELECT sample_id, chrom, bin_index, round(ref_median, 6) AS ref_median, round(ref_sigma, 6) AS ref_sigma FROM loo")
def q2_leave_one_out(spark, sf):
    return r6(a.leave_one_out(spark, sf).drop("v"))


@query(f"""WITH {_LOO}, z AS (SELECT *, abs((v - ref_median) / ref_sigma) AS z FROM loo), k AS (SELECT *, rank() OVER (PARTITION BY sample_id ORDER BY ref_median) + (count(*) OVER (PARTITION BY sample_id, ref_median) - 1) / 2 AS rx, rank() OVER (PARTITION BY sample_id ORDER BY v) + (count(*) OVER (PARTITION BY sample_id, v) - 1) / 2 AS ry FROM z)
  SELECT sample_id, round(median(z), 6) AS median_abs_z, round(avg(CAST(z > 3 AS INT)), 6) AS over_3, round(avg(CAST(z > 5 AS INT)), 6) AS over_5, round(corr(ref_median, v), 6) AS pearson, round(corr(rx, ry), 6) AS spearman FROM k GROUP BY ALL""")
def q3_reference_deviation(spark, sf):
    return r6(qc.reference_deviation(a.leave_one_out(spark, sf)))


_Q4 = f"""{_LOO}, dz AS (SELECT *, abs((v - ref_median) / ref_sigma) AS z, rank() OVER (PARTITION BY sample_id ORDER BY ref_median) + (count(*) OVER (PARTITION BY sample_id, ref_median) - 1) / 2 AS rx, rank() OVER (PARTITION BY sample_id ORDER BY v) + (count(*) OVER (PARTITION BY sample_id, v) - 1) / 2 AS ry FROM loo),
  dv AS (SELECT sample_id, median(z) AS median_abs_z, avg(CAST(z > 3 AS INT)) AS outlier_frac_abs_z_gt_3, corr(ref_median, v) AS pearson_r, corr(rx, ry) AS spearman_r FROM dz GROUP BY ALL),
  st AS (SELECT *, raw_count - lag(raw_count) OVER (PARTITION BY sample_id ORDER BY chrom_rank, bin_index) AS d FROM bins), sm AS (SELECT *, median(d) OVER (PARTITION BY sample_id) AS dm FROM st),
  un AS (SELECT sample_id, avg(CAST(raw_count = 0 AS INT)) AS zero_bin_fraction, stddev_pop(raw_count) / avg(raw_count) AS bin_cv, median(abs(d - dm)) AS adjacent_diff_mad, sum(raw_count) AS mapped_fragments FROM sm GROUP BY ALL),
  mt AS (SELECT un.*, dv.* EXCLUDE (sample_id), gini AS gini_coefficient FROM un JOIN dv USING (sample_id) JOIN ({_GINI}) USING (sample_id)),
  dc AS (SELECT sample_id, {', '.join(f"array_to_string(list_filter([{', '.join(f'CASE WHEN {c} IS NULL THEN {chr(39)}{c}=nan{chr(39)} WHEN {c} {o} {lim[at]} THEN {chr(39)}{c}{o}{lim[at]}{chr(39)} END' if at else f'CASE WHEN {c} {o} {lim[at]} THEN {chr(39)}{c}{o}{lim[at]}{chr(39)} END' for c, o, *lim in [(n, '<' if k == 'min' else '>', w, f) for n, k, w, f in qc.DEFAULT_CHECKS])}], lambda x: x IS NOT NULL), ';') AS {out}" for at, out in ((1, 'fl'), (0, 'wn')))} FROM mt)"""


def _all_metrics(spark, sf):
    """The nine metrics of a sample under their names in the checks."""
    counted = a.bins(spark, sf)
    deviation = qc.reference_deviation(a.leave_one_out(spark, sf, counted)).withColumnsRenamed({"over_3": "outlier_frac_abs_z_gt_3", "pearson": "pearson_r", "spearman": "spearman_r"})
    return qc.uniformity_metrics(counted).withColumnsRenamed({"zero_fraction": "zero_bin_fraction", "cv": "bin_cv", "adjacent_mad": "adjacent_diff_mad", "gini": "gini_coefficient"}).join(deviation, "sample_id")


@query(f"WITH {_Q4} SELECT sample_id, CASE WHEN fl <> '' THEN 'FAIL' WHEN wn <> '' THEN 'WARN' ELSE 'PASS' END AS qc_decision, CASE WHEN fl <> '' THEN fl WHEN wn <> '' THEN wn ELSE 'all_metrics_within_default_heuristic_thresholds' END AS qc_reason FROM dc")
def q4_qc_decision(spark, sf):
    return qc.qc_decision(_all_metrics(spark, sf)).select("sample_id", "qc_decision", "qc_reason")


@query(f"WITH {NORM} SELECT p.sample_id AS sample_a, q.sample_id AS sample_b, round(corr(p.x, q.x), 6) AS pearson FROM norm p JOIN norm q USING (chrom, bin_index) GROUP BY ALL")
def q10_sample_correlations(spark, sf):
    return r6(qc.sample_correlations(a.normalized(spark, sf), "normalized_signal"))


_AF = f"{BINS}, af AS (SELECT sample_id, chrom, sum(raw_count) / sum(sum(raw_count)) OVER (PARTITION BY sample_id) AS fraction FROM bins WHERE {AUTO} GROUP BY sample_id, chrom)"


@query(f"WITH {_AF} SELECT sample_id, chrom, round(fraction, 6) AS fraction FROM af")
def q13_autosome_fractions(spark, sf):
    return r6(qc.autosome_fractions(a.bins(spark, sf)))


@query(f"""WITH {_AF}, m AS (SELECT *, median(fraction) OVER (PARTITION BY chrom) AS m FROM af WHERE right(sample_id, 1) < '5'), s AS (SELECT chrom, max(m) AS m, 1.4826 * median(abs(fraction - m)) AS s FROM m GROUP BY ALL),
  z AS (SELECT sample_id, chrom, abs(fraction - m) / CASE WHEN s > 0 THEN s ELSE 1e-6 END AS z FROM af JOIN s USING (chrom)), r AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY z DESC, chrom) AS r FROM z)
  SELECT sample_id, round(max(z), 6) AS max_abs_z, {', '.join(f"max(CASE WHEN r = {i} THEN chrom END) AS top_chrom_{i}" for i in (1, 2, 3))} FROM r GROUP BY ALL""")
def q15_chromosome_bias(spark, sf):
    """The stable samples are those with a number under 5."""
    shares = qc.autosome_fractions(a.bins(spark, sf))
    return r6(qc.chromosome_bias(shares, shares.where(F.substring("sample_id", -1, 1) < "5").select("sample_id")))


@query(f"""WITH {BINS}, l AS (SELECT *, ln(1 + raw_count) AS l FROM bins), m AS (SELECT *, median(l) OVER (PARTITION BY sample_id) AS m FROM l), q AS (SELECT sample_id, CAST(sum(raw_count) AS BIGINT) AS total, avg(CAST(raw_count > 0 AS INT)) AS nz, median(abs(l - m)) AS md FROM m GROUP BY ALL)
  SELECT sample_id, total, round(nz, 6) AS nonzero_fraction, round(md, 6) AS log_mad, CASE WHEN total >= 2000 AND nz >= 0.4 AND md <= 1.2 THEN 'PASS' ELSE concat_ws(',', CASE WHEN total < 2000 THEN 'low_total' END, CASE WHEN nz < 0.4 THEN 'low_nonzero' END, CASE WHEN md > 1.2 THEN 'high_mad' END) END AS status FROM q""")
def q22_input_qc(spark, sf):
    return r6(qc.input_qc(a.bins(spark, sf), least_total=2000))


_M1 = f"{_LOO}, m1 AS (SELECT chrom, bin_index, avg(CAST(abs(zc) > 3 AS INT)) AS zf, median(abs(zc)) AS mz, count(*) AS n_samples FROM (SELECT *, CASE WHEN sample_id NOT IN ('S2', 'S5') THEN 0.5 * (v - ref_median) / ref_sigma END AS zc FROM loo) GROUP BY ALL)"
_MASK = f"""{_M1}, {ANN[len(GRID) + 2:]}, mask AS (SELECT ann.*, CASE WHEN n_fraction >= 0.2 THEN 'hard' WHEN coalesce(gc_fraction, 0.5) < 0.2 OR coalesce(gc_fraction, 0.5) > 0.8 THEN 'soft' WHEN zf >= 0.05 OR mz >= 1.5 THEN 'dynamic' ELSE 'pass' END AS mask_label, zf, mz FROM ann LEFT JOIN m1 USING (chrom, bin_index))"""


@query(f"WITH {_M1} SELECT chrom, bin_index, round(zf, 6) AS z_frac_over_3, round(mz, 6) AS median_abs_z, n_samples FROM m1")
def m1_dynamic_bin_metrics(spark, sf):
    return r6(qc.dynamic_bin_metrics(a.leave_one_out(spark, sf).select("chrom", "bin_index", a.cohort_z())))


@query(f"WITH {_MASK} SELECT chrom, bin_index, mask_label FROM mask")
def m3_combined_mask(spark, sf):
    return a.masked(spark, sf).select("chrom", "bin_index", "mask_label")


@query(f"WITH {_MASK} SELECT mask_label, count(*) AS n_bins FROM mask GROUP BY ALL")
def m4_mask_summary(spark, sf):
    return qc.mask_summary(a.masked(spark, sf))


_C1 = f"""{_MASK}, c0 AS (SELECT *, greatest(low_mappability_overlap_fraction, least(1.0, greatest(0.0, (0.85 - atgc) / 0.5))) AS cm,
  greatest(segmental_duplication_overlap_fraction, 0.85 * repeat_rich_overlap_fraction, blacklist_overlap_fraction, gap_centromere_telomere_overlap_fraction) AS cr FROM mask),
  c1 AS (SELECT *, least(1.0, greatest(0.35 * cm + 0.30 * cr + 0.10 * CASE mask_label WHEN 'soft' THEN 0.2 WHEN 'dynamic' THEN 0.55 WHEN 'hard' THEN 0.95 ELSE 0 END, blacklist_overlap_fraction, gap_centromere_telomere_overlap_fraction)) AS s FROM c0),
  c2 AS (SELECT *, s >= 0.75 OR blacklist_overlap_fraction > 0 OR gap_centromere_telomere_overlap_fraction > 0 OR mask_label IN ('hard', 'dynamic') AS hi, s >= 0.35 OR cr > 0 OR cm > 0 OR mask_label IN ('soft', 'dynamic') AS mo FROM c1)"""


@query(f"""WITH {_C1} SELECT chrom, bin_index, round(s, 6) AS risk_score, CASE WHEN hi THEN 'high' WHEN mo THEN 'moderate' ELSE 'clean' END AS region_risk_class, round(least(1.0, greatest(0.1, exp(-2 * s))), 6) AS region_risk_weight,
  round(1 + 2.5 * s + CASE WHEN hi THEN 0.5 ELSE 0 END, 6) AS variance_inflation,
  CAST(NOT (blacklist_overlap_fraction > 0 OR gap_centromere_telomere_overlap_fraction > 0 OR cm >= 0.75 OR segmental_duplication_overlap_fraction >= 0.75 OR mask_label IN ('hard', 'dynamic')) AS INT) AS correction_fit_eligible,
  CAST(NOT (hi OR mask_label = 'hard') AS INT) AS calling_seed_eligible, CAST({AUTO} AND NOT hi AND NOT mo AND mask_label NOT IN ('soft', 'dynamic', 'hard') AS INT) AS null_eligible FROM c2""")
def c1_region_risk(spark, sf):
    return r6(a.risk(spark, sf).select("chrom", "bin_index", "risk_score", "region_risk_class", "region_risk_weight", "variance_inflation", "correction_fit_eligible", "calling_seed_eligible", "null_eligible"))


@query(f"WITH {BINS} SELECT sample_id, round(sum(CASE WHEN chrom = 'chrY' THEN raw_count ELSE 0 END) / sum(raw_count), 6) AS y_fraction FROM bins GROUP BY ALL")
def r14_y_fraction(spark, sf):
    return r6(evaluate.y_fraction(a.bins(spark, sf)))


@query(f"""WITH {BINS}, y AS (SELECT sample_id, sum(CASE WHEN chrom = 'chrY' THEN raw_count ELSE 0 END) / sum(raw_count) AS y FROM bins GROUP BY ALL), g AS (SELECT y, lead(y) OVER (ORDER BY y) AS n FROM y)
  SELECT round((y + n) / 2, 6) AS cutoff, round(n - y, 6) AS gap FROM g WHERE n > y ORDER BY n - y DESC, y LIMIT 1""")
def r15_largest_gap(spark, sf):
    return r6(evaluate.largest_gap_cutoff(evaluate.y_fraction(a.bins(spark, sf)), "y_fraction"))


X1 = f"""c AS (SELECT sample_id, chrom, sum(raw_count) / 2520000 AS d FROM bins GROUP BY ALL), r AS (SELECT sample_id, median(d) FILTER (WHERE chrom NOT IN ('chrX', 'chrY')) AS m, max(d) FILTER (WHERE chrom = 'chrX') AS x, max(d) FILTER (WHERE chrom = 'chrY') AS y FROM c GROUP BY ALL),
  sx AS (SELECT sample_id, m, x / m AS xm, y / m AS ym, CASE WHEN x > 0 THEN y / x END AS yx, CASE WHEN x / m >= 0.95 THEN 'XX' WHEN x / m <= 0.80 AND y / m >= 0.20 THEN 'XY' WHEN y / m <= 0.15 THEN 'XX' ELSE 'ambiguous' END AS sex_call FROM r)"""


@query(f"WITH {BINS}, {X1} SELECT sample_id, round(m, 6) AS autosome_depth, round(xm, 6) AS x_depth, round(ym, 6) AS y_depth, round(yx, 6) AS y_to_x_ratio, sex_call FROM sx")
def x1_relative_depths(spark, sf):
    return r6(a.depths(spark, sf))


@query(f"WITH {TRUTH} SELECT CASE WHEN fraction IS NULL THEN 'unknown' WHEN fraction <= 0.05 THEN '<=5%' WHEN fraction <= 0.10 THEN '5-10%' WHEN fraction <= 0.15 THEN '10-15%' WHEN fraction <= 0.20 THEN '15-20%' WHEN fraction <= 0.30 THEN '20-30%' ELSE '>30%' END AS fraction_bin, count(*) AS n FROM truth GROUP BY ALL")
def t8_fraction_bin(spark, sf):
    return a.loaded_truth(spark, sf).groupBy(evaluate.fraction_bin(F.col("truth_fraction")).alias("fraction_bin")).agg(F.count("*").alias("n"))


@query(f"WITH {RUNS} SELECT user_id, rule_name, event_id, wall_seconds FROM (SELECT *, row_number() OVER (PARTITION BY user_id, rule_name ORDER BY threads = 1 DESC, created_at DESC, event_id DESC) AS r FROM (SELECT * REPLACE (CAST(event_id % 4 AS INT) AS threads) FROM runs)) WHERE r = 1")
def u1_upsert_latest(spark, sf):
    """Every fourth run is new; the others are there already."""
    runs = a.runs(spark, sf)
    new = F.col("event_id") % 4 == 1
    return evaluate.upsert_latest(runs.where(~new), runs.where(new), ["user_id", "rule_name"], ["created_at", "event_id"]).select("user_id", "rule_name", "event_id", "wall_seconds")


@query(f"""WITH {RUNS}, g AS (SELECT module, rule_name, sample_bucket, threads, binsize, pca_components, count(*) AS n_runs, quantile_cont(wall_seconds / 60, 0.5) AS p50, quantile_cont(wall_seconds / 60, 0.8) AS p80, max(wall_seconds / 60) AS mx FROM runs WHERE status IN ('success', 'log_complete') AND wall_seconds IS NOT NULL GROUP BY ALL)
  SELECT module, rule_name, sample_bucket, threads, binsize, pca_components, n_runs, round(p50, 6) AS p50_minutes, round(p80, 6) AS p80_minutes, round(mx, 6) AS max_minutes, CAST(ceil(greatest(1.2 * p50, p80)) AS BIGINT) AS recommended_check_after_minutes FROM g""")
def u2_runtime_summary(spark, sf):
    return r6(evaluate.runtime_summary(a.runs(spark, sf)))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


from binlattice.plans import calling_queries, cohort_queries, report_queries  # noqa: E402, F401  register their queries
from binlattice.plans import table_queries  # noqa: E402, F401  registers its queries
from binlattice.plans import file_queries  # noqa: E402, F401  registers its queries
