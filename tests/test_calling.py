"""Segmentation, merging, readers and validation on small fixtures."""

import random
import time

import pytest
from pyspark.sql import functions as F

from binlattice.operators import calling, evaluate, grid, qc, report
from binlattice.sources import ingest

BINS = "sample_id string, chrom string, bin_index bigint, start_pos bigint, end_pos bigint, robust_z double, calling_weight double, normalized_signal double, calling_seed_eligible int"


def plain_cuts(z, w, least, threshold, cap):
    """A first-in first-out queue over one block, by plain sums."""
    queue, done = [(0, len(z))], []
    while queue:
        a, b = queue.pop(0)
        best = None
        if len(queue) + len(done) + 1 < cap:
            for m in range(a + least, b - least + 1):
                x, y = sum(w[a:m]), sum(w[m:b])
                gap = abs(sum(p * q for p, q in zip(z[a:m], w[a:m])) / x - sum(p * q for p, q in zip(z[m:b], w[m:b])) / y)
                score = gap * (x * y / (x + y)) ** 0.5
                if best is None or score > best[0] + 1e-12:
                    best = (score, m)
        if best and best[0] >= threshold:
            queue += [(a, best[1]), (best[1], b)]
        else:
            done.append((a, b))
    return sorted(done)


def test_segments_match_a_plain_queue(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for s in range(12):
        n = rng.randint(5, 60)
        z, level = [], 0.0
        for _ in range(n):
            level = rng.choice([0.0, 3.0, -3.0]) if rng.random() < 0.1 else level
            z.append(level + rng.gauss(0, 1))
        w = [rng.uniform(0.1, 2) for _ in range(n)]
        rows += [(f"S{s}", "chr1", i, i * 10, i * 10 + 10, z[i], w[i], 5.0, 1) for i in range(n)]
        want[f"S{s}"] = plain_cuts(z, w, 5, 2.5, 4)
    got = calling.segment_series(spark.createDataFrame(rows, BINS), max_segments=4).collect()
    found = {}
    for r in got:
        found.setdefault(r.sample_id, []).append((r.left_bin, r.right_bin))
    assert {k: sorted(v) for k, v in found.items()} == want


def test_merge_joins_touching_calls_of_one_state(spark):
    calls = spark.createDataFrame(
        [("S", "chr1", 1, 10, 14, "gain", 3.0, 3.0), ("S", "chr1", 1, 14, 18, "gain", 5.0, 5.0), ("S", "chr1", 1, 20, 24, "gain", 4.0, 4.0)],
        "sample_id string, chrom string, block_index int, left_bin bigint, right_bin bigint, state string, mean_z double, median_z double",
    )
    assert sorted((r.left_bin, r.right_bin, r.n_segments, r.mean_z) for r in calling.merge_adjacent(calls).collect()) == [(10, 18, 2, 4.0), (20, 24, 1, 4.0)]


@pytest.mark.parametrize("mean, median, want", [(2.0, 1.0, "gain"), (-2.0, 1.0, "loss"), (1.0, 1.0, "neutral"), (None, None, "neutral")])
def test_reconciled_state(spark, mean, median, want):
    df = spark.createDataFrame([(mean, median)], "a double, b double")
    assert df.select(calling.reconcile_state(df.a, df.b)).first()[0] == want


def test_viterbi_prefers_to_stay(spark):
    rows = [("S", "chr1", i, z) for i, z in enumerate([0.1, 0.2, 6.0, 6.1, 5.9, 0.0])]
    path = calling.viterbi_states(spark.createDataFrame(rows, "sample_id string, chrom string, left_bin int, mean_z double"), shift=6.0, stay=0.9).first().path
    assert len(path) == 6 and path[:2] == ["neutral", "neutral"] and path[3] == "gain"


def test_readers(spark, tmp_path):
    (tmp_path / "a.bed").write_text("# comment\n\nchr1\t5\t9\tx\nchr2\t7\n")
    assert [tuple(r) for r in ingest.read_bed(spark, str(tmp_path / "a.bed"), "par").collect()] == [("par", "chr1", 5, 9)]
    assert ingest.read_bed(spark, "", "par").count() == 0
    (tmp_path / "S7.x.tsv").write_text("a\tb\n1\t2\n")
    table = ingest.read_table(spark, str(tmp_path / "S7.x.tsv"), required=("a",))
    assert ingest.with_sample_from_path(table).first().sample_id == "S7"
    with pytest.raises(ValueError, match="missing columns: z"):
        ingest.read_table(spark, str(tmp_path / "S7.x.tsv"), required=("z",))
    folder = tmp_path / "S9"
    folder.mkdir()
    (folder / "r.json").write_text('{"summary": {"before_filtering": {"total_reads": 10, "q30_rate": 0.9}},\n "duplication": {"rate": 0.1}}')
    row = ingest.library_metrics(spark, str(folder / "r.json")).first()
    assert (row.sample_id, row.before_total_reads, row.duplication_rate, row.after_gc_content) == ("S9", 10.0, 0.1, None)
    ingest.write_outputs(table, str(tmp_path / "out"), ("parquet", "tsv", "json"))
    assert ingest.read_table(spark, str(tmp_path / "out/tsv")).count() == spark.read.json(str(tmp_path / "out/json")).count() == 1


def test_text_reports(spark):
    text = ["100 + 0 in total (QC-passed)", "90 + 0 mapped (90% : N/A)", "80 + 0 with itself and mate mapped", "3 + 0 with mate mapped to a different chr", "2 + 0 with mate mapped to a different chr (mapQ>=5)"]
    row = ingest.flagstat_metrics(spark.createDataFrame([("S", t) for t in text], "sample_id string, value string")).first()
    assert (row.total_reads_bam, row.mapped_reads_bam, row.mate_diff_chr_reads_bam, row.mate_diff_chr_mapq5_reads_bam, row.singleton_reads_bam) == (100, 90, 3, 2, None)
    lines = spark.createDataFrame([("S", "chr1\t10\t5\t0"), ("S", "bad")], "sample_id string, value string")
    assert [tuple(r) for r in ingest.idxstats_table(lines).collect()] == [("S", "chr1", 10, 5, 0)]


def test_bad_input_is_an_error(spark):
    two = spark.createDataFrame([(1, "XX"), (1, "XY")], "id int, sex string")
    with pytest.raises(Exception, match="two sexes"):
        ingest.sample_sex_map(two).collect()
    with pytest.raises(Exception, match="malformed region"):
        ingest.parse_region_specs(spark.createDataFrame([("chr1:5",)], "r string"), "r").collect()


@pytest.mark.parametrize(
    ("rows", "others", "want"),
    [
        ([(1, 2.0, "a"), (2, 3.0, "b")], [(2, 3.0, "b"), (1, 2.0, "a")], "identical"),
        ([(1, 2.0, "a"), (2, 3.0, "b")], [(1, 2.0 + 1e-12, "a"), (2, 3.0, "b")], "identical"),
        ([(1, 2.0, "a"), (2, 3.0, "b")], [(1, 2.5, "a"), (2, 3.0, "b")], "float_tolerance_only"),
        ([(1, 2.0, "a"), (2, None, "b")], [(1, 2.5, "a"), (2, None, "b")], "value_changed"),
        ([(1, 2.0, "a"), (2, 3.0, "b")], [(1, 2.5, "x"), (2, 3.0, "b")], "value_changed"),
        ([(1, 2.0, "a"), (2, 3.0, "b")], [(1, 2.0, "a"), (3, 3.0, "b")], "value_changed"),
        ([(1, 2.0, "a"), (2, 3.0, "b")], [(1, 2.0, "a")], "row_count_changed"),
    ],
)
def test_diff_tables(spark, rows, others, want):
    kind = "sample_id int, x double, t string"
    a, b = spark.createDataFrame(rows, kind), spark.createDataFrame(others, kind)
    assert report.diff_tables(a, b).first().status == want
    assert report.diff_tables(a, b.select("sample_id", "t", "x")).first().status == "schema_changed"
    if "x" not in {r[2] for r in others} and want == "float_tolerance_only":
        assert report.diff_tables(a, b, ignore=("x",)).first().status == "identical"


EVENT = "sample_id string, event_id string, chrom string, start_pos bigint, end_pos bigint, state string, keep_event int, artifact_status string, priority_score double, n_bins int, technical_confidence string, artifact_flags string, downgrade_reason string, calibrated_mean_z double, calibrated_median_z double, event_corr_adjusted_z double, fraction_point double, fraction_ci_low double, fraction_ci_high double, fraction_status string"


def event(event_id, chrom, start, end, status="pass", keep=1, priority=5.0, z=-4.0, fraction=None, state="gain", sample="S1"):
    return (sample, event_id, chrom, start, end, state, keep, status, priority, 10, "high", "", "", z, None, 1.0, fraction, fraction and fraction / 2, fraction and fraction * 1.5, "estimated")


def test_truth_shares_a_base_with_its_match(spark):
    events = spark.createDataFrame([event("a", "1", 100, 200), event("b", "chr1", 201, 300, state="DUP"), event("c", "chr1", 1, 50, keep=0, z=99.0), event("d", "chr2", 1, 9, z=-2.0)], EVENT)
    truth = spark.createDataFrame([("t1", "S1", "1", " Amplification", 200, 200, "0.3"), ("t2", "S1", "chr1", "+", 301, 400, "x"), ("t3", "S1", "chr2", "gain", None, 5, None)], "truth_id string, sample_id string, chrom string, state string, t_start bigint, t_end bigint, expected_fraction string")
    loaded = report.load_truth(truth)
    got = {r.truth_id: (r.matched, r.detected, r.top_support_z) for r in evaluate.truth_metrics(events, loaded).collect()}
    assert got == {"t1": (1, 1, 4.0), "t2": (0, 0, None), "t3": (1, 0, 2.0)}
    outside = report.load_external(spark.createDataFrame([("S1", "1", "dup", 150, 200, -6.0), ("S1", "1", "dup", 150, 199, 9.0)], "sample_id string, chrom string, kind string, start_pos bigint, end_pos bigint, zscore double"))
    both = {r.truth_id: r for r in report.match_truth(evaluate.kept_events(events), loaded, outside).collect()}
    assert (both["t1"].n_matched, both["t1"].top_event_id, both["t1"].truth_fraction, both["t1"].external_n_matched, both["t1"].external_top_z, both["t1"].external_detected) == (1, "a", 0.3, 1, 6.0, 1)
    assert both["t2"].truth_fraction is None and (both["t2"].n_matched, both["t2"].external_n_matched) == (0, 0)


def test_sex_chromosome_review_is_not_shown(spark):
    events = spark.createDataFrame([event("a", "chrX", 1, 9, status="review", priority=9.0), event("b", "chr7", 5, 20, priority=3.0, fraction=0.25), event("c", "chrX", 1, 9, status="review", sample="S2"), event("d", "chrX", 3, 9, sample="S3"), event("e", "chr1", 3, 9, keep=0, status="artifact", sample="S4")], EVENT)
    shown = report.top_display_event(events)
    assert {r.sample_id: (r.top_event, r.top_fraction, r.top_fraction_ci) for r in shown.collect()} == {"S1": ("chr7:5-20 gain [pass/high]", "25.0%", "12.5% to 37.5%"), "S3": ("chrX:3-9 gain [pass/high]", "", "")}
    samples = spark.createDataFrame([("S1", "PASS", "XX"), ("S2", None, "XY")], "sample_id string, qc_status string, sex_call string")
    outside = spark.createDataFrame([("S4", "chr9:1-2 loss")], "sample_id string, top_event string")
    said = {r.sample_id: r for r in report.sample_conclusions(samples, report.sample_event_rollup(events), shown, outside).collect()}
    assert said["S1"].technical_conclusion == "Branch B kept 2 events; top event: chr7:5-20 gain [pass/high]; fraction=25.0%; flags=none; downgrade=none; sex_review_suppressed=1; QC=PASS; sex=XX".replace("flags=none; downgrade=none", "flags=sex_chromosome_event; downgrade=sex_chromosome_review_suppressed")
    assert said["S2"].technical_conclusion.startswith("Branch B kept 1 events; top event: suppressed_sex_chromosome_review; fraction=not_estimated; flags=sex_chromosome_event") and said["S2"].technical_conclusion.endswith("QC=NA; sex=XY")
    assert said["S2"].biological_conclusion == "Branch B top event suppressed (sex-chromosome review only)" and said["S4"].biological_conclusion == "chr9:1-2 loss" and said["S1"].biological_conclusion.startswith("chr7")


def test_small_labels(spark):
    one = spark.range(1)
    groups = {"E12": "batch5_E", "E12x": "other", "E": "batch2_AH", "12": "batch3_num", "12-a": "other", "C": "batch2_AH", "c": "other", "K": "other", "": "other"}
    for name, want in groups.items():
        assert one.select(report.batch_group(F.lit(name))).first()[0] == want
    for value, want in {None: "unknown", 0.05: "<=5%", 0.0500001: "5-10%", 0.15: "10-15%", 0.2: "15-20%", 0.3: "20-30%", 0.31: ">30%"}.items():
        assert one.select(evaluate.fraction_bin(F.lit(value).cast("double"))).first()[0] == want
    calls = spark.createDataFrame([("XX", "XY"), ("XX", None), ("XX", "ambiguous"), (None, "XX")], "model_call string, depth_call string")
    assert [tuple(r)[2:] for r in report.resolve_sex(calls, "depth_only").collect()] == [("XY", "M", "depth_only"), ("XX", "F", "depth_only_fallback_model"), ("XX", "F", "depth_only_fallback_model"), ("XX", "F", "depth_only")]
    assert [r.sex_source for r in report.resolve_sex(calls).collect()] == ["depth_override", "model_fallback", "model_fallback", "depth_override"]


def test_projection_of_an_absent_chromosome(spark):
    target = grid.make_bin_grid(spark.createDataFrame([("chr1", 200), ("chr2", 100)], "chrom string, length bigint"), 100, "wide")
    source = spark.createDataFrame([("chr1", 0, 0, 50, 0.4, 1)], "chrom string, bin_index bigint, start_pos bigint, end_pos bigint, gc_fraction double, overlaps_blacklist int")
    got = {(r.chrom, r.start_pos): (r.gc_fraction, r.overlaps_blacklist) for r in grid.project_annotations(target, source, ["gc_fraction"], ["overlaps_blacklist"], 100).collect()}
    assert got == {("chr1", 0): (0.2, 1), ("chr1", 100): (0.0, 0), ("chr2", 0): (None, 0)}


def test_new_runs_replace_old_ones(spark):
    kind = "k string, at int, v string"
    old, new = spark.createDataFrame([("a", 9, "old"), ("b", 1, "old")], kind), spark.createDataFrame([("a", 1, "new"), ("a", 2, "newer"), ("c", 1, "new")], kind)
    assert {(r.k, r.v) for r in evaluate.upsert_latest(old, new, ["k"], ["at"]).collect()} == {("a", "newer"), ("b", "old"), ("c", "new")}


def test_chromosome_bias_of_the_stable_cohort(spark):
    shares = spark.createDataFrame([(s, c, x) for s, xs in {"a": (0.5, 0.3, 0.2), "b": (0.52, 0.28, 0.2), "c": (0.48, 0.32, 0.2), "d": (0.9, 0.05, 0.05)}.items() for c, x in zip(("chr1", "chr2", "chr3"), xs, strict=True)], "sample_id string, chrom string, fraction double")
    got = {r.sample_id: r for r in qc.chromosome_bias(shares, spark.createDataFrame([("a",), ("b",), ("c",)], "sample_id string")).collect()}
    assert [got["d"][f"top_chrom_{i}"] for i in (1, 2, 3)] == ["chr3", "chr1", "chr2"] and abs(got["d"].max_abs_z - 0.15 / 1e-6) < 1
    alone = qc.chromosome_bias(shares, spark.createDataFrame([("nobody",)], "sample_id string")).collect()
    assert sorted(r.max_abs_z for r in alone) == sorted(r.max_abs_z for r in qc.chromosome_bias(shares).collect())


def test_truth_hits_are_those_of_all_pairs(spark):
    rng = random.Random(5)
    place = lambda: (start := rng.choice([0, 7, 99_999, 100_000, 1_700_000]) + rng.randint(0, 3), start + rng.choice([-1, 0, 1, 90_000, 30_000_000]))
    truth = [(f"t{i}", "S1", rng.choice(["chr1", "chr2"]), "gain", *[None if rng.random() < 0.2 else x for x in place()]) for i in range(60)]
    found = [(rng.choice(["S1", "S2"]), rng.choice(["chr1", "chr2"]), "gain", *place(), float(rng.randint(0, 9))) for _ in range(60)]
    want = {}
    for name, sample, chrom, state, a, b in truth:
        hit = [z for s, c, k, d, e, z in found if (s, c, k) == (sample, chrom, state) and (a is None or b is None or min(e, b) - max(d, a) + 1 > 0)]
        want[name] = (len(hit), max(hit, default=None))
    keys = "sample_id string, chrom string, state string, "
    hits = evaluate.truth_hits(spark.createDataFrame(truth, f"truth_id string, {keys}t_start bigint, t_end bigint"), spark.createDataFrame(found, f"{keys}start_pos bigint, end_pos bigint, z double"), -F.col("z"))
    got = hits.collect()
    assert len(got) == 60 and {r.truth_id: (r.n, None if r.best is None else -r.best) for r in got} == want


def test_many_segments_at_one_place_make_no_pairs(spark):
    """100,000 truth rows and as many segments of another caller at one place: their 10 billion pairs are counted, not made."""
    key = ["'S1' AS sample_id", "'chr1' AS chrom", "'gain' AS state"]
    truth = spark.range(100_000).selectExpr("id AS truth_id", *key, "CAST(10 AS BIGINT) AS t_start", "IF(id % 2 = 0, CAST(20 AS BIGINT), NULL) AS t_end", "0.5D AS truth_fraction")
    outside = spark.range(100_000).selectExpr(*key, "CAST(20 AS BIGINT) AS start_pos", "CAST(30 AS BIGINT) AS end_pos", "CAST(id % 7 AS DOUBLE) AS abs_zscore")
    events = spark.createDataFrame([("S1", "chr1", "gain", 1, 10, 3.0, "e", 0.4, 0.3, 0.5, "estimated")], "sample_id string, chrom string, state string, start_pos bigint, end_pos bigint, support_z double, event_id string, fraction_point double, fraction_ci_low double, fraction_ci_high double, fraction_status string")
    begun = time.monotonic()
    got = report.match_truth(events, truth, outside).agg(F.count("*"), F.sum("n_matched"), F.sum("external_n_matched"), F.min("external_top_z"), F.min("top_event_id")).first()
    assert tuple(got) == (100_000, 100_000, 10**10, 6.0, "e")
    assert time.monotonic() - begun < 60
