"""Rules of risk, masks, calling, calibration and artifacts on fixtures on which each of them decides."""

import math
import random
from statistics import median

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from binlattice.operators import artifact, calibrate, calling, grid, qc
from binlattice.plans import adapters

#: An event that no rule objects to.
PLAIN = dict(
    event_id="e", sample_id="S", chrom="chr4", start_pos=40_000_000, end_pos=52_000_000, start_bin=40, end_bin=51, n_bins=12, chrom_bins=190, sex_call="XX", par_bp=0, par_fraction=0.0, calibrated_mean_z=5.0, calibrated_median_z=-4.0,
    event_corr_adjusted_z=16.5, empirical_qvalue=0.0005, clean_bin_fraction=0.95, moderate_risk_bin_fraction=0.05, high_risk_bin_fraction=0.0, effective_bin_count=11.0, region_risk_score_mean=0.01, region_risk_score_max=0.1,
    high_risk_boundary_crossing=0, segment_mean_robust_z=5.0, segment_median_robust_z=4.9, segment_abs_max_robust_z=8.0, **{f"{c}_overlap_fraction": 0.0 for c in artifact.OVERLAPS},
)

#: (changes, status, flags, downgrade reasons, filter reasons)
CASES = [
    ({}, "pass", "", "", ""),
    ({"n_bins": 2}, "artifact", "too_few_bins", "", "bin_count_below_minimum"),
    ({"event_corr_adjusted_z": 1.0, "calibrated_mean_z": 1.5, "calibrated_median_z": -1.9}, "artifact", "low_calibrated_signal", "", "signal_support_below_minimum"),
    ({"n_bins": 90, "effective_bin_count": 80.0}, "review", "broad_chrom_fraction", "broad_event_preserved_by_internal_support", ""),
    ({"n_bins": 90, "effective_bin_count": 9.0}, "artifact", "broad_chrom_fraction", "", "chromosome_fraction_too_large"),
    ({"n_bins": 90, "effective_bin_count": 80.0, "empirical_qvalue": 0.3}, "artifact", "broad_chrom_fraction,weak_empirical_support", "empirical_qvalue_above_threshold", "chromosome_fraction_too_large"),
    ({"n_bins": 90, "chrom": "chrX"}, "review", "broad_chrom_fraction,sex_chromosome_event", "broad_sex_chromosome_event", ""),
    ({"n_bins": 90, "chrom": "chrX", "sex_call": None, "clean_bin_fraction": 0.1}, "artifact", "broad_chrom_fraction,sex_chromosome_event", "", "chromosome_fraction_too_large"),
    ({"start_bin": 2}, "review", "edge_event", "chromosome_edge_contact", ""),
    ({"end_bin": 187, "start_bin": 176}, "review", "edge_event", "chromosome_edge_contact", ""),
    ({"start_bin": 0, "event_corr_adjusted_z": 2.1, "calibrated_mean_z": 1.0, "calibrated_median_z": 1.0, "effective_bin_count": 1.0}, "artifact", "edge_event", "chromosome_edge_contact", "edge_event_priority_below_keep_threshold"),
    ({"empirical_qvalue": 0.26}, "review", "weak_empirical_support", "empirical_qvalue_above_threshold", ""),
    ({"chrom": "chrX"}, "review", "sex_chromosome_event", "", ""),
    ({"chrom": "chrX", "par_bp": 12_000_000, "par_fraction": 1.0}, "review", "sex_chromosome_event,par_overlap", "par_overlap", ""),
    ({"chrom": "chrX", "par_bp": 500, "par_fraction": 0.4}, "review", "sex_chromosome_event,par_overlap,mixed_par_nonpar", "par_overlap;mixed_par_nonpar_boundary", ""),
    ({"chrom": "chrY"}, "artifact", "sex_chromosome_event,xx_chrY_unexpected_signal", "", "xx_sample_with_chrY_signal"),
    ({"chrom": "chrY", "sex_call": "XY"}, "review", "sex_chromosome_event", "xy_chrY_default_review", ""),
    ({"chrom": "chrX", "xtr_overlap_fraction": 0.01}, "review", "sex_chromosome_event,xtr_overlap", "xtr_overlap", ""),
    ({"chrom": "chrX", "sex_homology_overlap_fraction": 0.1}, "review", "sex_chromosome_event,sex_homology_overlap", "sex_homology_overlap", ""),
    ({"segmental_duplication_overlap_fraction": 0.3}, "review", "segmental_duplication_overlap", "segmental_duplication_overlap", ""),
    ({"segmental_duplication_overlap_fraction": 0.3, "clean_bin_fraction": 0.4}, "artifact", "segmental_duplication_overlap", "", "segmental_duplication_overlap_with_limited_clean_support"),
    ({"low_mappability_overlap_fraction": 0.25}, "review", "low_mappability_overlap", "low_mappability_overlap", ""),
    ({"repeat_rich_overlap_fraction": 0.25}, "review", "repeat_rich_overlap", "repeat_rich_overlap", ""),
    ({"gap_centromere_telomere_overlap_fraction": 0.01}, "review", "gap_centromere_telomere_overlap", "gap_centromere_telomere_overlap", ""),
    ({"blacklist_overlap_fraction": 0.01}, "artifact", "blacklist_overlap", "", "blacklist_region_overlap"),
    ({"ambiguous_alignment_overlap_fraction": 0.1}, "review", "ambiguous_alignment_region", "ambiguous_alignment_region", ""),
    ({"ambiguous_alignment_overlap_fraction": 0.1, "event_corr_adjusted_z": 3.0, "calibrated_mean_z": 3.0, "calibrated_median_z": 3.0}, "artifact", "ambiguous_alignment_region", "ambiguous_alignment_region", "ambiguous_alignment_with_non_high_confidence_signal"),
    ({"high_risk_bin_fraction": 0.5, "clean_bin_fraction": 0.5}, "review", "high_risk_region_burden", "high_risk_bin_fraction", ""),
    ({"high_risk_bin_fraction": 0.9, "clean_bin_fraction": 0.1, "event_corr_adjusted_z": 3.0, "calibrated_mean_z": 3.0, "calibrated_median_z": 3.0}, "artifact", "high_risk_region_burden,clean_support_low", "high_risk_bin_fraction", "clean_bin_support_too_low"),
    ({"high_risk_boundary_crossing": 1}, "review", "high_risk_boundary_crossing", "high_risk_boundary_crossing", ""),
    ({"event_corr_adjusted_z": 6.0}, "review", "clean_event_below_ultra_pass", "low_risk_event_preserved_below_ultra_pass", ""),
    ({"event_corr_adjusted_z": 7.0, "segmental_duplication_overlap_fraction": 0.2, "region_risk_score_max": 0.15}, "review", "clean_event_below_ultra_pass", "focal_low_risk_event_preserved_below_ultra_pass", ""),
    ({"event_corr_adjusted_z": 7.0, "region_risk_score_max": 0.5}, "artifact", "clean_event_below_ultra_pass", "", "clean_event_below_ultra_pass_gate"),
    ({"effective_bin_count": 7.0}, "review", "clean_event_below_ultra_pass", "low_risk_event_preserved_below_ultra_pass", ""),
]


def test_every_artifact_rule_decides_a_case(spark):
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'bigint'}" for k, v in PLAIN.items())
    rows = [tuple((PLAIN | {"event_id": str(i)} | change).values()) for i, (change, *_) in enumerate(CASES)]
    found = artifact.classify_events(artifact.priority_score(artifact.artifact_flags(spark.createDataFrame(rows, kinds)))).collect()
    got = {int(r.event_id): (r.artifact_status, r.artifact_flags, r.downgrade_reason, r.filter_reason) for r in found}
    for i, case in enumerate(CASES):
        assert got[i] == case[1:], case[0]
    flags = {f for *_, f, _, _ in CASES for f in f.split(",") if f}
    assert flags == {f for f, *_ in artifact._rules() if f} | {"clean_event_below_ultra_pass"}
    assert {r.keep_event for r in found if r.artifact_status == "review"} == {1} and {r.technical_confidence for r in found} >= {"rejected", "high", "moderate"}
    hidden = artifact.classify_events(artifact.priority_score(artifact.artifact_flags(spark.createDataFrame(rows, kinds))), keep_review=False)
    assert {(r.artifact_status, r.keep_event) for r in hidden.collect()} == {("pass", 1), ("review", 0), ("artifact", 0)}


def test_par_overlap_sums_pieces(spark):
    events = spark.createDataFrame([("a", "chrX", 0, 1000), ("b", "chrX", 2_500_000, 4_500_000), ("c", "chr1", 0, 1000)], "event_id string, chrom string, start_pos bigint, end_pos bigint")
    par = spark.createDataFrame([("chrX", 100, 300), ("chrX", 900, 3_000_000)], "chrom string, start_pos bigint, end_pos bigint")
    got = {r.event_id: (r.par_bp, r.par_fraction) for r in artifact.par_overlap(events, par).collect()}
    assert got == {"a": (300, 0.3), "b": (500_000, 0.25), "c": (0, 0.0)}


RISK = "chrom string, mask_label string, mappability_score double, " + ", ".join(f"{c}_overlap_fraction double" for c in artifact.OVERLAPS)


def test_region_risk(spark):
    row = lambda chrom="chr2", mask="pass", mappable=0.95, **o: (chrom, mask, mappable, *[o.get(c, 0.0) for c in artifact.OVERLAPS])
    rows = [row(), row("chrX"), row(mask="soft"), row(mask="dynamic"), row(mask="hard"), row(mappable=0.6), row(segmental_duplication=0.8), row(blacklist=0.02), row(gap_centromere_telomere=0.01), row(ambiguous_alignment=0.1), row(ambiguous_alignment=0.3), row("chrX", par=0.3)]
    got = [(r.region_risk_class, r.correction_fit_eligible, r.calling_seed_eligible, r.null_eligible) for r in qc.annotate_region_risk(spark.createDataFrame(rows, RISK).coalesce(1)).collect()]
    assert got == [
        ("clean", 1, 1, 1), ("clean", 1, 1, 0), ("moderate", 1, 1, 0), ("high", 0, 0, 0), ("high", 0, 0, 0), ("moderate", 1, 1, 0), ("moderate", 0, 1, 0), ("high", 0, 0, 0), ("high", 0, 0, 0), ("moderate", 0, 0, 0), ("high", 0, 0, 0), ("moderate", 0, 1, 0),
    ]


def test_hotspots_only_raise_masks(spark):
    kind = "chrom string, mask_label string, mask_reason string, gap_centromere_telomere_overlap_fraction double, segmental_duplication_overlap_fraction double, par_overlap_fraction double"
    rows = [("chr14", "soft", "x", 0.6, 0.0, 0.0), ("chr14", "soft", "x", 0.4, 0.0, 0.0), ("chr9", "pass", "", 0.0, 0.4, 0.0), ("chr9", "hard", "n", 0.0, 0.4, 0.0), ("chrX", "pass", None, 0.0, 0.0, 0.5), ("chrX", None, None, 0.0, 0.0, 0.2), ("chr1", "pass", "", 0.9, 0.9, 0.9)]
    got = [(r.mask_label, r.mask_reason or "") for r in grid.escalate_hotspots(spark.createDataFrame(rows, kind).coalesce(1)).collect()]
    # Names of reasons.
    assert got == [("hard", "x;branch_b_hotspot:acrocentric_gap"), ("soft", "x"), ("dynamic", "branch_b_hotspot:repeat_hotspot"), ("hard", "n"), ("hard", "branch_b_hotspot:xy_homology"), ("dynamic", "branch_b_hotspot:xy_homology"), ("pass", "")]


def test_projected_mask_labels(spark):
    bins = spark.createDataFrame([("chr1", i * 100, i * 100 + 100) for i in range(7)], "chrom string, start_pos bigint, end_pos bigint")
    mask = [(0, 50, "hard", "a"), (100, 140, "hard", "b"), (200, 230, "dynamic", "c"), (300, 330, "soft", "d"), (400, 410, "soft", "e"), (500, 510, "dynamic", "f"), (500, 540, "soft", "g")]
    table = spark.createDataFrame([("chr1", *m) for m in mask], "chrom string, start_pos bigint, end_pos bigint, mask_label string, mask_reason string")
    got = [(r.mask_label, r.mask_reason) for r in grid.project_mask(bins, table, 1000).orderBy("start_pos").collect()]
    assert got == [("hard", "a"), ("dynamic", "b"), ("dynamic", "c"), ("soft", "d"), ("soft", "e"), ("soft", "g"), ("pass", "")]


SCORED = "sample_id string, chrom string, bin_index bigint, start_pos bigint, end_pos bigint, normalized_signal double, bin_weight double, region_risk_weight double, variance_inflation double, calling_weight double, calling_seed_eligible int, is_autosome int, region_risk_class string, mask_label string, gap_centromere_telomere_overlap_fraction double"


def series(values, sample="S", seeds=None, auto=None, classes=None, masks=None, gaps=None):
    """Rows of bins: chromosome -> signals."""
    rows = []
    for chrom, signal in values.items():
        for i, x in enumerate(signal):
            pick = lambda table, default: (table or {}).get((chrom, i), default)
            rows.append((sample, chrom, i, i * 10, i * 10 + 10, x, 1.0, 1.0, 1.0, 1.0, pick(seeds, 1), 0 if chrom == "chrX" else 1, pick(classes, "clean"), pick(masks, "pass"), pick(gaps, 0.0)))
    return rows


def plain_background(values, own, seeds):
    """Centre and scale of the first tier that holds values, the own chromosome left out."""
    cells = [(x, c != "chrX", (seeds or {}).get((c, i), 1) == 1) for c, signal in values.items() if c != own for i, x in enumerate(signal)]
    cells = cells or [(x, own != "chrX", True) for x in values[own]]
    tiers = [lambda a, s: a and s, lambda a, s: a, lambda a, s: s, lambda a, s: True]
    held = next(v for t in tiers if (v := [x for x, a, s in cells if t(a, s)]))
    m, mean = median(held), sum(held) / len(held)
    return m, max(1.4826 * median(abs(x - m) for x in held), math.sqrt(sum((x - mean) ** 2 for x in held) / len(held)), 1e-6)


@pytest.mark.parametrize("case", ["plain", "no seeds", "no autosomes", "one chromosome"])
def test_scores_against_other_chromosomes(spark, case):
    rng = random.Random(case)
    values = {c: [rng.gauss(10 if c != "chr4" else 8, 0.2) for _ in range(9)] for c in ("chr1", "chr2", "chr3", "chr4", "chrX")}
    seeds = {(c, i): 0 for c in values for i in range(9) if i % 4 == 3}
    if case == "no seeds":
        seeds = {(c, i): 0 for c in values if c != "chrX" for i in range(9)}
    if case == "no autosomes":
        values, seeds = {"chrX": values["chrX"]}, None
    if case == "one chromosome":
        values, seeds = {"chr4": values["chr4"]}, None
    got = calling.score_bins(spark.createDataFrame(series(values, seeds=seeds), SCORED)).collect()
    for r in got:
        center, scale = plain_background(values, r.chrom, seeds)
        assert r.global_robust_z == pytest.approx((r.normalized_signal - center) / scale)
    if case == "plain":
        assert {r.chrom for r in got if r.chrom_shift_z < -2} == {"chr4"}
        held = [x for c, s in values.items() if c != "chrX" for i, x in enumerate(s) if i % 4 != 3]
        assert {round(r.background_center, 9) for r in got} == {round(median(held), 9)}


def test_dosage_needs_shift_bins_and_clean_share(spark):
    flat = lambda n, x: [x + 0.01 * (i % 3) for i in range(n)]
    values = {"chr1": flat(12, 10), "chr2": flat(12, 10), "chr3": flat(12, 10.1), "chr4": flat(12, 9.9), "chr5": flat(12, 16), "chr6": flat(12, 5), "chr7": flat(12, 16), "chr8": flat(9, 16)}
    dirty = {("chr7", i): "high" for i in range(9)}
    scored = calling.score_bins(spark.createDataFrame(series(values, classes=dirty), SCORED)).withColumn("chrom_shift_z", F.col("chrom_shift_z") * 100)
    kept = calling.dosage_events(scored.where("chrom IN ('chr5', 'chr6', 'chr7', 'chr8')")).collect()
    assert {(r.chrom, r.state, r.n_bins) for r in kept} == {("chr5", "gain", 12), ("chr6", "loss", 12)}
    assert {r.chrom for r in calling.dosage_events(scored.where("chrom IN ('chr7', 'chr8')"), least_clean=0.2, least_effective=9.0).collect()} == {"chr7", "chr8"}


def test_gap_rescue_and_fusion(spark):
    values = {"chr1": [10 + 0.05 * (i % 5) for i in range(30)]}
    for i in (10, 11, 12, 20, 21):
        values["chr1"][i] = 14.0
    masks, gaps = {("chr1", i): "hard" for i in (10, 11, 12, 20, 21)}, {("chr1", i): 0.5 for i in (10, 11, 12, 20, 21)}
    bins = spark.createDataFrame(series(values, masks=masks, gaps=gaps), SCORED).withColumn("chrom_shift_z", F.lit(-1.5))
    found = calling.gap_rescue_events(bins)
    assert [(r.start_bin, r.end_bin, r.state, r.caller_stage) for r in found.collect()] == [(10, 12, "gain", "masked_gap_rescue")]
    assert calling.gap_rescue_events(bins.withColumn("chrom_shift_z", F.lit(0.5))).count() == 0
    assert calling.gap_rescue_events(bins.withColumn("chrom_shift_z", F.lit(1.5))).count() == 0
    event = lambda name, a, b, state: (name, "S", "chr1", state, a, b)
    kind = "event_id string, sample_id string, chrom string, state string, start_bin bigint, end_bin bigint"
    dosage = spark.createDataFrame([event("d", 0, 29, "gain")], kind)
    others = spark.createDataFrame([event("same", 2, 29, "gain"), event("short", 0, 20, "gain"), event("other", 0, 29, "loss")], kind)
    assert {r.event_id for r in calling.fuse_events(dosage, others.unionByName(found.select(others.columns))).collect()} == {"d", "short", "other", found.first().event_id}


def test_segments_become_states_and_events(spark):
    rng = random.Random(8)
    z = [rng.gauss(0, 0.3) + (4 if 10 <= i < 17 else -4 if 17 <= i < 23 else 0) for i in range(40)]
    rows = [("S", "chr1", i, i * 10, i * 10 + 10, x, 1.0, 5.0 + x, 0 if i == 30 else 1) for i, x in enumerate(z)]
    bins = spark.createDataFrame(rows, "sample_id string, chrom string, bin_index bigint, start_pos bigint, end_pos bigint, robust_z double, calling_weight double, normalized_signal double, calling_seed_eligible int")
    states = calling.segment_states(calling.segment_series(bins), bins)
    marked = {r.bin_index: r.hmm_state for r in calling.with_hmm_state(bins, states).collect()}
    assert marked == {i: "gain" if 10 <= i < 17 else "loss" if 17 <= i < 23 else "neutral" for i in range(40)}
    events = {(r.event_id, r.start_bin, r.end_bin, r.n_bins) for r in calling.segment_events(bins, states=states).collect()}
    assert events == {("S.chr1_block1_merged1.gain", 10, 16, 7), ("S.chr1_block1_merged2.loss", 17, 22, 6)}


def test_no_seed_block_gives_no_segment(spark):
    rows = [("S", "chr1", i, i * 10, i * 10 + 10, 1.0, 1.0, 5.0, int(i % 4 > 0)) for i in range(20)]
    bins = spark.createDataFrame(rows, "sample_id string, chrom string, bin_index bigint, start_pos bigint, end_pos bigint, robust_z double, calling_weight double, normalized_signal double, calling_seed_eligible int")
    assert calling.segment_series(bins).count() == 0 and calling.segment_events(bins).count() == 0


def best_path(z, shift, stay):
    """The best of all paths, by trying each; ties go to the earlier state from the end backwards."""
    import itertools

    mean = sum(z) / len(z)
    sigma = max(math.sqrt(sum((x - mean) ** 2 for x in z) / len(z)), 1.0)

    def score(path):
        moves = sum(math.log(stay) if a == b else math.log((1 - stay) / 2) for a, b in zip(path, path[1:]))
        return moves - sum((x - shift * (s - 1)) ** 2 / (2 * sigma * sigma) for x, s in zip(z, path))

    return max(itertools.product(range(3), repeat=len(z)), key=lambda p: (round(score(p), 9), [-s for s in reversed(p)]))


def test_viterbi_is_the_best_of_all_paths(spark):
    rng = random.Random(6)
    series_ = {f"S{k}": [rng.choice([0.0, 1.0, -1.0, 2.5, rng.gauss(0, 2)]) for _ in range(rng.randint(1, 6))] for k in range(25)}
    rows = [(s, "chr1", i, z) for s, zs in series_.items() for i, z in enumerate(zs)]
    got = {r.sample_id: r.path for r in calling.viterbi_states(spark.createDataFrame(rows, "sample_id string, chrom string, left_bin int, mean_z double"), shift=1.0, stay=0.6).collect()}
    assert got == {s: [("loss", "neutral", "gain")[i] for i in best_path(z, 1.0, 0.6)] for s, z in series_.items()}


NULL = "sample_id string, chrom string, bin_index bigint, robust_z double, hmm_state string, null_eligible int"


@pytest.mark.parametrize(("case", "size"), [("neutral", 6), ("between quantiles", 8), ("all", 12)])
def test_tiers_of_the_null(spark, case, size):
    state = lambda i: "neutral" if case == "neutral" and i < 6 else "gain"
    rows = [("S", "chr1", i, float(i), state(i), int(i < 10 and case != "all") if case != "all" else 0) for i in range(12)]
    least = {"neutral": 5, "between quantiles": 8, "all": 11}[case]
    r = calibrate.empirical_null(spark.createDataFrame(rows, NULL), least).first()
    want = {"neutral": range(6), "between quantiles": range(1, 9), "all": range(12)}[case]
    assert r.n_null == size == len(want) and r.null_median == median(want)


def test_tiers_of_the_baseline(spark):
    kind = "sample_id string, chrom string, normalized_signal double, hmm_state string, null_eligible int, region_risk_class string"
    rows = [(s, "chr1", float(i), "neutral" if i < 6 else "gain", int(i < 8), "clean" if i < 3 else "moderate") for s in ("a",) for i in range(10)] + [("a", "chrX", 99.0, "neutral", 1, "clean")]
    table = spark.createDataFrame(rows, kind)
    for least, want in ((3, (1.0, 3)), (5, (2.5, 6)), (9, (4.5, 10))):
        r = calibrate.neutral_baseline(table, least=least).first()
        assert (r.baseline, r.n_baseline) == want


def test_variance_of_equal_values_is_zero(spark):
    from binlattice.functions.stats import weighted_stats

    rows = [("a", 0.1, 0.3)] * 7 + [(None, 5.0, 1.0), (None, 7.0, 1.0), ("b", None, 1.0), ("c", 1e9, 1.0), ("c", 1e9 + 1, 1.0)]
    got = {r.k: r for r in weighted_stats(spark.createDataFrame(rows, "k string, x double, w double"), "x", "w", ["k"]).collect()}
    assert got["a"].weighted_std < 1e-15 and (got[None].weighted_mean, got[None].weighted_std) == (6.0, 1.0) and got["c"].weighted_std == 0.5
    assert got["b"].weighted_mean is None and got["b"].effective_sample_size == 0.0


def test_reads_that_do_not_count(spark):
    kind = "sample_id string, chrom string, pos bigint, mapq int, is_duplicate boolean, is_secondary boolean, is_supplementary boolean, is_unmapped boolean, is_qcfail boolean, is_paired boolean, is_read1 boolean"
    good = ("S", "chr1", 5, 40, False, False, False, False, False, False, False)
    change = lambda i, x: tuple(x if k == i else v for k, v in enumerate(good))
    rows = [good, change(9, True), change(9, True)[:10] + (True,), change(2, -5), change(3, 29), *[change(i, True) for i in range(4, 9)], ("T", *change(7, True)[1:])]
    bins = grid.make_bin_grid(spark.createDataFrame([("chr1", 20)], "chrom string, length bigint"), 10, "x")
    got = {(r.sample_id, r.bin_index): r.raw_count for r in grid.count_fragments(spark.createDataFrame(rows, kind), bins, 10).collect()}
    assert got == {("S", 0): 2, ("S", 1): 0, ("T", 0): 0, ("T", 1): 0}


def test_intervals_of_all_lengths_meet_once(spark):
    rng = random.Random(12)
    some = lambda n: [(f"chr{rng.randint(1, 2)}", a, a + rng.choice([0, 1, 5, 100, 900, 20_000, 300_000, 5_000_000, 250_000_000])) for a in (rng.randrange(0, 250_000_000 if i % 3 else 3_000) for i in range(n))]
    x, y = some(150), some(150)
    left = spark.createDataFrame([(*r, i) for i, r in enumerate(x)], "chrom string, start_pos bigint, end_pos bigint, i int")
    right = spark.createDataFrame([(*r, i) for i, r in enumerate(y)], "chrom string, r_start bigint, r_end bigint, j int")
    want = sorted((i, j) for i, a in enumerate(x) for j, b in enumerate(y) if a[0] == b[0] and a[1] < b[2] and b[1] < a[2] and a[1] < a[2] and b[1] < b[2])
    for bucket in (10, 30_000):
        met = grid.overlap_join(left, right, bucket)
        assert set(met.columns) == {"chrom", "start_pos", "end_pos", "r_start", "r_end", "i", "j"}
        assert sorted((r.i, r.j) for r in met.collect()) == want
    long = spark.createDataFrame([("chr1", 0, 250_000_000, 4)], "chrom string, r_start bigint, r_end bigint, __own int")
    assert grid._dealt(long, "r_start", "r_end", 30_000).count() <= 2


def test_order_over_ranges(spark):
    from binlattice.functions.ordering import numbered, with_next
    from binlattice.operators.evaluate import largest_gap_cutoff

    rng = random.Random(3)
    values = [rng.choice([1.0, 2.5, rng.uniform(0, 50)]) for _ in range(400)]
    table = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(7)
    placed = numbered(table.where("v IS NOT NULL"), [F.col("v")], "place")
    assert [(r.place, r.v) for r in placed.orderBy("place").collect()] == list(enumerate(sorted(values), 1))
    assert sorted((r.v, r.y) for r in with_next(table, "v", "y").where("y IS NOT NULL").collect()) == list(zip(sorted(values), sorted(values)[1:]))
    gap, low = max((b - a, -a) for a, b in zip(sorted(values), sorted(values)[1:]))
    found = largest_gap_cutoff(table, "v").first()
    assert found.gap == gap and found.cutoff == pytest.approx(-low + gap / 2)
    assert largest_gap_cutoff(table.where("v = 1"), "v").count() == 0


def test_digest_is_that_of_a_multiset(spark):
    from binlattice.operators.cohort import table_digest

    kind = "a int, b string, c double"
    digest = lambda rows, kind=kind: spark.createDataFrame(rows, kind).agg(table_digest(spark.createDataFrame([], kind))).first()[0]
    rows = [(1, "x", 0.5), (2, None, None), (1, "x", 0.5)]
    assert digest(rows) == digest(rows[::-1]) != digest(rows[:2]) and digest([]) == "0-0"
    assert digest([(1, "x", 0.5)]) != digest([(1, None, 0.5)]) != digest([(1, "", 0.5)])
    assert digest([(1, "x", 0.5)]) == digest([(0.5, 1, "x")], "c double, a int, b string")


def test_letters_that_grow_in_upper_case_move_no_base(spark):
    """ß, ŉ and ﬆ are two letters in upper case; places and counts are those of the text as it is."""
    places = grid.make_bin_grid(spark.createDataFrame([("chr1", 20)], "chrom string, length bigint"), 10, "x")
    chunks = spark.createDataFrame([("chr1", 0, "ßAcgtNacgtCC ŉﬆ")], "chrom string, chunk_start bigint, seq string")
    got = {r.bin_index: [r.n_a, r.n_c, r.n_g, r.n_t, r.n_n] for r in grid.base_composition(chunks, places, 10).collect()}
    assert got == {0: [2, 2, 2, 2, 1], 1: [0, 2, 0, 0, 0]}


def _counted(spark, table):
    """(the table, an accumulator of the rows of it that were read)"""
    n = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            n.add(len(b))
            yield b

    return table.mapInPandas(seen, table.schema), n


@pytest.mark.parametrize("widths", [(90_000,), (100,), (90_000, 100, 5_000_000)])
def test_interval_joins_read_a_side_for_its_levels_and_once_more(spark, widths):
    rng = random.Random(7)
    x = [(f"chr{i % 2}", i * 90_000, i * 90_000 + widths[i % len(widths)], i) for i in range(40)]
    y = [(f"chr{rng.randrange(2)}", a, a + rng.choice([100, 400, 60_000]), j) for j, a in enumerate(rng.randrange(0, 3_600_000) for _ in range(60))]
    left = spark.createDataFrame(x, "chrom string, start_pos bigint, end_pos bigint, i int")
    right, n = _counted(spark, spark.createDataFrame(y, "chrom string, r_start bigint, r_end bigint, j int"))
    got = sorted((r.i, r.j) for r in grid.overlap_join(left, right, 30_000).collect())
    assert got == sorted((a[3], b[3]) for a in x for b in y if a[0] == b[0] and a[1] < b[2] and b[1] < a[2])
    assert n.value <= 2 * len(y)


def test_alignments_are_read_once(spark):
    kind = "sample_id bigint, chrom bigint, pos bigint, mapq int, is_duplicate boolean, is_secondary boolean, is_supplementary boolean, is_unmapped boolean, is_qcfail boolean, is_paired boolean, is_read1 boolean"
    good = (40, False, False, False, False, False, False, False)
    rows = [(1, 0, 5, *good), (1, 0, None, *good), (1, 0, -3, *good), (2, 0, 5, 40, None, *good[2:]), (-3, 1, 15, *good), (None, 1, 15, *good)]
    table, n = _counted(spark, spark.createDataFrame(rows, kind))
    bins = grid.make_bin_grid(spark.createDataFrame([(0, 10), (1, 20)], "chrom bigint, length bigint"), 10, "x")
    got = {(r.sample_id, r.chrom, r.bin_index): r.raw_count for r in grid.count_fragments(table, bins, 10).collect()}
    ones = {(1, 0, 0), (-3, 1, 1)}
    assert got == {(s, c, b): int((s, c, b) in ones) for s in (1, 2, -3, None) for c, b in ((0, 0), (1, 0), (1, 1))}
    assert n.value == len(rows)


def test_letters_are_counted_by_the_bytes_of_a_batch(spark):
    """A text is read once for all letters, and not copied for each; long texts, slices of a batch, empty texts and other alphabets are counted alike."""
    texts = ["AaCcGgTtNn", "", "ßÁçñŉ—acgt", "Áñ" * 3, "aN" * 700_000, "x", "Kg"]
    batch = pa.RecordBatch.from_pydict({"chrom": [str(i) for i in range(7)], "bin_index": list(range(7)), "piece": texts})
    for part in (batch, batch.slice(2, 4), batch.slice(0, 0)):
        (got,) = grid._letter_counts([part])
        assert [list(r.values())[2:] for r in got.to_pylist()] == [[t.count(b) + t.count(b.lower()) for b in "ACGTN"] for t in part.column("piece").to_pylist()]
    chunks = spark.createDataFrame([("chr1", 0, "acgt")], "chrom string, chunk_start bigint, seq string")
    plan = grid.base_composition(chunks, grid.make_bin_grid(spark.createDataFrame([("chr1", 20)], "chrom string, length bigint"), 10, "x"), 10)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "replace(" not in plan


def test_shares_of_all_classes_come_from_one_aggregation(spark):
    """Also by numbers of chromosomes; a class without intervals is 0, one that isn't asked for doesn't count."""
    bins = spark.createDataFrame([(7, 0, 100), (7, 100, 200), (8, 0, 100)], "chrom bigint, start_pos bigint, end_pos bigint")
    places = [(7, 90, 120, "a"), (7, 95, 120, "a"), (7, 0, 300, "b"), (7, 0, 50, None), (8, 0, 50, "c"), (None, 0, 50, "a")]
    found = grid.overlap_fraction(bins, spark.createDataFrame(places, "chrom bigint, start_pos bigint, end_pos bigint, region_class string"), 30_000, ["a", "b", "z"])
    assert "pivotfirst" not in found._jdf.queryExecution().toString().lower()
    assert sorted(tuple(r) for r in found.collect()) == [(7, 0, 100, 0.15, 1.0, 0.0), (7, 100, 200, 0.4, 1.0, 0.0), (8, 0, 100, 0.0, 0.0, 0.0)]
    assert dict(adapters._numbered_intervals(spark, "/root/testdata/sf0.001").dtypes)["chrom"] == "bigint"
