"""Rules that sort calibrated events into pass, review and artifact, with a priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binlattice.functions.stats import clean
from binlattice.operators.grid import overlap_bp, overlap_join

OVERLAPS = ["par", "xtr", "sex_homology", "segmental_duplication", "low_mappability", "repeat_rich", "gap_centromere_telomere", "blacklist", "ambiguous_alignment"]


def par_overlap(events: DataFrame, regions: DataFrame, bucket: int = 1_000_000) -> DataFrame:
    """Base pairs of each event in the regions, summed, and their share of its length."""
    right = regions.select("chrom", F.col("start_pos").alias("r_start"), F.col("end_pos").alias("r_end"))
    met = overlap_join(events.select("event_id", "chrom", "start_pos", "end_pos"), right, bucket).groupBy("event_id").agg(F.sum(overlap_bp()).alias("bp"))
    bp = F.coalesce("bp", F.lit(0))
    span = F.greatest(F.col("end_pos") - F.col("start_pos"), F.lit(1))
    return events.join(met, "event_id", "left").withColumn("par_bp", bp).withColumn("par_fraction", bp / span).drop("bp")


def _inputs(events: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(clean(c), F.lit(0.0))
    size = lambda *cs: F.greatest(F.lit(0.0), *[F.abs(clean(c)) for c in cs])
    df = events.withColumn("r_z", size("calibrated_mean_z", "calibrated_median_z", "event_corr_adjusted_z"))
    df = df.withColumn("r_support", F.greatest("r_z", size("segment_mean_robust_z", "segment_median_robust_z", "segment_abs_max_robust_z")))
    df = df.withColumns({"r_clean": zero("clean_bin_fraction"), "r_high": zero("high_risk_bin_fraction"), "r_mean": zero("region_risk_score_mean"), "r_max": zero("region_risk_score_max"), "r_q": clean("empirical_qvalue")})
    df = df.withColumn("r_moderate", F.coalesce(clean("moderate_risk_bin_fraction"), F.greatest(F.lit(0.0), 1 - F.col("r_clean") - F.col("r_high"))))
    df = df.withColumn("r_ess", F.coalesce(clean("effective_bin_count"), F.col("n_bins").cast("double"))).withColumn("r_part", F.col("n_bins") / F.greatest("chrom_bins", F.lit(1)))
    df = df.withColumns({f"o_{c}": zero(f"{c}_overlap_fraction") if f"{c}_overlap_fraction" in events.columns else F.lit(0.0) for c in OVERLAPS})
    df = df.withColumn("r_overlap", F.greatest(*[f"o_{c}" for c in OVERLAPS]))
    sure = F.coalesce(F.col("r_q") <= 0.25, F.lit(True))
    enough = F.col("r_clean") + 0.5 * F.col("r_moderate") >= 0.5
    bare = F.greatest(*[f"o_{c}" for c in OVERLAPS if c != "segmental_duplication"]) == 0
    return df.withColumns(
        {
            "broad": (F.col("r_part") > 0.35) & (F.col("r_support") >= 4) & (F.col("r_ess") >= 10) & (F.col("r_clean") >= 0.3) & sure,
            "tidy": (F.col("r_support") >= 4) & enough & (F.col("r_high") < 0.2) & (F.col("r_overlap") <= 0.15) & (F.col("r_max") <= 0.35) & sure,
            "focal": (F.col("r_part") <= 0.1) & (F.col("r_support") >= 6) & enough & (F.col("r_high") <= 0.05) & (F.col("r_overlap") <= 0.25) & (F.col("r_max") <= 0.2) & bare & sure,
        }
    )


def _rules() -> list[tuple[str | None, Column, Column | bool, str | None, str | None]]:
    """(flag, condition, hard, downgrade reason, filter reason) in order; a rule whose condition holds is hard where ``hard`` holds.

    With a condition for ``hard`` the filter reason goes with hard, the downgrade reason with the rest.
    """
    c, part, z, high = F.col, F.col("r_part"), F.col("r_z"), F.col("r_high")
    sex = c("chrom").isin("chrX", "chrY")
    known = F.coalesce(c("sex_call").isin("XX", "XY"), F.lit(False))
    # Names of flags and reasons.
    return [
        ("too_few_bins", c("n_bins") < 3, True, None, "bin_count_below_minimum"),
        ("low_calibrated_signal", z < 2, True, None, "signal_support_below_minimum"),
        ("broad_chrom_fraction", (part > 0.35) & sex & known, False, "broad_sex_chromosome_event", None),
        ("broad_chrom_fraction", (part > 0.35) & ~(sex & known) & c("broad"), False, "broad_event_preserved_by_internal_support", None),
        ("broad_chrom_fraction", (part > 0.35) & ~(sex & known) & ~c("broad"), True, None, "chromosome_fraction_too_large"),
        ("edge_event", (c("start_bin") <= 2) | (c("chrom_bins") - c("end_bin") - 1 <= 2), False, "chromosome_edge_contact", None),
        ("weak_empirical_support", c("r_q") > 0.25, False, "empirical_qvalue_above_threshold", None),
        ("sex_chromosome_event", sex, False, None, None),
        ("par_overlap", c("par_bp") > 0, False, "par_overlap", None),
        ("mixed_par_nonpar", (c("par_fraction") > 0) & (c("par_fraction") < 1), False, "mixed_par_nonpar_boundary", None),
        ("xx_chrY_unexpected_signal", (c("sex_call") == "XX") & (c("chrom") == "chrY"), True, None, "xx_sample_with_chrY_signal"),
        (None, (c("sex_call") == "XY") & (c("chrom") == "chrY"), False, "xy_chrY_default_review", None),
        ("xtr_overlap", c("o_xtr") > 0, False, "xtr_overlap", None),
        ("sex_homology_overlap", c("o_sex_homology") >= 0.1, False, "sex_homology_overlap", None),
        ("segmental_duplication_overlap", c("o_segmental_duplication") >= 0.25, c("r_clean") < 0.5, "segmental_duplication_overlap", "segmental_duplication_overlap_with_limited_clean_support"),
        ("low_mappability_overlap", c("o_low_mappability") >= 0.25, False, "low_mappability_overlap", None),
        ("repeat_rich_overlap", c("o_repeat_rich") >= 0.25, False, "repeat_rich_overlap", None),
        ("gap_centromere_telomere_overlap", c("o_gap_centromere_telomere") > 0, False, "gap_centromere_telomere_overlap", None),
        ("blacklist_overlap", c("o_blacklist") > 0, True, None, "blacklist_region_overlap"),
        ("ambiguous_alignment_region", (c("o_ambiguous_alignment") >= 0.1) & (z < 4), True, "ambiguous_alignment_region", "ambiguous_alignment_with_non_high_confidence_signal"),
        ("ambiguous_alignment_region", (c("o_ambiguous_alignment") >= 0.1) & (z >= 4), False, "ambiguous_alignment_region", None),
        ("high_risk_region_burden", high >= 0.5, False, "high_risk_bin_fraction", None),
        ("clean_support_low", (c("r_clean") <= 0.2) & (high >= 0.5) & (z < 4), True, None, "clean_bin_support_too_low"),
        ("high_risk_boundary_crossing", c("high_risk_boundary_crossing") == 1, False, "high_risk_boundary_crossing", None),
    ]


#: What a rule says of an event, by the rule's downgrade reason, else its filter reason, else its flag; {} is a share of the event.
SAID = {
    "bin_count_below_minimum": "Event spans too few bins for a stable segment.",
    "signal_support_below_minimum": "Calibrated signal amplitude is below the minimum support threshold.",
    "broad_sex_chromosome_event": "Large sex-chromosome event requires sex-aware review.",
    "broad_event_preserved_by_internal_support": "Broad event is preserved for review because Branch B shows high-confidence chromosome-scale support.",
    "chromosome_fraction_too_large": "Event spans too much of one chromosome and is likely technical.",
    "chromosome_edge_contact": "Segment touches chromosome-edge bins and should be reviewed.",
    "empirical_qvalue_above_threshold": "Empirical null calibration indicates weak support.",
    "sex_chromosome_event": "Sex-chromosome event needs sex and PAR-aware interpretation.",
    "par_overlap": "Event overlaps a PAR interval ({} of event span).",
    "mixed_par_nonpar_boundary": "Event crosses PAR and non-PAR sequence.",
    "xx_sample_with_chrY_signal": "chrY signal in an XX-routed sample is treated as artifact.",
    "xy_chrY_default_review": "chrY event in XY-routed sample remains review-only by default.",
    "xtr_overlap": "Event overlaps XTR sequence ({}).",
    "sex_homology_overlap": "Event overlaps sex-chromosome homology sequence with elevated mapping ambiguity.",
    "segmental_duplication_overlap": "Event overlaps segmental duplication sequence.",
    "low_mappability_overlap": "Event overlaps low-mappability bins.",
    "repeat_rich_overlap": "Event overlaps repeat-rich sequence.",
    "gap_centromere_telomere_overlap": "Event overlaps gap / centromere / telomere-adjacent sequence.",
    "blacklist_region_overlap": "Event overlaps a blacklisted genomic region.",
    "ambiguous_alignment_region": "Event overlaps a high-risk ambiguous-alignment region.",
    "high_risk_bin_fraction": "High-risk bins cover {} of the event.",
    "clean_bin_support_too_low": "Event has limited clean-bin support relative to high-risk sequence burden.",
    "high_risk_boundary_crossing": "Event crosses a clean/high-risk boundary and should be manually reviewed.",
}
#: What is said after the rules, of weak edge events, of events that pass, and of those kept or not below the gate.
SAID_LAST = {
    "weak_edge": "Edge-only event priority is too low to keep for manual review.",
    "pass": "No explicit artifact rule was triggered.",
    "saved": "Low-risk event retains strong internal support but misses the ultra-pass gate, so it is kept for review.",
    "below": "Clean event did not meet the ultra-pass gate and is suppressed to control false positives.",
}
SHARES = {"par_overlap": "par_fraction", "xtr_overlap": "o_xtr", "high_risk_bin_fraction": "r_high"}


def _said(rule: str) -> Column:
    """The rule's sentence, with its share in percent to one decimal; half a tenth goes to the even digit."""
    if rule not in SHARES:
        return F.lit(SAID[rule])
    return F.format_string(SAID[rule].replace("{}", "%.1f%%"), F.bround(100 * F.col(SHARES[rule]), 1))


def artifact_flags(events: DataFrame) -> DataFrame:
    """Flags, downgrade and filter reasons and sentences as arrays in the order of the rules, with ``hard`` and ``review``.

    Needs chrom_bins, sex_call, par_bp and par_fraction; a sex chromosome or PAR overlap alone asks for no review.
    """
    flags, down, filters, said, hards, reviews = [], [], [], [], [], []
    for flag, holds, hard, soften, drop in _rules():
        holds = F.coalesce(holds, F.lit(False))
        split = isinstance(hard, Column)
        strict = holds & (hard if split else F.lit(hard))
        flags.append(F.when(holds, F.lit(flag)))
        down.append(F.when(holds & ~strict if split else holds, F.lit(soften)))
        filters.append(F.when(strict, F.lit(drop)))
        said.append(F.when(holds, _said(soften or drop or flag)))
        hards.append(strict)
        if soften and flag != "par_overlap":
            reviews.append(holds & ~strict)
    some = lambda xs: F.exists(F.array(*xs), lambda x: x)
    names = {"flags": flags, "downgrades": down, "filters": filters, "said": said}
    return _inputs(events).withColumns({k: F.array_distinct(F.array_compact(F.array(*v))) for k, v in names.items()} | {"hard": some(hards), "review": some(reviews)})


def priority_score(flagged: DataFrame) -> DataFrame:
    """Signal times ln(1 + effective bins), lowered by risk, by missing clean support and by q; with the difference these make."""
    penalty = 0.6 * F.col("r_high") + 0.25 * F.col("r_overlap") + 0.2 * F.col("r_mean") + 0.1 * F.col("r_max")
    base = F.col("r_z") * F.log1p(F.greatest("r_ess", F.lit(1.0)))
    score = base * F.greatest("r_clean", F.lit(0.1)) * F.greatest(F.lit(0.1), 1 - penalty) * F.coalesce(F.greatest(F.lit(0.0), 1 - F.col("r_q")), F.lit(1.0))
    return flagged.withColumn("priority_score", score).withColumn("priority_delta", score - base)


def classify_events(scored: DataFrame, keep_review: bool = True) -> DataFrame:
    """artifact_status, keep_event, confidence, class and reasons from the flags and the priority."""
    c = F.col
    weak_edge = ~c("hard") & c("review") & (F.array_size("flags") == 1) & F.array_contains("flags", "edge_event") & (c("priority_score") < 2)
    df = scored.withColumn("weak_edge", weak_edge).withColumn("filters", F.when(c("weak_edge"), F.array_append("filters", "edge_event_priority_below_keep_threshold")).otherwise(c("filters")))
    df = df.withColumn("hard", c("hard") | c("weak_edge")).withColumn("review", c("review") & ~c("weak_edge"))
    held = c("review") | (F.array_size("flags") > 0)
    ultra = (c("r_z") >= 15) & (c("r_ess") >= 8) & F.coalesce(c("r_q") <= 0.001, F.lit(True))
    df = df.withColumn("held", held).withColumn("below", ~c("hard") & ~held & ~ultra)
    held, below = c("held"), c("below")
    saved = below & (c("tidy") | c("focal"))
    df = df.withColumn("artifact_status", F.when(c("hard"), "artifact").when(held | saved, "review").when(ultra, "pass").otherwise("artifact"))
    df = df.withColumn("flags", F.when(below, F.array(F.lit("clean_event_below_ultra_pass"))).otherwise(c("flags")))
    why = F.when(c("focal") & ~c("tidy"), "focal_low_risk_event_preserved_below_ultra_pass").otherwise("low_risk_event_preserved_below_ultra_pass")
    df = df.withColumn("downgrades", F.when(saved, F.array_append("downgrades", why)).otherwise(c("downgrades"))).withColumn("filters", F.when(below & ~saved, F.array_append("filters", "clean_event_below_ultra_pass_gate")).otherwise(c("filters")))
    status, strong = c("artifact_status"), c("r_z") >= 4
    last = F.when(c("weak_edge"), SAID_LAST["weak_edge"]).when(saved, SAID_LAST["saved"]).when(below, SAID_LAST["below"]).when(status == "pass", SAID_LAST["pass"])
    return df.withColumns(
        {
            "keep_event": F.when(status == "pass", 1).when(status == "review", int(keep_review)).otherwise(0),
            "technical_confidence": F.when(status == "artifact", "rejected").when(status == "pass", "high").when(strong, "moderate").otherwise("low"),
            "report_class": F.when(status == "artifact", "technical_artifact").when(status == "pass", "candidate_pass").otherwise("candidate_review" if keep_review else "candidate_suppressed"),
            "artifact_flags": F.concat_ws(",", "flags"),
            "artifact_explanations": F.concat_ws(" ", "said", last),
            "retain_reason": F.when(status == "pass", "clean_support_and_statistical_support").otherwise(""),
            "downgrade_reason": F.concat_ws(";", "downgrades"),
            "filter_reason": F.concat_ws(";", "filters"),
            "manual_review_recommended": (c("review") | (F.array_size("downgrades") > 0)).cast("int"),
            "biological_context": F.when(c("chrom").isin("chrX", "chrY"), "sex_chromosome").otherwise("autosome"),
        }
    ).drop("flags", "downgrades", "filters", "said", "hard", "review", "weak_edge", "held", "below", "broad", "tidy", "focal", *[f"o_{x}" for x in OVERLAPS], *[f"r_{x}" for x in ("z", "support", "clean", "high", "mean", "max", "q", "moderate", "ess", "part", "overlap")])


def rank_events(classified: DataFrame, top: int = 5) -> DataFrame:
    """The first events of each sample: kept ones first, then by status, priority, bins and id."""
    w = Window.partitionBy("sample_id").orderBy(F.desc("keep_event"), "artifact_status", F.desc("priority_score"), F.desc("n_bins"), "event_id")
    return classified.withColumn("event_rank", F.row_number().over(w)).where(F.col("event_rank") <= top)


def artifact_summary(classified: DataFrame) -> DataFrame:
    return classified.groupBy("sample_id", "artifact_status").agg(F.count("*").alias("n_events"), F.sum("keep_event").alias("n_kept"), F.max("priority_score").alias("top_priority"))
