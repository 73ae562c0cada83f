"""Tables over samples: cohorts of references, ranks, diagnoses, quality events and their roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from binlattice.functions.ordering import numbered
from binlattice.functions.stats import over
from binlattice.operators.report import decision_rank
from binlattice.sources.ingest import natural_sort_key

#: What a sample that is not PASS is diagnosed with.
DIAGNOSES = {
    "dna": "更偏向样本DNA/染色体组成异常",
    "library": "更偏向建库/扩增波动",
    "noise": "更偏向文库噪声，暂不能排除上游DNA因素",
}


def reference_sample_table(metrics: DataFrame, targets: DataFrame) -> DataFrame:
    """For each target all other samples with their fragments, bins and share of zero bins; as large as targets times samples."""
    other = metrics.select(F.col("sample_id").alias("ref_sample_id"), "mapped_fragments", F.col("n_bins").alias("usable_bins"), F.col("zero_fraction").alias("zero_bin_fraction"))
    return targets.select("sample_id").join(other, F.col("sample_id") != F.col("ref_sample_id"))


def rank_samples_by_decision(rows: DataFrame) -> DataFrame:
    """rows with decision_rank and place: PASS, WARN, FAIL, others, then natural order of ids; a sample with two rows is an error."""
    per = F.count("*").over(over(["sample_id"]))
    once = rows.withColumn("decision_rank", F.when(per == 1, decision_rank(F.upper("qc_decision"))).otherwise(F.raise_error(F.concat(F.lit("more than one row for sample "), "sample_id")).cast("int")))
    return numbered(once, [F.col("decision_rank"), natural_sort_key(F.col("sample_id")), F.col("sample_id")], "place")


def split_retained_outliers(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(PASS, all others); a missing decision is no PASS."""
    keep = F.coalesce(F.upper("qc_decision") == "PASS", F.lit(False))
    return rows.where(keep), rows.where(~keep)


def batch_decision_distribution(rows: DataFrame, medians: list[str]) -> DataFrame:
    count = lambda d: F.count_if(F.upper("qc_decision") == d).alias(f"n_{d.lower()}")
    return rows.groupBy("batch_group").agg(F.count("*").alias("n_samples"), *[count(d) for d in ("PASS", "WARN", "FAIL")], *[F.median(c).alias(f"median_{c}") for c in medians])


def profile_chromosome_summary(profile: DataFrame, keys: list[str], z: str = "z") -> DataFrame:
    """Median |z|, the largest |median z| of a chromosome, the share of chromosomes at 1 or more, and the three largest by name."""
    chrom = profile.groupBy(*keys, "chrom").agg(F.abs(F.median(z)).alias("m"))
    ranked = chrom.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("m"), "chrom")))
    top = ranked.groupBy(*keys).agg(
        F.max("m").alias("max_chrom_abs_median_z"), F.avg((F.col("m") >= 1).cast("double")).alias("broad_noise_fraction"), *[F.coalesce(F.max(F.when(F.col("r") == i, F.col("chrom"))), F.lit("")).alias(f"top_chr_{i}") for i in (1, 2, 3)]
    )
    return profile.groupBy(*keys).agg(F.median(F.abs(z)).alias("global_median_abs_z")).join(top, keys)


def join_sample_metrics(samples: DataFrame, library: DataFrame, flagstat: DataFrame, bias: DataFrame, profile: DataFrame, label: str = "1mb") -> DataFrame:
    """samples with all metrics, of the profiles those of one bin label, and five rates; a rate over 0 or null is null."""
    out = samples
    for part in (library, flagstat, bias, profile.where(F.col("bin_label") == label).drop("bin_label")):
        out = out.join(part, "sample_id", "left")
    rates = {
        "clean_read_rate": ("clean_reads", "raw_reads"),
        "mapping_rate": ("mapped_reads", "total_reads"),
        "proper_pair_rate": ("properly_paired_reads", "paired_reads"),
        "singleton_rate": ("singleton_reads", "paired_reads"),
        "diff_chr_rate": ("mate_diff_chr_reads", "paired_reads"),
    }
    return out.withColumns({name: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")) for name, (a, b) in rates.items()})


def diagnose_failed_samples(metrics: DataFrame) -> DataFrame:
    """Samples whose worst decision is not PASS, with one of DIAGNOSES.

    Insert peak and duplication are held against the median and MAD of the stably retained samples, or of those with
    PASS where there is none. A missing value is never high; a missing rate is never good.
    """
    stable = F.coalesce(F.col("stable_retained").cast("int"), F.lit(0)) == 1
    passed = F.col("worst_decision") == "PASS"
    held = ("insert_peak", "duplication_rate")
    # one row each for the cohort
    middles = metrics.agg((F.max(stable.cast("int")) == 1).alias("__any"), *[F.median(F.when(group, F.col(c))).alias(f"__{k}_{c}") for c in held for k, group in (("s", stable), ("p", passed))])
    middles = middles.select("__any", *[F.when(F.col("__any"), F.col(f"__s_{c}")).otherwise(F.col(f"__p_{c}")).alias(f"__m_{c}") for c in held])
    marked = metrics.crossJoin(F.broadcast(middles)).withColumn("__in", F.when(F.col("__any"), stable).otherwise(passed))
    spreads = marked.agg(*[F.median(F.when(F.col("__in"), F.abs(F.col(c) - F.col(f"__m_{c}")))).alias(f"__d_{c}") for c in held])
    marked = marked.crossJoin(F.broadcast(spreads))
    yes = lambda c: F.coalesce(c, F.lit(False))
    dup = yes(F.col("duplication_rate") - F.col("__m_duplication_rate") > F.greatest(F.lit(0.01), 3 * F.col("__d_duplication_rate")))
    insert = yes(F.abs(F.col("insert_peak") - F.col("__m_insert_peak")) > F.greatest(F.lit(25.0), 3 * F.col("__d_insert_peak")))
    bias, peak = yes(F.col("max_chr_fraction_dev_z") >= 4), yes(F.col("max_chrom_abs_median_z") >= 1.8)
    mapping, pair = yes(F.col("mapping_rate") >= 0.985), yes(F.col("proper_pair_rate") >= 0.96)
    noise = yes(F.col("broad_noise_fraction") >= 0.25)
    kind = F.when(bias & peak & mapping & pair & ~dup & ~insert, DIAGNOSES["dna"]).when(noise | dup | insert | ~mapping | ~pair, DIAGNOSES["library"]).otherwise(DIAGNOSES["noise"])
    out = marked.withColumn("diagnosis", kind).where(F.col("worst_decision") != "PASS")
    return out.select("sample_id", "worst_decision", *[c for c in ("fail_count", "warn_count") if c in metrics.columns], "diagnosis").orderBy(F.desc("worst_decision"), *[F.desc(c) for c in ("fail_count",) if c in metrics.columns], "sample_id")


def qc_events(summary: DataFrame, profile: DataFrame, mask: DataFrame) -> DataFrame:
    """(sample_id, event_type, status, detail): a sample without a profile is a no-call and has no other event.

    ``summary`` has spearman and median_abs_z, ``profile`` z by sample and bin, ``mask`` labels by bin.
    """
    masked = mask.where("mask_label <> 'pass'").select("chrom", "bin_index", F.lit(1).alias("__masked"))
    joined = profile.join(masked, ["chrom", "bin_index"], "left")
    share = joined.groupBy("sample_id").agg(F.avg(F.coalesce("__masked", F.lit(0))).alias("masked_fraction"))
    chrom = profile.groupBy("sample_id", "chrom").agg(F.abs(F.median("z")).alias("m")).groupBy("sample_id").agg(F.max("m").alias("shift"), F.max_by("chrom", F.struct("m", "chrom")).alias("top"))
    rows = summary.join(share, "sample_id", "left").join(chrom, "sample_id", "left")
    here = F.col("masked_fraction").isNotNull()

    def event(kind: str, status: Column, detail: Column) -> Column:
        return F.when(status.isNotNull(), F.struct(F.lit(kind).alias("event_type"), status.alias("status"), detail.alias("detail")))

    level = lambda c, review, fail: F.when(here & (F.col(c) >= fail), "fail").when(here & (F.col(c) >= review), "review")
    r = F.col("spearman")
    found = F.array(
        event("profile_missing", F.when(~here, "no-call"), F.lit("profile_tsv_missing")),
        event("correlation_drop", F.when(here & (r < 0.83), "fail").when(here & (r < 0.90), "review"), F.format_string("spearman_r=%.4f", r)),
        event("broad_noise", level("median_abs_z", 1.0, 1.5), F.format_string("median_abs_z=%.4f", "median_abs_z")),
        event("masked_bin_burden", level("masked_fraction", 0.10, 0.20), F.format_string("masked_fraction=%.4f", "masked_fraction")),
        event("chromosome_shift_hint", level("shift", 2.5, 4.0), F.format_string("%s median_abs_z=%.4f", "top", "shift")),
    )
    return rows.select("sample_id", F.inline(F.array_compact(found)))


def bin_qc_status(bins: DataFrame) -> DataFrame:
    """bins with qc_status by mask: soft and dynamic are review, hard is no-call, others and none pass."""
    label = F.coalesce("mask_label", F.lit("pass"))
    return bins.withColumn("qc_status", F.when(label.isin("soft", "dynamic"), "review").when(label == "hard", "no-call").otherwise("pass"))


def escalate_sample_status(summary: DataFrame, events: DataFrame) -> DataFrame:
    """(sample_id, status): of the decision, an unknown one being review; then any no-call event, review over pass, and fail over all."""
    has = lambda s: F.coalesce(F.bool_or(F.col("status") == s), F.lit(False)).alias(f"has_{s.replace('-', '_')}")
    flags = events.groupBy("sample_id").agg(has("fail"), has("review"), has("no-call"))
    base = F.create_map(*[F.lit(x) for x in ("PASS", "pass", "WARN", "review", "FAIL", "fail")])
    own = F.coalesce(F.try_element_at(base, F.upper("qc_decision")), F.lit("review"))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    status = F.when(yes("has_fail"), "fail").when(yes("has_no_call"), "no-call").when(yes("has_review") & (own == "pass"), "review").otherwise(own)
    return summary.join(flags, "sample_id", "left").select("sample_id", status.alias("status"))


def run_rollup(samples: DataFrame, bins: DataFrame, events: DataFrame) -> DataFrame:
    """One row: samples, bins and events by status, and the run's status."""
    n = lambda c, s, name: F.count_if(F.col(c) == s).alias(name)
    one = samples.agg(F.count("*").alias("sample_count"), *[n("status", s, f"{s.replace('-', '_')}_count") for s in ("pass", "review", "fail", "no-call")])
    two = bins.agg(*[n("qc_status", s, f"bin_{s.replace('-', '_')}_count") for s in ("pass", "review", "no-call")])
    rolled = one.crossJoin(two).crossJoin(events.agg(F.count("*").alias("event_count")))  # one row each
    return rolled.withColumn("status", F.when(F.col("fail_count") > 0, "fail").when(F.col("review_count") > 0, "review").otherwise("pass"))


def top_external_event(samples: DataFrame, events: DataFrame) -> DataFrame:
    """Per sample the number of events and the one of largest |zscore|, then largest end, as text; none is 0 and an empty text."""
    text = F.format_string("chr%s:%d-%d %s", "chrom", "start_pos", "end_pos", "kind")
    per = events.groupBy("sample_id").agg(F.count("*").alias("event_count"), F.max_by(text, F.struct(F.abs("zscore"), "end_pos", text)).alias("top_event"))
    return samples.select("sample_id").join(per, "sample_id", "left").select("sample_id", F.coalesce("event_count", F.lit(0)).alias("event_count"), F.coalesce("top_event", F.lit("")).alias("top_event"))


def route_reference(calls: DataFrame, references: DataFrame) -> DataFrame:
    """calls with the reference of their sex (XX or XY, anything else is an error) and the gender: the given F or M, else that of the sex."""
    sex = F.upper(F.trim("sex_call"))
    checked = F.when(sex.isin("XX", "XY"), sex).otherwise(F.raise_error(F.concat(F.lit("no reference for sex "), F.coalesce(sex, F.lit("none")))).cast("string"))
    gender = F.upper(F.trim("predict_gender")) if "predict_gender" in calls.columns else F.lit(None).cast("string")
    out = calls.withColumn("sex_call", checked).withColumn("gender", F.when(gender.isin("F", "M"), gender).when(F.col("sex_call") == "XX", "F").otherwise("M"))
    return out.join(references.select("sex_call", "reference"), "sex_call", "left")
