"""Tables over samples and the event classifier on small fixtures."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from binlattice.functions.ordering import numbered
from binlattice.operators import classifier
from binlattice.operators import sample_report as sr
from binlattice.sources.ingest import natural_sort_key


def test_rank_refuses_repeated_samples(spark):
    rows = spark.createDataFrame([("S10", "pass"), ("S2", "PASS"), ("S1", "FAIL"), ("S3", None)], "sample_id string, qc_decision string")
    assert [r["sample_id"] for r in sr.rank_samples_by_decision(rows).orderBy("place").collect()] == ["S2", "S10", "S1", "S3"]
    with pytest.raises(PySparkException):
        sr.rank_samples_by_decision(rows.union(rows)).collect()


def test_split_keeps_all(spark):
    rows = spark.createDataFrame([("a", "Pass"), ("b", None), ("c", "WARN")], "sample_id string, qc_decision string")
    kept, out = sr.split_retained_outliers(rows)
    assert [r["sample_id"] for r in kept.collect()] == ["a"] and sorted(r["sample_id"] for r in out.collect()) == ["b", "c"]


def test_fail_overrides_no_call(spark):
    summary = spark.createDataFrame([("a", "PASS"), ("b", "PASS"), ("c", "FAIL"), ("d", "odd"), ("e", "PASS"), ("f", "FAIL")], "sample_id string, qc_decision string")
    events = spark.createDataFrame([("a", "no-call"), ("a", "fail"), ("b", "review"), ("c", "review"), ("f", "no-call")], "sample_id string, status string")
    got = {r["sample_id"]: r["status"] for r in sr.escalate_sample_status(summary, events).collect()}
    assert got == {"a": "fail", "b": "review", "c": "fail", "d": "review", "e": "pass", "f": "no-call"}


def test_route_refuses_unknown_sex(spark):
    references = spark.createDataFrame([("XX", "x"), ("XY", "y")], "sex_call string, reference string")
    good = spark.createDataFrame([("a", "xx "), ("b", "XY")], "sample_id string, sex_call string")
    assert {(r["sample_id"], r["reference"], r["gender"]) for r in sr.route_reference(good, references).collect()} == {("a", "x", "F"), ("b", "y", "M")}
    for sex in ("ambiguous", None):
        with pytest.raises(PySparkException):
            sr.route_reference(spark.createDataFrame([("a", sex)], "sample_id string, sex_call string"), references).collect()


def test_diagnoses(spark):
    base = dict(worst_decision="PASS", stable_retained=1, fail_count=0, insert_peak=170.0, duplication_rate=0.1, max_chr_fraction_dev_z=1.0, max_chrom_abs_median_z=0.5, mapping_rate=0.99, proper_pair_rate=0.97, broad_noise_fraction=0.1)
    bad = base | {"worst_decision": "FAIL", "stable_retained": 0}
    rows = [base | {"sample_id": f"p{i}"} for i in range(3)]
    rows += [bad | {"sample_id": "dna", "max_chr_fraction_dev_z": 5.0, "max_chrom_abs_median_z": 2.0}, bad | {"sample_id": "dup", "duplication_rate": 0.2}, bad | {"sample_id": "noise"}, bad | {"sample_id": "gone", "mapping_rate": None}]
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'int' if isinstance(v, int) else 'double'}" for k, v in rows[0].items())
    got = {r["sample_id"]: r["diagnosis"] for r in sr.diagnose_failed_samples(spark.createDataFrame([tuple(r[k] for k in rows[0]) for r in rows], schema)).collect()}
    assert got == {"dna": sr.DIAGNOSES["dna"], "dup": sr.DIAGNOSES["library"], "noise": sr.DIAGNOSES["noise"], "gone": sr.DIAGNOSES["library"]}


def test_diagnoses_take_no_window_over_all_samples(spark):
    columns = "sample_id string, worst_decision string, stable_retained int, insert_peak double, duplication_rate double, max_chr_fraction_dev_z double, max_chrom_abs_median_z double, mapping_rate double, proper_pair_rate double, broad_noise_fraction double"
    good = [(f"p{i}", "PASS", None, 170.0 + i, 0.1, 1.0, 0.5, 0.99, 0.97, 0.1) for i in range(5)]
    table = spark.createDataFrame([*good, ("dup", "FAIL", None, 172.0, 0.2, 1.0, 0.5, 0.99, 0.97, 0.1), ("far", "WARN", 0, 210.0, 0.1, 1.0, 0.5, 0.99, 0.97, 0.1)], columns)
    out = sr.diagnose_failed_samples(table)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["sample_id"]: r["diagnosis"] for r in out.collect()} == {"dup": sr.DIAGNOSES["library"], "far": sr.DIAGNOSES["library"]}


def test_natural_places_number_all_rows_by_ranges(spark):
    names = [f"{'ab'[i % 2]}-{i * 7919 % 3001}" for i in range(3000)] + [None, ""]
    out = numbered(spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string").repartition(5), [natural_sort_key(F.col("name"))], "place").collect()
    want = sorted((n for n in names if n), key=lambda n: (n[0], int(n[2:])))
    assert [r["name"] for r in sorted(out, key=lambda r: r["place"])] == [None, "", *want]
    assert sorted(r["place"] for r in out) == list(range(1, len(names) + 1))


def test_top_external_event(spark):
    events = spark.createDataFrame([("a", "1", 10, 20, "gain", 3.0), ("a", "2", 10, 30, "loss", -3.0)], "sample_id string, chrom string, start_pos bigint, end_pos bigint, kind string, zscore double")
    samples = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    assert sorted(map(tuple, sr.top_external_event(samples, events).collect())) == [("a", 2, "chr2:10-30 loss"), ("b", 0, "")]


def test_features_of_bare_events(spark):
    rows = classifier.event_features(spark.createDataFrame([("e", "s", "chrX", "gain", 0, 4, None)], "event_id string, sample_id string, chrom string, state string, start_bin int, end_bin int, artifact_flags string")).collect()
    r = rows[0]
    assert (r["chrom_fraction"], r["is_gain"], r["is_autosome"], r["flag_count"], r["n_bins"]) == (1.0, 1.0, 0.0, 0.0, None)


def test_fold_metrics(spark):
    rng = np.random.default_rng(0)
    y, s = rng.integers(0, 2, 80), rng.integers(0, 12, 80) / 11
    rows = [(0, float(a), float(b)) for a, b in zip(y, s)] + [(1, 1.0, 0.2)]
    got = {r["fold"]: r for r in classifier.fold_metrics(spark.createDataFrame(rows, "fold int, label double, y_score double")).collect()}
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in s[y == 1] for q in s[y == 0]])
    cuts = sorted(set(s), reverse=True)
    tp = np.array([((s >= c) & (y == 1)).sum() for c in cuts])
    ap = (np.diff(tp, prepend=0) / y.sum() * tp / np.array([(s >= c).sum() for c in cuts])).sum()
    assert np.isclose(got[0]["roc_auc"], auc) and np.isclose(got[0]["average_precision"], ap) and np.isclose(got[0]["brier"], np.mean((s - y) ** 2))
    hit = s >= 0.5
    assert np.isclose(got[0]["precision"], y[hit].mean()) and np.isclose(got[0]["recall"], hit[y == 1].mean()) and np.isclose(got[0]["accuracy"], (hit == y).mean())
    assert got[1]["roc_auc"] is None and got[1]["recall"] == 0.0


def test_classifier_is_judged_on_rows_it_has_not_seen(spark):
    rng = np.random.default_rng(4)
    rows = [(f"e{i}", "s", f"chr{i % 5 + 1}", "gain" if rng.random() < 0.5 else "loss", 1, 3, float(rng.normal())) for i in range(150)]
    events = spark.createDataFrame(rows, "event_id string, sample_id string, chrom string, state string, start_bin int, end_bin int, segment_mean_signal double")
    labels = spark.createDataFrame([(r[0], int(r[6] + 0.2 * rng.normal() > 0)) for r in rows[:140]], "event_id string, label int")
    labelled = classifier.attach_labels(classifier.event_features(events), labels)
    model, held = classifier.train_event_classifier(labelled, 3, maxIter=3, maxDepth=3)
    assert held.count() == 140 and held.select("event_id").distinct().count() == 140
    assert min(r["accuracy"] for r in classifier.fold_metrics(held).collect()) > 0.7
    assert classifier.feature_importance(model).first()["feature"] == "segment_mean_signal"
    assert classifier.train_event_classifier(labelled.where("label = 1"), 3) is None
