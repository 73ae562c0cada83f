"""Trend correction and cohort selection against plain models on small fixtures."""

import math

import numpy as np
import pytest

from binlattice.operators import cohort, correction


def plain_loess(x, y, frac, turns):
    n, size = len(x), max(3, math.ceil(frac * len(x)))
    robust, fit = np.ones(n), np.zeros(n)
    for turn in range(turns + 1):
        for i in range(n):
            right = min(n, max(0, i - size // 2) + size)
            at = np.arange(max(0, right - size), right)
            d = np.abs(x[at] - x[i])
            if d.max() == 0:
                fit[i] = y[at].mean()
                continue
            w = (1 - (d / d.max()) ** 3) ** 3 * robust[at]
            if (w > 0).sum() < 2:
                fit[i] = y[at].mean()
                continue
            a = np.stack([np.ones(len(at)), x[at] - x[i]], 1) * np.sqrt(w)[:, None]
            fit[i] = np.linalg.lstsq(a, y[at] * np.sqrt(w), rcond=None)[0][0]
        r = y - fit
        scale = 6 * np.median(np.abs(r))
        robust = np.where(np.abs(r) < scale, (1 - (r / scale) ** 2) ** 2, 0) if scale > 0 else np.ones(n)
    return fit


@pytest.mark.parametrize("n,turns,levels", [(2, 1, 0), (3, 1, 0), (7, 0, 0), (400, 2, 0), (60, 1, 4)])
def test_smooth_positions(n, turns, levels):
    rng = np.random.default_rng(n)
    x = np.sort(rng.integers(0, levels, n) / levels if levels else rng.random(n))
    y = np.sin(5 * x) + rng.normal(0, 0.1, n)
    want = y if n < 3 else plain_loess(x, y, 0.2, turns)
    assert np.allclose(correction.smooth_positions(x, y, 0.2, turns), want, atol=1e-8)


def test_poly_is_least_squares(spark):
    rng = np.random.default_rng(1)
    rows = [("a", i, float(g), float(3 - 2 * g + 5 * g * g + e)) for i, (g, e) in enumerate(zip(rng.random(50), rng.normal(0, 0.1, 50)))]
    rows += [("two", i, float(i % 2), float(i)) for i in range(6)] + [("one", i, 0.4, float(i)) for i in range(4)] + [("one", 9, None, 1.0), ("one", 10, float("nan"), 1.0)]
    got = correction.gc_poly(spark.createDataFrame(rows, "s string, i int, g double, y double"), "y", "g", ["i"], ["s"]).collect()
    assert len(got) == 60
    for s in ("a", "two", "one"):
        here = [r for r in rows if r[0] == s and r[2] is not None and not math.isnan(r[2])]
        x, y = np.array([r[2] for r in here]), np.array([r[3] for r in here])
        want = np.polyval(np.polyfit(x, y, {"a": 2, "two": 1, "one": 0}[s]), x)
        assert np.allclose([r["gc_trend"] for r in sorted(got, key=lambda r: r["i"]) if r["s"] == s], want, atol=1e-8)


def test_correction_leaves_small_groups_alone(spark):
    df = spark.createDataFrame([("s", i, 0.5, float(i)) for i in range(5)] + [("s", 9, None, 2.0)], "s string, i int, g double, y double")
    for method in ("loess", "poly2", "none"):
        rows = correction.apply_gc_correction(df, "y", "g", method, ["i"], ["s"], min_valid=6).collect()
        assert {(r["gc_trend"], r["gc_correction_applied"], r["gc_correction_valid_bins"]) for r in rows} == {(None, 0, 5)}
        assert all(r["signal_corrected"] == r["y"] for r in rows)
    kept = {r["i"]: r for r in correction.apply_gc_correction(df, "y", "g", "loess", ["i"], ["s"], min_valid=3).collect()}
    assert kept[9]["signal_corrected"] == 2.0 and kept[9]["gc_trend"] is None and kept[0]["gc_trend"] == 1.0  # equal GC: the mean of a window of 3 places


def plain_surface(train, y, base, query, frac, turns):
    def predict(w, at):
        out = []
        for q in at:
            d = train - q
            far = np.sqrt((d**2).sum(1))
            k = max(25, min(len(y), math.ceil(frac * len(y))))
            radius = np.sort(far)[k - 1] or (far[far > 0].min() if (far > 0).any() else 1.0)
            kernel = np.where(far < radius, (1 - np.minimum(far / radius, 1) ** 3) ** 3, 0) * w
            a = np.column_stack([np.ones(len(y)), d]) * np.sqrt(kernel)[:, None]
            out.append(np.linalg.lstsq(a, y * np.sqrt(kernel), rcond=None)[0][0] if kernel.any() else np.average(y, weights=np.maximum(w, 1e-6)))
        return np.array(out)

    robust = np.ones(len(y))
    for _ in range(max(turns, 1)):
        r = y - predict(base * robust, train)
        r = np.abs(r - np.median(r))
        scale = 6 * 1.4826 * np.median(r)
        robust = np.where(r < scale, (1 - (r / scale) ** 2) ** 2, 0)
    return predict(base * robust, query)


def test_loess_2d():
    rng = np.random.default_rng(3)
    train, query = rng.normal(size=(300, 2)), rng.normal(size=(280, 2))
    y, base = train[:, 0] ** 2 - train[:, 1] + rng.normal(0, 0.1, 300), rng.random(300) + 0.25
    assert np.allclose(correction.loess_2d(train, y, base, query), plain_surface(train, y, base, query, 0.2, 2), atol=1e-6)


def test_correct_signal_2d(spark):
    rng = np.random.default_rng(8)
    rows = []
    for s, n in (("big", 240), ("small", 30)):
        for i in range(n):
            chrom = "chrX" if i % 12 == 0 else f"chr{i % 3 + 1}"
            gc = None if i == 7 else float(rng.random())
            rows.append((s, chrom, i, float(3 + (gc or 0) ** 2 + rng.normal(0, 0.05)), gc, float(rng.random()), float(1 + rng.random()), 0.1 if i % 5 else 1.0, "dynamic" if i % 17 == 0 else "pass", int(i % 13 > 0)))
    names = "sample_id string, chrom string, bin_index int, normalized_signal double, gc_fraction double, mappability_score double, bin_weight double, region_risk_weight double, mask_label string, correction_fit_eligible int"
    got = {(r["sample_id"], r["bin_index"]): r for r in correction.correct_signal_2d(spark.createDataFrame(rows, names), min_valid=100).collect()}
    assert len(got) == 270
    small = [r for (s, _), r in got.items() if s == "small"]
    assert all(r["correction_applied"] == 0 and r["signal_for_calling"] == r["normalized_signal"] and r["correction_residual"] == 0 for r in small)
    big = sorted((r for r in rows if r[0] == "big"), key=lambda r: (r[1], r[2]))
    fit = np.array([r[1] != "chrX" and r[4] is not None and r[8] == "pass" and r[9] == 1 for r in big])
    raw = np.array([[np.nan if r[4] is None else r[4], r[5]] for r in big])
    z = np.nan_to_num((raw - np.median(raw[fit], axis=0)) / raw[fit].std(axis=0))
    y, w = np.array([r[3] for r in big]), np.maximum(np.array([r[6] * r[7] for r in big]), 0.25)
    want = plain_surface(z[fit], y[fit], w[fit], z, 0.2, 2)
    assert np.allclose([got[r[0], r[2]]["correction_expected_signal"] for r in big], want, atol=1e-6)
    assert np.allclose([got[r[0], r[2]]["signal_for_calling"] for r in big], y - want + np.median(y[fit]), atol=1e-6)


def matrix(n, bins, seed=0, odd=()):
    rng = np.random.default_rng(seed)
    shape, load = rng.gamma(4, 20, bins), rng.normal(size=(2, bins))
    m = rng.poisson(shape * np.exp(0.1 * rng.normal(size=(n, 2)) @ load))
    for i in odd:
        m[i] = rng.poisson(rng.permutation(shape))
    return m


def frame(spark, m):
    rows = [(f"s{i:02}", f"chr{b % 4 + 1}", b // 4, int(v)) for i, r in enumerate(m) for b, v in enumerate(r)]
    return spark.createDataFrame(rows, "sample_id string, chrom string, bin_index bigint, raw_count bigint")


def plain_signal(m):
    return np.log1p(m / m.sum(1, keepdims=True) * 1e6)


def plain_z(x, fit=None):
    fit = x if fit is None else fit
    sd = fit.std(0)
    return (x - fit.mean(0)) / np.where(sd > 0, sd, 1)


def test_components_and_errors(spark):
    m = matrix(10, 120)
    signal = cohort.with_signal(cohort.align_matrix(frame(spark, m)))
    z = plain_z(plain_signal(m))
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    got = cohort.pca_profile(signal, 5).orderBy("component").collect()
    assert np.allclose([r["explained"] for r in got], (s**2 / (s**2).sum())[:5])
    errors = {r["sample_id"]: r["reconstruction_error"] for r in cohort.cohort_sample_metrics(signal, 3).collect()}
    assert np.allclose([errors[f"s{i:02}"] for i in range(10)], ((z - z @ vt[:3].T @ vt[:3]) ** 2).mean(1))


def test_cross_validation(spark):
    m = matrix(9, 120, 5)
    signal = cohort.with_signal(cohort.align_matrix(frame(spark, m)))
    fold = {r["sample_id"]: r["fold"] for r in cohort.folds(signal.select("sample_id").distinct(), 3).collect()}
    x, of = plain_signal(m), np.array([fold[f"s{i:02}"] for i in range(9)])
    want = []
    for f in range(3):
        train, test = plain_z(x[of != f]), plain_z(x[of == f], x[of != f])
        basis = np.linalg.svd(train, full_matrices=False)[2][:2]
        want.append(((test - test @ basis.T @ basis) ** 2).mean())
    got = cohort.cv_reconstruction_mse(signal, [2, 6], 3)
    assert np.isclose(got[2], np.mean(want)) and got[6] is None


def test_tiles_and_iteration_give_the_same_components(spark, monkeypatch):
    signal = cohort.with_signal(cohort.align_matrix(frame(spark, matrix(14, 120, 4))))
    ids = [f"s{i:02}" for i in range(14)]
    trains = [None, set(ids[:9])]
    whole = cohort._products(signal, ids, trains)
    monkeypatch.setattr(cohort, "TILE", 4)
    monkeypatch.setattr(cohort, "GATHERED", 0)
    monkeypatch.setattr(cohort, "BESIDE", 5)
    for one, tiled, fit in zip(whole, cohort._products(signal, ids, trains), (None, np.arange(14) < 9), strict=True):
        assert tiled.array is None and tiled.bins == one.bins == 120
        assert np.allclose(tiled.diagonal, np.diag(one.array)) and np.allclose(tiled.times(np.eye(14)), one.array)
        (v, q), (w, r) = one.top(2, fit), tiled.top(2, fit)
        assert np.allclose(v, w) and np.allclose(np.abs(q), np.abs(r), atol=1e-6)


def test_prefilter_removes_the_odd_sample(spark):
    signal = cohort.with_signal(cohort.align_matrix(frame(spark, matrix(12, 200, 2, odd=[4]))))
    rows = {r["sample_id"]: r for r in cohort.iterative_prefilter(signal, min_reads=0, min_corr=0.5).collect()}
    assert rows["s04"]["is_outlier"] == 1 and rows["s04"]["removed_iteration"] == 1 and "low_corr" in rows["s04"]["reasons"]
    assert rows["s04"]["corr_to_median"] == 0.0 and rows["s04"]["reads"] > 0 and sum(r["is_outlier"] for r in rows.values()) < 5
    with pytest.raises(ValueError):
        cohort.iterative_prefilter(signal, min_samples=13)


def test_tuning_grid_statuses(spark):
    good = cohort.with_signal(cohort.align_matrix(frame(spark, matrix(10, 120))))
    few = cohort.with_signal(cohort.align_matrix(frame(spark, matrix(2, 120))))
    rows = cohort.tuning_grid({100: good, 50: few}, max_components=3, min_samples=5, min_reads=0, max_recon_z=50, max_noise_z=50, n_folds=3).collect()
    assert {(r["bin_size"], r["status"]) for r in rows} == {(50, "FAIL_USABLE_SAMPLE_COUNT"), (100, "PASS")}
    assert sum(r["is_selected_pca"] for r in rows) == 1
    best = cohort.rank_bin_sizes(spark.createDataFrame(rows)).where("is_best_binsize = 1").collect()
    assert [r["bin_size"] for r in best] == [100]


def test_align_refuses(spark):
    with pytest.raises(ValueError):
        cohort.align_matrix(frame(spark, matrix(3, 40)))


def test_alignment_of_ragged_samples(spark):
    m = matrix(4, 480)
    m[3] = 0
    full = frame(spark, m)
    rows = full.where("NOT (sample_id = 's00' AND chrom = 'chr1' AND bin_index > 50) AND NOT (sample_id = 's01' AND chrom = 'chr3')")
    usable, empty = cohort.drop_unusable_samples(rows)
    assert [r["sample_id"] for r in empty.collect()] == ["s03"]
    got = {(r["sample_id"], r["chrom"], r["bin_index"]): r["raw_count"] for r in cohort.align_matrix(usable).collect()}
    assert len(got) == 3 * (51 + 3 * 120)
    assert all(v == (0 if s == "s01" and c == "chr3" else m[int(s[1:]), 4 * b + int(c[3:]) - 1]) for (s, c, b), v in got.items())
