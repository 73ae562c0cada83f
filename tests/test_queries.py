"""Every query of the library against its SQL on DuckDB, at the smallest scale."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

from binlattice.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/*.parquet'" if os.path.isdir(path) else f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return c


def plain(v):
    if isinstance(v, (float, Decimal)):
        return "nan" if math.isnan(v) else round(float(v), 5) + 0.0
    return int(v) if isinstance(v, bool) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    found = duck.execute(registry.oracle_sql()[name])
    columns = sorted(x[0] for x in found.description)
    assert columns == sorted(got.columns)
    at = [[x[0] for x in found.description].index(c) for c in columns]
    want = sorted(repr([plain(r[i]) for i in at]) for r in found.fetchall())
    assert sorted(repr([plain(r[c]) for c in columns]) for r in got.collect()) == want


def test_two_sided_p(spark):
    from binlattice.functions.stats import two_sided_p

    rows = spark.createDataFrame([(0.0,), (-1.96,), (None,), (8.0,)], "z double").select(two_sided_p("z")).collect()
    want = [math.erfc(abs(z) / math.sqrt(2)) for z in (0, -1.96, 0, 8)]
    assert all(abs(r[0] - p) <= 1.2e-7 * p for r, p in zip(rows, want, strict=True))


def test_leave_one_out_is_that_of_the_other_samples(spark):
    import random
    from statistics import median

    from binlattice.operators.qc import leave_one_out

    rng = random.Random(3)
    for n in (2, 3, 4, 5, 8, 9):
        rows = [(f"S{s}", "chr1", b, float(rng.randint(0, 6))) for s in range(n) for b in range(4)]
        got = leave_one_out(spark.createDataFrame(rows, "sample_id string, chrom string, bin_index int, x double"), "x").collect()
        assert len(got) == 4 * n
        for r in got:
            others = [x for s, _, b, x in rows if b == r.bin_index and s != r.sample_id]
            m = median(others)
            assert r.ref_median == m and r.ref_sigma >= 1.4826 * median(abs(x - m) for x in others) - 1e-12


def test_leave_one_out_ignores_own_value(spark):
    from binlattice.operators.qc import leave_one_out

    rows = [(f"S{s}", "chr1", b, float(s * s + b)) for s in range(5) for b in range(3)]
    base = {(r.sample_id, r.bin_index): r.ref_median for r in leave_one_out(spark.createDataFrame(rows, "sample_id string, chrom string, bin_index int, x double"), "x").collect()}
    moved = [(s, c, b, 1e6 if s == "S2" else x) for s, c, b, x in rows]
    after = {(r.sample_id, r.bin_index): r.ref_median for r in leave_one_out(spark.createDataFrame(moved, "sample_id string, chrom string, bin_index int, x double"), "x").collect()}
    assert all(base[("S2", b)] == after[("S2", b)] for b in range(3))


def test_steps_that_read_whole_tables_are_written_once(spark):
    """What later steps look at many times holds no scan of a given table."""
    from binlattice.plans import adapters, cohort_queries

    for step in (adapters.bins, adapters.annotated, adapters.calling_bins, cohort_queries._signal):
        assert not any(f"{t}.parquet" in f for f in step(spark, SF).inputFiles() for t in TABLES), step.__name__
