"""Every registered query with an SQL equivalent must give the same rows on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as contract  # noqa: E402
import check  # noqa: E402

SQL = contract.oracle_sql()
# Slow assemblies and iterative fits are covered piece by piece in the other test files.
LONG = {"s22_run_battery", "s23_battery_overview", "s27_fit_student_t", "s28_fit_gmm", "t6_fit_transforms",
        "t7_save_load_transforms", "t9_run_transform"}


@pytest.fixture(scope="module")
def con(sf):
    return check.connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, sf, name):
    verdict, _ = check.compare(name, spark, con, sf)
    assert verdict == "ok", verdict


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(SQL) - LONG))
def test_rows_only(spark, sf, name):
    assert contract.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "volatility" in df.columns


def test_registry_is_complete():
    assert set(SQL) <= set(contract.queries())
    ids = {n.split("_")[0] for n in contract.queries()}
    want = {f"{p}{i}" for p, n in (("i", 9), ("h", 10), ("w", 8), ("k", 9), ("t", 9), ("z", 7), ("s", 30)) for i in range(1, n + 1)}
    assert want | {"b1", "b2a", "b2b", "b3", "b4", "b5", "b6", "b7", "b8", "p1"} <= ids
