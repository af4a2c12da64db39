"""Every registered query against its DuckDB twin at sf0.01 (the driver's gate)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from conftest import SF01
from oracle_compare import compare, duck_connect

from trajlake.plans.catalog import QUERIES

NAMES = sorted(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF01)


def test_every_query_has_oracle():
    """The library's own queries all have one; those of the pipeline operators where SQL can express them."""
    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SF01, name, entry_mod.queries()[name], entry_mod.oracle_sql()[name], con)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and df.columns[:4] == ["robot", "n_actions", "n_dropped", "n_bad"]
