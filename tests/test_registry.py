"""Every registered query against its SQL twin, and the shape of those without one."""

from __future__ import annotations

import checks
import pytest

import __spark_entry__ as entry_module
from loomtext.plans import all_queries, all_sql


@pytest.fixture(scope="module")
def con(sf):
    return checks.connect(sf)


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_matches_sql(spark, sf, con, name):
    assert checks.differences(all_queries()[name](spark, sf), con, all_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(all_sql())))
def test_has_rows(spark, sf, name):
    assert all_queries()[name](spark, sf).count() > 0


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert {r["status"] for r in rows} == {"SUCCESS", "FALLBACK_TRIGGERED"}
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
