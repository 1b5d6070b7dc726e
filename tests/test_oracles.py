"""Every registered query gives the same rows as its SQL in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from caremill.plans import catalogue
from compare import difference

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()

# Queries that order rows within a key, which may be too big for one task.
ORDERING = (
    "payer_periods", "payer_periods_gap3", "stg_payer_transitions", "clinical_encounters", "subscription_history",
    "history_as_of", "plan_mix", "plan_transitions", "bi_busiest", "check_overlap_subscriptions",
)


def test_every_query_has_sql():
    """All but those of the optional parts, which are tested where they are."""
    assert set(catalogue.QUERIES) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(name, spark, folder, duck):
    assert difference(QUERIES[name](spark, folder), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", ORDERING)
def test_same_rows_when_keys_are_split(name, spark, folder, duck, tiny_tasks):
    assert difference(QUERIES[name](spark, folder), duck, ORACLES[name]) is None


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
