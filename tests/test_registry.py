"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as contract
from starmill.operators import analytics
from workload.compare import connect, difference
from workload.registry import REGISTRY


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, sf_dir, duck, name):
    result = contract.queries()[name](spark, sf_dir)
    assert difference(result, duck, contract.oracle_sql()[name]) is None


def test_star_ranks_match_when_entities_are_too_many_for_a_window(spark, sf_dir, duck, monkeypatch):
    monkeypatch.setattr(analytics, "ONE_TASK_ROWS", 0)
    result = contract.queries()["rank_by_period"](spark, sf_dir)
    assert difference(result, duck, contract.oracle_sql()["rank_by_period"]) is None


def test_every_star_query_has_sql():
    assert set(REGISTRY) <= set(contract.oracle_sql())


def test_entry_runs(spark, sf_dir):
    assert contract.entry(spark).columns == [
        "nombre_entidad",
        "anio",
        "total",
        "anio_anterior",
        "variacion_absoluta",
        "pct_cambio",
    ]
