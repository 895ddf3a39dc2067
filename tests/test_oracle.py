"""Every registered query against its SQL at the smallest scale."""

import pytest

from checks import demand, feeds_and_shape, layers_and_streams, replays, rows_of_plans, text_and_forecast  # noqa: F401
from checks.registry import ORACLES, QUERIES
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    note = compare(spark, con, QUERIES[name], ORACLES[name], SF)
    assert note.startswith("ok") and "types" not in note, note


#: Fits, which SQL cannot express; tests/test_forecast.py holds them against a second fit in plain numpy.
FITS = {"fct_fit_predict", "fct_holdout", *(f"flow_forecast_{n}" for n in ("orders", "delays", "sales", "quantity", "next_delivery"))}


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) | FITS


@pytest.mark.parametrize("name", ["fct_holdout", "fct_fit_predict", "flow_forecast_orders"])
def test_fits_over_the_given_series(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert rows
    if name == "fct_holdout":
        assert all(0 <= r.covered <= r.days <= 7 and r.width > 0 for r in rows)


def test_entry_registers_everything():
    import __spark_entry__ as e

    assert set(ORACLES) <= set(e.oracle_sql()) <= set(e.queries())
