import pytest

from tests.helpers import check, only
from tickloom import catalogue
from tickloom.operators import deriv_bars as db

T0 = 1704067200000


@pytest.fixture
def deriv(spark):
    rows = [  # mark, index, funding, open interest; ids out of time order
        (2, T0 + 1, 101.0, 100.0, 0.01, 50.0),
        (1, T0 + 1, 99.0, 100.0, 0.03, 70.0),
        (0, T0 + 9, 104.0, 100.0, -0.02, 60.0),
    ]
    data = [(i, "okx-perps", "perpetual-A", ts, ts, *rest) for i, ts, *rest in rows]
    return spark.createDataFrame(data, catalogue.DERIV)


def test_all_four(deriv):
    row = only(db.basis(deriv, "1h"))
    check(row, basis_mean=4 / 3, basis_close=4, basis_bps_close=400)
    row = only(db.funding(deriv, "1h"))
    check(row, funding_rate=-0.02, funding_mean=0.02 / 3, funding_min=-0.02, funding_max=0.03)
    row = only(db.open_interest(deriv, "1h"))
    check(row, oi_open=70, oi_high=70, oi_low=50, oi_close=60, oi_change=-10, oi_notional=6240)
    row = only(db.derivative_price(deriv, "1h"))
    check(row, mark_open=99, mark_high=104, mark_low=99, mark_close=104)
    check(row, index_open=100, index_close=100)


def test_zero_index(deriv):
    row = only(db.basis(deriv.selectExpr("* except (index_price)", "0D as index_price"), "1h"))
    check(row, basis_close=104, basis_bps_close=None)
