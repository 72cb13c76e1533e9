import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tickloom import catalogue  # noqa: E402
from tickloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(os.environ.get("TEST_CPUS", "8"), "tests")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


@pytest.fixture
def trades(spark):
    """Trades from (ts, price, qty, side) rows; ids follow the list."""

    def make(rows, symbol="perpetual-A-USDT:USDT", exchange="binance-futures"):
        data = [
            (i, exchange, symbol, ts, ts, float(price), float(qty), side)
            for i, (ts, price, qty, side) in enumerate(rows)
        ]
        return spark.createDataFrame(data, catalogue.TRADES)

    return make


@pytest.fixture
def quotes(spark):
    """Quotes from (ts, bid, ask, bid_size, ask_size) rows."""

    def make(rows, symbol="perpetual-A-USDT:USDT", exchange="binance-futures"):
        data = [
            (i, exchange, symbol, ts, ts, *(None if x is None else float(x) for x in values))
            for i, (ts, *values) in enumerate(rows)
        ]
        return spark.createDataFrame(data, catalogue.QUOTES)

    return make


@pytest.fixture(scope="session")
def small(spark):
    """Tick tables of the smallest generated data."""
    from checks.queries import tick_tables

    return {name: df.cache() for name, df in tick_tables(spark, SMALL).items()}
