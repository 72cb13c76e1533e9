"""Names, enumerations and schemas of the bar engine.

Fixed values: the dataset, interval, exchange and clock names below are part of
the public interface and must be spelled exactly like this.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values -----------------------------------------------------------------
INTERVAL_MS = {
    "1s": 1_000,
    "1m": 60_000,
    "5m": 300_000,
    "15m": 900_000,
    "30m": 1_800_000,
    "1h": 3_600_000,
    "4h": 14_400_000,
    "1d": 86_400_000,
}
EXCHANGES = ("binance-futures", "okx-perps", "hyperliquid-perps")
TS_KINDS = ("exchange", "true")

TRADE_METRICS = (
    "vtwap",
    "flow",
    "trade_size",
    "impact",
    "range",
    "updownticks",
    "run_structure",
    "returns",
    "slippage",
)
L1_METRICS = ("l1_price", "l1_imbalance", "l1_liquidity")
L2_METRICS = ("l2_imbalance", "l2_liquidity")
DERIVATIVE_METRICS = ("basis", "funding", "open_interest", "derivative_price")
DATASETS = ("ohlcv", *TRADE_METRICS, *L1_METRICS, *L2_METRICS, *DERIVATIVE_METRICS)
# ------------------------------------------------------------------------------

SIZE_CLASSES = ("small", "medium", "large")
BOOK_DEPTHS = (1, 5, 10)

SERIES = ("exchange", "symbol")
BAR = ("exchange", "symbol", "bar")
PARTITIONS = ("interval", "ts_kind", "exchange", "year", "month", "symbol")


def _fields(
    doubles: str = "", longs: str = "", flags: str = "", bytes_: str = ""
) -> dict[str, T.DataType]:
    out: dict[str, T.DataType] = {name: T.DoubleType() for name in doubles.split()}
    out.update({name: T.LongType() for name in longs.split()})
    out.update({name: T.BooleanType() for name in flags.split()})
    out.update({name: T.BinaryType() for name in bytes_.split()})
    return out


def _per(template: str, values) -> str:
    return " ".join(template.format(v) for v in values)


_METRIC_COLUMNS: dict[str, dict[str, T.DataType]] = {
    "ohlcv": _fields("open high low close volume"),
    "vtwap": _fields("vwap twap"),
    "flow": _fields(
        "buy_volume sell_volume net_volume buy_volume_ratio buy_count_ratio "
        + _per("buy_volume_{0} sell_volume_{0}", SIZE_CLASSES),
        "buy_count sell_count " + _per("buy_count_{0} sell_count_{0}", SIZE_CLASSES),
    ),
    "trade_size": _fields(
        _per("volume_{}", SIZE_CLASSES) + " mean std min max p25 p50 p75 p95 skew kurt",
        _per("count_{}", SIZE_CLASSES),
    ),
    "impact": _fields("amihud kyle_lambda buy_impact sell_impact"),
    "range": _fields(
        "range range_pct log_range parkinson_var mean std p05 p25 p50 p75 p95"
    ),
    "updownticks": _fields(
        "up_volume down_volume up_down_ratio up_pct down_pct",
        "up_count down_count flat_count",
    ),
    "run_structure": _fields(
        "mean_run_length max_run_volume",
        "run_count max_run_length buy_run_count sell_run_count",
    ),
    "returns": _fields("ret log_ret realized_var close_to_close"),
    "slippage": _fields(
        "slippage_bps buy_slippage_bps sell_slippage_bps", "unmatched_count"
    ),
    "l1_price": _fields("bid_price ask_price mid_price mid_twap mid_vwap micro_price"),
    "l1_imbalance": _fields("imbalance ratio bid_pct ask_pct"),
    "l1_liquidity": _fields("spread spread_bps depth dollar_depth"),
    "l2_imbalance": _fields(_per("imbalance_{0} dollar_imbalance_{0}", BOOK_DEPTHS)),
    "l2_liquidity": _fields(
        _per("bid_depth_{0} ask_depth_{0} bid_dollar_{0} ask_dollar_{0}", BOOK_DEPTHS)
    ),
    "basis": _fields("basis_mean basis_close basis_bps_close"),
    "funding": _fields("funding_rate funding_mean funding_min funding_max"),
    "open_interest": _fields("oi_open oi_high oi_low oi_close oi_change oi_notional"),
    "derivative_price": _fields(
        _per("mark_{}", ("open", "high", "low", "close"))
        + " "
        + _per("index_{}", ("open", "high", "low", "close"))
    ),
}


# What a bar of order-dependent datasets is made of, kept so that bars can be merged: its
# first and last trade or run, and sums over what lies between. Stored like a dataset.
_STATE_COLUMNS: dict[str, dict[str, T.DataType]] = {
    "path_state": _fields(
        "first_price first_qty first_signed last_price notional volume held log_dp_sq "
        "up_qty down_qty buy_dp buy_dp_qty sell_dp sell_dp_qty k_x k_y k_sxx k_sxy",
        "first_ts last_ts pairs ups downs flats k_n",
        "first_buy",
    ),
    "run_state": _fields(
        "head_qty tail_qty inner_qty",
        "first_ts head_length tail_length inner_runs inner_buy_runs inner_trades inner_length",
        "head_buy tail_buy",
    ),
    "mid_state": _fields("last_mid", "quotes"),
    "sketch_state": _fields(bytes_="qty_sketch price_sketch"),
}
STATES = tuple(_STATE_COLUMNS)
_COLUMNS = _METRIC_COLUMNS | _STATE_COLUMNS


def metric_columns(dataset: str) -> list[str]:
    """Value columns of a dataset or state table, without the keys."""
    return list(_COLUMNS[check_dataset(dataset)])


def data_schema(dataset: str) -> T.StructType:
    """Columns stored inside the Parquet files of a dataset."""
    schema = T.StructType(
        [
            T.StructField("timestamp", T.LongType()),
            T.StructField("time", T.TimestampNTZType()),
        ]
    )
    for name, kind in _COLUMNS[check_dataset(dataset)].items():
        schema.add(name, kind)
    return schema


def partition_schema() -> T.StructType:
    """Directory columns. Always passed to the reader: inference reads '1d' as 1.0."""
    return T.StructType(
        [
            T.StructField(
                name, T.IntegerType() if name in ("year", "month") else T.StringType()
            )
            for name in PARTITIONS
        ]
    )


def lake_schema(dataset: str) -> T.StructType:
    return T.StructType(data_schema(dataset).fields + partition_schema().fields)


TRADES = (
    "trade_id bigint, exchange string, symbol string, exchange_ts bigint, "
    "true_ts bigint, price double, qty double, side string"
)
QUOTES = (
    "quote_id bigint, exchange string, symbol string, exchange_ts bigint, "
    "true_ts bigint, bid_price double, ask_price double, bid_size double, "
    "ask_size double"
)
BOOK = (
    "quote_id bigint, exchange string, symbol string, exchange_ts bigint, "
    "true_ts bigint, bid_px array<double>, bid_sz array<double>, "
    "ask_px array<double>, ask_sz array<double>"
)
DERIV = (
    "tick_id bigint, exchange string, symbol string, exchange_ts bigint, "
    "true_ts bigint, mark_price double, index_price double, funding_rate double, "
    "open_interest double"
)


def check_dataset(dataset: str) -> str:
    if dataset not in _COLUMNS:
        raise ValueError(f"unknown dataset {dataset!r}; one of {', '.join(DATASETS)}")
    return dataset


def check_interval(interval: str) -> str:
    if interval not in INTERVAL_MS:
        raise ValueError(f"unknown interval {interval!r}; one of {', '.join(INTERVAL_MS)}")
    return interval


def check_exchange(exchange: str) -> str:
    if exchange not in EXCHANGES:
        raise ValueError(f"unknown exchange {exchange!r}; one of {', '.join(EXCHANGES)}")
    return exchange


def check_ts_kind(ts_kind: str) -> str:
    if ts_kind not in TS_KINDS:
        raise ValueError(f"unknown timestamp kind {ts_kind!r}; one of {', '.join(TS_KINDS)}")
    return ts_kind
