"""SQL for the registered queries, written from the definitions for DuckDB.

The shape differs from the Spark code on purpose: bars are windows over whole bars (no
slices), as-of is an ASOF JOIN, runs come from row-number differences, regressions and
higher moments from their sums.
"""

from __future__ import annotations

from checks.settings import (
    FINE_DATASETS,
    FINE_INTERVALS,
    GROUPS,
    LATE_DATASETS,
    LIMITS,
    PART_CUT,
    SIZED_GROUP,
    SLICE_FROM,
    SLICE_SYMBOL,
    SLICE_TO,
    nudge,
)
from tickloom.catalogue import (
    BOOK_DEPTHS,
    DATASETS,
    DERIVATIVE_METRICS,
    INTERVAL_MS,
    L1_METRICS,
    L2_METRICS,
    SIZE_CLASSES,
    TRADE_METRICS,
    data_schema,
    metric_columns,
)
from tickloom.functions.clock import day_ms, next_day_ms
from tickloom.operators.resample import FROM_STATES
from tickloom.operators.trade_bars import QUANTILES

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_MS = "(epoch_us(ts) // 1000 + (event_id % 4) * 2678400000)"
_EXCHANGE = "['binance-futures', 'okx-perps', 'hyperliquid-perps'][user_id % 3 + 1]"
_FIRST = "exchange = 'binance-futures'"
_SYMBOL = "'perpetual-S' || CAST(user_id % 5 AS VARCHAR) || '-USDT:USDT'"
_KEYS = f"""{_EXCHANGE} AS exchange, {_SYMBOL} AS symbol,
  {_MS} AS exchange_ts, {_MS} + (event_id * 7919) % 900000 AS true_ts"""

_TRADES = f"""trades AS (
  SELECT event_id AS trade_id, {_KEYS}, value AS price, CAST({_K} + 1 AS DOUBLE) AS qty,
    CASE WHEN event_id % 3 = 0 THEN 'sell' ELSE 'buy' END AS side
  FROM events)"""
_QUOTES = f"""quotes AS (
  SELECT event_id AS quote_id, {_KEYS},
    value + 1 - (1 + {_K} % 5) / 100.0::DOUBLE AS bid_price,
    value + 1 + (1 + {_K} % 5) / 100.0::DOUBLE AS ask_price,
    CAST(1 + user_id % 50 AS DOUBLE) AS bid_size,
    CAST(1 + (event_id * 7) % 50 AS DOUBLE) AS ask_size
  FROM events WHERE event_type IN ('signup', 'error', 'view'))"""
_DERIV = f"""deriv AS (
  SELECT event_id AS tick_id, {_KEYS}, value + 1 AS mark_price,
    (value + 1) * (1.0::DOUBLE - ({_K} - 50) / 10000.0::DOUBLE) AS index_price,
    ({_K} - 50) / 1000000.0::DOUBLE AS funding_rate,
    CAST(user_id * 10 + {_K} AS DOUBLE) AS open_interest
  FROM events WHERE event_type IN ('purchase', 'click'))"""
_BAR = "exchange, symbol, bar"


def _rows(table: str, row_id: str, width: int, clock: str) -> str:
    """Ticks with their bar, numbered from both ends, with neighbours in the bar."""
    bar = f"{clock}_ts - {clock}_ts % {width}"
    return f"""t AS (
  SELECT *, {row_id} AS id, {clock}_ts AS at, {bar} AS bar,
    row_number() OVER (PARTITION BY exchange, symbol, {bar} ORDER BY {clock}_ts, {row_id})
      AS nth,
    row_number() OVER (PARTITION BY exchange, symbol, {bar}
      ORDER BY {clock}_ts DESC, {row_id} DESC) AS nth_last,
    coalesce(lead({clock}_ts) OVER (PARTITION BY exchange, symbol, {bar}
      ORDER BY {clock}_ts, {row_id}), {bar} + {width}) - {clock}_ts AS dt
  FROM {table})"""


def _first(x: str) -> str:
    return f"max({x}) FILTER (WHERE nth = 1)"


def _last(x: str) -> str:
    return f"max({x}) FILTER (WHERE nth_last = 1)"


def _bars(ctes: list[str], columns: dict[str, str], source: str = "t") -> tuple:
    return ctes, {"timestamp": "bar", **columns}, f"FROM {source} GROUP BY {_BAR}"


def _changes() -> str:
    return f"""d AS (
  SELECT *, price - lag(price) OVER w AS dp, ln(price / lag(price) OVER w) AS dl,
    CASE WHEN side = 'buy' THEN qty ELSE -qty END AS x
  FROM t WINDOW w AS (PARTITION BY {_BAR} ORDER BY nth))"""


def _classes() -> dict[str, str]:
    low, high = LIMITS
    n = "price * qty"
    tests = (f"{n} < {low}", f"{n} >= {low} AND {n} < {high}", f"{n} >= {high}")
    return dict(zip(SIZE_CLASSES, tests, strict=True))


def _moments(value: str) -> str:
    """Central power sums per bar, from deviations."""
    return f"""m AS (
  SELECT {_BAR}, count(*) AS n, sum(v * v) AS s2, sum(v * v * v) AS s3,
    sum(v * v * v * v) AS s4
  FROM (SELECT {_BAR}, {value} - avg({value}) OVER (PARTITION BY {_BAR}) AS v FROM t)
  GROUP BY {_BAR})"""


def _dataset(dataset: str, width: int, clock: str) -> tuple[list[str], dict[str, str], str]:
    trades = [_TRADES, _rows("trades", "trade_id", width, clock)]
    quotes = [_QUOTES, _rows("quotes", "quote_id", width, clock)]
    deriv = [_DERIV, _rows("deriv", "tick_id", width, clock)]
    if dataset == "ohlcv":
        return _bars(
            trades,
            {
                "open": _first("price"),
                "high": "max(price)",
                "low": "min(price)",
                "close": _last("price"),
                "volume": "sum(qty)",
            },
        )
    if dataset == "vtwap":
        return _bars(
            trades,
            {
                "vwap": "sum(price * qty) / nullif(sum(qty), 0)",
                "twap": "sum(price * dt) / nullif(sum(dt), 0)",
            },
        )
    if dataset == "flow":
        columns = {}
        for side in ("buy", "sell"):
            columns[f"{side}_volume"] = f"coalesce(sum(qty) FILTER (side = '{side}'), 0)"
            columns[f"{side}_count"] = f"count(*) FILTER (side = '{side}')"
            for name, test in _classes().items():
                where = f"FILTER (side = '{side}' AND {test})"
                columns[f"{side}_volume_{name}"] = f"coalesce(sum(qty) {where}, 0)"
                columns[f"{side}_count_{name}"] = f"count(*) {where}"
        buy = columns["buy_volume"]
        columns["net_volume"] = "sum(CASE WHEN side = 'buy' THEN qty ELSE -qty END)"
        columns["buy_volume_ratio"] = f"{buy} / nullif(sum(qty), 0)"
        columns["buy_count_ratio"] = f"{columns['buy_count']} / count(*)"
        return _bars(trades, columns)
    if dataset == "trade_size":
        columns = {}
        for name, test in _classes().items():
            columns[f"volume_{name}"] = f"coalesce(sum(qty) FILTER ({test}), 0)"
            columns[f"count_{name}"] = f"count(*) FILTER ({test})"
        columns |= {
            "mean": "sum(qty) / count(*)",
            "std": "sqrt(any_value(s2) / nullif(any_value(n) - 1, 0))",
            "min": "min(qty)",
            "max": "max(qty)",
            **{f"p{p}": f"quantile_cont(qty, {p / 100})" for p in (25, 50, 75, 95)},
            "skew": "CASE WHEN any_value(n) >= 3 THEN any_value(s3) / any_value(n) "
            "/ nullif(pow(any_value(s2) / any_value(n), 1.5), 0) END",
            "kurt": "CASE WHEN any_value(n) >= 4 THEN any_value(s4) / any_value(n) "
            "/ nullif(pow(any_value(s2) / any_value(n), 2), 0) - 3 END",
        }
        joined = f"j AS (SELECT * FROM t JOIN m USING ({_BAR}))"
        return _bars([*trades, _moments("qty"), joined], columns, "j")
    if dataset == "impact":

        def side(name: str) -> str:
            where = f"FILTER (side = '{name}' AND dp IS NOT NULL)"
            return f"sum(dp) {where} / nullif(sum(qty) {where}, 0)"

        pair = "FILTER (dp IS NOT NULL)"
        sxx = f"(sum(x * x) {pair} - sum(x) {pair} * sum(x) {pair} / count(dp))"
        sxy = f"(sum(x * dp) {pair} - sum(x) {pair} * sum(dp) {pair} / count(dp))"
        return _bars(
            [*trades, _changes()],
            {
                "amihud": f"abs({_last('price')} / {_first('price')} - 1) / sum(price * qty)",
                "kyle_lambda": f"CASE WHEN count(dp) > 1 THEN {sxy} / nullif({sxx}, 0) END",
                "buy_impact": side("buy"),
                "sell_impact": side("sell"),
            },
            "d",
        )
    if dataset == "range":
        return _bars(
            trades,
            {
                "range": "max(price) - min(price)",
                "range_pct": f"(max(price) - min(price)) / {_first('price')}",
                "log_range": "ln(max(price)) - ln(min(price))",
                "parkinson_var": "pow(ln(max(price) / min(price)), 2) / (4 * ln(2))",
                "mean": "avg(price)",
                "std": "stddev_samp(price)",
                **{f"p{p:02}": f"quantile_cont(price, {p / 100})" for p in (5, 25, 50, 75, 95)},
            },
        )
    if dataset == "updownticks":
        up, down = "count(*) FILTER (dp > 0)", "count(*) FILTER (dp < 0)"
        return _bars(
            [*trades, _changes()],
            {
                "up_count": up,
                "down_count": down,
                "flat_count": "count(*) FILTER (dp = 0)",
                "up_volume": "coalesce(sum(qty) FILTER (dp > 0), 0)",
                "down_volume": "coalesce(sum(qty) FILTER (dp < 0), 0)",
                "up_down_ratio": f"{up} / nullif({down}, 0)",
                "up_pct": f"{up} / nullif(count(dp), 0)",
                "down_pct": f"{down} / nullif(count(dp), 0)",
            },
            "d",
        )
    if dataset == "run_structure":
        runs = f"""r AS (
  SELECT {_BAR}, side, island, count(*) AS len, sum(qty) AS vol
  FROM (SELECT *, nth - row_number() OVER (PARTITION BY {_BAR}, side ORDER BY nth) AS island
    FROM t)
  GROUP BY {_BAR}, side, island)"""
        return _bars(
            [*trades, runs],
            {
                "run_count": "count(*)",
                "max_run_length": "max(len)",
                "mean_run_length": "avg(len)",
                "buy_run_count": "count(*) FILTER (side = 'buy')",
                "sell_run_count": "count(*) FILTER (side = 'sell')",
                "max_run_volume": "max(vol)",
            },
            "r",
        )
    if dataset == "returns":
        closes = f"""c AS (
  SELECT *, lag(close) OVER (PARTITION BY exchange, symbol ORDER BY bar) AS before
  FROM (SELECT {_BAR}, {_first('price')} AS open, {_last('price')} AS close,
      coalesce(sum(dl * dl), 0) AS rv
    FROM d GROUP BY {_BAR}))"""
        return _bars(
            [*trades, _changes(), closes],
            {
                "ret": "max(close / open - 1)",
                "log_ret": "max(ln(close) - ln(open))",
                "realized_var": "max(rv)",
                "close_to_close": "max(ln(close) - ln(before))",
            },
            "c",
        )
    if dataset == "slippage":

        def bps(test: str) -> str:
            where = f"FILTER (mid IS NOT NULL AND {test})"
            cost = "CASE WHEN side = 'buy' THEN 1 ELSE -1 END * qty * (price - mid) / mid"
            return f"sum({cost}) {where} * 10000 / nullif(sum(qty) {where}, 0)"

        return _bars(
            [*trades[:1], _QUOTES, *_asof(clock), _rows("matched", "trade_id", width, clock)],
            {
                "slippage_bps": bps("true"),
                "buy_slippage_bps": bps("side = 'buy'"),
                "sell_slippage_bps": bps("side = 'sell'"),
                "unmatched_count": "count(*) FILTER (mid IS NULL)",
            },
        )
    if dataset == "l1_price":
        mid, size = "((bid_price + ask_price) / 2)", "(bid_size + ask_size)"
        return _bars(
            quotes,
            {
                "bid_price": _last("bid_price"),
                "ask_price": _last("ask_price"),
                "mid_price": _last(mid),
                "mid_twap": f"sum({mid} * dt) / nullif(sum(dt), 0)",
                "mid_vwap": f"sum({mid} * {size}) / nullif(sum({size}), 0)",
                "micro_price": "avg((bid_price * ask_size + ask_price * bid_size) "
                f"/ nullif({size}, 0))",
            },
        )
    if dataset == "l1_imbalance":
        size = "nullif(bid_size + ask_size, 0)"
        return _bars(
            quotes,
            {
                "imbalance": f"avg((bid_size - ask_size) / {size})",
                "ratio": "avg(bid_size / nullif(ask_size, 0))",
                "bid_pct": f"avg(bid_size / {size})",
                "ask_pct": f"avg(ask_size / {size})",
            },
        )
    if dataset == "l1_liquidity":
        return _bars(
            quotes,
            {
                "spread": "avg(ask_price - bid_price)",
                "spread_bps": "avg((ask_price - bid_price) / (bid_price + ask_price) * 20000)",
                "depth": "avg(bid_size) + avg(ask_size)",
                "dollar_depth": "avg(bid_price * bid_size) + avg(ask_price * ask_size)",
            },
        )
    if dataset in ("l2_imbalance", "l2_liquidity"):
        # Level i is 0.01*i away from the best price and i (bid) or 2i (ask) larger.
        levels = """levels AS (
  SELECT quote_id, exchange, symbol, exchange_ts, true_ts, level,
    bid_size + level AS bs, ask_size + 2 * level AS az,
    (bid_price - 0.01::DOUBLE * level) * (bid_size + level) AS bc,
    (ask_price + 0.01::DOUBLE * level) * (ask_size + 2 * level) AS ac
  FROM quotes, (SELECT unnest(range(10)) AS level))"""
        sums = ", ".join(
            f"sum({column}) FILTER (level < {k}) AS {column}_{k}"
            for k in BOOK_DEPTHS
            for column in ("bs", "az", "bc", "ac")
        )
        book = f"""book AS (
  SELECT quote_id, exchange, symbol, exchange_ts, true_ts, {sums}
  FROM levels GROUP BY ALL)"""
        columns = {}
        for k in BOOK_DEPTHS:
            if dataset == "l2_imbalance":
                columns[f"imbalance_{k}"] = f"avg((bs_{k} - az_{k}) / nullif(bs_{k} + az_{k}, 0))"
                columns[f"dollar_imbalance_{k}"] = (
                    f"avg((bc_{k} - ac_{k}) / nullif(bc_{k} + ac_{k}, 0))"
                )
            else:
                columns[f"bid_depth_{k}"] = f"avg(bs_{k})"
                columns[f"ask_depth_{k}"] = f"avg(az_{k})"
                columns[f"bid_dollar_{k}"] = f"avg(bc_{k})"
                columns[f"ask_dollar_{k}"] = f"avg(ac_{k})"
        ctes = [_QUOTES, levels, book, _rows("book", "quote_id", width, clock)]
        return _bars(ctes, columns)
    if dataset == "basis":
        gap = "(mark_price - index_price)"
        return _bars(
            deriv,
            {
                "basis_mean": f"avg({gap})",
                "basis_close": _last(gap),
                "basis_bps_close": _last(f"{gap} / nullif(index_price, 0) * 10000"),
            },
        )
    if dataset == "funding":
        return _bars(
            deriv,
            {
                "funding_rate": _last("funding_rate"),
                "funding_mean": "avg(funding_rate)",
                "funding_min": "min(funding_rate)",
                "funding_max": "max(funding_rate)",
            },
        )
    if dataset == "open_interest":
        oi = "open_interest"
        return _bars(
            deriv,
            {
                "oi_open": _first(oi),
                "oi_high": f"max({oi})",
                "oi_low": f"min({oi})",
                "oi_close": _last(oi),
                "oi_change": f"{_last(oi)} - {_first(oi)}",
                "oi_notional": _last(f"{oi} * mark_price"),
            },
        )
    columns = {}
    for kind in ("mark", "index"):
        price = f"{kind}_price"
        columns[f"{kind}_open"] = _first(price)
        columns[f"{kind}_high"] = f"max({price})"
        columns[f"{kind}_low"] = f"min({price})"
        columns[f"{kind}_close"] = _last(price)
    return _bars(deriv, columns)


def _asof(clock: str) -> list[str]:
    """Trades with the mid of the last quote; the highest id wins within a millisecond."""
    return [
        f"""mids AS (
  SELECT exchange, symbol, {clock}_ts AS quoted_at,
    arg_max((bid_price + ask_price) / 2, quote_id) AS mid
  FROM quotes GROUP BY exchange, symbol, {clock}_ts)""",
        f"""matched AS (
  SELECT trades.*, mids.mid
  FROM trades ASOF LEFT JOIN mids ON trades.exchange = mids.exchange
    AND trades.symbol = mids.symbol AND trades.{clock}_ts >= mids.quoted_at)""",
    ]


def _value(name: str, kind: str) -> str:
    if kind == "double":
        digits, amount = nudge(name)
        return f"round(CAST({name} AS DOUBLE) + {amount!r}::DOUBLE, {digits}) + 0.0 AS {name}"
    return f"CAST({name} AS BIGINT) AS {name}"


def _query(parts, names: list[str], keys: str, kinds: dict[str, str], where: str = "") -> str:
    ctes, columns, tail = parts
    inner = ", ".join(f"{text} AS {name}" for name, text in columns.items())
    ctes = [*ctes, f"bars AS (SELECT exchange, symbol, {inner} {tail})"]
    out = ", ".join(_value(name, kinds[name]) for name in names)
    return f"WITH {', '.join(ctes)} SELECT {keys}, {out} FROM bars {where}"


def _kinds(dataset: str) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in data_schema(dataset)}


def _bar_sql(
    dataset: str,
    interval: str = "4h",
    clock: str = "exchange",
    keys: str = "exchange, symbol, timestamp",
    where: str = "",
) -> str:
    parts = _dataset(dataset, INTERVAL_MS[interval], clock)
    return _query(parts, metric_columns(dataset), keys, _kinds(dataset), where)


_DATETIME = "strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d %H:%M:%S.%g')"


def _fetched(dataset: str) -> str:
    keys = (
        "exchange, symbol, '1d' AS interval, 'true' AS ts_kind, timestamp, "
        f"{_DATETIME} AS datetime"
    )
    return _bar_sql(dataset, "1d", "true", keys)


def _closed(dataset: str, clock: str) -> str:
    """Bars whose end the watermark (latest trade minus 30 minutes) has passed."""
    end = INTERVAL_MS["4h"]
    late = f"SELECT max({clock}_ts) - 1800000 FROM trades"
    return _bar_sql(dataset, "4h", clock, where=f"WHERE timestamp + {end} <= ({late})")


def _side_by_side(datasets: tuple[str, ...]) -> str:
    parts = []
    for dataset in datasets:
        names = ", ".join(f"{name} AS {dataset}_{name}" for name in metric_columns(dataset))
        parts.append(
            f"(SELECT exchange, symbol, timestamp, {names} FROM ({_bar_sql(dataset)}))"
        )
    keys = " USING (exchange, symbol, timestamp)"
    joined = parts[0] + "".join(f" JOIN {part}{keys}" for part in parts[1:])
    return f"SELECT * FROM {joined}"


def _sketched() -> str:
    """Quantiles that are one of the day's values, by rank."""
    picks = []
    for value, points in QUANTILES.items():
        for name, point in points.items():
            digits, amount = nudge(f"{value}_{name}")
            picks.append(
                f"round(quantile_disc({value}, {point}) + {amount:.12f}, {digits}) + 0.0 AS {value}_{name}"
            )
    day = INTERVAL_MS["1d"]
    return (
        f"WITH {_TRADES} SELECT exchange, symbol, exchange_ts - exchange_ts % {day} AS timestamp, "
        f"{', '.join(picks)} FROM trades GROUP BY ALL"
    )


def _stamped() -> str:
    return f"WITH {_TRADES}, s AS (SELECT trade_id, exchange_ts AS timestamp FROM trades)"


def _asof_sql(clock: str) -> str:
    ctes = ", ".join([_TRADES, _QUOTES, *_asof(clock)])
    return (
        f"WITH {ctes} SELECT trade_id, exchange, symbol, "
        f"{_value('price', 'double')}, {_value('mid', 'double')} FROM matched"
    )


def _requests(member: str) -> str:
    datasets = "[" + ", ".join(f"'{name}'" for name in DATASETS) + "]"
    intervals = "[" + ", ".join(f"'{name}'" for name in INTERVAL_MS) + "]"
    keys = "dataset, symbol, interval, ts_kind, start_date, end_date"
    return f"""WITH requests AS (
  SELECT event_id AS request_id, value,
    {datasets}[{_K} % {len(DATASETS)} + 1] AS dataset,
    'perpetual-S' || CAST(user_id % 5 AS VARCHAR) AS symbol,
    {intervals}[{_K} % {len(INTERVAL_MS)} + 1] AS interval,
    CASE WHEN {_K} % 2 = 0 THEN 'exchange' ELSE 'true' END AS ts_kind,
    strftime(date_trunc('week', ts), '%Y-%m-%d') AS start_date,
    strftime(date_trunc('week', ts) + INTERVAL 7 DAY, '%Y-%m-%d') AS end_date
  FROM events)
SELECT request_id, {keys} FROM requests
WHERE ({keys}) {member} (SELECT {keys} FROM requests WHERE value >= 60)"""


def _range(first, last, column: str = "timestamp") -> str:
    return f"{column} >= {day_ms(first)} AND {column} < {next_day_ms(last)}"


def sql_texts() -> dict[str, str]:
    from datetime import date

    series = "exchange, symbol, '4h' AS interval, 'exchange' AS ts_kind, timestamp"
    mid_month = _range(date(2024, 1, 10), date(2024, 1, 20))
    month = (
        "CAST(year(make_timestamp(timestamp * 1000)) AS INTEGER) AS year, "
        "CAST(month(make_timestamp(timestamp * 1000)) AS INTEGER) AS month"
    )
    in_january = _range(date(2024, 1, 1), date(2024, 1, 31))
    every_bar = " UNION ALL ".join(
        f"SELECT exchange, symbol, '{name}' AS interval, exchange_ts - exchange_ts % {ms} "
        f"AS timestamp, count(*) AS trades FROM trades GROUP BY ALL"
        for name, ms in INTERVAL_MS.items()
    )
    vwap_volume = _bars(
        [_TRADES, _rows("trades", "trade_id", INTERVAL_MS["1d"], "exchange")],
        {"vwap": "sum(price * qty) / sum(qty)", "volume": "sum(qty)"},
    )
    out = {
        "L1_load_dataset": _bar_sql(
            "ohlcv",
            keys=f"{series}, {_DATETIME} AS time, {_DATETIME} AS datetime",
            where=f"WHERE {_FIRST} AND symbol = '{SLICE_SYMBOL}' AND {_range(SLICE_FROM, SLICE_TO)}",
        ),
        "L2_month_pruning": _bar_sql(
            "ohlcv", keys=f"exchange, symbol, timestamp, {month}", where=f"WHERE {in_january}"
        ),
        "L2b_read_parquet": "SELECT event_id, user_id, event_type, value, props, "
        "strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts FROM events",
        "L3_concat_strict": "SELECT event_id, event_type, value FROM events",
        "L3_concat_merge": "SELECT event_id, event_type, "
        "CASE WHEN event_type IN ('signup', 'view', 'purchase') THEN value END AS value, "
        "CASE WHEN event_type IN ('error', 'view') THEN CAST(user_id AS DOUBLE) END AS user_id, "
        "CASE WHEN event_type IN ('purchase', 'click') THEN props END AS props FROM events",
        "L4_from_epoch_ms": f"{_stamped()} SELECT *, {_DATETIME} AS datetime FROM s",
        "L5_filter_datetime_range": f"{_stamped()} SELECT * FROM s WHERE {mid_month}",
        "L6_sort_by": f"{_stamped()} SELECT * FROM s ORDER BY timestamp",
        "L7_has_column": "SELECT event_id, value, CAST(year(ts) AS INTEGER) AS year, "
        "CAST(month(ts) AS INTEGER) AS month FROM events",
        "L8_empty_result": _bar_sql("ohlcv", where="WHERE timestamp < 0"),
        "L9_list_symbols": f"WITH {_TRADES} SELECT DISTINCT symbol FROM trades WHERE {_FIRST}",
        "L10_symbol_prefix": f"WITH {_TRADES} SELECT trade_id, symbol FROM trades "
        "WHERE starts_with(symbol, 'perpetual-')",
        "L11_preview_served": _requests("IN"),
        "L11_preview_refused": _requests("NOT IN"),
        "L12_month_gaps": f"""WITH {_TRADES},
months AS (SELECT unnest([202312, 202401, 202402]) AS m),
seen AS (SELECT DISTINCT exchange, symbol,
    year(make_timestamp(exchange_ts * 1000)) * 100 + month(make_timestamp(exchange_ts * 1000))
      AS m
  FROM trades WHERE {_FIRST})
SELECT exchange, symbol, CAST(m // 100 AS INTEGER) AS year, CAST(m % 100 AS INTEGER) AS month
FROM (SELECT exchange, symbol, m FROM (SELECT DISTINCT exchange, symbol FROM seen), months
  EXCEPT SELECT * FROM seen)""",
        "L13_panel": _bar_sql(
            "ohlcv", where=f"WHERE {_range(date(2024, 1, 3), date(2024, 3, 10))}"
        ),
        "L14_write_lake": _bar_sql("ohlcv", keys=f"{series}, {month}, {_DATETIME} AS time"),
        "L14_write_in_parts": _bar_sql("ohlcv", keys=f"{series}, {month}, {_DATETIME} AS time"),
        "L11_preview_fetch": _bar_sql(
            "ohlcv", where=f"WHERE {_FIRST} AND symbol = '{SLICE_SYMBOL}' AND {_range(SLICE_FROM, SLICE_TO)}"
        ),
        "L3_lake_strict": _bar_sql("ohlcv"),
        "L14_load_deltas": _bar_sql("ohlcv"),
        "L14_compacted_deltas": _bar_sql("ohlcv"),
        "L3_lake_merge": _bar_sql(
            "ohlcv",
            keys="exchange, symbol, timestamp, "
            f"CASE WHEN timestamp >= {PART_CUT} THEN CAST(timestamp AS DOUBLE) END AS stamp",
        ),
        "B9_returns_in_parts": _bar_sql("returns"),
        "B10_slippage_in_parts": _bar_sql("slippage"),
        "get_ohlcv": _fetched("ohlcv"),
        "get_vwap": _fetched("vtwap"),
        "get_twap": _fetched("vtwap"),
        "get_symbols": f"WITH {_TRADES} SELECT symbol FROM trades WHERE {_FIRST} GROUP BY symbol",
        "X1_time_bucket": f"WITH {_TRADES} {every_bar}",
        "X1_time_bucket_true": f"WITH {_TRADES} SELECT trade_id, "
        "epoch_ms(date_trunc('day', make_timestamp(true_ts * 1000))) AS timestamp FROM trades",
        "X2_asof_join": _asof_sql("exchange"),
        "X2_asof_join_true": _asof_sql("true"),
        "X2b_asof_day_seeded": _asof_sql("exchange"),
        "X2_asof_balanced_true": _asof_sql("true"),
        "B10_slippage_balanced": _bar_sql("slippage"),
        "X3_resample_ohlcv": _bar_sql("ohlcv", "1d"),
        "X3_resample_vwap": _query(
            vwap_volume,
            ["vwap", "volume"],
            "exchange, symbol, timestamp",
            {"vwap": "double", "volume": "double"},
        ),
        "X3_resample_flow": _bar_sql("flow", "1d"),
        "X3_resample_open_interest": _bar_sql("open_interest", "1d"),
        "X3_sketch_quantiles": _sketched(),
        "X4_stream_ohlcv": _closed("ohlcv", "exchange"),
        "X4_stream_ohlcv_true": _closed("ohlcv", "true"),
        "X4_stream_flow": _closed("flow", "exchange"),
        "X4_stream_resample_ohlcv": _closed("ohlcv", "exchange"),
        "X4_stream_resample_flow": _closed("flow", "true"),
        "L14_write_datasets_sized": _side_by_side(SIZED_GROUP),
        "X4_stream_to_lake_ohlcv": _bar_sql("ohlcv"),
        "X4_stream_to_lake_flow": _bar_sql("flow"),
        **{
            f"L14_write_datasets_{name}": _side_by_side(datasets)
            for name, datasets in GROUPS.items()
        },
    }
    for number, dataset in enumerate(DATASETS, start=1):
        out[f"B{number}_{dataset}"] = out[f"measured_{dataset}"] = _bar_sql(dataset)
    for dataset in LATE_DATASETS:
        out[f"L14_late_{dataset}"] = _bar_sql(dataset)
    for dataset in FROM_STATES:
        for interval in ("1h", "1d"):
            out[f"X3_states_{dataset}_{interval}"] = _bar_sql(dataset, interval)
    for interval in FINE_INTERVALS:
        for dataset in FINE_DATASETS:
            out[f"{dataset}_{interval}"] = _bar_sql(dataset, interval)
    for metric in (*TRADE_METRICS, *L1_METRICS, *L2_METRICS):
        out[f"get_metrics_{metric}"] = _fetched(metric)
    for metric in DERIVATIVE_METRICS:
        out[f"get_derivative_metrics_{metric}"] = _fetched(metric)
    return out
