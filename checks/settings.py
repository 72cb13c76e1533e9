"""Parameters shared by the registered queries and their SQL."""

from datetime import date

from tickloom.catalogue import DATASETS

LIMITS = (700.0, 2400.0)
FIRST_DAY, LAST_DAY = date(2020, 1, 1), date(2030, 12, 31)
SLICE_SYMBOL = "perpetual-S1-USDT:USDT"
SLICE_FROM, SLICE_TO = date(2024, 1, 5), date(2024, 1, 10)

# Where a load in two parts is cut (16 January 2024), and the slice size that makes
# ``measure`` cut bars of the generated data.
PART_CUT = 1705363200000
MEASURED_ROWS = 5

FINE_INTERVALS = ("1m", "5m", "1h")
FINE_DATASETS = DATASETS

# Datasets that are brought up to date after late ticks.
LATE_DATASETS = ("ohlcv", "trade_size", "run_structure", "returns", "slippage", "l1_price")

GROUPS = {
    "tally": ("ohlcv", "flow", "trade_size", "range"),
    "path": ("vtwap", "impact", "updownticks", "returns"),
    "quotes": ("l1_imbalance", "l1_liquidity"),
    "book": ("l2_imbalance", "l2_liquidity"),
    "deriv": ("basis", "funding", "open_interest", "derivative_price"),
}

# Written together with measured slices: members of one pass, and datasets built alone.
SIZED_GROUP = ("vtwap", "updownticks", "returns", "run_structure", "slippage")

# Digits to compare; 6 unless named, more for small values.
DIGITS = {
    "basis_mean": 10,
    "funding_rate": 12,
    "funding_mean": 12,
    "funding_min": 12,
    "funding_max": 12,
    "amihud": 10,
}


def nudge(name: str) -> tuple[int, float]:
    """Digits to round to, and a small amount added before, the same on both sides.

    Means of short decimals often lie exactly between two rounded values, where the
    last bit of a sum would decide. The amount moves them off that point.
    """
    digits = DIGITS.get(name, 6)
    return digits, 3.1 * 10.0 ** -(digits + 2)
