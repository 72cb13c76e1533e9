import math

import pandas as pd


def only(df):
    """The single row of a frame, as a dict."""
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def close(got, want, tolerance=1e-9):
    if want is None or (isinstance(want, float) and math.isnan(want)):
        return got is None or (isinstance(got, float) and math.isnan(got))
    if got is None:
        return False
    return math.isclose(got, want, rel_tol=tolerance, abs_tol=tolerance)


def check(row, **want):
    for name, value in want.items():
        assert close(row[name], value), f"{name}: {row[name]} is not {value}"


def same(one, other, keys=("exchange", "symbol", "timestamp"), tolerance=1e-8):
    """Two Spark frames hold the same rows."""
    a, b = (
        df.toPandas().sort_values(list(keys)).reset_index(drop=True)[sorted(one.columns)]
        for df in (one, other)
    )
    pd.testing.assert_frame_equal(a, b, rtol=tolerance, atol=tolerance, check_dtype=False)
