import pytest

from tests.helpers import same
from tickloom.operators.resample import resample, vwap_with_volume
from tickloom.plans.build import build


@pytest.mark.parametrize("dataset", ["ohlcv", "flow", "open_interest"])
def test_merged_bars_equal_direct_ones(small, dataset):
    merged = resample(build(dataset, small, "1h", "true"), dataset, "1d")
    same(merged, build(dataset, small, "1d", "true"))


def test_vwap(small):
    fine = vwap_with_volume(build("vtwap", small, "1h"), build("ohlcv", small, "1h"))
    keys = ["exchange", "symbol", "timestamp", "vwap"]
    same(resample(fine, "vtwap", "1d").select(keys), build("vtwap", small, "1d").select(keys))
    with pytest.raises(ValueError, match="volume"):
        resample(build("vtwap", small, "1h"), "vtwap", "1d")


def test_others_cannot_be_merged(small):
    with pytest.raises(ValueError, match="cannot be merged"):
        resample(build("returns", small, "1h"), "returns", "1d")
