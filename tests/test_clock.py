from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import only
from tickloom.catalogue import INTERVAL_MS
from tickloom.functions import clock

MIDNIGHT = 1704067200000  # 2024-01-01


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_epoch_conversion_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = clock.from_epoch_ms(spark.createDataFrame([(MIDNIGHT + 123,)], "timestamp bigint"))
        text = only(df.select(F.col("datetime").cast("string").alias("text")))["text"]
        assert df.schema["datetime"].dataType.typeName() == "timestamp_ntz"
        back = only(df.select(clock.ms_from_ntz(F.col("datetime")).alias("ms")))["ms"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert text == "2024-01-01 00:00:00.123"
    assert back == MIDNIGHT + 123


def test_input_frame_is_left_alone(spark):
    df = spark.createDataFrame([(MIDNIGHT,)], "timestamp bigint")
    clock.from_epoch_ms(df)
    assert df.columns == ["timestamp"]


def test_buckets_align_to_midnight(spark):
    moment = MIDNIGHT + 13 * 3_600_000 + 37 * 60_000 + 12_345
    for name, width in INTERVAL_MS.items():
        bar = only(
            spark.range(1).select(clock.time_bucket(F.lit(moment), width).alias("bar"))
        )["bar"]
        assert bar <= moment < bar + width, name
        assert (bar - MIDNIGHT) % width == 0
        assert clock.DAY_MS % width == 0


def test_bucket_before_1970(spark):
    bar = only(spark.range(1).select(clock.time_bucket(F.lit(-1), 1000).alias("bar")))["bar"]
    assert bar == -1000


def test_day_bounds():
    assert clock.day_ms(date(2024, 1, 1)) == MIDNIGHT
    assert clock.next_day_ms(date(2024, 2, 29)) == clock.day_ms(date(2024, 3, 1))


def test_unknown_interval():
    with pytest.raises(ValueError, match="interval"):
        clock.interval_ms("2h")
