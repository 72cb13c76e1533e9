from datetime import date
from pathlib import Path

import pytest

from tests.test_lake import A, B, X, bars_of, closes
from tickloom.functions.clock import day_ms
from tickloom.sources import lake, reports

TARGET = ("ohlcv", "1d", "exchange")
DAYS = [day_ms(date(2024, m, d)) for m in (1, 2, 3) for d in (1, 2, 3)]


def load(spark, root, symbol=None, **options):
    return lake.load(
        spark, root, "ohlcv", "exchange", "1d", X, symbol, date(2024, 1, 1), date(2024, 3, 31), **options
    )


def values(df):
    return {(r.symbol, r.timestamp): r.close for r in df.collect()}


@pytest.fixture
def stored(spark, root):
    lake.write_lake(bars_of(spark, [(s, ts, i) for s in (A, B) for i, ts in enumerate(DAYS)]), root, *TARGET)
    return root


def files(root):
    found = Path(root, "ohlcv").rglob("*.parquet")
    return {str(p): p.stat().st_mtime_ns for p in found}


def test_a_delta_reads_and_rewrites_no_stored_bar(spark, stored, monkeypatch):
    before = files(stored)

    def refuse(*_, **__):
        raise AssertionError("a stored bar was read")

    for name in ("read_months", "_with_stored", "scan_months", "compact"):
        monkeypatch.setattr(lake, name, refuse)
    lake.write_lake(bars_of(spark, [(A, DAYS[4], 40.0)]), stored, *TARGET, delta=True)
    assert files(stored) == before
    monkeypatch.undo()
    assert values(load(spark, stored))[(A, DAYS[4])] == 40.0


def test_the_last_load_wins_and_compaction_keeps_it(spark, stored):
    for value in (1.5, 2.5, 3.5):
        lake.write_lake(bars_of(spark, [(A, DAYS[0], value), (B, DAYS[8] + 86_400_000, value)]), stored, *TARGET, delta=True)
    before = files(stored)
    want = values(load(spark, stored))
    assert want[(A, DAYS[0])] == want[(B, DAYS[8] + 86_400_000)] == 3.5 and len(want) == 19
    assert lake.compact(spark, stored, *TARGET) == 3
    assert values(load(spark, stored)) == want
    after = files(stored)
    # February, and the other series' months, were not rewritten
    assert {p for p in before if "month=2" in p} <= {p for p, t in after.items() if before.get(p) == t}
    assert lake.compact(spark, stored, *TARGET) == 0


def test_compaction_that_stopped_before_the_end_runs_again(spark, stored, monkeypatch):
    lake.write_lake(bars_of(spark, [(A, DAYS[0], 5.0)]), stored, *TARGET, delta=True)
    write = lake._write

    def stop_after(*args, **options):
        write(*args, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr(lake, "_write", stop_after)
    with pytest.raises(RuntimeError):
        lake.compact(spark, stored, *TARGET)
    monkeypatch.undo()
    want = values(load(spark, stored))
    assert want[(A, DAYS[0])] == 5.0 and len(want) == 18
    assert lake.compact(spark, stored, *TARGET) == 1
    assert values(load(spark, stored)) == want


def test_other_writes_come_after_pending_deltas(spark, stored):
    lake.write_lake(bars_of(spark, [(A, DAYS[0], 5.0), (A, DAYS[3], 5.0)]), stored, *TARGET, delta=True)
    lake.write_lake(bars_of(spark, [(A, DAYS[0], 6.0)]), stored, *TARGET)
    found = values(load(spark, stored))
    assert found[(A, DAYS[0])] == 6.0 and found[(A, DAYS[3])] == 5.0
    lake.write_lake(bars_of(spark, [(A, DAYS[4], 7.0)]), stored, *TARGET, delta=True)
    lake.write_lake(bars_of(spark, [(A, DAYS[3], 8.0)]), stored, *TARGET, replace_months=True)
    assert closes(load(spark, stored, A, sort=True)) == [6.0, 1.0, 2.0, 8.0, 6.0, 7.0, 8.0]


def test_deltas_alone_and_under_all_schema_modes(spark, root, stored):
    empty = f"{root}-empty"
    lake.write_lake(bars_of(spark, [(A, DAYS[0], 5.0)]), empty, *TARGET, delta=True)
    assert values(load(spark, empty)) == {(A, DAYS[0]): 5.0}
    assert [r.symbol for r in reports.list_symbols(spark, empty, X).collect()] == [A]
    lake.write_lake(bars_of(spark, [(A, DAYS[0], 5.0)]), stored, *TARGET, delta=True)
    for mode in ("declared", "strict", "merge"):
        assert values(load(spark, stored, schema_mode=mode))[(A, DAYS[0])] == 5.0


def test_the_same_load_name_replaces_its_bars(spark, stored):
    for value in (5.0, 6.0):
        lake.write_lake(bars_of(spark, [(A, DAYS[0], value)]), stored, *TARGET, delta=True, load_name="x")
    assert values(load(spark, stored))[(A, DAYS[0])] == 6.0
    assert lake.compact(spark, stored, *TARGET) == 1


def test_empty_delta(spark, stored):
    want = values(load(spark, stored))
    lake.write_lake(bars_of(spark, []), stored, *TARGET, delta=True)
    assert values(load(spark, stored)) == want
    lake.compact(spark, stored, *TARGET)
    assert values(load(spark, stored)) == want


def test_a_merge_lists_only_its_months(spark, stored, monkeypatch):
    seen = []
    read = lake.read_months

    def watch(spark, path, schema, months):
        seen.append(months)
        return read(spark, path, schema, months)

    monkeypatch.setattr(lake, "read_months", watch)
    lake.write_lake(bars_of(spark, [(A, DAYS[3], 9.0)]), stored, *TARGET)
    assert seen == [[(2024, 2)]]
