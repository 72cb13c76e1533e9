"""The bar lake: monthly Parquet, written once and loaded by series and date range.

Layout: ``root/dataset/interval=/ts_kind=/exchange=/year=/month=/symbol=/*.parquet``.
Months come before symbols, so a load names its months in the path: Spark then lists
the folders of those months only, not the whole lake.

A write may also leave the stored months alone and add its bars as a delta, below
``root/delta/dataset/interval=/ts_kind=/load=/...``. A load puts the last bar of each
(series, timestamp) on top; ``compact`` folds deltas into their months.
"""

from __future__ import annotations

import logging
import re
import time
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.catalogue import (
    EXCHANGES,
    PARTITIONS,
    SERIES,
    check_dataset,
    check_exchange,
    check_interval,
    check_ts_kind,
    data_schema,
    lake_schema,
    metric_columns,
    partition_schema,
)
from tickloom.functions.clock import month_number, ntz_from_ms
from tickloom.session import shared_folder
from tickloom.sources.frames import SchemaMismatch, trim

log = logging.getLogger(__name__)
Names = str | Sequence[str] | None


def write_lake(
    bars: DataFrame,
    root: str,
    dataset: str,
    interval: str,
    ts_kind: str,
    *,
    replace_months: bool = False,
    delta: bool = False,
    load_name: str | None = None,
) -> str:
    """Write bars of one dataset, interval and clock.

    Bars written before stay: where a month of a series is there already, old and new bars
    are merged and new ones win, so a day or a week can be loaded on its own. Both sides
    are bar tables, and only the months that the new bars span are read.
    ``replace_months`` drops what the touched months held instead.

    ``delta`` reads no stored bar and rewrites no month: the bars go into a folder of their own
    (``load_name``, by default the time of the call; a later name wins, and the same name again
    replaces its bars). Any other write folds pending deltas in first.

    A series holds at most one row per interval, so a month folder is bounded by the
    calendar (2.7 million rows at 1s), however many trades stand behind it. The
    rebalance hint lets AQE join small partitions and split large ones; rows are sorted
    by time inside a file, which makes row-group statistics useful to a range filter.
    Interval and clock go into the path and not among the sort keys: a constant key is
    optimized away, and Spark would then sort again by folder only.
    """
    check_interval(interval)
    check_ts_kind(ts_kind)
    stamp = ntz_from_ms(F.col("timestamp"))
    types = {field.name: field.dataType for field in lake_schema(dataset)}
    missing = F.lit(False)
    for name in (*SERIES, "timestamp"):
        missing = missing | F.col(name).isNull()
    fail = F.raise_error(F.lit("bar without exchange, symbol or timestamp")).cast("string")
    columns = {
        "timestamp": F.col("timestamp"),
        "time": stamp,
        **{name: F.col(name) for name in metric_columns(dataset)},
        # Depends on the row, so it is no constant even if there is one exchange.
        "exchange": F.when(missing, fail).otherwise(F.col("exchange")),
        "year": F.year(stamp),
        "month": F.month(stamp),
        "symbol": F.col("symbol"),
    }
    rows = bars.select(
        *(column.cast(types[name]).alias(name) for name, column in columns.items())
    )
    folders = [name for name in PARTITIONS if name not in ("interval", "ts_kind")]
    path = f"{root}/{dataset}/interval={interval}/ts_kind={ts_kind}"
    if delta:
        name = load_name or f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        path = f"{_delta_root(root, dataset, interval, ts_kind)}/load={name}"
    else:
        compact(rows.sparkSession, root, dataset, interval, ts_kind)
        if not replace_months:
            rows = _with_stored(rows, path, folders)
    _write(rows, path, folders, whole=delta)
    return path


def _write(rows: DataFrame, path: str, folders: list[str], *, whole: bool = False) -> None:
    by_folder = [F.col(name) for name in folders]
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        rows = rows.hint("rebalance", *by_folder)
    else:  # the hint would be ignored
        rows = rows.repartition(*by_folder)
    (
        rows.sortWithinPartitions(*folders, "timestamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def _with_stored(rows: DataFrame, path: str, folders: list[str]) -> DataFrame:
    """``rows`` and the bars stored in the folders they touch, read from a staged copy.

    Only the months between the first and the last new bar are listed.
    """
    spark = rows.sparkSession
    rows = _staged(rows, "merge")
    months = month_span(rows)
    stored = read_months(spark, path, rows.schema, months) if months else None
    if stored is None:
        return rows
    old = stored.join(rows.select(*folders).distinct(), folders, "left_semi").join(
        rows.select(*SERIES, "timestamp"), [*SERIES, "timestamp"], "left_anti"
    )
    return _staged(old.select(rows.columns).unionByName(rows), "merge")


def _staged(df: DataFrame, purpose: str) -> DataFrame:
    where = shared_folder(df.sparkSession, purpose)
    df.write.parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def month_span(rows: DataFrame) -> list[tuple[int, int]]:
    """Months from the first to the last bar of ``rows`` (columns year and month)."""
    month = F.col("year") * 12 + F.col("month")
    span = rows.agg(F.min(month).alias("first"), F.max(month).alias("last")).first()
    if span.first is None:
        return []
    return [((n - 1) // 12, (n - 1) % 12 + 1) for n in range(span.first, span.last + 1)]


def read_months(
    spark: SparkSession, path: str, schema, months: Sequence[tuple[int, int]]
) -> DataFrame | None:
    """Stored bars of the named months, all exchanges; None if there is no such folder.

    ``path`` is one interval and clock of a dataset. Other months are not listed.
    """
    named = _any_of([f"year={y}/month={m}" for y, m in months])
    try:
        reader = spark.read.schema(schema).option("basePath", path)
        return reader.parquet(f"{path}/{_any_of([f'exchange={n}' for n in EXCHANGES])}/{named}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# Deltas -----------------------------------------------------------------------------


def _delta_root(root: str, dataset: str, interval: str, ts_kind: str) -> str:
    return f"{root}/delta/{dataset}/interval={interval}/ts_kind={ts_kind}"


def _pending(spark: SparkSession, where: str) -> list:
    """Paths of the loads below ``where`` that are not folded in; one listing of one folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return [s.getPath() for s in system.listStatus(path) if s.getPath().getName().startswith("load=")]


def _latest(deltas: DataFrame) -> DataFrame:
    """The bar of the last load for each (series, timestamp)."""
    keys = [*SERIES, "timestamp"]
    rest = [name for name in deltas.columns if name not in (*keys, "load")]
    found = deltas.groupBy(*keys).agg(F.max_by(F.struct(*rest), "load").alias("bar"))
    return found.select(*keys, "bar.*")


def with_deltas(stored: DataFrame, deltas: DataFrame) -> DataFrame:
    """Stored bars with the last delta of each (series, timestamp) on top.

    Deltas are combined first; stored bars meet only their keys.
    """
    latest = _latest(deltas)
    keys = [*SERIES, "timestamp"]
    kept = stored.join(latest.select(*keys), keys, "left_anti")
    shared = [name for name in kept.columns if name in latest.columns]
    return kept.unionByName(latest.select(shared), allowMissingColumns=True)


def compact(
    spark: SparkSession, root: str, dataset: str, interval: str, ts_kind: str
) -> int:
    """Fold the pending deltas of one dataset, interval and clock into their months.

    Only months that a delta touches are read and rewritten. A delta goes after its bars are in
    their months; a run that stops in between leaves deltas that say the same as the months,
    and the next run removes them. Loads that begin meanwhile stay pending. Returns the number
    of loads folded in. Nobody should be reading the touched months.
    """
    check_dataset(dataset), check_interval(interval), check_ts_kind(ts_kind)
    loads = _pending(spark, _delta_root(root, dataset, interval, ts_kind))
    if not loads:
        return 0
    where = _delta_root(root, dataset, interval, ts_kind)
    folders = [name for name in PARTITIONS if name not in ("interval", "ts_kind")]
    schema = lake_schema(dataset)
    names = [f for f in schema.fieldNames() if f not in ("interval", "ts_kind")]
    kinds = ", ".join(f"`{n}` {schema[n].dataType.simpleString()}" for n in names)
    deltas = (
        spark.read.schema(f"{kinds}, load string")
        .option("basePath", where)
        .parquet(*(path.toString() for path in loads))
    )
    path = f"{root}/{dataset}/interval={interval}/ts_kind={ts_kind}"
    _write(_with_stored(_latest(deltas).select(names), path, folders), path, folders)
    for load_path in loads:
        load_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(load_path, True)
    return len(loads)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def empty_result(spark: SparkSession, dataset: str) -> DataFrame:
    """No rows, with the columns of the dataset."""
    return spark.createDataFrame([], lake_schema(dataset))


def months_between(start_date: date, end_date: date) -> list[tuple[int, int]]:
    first, last = month_number(start_date), month_number(end_date)
    return [((n - 1) // 12, (n - 1) % 12 + 1) for n in range(first, last + 1)]


def _any_of(names: Sequence[str]) -> str:
    return names[0] if len(names) == 1 else "{" + ",".join(names) + "}"


def _as_list(names: Names) -> list[str] | None:
    if names is None:
        return None
    return [names] if isinstance(names, str) else list(names)


def check_request(
    dataset: str,
    timestamp: str,
    interval: str,
    exchange: Names,
    start_date: date,
    end_date: date,
) -> None:
    check_dataset(dataset)
    check_ts_kind(timestamp)
    check_interval(interval)
    for name in _as_list(exchange) or []:
        check_exchange(name)
    if start_date > end_date:
        raise ValueError(f"start date {start_date} is after end date {end_date}")


#: Dates of a scan that takes every month there is.
EARLIEST, LATEST = date(1, 1, 1), date(9999, 12, 31)


def _month_paths(exchange, start_date, end_date) -> str:
    if (start_date, end_date) == (EARLIEST, LATEST):
        return f"{_any_of([f'exchange={name}' for name in _as_list(exchange) or EXCHANGES])}"
    months = [f"year={y}/month={m}" for y, m in months_between(start_date, end_date)]
    exchanges = [f"exchange={name}" for name in _as_list(exchange) or EXCHANGES]
    return f"{_any_of(exchanges)}/{_any_of(months)}"


def scan_months(
    spark: SparkSession,
    root: str,
    dataset: str,
    timestamp: str,
    interval: str,
    exchange: Names,
    symbol: Names,
    start_date: date,
    end_date: date,
    *,
    schema_mode: str = "declared",
) -> DataFrame:
    """The months a date range touches, unfiltered inside; also the input of ``load``.

    ``schema_mode``: ``declared`` reads the dataset's own columns; ``strict`` first
    compares the files with them; ``merge`` also keeps columns found in only some files.
    """
    if schema_mode not in ("declared", "strict", "merge"):
        raise ValueError(f"unknown schema mode {schema_mode!r}")
    months = _month_paths(exchange, start_date, end_date)
    where = f"{root}/{dataset}/interval={interval}/ts_kind={timestamp}/{months}"

    def reader():
        return spark.read.option("basePath", f"{root}/{dataset}")

    schema = lake_schema(dataset)
    try:
        if schema_mode == "merge":
            for field in reader().option("mergeSchema", "true").parquet(where).schema:
                if field.name not in schema.names:
                    schema.add(field)
        df = reader().schema(schema).parquet(where)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = None
    deltas = _read_deltas(spark, root, dataset, timestamp, interval, months)
    if df is None and deltas is None:
        log.warning("no file for %s", where)
        return empty_result(spark, dataset)

    def narrow(rows: DataFrame) -> DataFrame:
        month = F.col("year") * 12 + F.col("month")
        rows = rows.where(month.between(month_number(start_date), month_number(end_date)))
        for name, wanted in (("symbol", _as_list(symbol)), ("exchange", _as_list(exchange))):
            if wanted is not None:
                rows = rows.where(F.col(name).isin(wanted))
        return rows

    if df is None:  # the deltas are all there is
        return with_deltas(empty_result(spark, dataset), narrow(deltas))
    df = narrow(df)
    if schema_mode == "strict":
        _check_files(dataset, reader(), df, where)
    return df if deltas is None else with_deltas(df, narrow(deltas))


def _read_deltas(spark, root, dataset, timestamp, interval, months) -> DataFrame | None:
    schema = lake_schema(dataset).add("load", "string")
    where = f"{_delta_root(root, dataset, interval, timestamp)}/load=*/{months}"
    try:
        return spark.read.schema(schema).option("basePath", f"{root}/delta/{dataset}").parquet(where)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _footer_columns(batches):
    """Column names of Parquet files, read from their footers inside the tasks."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        names = []
        for uri in batch["file_path"]:
            uri = re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "file:///", uri))
            where, path = fs.FileSystem.from_uri(uri)
            names.append(sorted(pq.read_schema(path, filesystem=where).names))
        yield batch.assign(names=names)


def _check_files(dataset: str, reader, rows: DataFrame, where: str) -> None:
    """Raise if a file to be read lacks a column, has another one, or another type.

    Types are compared on the schema Spark merges from all footers, column names file
    by file. Both steps run as Spark jobs.
    """
    declared = {(f.name, f.dataType.simpleString()) for f in data_schema(dataset)}
    try:
        merged = reader.option("mergeSchema", "true").parquet(where).schema
    except Exception as error:  # Spark's own or a Java error, by version
        if "MERGE" not in str(error).upper():
            raise
        raise SchemaMismatch(f"{dataset}: files disagree on a column type") from error
    found = {(f.name, f.dataType.simpleString()) for f in merged if f.name not in PARTITIONS}
    if found - declared:
        raise SchemaMismatch(f"{dataset}: unexpected {sorted(found - declared)}")
    wanted = F.array(*(F.lit(name) for name, _ in sorted(declared)))
    odd = (
        rows.select(F.col("_metadata.file_path").alias("file_path"))
        .distinct()
        .mapInPandas(_footer_columns, "file_path string, names array<string>")
        .where(F.col("names") != wanted)
        .first()
    )
    if odd is not None:
        raise SchemaMismatch(f"{odd.file_path}: columns {odd.names}")


def load(
    spark: SparkSession,
    root: str,
    dataset: str,
    timestamp: str,
    interval: str,
    exchange: Names,
    symbol: Names,
    start_date: date,
    end_date: date,
    *,
    sort: bool = True,
    schema_mode: str = "declared",
    output: str = "spark",
):
    """Bars of a dataset for one symbol, a list of symbols, or all (``None``).

    Days are UTC and both ends are included. ``output="pandas"`` collects the result;
    leave it for slices that fit on the driver. The sort costs a range shuffle and can
    be switched off.
    """
    check_request(dataset, timestamp, interval, exchange, start_date, end_date)
    if output not in ("spark", "pandas"):
        raise ValueError(f"unknown output {output!r}; spark or pandas")
    df = scan_months(
        spark,
        root,
        dataset,
        timestamp,
        interval,
        exchange,
        symbol,
        start_date,
        end_date,
        schema_mode=schema_mode,
    )
    order = ("timestamp", "exchange", "symbol") if sort else None
    df = trim(df, start_date, end_date, order)
    keys = ["exchange", "symbol", "interval", "ts_kind"]
    rest = [name for name in df.columns if name not in (*keys, "year", "month")]
    df = df.select(*keys, *rest)
    return df.toPandas() if output == "pandas" else df


def load_files(
    spark: SparkSession,
    path: str,
    start_date: date,
    end_date: date,
    *,
    schema_mode: str = "merge",
    sort: bool = True,
) -> DataFrame:
    """Foreign monthly Parquet: range filter and sort only if it has ``timestamp``."""
    df = spark.read.option("mergeSchema", str(schema_mode == "merge").lower()).parquet(path)
    return trim(df, start_date, end_date, ("timestamp",) if sort else None)


def partition_rows(
    spark: SparkSession,
    root: str,
    dataset: str,
    exchange: Names = None,
    interval: str | None = None,
    ts_kind: str | None = None,
) -> DataFrame:
    """The folder names of each stored file, one row per file, for symbol lists and gaps.

    Files are listed, their content is not read. What is known goes into the path.
    """
    exchanges = [f"exchange={check_exchange(n)}" for n in _as_list(exchange) or EXCHANGES]
    clocks = f"{check_dataset(dataset)}/interval={interval or '*'}/ts_kind={ts_kind or '*'}"
    files = None
    for where in (f"{root}/{clocks}", f"{root}/delta/{clocks}/load=*"):
        try:
            found = (
                spark.read.format("binaryFile")
                .option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "*.parquet")
                .load(f"{where}/{_any_of(exchanges)}")
                .select("path")
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        files = found if files is None else files.unionByName(found)
    if files is None:
        return spark.createDataFrame([], partition_schema())

    def folder(field) -> Column:
        found = F.regexp_extract("path", f"/{field.name}=([^/]*)/", 1)
        # Folder names are percent-encoded; a plus sign stands for itself.
        return F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))).cast(field.dataType)

    return files.select(*(folder(f).alias(f.name) for f in partition_schema()))
