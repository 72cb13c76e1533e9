"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import shared_folder

#: Words end at ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts lineage in a folder that every executor shares, so a lost executor costs
    nothing that was computed before.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@functools.cache
def _shipped(application: str, package: Path) -> str:
    path = Path(tempfile.mkdtemp(prefix="ship-"), f"{package.name}_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    return str(path)


def ship(spark: SparkSession) -> None:
    """Send this package's code (a few KB) to the executors, once per application.

    Python functions in a plan are found there by name, wherever the driver was started.
    """
    context = spark.sparkContext
    before = _shipped.cache_info().misses
    path = _shipped(context.applicationId, Path(__file__).resolve().parents[1])
    if _shipped.cache_info().misses > before:
        context.addPyFile(path)


def parts(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that a task holds few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def unused(docs: DataFrame, name: str) -> str:
    """``name``, or what follows from it, such that ``docs`` has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def count_words(text: Column) -> Column:
    """Number of words without building them; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, salt: str = "") -> Column:
    """A number strictly between 0 and 1 that depends on ``key`` (null as empty) alone.

    52 bits of an MD5 digest, so that SQL engines agree on it.
    """
    digest = F.md5(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(2**52))
