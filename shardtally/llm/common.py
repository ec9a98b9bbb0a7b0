"""What several operators share: reading tables, shipping the package, words of a text."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps
from pathlib import Path

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the contracts: a word is a run of anything but blank, tab, line feed, vertical tab,
#: form feed and carriage return. ``bytes.split()`` cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
MASK = (1 << 64) - 1

_shipped: set[str] = set()


#: Bytes that go to a Python worker at once, where the session has not set it: texts may be long.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"
#: Words whose hashes a worker keeps.
HASHES = 150_000


def ship(spark: SparkSession) -> None:
    """Makes the package importable in the Python workers of this application."""
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="shardtally-py-")) / "shardtally.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallel(df: DataFrame) -> int:
    """Partitions to deal rows into: the session's shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two columns that are equal for repeated rows only (null ids and texts included)."""
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)).cast("long")).alias("_k1"),
        F.xxhash64(F.col(doc_id).isNull(), F.col(text)).alias("_k2"),
    ]


def release() -> None:
    """Gives a worker's free memory back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries than glibc
        ctypes.CDLL(None).malloc_trim(0)


def lean(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` (an iterator of batches to an iterator of results), after which the worker gives free memory back.

    Workers wait for their next task, also one of another stage, with all that the last one has touched.
    """

    @wraps(function)
    def rows(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            release()

    return rows


def longs(values: list[int | None]) -> pd.api.extensions.ExtensionArray:
    """A nullable column of 64-bit integers for a result frame; no value passes through a double."""
    return pd.array(values, dtype="Int64")


class Hashes(dict):
    """64-bit hash of each word seen, as signed-free integers for numpy."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HASHES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value
