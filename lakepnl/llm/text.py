"""Whole Arrow batches of text as byte arrays: word spans and word hashes without a loop over words.

A word is a run of bytes of one class, so that UTF-8 never has to be decoded. Batches are
cut into slices of about SLICE bytes at document ends, which bounds the memory of a task to
that or to its longest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakepnl.session import new_folder, ship_package

SLICE = 1 << 20
ROWS_PER_BATCH = 500

_ALL = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, all other bytes as they are.
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint8)
LOWER_TABLE = LOWER.tobytes()
#: Bytes that are not space and not \t to \r.
NOT_SPACE = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))
#: Digits, lower-case letters and all bytes of characters beyond ASCII.
ALNUM = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def small_batches(spark: SparkSession) -> None:
    """Batches between the JVM and Python hold few rows, as texts can be long; workers get this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def large_batches(spark: SparkSession) -> None:
    """Batches for rows of a few numbers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(200 * ROWS_PER_BATCH))


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums and minima of hashes behave like random numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE + 2), base, dtype=np.uint64)
        steps[0] = 1
        made = np.cumprod(steps, dtype=np.uint64)
        if len(made) > 4 * SLICE:
            return made
        _powers[key] = have = made
    return have


@dataclass
class Words:
    """Words of some documents: byte spans, and the first word of each document (one more at the end)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes and length."""
        n = len(self.data)
        if not n:
            return np.zeros(0, np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _power_table(_BASE, n)[:n], out=sums[1:])
        h = (sums[self.end] - sums[self.start]) * _power_table(_INVERSE, n + 1)[self.start]
        return mix(h + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, lower: bool = True) -> Words:
    """Words of the documents that lie at offsets (0 first, length of data last)."""
    if lower:
        data = LOWER[data]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    own = is_word[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = own[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    before[cut] = False
    start = np.flatnonzero(own & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = own[1:]
    after[cut - 1] = False
    end = np.flatnonzero(own & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows with about SLICE bytes."""
    data, at = text_bytes(batch.column(batch.schema.get_field_index(column)))
    row = 0
    while row < batch.num_rows:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + SLICE, "right")) - 1)
        yield row, stop, data[at[row] : at[stop]], at[row : stop + 1] - at[row]
        row = stop
