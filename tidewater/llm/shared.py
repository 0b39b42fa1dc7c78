"""Small helpers the operators of this folder have in common."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Pattern of a word in Spark's and Java's syntax: what ASCII white space does not split.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes after which Spark closes a batch for Python, 64 MB by default, and those within ``light_batches``.
BATCH_BYTES, LIGHT = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def fold(doc_id: str, n: int) -> Column:
    """Remainder of the id's CRC; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % n


def words(text: str | None) -> list[bytes]:
    """Words of a whole text with A-Z in lower case.

    Bytes are lower-cased and split by ASCII rules alone, as the pattern above demands;
    the unit separators 0x1C-0x1F are not white space for bytes.
    """
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def rows_of(batches: Iterable[pa.RecordBatch], at_once: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that long texts are not all unpacked at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, at_once):
            yield batch.slice(start, at_once)


@contextmanager
def light_batches(spark: SparkSession) -> Iterator[None]:
    """Within, a batch for Python is closed after ``LIGHT`` bytes: Spark and Python both hold one in every task."""
    before = spark.conf.get(BATCH_BYTES, None)
    spark.conf.set(BATCH_BYTES, str(LIGHT))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)


def rest() -> None:
    """Hand freed memory back to the system, which an idle process would keep beside those that work."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def resting(run: Callable, *forget: Callable[[], None]) -> Callable:
    """The same function of a task's batches, which then forgets and rests."""

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for give_up in forget:
                give_up()
            rest()

    return whole


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str], others: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Each key with its rows, from rows sorted by key; one key's rows are held at a time."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in keys + others)):
            if row[: len(keys)] != now:
                if rows:
                    yield now, rows
                now, rows = row[: len(keys)], []
            rows.append(row[len(keys) :])
    if rows:
        yield now, rows


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return starts, np.diff(starts, append=len(keys))


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit values one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def only(docs: DataFrame, **types: str) -> DataFrame:
    """Just the named columns, cast; what else the table holds cannot clash."""
    return docs.select(*(F.col(name).cast(kind).alias(name) for name, kind in types.items()))
