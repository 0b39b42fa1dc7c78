"""Exact dedup by Grace hashing over complete texts."""

from __future__ import annotations

import hashlib
import os
import re
import struct
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.shared import only, resting, rows_of

FANOUT_BITS = 4
_SPACES = re.compile(rb"[\x20\x09-\x0D]+")
_HEAD = struct.Struct("<QqqI")


def normalised(text: str | None) -> bytes:
    return _SPACES.sub(b" ", (text or "").encode("utf-8", "surrogatepass"))


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte."""

    def __init__(self):
        self.slots = [-1] * 64
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.least: list[int | None] = []
        self.count: list[int] = []
        self.bytes = 0

    def add(self, h: int, text: bytes, doc_id: int | None, n: int) -> None:
        mask = len(self.slots) - 1
        at = h & mask
        while (k := self.slots[at]) >= 0:
            if self.hashes[k] == h and self.texts[k] == text:
                self.count[k] += n
                if doc_id is not None and (self.least[k] is None or doc_id < self.least[k]):
                    self.least[k] = doc_id
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.hashes)
        self.hashes.append(h)
        self.texts.append(text)
        self.least.append(doc_id)
        self.count.append(n)
        self.bytes += len(text) + 120
        if 2 * len(self.hashes) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for k, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k

    def records(self) -> Iterator[tuple[int, bytes, int | None, int]]:
        return zip(self.hashes, self.texts, self.least, self.count)


Record = tuple[int, bytes, "int | None", int]


def _read(path: str) -> Iterator[Record]:
    with open(path, "rb") as f:
        while head := f.read(_HEAD.size):
            h, doc_id, n, size = _HEAD.unpack(head)
            yield h, f.read(size), None if n < 0 else doc_id, abs(n)


def grace(records: Iterable[Record], folder: str, limit: int, shift: int = 64) -> Iterator[Record]:
    """Distinct contents of a stream of ``(hash, content, smallest id, rows)``.

    A table is filled first. Once it holds ``limit`` bytes, it and what follows are dealt out
    to spill files by the next bits of the hash, and each file is treated alike. Copies never
    overfill a table, for it holds one of them.
    """
    table = ContentTable()
    records = iter(records)
    for h, text, doc_id, n in records:
        table.add(h, text, doc_id, n)
        if table.bytes > limit and len(table.hashes) > 1 and shift > FANOUT_BITS:
            break
    else:
        yield from table.records()
        return
    shift -= FANOUT_BITS
    names = [os.path.join(folder, f"{shift}-{k}") for k in range(1 << FANOUT_BITS)]
    files = [open(name, "wb", buffering=1 << 15) for name in names]  # noqa: SIM115
    held = table.records()
    del table
    for part in (held, records):
        for h, text, doc_id, n in part:
            f = files[(h >> shift) & ((1 << FANOUT_BITS) - 1)]
            f.write(_HEAD.pack(h, doc_id or 0, -n if doc_id is None else n, len(text)) + text)
        held = None
    for f in files:
        f.close()
    for name in names:
        yield from grace(_read(name), folder, limit, shift)
        os.remove(name)


def _scratch() -> str | None:
    """The folder Spark gives this executor for its own spills; it goes with the executor."""
    return (os.environ.get("SPARK_LOCAL_DIRS") or "").split(",")[0] or None


_CONTENT = "h long, text binary, least long, n long"


def _content_batches(records: Iterable[Record], at_once: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    columns: list[list] = [[], [], [], []]
    size = 0

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()),
             pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())],
            names=["h", "text", "least", "n"],
        )

    for h, text, doc_id, n in records:
        for column, v in zip(columns, (h - (h >> 63 << 64), text, doc_id, n)):
            column.append(v)
        size += len(text)
        if size > at_once:
            yield batch()
            columns, size = [[], [], [], []], 0
    if columns[0]:
        yield batch()


def _hash(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")


def _combine(limit: int):
    """Map side: copies within a task become one record with a count."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in rows_of(batches):
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                content = normalised(text)
                table.add(_hash(content), content, doc_id, 1)
                if table.bytes > limit:
                    yield from _content_batches(table.records())
                    table = ContentTable()
        yield from _content_batches(table.records())

    return resting(run)


def _reduce(limit: int):
    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[Record]:
        for batch in rows_of(batches):
            for h, text, least, n in zip(*(batch[c].to_pylist() for c in ("h", "text", "least", "n"))):
                yield h & 0xFFFFFFFFFFFFFFFF, text, least, n

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory(prefix="grace-", dir=_scratch()) as folder:
            rows: list[tuple] = []
            for _, text, least, n in grace(records(batches), folder, limit):
                rows.append((hashlib.sha256(text).hexdigest(), least, n))
                if len(rows) == 10_000:
                    yield _groups(rows)
                    rows = []
            if rows:
                yield _groups(rows)

    return resting(run)


def _groups(rows: list[tuple]) -> pa.RecordBatch:
    sha, least, n = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(sha, pa.string()), pa.array(least, pa.int64()), pa.array(n, pa.int64())],
        names=["text_sha256", "keep_id", "group_size"],
    )


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows_of(batches):
        sha = [hashlib.sha256(normalised(t)).hexdigest() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sha, pa.string())], names=["doc_id", "text_sha256"])


def content_groups(docs: DataFrame, limit: int = 48 << 20) -> DataFrame:
    """``text_sha256, keep_id, group_size`` of every distinct content, at most ``limit`` bytes in a table."""
    docs = only(docs, doc_id="long", text="string")
    sent = docs.mapInArrow(_combine(limit // 3), _CONTENT)
    return sent.repartition("h").mapInArrow(_reduce(limit), "text_sha256 string, keep_id long, group_size long")


def exact_dedup(docs: DataFrame, limit: int = 48 << 20) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after each run of ASCII white space became one space; null
    is empty. The row with the smallest id of a group is kept. Every task first folds the
    copies among its own rows, so that a group holding a third of the table reaches the
    shuffle as one record a task; records are then partitioned by content hash, and within a
    task by Grace hashing. The groups come back to the documents by digest, a join of
    narrow rows that adaptive execution splits where one group is hot.

    Cases: repeated rows with one id all carry it, and of rows equal in id and text each says
    ``kept``; a null id is never smallest unless all of a group are null, then ``keep_id`` is
    null and every row of it is kept, as no id can name one of them. An empty table gives no rows.
    """
    digests = only(docs, doc_id="long", text="string").mapInArrow(_digests, "doc_id long, text_sha256 string")
    joined = digests.join(content_groups(docs, limit), "text_sha256")
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
