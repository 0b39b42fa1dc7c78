"""Token shards in training order.

Texts become one stream of ids for each input partition, cut into sequences of a fixed length. A keyed
Feistel permutation with cycle walking gives every sequence a global slot; slots are dealt
to shards by range, and every shard is a file in which slot ``s`` lies at ``(s - first) * stride``. A reader
can start at any slot and read on.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from tidewater.llm.encoders import BLANK, Model
from tidewater.llm.sentence_pieces import _Sent
from tidewater.llm.shared import mix64, only, rows_of
from tidewater.session import settle, shared_folder

SEQUENCE, SHARD, KEY, ROUNDS = 512, 16_384, 20_240_601, 6
#: Sequences of a stream that are settled as one block, and the strength of their compression.
BLOCK, STRENGTH = 4_096, 6
#: Id after each text and, repeated, after the last text of a partition.
CLOSE = 2


@dataclass(frozen=True)
class Order:
    """A pseudorandom permutation of ``0 .. n-1``, fixed by its key."""

    n: int
    key: int = KEY
    rounds: int = ROUNDS

    def _once(self, x: np.ndarray, backwards: bool) -> np.ndarray:
        half = np.uint64(max(1, (max(1, self.n - 1).bit_length() + 1) // 2))
        mask = (np.uint64(1) << half) - np.uint64(1)
        left, right = x >> half, x & mask
        for r in range(self.rounds)[:: -1 if backwards else 1]:
            salt = np.uint64((self.key * 0x9E3779B97F4A7C15 + r) & 0xFFFFFFFFFFFFFFFF)
            if backwards:
                left, right = right ^ (mix64(left + salt) & mask), left
            else:
                left, right = right, left ^ (mix64(right + salt) & mask)
        return (left << half) | right

    def _walk(self, x, backwards: bool) -> np.ndarray:
        x = self._once(np.asarray(x, np.uint64), backwards)
        while (out := x >= self.n).any():  # the next element of the cycle, until it is one of the n
            x[out] = self._once(x[out], backwards)
        return x.astype(np.int64)

    def slot(self, sequence) -> np.ndarray:
        return self._walk(sequence, False)

    def sequence(self, slot) -> np.ndarray:
        return self._walk(slot, True)


#: Words whose ids a worker remembers before it starts anew, and of these the first met, mostly frequent ones, that it
#: goes on with; this bounds memory only.
REMEMBERED, KEPT = 300_000, 150_000


class Words(dict):
    """Ids, as bytes of one integer type, by the public encoder, which is asked once for each word between single spaces.

    That is right where no piece reaches over a blank, which ``encoders.Model`` proves of a model; texts with other
    spaces than single ones, and all texts of another model, are encoded whole.
    """

    def __init__(self, model: bytes, kind: str):
        self.encoder, self.kind = Model(model), kind

    def _ids(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, packed all at once and cut again."""
        ids = self.encoder.plain_ids(texts)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        packed = np.fromiter(chain.from_iterable(ids), self.kind, sizes.sum())
        ends = (np.cumsum(sizes) * packed.itemsize).tolist()
        packed = packed.tobytes()
        return [packed[i:j] for i, j in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        by_word = [
            t.split(" ") if self.encoder.reach and t and "  " not in t and BLANK not in t and t[0] != " " != t[-1] else None
            for t in texts
        ]
        if len(self) > REMEMBERED:
            kept = list(islice(self.items(), KEPT))
            self.clear()
            self.update(kept)
        new = list({w for parts in by_word if parts for w in parts}.difference(self))
        self.update(zip(new, self._ids(new)))
        whole = iter(self._ids([t for t, parts in zip(texts, by_word) if parts is None]))
        return [next(whole) if parts is None else b"".join(map(self.__getitem__, parts)) for parts in by_word]


@lru_cache(maxsize=2)
def _words(sent: _Sent, kind: str) -> Words:
    return Words(sent.model.value, kind)


# ---------------------------------------------------------------- streams of the input partitions

_STREAMED = "part int, doc_id long, n_tokens long, start long, number long, sequences long, tokens long, ids binary"


def _squeezed(data: bytes, strength: int) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=strength).compress(data, asbytes=True)


def _whole(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _streamed(sent: _Sent, length: int, kind: str, block: int):
    """Rows of two kinds: every document's place in its partition's stream, and blocks of the stream's sequences in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, number, words = TaskContext.get().partitionId(), 0, 0, _words(sent, kind)
        size = np.dtype(kind).itemsize * length
        close = np.array([CLOSE], kind).tobytes()
        names = [x.split()[0] for x in _STREAMED.split(", ")]
        kinds = (pa.int32(), *[pa.int64()] * 6, pa.binary())
        held, n_held = [], 0

        def blocks(stream: bytes, tokens: int):
            """``tokens`` of the stream's ids are the texts' own; what lies behind them fills the last sequence."""
            nonlocal number
            for at in range(0, len(stream), block * size):
                data = stream[at : at + block * size]
                n, own = len(data) // size, min(tokens, len(data) // size * length)
                tokens -= own
                row = (part, None, None, None, number, n, own, _squeezed(data, STRENGTH))
                number += n
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

        for batch in rows_of(batches, 500):
            placed = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), words.encode([t or "" for t in batch["text"].to_pylist()])):
                n = len(ids) * length // size
                placed.append((part, doc_id, n, start, None, None, None, None))
                start += n + 1
                held += [ids, close]
                n_held += len(ids) + len(close)
            if placed:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*placed), kinds)], names=names)
            if n_held >= block * size:
                joined = b"".join(held)
                whole = len(joined) // size * size
                yield from blocks(joined[:whole], whole * length // size)
                held, n_held = [joined[whole:]], len(joined) - whole
        if n_held:
            rest = b"".join(held)
            yield from blocks(rest + close * (-len(rest) % size // len(close)), len(rest) * length // size)

    return run


_DEALT = "shard int, tokens long, slots binary, ids binary"


def _dealt(order: Order, size: int, length: int, shard: int, firsts: dict[int, int]):
    """The sequences of a block by shard, each with its slots."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, tokens, ids in zip(*(batch[c].to_pylist() for c in ("part", "number", "tokens", "ids"))):
                rows = np.frombuffer(_whole(ids), np.uint8).reshape(-1, size)
                own = np.minimum(length, np.maximum(0, tokens - length * np.arange(len(rows))))
                slots = order.slot(firsts[part] + number + np.arange(len(rows)))
                out = []
                for k in np.unique(slots // shard).tolist():
                    here = np.flatnonzero(slots // shard == k)
                    out.append((k, int(own[here].sum()), slots[here].tobytes(), _squeezed(rows[here].tobytes(), 1)))
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[x.split()[0] for x in _DEALT.split(", ")])

    return run


# ---------------------------------------------------------------- shard files

def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder, whichever it is, and the path in it."""
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of the store that Spark's own configuration gives for it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _name(shard: int) -> str:
    return f"shard-{shard:06d}.bin"


def _write(folder: str, stride: int, shard_size: int, total: int):
    """Put a shard's sequences in the order of their slots and write them under a name of their own, which is
    then changed, so that a repeated task does no harm. A task has one shard, whose size is bounded."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _open(folder)
        shard, tokens, body, filled = None, 0, None, None
        for batch in batches:
            for k, own, slots, ids in zip(*(batch[c].to_pylist() for c in ("shard", "tokens", "slots", "ids"))):
                if shard is None:
                    shard, n = k, min(shard_size, total - k * shard_size)
                    body, filled = np.zeros((n, stride), np.uint8), np.zeros(n, np.int64)
                if k != shard:
                    raise RuntimeError(f"shards {shard} and {k} in one task")
                at = np.frombuffer(slots, np.int64) - shard * shard_size
                body[at] = np.frombuffer(_whole(ids), np.uint8).reshape(-1, stride)
                filled[at] += 1
                tokens += own
        if shard is None:
            return
        if (filled != 1).any():
            raise RuntimeError(f"slots of shard {shard} that are not filled once")
        data, own = body.tobytes(), f"{path}/.writing-{uuid.uuid4().hex}"
        with store.open_output_stream(own) as out:
            out.write(data)
        store.move(own, f"{path}/{_name(shard)}")
        row = (shard, len(filled), tokens, zlib.crc32(data))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], k) for x, k in zip(row, (pa.int32(), *[pa.int64()] * 3))], names=["shard", "sequences", "tokens", "crc32"]
        )

    return run


def read_sequences(folder: str, first: int = 0, count: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """``slot, ids`` from a slot on, in order; reading can be taken up again at any slot."""
    store, path = _open(folder)
    with store.open_input_stream(f"{path}/manifest.json") as f:
        about = json.loads(f.read())
    stride, size, n = about["stride"], about["shard"], about["sequences"]
    end = n if count is None else min(n, first + count)
    slot = first
    while slot < end:
        with store.open_input_file(f"{path}/{_name(slot // size)}") as f:
            f.seek(slot % size * stride)
            for _ in range(min(end, (slot // size + 1) * size) - slot):
                yield slot, np.frombuffer(f.read(stride), about["dtype"])
                slot += 1


def write_shards(
    docs: DataFrame, sent: _Sent, folder: str | None = None, length: int = SEQUENCE, shard: int = SHARD, key: int = KEY,
    block: int = BLOCK,
) -> DataFrame:
    """Write all texts as shards and a manifest; return each document's place.

    The rows are ``doc_id, n_tokens, sequence, slot, shard, byte_offset, shard_sequences, shard_tokens,
    shard_crc32``: the sequence in which the text begins, where that lies, and the
    shard as it was written. Every text is encoded once: its ids are settled as the sequences of its input
    partition's stream, in blocks of ``block``, which are numbered, placed and written from there.

    Cases: null and empty texts are the closing id alone; repeated rows are written each; null ids
    are kept; an empty table writes a manifest alone and gives no rows.
    """
    spark = docs.sparkSession
    folder = _qualified(spark, folder or f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}")
    store, path = _open(folder)
    store.create_dir(path, recursive=True)
    kind = "uint16" if len(sent.vocabulary.value[1]) <= 1 << 16 else "uint32"
    docs = only(docs, doc_id="long", text="string")
    streams = settle(docs.mapInArrow(_streamed(sent, length, kind, block), _STREAMED), "streams")
    blocks = streams.where("ids is not null").select("part", "number", "tokens", "ids")
    placed = streams.where("ids is null").select("part", "doc_id", "n_tokens", "start")
    # One row for each input partition.
    rows = streams.where("ids is not null").groupBy("part").agg(F.sum("sequences").alias("n")).orderBy("part").collect()
    firsts, total = {}, 0
    for r in rows:
        firsts[r["part"]] = total
        total += r["n"]
    order, stride = Order(total, key), length * np.dtype(kind).itemsize
    shards = -(-total // shard)

    @pandas_udf("long")
    def slot(sequence: pd.Series) -> pd.Series:
        return pd.Series(order.slot(sequence.to_numpy()))

    if total:
        written = blocks.mapInArrow(_dealt(order, stride, length, shard, firsts), _DEALT).repartitionById(shards, F.col("shard"))
        written = written.mapInArrow(_write(folder, stride, shard, total), "shard int, sequences long, tokens long, crc32 long")
        written = settle(written, "written")
    else:
        written = spark.createDataFrame([], "shard int, sequences long, tokens long, crc32 long")
    about = {"sequences": total, "length": length, "stride": stride, "dtype": kind, "shard": shard, "order": asdict(order)}
    with store.open_output_stream(f"{path}/manifest.json") as f:
        f.write(json.dumps(about).encode())

    firsts = spark.createDataFrame(list(firsts.items()), "part int, first long")
    out = placed.join(firsts, "part").withColumn("sequence", F.col("first") + F.floor(F.col("start") / length))
    out = out.withColumn("slot", slot("sequence")).withColumn("shard", F.floor(F.col("slot") / shard).cast("int"))
    out = out.join(written.withColumnsRenamed({"tokens": "shard_tokens"}), "shard")
    return out.select(
        "doc_id", "n_tokens", "sequence", "slot", "shard",
        (F.col("slot") % shard * stride + F.col("start") % length * (stride // length)).alias("byte_offset"),
        F.col("sequences").alias("shard_sequences"), "shard_tokens", F.col("crc32").alias("shard_crc32"),
    )
