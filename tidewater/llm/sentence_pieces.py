"""SentencePiece encoding and decoding by a max-plus parallel scan over chunks.

Texts up to ``chunk`` characters are encoded in one go. A longer one is split into chunks. Each
chunk yields the transfer matrix between the states at its ends, a state being the
piece that lies across. Matrices are multiplied within blocks of a bounded number of chunks and the
blocks' products along the text; products are associative, so blocks are independent
tasks. That fixes the states at every boundary, and every chunk is then traced back by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from tidewater.llm.pieces import Pieces, Vocabulary, blanked, matrix, product, read_vocabulary, route
from tidewater.llm.shared import grouped, only, resting, rows_of
from tidewater.session import settle

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 16_384
#: Chunks of a block. A text has fewer than 2^31 characters, so at most 512 blocks of these.
BLOCK = 256


@lru_cache(maxsize=1)
def _pieces(sent: "_Sent") -> Pieces:
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=sent.model.value)
    # The library encodes by the kind the model was made for.
    same = sent.vocabulary.value[0] == "bpe" and library.normalize(" ﬁ  Å ") == "▁▁ﬁ▁▁Å▁"
    return Pieces(sent.vocabulary.value, library if same else None)


class _Sent:
    """The vocabulary and its model file as the tasks get them, told apart by their broadcast."""

    def __init__(self, vocabulary: Broadcast, model: Broadcast, name: int):
        self.vocabulary, self.model, self.name = vocabulary, model, name

    def __hash__(self):
        return self.name

    def __eq__(self, other):
        return self.name == other.name


def send_vocabulary(spark: SparkSession, path: str = MODEL, kind: str = "bpe") -> _Sent:
    """Read a model file on the driver and broadcast its pieces, whose number the model fixes."""
    broadcast = spark.sparkContext.broadcast(read_vocabulary(path, kind))
    model = spark.sparkContext.broadcast(Path(path).read_bytes())
    return _Sent(broadcast, model, broadcast._jbroadcast.id() if broadcast._jbroadcast is not None else 0)


def _id_lists(lists: list[bytes]) -> pa.Array:
    lengths = np.fromiter((len(x) // 4 for x in lists), np.int64, len(lists))
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(lists), np.int32)))


def _encode_short(sent: _Sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(sent)
        for batch in rows_of(batches):
            ids = pieces.encode_all([blanked(t) for t in batch["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["k1"], _id_lists(ids)], names=["doc_id", "k1", "ids"])

    return resting(run, lambda: _pieces(sent).forget())


def _chunks(longest: int, chunk: int):
    """Chunks of the blanked texts with as many characters around as a piece can cover."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k1", "k2", "block", "part", "a", "b", "last", "text"]
        for batch in rows_of(batches, 1):
            k1, k2, text = (batch[c][0].as_py() for c in ("k1", "k2", "text"))
            form, out = blanked(text), []
            for part, at in enumerate(range(0, len(form), chunk)):
                low, end = max(0, at - longest), min(at + chunk, len(form))
                out.append((k1, k2, part // BLOCK, part, at - low, end - low, end == len(form), form[low : end + longest]))
                if len(out) == 64:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    return run


_CHUNK = "k1 long, k2 long, block long, part long, a long, b long, last boolean, text string"
_MATRIX = "k1 long, k2 long, block long, part long, i array<int>, j array<int>, w array<double>"


def _transfer(sent: _Sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(sent)
        for batch in rows_of(batches, 50):
            cells = [
                tuple(zip(*pieces.transfer(text, a, b))) or ((), (), ())
                for text, a, b in zip(*(batch[c].to_pylist() for c in ("text", "a", "b")))
            ]
            kinds = (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64()))
            matrices = [pa.array([c[k] for c in cells], kind) for k, kind in enumerate(kinds)]
            keys = [batch[c] for c in ("k1", "k2", "block", "part")]
            yield pa.RecordBatch.from_arrays([*keys, *matrices], names=["k1", "k2", "block", "part", "i", "j", "w"])

    return resting(run, lambda: _pieces(sent).forget())


def _batches(rows: Iterable[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == 2_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


_INTS, _FLOATS = pa.list_(pa.int32()), pa.list_(pa.float64())


def _whole_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The product of each block's matrices."""
    def rows():
        for key, parts in grouped(batches, ["k1", "k2", "block"], ["i", "j", "w"]):
            total = matrix(*parts[0])
            for part in parts[1:]:
                total = product(total, matrix(*part))
            yield (*key, *zip(*((a, b, w) for a, row in total.items() for b, w in row.items())))

    return _batches(rows(), ["k1", "k2", "block", "i", "j", "w"], [pa.int64()] * 3 + [_INTS, _INTS, _FLOATS])


def _route_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states at the ends of every block on a text's best path."""
    def rows():
        for key, blocks in grouped(batches, ["k1", "k2"], ["block", "i", "j", "w"]):
            states = route([matrix(*b[1:]) for b in blocks], 0, None)
            for (block, *_), entry, leaving in zip(blocks, states, states[1:]):
                yield *key, block, entry, leaving

    return _batches(rows(), ["k1", "k2", "block", "block_entry", "block_leaving"], [pa.int64()] * 3 + [pa.int32()] * 2)


def _route_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states at the ends of every chunk, between those of its block."""
    def rows():
        others = ["part", "block_entry", "block_leaving", "i", "j", "w"]
        for key, parts in grouped(batches, ["k1", "k2", "block"], others):
            states = route([matrix(*p[3:]) for p in parts], parts[0][1], parts[0][2])
            for (part, *_), entry, leaving in zip(parts, states, states[1:]):
                yield *key[:2], part, entry, leaving

    return _batches(rows(), ["k1", "k2", "part", "entry", "leaving"], [pa.int64()] * 3 + [pa.int32()] * 2)


def _by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, order)


def _backtrace(sent: _Sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(sent)
        for batch in rows_of(batches, 50):
            columns = (batch[c].to_pylist() for c in ("text", "a", "b", "entry", "leaving"))
            ids = [np.array(pieces.backtrace(*row), np.int32).tobytes() for row in zip(*columns)]
            keys = [batch[c] for c in ("k1", "k2", "part")]
            yield pa.RecordBatch.from_arrays([*keys, _id_lists(ids)], names=["k1", "k2", "part", "ids"])

    return resting(run, lambda: _pieces(sent).forget())


def _encoded(docs: DataFrame, sent: _Sent, chunk: int) -> DataFrame:
    """``doc_id, k1, ids``; ``k1`` is a hash of the text, null being empty."""
    docs = only(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.select("doc_id", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "text")
    is_long = F.length("text") > chunk
    short = docs.where(~is_long).drop("k2").mapInArrow(_encode_short(sent), "doc_id long, k1 long, ids array<int>")

    giants = docs.where(is_long)
    longest = max(len(p) for p, _, role in sent.vocabulary.value[1] if role == "text")
    chunks = giants.select("k1", "k2", "text").dropDuplicates(["k1", "k2"]).mapInArrow(_chunks(longest, chunk), _CHUNK)
    chunks = settle(chunks, "chunks")
    matrices = settle(chunks.mapInArrow(_transfer(sent), _MATRIX), "transfer")
    cells = "i array<int>, j array<int>, w array<double>"
    block, text = ["k1", "k2", "block"], ["k1", "k2"]
    blocks = _by(matrices, block, "part").mapInArrow(_whole_blocks, f"k1 long, k2 long, block long, {cells}")
    routed = _by(blocks, text, "block").mapInArrow(
        _route_blocks, "k1 long, k2 long, block long, block_entry int, block_leaving int"
    )
    states = _by(matrices.join(routed, block), block, "part").mapInArrow(
        _route_chunks, "k1 long, k2 long, part long, entry int, leaving int"
    )
    traced = chunks.join(states, ["k1", "k2", "part"]).select("k1", "k2", "part", "text", "a", "b", "entry", "leaving")
    traced = traced.mapInArrow(_backtrace(sent), "k1 long, k2 long, part long, ids array<int>")
    whole = traced.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("part", "ids"))).alias("parts"))
    whole = whole.select("k1", "k2", F.flatten("parts.ids").alias("ids"))
    return short.union(giants.drop("text").join(whole, ["k1", "k2"]).select("doc_id", "k1", "ids"))


def encode(docs: DataFrame, sent: _Sent, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, ids`` for every document: its whole text as the model itself would encode it.

    Texts beyond ``chunk`` characters go through the scan, equal ones once. Their parts
    are put together again, for a document is one row before and after.

    Cases: null and empty texts have no ids; characters outside the vocabulary become byte
    pieces; repeated rows give the same row repeated; null ids are kept; an empty table gives no rows.
    """
    return _encoded(docs, sent, chunk).select("doc_id", "ids")


def decoded(sent: _Sent, ids: str):
    """The text of a column of id lists; null stays null."""

    @pandas_udf("string")
    def text(lists: pd.Series) -> pd.Series:
        pieces = _pieces(sent)
        return lists.map(lambda ids: None if ids is None else pieces.decode(ids.tolist()))

    return text(F.col(ids))


def decode(encoded: DataFrame, sent: _Sent) -> DataFrame:
    """``doc_id, text`` of encoded documents, row by row.

    Ids of unknown or control pieces decode to nothing, bytes that are no UTF-8 to the replacement
    character, and the blank sign, which stands for the space, to a space. Null ids give null,
    no ids the empty text.
    """
    return encoded.select("doc_id", decoded(sent, "ids").alias("text"))


def token_report(docs: DataFrame, sent: _Sent, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_tokens, ids_hash, round_trip`` of every document.

    The last says whether the decoded ids hash as the text does; cases as in ``encode``.
    """
    return _encoded(docs, sent, chunk).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"),
        (F.xxhash64(decoded(sent, "ids")) == F.col("k1")).alias("round_trip"),
    )
