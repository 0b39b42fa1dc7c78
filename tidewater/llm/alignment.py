"""Cross-tokenizer alignment through whitespace-token anchors.

A text is encoded whole by two tokenizers whose tokens are strings of bytes. A place where tokens of both
begin with a space, and which is thus a shared end of the tokens before, is an anchor; anchors split both
id sequences into windows, mostly words. A window's alignment depends on its ids alone, so it is worked
out once for each pair of id tuples and remembered. Where tokens of both end together they are linked.
Linked pairs are counted over the corpus, and each text is scored with these counts.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.encoders import Shipped, load
from tidewater.llm.shared import mix64, only, rows_of, runs
from tidewater.session import settle

#: Most frequent pairs that every task holds; rarer ones are joined.
HEAD = 1 << 17
#: Windows a worker remembers before it starts anew, and ids in one of them: these bound memory only.
REMEMBERED, LONGEST = 300_000, 32
#: Pairs that a task sums at once.
AT_ONCE = 2_000_000


class Windows(dict):
    """Alignments by the ids of a window: its groups as text, and its links as packed pairs of ids.

    Keys are the packed 32-bit ids of both sides. Windows begin and end together; one whose sides spell different
    bytes has no groups. No token is empty.
    """

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.a_bytes, self.b_bytes = a_bytes, b_bytes
        self.a_len, self.b_len = (np.array(list(map(len, x)), np.int64) for x in (a_bytes, b_bytes))
        # An id as text before another of its side, before the other side, before the next group, and at a window's end.
        ids = range(max(len(a_bytes), len(b_bytes)))
        self.inside, self.bar, self.next, self.last = (np.array([b"%d" % i + c for i in ids], object) for c in (b",", b"|", b";", b"\n"))

    def look_up(self, keys: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
        """Groups and links of every key; new windows are aligned all at once, and remembered unless they are long."""
        new = [k for k in dict.fromkeys(keys) if k not in self]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = list(dict.fromkeys(keys))
        found = dict(zip(new, self._aligned(new)))
        short = ((k, x) for k, x in found.items() if len(k[0]) + len(k[1]) <= 8 * LONGEST)
        self.update(islice(short, REMEMBERED - len(self)))
        return [found[k] if k in found else self[k] for k in keys]

    def _spelt(self, key: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
        return tuple(b"".join([of[i] for i in memoryview(x).cast("i")]) for of, x in zip((self.a_bytes, self.b_bytes), key))

    def _aligned(self, keys: list[tuple[bytes, bytes]]) -> list[tuple[bytes, bytes]]:
        if not keys:
            return []
        a, b = b"".join([a for a, _ in keys]), b"".join([b for _, b in keys])
        spelt_a, spelt_b = self._spelt((a, b))
        a, b = np.frombuffer(a, np.int32), np.frombuffer(b, np.int32)
        n_a, n_b = (np.cumsum(np.fromiter((len(k[side]) for k in keys), np.int64, len(keys))) // 4 for side in (0, 1))
        ends_a, ends_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        if spelt_a != spelt_b or (ends_a[n_a - 1] != ends_b[n_b - 1]).any():
            same = [x == y for x, y in map(self._spelt, keys)]
            some = iter(self._aligned([k for k, x in zip(keys, same) if x]))
            return [next(some) if x else (b"", b"") for x in same]
        # Groups end where tokens of both sides do, which the ends of windows are among.
        where = np.searchsorted(ends_b, ends_a)
        shut_a, shut_b = ends_b[where] == ends_a, np.zeros(len(b), bool)
        shared_a, shared_b = np.flatnonzero(shut_a), where[shut_a]
        shut_b[shared_b] = True
        links = (a[shared_a].astype(np.int64) << 32 | b[shared_b]).tobytes()
        # Group by group the ids of the one side, then those of the other.
        group_a, group_b = np.cumsum(shut_a) - shut_a, np.cumsum(shut_b) - shut_b
        text = np.empty(len(a) + len(b), object)
        text[np.arange(len(a)) + np.append(0, shared_b + 1)[group_a]] = np.where(shut_a, self.bar[a], self.inside[a])
        tail = np.where(shut_b, self.next[b], self.inside[b])
        tail[n_b - 1] = self.last[b[n_b - 1]]
        text[np.arange(len(b)) + (shared_a + 1)[group_b]] = tail
        upto = (8 * (group_b[n_b - 1] + 1)).tolist()
        return [(line, links[i:j]) for line, i, j in zip(b"".join(text.tolist()).split(b"\n"), [0, *upto], upto)]


class Aligner:
    def __init__(self, a, b):
        self.a, self.b = a, b
        self.a_bytes, self.b_bytes = a.token_bytes(), b.token_bytes()
        self.a_len, self.b_len = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_space, self.b_space = (np.array([t[:1] == b" " for t in x]) for x in (self.a_bytes, self.b_bytes))
        self.windows = Windows(self.a_bytes, self.b_bytes)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for space and text; none where the first side's bytes are not those of the text, or the other's not as many.

        Whether the other's bytes are the same shows in the windows.
        """
        both = zip(texts, self.a.plain_ids([" " + t for t in texts]), self.b.plain_ids(texts))
        none = np.zeros(0, np.int32)
        for text, a, b in both:
            b = np.frombuffer(array("i", b), np.int32)
            whole = b" " + text.encode()
            same = text and b"".join(map(self.a_bytes.__getitem__, a)) == whole and self.b_len[b].sum() == len(whole)
            yield (np.frombuffer(array("i", a), np.int32), b) if same else (none, none)

    def align(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[bytes, np.ndarray]]:
        """For each text its groups in one line, and its linked pairs in order; nothing for one whose sides differ.

        The texts are laid end to end; each begins with a space in both sequences, which is an anchor.
        Equal windows are found by two 64-bit hashes, and only one of each is looked up.
        """
        held = [k for k, (a, _) in enumerate(texts) if len(a)]
        out = [(b"", np.zeros(0, np.int64))] * len(texts)
        if not held:
            return out
        a, b = (np.concatenate([texts[k][side] for k in held]) for side in (0, 1))
        begins_a, begins_b = (np.cumsum(n[x]) - n[x] for x, n in ((a, self.a_len), (b, self.b_len)))
        marked_a, marked_b = np.flatnonzero(self.a_space[a]), np.flatnonzero(self.b_space[b])
        places_a, places_b = begins_a[marked_a], begins_b[marked_b]
        where = np.searchsorted(places_b, places_a)
        shared = np.append(places_b, -1)[where] == places_a
        cut_a, cut_b = marked_a[shared], marked_b[where[shared]]

        names = [_window_hash(a, cut_a, salt) ^ mix64(_window_hash(b, cut_b, salt + 1)) for salt in (1, 3)]
        _, first, which = np.unique(names[0], return_index=True, return_inverse=True)
        if (names[1][first][which] != names[1]).any():  # two windows with one hash: look up each
            first = which = np.arange(len(cut_a))
        bytes_a, bytes_b = a.tobytes(), b.tobytes()
        ends_a, ends_b = np.append(cut_a[1:], len(a)), np.append(cut_b[1:], len(b))
        spans = zip(*((4 * x[first]).tolist() for x in (cut_a, ends_a, cut_b, ends_b)))
        groups, links = zip(*self.windows.look_up([(bytes_a[i:j], bytes_b[k:l]) for i, j, k, l in spans]))

        lines = np.empty(len(groups), object)
        lines[:] = groups
        lines = lines[which].tolist()
        sizes = np.array(list(map(len, links))) >> 3
        begins = (np.cumsum(sizes) - sizes)[which]
        sizes = sizes[which]
        ends = np.cumsum(sizes)
        pairs = np.frombuffer(b"".join(links), np.int64)[np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1])]
        of_text = np.searchsorted(cut_a, np.cumsum([0] + [len(texts[k][0]) for k in held])).tolist()
        upto = np.append(0, ends)
        for k, i, j in zip(held, of_text, of_text[1:]):
            if sizes[i:j].all():
                out[k] = b";".join(lines[i:j]), pairs[upto[i] : upto[j]]
        return out


def _window_hash(ids: np.ndarray, starts: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each window's ids in their order."""
    within = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    return np.add.reduceat(mix64(ids.astype(np.uint64) | (within.astype(np.uint64) + np.uint64(salt << 24)) << np.uint64(32)), starts)


@lru_cache(maxsize=2)
def _aligner(a: Shipped, b: Shipped) -> Aligner:
    return Aligner(load(a), load(b))


_ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<int>"
)


def _lists(lists: list[np.ndarray], kind) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, kind), *lists]).astype(kind)))


def _aligned(a: Shipped, b: Shipped):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a, b)
        row = TaskContext.get().partitionId() << 40
        for batch in rows_of(batches, 256):
            out, pairs, times = [], [], []
            encoded = list(aligner.encode([t or "" for t in batch["text"].to_pylist()]))
            for doc_id, (ids_a, ids_b), (groups, links) in zip(batch["doc_id"].to_pylist(), encoded, aligner.align(encoded)):
                found, n = np.unique(links, return_counts=True)
                pairs.append(found)
                times.append(n)
                digest = hashlib.sha256(groups).hexdigest() if groups else ""
                n_a, n_b = (len(ids_a), len(ids_b)) if groups else (0, 0)
                out.append((row, doc_id, n_a, n_b, groups.count(b"|"), len(links), digest))
                row += 1
            if out:
                kinds = [pa.int64()] * 6 + [pa.string()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                names = [x.split()[0] for x in _ALIGNED.split(", ")]
                yield pa.RecordBatch.from_arrays([*columns, _lists(pairs, np.int64), _lists(times, np.int32)], names=names)

    return run


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch["pairs"].flatten().to_numpy(), batch["times"].flatten().to_numpy().astype(np.int64)


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``pair, c`` of many rows at once."""
    def total(held):
        pairs, times = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(pairs, kind="stable")
        starts, _ = runs(pairs[order])
        if len(starts):
            sums = np.add.reduceat(times[order], starts)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[order][starts]), pa.array(sums)], names=["pair", "c"])

    held, n = [], 0
    for batch in batches:
        held.append(_flat(batch))
        n += len(held[-1][0])
        if n > AT_ONCE:
            yield from total(held)
            held, n = [], 0
    if held:
        yield from total(held)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, c, best``: how many links of the corpus hold a pair, and whether none of its right id's is more frequent."""
    sums = aligned.select("pairs", "times").mapInArrow(_summed, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c"))
    sums = settle(sums.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pair-sums")
    most = sums.groupBy("b").agg(F.max("c").alias("most"))
    return settle(sums.join(most, "b").select("pair", "c", (F.col("c") == F.col("most")).alias("best")), "pairs")


def _found(batch: pa.RecordBatch, head: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs and times of the batch's rows, where each lies in the head, and whether it does; the row of each."""
    pairs, times = _flat(batch)
    at = np.minimum(np.searchsorted(head, pairs), max(0, len(head) - 1))
    row = np.repeat(np.arange(batch.num_rows), np.diff(batch["pairs"].offsets.to_numpy()))
    return pairs, times, at, (head[at] == pairs) if len(head) else np.zeros(len(pairs), bool), row


def _within(head: Broadcast):
    """Rows with what their pairs in the head add up to."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, c, best = head.value
        for batch in rows_of(batches, 2_000):
            _, times, at, known, row = _found(batch, pair)
            at, times, row, n = at[known], times[known], row[known], batch.num_rows
            sums = []
            for weight in (times * best[at], times * c[at]):
                total = np.zeros(n, np.int64)
                np.add.at(total, row, weight)
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([batch["row"], *sums], names=["row", "head_best", "head_sum"])

    return run


def _beyond(head: Broadcast):
    """The pairs that the head lacks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 2_000):
            pairs, times, _, known, row = _found(batch, head.value[0])
            names = batch["row"].to_numpy()[row[~known]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (names, pairs[~known], times[~known])], names=["row", "pair", "n"])

    return run


def align_tokens(docs: DataFrame, a: Shipped, b: Shipped, head: int = HEAD) -> DataFrame:
    """The settled alignment of every document, and its links' corpus-wide counts.

    ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``. ``a`` encodes space and text, ``b`` the
    text, to which it adds the space itself; special strings are plain text. The groups between shared ends are
    hashed in the form ``a1,a2|b1;a3|b2``. ``n_best`` counts links whose pair is the most frequent of its ``b`` id in
    the corpus, ties included; ``count_sum`` sums the pairs' counts over the links.

    Cases: null and empty texts, and those whose tokens do not spell them out, have no tokens, zeros and an
    empty digest; repeated rows count each time; null ids are kept; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = only(docs, doc_id="long", text="string")
    aligned = settle(docs.mapInArrow(_aligned(a, b), _ALIGNED), "aligned")
    pairs = pair_counts(aligned)
    top = pairs.orderBy(F.desc("c"), "pair").limit(head).toPandas().sort_values("pair")
    sent = spark.sparkContext.broadcast((top["pair"].to_numpy(np.int64), top["c"].to_numpy(np.int64), top["best"].to_numpy(np.int64)))
    rows = aligned.select("row", "pairs", "times")
    rare = rows.mapInArrow(_beyond(sent), "row long, pair long, n long").join(pairs, "pair")
    rare = rare.groupBy("row").agg(
        F.sum(F.col("n") * F.col("best").cast("long")).alias("best"), F.sum(F.col("n") * F.col("c")).alias("sum")
    )
    within = rows.mapInArrow(_within(sent), "row long, head_best long, head_sum long")
    out = aligned.drop("pairs", "times").join(within, "row").join(rare, "row", "left")
    none = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("head_best") + F.coalesce("best", none)).alias("n_best"),
        (F.col("head_sum") + F.coalesce("sum", none)).alias("count_sum"), "groups_sha256",
    )
