"""LM scoring with Brown's class-based bigrams.

``log p(text) = sum of log p(class | class before) + log p(word | class)`` over the words and one end.

1. Words are counted over all training texts; the table grows with the corpus and stays distributed.
2. The ``head`` most frequent words, a bounded number, are clustered by exchange. Each has its neighbours counted
   once, in ranges of words that are settled; a sweep reads these where they lie, a task exchanges its words one by one
   against the class-class sums, and the sums are then taken anew. Nothing is shuffled in a sweep.
3. Every other word that occurs ``LEAST`` times is put once where the bigrams become likeliest, by the same gain. A rarer
   one has the class that most clustered words with its last three characters have; where none has them, the
   class with most clustered words.
4. Class bigrams are counted over all pairs of all words: those of head words from their neighbours, the others from
   the words outside the head, which are joined with their classes at their places in the texts.
5. Texts are scored from the class sequences of their head words and from these places.

The tasks hold the head, its classes, and tables of classes by classes; their number is the root of the head's, halved.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from tidewater.llm.shared import fold, grouped, only, resting, rows_of, runs
from tidewater.session import settle

#: Words that every task holds with their counts; count from which a word is clustered; sweeps over the head.
HEAD, LEAST, SWEEPS = 1 << 17, 5, 3
#: Head words whose neighbours one task holds; tokens whose pairs are summed at once.
PER_RANGE, AT_ONCE = 256, 2_000_000
#: Bytes of text looked up at once.
TEXT_AT_ONCE = 1 << 21
#: Classes whose exact gain is compared for a word.
SHORT = 16
#: Weight of the class's own share in smoothing transitions.
BACKOFF = 5.0
#: Stands for a word outside the head in a line of classes.
OUTSIDE = 0xFFFF


def n_classes(n_words: int) -> int:
    return math.ceil(math.sqrt(n_words) / 2)


# ---------------------------------------------------------------- counts

def _by_size(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``TEXT_AT_ONCE`` bytes of text, or one longer text: every batch hashes the head anew."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            limit = (upto[start - 1] if start else 0) + TEXT_AT_ONCE
            stop = max(start + 1, int(np.searchsorted(upto, limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _by_number(numbers: np.ndarray) -> np.ndarray:
    """Stable order of numbers that are not negative, by 16 bits at a time, which numpy sorts without comparing."""
    order, shift, most = np.arange(len(numbers)), 0, int(numbers.max(initial=0))
    while most >> shift:
        order = order[np.argsort((numbers[order] >> shift & 0xFFFF).astype(np.uint16), kind="stable")]
        shift += 16
    return order


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, as ``shared.words`` has them, and the number of words of each text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, at = parts.flatten(), parts.offsets.to_numpy()
    # White space at the ends of a text leaves empty words there.
    some = pc.greater(pc.binary_length(flat), 0)
    upto = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))[at - at[0]]
    return flat.filter(some), np.diff(upto)


def _looked_up(texts: pa.Array, head: pa.Array, other: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts, the place of each in ``head`` or ``other``, and the number of words of each text."""
    flat, lengths = _split(texts)
    found = pc.fill_null(pc.index_in(flat, value_set=head.cast(flat.type)), other)
    return flat, found.to_numpy().astype(np.int64), lengths


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def table(held: list[pa.Array]):
        counts = pa.chunked_array(held, pa.string()).value_counts()
        for at in range(0, len(counts), 100_000):
            part = counts.slice(at, 100_000)
            yield pa.RecordBatch.from_arrays([part.field("values"), part.field("counts")], names=["word", "c"])

    held, n = [], 0
    for batch in rows_of(batches):
        held.append(_split(batch["text"])[0].cast(pa.string()))
        n += len(held[-1])
        if n > 2 * AT_ONCE:
            yield from table(held)
            held, n = [], 0
    if held:
        yield from table(held)


def _packed(values: np.ndarray) -> bytes:
    return np.int64(len(values)).tobytes() + pa.compress(np.ascontiguousarray(values, "<i8").tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    return np.frombuffer(pa.decompress(data[8:], 8 * n, codec="zstd", asbytes=True), "<i8")


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    starts, _ = runs(keys[order])
    return keys[order][starts], np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]


_NEIGHBOURS = "range int, after binary, after_n binary, before binary, before_n binary"


def _neighbours(head: Broadcast, size: int, ranges: int):
    """Neighbours of the head's words after and before them, as keys ``word * (size + 2) + neighbour``.

    A neighbour is a head word, ``size`` for any other word, or ``size + 1`` for the end, which stands before
    and after each text.
    """
    width = size + 2

    def counted(pairs: list[np.ndarray]):
        left, right = (np.concatenate(x) for x in zip(*pairs))
        some = (left < size) | (right < size)
        pair = left[some] * width + right[some]
        pair.sort()
        starts, counts = runs(pair)
        left, right = np.divmod(pair[starts], width)
        sides = []
        # The pairs lie by left word and then by right, so the sides' words are put in order by stable sorts.
        for word, other, ordered in ((left, right, None), (right, left, _by_number(right))):
            mine = np.flatnonzero(word < size) if ordered is None else ordered[word[ordered] < size]
            mine = mine[_by_number(word[mine] % ranges)]
            sides.append(((word[mine] % ranges).astype(np.int32), word[mine] * width + other[mine], counts[mine]))
        cuts = [np.searchsorted(which, np.arange(ranges + 1, dtype=np.int32)).tolist() for which, _, _ in sides]
        for r in range(ranges):
            cut = [(c[r], c[r + 1]) for c in cuts]
            if any(a < b for a, b in cut):
                row = [_packed(x) for (a, b), (_, keys, n) in zip(cut, sides) for x in (np.diff(keys[a:b], prepend=0), n[a:b])]
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), *(pa.array([x], pa.binary()) for x in row)], names=_NEIGHBOURS_NAMES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in _by_size(batches):
            _, found, lengths = _looked_up(batch["text"], head.value, size)
            line = np.append(size + 1, np.insert(found, np.cumsum(lengths), size + 1))
            held.append((line[:-1], line[1:]))
            n += len(line)
            if n > AT_ONCE:
                yield from counted(held)
                held, n = [], 0
        if held:
            yield from counted(held)

    return run


_NEIGHBOURS_NAMES = [x.split()[0] for x in _NEIGHBOURS.split(", ")]


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each range, from rows sorted by range; what is held shrinks to the range's own pairs."""
    def total(parts: list):
        return [_summed(*(np.concatenate(x) for x in zip(*side))) for side in parts]

    names = _NEIGHBOURS_NAMES
    now, held, n = None, [[], []], 0

    def row():
        packed = [_packed(x) for keys, counts in total(held) for x in (np.diff(keys, prepend=0), counts)]
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], names=names)

    for batch in batches:
        for r, *data in zip(*(batch[c].to_pylist() for c in names)):
            if r != now:
                if now is not None:
                    yield row()
                now, held, n = r, [[], []], 0
            for side, (keys, counts) in enumerate((data[:2], data[2:])):
                held[side].append((np.cumsum(_unpacked(keys)), _unpacked(counts)))
                n += len(held[side][-1][0])
            if n > AT_ONCE:
                held, n = [[x] for x in total(held)], 0
    if now is not None:
        yield row()


# ---------------------------------------------------------------- clustering

def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


class Exchange:
    """One task's copy of the class-class sums, against which it moves its words.

    Classes ``0..k-1`` are words' own; the others are contexts alone. A word is taken out of its class and put
    where the class bigrams become likeliest, and the sums follow. All classes are compared by the first order of
    the gain, for many words at once; the ``SHORT`` best of them, and the word's own, by the gain itself.
    """

    def __init__(self, joint: np.ndarray, k: int):
        self.joint, self.k = joint.astype(float), k
        self.out, self.into = self.joint.sum(axis=1), self.joint.sum(axis=0)

    def _add(self, g: int, after: np.ndarray, n: np.ndarray, before: np.ndarray, m: np.ndarray, own: float, sign: int) -> None:
        self.joint[g, after] += sign * n
        self.joint[before, g] += sign * m
        self.joint[g, g] += sign * own
        self.out[g] += sign * (n.sum() + own)
        self.into[g] += sign * (m.sum() + own)

    def gains(self, right: np.ndarray, left: np.ndarray) -> np.ndarray:
        """First order of the gain of every class (columns) for words (rows) by their neighbours' classes after and before them."""
        k = self.k
        log = np.log(np.maximum(self.joint, 0) + 0.5)
        gain = right @ log.T[:, :k] + left @ log[:, :k]
        gain -= right.sum(axis=1)[:, None] * np.log(np.maximum(self.out[:k], 0) + 1)
        return gain - left.sum(axis=1)[:, None] * np.log(np.maximum(self.into[:k], 0) + 1)

    def shortlist(self, right: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The most promising classes of words, ascending."""
        if self.k <= SHORT:
            return np.tile(np.arange(self.k), (len(right), 1))
        return np.sort(np.argpartition(self.gains(right, left), -SHORT, axis=1)[:, -SHORT:], axis=1)

    def move(
        self, g: int, after: np.ndarray, n: np.ndarray, before: np.ndarray, m: np.ndarray, own: float = 0.0, c: np.ndarray | None = None
    ) -> int:
        """The class, of those of ``c`` and its own, of a word of class ``g`` with ``n`` neighbours of the classes
        ``after`` it, ``m`` of ``before`` it, and ``own`` times itself."""
        k = self.k
        self._add(g, after, n, before, m, own, -1)
        right, left = np.zeros(len(self.joint)), np.zeros(len(self.joint))
        right[after], left[before] = n, m
        if c is None:
            c = self.shortlist(right[None], left[None])[0]
        if g < k and not (c == g).any():
            c = np.append(c, g)
        # Wherever the word goes, its neighbours' classes keep in their sums what they share with it.
        met = np.concatenate([self.joint[c[:, None], after], self.joint[before, c[:, None]]], axis=1)
        f = _xlogx(np.concatenate([met + np.concatenate([n, m]), met]))
        gain = (f[: len(c)] - f[len(c) :]).sum(axis=1)
        # The cell of a class with itself lies in its row and in its column.
        d, r, l, out, into = self.joint[c, c], right[c], left[c], self.out[c], self.into[c]
        f = _xlogx(np.array([d + r + l + own, d, d + r, d + l, out + n.sum() + own, out, into + m.sum() + own, into]))
        gain += f[0] + f[1] - f[2] - f[3] - f[4] + f[5] - f[6] + f[7]
        best = int(c[gain.argmax()])
        if g < k and gain.max() <= gain[c == g][0] + 1e-9:
            best = g
        self._add(best, after, n, before, m, own, 1)
        return best


def _sides(row: list[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words, neighbours and counts after and before the words of a range."""
    for keys, counts in (row[:2], row[2:]):
        keys = np.cumsum(_unpacked(keys))
        yield keys // width, keys % width, _unpacked(counts)


def _cells(of: Broadcast, size: int, k: int, outside: bool):
    """Class-class sums of the ranges: cells ``class * (k + 2) + class``; words outside the head count if asked for."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 2) ** 2, np.int64)
        classes = of.value
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in _NEIGHBOURS_NAMES[1:])):
                (w, after, n), (v, before, m) = _sides(list(row), size + 2)
                only_left = before >= size  # pairs of two head words are counted after the first
                a = np.concatenate([classes[w], classes[before[only_left]]])
                b = np.concatenate([classes[after], classes[v[only_left]]])
                c = np.concatenate([n, m[only_left]])
                if not outside:
                    known = np.concatenate([after != size, before[only_left] != size])
                    a, b, c = a[known], b[known], c[known]
                total += np.bincount(a.astype(np.int64) * (k + 2) + b, c, (k + 2) ** 2).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "c"])

    return run


def _joint(neighbours: DataFrame, of: np.ndarray, size: int, k: int, outside: bool) -> np.ndarray:
    sent = neighbours.sparkSession.sparkContext.broadcast(of)
    cells = neighbours.mapInArrow(_cells(sent, size, k, outside), "cell long, c long").groupBy("cell").agg(F.sum("c").alias("c")).toPandas()
    joint = np.zeros((k + 2) ** 2)
    joint[cells["cell"].to_numpy(np.int64)] = cells["c"].to_numpy(float)
    return joint.reshape(k + 2, k + 2)


def _exchanged(of: Broadcast, joint: Broadcast, size: int, k: int):
    """New classes ``id, g`` of the words of the ranges."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, exchange, width = of.value, Exchange(joint.value, k), k + 2
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in _NEIGHBOURS_NAMES[1:])):
                sides = list(_sides(list(row), size + 2))
                ids = np.unique(np.concatenate([w for w, _, _ in sides]))
                own, tables = np.zeros(len(ids)), []
                for side, (w, other, n) in enumerate(sides):
                    at = np.searchsorted(ids, w)
                    itself = w == other
                    if not side:
                        own[at[itself]] = n[itself]
                    table = np.bincount(at[~itself] * width + classes[other[~itself]], n[~itself], len(ids) * width)
                    tables.append(table.reshape(len(ids), width))
                found, promising = [], exchange.shortlist(*tables)
                for x, i in enumerate(ids.tolist()):
                    after, before = (np.flatnonzero(t[x]) for t in tables)
                    found.append(exchange.move(
                        int(classes[i]), after, tables[0][x, after], before, tables[1][x, before], float(own[x]), promising[x]
                    ))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found, pa.int32())], names=["id", "g"])

    return run


def clustered_head(neighbours: DataFrame, size: int, k: int, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the ``size`` head words, and the class-class sums with words outside.

    The first ``k`` words start a class each. The others have none until the first sweep gives them one; as
    contexts they are one class until then, as are words outside throughout. Behind the words stand the classes of
    those, ``k``, and of the end, ``k + 1``.
    """
    context = neighbours.sparkSession.sparkContext
    of = np.full(size + 2, k, np.int32)
    of[:k] = np.arange(k)
    of[size + 1] = k + 1
    for _ in range(sweeps if size else 0):
        joint = _joint(neighbours, of, size, k, True)
        moved = neighbours.mapInArrow(_exchanged(context.broadcast(of), context.broadcast(joint), size, k), "id long, g int").toPandas()
        of = of.copy()
        of[moved["id"].to_numpy(np.int64)] = moved["g"].to_numpy(np.int32)
    return of, _joint(neighbours, of, size, k, True)


def _placed(joint: Broadcast, k: int, least: int):
    """Classes ``word, g`` for words outside the head that have ``least`` places, from all places' ``word, left, right`` sorted by word.

    These words are rare beside the classes, so the first order of the gain decides, and the sums stay as they are.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exchange, width = Exchange(joint.value, k), k + 2
        # In the sums the end, which is k at a place, is k + 1, and another word outside, which is -1, is k.
        code = np.append(np.arange(k), [k + 1, k])

        def placed(word: pa.Array, tables: np.ndarray) -> pa.RecordBatch:
            often = tables[0].sum(axis=1) >= least
            found = exchange.gains(*tables[:, often]).argmax(axis=1)
            return pa.RecordBatch.from_arrays([word.filter(pa.array(often)), pa.array(found, pa.int32())], names=["word", "g"])

        last, held = pa.array([], pa.string()), np.zeros((2, 0, width))  # the word of the last place, which may have more
        for batch in rows_of(batches, 10_000):
            if not batch.num_rows:
                continue
            word = batch["word"].cast(pa.string())
            begins = np.flatnonzero(np.append(True, pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)))
            at = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(word))) * width
            cells = [np.bincount(at + code[batch[side].to_numpy()], minlength=len(begins) * width) for side in ("right", "left")]
            tables, found = np.stack(cells).reshape(2, -1, width).astype(float), word.take(pa.array(begins))
            if len(last) and last[0] == found[0]:
                tables[:, :1] += held
            else:
                yield placed(last, held)
            yield placed(found[:-1], tables[:, :-1])
            last, held = found[-1:], tables[:, -1:]
        yield placed(last, held)

    return run


def classes_outside(counts: DataFrame, tail_of: DataFrame, head: DataFrame) -> DataFrame:
    """``word, c, g`` of all words outside the head: their own class or, for a rarer one, that of its last three characters."""
    def ended(df: DataFrame) -> DataFrame:
        return df.withColumn("ending", F.expr("right(word, 3)"))

    often = ended(head.select("word", "g").union(tail_of.select("word", "g"))).groupBy("ending", "g").agg(F.count("*").alias("n"))
    often = settle(often, "endings")
    ends = often.groupBy("ending").agg(F.max(F.struct("n", -F.col("g"))).alias("most"))
    ends = ends.select("ending", (-F.col("most")["col2"]).alias("theirs"))
    most = often.groupBy("g").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "g").first()
    out = ended(counts).join(tail_of, "word", "left").join(ends, "ending", "left")
    return out.select("word", "c", F.coalesce("g", "theirs", F.lit(most["g"] if most else 0)).cast("int").alias("g"))


# ---------------------------------------------------------------- lines of classes

_LINES = (
    "row long, doc_id long, train boolean, n_tokens long, n_known long, base double, logs double, line binary, "
    "word string, run int, at int, left int, right int"
)
_LINE_NAMES = [x.split()[0] for x in _LINES.split(", ")]


@dataclass(frozen=True)
class Head:
    """What every task holds of the head: places, classes, and logarithms of counts."""

    words: pa.Array
    of: np.ndarray
    base: np.ndarray  # log10 by the base formula; last, of the end
    logs: np.ndarray  # log10 of the discounted count


def _lines(sent: Broadcast, end: int, end_known: int):
    """A row for every text with the classes of its head words, and one for every word outside the head: its place, the
    place where its run of such words begins, and the classes before and after it, -1 for another such word."""

    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
    rare_kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, head = TaskContext.get().partitionId() << 40, sent.value
        of = np.append(head.of, -1).astype(np.int64)
        for batch in _by_size(batches):
            n = batch.num_rows
            flat, at, lengths = _looked_up(batch["text"], head.words, -1)
            # The texts' lines lie end to end, each between two ends.
            text = np.repeat(np.arange(n), lengths)
            place = np.arange(len(flat)) + 2 * text + 1
            line = np.full(len(flat) + 2 * n, end)
            line[place] = of[at]
            bytes_of = np.where(line < 0, OUTSIDE, line).astype("<u2").tobytes()
            known = at >= 0
            base, logs = head.base[at[known]], head.logs[at[known]]
            n_known = np.bincount(text[known], minlength=n)
            upto, ends = np.cumsum(n_known).tolist(), np.cumsum(2 * (lengths + 2)).tolist()
            whole: list[tuple] = []
            i = j = 0
            for x, (doc_id, train) in enumerate(zip(batch["doc_id"].to_pylist(), batch["train"].to_pylist())):
                whole.append((row + x, doc_id, train, (ends[x] - j) // 2 - 1, upto[x] - i + end_known, float(base[i : upto[x]].sum() + head.base[-1]),
                              float(logs[i : upto[x]].sum()), bytes_of[j : ends[x]]))
                i, j = upto[x], ends[x]
            out = np.flatnonzero(~known)
            of_text, left, right = text[out], line[place[out] - 1], line[place[out] + 1]
            k = out - (np.cumsum(lengths) - lengths)[of_text]
            # A text's first word outside the head has a class or an end before it, and so begins a run.
            begin = k[np.maximum.accumulate(np.where(left >= 0, np.arange(len(out)), 0))]
            trained = batch["train"].to_numpy(zero_copy_only=False)[of_text]
            if whole:
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, k) for c, k in zip(zip(*whole), kinds)), pa.nulls(n, pa.string()), *(pa.nulls(n, k) for k in rare_kinds)],
                    names=_LINE_NAMES,
                )
            for start in range(0, len(out), 200_000):
                some = slice(start, start + 200_000)
                m = len(out[some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + of_text[some]), pa.nulls(m, pa.int64()), pa.array(trained[some], pa.bool_()), *(pa.nulls(m, x) for x in kinds[3:]),
                     flat.take(pa.array(out[some])).cast(pa.string()),
                     *(pa.array(x[some].astype(np.int32)) for x in (begin, k, left, right))],
                    names=_LINE_NAMES,
                )
            row += n

    return run


_STEPS = "row long, train boolean, c long, before int, g int, after int"


def _stepped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word's class between those before and after it, from rows sorted by row, run and place; after is -1 inside a run."""
    last = -1
    for batch in batches:
        if not batch.num_rows:
            continue
        left, g = batch["left"].to_numpy(), batch["g"].to_numpy()
        # Within a run the word before is the row before.
        before = np.where(left >= 0, left, np.append(last, g[:-1])).astype(np.int32)
        last = g[-1]
        columns = [batch["row"], batch["train"], batch["c"], pa.array(before), batch["g"], batch["right"]]
        yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _STEPS.split(", ")])


# ---------------------------------------------------------------- the model

@dataclass(frozen=True)
class ClassModel:
    """Tables by class: log10 transitions, whose last two are the end and the unknown word, and tokens of each class."""

    transition: np.ndarray
    per_class: np.ndarray
    tokens: int
    types: int
    discount: float


def transitions(joint: np.ndarray, per_class: np.ndarray, freed: np.ndarray) -> np.ndarray:
    """log10 from class to class, the last row and column being the unknown word.

    ``joint`` counts the bigrams of the classes of words and, last, the end. Each class frees the share ``freed``
    of its mass for the unknown word, which therefore may stand for any class, as likely as that class has freed mass.
    """
    size = len(joint)
    share = (joint.sum(axis=0) + 1) / (joint.sum() + size)
    p = (joint + BACKOFF * share) / (joint.sum(axis=1, keepdims=True) + BACKOFF)
    k = size - 1
    mass = freed * per_class
    stands = mass / mass.sum() if mass.sum() else np.full(k, 1 / max(1, k))
    p = np.vstack([p, stands @ p[:k] if k else p[-1]])
    unknown = p[:, :k] @ freed if mass.sum() else np.ones(len(p))
    return np.log10(np.column_stack([p, unknown]))


def _whole_scores(model: Broadcast):
    """Scores of what a text's head words give by themselves."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transition = model.value.transition
        share = np.log10(np.maximum(model.value.per_class, 1))
        end = len(transition) - 2
        for batch in rows_of(batches, 10_000):
            data = batch["line"].to_pylist()
            line = np.frombuffer(b"".join(data), "<u2").astype(np.int64)
            upto = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) // 2)
            inside = line != OUTSIDE
            here = inside[:-1] & inside[1:]
            here[upto[:-1] - 1] = False  # no text goes on in the next
            own = inside & (line != end)
            steps, shares = transition[line[:-1][here], line[1:][here]], share[line[own]]
            found, i, j = [], 0, 0
            to_steps, to_shares = (np.append(0, np.cumsum(x))[y].tolist() for x, y in ((here, upto - 1), (own, upto)))
            for logs, x, y in zip(batch["logs"].to_pylist(), to_steps, to_shares):
                found.append(float(logs + steps[i:x].sum() - shares[j:y].sum()))
                i, j = x, y
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(found, pa.float64())], names=["row", "score"])

    return run


def _outside_scores(model: Broadcast):
    """Sums for the words outside the head, a row for each stretch of one text: base, score and known ones."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        share = np.append(np.maximum(m.per_class, 1), 1.0)
        for batch in batches:
            if not batch.num_rows:
                continue
            row, c, before, g, after = (batch[x].to_numpy().astype(np.int64) for x in ("row", "c", "before", "g", "after"))
            known = c > 0
            size = share[np.minimum(g, len(share) - 1)]  # the unknown word's is not used
            score = m.transition[before, g] + np.where(after >= 0, m.transition[g, after], 0.0)
            score += np.where(known, np.log10(np.maximum(c - m.discount, 1e-9) / size), 0.0)
            base = np.log10((c + 1) / (m.tokens + m.types + 1))
            starts, _ = runs(row)
            sums = [np.add.reduceat(x, starts) for x in (base, score, known.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array(row[starts]), *map(pa.array, sums)], names=["row", "more_base", "more_score", "more_known"])

    return run


@dataclass(frozen=True)
class Fitted:
    model: ClassModel
    lines: DataFrame  # texts and words outside the head
    steps: DataFrame  # words outside the head with their classes
    head: DataFrame  # word, c, g
    outside: DataFrame  # word, c, g of all other words


def fit(docs: DataFrame, head_size: int = HEAD, least: int = LEAST) -> Fitted:
    """The model of the training rows of ``doc_id, train, text``, and all rows as lines of classes."""
    spark = docs.sparkSession
    training = docs.where("train").select("text")
    counts = training.mapInArrow(resting(_count_words), "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counts = settle(counts, "words")
    n_docs = training.count()
    about = counts.agg(
        F.count("*").alias("types"), F.sum("c").alias("tokens"), F.count_if(F.col("c") == 1).alias("ones"), F.count_if(F.col("c") == 2).alias("twos")
    ).first()
    types, tokens = about["types"] + int(n_docs > 0), (about["tokens"] or 0) + n_docs
    ones, twos = about["ones"], about["twos"]
    discount = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones else 0.1

    top = counts.where(F.col("c") >= least).orderBy(F.desc("c"), "word").limit(head_size).toPandas()
    size, c = len(top), top["c"].to_numpy(float)
    k = max(1, n_classes(size)) if about["types"] else 0
    first = pa.array(top["word"].tolist(), pa.string())
    ranges = max(1, -(-size // PER_RANGE))
    neighbours = training.mapInArrow(resting(_neighbours(spark.sparkContext.broadcast(first), size, ranges)), _NEIGHBOURS)
    # Sweeps read the ranges in as many tasks as there are files, whatever their size.
    neighbours = neighbours.repartition(max(1, ranges // 4), "range").sortWithinPartitions("range").mapInArrow(_merged, _NEIGHBOURS)
    neighbours = settle(neighbours, "neighbours")
    of, joint = clustered_head(neighbours, size, k)
    head = spark.createDataFrame(
        pd.DataFrame({"word": top["word"].astype(object), "c": top["c"].astype("int64"), "g": of[:size].astype("int32")}), "word string, c long, g int"
    )

    base = np.log10((np.append(c, n_docs) + 1) / (tokens + types + 1))
    sent = spark.sparkContext.broadcast(Head(first, of[:size], base, np.log10(np.maximum(c - discount, 1e-9))))
    lines = settle(docs.mapInArrow(resting(_lines(sent, k, int(tokens > 0))), _LINES), "lines")

    rare = lines.where("word is not null").select("row", "train", "word", "run", "at", "left", "right")
    outside = counts
    if size:  # in the order of the head, all words after its last
        last = top.iloc[-1]
        outside = counts.where((F.col("c") < int(last["c"])) | ((F.col("c") == int(last["c"])) & (F.col("word") > str(last["word"]))))
    # A word has as many places here as counts, so those that occur too rarely are told by these.
    around = rare.where("train").select("word", "left", "right").repartition("word").sortWithinPartitions("word")
    tail_of = settle(around.mapInArrow(_placed(spark.sparkContext.broadcast(joint), k, least), "word string, g int"), "placed")
    classed = settle(classes_outside(outside, tail_of, head), "classed")

    unknown = k + 1
    # No word is classed twice, so tables of these spare the sort of all places by word.
    placed = rare.join(classed.hint("shuffle_hash"), "word", "left").select(
        "row", "train", "run", "at", "left", "right", F.coalesce("c", F.lit(0)).cast("long").alias("c"), F.coalesce("g", F.lit(unknown)).cast("int").alias("g")
    )
    # A text's words meet in one task, so that its sums are one row of it or few, however many partitions there are.
    placed = placed.repartition("row").sortWithinPartitions("row", "run", "at")
    steps = settle(placed.select("row", "train", "c", "g", "left", "right").mapInArrow(_stepped, _STEPS), "steps")

    # Bigrams of all words: between head words and ends, around words outside, and of texts without words.
    joint = _joint(neighbours, of, size, k, False)
    joint = np.delete(np.delete(joint, k, axis=0), k, axis=1)  # words outside have classes now
    passed = steps.where("train").select("before", "g", "after")
    passed = passed.select(F.col("before").alias("a"), F.col("g").alias("b")).union(passed.where("after >= 0").select("g", "after"))
    for r in passed.groupBy("a", "b").agg(F.count("*").alias("c")).toPandas().itertuples():
        joint[r.a, r.b] += r.c
    joint[k, k] += lines.where("word is null and train and n_tokens = 1").count()

    sums = classed.groupBy("g").agg(F.sum("c").alias("c"), F.count("*").alias("n")).toPandas()
    per_class = np.bincount(of[:size], c, k).astype(float)
    held = np.bincount(of[:size], minlength=k).astype(float)
    per_class[sums["g"].to_numpy(np.int64)] += sums["c"].to_numpy(float)
    held[sums["g"].to_numpy(np.int64)] += sums["n"].to_numpy(float)
    freed = discount * held / np.maximum(per_class, 1)
    model = ClassModel(transitions(joint, per_class, freed), per_class, tokens, types, discount)
    return Fitted(model, lines, steps, head, classed)


def lm_scores(docs: DataFrame, head_size: int = HEAD, least: int = LEAST) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity``.

    Training texts are those whose id's CRC leaves another remainder than 2 by 7. ``base_score`` is the
    add-one unigram of the contract. ``score`` is the class model's log10 probability of the
    whole text: all words of the training texts have a class, in which they are discounted
    absolutely, the mass freed being that of one unknown word, as the base has one. Words that occur ``least``
    times are clustered, the ``head_size`` most frequent of them in sweeps; classes are as many as the root of
    those, halved.

    Cases: null and empty texts are the end alone; rows repeated give equal rows, and training ones
    count each time; a null id is neither trained on nor held out; without training texts every word
    is unknown; an empty table gives no rows.
    """
    docs = only(docs, doc_id="long", text="string")
    docs = docs.select("doc_id", F.coalesce(fold("doc_id", 7) != 2, F.lit(False)).alias("train"), "text")
    fitted = fit(docs, head_size, least)
    sent = docs.sparkSession.sparkContext.broadcast(fitted.model)
    texts = fitted.lines.where("word is null")
    own = texts.select("row", "logs", "line").mapInArrow(_whole_scores(sent), "row long, score double")
    more = fitted.steps.mapInArrow(_outside_scores(sent), "row long, more_base double, more_score double, more_known long")
    more = more.groupBy("row").agg(*(F.sum(x).alias(x) for x in ("more_base", "more_score", "more_known")))
    out = texts.select("row", "doc_id", "n_tokens", "n_known", "base").join(own, "row").join(more, "row", "left").select(
        "doc_id", F.coalesce(fold("doc_id", 7) == 2, F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(fitted.model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
