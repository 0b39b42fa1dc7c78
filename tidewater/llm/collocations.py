"""Phrase collocations, counted in quotient filters.

1. Every task splits its texts into words, gives them ids of its own, and writes the id streams with the
   words' counts. Counts are summed by language and word. A phrase that occurs ``least`` times has only words that
   do, so just these get ids of the corpus, densely, and are joined back to each task's own ids.
2. Streams and ids meet again by task. Runs of two and three known words are packed, permuted and counted in a
   quotient filter, which is split by the first bits of its keys; filters of one range are merged.
3. Frequent phrases come back from the merged filters as word ids; scores, the rule against parts of longer
   phrases and ranks are joins and windows over these.

Nothing is broadcast or collected but the number of words of each partition.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.quotient_filter import Packing, QuotientFilter
from tidewater.llm.shared import only, rows_of
from tidewater.session import settle

LEAST, TOP, UNKNOWN = 10, 2_000, "und"
#: Words to a row of a stream, and own ids of a task before it starts anew.
ROW, OWN_IDS = 1 << 18, 1_000_000
#: Phrases that a task counts at once, and about as many to a range of keys.
AT_ONCE = 4_000_000
# A-Z in lower case; what parts pieces becomes a full stop, which then stands for nothing else.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b",;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9)

_LEARNED = "part long, seq long, lang string, word string, own int, c long, ids binary"
_NAMES = [x.split()[0] for x in _LEARNED.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary()]


class _Own(dict):
    """Ids, from 1 on, of words in the order of their first use; all languages share one count."""

    def __init__(self, used: list[bytes]):
        self.used = used
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        self.used.append(word)
        self[word] = len(self.used)
        return len(self.used)


def _learner(row_words: int, own_ids: int):
    """Streams of own ids, 0 between pieces and after texts, and the words behind the ids with their counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 20

        def fresh():
            used: list[bytes] = []
            return used, defaultdict(lambda: _Own(used)), {}

        def row(held: list[np.ndarray], seq: int):
            ids = np.concatenate(held).astype("<i4")
            line = pa.compress(ids.tobytes(), codec="zstd", asbytes=True)
            size = np.int64(len(ids)).tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in zip((part, seq, None, None, None, None, size + line), _KINDS)], names=_NAMES
            )

        def words():
            langs = np.empty(len(used), object)
            for lang, spans in where.items():
                for a, b in spans:
                    langs[a:b] = lang
            for at in range(0, len(used), 100_000):
                some = used[at : at + 100_000]
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n), pa.nulls(n, pa.int64()), pa.array(langs[at : at + n], pa.string()),
                     pa.array(some, pa.binary()).cast(pa.string()), pa.array(np.arange(at + 1, at + n + 1, dtype=np.int32)),
                     pa.array(counts[at + 1 : at + n + 1]), pa.nulls(n, pa.binary())],
                    names=_NAMES,
                )

        used, own, where = fresh()
        counts = np.zeros(1, np.int64)
        held, n, seq = [], 0, 0

        def flush():
            nonlocal held, n, seq, counts
            if held:
                more = np.bincount(np.concatenate(held), minlength=len(used) + 1)
                more[: len(counts)] += counts
                counts = more
                yield row(held, seq)
                held, n, seq = [], 0, seq + 1

        for batch in rows_of(batches, 100):
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                parts = text.encode().translate(_PLAIN).replace(b".", b" . ").split()
                before = len(used)
                parts.append(b".")
                held.append(np.fromiter(map(own[lang].__getitem__, parts), np.int64, len(parts)))
                n += len(parts)
                if len(used) > before:
                    where.setdefault(lang, []).append((before, len(used)))
                if n > row_words:
                    yield from flush()
            if len(used) > own_ids:
                yield from flush()
                yield from words()
                part, seq = part + 1, 0
                used, own, where = fresh()
                counts = np.zeros(1, np.int64)
        yield from flush()
        yield from words()

    return run


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        columns = [pa.array(np.full(n, task, np.int32)), pa.array(np.arange(at, at + n)), *(batch[c] for c in ("lang", "word", "c"))]
        at += n
        yield pa.RecordBatch.from_arrays(columns, names=["task", "at", "lang", "word", "c"])


def known_words(words: DataFrame, least: int) -> tuple[DataFrame, int]:
    """``id, lang, word, c`` of the words that occur ``least`` times, ids being dense from 1 on, and their number."""
    spark = words.sparkSession
    often = words.where(F.col("c") >= least).mapInArrow(_numbered, "task int, at long, lang string, word string, c long")
    often = settle(often, "known-words")
    # One row for each partition.
    sizes = often.groupBy("task").agg(F.count("*").alias("n")).orderBy("task").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["task"], total))
        total += r["n"]
    first = spark.createDataFrame(starts, "task int, first long")
    return settle(often.join(first, "task").select((F.col("first") + F.col("at") + 1).alias("id"), "lang", "word", "c"), "word-ids"), total


def _counted(packing: Packing, prefix: int, at_once: int):
    """Filters by range of the phrases in rows ``part, kind, own, id, ids``: first a part's ids, then its stream."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own, ids, lookup = None, [], [], None
        lefts, rights, n = [], [], 0

        def flush():
            nonlocal lefts, rights, n
            if lefts:
                # What was gathered is let go before it is sorted, which takes as much again.
                whole, other = np.concatenate(lefts), np.concatenate(rights) if rights else None
                lefts, rights, n = [], [], 0
                found = QuotientFilter.of_keys(packing.half, whole) if other is None else QuotientFilter.of(packing.half, whole, other)
                del whole, other
                for which, some in found.split(prefix):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([which], pa.int64()), pa.array([some.to_bytes()], pa.binary())], names=["range", "filter"]
                    )

        for batch in batches:
            parts, kinds = (batch[c].to_numpy() for c in ("part", "kind"))
            turns = np.concatenate([[0], np.flatnonzero((parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1])) + 1, [len(parts)]])
            for a, b in zip(turns[:-1].tolist(), turns[1:].tolist()):
                if a == b:
                    continue
                if parts[a] != part:
                    part, own, ids, lookup = parts[a], [], [], None
                if kinds[a] == 0:
                    own.append(batch["own"].slice(a, b - a).to_numpy())
                    ids.append(batch["id"].slice(a, b - a).to_numpy())
                    continue
                if lookup is None:
                    # Own ids without an entry are words too rare for any phrase.
                    keys = np.concatenate([np.zeros(1, np.int64), *own]).astype(np.int64)
                    lookup = np.zeros(int(keys.max()) + 1, np.int64)
                    lookup[keys] = np.concatenate([np.zeros(1, np.int64), *ids])
                for line in batch["ids"].slice(a, b - a).to_pylist():
                    size = int(np.frombuffer(line, np.int64, 1)[0])
                    stream = np.frombuffer(pa.decompress(line[8:], 4 * size, codec="zstd", asbytes=True), "<i4")
                    g = lookup[np.where(stream < len(lookup), stream, 0)]
                    two = np.flatnonzero((g[:-1] > 0) & (g[1:] > 0))
                    three = two[:-1][(np.diff(two) == 1)] if len(two) else two
                    x = np.concatenate([g[two], g[three]])
                    y = np.concatenate([g[two + 1], g[three + 1]])
                    z = np.concatenate([np.zeros(len(two), np.int64), g[three + 2]])
                    left, right = packing.pack(x, y, z)
                    n += len(left)
                    keys = packing.joined(left, right)
                    lefts.append(left if keys is None else keys)
                    if keys is None:
                        rights.append(right)
                    if n > at_once:
                        yield from flush()
        yield from flush()

    return run


def _merged(packing: Packing, least: int, at_once: int):
    """Phrases that occur ``least`` times, from rows ``range, filter`` sorted by range."""

    def rows(filters: list[QuotientFilter]) -> pa.RecordBatch:
        found = QuotientFilter.merged(filters)
        keep = found.counts >= least
        columns = (*packing.unpack(found.left[keep], found.right[keep]), found.counts[keep])
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["x", "y", "z", "f"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, n = None, [], 0
        for batch in batches:
            for which, data in zip(batch["range"].to_pylist(), batch["filter"].to_pylist()):
                if which != now:
                    if held:
                        yield rows(held)
                    now, held, n = which, [], 0
                held.append(QuotientFilter.from_bytes(data, which))
                n += len(held[-1])
                if n > at_once:  # what is held shrinks to the distinct phrases of the range
                    held = [QuotientFilter.merged(held)]
                    n = 0
        if held:
            yield rows(held)

    return run


def phrase_counts(
    docs: DataFrame, least: int, row_words: int = ROW, own_ids: int = OWN_IDS, at_once: int = AT_ONCE
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sums ``lang, word, c`` of all words; the known ones with ids; ``x, y, z, f`` of frequent phrases, z = 0 for two words."""
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    learned = settle(docs.mapInArrow(_learner(row_words, own_ids), _LEARNED), "learned")
    own = learned.where("word is not null").select("part", "lang", "word", "own", "c")
    words = settle(own.groupBy("lang", "word").agg(F.sum("c").alias("c")), "words")
    known, n_known = known_words(words, least)
    n = words.agg(F.sum("c")).first()[0] or 0
    packing = Packing(max(1, n_known.bit_length()))
    prefix = min(packing.half, max(0, (2 * n // at_once).bit_length()))

    ids = own.join(known.select("lang", "word", "id"), ["lang", "word"]).select(
        "part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("seq"), F.col("own").cast("long").alias("own"), "id", F.lit(None).cast("binary").alias("ids")
    )
    streams = learned.where("ids is not null").select("part", F.lit(1), "seq", F.lit(0).cast("long"), F.lit(0).cast("long"), "ids")
    order = ["part", "kind", "seq"]
    both = ids.union(streams).repartition("part").sortWithinPartitions(*order).select("part", "kind", "own", "id", "ids")
    filters = both.mapInArrow(_counted(packing, prefix, at_once), "range long, filter binary")
    phrases = filters.repartition("range").sortWithinPartitions("range").mapInArrow(
        _merged(packing, least, at_once), "x long, y long, z long, f long"
    )
    return words, known, settle(phrases, "phrases")


def _score(a: str, l: str, r: str) -> Column:
    """``floor(1000000 * a * a / (l * r))`` in whole decimals of 38 digits; at most 1,000,000."""
    return F.expr(f"(cast({a} as decimal(18,0)) * {a} * cast(1000000 as decimal(7,0))) div (cast({l} as decimal(18,0)) * {r})")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, row_words: int = ROW, own_ids: int = OWN_IDS, at_once: int = AT_ONCE
) -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``row_words``, ``own_ids`` and ``at_once`` size what a task holds and change no result.
    Candidates are phrases of two or three words within a piece that occur ``a >= least`` times. The cut with the
    lowest score counts, the earlier of equals. A candidate inside a longer one with at least half its count is
    dropped.

    Cases: a null language is ``und``, a null text is empty; repeated rows count each time; texts of any length are
    one row of a task; a language without candidates gives no rows, nor does an empty table.
    """
    words, known, phrases = phrase_counts(only(docs, lang="string", text="string"), least, row_words, own_ids, at_once)

    def named(key: str) -> DataFrame:
        return known.select(F.col("id").alias(key), F.col("word").alias(f"w{key}"), F.col("c").alias(f"c{key}"))

    two = phrases.where("z = 0").select("x", "y", F.col("f").alias("a"))
    two = two.join(known.select(F.col("id").alias("x"), "lang", F.col("word").alias("wx"), F.col("c").alias("cx")), "x").join(named("y"), "y")
    two = settle(two, "two")
    three = phrases.where("z > 0").withColumnRenamed("f", "a")
    three = three.join(two.select("x", "y", "lang", "wx", "wy", "cx", F.col("a").alias("fxy")), ["x", "y"])
    three = three.join(two.select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("wy").alias("wz"), F.col("cy").alias("cz"), F.col("a").alias("fyz")), ["y", "z"])
    three = settle(three, "three")

    longer = three.select("x", "y", "a").union(three.select("y", "z", "a")).groupBy("x", "y").agg(F.max("a").alias("longer"))
    two = two.join(longer, ["x", "y"], "left").where(100 * F.coalesce("longer", F.lit(0)) < 50 * F.col("a"))
    two = two.select("lang", F.concat_ws(" ", "wx", "wy").alias("phrase"), "a", F.col("cx").alias("l"), F.col("cy").alias("r"), _score("a", "cx", "cy").alias("score"))
    three = three.withColumns({"s1": _score("a", "cx", "fyz"), "s2": _score("a", "fxy", "cz")})
    first = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "wx", "wy", "wz").alias("phrase"), "a",
        F.when(first, F.col("cx")).otherwise(F.col("fxy")).alias("l"), F.when(first, F.col("fyz")).otherwise(F.col("cz")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.union(three).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("c").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


#: The same in SQL, counting the phrases as text.
ORACLE = r"""
with plain as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
), pieces as (
  select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from plain
), worded as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from pieces),
places as (
  select lang, unnest(range(1, len(w) + 1)) as i, w from worded
), grams as (
  select lang, w[i] as x, case when i + 1 <= len(w) then w[i + 1] end as y, case when i + 2 <= len(w) then w[i + 2] end as z from places
), one as (select lang, x, count(*) as f from grams group by all),
two as (select lang, x, y, count(*) as a from grams where y is not null group by all having count(*) >= 10),
three as (select lang, x, y, z, count(*) as a from grams where z is not null group by all having count(*) >= 10),
scored as (
  select two.lang, two.x || ' ' || two.y as phrase, a, u.f as l, v.f as r,
    1000000::hugeint * a * a // (u.f::hugeint * v.f) as score
  from two join one u on u.lang = two.lang and u.x = two.x join one v on v.lang = two.lang and v.x = two.y
  where not exists (
    select 1 from three where three.lang = two.lang and 100 * three.a >= 50 * two.a
      and (three.x = two.x and three.y = two.y or three.y = two.x and three.z = two.y))
  union all
  select lang, phrase, a, case when s1 <= s2 then l1 else l2 end, case when s1 <= s2 then r1 else r2 end, least(s1, s2)
  from (
    select three.lang, three.x || ' ' || three.y || ' ' || three.z as phrase, three.a, u.f as l1, yz.a as r1, xy.a as l2, v.f as r2,
      1000000::hugeint * three.a * three.a // (u.f::hugeint * yz.a) as s1,
      1000000::hugeint * three.a * three.a // (xy.a::hugeint * v.f) as s2
    from three join one u on u.lang = three.lang and u.x = three.x join one v on v.lang = three.lang and v.x = three.z
      join two xy on xy.lang = three.lang and xy.x = three.x and xy.y = three.y
      join two yz on yz.lang = three.lang and yz.x = three.y and yz.y = three.z)
), totals as (select lang, sum(f)::bigint as n from one group by lang),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from scored)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join totals using (lang) where rank <= 2000
"""
