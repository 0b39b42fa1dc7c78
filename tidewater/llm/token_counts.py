"""Token counts of whole texts by overlap resynchronisation.

Texts of up to ``chunk`` characters are counted by the library in one go. A longer one is cut into parts,
and each part is encoded with ``overlap`` characters of the next one. Of two neighbours, the first place where both
begin a match, and which the cut end of the left one cannot have changed, is where they are spliced: from there
on both scans agree, so the tokens of the left one before that place and of the right one after it are those
of the whole text. Where two parts have no such place, the overlap is widened, fourfold, up to the whole
right part; a part without any is taken into its left neighbour, whole runs of them at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater.llm.encoders import Shipped, load
from tidewater.llm.shared import only, rows_of
from tidewater.session import settle

CHUNK, OVERLAP, LIMIT = 16_384, 512, 512
_KEY = ["k1", "k2"]
_SPAN = ["part", "start", "stop", "end", "head_to"]
_CHUNK = "k1 long, k2 long, part long, start long, stop long, end long, head_to long, length long, text string"
_MARKS = (
    "k1 long, k2 long, part long, start long, stop long, end long, head_to long, length long, "
    "n long, head_at array<long>, head_n array<long>, tail_at array<long>, tail_n array<long>"
)


def _counted(sent: Shipped):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(sent)
        for batch in rows_of(batches, 128):
            n = encoder.counts([t or "" for t in batch["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of each text with what lies ahead of them, a few at a time."""
    names = [*_KEY, *_SPAN, "length", "text"]
    for batch in rows_of(batches, 1):
        k1, k2, text, spans = (batch[c][0].as_py() for c in (*_KEY, "text", "spans"))
        for at in range(0, len(spans), 64):
            out = [
                (k1, k2, *(s[x] for x in _SPAN), len(text), text[s["start"] : s["end"]]) for s in spans[at : at + 64]
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)


def _marked(sent: Shipped):
    """Where matches begin near both ends of a part, and how many tokens lie before."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(sent)
        names = [x.split()[0] for x in _MARKS.split(", ")]
        for batch in rows_of(batches, 32):
            out = []
            for row in batch.to_pylist():
                start = row["start"]
                zones = [(0, row["head_to"] - start), (row["stop"] - start, len(row["text"]))]
                at, before, n = encoder.begins(row["text"], [z for z in zones if z[0] < z[1]])
                sure = row["end"] - (0 if row["end"] == row["length"] else encoder.reach)
                marks = [(start + x, k) for x, k in zip(at, before)]
                head = [m for m in marks if m[0] < row["head_to"]]
                tail = [m for m in marks if row["stop"] <= m[0] <= sure]
                lists = ([x for x, _ in head], [k for _, k in head], [x for x, _ in tail], [k for _, k in tail])
                out.append((*(row[c] for c in names[:8]), n, *lists))
            if out:
                kinds = [pa.int64()] * 9 + [pa.list_(pa.int64())] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


def _encoded(cut: DataFrame, sent: Shipped) -> DataFrame:
    """Marks of the parts ``spans`` of each text; parts are dealt to many tasks, equal texts encoded once."""
    parts = cut.select(*_KEY, "text", "spans").mapInArrow(_cut, _CHUNK)
    return parts.dropDuplicates([*_KEY, "part"]).mapInArrow(_marked(sent), _MARKS)


def _first_spans(chunk: int, overlap: int) -> Column:
    length = F.length("text").cast("long")

    def span(start: Column) -> Column:
        stop = F.least(start + chunk, length)
        return F.struct(
            F.floor(start / chunk).alias("part"), start.alias("start"), stop.alias("stop"),
            F.least(stop + overlap, length).alias("end"), F.least(start + overlap, length).alias("head_to"),
        )

    return F.transform(F.sequence(F.lit(0).cast("long"), length - 1, F.lit(chunk).cast("long")), span)


def _seams(parts: DataFrame) -> DataFrame:
    """Parts with the place where each is spliced to the one before, null if there is none."""
    along = Window.partitionBy(*_KEY).orderBy("part")
    before = {f"p_{c}": F.lag(c).over(along) for c in ("end", "tail_at", "tail_n")}
    out = parts.withColumns(before).withColumn("seam", F.array_min(F.array_intersect("p_tail_at", "head_at")))
    count = lambda at, n: F.element_at(n, F.array_position(at, F.col("seam")).cast("int"))
    return out.withColumns({
        "p_before": F.when(F.col("seam").isNotNull(), count("p_tail_at", "p_tail_n")),
        "before": F.when(F.col("seam").isNotNull(), count("head_at", "head_n")),
        "failed": (F.col("start") > 0) & F.col("seam").isNull(),
    }).drop("p_tail_at", "p_tail_n")


def _widened(seams: DataFrame, overlap: int) -> DataFrame:
    """New spans after failed seams, with ``same`` true for those that need not be encoded again."""
    along = Window.partitionBy(*_KEY).orderBy("part")
    covered = F.col("failed") & (F.col("p_end") >= F.col("stop"))
    wide = F.lead(F.col("failed") & ~covered, 1, False).over(along)
    more = F.least(F.lead("stop").over(along), F.col("end") + 4 * (F.col("end") - F.col("stop")))
    out = seams.select(
        *_KEY, "length", "part", "start", "stop", "head_to", F.col("end").alias("was"), F.when(wide, more).otherwise(F.col("end")).alias("end"),
        F.sum((~covered).cast("int")).over(along).alias("run"),
    )
    out = out.groupBy(*_KEY, "run").agg(
        F.max("length").alias("length"), F.min("part").alias("part"), F.min("start").alias("start"), F.max("stop").alias("stop"),
        F.min_by("head_to", "part").alias("head_to"), F.max_by("end", "part").alias("end"), F.max_by("was", "part").alias("was"), F.count("*").alias("n"),
    )
    out = out.withColumn("end", F.when(F.col("n") > 1, F.least(F.col("stop") + overlap, "length")).otherwise(F.col("end")))
    head_to = F.coalesce(F.lag("end").over(along), "head_to")
    same = (F.col("n") == 1) & (F.col("was") == F.col("end")) & (head_to == F.col("head_to"))
    return out.withColumn("same", same).withColumn("head_to", head_to).drop("run", "was", "n")


def spliced_parts(giants: DataFrame, sent: Shipped, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``k1, k2, part, start, stop, n_tokens`` of the distinct texts ``k1, k2, text``.

    The parts of a text lie end to end from seam to seam, in characters, and their tokens are the text's.
    Every pass with a failed seam encodes just the parts that it widens or joins, so what is left shrinks.
    """
    if not load(sent).reach or not load(sent).reach < overlap <= chunk:
        raise ValueError("splicing needs a tokenizer with proven boundaries and an overlap longer than its reach")
    parts = settle(_encoded(giants.withColumn("spans", _first_spans(chunk, overlap)), sent), "token-parts")
    while True:
        seams = settle(_seams(parts), "token-seams")
        if not seams.where("failed").limit(1).count():
            break
        spans = settle(_widened(seams, overlap), "token-spans")
        kept = parts.join(spans.where("same").select(*_KEY, "part"), [*_KEY, "part"], "left_semi")
        again = spans.where("not same").groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct(*_SPAN))).alias("spans"))
        # Few texts: at its true size this side is broadcast, and the texts stay where they are.
        again = settle(again, "token-again")
        parts = settle(kept.unionByName(_encoded(giants.join(again, _KEY), sent)), "token-parts")
    along = Window.partitionBy(*_KEY).orderBy("part")
    return seams.select(
        *_KEY, "part", F.coalesce("seam", "start").alias("start"), F.coalesce(F.lead("seam").over(along), "length").alias("stop"),
        (F.coalesce(F.lead("p_before").over(along), "n") - F.coalesce("before", F.lit(0))).alias("n_tokens"),
    )


def token_counts(
    docs: DataFrame, sent: Shipped, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document: its whole text as the library counts it.

    No tokens are added at the ends; special strings in a text are what the library takes them for by default.
    A tokenizer whose boundaries are not proven (see ``encoders``) encodes every text whole.

    Cases: null and empty texts have no bytes and no tokens; repeated rows give the same row repeated; null ids are
    kept; a text without any boundary ends up as one part; an empty table gives no rows.
    """
    docs = only(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))
    is_long = F.length("text") > (chunk if load(sent).reach else 1 << 31)
    counted = "doc_id long, n_bytes long, n_tokens long"
    short = docs.where(~is_long).mapInArrow(_counted(sent), counted)
    giants = docs.where(is_long).withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})
    if load(sent).reach:
        parts = spliced_parts(giants.select(*_KEY, "text"), sent, chunk, overlap)
        sums = parts.groupBy(*_KEY).agg(F.sum("n_tokens").alias("n_tokens"))
        short = short.union(giants.drop("text").join(sums, _KEY).select("doc_id", "n_bytes", "n_tokens"))
    return short.withColumn("over_limit", F.col("n_tokens") > limit)
