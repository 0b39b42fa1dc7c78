"""Mixing sources to target weights, in DataFrame functions alone.

Every source's words form a stream that is cut into blocks of ``block`` words. Targets in words become
expected draws of blocks. Every slot of the output is labelled with a source by a pseudorandom permutation of all
slots, which gives each output shard a multinomial draw of source counts whose totals over the run hold. The
counts of the shards before it say where a shard goes on in each source: a source's k-th draw maps through
a pseudorandom permutation of its block indexes, epoch by epoch, and blocks are joined by index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewater.llm.shared import WORD, only
from tidewater.session import settle

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK = 32
#: Slots of an output shard.
SHARD = 4_096
#: Shards whose running sums one window task holds.
SHARDS_AT_ONCE = 4_096
#: Documents whose running sums one window task holds.
PER_BUCKET = 20_000
SEED = 20_240_601
#: Steps of cycle walking. Of a domain up to 2^12 fewer elements lie outside than this; of a
#: larger one at most one in 64 does, and so long a walk among them does not occur.
WALK = 64


def word_count(text: str) -> Column:
    """Number of words of a whole text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _feistel(x: Column, a: Column, b: Column, salt: tuple, rounds: int = 4) -> Column:
    """One pass of an unbalanced Feistel network over [0, a*b): halves below a and b take turns."""
    left, right = ((x - x % b) / b).cast("long"), x % b
    for r in range(rounds):
        if r % 2 == 0:
            left = (left + F.pmod(F.xxhash64(F.lit(SEED + r), right, *salt), a)) % a
        else:
            right = (right + F.pmod(F.xxhash64(F.lit(SEED + r), left, *salt), b)) % b
    return left * b + right


def permuted(x: Column, n: Column, *salt: Column) -> Column:
    """Pseudorandom permutation of 0..n-1 by cycle walking, keyed by the salt."""
    a = F.greatest(F.lit(1), F.floor(F.sqrt(n.cast("double")))).cast("long")
    b = F.ceil(n / a).cast("long")
    once = _feistel(x, a, b, salt)
    step = lambda y, _: F.when(y < n, y).otherwise(_feistel(y, a, b, salt))
    return F.when(once < n, once).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once, step))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, have the weights in turn and share the sum of all sizes. None
    takes more than ``cap`` times its size; what it leaves goes to the others by weight. With the
    sources sorted by cap over weight, those with a cap form a prefix, the longest for which
    the share left for each of its members still exceeds its cap.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    t = sizes.withColumn("rank", F.row_number().over(order) - 1)
    t = t.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    t = t.withColumn("most", F.col("source_size") * cap)
    by = W.orderBy(F.col("most") / F.col("weight"), "rank")
    before = by.rowsBetween(W.unboundedPreceding, -1)
    after = by.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    t = t.withColumn("total", F.sum("source_size").over(everything))
    # Share of one weight if all sources before this one are held at their caps.
    t = t.withColumn(
        "share", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(after)
    )
    t = t.withColumn("open", F.col("share") * F.col("weight") <= F.col("most"))
    share = F.min(F.when(F.col("open"), F.struct(F.col("most") / F.col("weight"), "rank", "share"))).over(everything)["share"]
    t = t.withColumn("share", share)
    target = F.least(F.col("most").cast("double"), F.coalesce(F.col("share") * F.col("weight"), F.col("most")))
    return t.select("source", "source_size", target.cast("double").alias("target"))


def packed(docs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Every document's place ``first`` in its source's stream of words; and ``source, source_size``.

    The stream is ordered by bucket, a hash of id and text, and by id within it. Sums run inside
    buckets of a bounded number of rows and then over a source's buckets, so a source with
    a third of all rows is spread over many tasks.
    """
    docs = only(docs, doc_id="long", text="string", source="string").select(
        "doc_id", "source", word_count("text").alias("size"), F.xxhash64("doc_id", "text").alias("mark")
    )
    docs = settle(docs, "sizes")
    buckets = max(1, docs.count() // PER_BUCKET)
    docs = docs.withColumn("bucket", F.pmod(F.xxhash64("mark"), F.lit(buckets)))
    sums = settle(docs.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "buckets")
    ahead = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("offset", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    within = W.partitionBy("source", "bucket").orderBy("doc_id", "mark", "size").rowsBetween(W.unboundedPreceding, -1)
    docs = docs.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    same = docs["source"].eqNullSafe(sums["source"]) & (docs["bucket"] == sums["bucket"])
    placed = docs.join(sums, same).select(
        "doc_id", docs["source"].alias("source"), "size", "mark", (F.col("offset") + F.col("inside")).alias("first")
    )
    return placed, sums.groupBy("source").agg(F.sum("words").alias("source_size"))


def labelled_slots(targets: DataFrame, shard: int = SHARD) -> DataFrame:
    """``shard, slot, source_no, blocks`` of every slot of the output.

    Source by source, the expected number of draws of its blocks is laid out on a line; stratum t
    of the line belongs to the source over its point ``t + 1/2``, and a permutation by the seed deals the strata to slots.
    """
    spark = targets.sparkSession
    slots = int(targets.agg(F.coalesce(F.ceil(F.max("line_end")), F.lit(0))).first()[0])
    cell = 1 << 12
    phase = F.lit(0.5)
    strata = spark.range(slots).select(F.col("id").alias("t"), F.floor(F.col("id") / cell).alias("cell"))
    spans = targets.where("line_end > line_start").select(
        "source_no", "blocks", F.ceil(F.col("line_start") - phase).alias("low"), F.ceil(F.col("line_end") - phase).alias("high")
    ).where("high > low")
    spans = spans.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") / cell), F.floor((F.col("high") - 1) / cell)))
    )
    drawn = strata.join(spans, "cell").where("t >= low and t < high")
    slot = permuted(F.col("t"), F.lit(max(1, slots)).cast("long"), F.lit(-1).cast("long"))
    return drawn.select(F.floor(slot / shard).cast("long").alias("shard"), slot.alias("slot"), "source_no", "blocks")


def shard_counts(labelled: DataFrame) -> DataFrame:
    """``shard, source_no, n, offset``: a shard's draws of each source, and how many the shards before it make.

    Running sums go over groups of shards first and then inside them, so no source's shards are one task.
    """
    counts = settle(labelled.groupBy("shard", "source_no").agg(F.count("*").alias("n")), "counts")
    counts = counts.withColumn("group", F.floor(F.col("shard") / SHARDS_AT_ONCE))
    before = W.partitionBy("source_no").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    groups = counts.groupBy("source_no", "group").agg(F.sum("n").alias("whole"))
    groups = groups.select("source_no", "group", F.coalesce(F.sum("whole").over(before), F.lit(0)).alias("ahead"))
    within = W.partitionBy("source_no", "group").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return counts.join(groups, ["source_no", "group"]).select("shard", "source_no", "n", (F.col("ahead") + F.col("inside")).alias("offset"))


def draws(targets: DataFrame, shard: int = SHARD, cap: int = MAX_REPEATS) -> DataFrame:
    """``shard, slot, source_no, index``: the block that every slot of the output takes."""
    labelled = settle(labelled_slots(targets, shard), "slots")
    in_turn = W.partitionBy("shard", "source_no").orderBy("slot")
    drawn = labelled.withColumn("turn", F.row_number().over(in_turn) - 1).join(shard_counts(labelled), ["shard", "source_no"])
    drawn = drawn.withColumn("k", F.col("offset") + F.col("turn"))
    # An epoch beyond the cap, which rounding can begin by one draw a source, has none: its slot stays empty.
    drawn = drawn.where(F.col("k") < F.col("blocks") * cap)
    index = permuted(F.col("k") % F.col("blocks"), F.col("blocks"), F.col("source_no"), F.floor(F.col("k") / F.col("blocks")))
    return drawn.select("shard", "slot", "source_no", index.alias("index"))


def plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, cap: int = MAX_REPEATS) -> DataFrame:
    """Targets with each source's number, blocks, and span on the line of expected draws."""
    t = source_targets(sizes, weights, cap)
    t = t.withColumn("source_no", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    t = t.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
    # A source's last block may be short, so draws are reckoned by its mean block.
    t = t.withColumn("expected", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0))
    t = t.withColumn("line_end", F.sum("expected").over(W.orderBy("source_no").rowsBetween(W.unboundedPreceding, 0)))
    return t.withColumn("line_start", F.col("line_end") - F.col("expected"))


def _mixed(docs: DataFrame, weights, block: int, shard: int) -> tuple[DataFrame, DataFrame]:
    """Documents with their places and targets, and the blocks that the slots take, in the parts that documents make of them."""
    placed, sizes = packed(docs, block)
    targets = settle(plan(sizes, weights, block), "targets")
    known = targets.select(F.col("source").alias("its"), "source_no", "source_size", "target")
    placed = placed.join(known, F.col("source").eqNullSafe(F.col("its"))).drop("its")
    parts = placed.select("doc_id", "mark", "source", "source_no", "first", "size").where("size > 0").withColumn(
        "index", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block)))
    )
    start, end = F.greatest(F.col("index") * block, F.col("first")), F.least((F.col("index") + 1) * block, F.col("first") + F.col("size"))
    parts = parts.withColumns({"start": start - F.col("first"), "words": end - start, "at": start - F.col("index") * block})
    return placed, parts.drop("size").join(draws(targets, shard), ["source_no", "index"])


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The mix itself: ``shard, slot, source, index, at, doc_id, mark, start, words``.

    Slot by slot the block that it takes, in the parts that documents make of it: ``words`` words of the document from
    its word ``start`` on, from 0, lie at word ``at`` of the block. Cases as in ``mix``.
    """
    return _mixed(docs, weights, block, shard)[1].select("shard", "slot", "source", "index", "at", "doc_id", "mark", "start", "words")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken, mark``.

    ``size`` is the number of words, ``taken`` how many of them the slots of the mix take, repeats counted;
    ``mark`` hashes id and text. All comes from the rows and the seed, so reruns agree.

    Cases: null and empty texts have size 0 and take nothing; a null source is a source of its
    own, sorted last; null ids count like others; rows repeated exactly share their
    places in an order that does not matter for their sums as a group; an empty table gives no rows.
    """
    placed, slots = _mixed(docs, weights, block, shard)
    taken = slots.groupBy("source_no", "first").agg(F.sum("words").alias("taken"))
    # Documents with words are told apart by where they begin in their source's stream.
    key = F.when(F.col("size") > 0, F.col("first"))
    out = placed.withColumn("begin", key).join(taken.withColumnRenamed("first", "begin"), ["source_no", "begin"], "left")
    return out.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "mark"
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The documents of the mix, as often as it takes them, with the columns they came with.

    A document of which ``taken`` words are drawn appears ``taken / size`` times, the fraction
    rounded up or down in turn among documents of like size, so that a source's words keep near
    its target; one without words is kept once.
    Exact repeats of a row are told apart by nothing, so they share out what is taken from them evenly.
    """
    per = mix(docs, weights).select("mark", "source", "taken", "size")
    per = per.groupBy("mark").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"), F.first("source").alias("source"))
    per = settle(per, "taken")
    bucket = F.pmod(F.xxhash64("mark"), F.lit(max(1, per.count() // PER_BUCKET)))
    this = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0.0)
    so_far = F.sum(this).over(W.partitionBy("source", bucket).orderBy("size", "mark"))
    whole = F.floor(F.round(so_far, 6) + 0.5) - F.floor(F.round(so_far - this, 6) + 0.5)
    copies = F.when(F.col("size") == 0, 1).otherwise(whole).cast("int")
    per = per.select(F.col("mark").alias("__mark"), copies.alias("__copies")).where("__copies > 0")
    mark = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # The row travels as one column, so that its columns may have any name.
    joined = docs.select(F.struct("*").alias("__row"), mark.alias("__mark")).join(per, "__mark")
    return joined.select("__row", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("__row.*")
