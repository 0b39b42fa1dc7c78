"""Null-matching joins, full joins, salting and skew splitting."""

import itertools

import pytest
from pyspark.sql import functions as F

from tidewater.operators import joins
from tests.helpers import frame, rows

LEFT = [("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5), ("c", 6)]
RIGHT = [("a", 10), (None, 20), (None, 30), ("d", 40), ("a", 50)]


@pytest.fixture
def sides(spark):
    return frame(spark, "k string, x int", *LEFT), frame(spark, "k string, y int", *RIGHT)


def expected(how, na_matches):
    """Nested-loop reference result."""
    def match(a, b):
        return a == b if a is not None or b is not None else na_matches == "na"

    pairs = [(k, x, y) for (k, x), (j, y) in itertools.product(LEFT, RIGHT) if match(k, j)]
    if how == "inner":
        return pairs
    lone = [(k, x, None) for k, x in LEFT if not any(match(k, j) for j, _ in RIGHT)]
    if how == "left":
        return pairs + lone
    return pairs + lone + [(j, None, y) for j, y in RIGHT if not any(match(k, j) for k, _ in LEFT)]


def ordered(found):
    return sorted(found, key=lambda t: [(v is not None, str(v)) for v in t])


@pytest.mark.parametrize("na_matches", ["na", "never"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_left_and_inner_joins(sides, how, na_matches):
    out = joins.join_on(*sides, ["k"], how, na_matches=na_matches)
    assert out.columns == ["k", "x", "y"]
    assert rows(out) == ordered(expected(how, na_matches))


@pytest.mark.parametrize("na_matches", ["na", "never"])
@pytest.mark.parametrize("hot", [None, "left", "right"])
def test_full_join_whichever_side_is_hot(sides, hot, na_matches):
    out = joins.join_on(*sides, ["k"], "full", na_matches=na_matches, hot=hot)
    assert out.columns == ["k", "x", "y"]
    assert rows(out) == ordered(expected("full", na_matches))


def test_natural_join_uses_all_shared_names(spark):
    left = frame(spark, "s string, k string, x int", ("u", "a", 1), ("u", None, 2))
    right = frame(spark, "k string, s string, y int", ("a", "u", 7), (None, "u", 8), ("a", "v", 9))
    assert rows(joins.natural_join(left, right)) == [("u", None, 2, 8), ("u", "a", 1, 7)]


def test_joins_refuse_frames_without_keys(spark):
    a, b = frame(spark, "x int", (1,)), frame(spark, "y int", (1,))
    with pytest.raises(ValueError):
        joins.natural_join(a, b)
    with pytest.raises(ValueError):
        joins.join_on(a, b, [])


def test_clashing_columns_get_suffixes(spark):
    a, b = frame(spark, "k int, v string", (1, "l")), frame(spark, "k int, v string", (1, "r"))
    out = joins.join_on(a, b, ["k"], "full")
    assert out.columns == ["k", "v_x", "v_y"] and rows(out) == [(1, "l", "r")]


def test_semi_and_anti_rows_match_missing_values(spark, sides):
    left, right = sides
    assert rows(joins.rows_in(left, right, "k"), "x") == [(1,), (2,), (4,), (5,)]
    assert rows(joins.rows_not_in(left, right.filter("k is not null"), "k"), "x") == [(3,), (4,), (5,), (6,)]


def test_lookup_can_be_required_to_be_unique(spark):
    good = frame(spark, "k string, v int", ("a", 1), (None, 2))
    assert rows(joins.require_unique(good, ["k"])) == [(None, 2), ("a", 1)]
    with pytest.raises(Exception, match="not unique"):
        joins.require_unique(frame(spark, "k string, v int", ("a", 1), ("a", 2)), ["k"]).collect()


@pytest.fixture
def shuffled(spark):
    """Joins forced to shuffle, with skew thresholds that small data can reach."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_split(shuffled):
    ids = shuffled.range(0, 60_000, 1, 8)
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    big = ids.select(key.alias("k"), F.col("id").alias("x"), F.md5(F.col("id").cast("string")).alias("pad"))
    small = shuffled.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("y")).union(
        shuffled.createDataFrame([("hot", -1)], "k string, y long"))
    out = joins.join_on(big, small, ["k"])
    assert out.filter("y = -1").count() == 20_000
    collected = out.collect()
    assert len(collected) == 60_000
    assert "skew=true" in _plan(out)


def test_missing_keys_are_split_by_adaptive_execution(shuffled):
    """Two thirds of the rows lack the key and all of them meet the one right row without one."""
    ids = shuffled.range(0, 60_000, 1, 8)
    big = ids.select(
        F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), F.col("id").alias("x"), F.md5(F.col("id").cast("string")).alias("pad")
    )
    small = shuffled.range(3_000).select((F.col("id") * 3).alias("k"), F.lit(2).alias("y")).union(
        shuffled.createDataFrame([(None, 1)], "k long, y int"))
    out = joins.join_on(big, small, ["k"])
    collected = out.collect()
    assert len(collected) == 60_000
    assert sum(r.y == 1 for r in collected) == 40_000 and sum(r.y == 2 for r in collected) == 3_000
    assert "skew=true" in _plan(out)


def test_a_full_join_with_a_key_hot_on_both_sides_is_dealt_to_many_tasks(shuffled):
    """One key holds a third of both sides: its pairs go to as many tasks as there are pairs of stripes."""
    n = 3_000
    key = lambda c: F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit(c), F.col("id").cast("string")))
    left = shuffled.range(0, n, 1, 8).select(key("k").alias("k"), F.col("id").alias("x"))
    # The keys of the rest meet for some, and are missing on one side for others.
    right = shuffled.range(n // 2, n + n // 2, 1, 8).select(key("k").alias("k"), F.col("id").alias("y"))
    got = joins.join_on(left, right, ["k"], "full", hot="both")
    want = joins.join_on(left, right, ["k"], "full")
    by_task = got.groupBy(F.spark_partition_id().alias("p"), (F.col("k") == "hot").alias("hot")).count().collect()
    hot = [r["count"] for r in by_task if r.hot]
    assert sum(hot) == (n // 3) ** 2 and max(hot) <= sum(hot) / 4
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("k", "x", "y").cast("decimal(38,0)"))).first()
    assert got.columns == want.columns and digest(got) == digest(want)


@pytest.mark.parametrize("na_matches", ["na", "never"])
def test_hot_full_join_equals_the_plain_one(spark, na_matches):
    a = spark.createDataFrame([(None, 1, "a"), (None, 2, "a"), ("h", 3, "b"), ("h", 4, "b"), ("h", 4, "b"), ("only", 5, "c"), ("x", 6, None)], "k string, j int, v string")
    b = spark.createDataFrame([(None, 1, 7), ("h", 4, 8), ("h", 4, 9), ("x", 6, 1), ("other", 5, 2), (None, 2, 3)], "k string, j int, v int")
    for left, right in ((a, b), (b, a), (a, b.limit(0)), (a.limit(0), b)):
        want = joins.join_on(left, right, ["k"], "full", na_matches=na_matches)
        got = joins.join_on(left, right, ["k"], "full", na_matches=na_matches, hot="both")
        assert got.columns == want.columns and rows(got) == rows(want)
        want = joins.join_on(left, right, ["k", "j"], "full", na_matches=na_matches)
        assert rows(joins.join_on(left, right, ["k", "j"], "full", na_matches=na_matches, hot="both")) == rows(want)


def test_hot_keys_are_those_of_a_share_and_on_both_sides(spark):
    a = spark.createDataFrame([("h",)] * 50 + [("l",)] * 50 + [(f"k{i}",) for i in range(100)], "k string")
    b = spark.createDataFrame([("h",), ("k1",)], "k string")
    assert rows(joins.hot_keys(a, b, ["k"], share=0.2)) == [("h",), ("k1",)]  # half of the right side each
    wide = b.union(spark.createDataFrame([(f"r{i}",) for i in range(100)], "k string"))
    assert rows(joins.hot_keys(a, wide, ["k"], share=0.2)) == [("h",)]


@pytest.mark.parametrize("na_matches", ["na", "never"])
def test_factored_counts_equal_those_of_the_expanded_join(spark, na_matches):
    a = spark.createDataFrame([(None, "x", 1), (None, "x", 2), (None, "y", 1), ("k", "x", 1), ("k", None, 1), ("z", "y", 3)], "k string, s string, v int")
    b = spark.createDataFrame([(None, 7, 1), (None, 7, 2), (None, 8, 3), ("k", 7, 4), ("k", None, 5), ("q", 9, 6)], "k string, w int, v int")
    f = joins.factored_join(a, b, ["k"], na_matches=na_matches)
    whole = f.expand()
    assert whole.columns == ["k", "s", "v_x", "w", "v_y"]
    for left_by, right_by in (((), ()), (["s"], ()), ((), ["w"]), (["s", "v_x"], ["w", "v_y"]), (["k", "s"], ["w"])):
        want = whole.groupBy(*left_by, *right_by).agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("n"))
        assert rows(f.counts(left_by, right_by)) == rows(want)
    assert joins.factored_join(a, b.limit(0), ["k"], na_matches=na_matches).counts(["s"]).count() == 3
    assert f.largest().first().n == (9 if na_matches == "na" else 4)


def test_factored_counts_do_not_multiply_rows(spark):
    """A hundred thousand rows without a key on both sides are 10^10 joined rows, and two rows here."""
    side = lambda n, c: spark.range(n).select(F.lit(None).cast("string").alias("k"), (F.col("id") % 3).alias(c))
    f = joins.factored_join(side(100_000, "a"), side(100_000, "b"), ["k"])
    assert [int(r.n) for r in f.counts().collect()] == [10**10]
    assert sum(int(r.n) for r in f.counts(["a"], ["b"]).collect()) == 10**10
