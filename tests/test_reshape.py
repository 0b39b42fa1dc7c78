"""Reshaping, repetition, unions and column selection."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import reshape
from tests.helpers import frame, rows


def test_spread_sums_repeated_cells_and_keeps_missing_ids(spark):
    df = frame(
        spark, "area string, d string, n double",
        ("a", "Kept", 1.0), ("a", "Kept", 2.0), ("a", "Released Legal", 4.0), (None, "Kept", None), ("b", "Kept", None),
    )
    out = reshape.spread_sum(df, "d", "n", ["Kept", "Released Legal"])
    assert out.columns == ["area", "kept", "released_legal"]
    assert rows(out) == [(None, None, None), ("a", 3.0, 4.0), ("b", None, None)]


def test_spread_shuffles_once(spark):
    df = frame(spark, "area string, d string, n double", ("a", "Kept", 1.0))
    plan = reshape.spread_sum(df, "d", "n", ["Kept"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_gather_keeps_or_drops_missing(spark):
    df = frame(spark, "id int, `a(1)` int, b int", (1, 5, None))
    assert rows(reshape.gather(df, ["a(1)", "b"], "name", "n")) == [(1, "a(1)", 5), (1, "b", None)]
    assert rows(reshape.gather(df, ["a(1)", "b"], "name", "n", drop_null=True)) == [(1, "a(1)", 5)]


def test_blocks_are_labelled_by_their_first_header(spark):
    one = frame(spark, "`Source A` string, `PFMA 24` double, `PFMA 25` double", ("Aug", 1.0, 2.0))
    two = frame(spark, "`Source B` string, `PFMA 25` double", ("Sept", 3.0))
    out = reshape.stack_blocks([one, two], "source", "month", "pfma", "kept")
    assert rows(out) == [
        ("Source A", "Aug", "PFMA 24", 1.0), ("Source A", "Aug", "PFMA 25", 2.0), ("Source B", "Sept", "PFMA 25", 3.0)]


@pytest.mark.parametrize("n, copies", [(None, 0), (0, 0), (1, 1), (999, 999), (1000, 1000), (1001, 1001), (2500, 2500)])
def test_rows_repeat_by_count(spark, n, copies):
    df = frame(spark, "stock string, n int", ("x", n))
    out = reshape.repeat_rows(df, "n")
    assert out.columns == ["stock"] and out.count() == copies


def test_union_fills_columns_a_part_lacks(spark):
    a, b = frame(spark, "x int, y int", (1, 2)), frame(spark, "y int, z int", (3, 4))
    assert rows(reshape.stack_frames([a, b])) == [(None, 3, 4), (1, 2, None)]


def test_literal_rows_are_appended(spark):
    df = frame(spark, "x string, y int", ("a", 1))
    assert rows(reshape.add_rows(df, [{"x": "b", "y": 2}, {"x": "c"}])) == [("a", 1), ("b", 2), ("c", None)]


def test_column_ranges(spark):
    df = frame(spark, "a int, b int, c int, d int", (1, 2, 3, 4))
    assert reshape.drop_range(df, "b", "c").columns == ["a", "d"]
    assert reshape.select_blocks(df, [("a", "a"), ("c", "d")]).columns == ["a", "c", "d"]


def test_renames_by_pattern_and_token(spark):
    df = frame(spark, "`repunit.1` string, collection string, `collection.1` string, `prob.1` double", ("a", "b", "c", 1.0))
    out = reshape.rename_by_pattern(df, {"repunit.": "REGION_", "collection.": "DNA_STOCK_", "prob.": "PROB_"})
    assert out.columns == ["REGION_1", "collection", "DNA_STOCK_1", "PROB_1"]
    assert reshape.add_name_suffix(out, "region_", "_ROLLUP").columns[0] == "REGION_1_ROLLUP"
    upper = reshape.map_columns(df, "REPUNIT", F.upper)
    assert rows(upper) == [("A", "b", "c", 1.0)]


def test_casts_give_null_for_what_does_not_convert(spark):
    df = frame(spark, "a string, b string", ("1", "x"), ("y", "2.5"))
    assert rows(reshape.cast_columns(df, {"a": "int", "b": "double"})) == [(None, 2.5), (1, None)]


def test_spread_loses_no_value_under_an_undeclared_name(spark):
    df = frame(spark, "area int, d string, n double", (1, "Kept", 2.0), (1, "Odd", 3.0), (1, None, 4.0), (2, "Odd", 5.0))
    assert rows(reshape.spread_sum(df, "d", "n", ["Kept"], other="rest")) == [(1, 2.0, 7.0), (2, None, 5.0)]
    with pytest.raises(Exception, match="undeclared d"):
        reshape.spread_sum(df, "d", "n", ["Kept"]).collect()


def test_spread_occurring_finds_the_names_itself(spark):
    df = frame(spark, "id int, d string, n double", (1, "Kept", 2.0), (1, "Found Dead", 7.0), (1, "Kept", 1.0), (2, None, 5.0), (3, "Kept", None))
    out = reshape.spread_occurring(df, "d", "n")
    assert out.columns == ["id", "found_dead", "kept", "na"]
    assert rows(out) == [(1, 7.0, 3.0, None), (2, None, None, 5.0), (3, None, None, None)]
    assert reshape.spread_occurring(df.filter("d is not null"), "d", "n").columns == ["id", "found_dead", "kept"]
    assert reshape.spread_occurring(df.limit(0), "d", "n").columns == ["id"]
    with pytest.raises(ValueError, match="more than 1 "):
        reshape.spread_occurring(df, "d", "n", most=1)
    with pytest.raises(ValueError, match="one column"):
        reshape.spread_occurring(frame(spark, "id int, d string, n int", (1, "a b", 1), (1, "a-b", 2)), "d", "n")
