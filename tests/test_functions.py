"""Missing-value semantics, text, dates and recodes against hand-written values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater import rules
from tidewater.functions import dates, missing, recode, text
from tests.helpers import frame, one, rows


def value(spark, column, **cells):
    """One expression over one row of given cells."""
    kinds = {str: "string", int: "int", float: "double", bool: "boolean", dt.date: "date"}
    base = spark.range(1)
    for name, v in cells.items():
        kind = "string" if v is None else kinds[type(v)]
        base = base.withColumn(name, F.lit(v).cast(kind))
    return base.select(column.alias("v")).first()["v"]


def test_paste_writes_na_for_missing_parts(spark):
    assert value(spark, missing.paste("y", "a", "m", sep="-"), y=2021, a=None, m="July") == "2021-NA-July"
    assert value(spark, missing.paste("a", F.lit("x")), a="b") == "b x"


def test_join_present_needs_every_part(spark):
    assert value(spark, missing.join_present("a", "b"), a="B1", b="7") == "B1-7"
    assert value(spark, missing.join_present("a", "b"), a="B1", b=None) is None


@pytest.mark.parametrize("cell, inside", [("x", True), ("z", False), (None, False)])
def test_membership_is_never_null(spark, cell, inside):
    assert value(spark, missing.is_in("a", ["x", "y"]), a=cell) is inside
    assert value(spark, missing.not_in("a", ["x", "y"]), a=cell) is (not inside)


def test_pattern_tests_are_false_for_missing(spark):
    assert value(spark, missing.matches("a", "1$|2$"), a="31") is True
    assert value(spark, missing.matches("a", "1$|2$"), a=None) is False
    assert value(spark, ~missing.has_text("a", "TOTAL"), a=None) is True


def test_if_else_is_null_for_a_missing_test(spark):
    choice = missing.if_else(F.col("a") == "x", F.lit("yes"), F.lit("no"))
    assert [value(spark, choice, a=v) for v in ("x", "y", None)] == ["yes", "no", None]


def test_sums_with_missing_values(spark):
    df = frame(spark, "g string, n double", ("a", 1.0), ("a", None), ("b", None), ("c", 2.0), ("c", 3.0))
    out = df.groupBy("g").agg(missing.sum_or_zero("n").alias("z"), missing.sum_or_null("n").alias("s"))
    assert rows(out) == [("a", 1.0, None), ("b", 0.0, None), ("c", 5.0, 5.0)]


@pytest.mark.parametrize("x, rounded", [(0.5, 0.0), (1.5, 2.0), (2.5, 2.0), (412.5, 412.0), (-0.5, 0.0), (2.51, 3.0)])
def test_rounding_is_half_even(spark, x, rounded):
    assert value(spark, missing.round_half_even("a"), a=x) == rounded


def test_text_that_is_no_number_is_null(spark):
    assert value(spark, missing.number("a"), a="12.5") == 12.5
    assert value(spark, missing.number("a"), a="n/a") is None


@pytest.mark.parametrize(
    "raw, titled",
    [
        ("SAN-JUAN", "San-Juan"),
        ("CONUMA RIVER (UPPER)", "Conuma River (Upper)"),
        ("o'brien creek", "O'brien Creek"),
        ("bURMAN_r", "Burman_r"),
        (None, None),
    ],
)
def test_title_case_restarts_words(spark, raw, titled):
    assert value(spark, text.title_case("a"), a=raw) == titled


@pytest.mark.parametrize(
    "name, snake",
    [("Scale.Gilbert.Age", "scale_gilbert_age"), ("Otolith Box #", "otolith_box"), ("SampleYear", "sample_year"),
     ("(R) SCALE BOOK-CELL CONCAT", "r_scale_book_cell_concat"), ("Total.Age..yrs.", "total_age_yrs")],
)
def test_snake_names(name, snake):
    assert text.snake_name(name) == snake


def test_stat_week_equals_the_week_of_year_formula(spark):
    first = dt.date(2015, 1, 1)
    days = spark.range(3653).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("d"))
    for d, week in days.select("d", dates.stat_week("d")).collect():
        start = d.replace(day=1)
        assert week == f"{d.month}{int(d.strftime('%U')) - int(start.strftime('%U')) + 1}", d


def test_stat_week_examples(spark):
    assert value(spark, dates.stat_week("d"), d=dt.date(2021, 8, 17)) == "83"
    assert spark.range(1).select(dates.stat_week(F.lit(None).cast("date"))).first()[0] == "NANA"


def test_months(spark):
    assert value(spark, dates.month_name("d"), d=dt.date(2021, 9, 3)) == "September"
    assert value(spark, dates.month_label("a"), a="Sept") is None
    assert [value(spark, dates.month_rank("a", rules.SEASON_MONTHS), a=m) for m in ("May", "October", "January")] == [1, 6, None]
    assert value(spark, dates.month_in_text("a"), a="A25_07(Jul)") == "July"
    assert value(spark, dates.month_in_text("a"), a="A25_10") is None


def test_recodes(spark):
    assert [value(spark, recode.genetic_region("a"), a=v) for v in ("NoKy", "SWVI", "NPS", "Fraser", None)] == [
        "NWVI", "SWVI", "Puget Sound", None, None]
    assert [value(spark, recode.total_age("a"), a=v) for v in ("21", "1M", "61", "99")] == ["2", "2", "6", None]
    assert [value(spark, recode.pfma_number("a"), a=v) for v in ("PFMA 25", "PFMA 121", "US7 North")] == [25, 121, None]
    area = recode.area_label("a", rules.CONUMA_SPORT_AREAS, "sport")
    assert [value(spark, area, a=v) for v in ("25D", "25PO", "25ZZ", None)] == [
        "sport Tlupana", "sport Outer Nootka/corridor", None, None]
    gear = recode.gear_from_text("a", rules.SAMPLE_GEARS)
    assert [value(spark, gear, a=v) for v in ("GILL NET", "SEINE set", "Sport")] == ["Gillnet", "Seine", None]


def test_size_bins_at_their_bounds(spark):
    caught = recode.size_bin("a", rules.CATCH_SIZE_STEPS, rules.CATCH_SIZE_TOP)
    assert [value(spark, caught, a=n) for n in (499, 500, 999, 1000, 1499, 1500)] == [4, 7, 7, 10, 10, 14]
    sampled = recode.size_bin("a", rules.SAMPLE_SIZE_STEPS, rules.SAMPLE_SIZE_TOP)
    assert [value(spark, sampled, a=n) for n in (9, 10, 49, 50, 74, 75, 99, 100)] == [3, 6, 6, 8, 8, 10, 10, 12]
