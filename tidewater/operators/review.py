"""Tables behind the review maps and plots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from tidewater import rules
from tidewater.functions.dates import month_label, month_rank
from tidewater.functions.missing import first_match, sum_or_zero
from tidewater.functions.recode import size_bin


def catch_points(catch: DataFrame, year: int, column: str = "kept") -> DataFrame:
    """Catch of one year by sector, area and position, with the plotted size."""
    return (
        catch.filter((F.col("year") == year) & F.col("run_recon_area").isNotNull())
        .groupBy("sector", "run_recon_area", "lat", "long", "label")
        .agg(sum_or_zero(column).alias(column))
        .filter(F.col(column) > 0)
        .withColumn("radius", size_bin(column, rules.CATCH_SIZE_STEPS, rules.CATCH_SIZE_TOP))
    )


def sample_points(bio: DataFrame, year: int, years_before: int | Iterable[int] = 0) -> DataFrame:
    """Located samples of one year, or of several counted back, by area and position, one row per label, with the plotted size.

    Every label row shows the count of its whole position. Labels are counted
    first, so the window only sees the few labels of a position.
    """
    back = [years_before] if isinstance(years_before, int) else years_before
    years = [year - n for n in back]
    place = ["year", "sector", "run_recon_area", "creel_sub_area", "lat", "long"]
    labels = (
        bio.filter(F.col("lat").isNotNull() & F.col("year").isin(*years))
        .groupBy(*place, "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return labels.withColumn("n", F.sum("n").over(Window.partitionBy(*place))).withColumn(
        "radius", size_bin("n", rules.SAMPLE_SIZE_STEPS, rules.SAMPLE_SIZE_TOP)
    )


def temporal_catch(catch: DataFrame, year: int, column: str = "kept") -> DataFrame:
    """Positive catch of one year by sector, area and month."""
    return (
        catch.filter(F.col("run_recon_area").isNotNull() & (F.col("year") == year) & (F.col(column) > 0))
        .withColumn("month", month_label("month", rules.SEASON_MONTHS))
        .groupBy("year", "sector", "run_recon_area", "month")
        .agg(F.sum(column).alias(column))
    )


def temporal_samples(bio: DataFrame, min_n: int = rules.MIN_SAMPLES) -> DataFrame:
    """Samples by year, sector, area and month; exactly ``min_n`` is in neither class."""
    n = F.col("n")
    return (
        bio.filter(F.col("run_recon_area").isNotNull())
        .groupBy("year", "sector", "run_recon_area", "month")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(
            "sample_class",
            first_match([(n > min_n, F.lit(f">{min_n}")), (n < min_n, F.lit(f"<{min_n}"))]),
        )
    )


def ufid_table(
    catch: DataFrame, year: int, column: str = "kept", *, keep_zero: bool = False, by_month: bool = False
) -> DataFrame:
    """Total by fishery of one year.

    ``by_month`` gives one row per month of a fishery, sorted by sector and
    calendar month, each with the fishery's total.
    """
    keys = ["sector", "run_recon_area", "ufid"]
    rows = catch.filter(F.col("run_recon_area").isNotNull() & (F.col("year") == year))
    if not by_month:
        totals = rows.groupBy(*keys).agg(sum_or_zero(column).alias("total_kept"))
        return totals if keep_zero else totals.filter(F.col("total_kept") > 0)
    months = rows.groupBy(*keys, month_label("month", rules.SEASON_MONTHS).alias("month")).agg(
        sum_or_zero(column).alias("total_kept")
    )
    totals = months.withColumn("total_kept", F.sum("total_kept").over(Window.partitionBy(*keys)))
    if not keep_zero:
        totals = totals.filter(F.col("total_kept") > 0)
    rank = month_rank("month", rules.SEASON_MONTHS)
    return totals.orderBy(F.col("sector").asc_nulls_last(), rank.asc_nulls_last()).drop("month")
