"""Which fisheries have too few age or stock samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewater import rules
from tidewater.functions.missing import sum_or_zero
from tidewater.operators.joins import rows_in
from tidewater.operators.reshape import display_names


def sample_sufficiency(
    catch: DataFrame, bio: DataFrame, year: int, *, catch_column: str = "kept", min_n: int = rules.MIN_SAMPLES
) -> DataFrame:
    """Catch per fishery of one year with its numbers of age and stock samples.

    Age samples count for their own sector, stock samples for every sector of
    the area and id. Catch and samples meet in one aggregation instead of two
    joins: both are summed per fishery before the shuffle, and each is read once.
    """
    fishery = ["sector", "run_recon_area", "ufid"]
    in_area = F.col("run_recon_area").isNotNull()
    caught = catch.filter(in_area & (F.col("year") == year)).select(
        *fishery, F.col(catch_column).cast("double").alias("kept"), F.lit(0).alias("age"), F.lit(0).alias("stock")
    )
    sampled = bio.filter(in_area).select(
        *fishery,
        F.lit(None).cast("double").alias("kept"),
        F.col("resolved_age").isNotNull().cast("int").alias("age"),
        F.col("resolved_stock_origin").isNotNull().cast("int").alias("stock"),
    )
    per_fishery = (
        caught.unionByName(sampled)
        .groupBy(*fishery)
        .agg(
            sum_or_zero("kept").alias("total_kept"),
            F.nullif(F.sum("age"), F.lit(0)).alias("n_age_samples"),
            F.sum("stock").alias("stocks"),
        )
    )
    stocks = F.sum("stocks").over(Window.partitionBy("run_recon_area", "ufid"))
    counted = per_fishery.withColumn("n_stockcomp_samples", F.nullif(stocks, F.lit(0))).drop("stocks")

    return _flagged(counted, min_n)


def _flagged(counted: DataFrame, min_n: int) -> DataFrame:
    def flag(n: str) -> Column:
        return F.when(F.col(n).isNull() | (F.col(n) < min_n), "FLAG")

    return counted.filter(F.col("total_kept") > 0).withColumns(
        {
            "age_samplesize_flag": flag("n_age_samples"),
            "stockcomp_samplesize_flag": flag("n_stockcomp_samples"),
        }
    )


#: A fishery's keys, and what is counted of its samples.
FISHERY, COUNTS = ("sector", "run_recon_area", "ufid", "year"), ("n", "age", "stock")


def fishery_counts(bio: DataFrame) -> DataFrame:
    """Samples of every fishery and year: all, those with an age, and those with a stock.

    A small table whatever the number of samples, from which sufficiency and missed samples follow without
    the samples; ``add_counts`` brings it up to date with a new extract's.
    """
    return bio.groupBy(*FISHERY).agg(
        F.count(F.lit(1)).alias("n"), F.count("resolved_age").alias("age"), F.count("resolved_stock_origin").alias("stock")
    )


def add_counts(counts: DataFrame, *more: DataFrame) -> DataFrame:
    """Counts of several extracts together; the order and grouping of the extracts do not matter."""
    for other in more:
        counts = counts.unionByName(other)
    return counts.groupBy(*FISHERY).agg(*[F.sum(c).alias(c) for c in COUNTS])


def sufficiency_of_counts(
    catch: DataFrame, counts: DataFrame, year: int, *, catch_column: str = "kept", min_n: int = rules.MIN_SAMPLES
) -> DataFrame:
    """``sample_sufficiency`` from the samples' counts."""
    fishery = ["sector", "run_recon_area", "ufid"]
    in_area = F.col("run_recon_area").isNotNull()
    none = F.lit(0).cast("long")
    caught = catch.filter(in_area & (F.col("year") == year)).select(
        *fishery, F.col(catch_column).cast("double").alias("kept"), none.alias("age"), none.alias("stock")
    )
    sampled = counts.filter(in_area).select(*fishery, F.lit(None).cast("double").alias("kept"), "age", "stock")
    per_fishery = (
        caught.unionByName(sampled)
        .groupBy(*fishery)
        .agg(
            sum_or_zero("kept").alias("total_kept"),
            F.nullif(F.sum("age"), F.lit(0)).alias("n_age_samples"),
            F.sum("stock").alias("stocks"),
        )
    )
    stocks = F.sum("stocks").over(Window.partitionBy("run_recon_area", "ufid"))
    counted = per_fishery.withColumn("n_stockcomp_samples", F.nullif(stocks, F.lit(0))).drop("stocks")
    return _flagged(counted, min_n)


def missed_of_counts(counts: DataFrame, orphans: DataFrame, year: int) -> DataFrame:
    """``missed_samples`` from the samples' counts."""
    empty = orphans.filter(F.col("n_age_samples").isNull() | F.col("n_stockcomp_samples").isNull())
    same_year = counts.filter(F.col("year") == year).groupBy("run_recon_area", "ufid").agg(F.sum("n").alias("n"))
    return rows_in(same_year, empty, "run_recon_area")


def orphan_ufids(sufficiency: DataFrame) -> DataFrame:
    """Fisheries with either flag set."""
    return sufficiency.filter(
        (F.col("age_samplesize_flag") == "FLAG") | (F.col("stockcomp_samplesize_flag") == "FLAG")
    )


def orphan_candidates(bio: DataFrame, orphans: DataFrame) -> DataFrame:
    """All samples, of any year, from areas with an orphan fishery."""
    return rows_in(bio, orphans, "run_recon_area")


def missed_samples(bio: DataFrame, orphans: DataFrame, year: int) -> DataFrame:
    """Same-year samples by fishery in areas where an orphan found no samples at all."""
    empty = orphans.filter(F.col("n_age_samples").isNull() | F.col("n_stockcomp_samples").isNull())
    # Counting first leaves one row per fishery to be matched with the areas.
    counts = (
        bio.filter(F.col("year") == year).groupBy("run_recon_area", "ufid").agg(F.count(F.lit(1)).alias("n"))
    )
    return rows_in(counts, empty, "run_recon_area")


def orphan_table(orphans: DataFrame) -> DataFrame:
    """Orphan fisheries with missing counts shown as zero."""
    return orphans.fillna(0)


def orphan_display(orphans: DataFrame, year: int) -> DataFrame:
    """The orphan table under its display names."""
    return display_names(orphan_table(orphans), rules.orphan_display(year))


def sectors(caught: DataFrame) -> DataFrame:
    """The sectors that occur."""
    return caught.select("sector").distinct()
