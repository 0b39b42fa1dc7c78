"""Stock-group coding of sampled fish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewater import rules
from tidewater.functions.missing import first_match, is_in, not_in, number, paste
from tidewater.functions.recode import recode
from tidewater.functions.text import title_case
from tidewater.operators.joins import natural_join
from tidewater.operators.reshape import add_rows


def stream_areas(df: DataFrame, *, dedupe: bool = False) -> DataFrame:
    """Stream names, as samples spell them, with their management area.

    Sub-areas of one stream (23A, 23B) give one row each, as in the published
    coding, so that stream's fish are repeated; ``dedupe`` keeps one.
    """
    name, area = F.col("resolved_stock_origin"), F.col("area_origin")
    streams = (
        df.select("waterbody_name", "area")
        .distinct()
        .select(
            title_case("waterbody_name").alias("resolved_stock_origin"),
            number(number(F.regexp_replace("area", "[A-z]+", "")), "int").alias("area_origin"),
        )
        .filter((name != "Salmon River") & (area != 29))
        .withColumn("resolved_stock_origin", F.coalesce(recode(name, rules.STREAM_RENAMES), name))
        .withColumn("resolved_stock_origin", F.replace(name, F.lit("Toquart"), F.lit("Toquaht")))
    )
    extra = [{"resolved_stock_origin": n, "area_origin": a} for n, a in rules.EXTRA_STREAMS]
    streams = add_rows(streams, extra)
    return streams.distinct() if dedupe else streams


def hatchery_natural() -> Column:
    """Hatchery, Natural or Unknown origin of a fish."""
    return F.coalesce(
        first_match(
            [
                (F.col("hatchery_origin") == "Y", F.lit("Hatchery")),
                ((F.col("adipose_fin_clipped") == "N") & (F.col("thermalmark") == "Not Marked"), F.lit("Natural")),
            ]
        ),
        F.lit("Unknown"),
    )


def stock_rollup() -> Column:
    """Stock name in capitals without river or creek; outside stocks share one group."""
    origin = F.col("resolved_stock_origin")
    return first_match(
        [
            (origin.isNull(), F.lit("Unknown")),
            (not_in("resolved_stock_rollup", rules.WCVI_ROLLUPS), F.lit("NON-WCVI")),
            (origin == "Tofino Hatchery", F.lit("BEDWELL")),
            (F.lit(True), F.upper(F.regexp_replace(origin, rules.NAME_SUFFIX, ""))),
        ]
    )


def term_group(focal: Sequence[str]) -> Column:
    """Stock group for one terminal area: focal stocks by name, others by area."""
    group, area, origin = F.col("stock_group"), F.col("area_origin"), F.col("resolved_stock_origin")
    by_name = origin.isNull() | (group == "NON-WCVI") | is_in(group, focal)
    return first_match(
        [
            (by_name, F.col("term_sum")),
            (area == 25, paste("hat_nat", F.lit("Other Area 25"))),
            (area == 23, paste("hat_nat", F.lit("Other Area 23"))),
            (F.lit(True), paste("hat_nat", F.lit("Other WCVI"))),
        ]
    )


def agree(a: str, b: str) -> Column:
    """The text TRUE where two groupings agree, else null."""
    return F.when(F.col(a) == F.col(b), "TRUE")


def code_stock_groups(
    bio: DataFrame, streams: DataFrame, focal: Mapping[str, Sequence[str]] = rules.FOCAL_STOCKS
) -> DataFrame:
    """Samples with origin, roll-up, the three area groupings and their agreement flags."""
    return (
        natural_join(bio, streams)
        .withColumns({"hat_nat": hatchery_natural(), "stock_group": stock_rollup()})
        .withColumn("term_sum", paste("hat_nat", "stock_group"))
        .withColumns({name: term_group(stocks) for name, stocks in focal.items()})
        .withColumns(
            {
                "qc_term_con_nit": agree("term_con", "term_nit"),
                "qc_term_con_23": agree("term_con", "term_area23"),
                "qc_term_nit_23": agree("term_nit", "term_area23"),
            }
        )
    )
