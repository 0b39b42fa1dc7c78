"""Biological samples: standardise, compile, and ages of broodstock."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidewater import rules
from tidewater.functions.dates import month_in_text, stat_week
from tidewater.functions.missing import (
    first_match, has_text, if_else, is_in, number, paste,
)
from tidewater.functions.recode import area_label, gear_from_text, genetic_region, total_age
from tidewater.functions.text import title_case
from tidewater.operators.catch import compile_catch, georeference, georeference_sectors, ufid
from tidewater.operators.reshape import (
    add_name_suffix, drop_range, gather, map_columns, rename_by_pattern, repeat_rows,
    stack_frames,
)

# Columns of the raw sample extract that the compiled samples do not carry.
UNUSED = (
    "species", "otolith_box", "otolith_specimen", "thermalmark", "oto_stock", "scale_book", "scale_no",
    "part_age_code", "cwt_head_label", "dna_container_type", "specimen_reference_dna_no",
)


def biosamples(df: DataFrame, areas: Mapping[str, Sequence[str]], sub_areas: Sequence[str], *, river: str) -> DataFrame:
    """Sampled fish with result class, gear, sector, area and fishery id.

    ``river`` is ``conuma`` or ``nitinat``; the former also names commercial and
    escapement areas and leaves out Area 26.
    """
    if river not in ("conuma", "nitinat"):
        raise ValueError(f"river must be 'conuma' or 'nitinat', not {river!r}")
    aged, typed = F.col("resolved_age").isNotNull(), F.col("resolved_stock_origin").isNotNull()
    kind, landing, old_area = F.col("sample_type"), F.col("landing_site"), F.col("run_recon_area")
    sport, escapement = kind == "Sport", kind == "Escapement"
    fleet = has_text(kind, "GILL NET") | has_text(kind, "TROLL")
    gear = gear_from_text(kind, rules.SAMPLE_GEARS)

    area_choices = [(sport, area_label("subarea", areas, "sport"))]
    if river == "conuma":
        inlet = if_else(old_area == "Tlupana Inlet", F.lit("Tlupana"), old_area)
        area_choices += [
            (fleet, paste(F.lit("commercial"), gear, inlet)),
            (escapement & (landing != "Conuma R"), paste(F.lit("escapement Misc"), landing)),
            (escapement & (landing == "Conuma R"), F.lit("escapement Conuma R")),
        ]
        df = df.filter(~has_text("subarea", "Area 26"))

    derived = {
        "input_data_type": first_match(
            [
                (aged & ~typed, F.lit("age")),
                (~aged & typed, F.lit("stock comp")),
                (aged & typed, F.lit("age and stock comp")),
            ]
        ),
        "gear": gear,
        "sector": first_match(
            [(sport, F.lit("sport")), (fleet, F.lit("commercial")), (escapement, F.lit("escapement"))]
        ),
        "creel_sub_area": F.when(sport & is_in("subarea", sub_areas), F.col("subarea")),
        "statweek": F.when(fleet, stat_week("collection_date")),
        "run_recon_area": first_match(area_choices),
        "pfma": number("area", "int"),
        "dna_stock_1": F.col("dna_results_stock_1"),
    }
    kept = [c for c in df.columns if c not in {*derived, *UNUSED, "area", "dna_results_stock_1"}]
    # The week is set for commercial samples only and left out of other ids.
    fishery = F.concat_ws("-", ufid(), F.col("statweek"))
    return df.select(*kept, *[c.alias(name) for name, c in derived.items()]).withColumn(
        "ufid", F.when(F.col("sector").isNotNull(), fishery)
    )


def gsi_results(df: DataFrame, year: int) -> DataFrame:
    """Genetic identification results; origin and region only above the probability threshold."""
    df = df.withColumns(
        {
            "input_data_type": F.lit("stock comp"),
            "month": month_in_text("collection"),
            "year": F.lit(year),
            "resolved_stock_source": paste(F.lit("DNA"), "id_source", sep="-"),
            "hatchery_origin": if_else(F.col("id_source") == "PBT", F.lit("Y"), F.lit("N")),
            "sector": F.lit(rules.NATIONS_SECTOR),
            "pfma": F.lit(25),
            "run_recon_area": F.lit(rules.NATIONS_GSI_AREA),
        }
    ).filter(F.col("id_source") != "likely_duplicate")
    df = map_columns(df, "repunit", genetic_region)
    df = rename_by_pattern(df, {"repunit.": "region_", "collection.": "dna_stock_", "prob.": "prob_"})
    df = add_name_suffix(df, "region_", "_rollup")
    sure = F.col("prob_1") >= rules.GSI_MIN_PERCENT
    df = df.withColumns(
        {
            "resolved_stock_origin": F.when(sure, title_case(F.replace("dna_stock_1", F.lit("_"), F.lit(" ")))),
            "resolved_stock_rollup": F.when(sure, F.col("region_1_rollup")),
        }
    )
    if {"indiv", "month_jb_added"} <= set(df.columns):
        df = drop_range(df, "indiv", "month_jb_added")
    return df.drop("id_source", "collection")


def pbt_ages(df: DataFrame, collections: Sequence[str]) -> DataFrame:
    """Parentage-based ages: counts by collection turned into one row per fish."""
    long = gather(df.withColumnRenamed("collection", "stock"), collections, "collection", "n", drop_null=True)
    fish = long.select(
        title_case(F.replace("stock", F.lit("_"), F.lit(" "))).alias("resolved_stock_origin"),
        genetic_region("repunit").alias("resolved_stock_rollup"),
        F.col("age").alias("resolved_age"),
        month_in_text("collection").alias("month"),
        F.lit("DNA-PBT").alias("resolved_stock_source"),
        "n",
    )
    return repeat_rows(fish, "n")


def compile_biodata(parts: Sequence[DataFrame]) -> DataFrame:
    """All sample parts in one table, with a display label."""
    return compile_catch(parts)


def conuma_biodata(samples: DataFrame, gsi: DataFrame, lookup: DataFrame) -> DataFrame:
    """Area 25 sport and commercial samples, escapement samples and genetic results.

    Sport samples are placed by sub-area, the others by run-reconstruction area.
    """
    sector, local = F.col("sector"), F.col("pfma") == 25
    wanted = samples.filter((sector.isin("sport", "commercial") & local) | (sector == "escapement"))
    keys = {
        "sport": ("creel_sub_area",),
        "commercial": ("run_recon_area",),
        "escapement": ("run_recon_area",),
        rules.NATIONS_SECTOR: ("run_recon_area",),
    }
    return compile_biodata([georeference_sectors(stack_frames([wanted, gsi]), lookup, keys)])


def nitinat_biodata(samples: DataFrame, lookup: DataFrame) -> DataFrame:
    """Areas 21 and 22 sport samples."""
    local = samples.filter((F.col("sector") == "sport") & is_in("pfma", (21, 22)))
    return compile_biodata([georeference(local, lookup, "sport", ["run_recon_area"])])


def sample_overview(df: DataFrame) -> DataFrame:
    """Number of samples by year and sample type."""
    return df.groupBy("year", "sample_type").agg(F.count(F.lit(1)).alias("n"))


def thermal_marks(df: DataFrame) -> DataFrame:
    """Otolith thermal marks of the species, tagged as stock composition."""
    return df.filter(F.col("species") == rules.MARK_SPECIES).withColumn(
        "input_data_type", F.lit("stock composition")
    )


def age_composition(
    df: DataFrame,
    year: int,
    project: str = rules.BROODSTOCK_PROJECT,
    region: str = rules.BROODSTOCK_REGION,
    gr_ages: Sequence[str] = rules.BROODSTOCK_GR_AGES,
) -> DataFrame:
    """Age composition of hatchery broodstock by location: count, total and share.

    Fish are counted per age first; shares come from that small result.
    """
    wanted = (
        (F.col("fiscal_year") == year)
        & (F.col("project") == project)
        & (F.col("geographic_location") == region)
        & F.col("gr_age").isin(*gr_ages)
    )
    counts = (
        df.filter(wanted)
        .withColumn("gr_age2", number(total_age("gr_age"), "int"))
        .groupBy("fiscal_year", "location", "gr_age2", "project")
        .agg(F.count(F.lit(1)).alias("age_n"))
    )
    in_location = Window.partitionBy("fiscal_year", "location")
    return (
        counts.withColumn("age_total", F.sum("age_n").over(in_location))
        .withColumn("age_propn", F.col("age_n") / F.col("age_total"))
        .withColumnRenamed("location", "esc_location")
        .withColumn("age_data_source", paste(F.lit(rules.BROODSTOCK_SOURCE), "esc_location", sep=", "))
        .withColumn("data_class", F.lit("age"))
        .orderBy("esc_location", "gr_age2")
    )
