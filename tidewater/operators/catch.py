"""Catch and escapement: standardise each source, add mortality, georeference, compile."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewater import rules
from tidewater.functions.dates import month_label, month_name, stat_week
from tidewater.functions.missing import (
    first_match, has_text, is_in, matches, not_in, number, paste, round_half_even, sum_or_null,
)
from tidewater.functions.recode import area_label, gear_from_text, pfma_number, recode
from tidewater.operators.joins import join_on, natural_join
from tidewater.operators.reshape import gather, spread_sum, stack_blocks, stack_frames

LOOKUP_COLUMNS = ("sector", "run_recon_area", "creel_sub_area", "lat", "long", "notes")


def ufid(
    year: Column | str = "year",
    area: Column | str = "run_recon_area",
    month: Column | str = "month",
    week: Column | str | None = None,
) -> Column:
    """Unique fishery id: year, area, month and, for commercial fisheries, the statistical week."""
    return paste(year, area, month, *([] if week is None else [week]), sep="-")


def _sport_rows(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("species") == rules.SPORT_SPECIES)
        .withColumn("month", month_label("month"))
        .drop("published_date", "status", "management", "species", "species_code", "scientific_name")
    )


def _sport_labels(df: DataFrame, areas: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumns(
        {
            "sector": F.lit("sport"),
            "input_data_type": F.lit("catch"),
            "run_recon_area": area_label("creel_sub_area", areas, "sport"),
            "pfma": pfma_number("pfma"),
        }
    ).withColumn("ufid", ufid())


def sport_catch(df: DataFrame, areas: Mapping[str, Sequence[str]]) -> DataFrame:
    """Sport catch estimates of the species, with sector, area and fishery id."""
    return _sport_labels(_sport_rows(df), areas)


def sport_totals(
    df: DataFrame,
    areas: Mapping[str, Sequence[str]],
    pfma: Sequence[int],
    year: int,
    years_before: int,
    *,
    dispositions: Sequence[str] = rules.DISPOSITIONS,
    total: str = "total_mort",
) -> DataFrame:
    """Kept, released and total mortality of the areas and years of a run reconstruction.

    Gives what ``sport_mortality(sport_catch(df))`` gives for those rows, but
    filters the extract's own columns, which reaches the scan, and sums before
    any label text is built.
    """
    rows = df.filter(
        F.col("pfma").isin(*[f"PFMA {n}" for n in pfma]) & F.col("year").between(year - years_before, year)
    )
    return _sport_labels(sport_mortality(_sport_rows(rows), dispositions, total), areas)


def fishery_region(df: DataFrame) -> DataFrame:
    """Coarse catch regions of raw sport catch, and region-month labels."""
    def region_test(areas, sub_areas, inside) -> Column:
        tests = is_in("pfma", areas) if areas else F.lit(False)
        if sub_areas:
            sub = is_in("creel_sub_area", sub_areas)
            tests = tests | (sub if inside is None else sub & is_in("pfma", [inside]))
        return tests

    choices = [(region_test(a, s, inside), F.lit(name)) for name, a, s, inside in rules.CATCH_REGIONS]
    choices.append((has_text("pfma", rules.US_REGION_TEXT), F.lit(rules.US_REGION_TEXT)))
    month = month_label("month")
    return df.withColumns(
        {
            "pfma_month": paste("pfma", month, sep=", "),
            "fish_cat_reg": first_match(choices),
        }
    ).withColumn("region_month", paste("fish_cat_reg", month, sep=", "))


def sport_mortality(
    df: DataFrame, dispositions: Sequence[str] = rules.DISPOSITIONS, total: str = "total_mort"
) -> DataFrame:
    """One row per fishery cell with kept, released and total mortality.

    A share of legal-size releases dies; the total is the kept catch alone when
    nothing was released, else rounded half-even. Estimates of undeclared dispositions are summed apart.
    """
    wide = spread_sum(df, "disposition", "estimate", dispositions, other="other_disposition")
    kept, dead = F.col("kept"), F.col("release_mort")
    return wide.withColumn("release_mort", F.col("released_legal") * rules.SPORT_RELEASE_RATE).withColumn(
        total,
        F.when(dead.isNull(), kept).otherwise(round_half_even(F.coalesce(kept, F.lit(0)) + dead)),
    )


def commercial_catch(df: DataFrame) -> DataFrame:
    """Commercial catch with gear, statistical week, area and fishery id."""
    return (
        df.withColumns(
            {
                "input_data_type": F.lit("catch"),
                "sector": F.lit("commercial"),
                "year": F.year("fishing_date"),
                "month": month_name("fishing_date"),
                "statweek": number(stat_week("fishing_date"), "int"),
                "gear": gear_from_text("licence_area", rules.LICENCE_GEARS),
            }
        )
        .withColumn("run_recon_area", paste("sector", "gear", "area_name"))
        .withColumn("ufid", ufid(week="statweek"))
    )


def commercial_mortality(df: DataFrame) -> DataFrame:
    """Release mortality by gear and total catch; unknown gear leaves both missing."""
    rate = recode("gear", rules.COMMERCIAL_RELEASE_RATES)
    return (
        df.withColumn("release_mort", F.col("chinook_reld") * rate)
        .withColumn("total_mort", round_half_even(F.col("chinook_kept") + F.col("release_mort")))
        .withColumnsRenamed({"mgmt_area": "pfma", "chinook_reld": "released_unk", "chinook_kept": "kept"})
    )


def nations_catch(blocks: Iterable[DataFrame], year: int, pfma: str = "PFMA 25") -> DataFrame:
    """Five Nations catch report blocks as one long table of one management area."""
    local = [b.select(F.col(f"`{b.columns[0]}`"), F.col(f"`{pfma}`")) for b in blocks if pfma in b.columns]
    long = stack_blocks(local, "catch_data_source", "month", "pfma", "kept")
    areas = [(matches("catch_data_source", p), F.lit(a)) for p, a in rules.NATIONS_AREAS.items()]
    return long.withColumns(
        {
            "year": F.lit(year),
            "run_recon_area": F.coalesce(first_match(areas), F.lit(rules.NATIONS_UNKNOWN)),
            "input_data_type": F.lit("catch"),
            "month": F.coalesce(recode("month", rules.MONTH_SHORT), F.col("month")),
            "pfma": pfma_number("pfma"),
            "sector": F.lit(rules.NATIONS_SECTOR),
        }
    ).withColumn("ufid", ufid())


SEX_COLUMNS = tuple(s.lower() for s in rules.REPORT_SEXES)


def _classified_lines(df: DataFrame) -> DataFrame:
    """Report lines that are no notes or subtotals, with sector, area, month and fishery id."""
    keep = not_in("details", rules.REPORT_NOTE_LINES)
    for text in rules.REPORT_NOTE_TEXT:
        keep = keep & ~has_text("details", text)

    kind, sector = F.col("estimate_type"), F.col("sector")
    natural, removed = kind == rules.NATURAL_SPAWNERS, kind == rules.FISH_REMOVED
    in_river = has_text("location", "River")
    kept_back = matches("details", "for broodstock|given to natives|other purposes")
    sectors = [
        (natural, F.lit("escapement")),
        (has_text(kind, "FRESH WATER SPORT FISHERY"), F.lit("sport")),
        (has_text(kind, "NATIVE FISHERY"), F.lit("FN")),
        (has_text(kind, "FISH REMOVED"), F.lit("escapement")),
    ]
    areas = [
        (natural & in_river, F.lit("escapement Nitinat River Spawners")),
        (removed & has_text("details", "surplus"), F.lit("escapement ESSR")),
        ((sector == "escapement") & kept_back, F.lit("escapement Hatchery broodstock, morts")),
        ((sector == "sport") & in_river, F.lit("sport Area 22 Nitinat River")),
        ((sector == "FN") & has_text("details", "ESSR"), F.lit("FN EO (Native ESSR)")),
        ((sector == "FN") & has_text("details", "Food Fish"), F.lit("FN FSC")),
    ]
    months = [(natural, F.lit("October")), (removed | sector.isin("sport", "FN"), F.lit("September"))]
    kinds = [(sector.isin("sport", "FN"), F.lit("catch")), (sector == "escapement", F.lit("escapement"))]
    return (
        df.filter(keep)
        .withColumn("sector", first_match(sectors))
        .withColumns(
            {
                "run_recon_area": first_match(areas),
                "month": first_match(months),
                "pfma": F.lit(22),
                "stock": F.lit("Nitinat"),
                "input_data_type": first_match(kinds),
                "creel_sub_area": F.when(sector == "sport", "22A"),
            }
        )
        .withColumn("ufid", F.when(F.col("run_recon_area").isNotNull(), ufid()))
    )


def hatchery_report(df: DataFrame, sexes: Sequence[str] = SEX_COLUMNS) -> DataFrame:
    """Hatchery escapement and removal report, one row per line and sex.

    Lines are classified while still wide; only the counts are melted.
    """
    long = gather(_classified_lines(df), sexes, "sex", "n")
    return long.withColumns({"sex": F.upper("sex"), "n": number("n")})


_FISHERY = ("pfma", "year", "sector", "run_recon_area", "ufid", "month", "input_data_type")


def river_sport_total(report: DataFrame) -> DataFrame:
    """River sport catch by fishery; one missing count makes the total missing."""
    river = (F.col("run_recon_area") == "sport Area 22 Nitinat River") & is_in("sex", ("M", "F", "U"))
    return (
        report.filter(river)
        .groupBy(*_FISHERY, "creel_sub_area")
        .agg(sum_or_null("n").alias("kept"))
        .withColumn("total", F.col("kept"))
    )


def fn_total(report: DataFrame) -> DataFrame:
    """First Nations catch by fishery; one missing count makes the total missing."""
    nations = (F.col("sector") == "FN") & is_in("sex", ("M", "F", "U")) & F.col("run_recon_area").isNotNull()
    return (
        report.filter(nations)
        .groupBy(*_FISHERY)
        .agg(sum_or_null("n").alias("kept"))
        .withColumn("total", F.col("kept"))
    )


def escapement_total(report: DataFrame) -> DataFrame:
    """Escapement by fishery and sex; one missing count makes the total missing."""
    spawners = (
        (F.col("sector") == "escapement")
        & F.col("run_recon_area").isNotNull()
        & is_in("sex", ("M", "F", "U", "J"))
    )
    return report.filter(spawners).groupBy(*_FISHERY, "sex").agg(sum_or_null("n").alias("total"))


def report_totals(extract: DataFrame, sexes: Sequence[str] = SEX_COLUMNS) -> DataFrame:
    """River sport, First Nations and escapement totals straight from the report extract.

    Equals the three totals of ``hatchery_report`` stacked: escapement is kept by
    sex, and a missing count makes its fishery's total missing. Counts are summed
    per distinct line text first, so only those few lines are classified and melted.
    """
    cells = {s: number(s) for s in sexes}
    lines = extract.groupBy("year", "estimate_type", "location", "details").agg(
        *[F.sum(n).alias(s) for s, n in cells.items()],
        *[F.count_if(n.isNull()).alias(f"{s}_missing") for s, n in cells.items()],
    )
    by_sex = F.array(
        *[
            F.struct(F.lit(s.upper()).alias("sex"), F.col(s).alias("n"), F.col(f"{s}_missing").alias("missing"))
            for s in sexes
        ]
    )
    sector, area = F.col("sector"), F.col("run_recon_area")
    landed = (area == "sport Area 22 Nitinat River") | ((sector == "FN") & area.isNotNull())
    spawners = (sector == "escapement") & area.isNotNull()
    rows = (
        _classified_lines(lines)
        .select(*_FISHERY, "creel_sub_area", F.inline(by_sex))
        .filter((landed & is_in("sex", ("M", "F", "U"))) | (spawners & is_in("sex", ("M", "F", "U", "J"))))
        .withColumn("sex", F.when(sector == "escapement", F.col("sex")))
    )
    totals = rows.groupBy(*_FISHERY, "creel_sub_area", "sex").agg(
        F.when(F.sum("missing") == 0, F.sum("n")).alias("total")
    )
    return totals.withColumn("kept", F.when(F.col("sector") != "escapement", F.col("total")))


def georeference(
    df: DataFrame, lookup: DataFrame, sector: str, drop: Sequence[str] = (), *, sector_text: bool = False
) -> DataFrame:
    """Attach positions from one sector of the spatial lookup.

    ``drop`` names lookup columns that must not act as join keys.
    ``sector_text`` takes every lookup sector that contains the text.
    """
    wanted = has_text("sector", sector) if sector_text else F.col("sector") == sector
    return natural_join(df, lookup.filter(wanted).drop("notes", *drop), "left")


def georeference_sectors(df: DataFrame, lookup: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Attach positions to several sectors of one table in a single pass.

    ``keys`` names, per sector, the columns that place its rows. Equals one
    ``georeference`` per sector with the other place columns dropped, stacked.
    """
    columns = sorted({c for place in keys.values() for c in place})
    places = {
        f"__{c}": F.when(F.col("sector").isin(*[s for s, place in keys.items() if c in place]), F.col(c))
        for c in columns
    }
    wanted = lookup.filter(F.col("sector").isin(*keys)).withColumns(places)
    positions = wanted.select("sector", *places, "lat", "long")
    return join_on(df.withColumns(places), positions, ["sector", *places], "left").drop(*places)


def compile_catch(parts: Sequence[DataFrame], how: str = "union", *, hot: str | None = None) -> DataFrame:
    """All catch parts in one table, with a display label.

    Parts never share a sector and area, so stacking them equals the full join
    on all shared columns and needs no shuffle; ``how="full"`` runs that join, with ``hot`` as of ``join_on``.
    """
    if how == "union":
        whole = stack_frames(parts)
    elif how == "full":
        whole = parts[0]
        for part in parts[1:]:
            whole = natural_join(whole, part, "full", hot=hot)
    else:
        raise ValueError(f"how must be 'union' or 'full', not {how!r}")
    return whole.withColumn("label", paste("run_recon_area", "input_data_type"))


def conuma_catch(
    sport_extract: DataFrame, commercial: DataFrame, nations: DataFrame, lookup: DataFrame, rr_year: int
) -> DataFrame:
    """Area 25 catch of all sectors.

    Takes the sport extract as landed, and standardised commercial and Five Nations catch.
    """
    sport = sport_totals(sport_extract, rules.CONUMA_SPORT_AREAS, (25,), rr_year, 3)
    fleet = commercial_mortality(commercial.filter(F.col("mgmt_area") == 25))
    five = nations.filter(is_in("month", rules.NATIONS_MONTHS)).withColumn("total_mort", F.col("kept"))
    places = {
        "sport": ("run_recon_area", "creel_sub_area"),
        "commercial": ("run_recon_area",),
        rules.NATIONS_SECTOR: ("run_recon_area",),
    }
    return compile_catch([georeference_sectors(stack_frames([sport, fleet, five]), lookup, places)])


def nitinat_catch(
    sport_extract: DataFrame, report_extract: DataFrame, lookup: DataFrame, rr_year: int
) -> DataFrame:
    """Areas 21 and 22 catch and escapement from the sport and hatchery report extracts as landed."""
    sport = sport_totals(sport_extract, rules.NITINAT_SPORT_AREAS, (21, 22), rr_year, 4, total="total")
    places = {
        "sport": ("run_recon_area", "creel_sub_area"),
        "FN": ("run_recon_area",),
        "escapement": ("run_recon_area",),
    }
    return compile_catch([georeference_sectors(stack_frames([sport, report_totals(report_extract)]), lookup, places)])
