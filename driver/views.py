"""Fishery-shaped inputs derived from the given tables, in SQL both engines read.

Every view covers whole tables. Choices come from key remainders; missing
values, which the tables lack, are made with ``nullif`` and ``case``.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"

# (sub-area, management area) pairs; an empty sub-area becomes null.
SPORT_PLACES = (
    ("25D", "PFMA 25"), ("25L", "PFMA 25"), ("25E", "PFMA 25"), ("25F", "PFMA 25"), ("25JI", "PFMA 25"),
    ("25I", "PFMA 25"), ("25PO", "PFMA 25"), ("25JO", "PFMA 25"), ("25K", "PFMA 25"), ("25M", "PFMA 25"),
    ("25N", "PFMA 25"), ("25O", "PFMA 25"), ("25PI", "PFMA 25"), ("25ZZ", "PFMA 25"), ("", "PFMA 25"),
    ("21A", "PFMA 21"), ("21B", "PFMA 21"), ("Area 21", "PFMA 21"), ("22A", "PFMA 22"), ("121C", "PFMA 121"),
    ("19A", "PFMA 19"), ("20A", "PFMA 20"), ("23A", "PFMA 23"), ("23H", "PFMA 23"), ("7X", "US7 North"),
    ("10A", "PFMA 10"), ("24B", "PFMA 24"), ("125A", "PFMA 125"), ("20DB", "PFMA 20"), ("13X", "PFMA 13"),
)
SAMPLE_PLACES = (
    "25D|25L|25E|25F|25JI|25I|25PO|25JO|25K|25M|25N|25O|25PI|125Q|Area 26 x||21A|21B|22A|121C|Area 21|25Z"
)
STOCKS = (
    "Conuma River|Nitinat River|Burman River|San Juan River|Robertson Creek|Tofino Hatchery|Big Qualicum River|"
    "Tranquil River|Toquaht River|Salmon River|SUS (assumed)|Marble River|Kaouk River|||Omega Pacific Hatchery|"
    "Sucwoa River|Gold River|Somass River|Quinsam River"
)
STREAMS = (
    ("CONUMA RIVER", "25"), ("NITINAT RIVER", "22"), ("BURMAN RIVER", "25"), ("SAN JUAN RIVER", "20"),
    ("QUALICUM RIVER", "14"), ("TRANQUIL CREEK", "24"), ("TOQUART RIVER", "23A"), ("TOQUART RIVER", "23B"),
    ("SALMON RIVER", "13"), ("SALMON RIVER", "29B"), ("MARBLE RIVER", "27"), ("KAOUK RIVER", "26"),
    ("SUCWOA RIVER", "25"), ("GOLD RIVER", "25A"), ("SOMASS RIVER", "23"), ("QUINSAM RIVER", "13"),
    ("HARRISON RIVER", "29D"), ("NO AREA CREEK", ""), ("", "23"), ("SARITA-UPPER CREEK", "23"),
)
LOOKUP_AREAS = (
    ("25D", "sport Tlupana"), ("25L", "sport Muchalat"), ("25E", "sport Inner Esperanza"),
    ("25F", "sport Inner Esperanza"), ("25JI", "sport Inner Esperanza"), ("25I", "sport Outer Nootka/corridor"),
    ("25PO", "sport Outer Nootka/corridor"), ("25JO", "sport Outer Esperanza/corridor"),
    ("25K", "sport Outer Esperanza/corridor"), ("25M", "sport Inner Nootka"), ("25N", "sport Inner Nootka"),
    ("25O", "sport Inner Nootka"), ("25PI", "sport Inner Nootka"), ("", ""),
    ("21A", "sport Area 21 Terminal"), ("21B", "sport Area 21 Terminal"), ("Area 21", "sport Area 21 Terminal"),
    ("121C", "sport Outer Nitinat corridor"), ("22A", "sport Nitinat Lake and River"),
    ("22A", "sport Area 22 Nitinat River"), ("25O", "sport Inner Nootka"),
)


def pick(values: str | tuple, key: str) -> str:
    """SQL for one of the ``|``-separated values, chosen by a whole-number expression; empty is null."""
    values = (values if isinstance(values, str) else "|".join(values)).split("|")
    at = f"1 + cast(({key}) % {len(values)} as int)"
    empty = [str(k) for k, v in enumerate(values, 1) if not v]
    if empty:
        at = f"CASE WHEN {at} IN ({', '.join(empty)}) THEN NULL ELSE {at} END"
    return f"split_part('{'|'.join(values)}', '|', {at})"


def _pairs(pairs: tuple, at: int) -> str:
    return "|".join(p[at] for p in pairs)


def text(expr: str) -> str:
    return f"cast({expr} as string)"


VIEWS: dict[str, str] = {
    "v_catch": f"""
        SELECT cast(year(l_shipdate) AS int) AS year, {pick(MONTHS, "month(l_shipdate) - 1")} AS month,
               {pick(_pairs(SPORT_PLACES, 1), "l_partkey")} AS pfma,
               {pick(_pairs(SPORT_PLACES, 0), "l_partkey")} AS creel_sub_area,
               CASE WHEN l_linenumber = 7 THEN 'COHO SALMON' ELSE 'CHINOOK SALMON' END AS species,
               CASE l_returnflag WHEN 'A' THEN 'Kept' WHEN 'R' THEN 'Released Legal'
                    ELSE CASE l_linenumber WHEN 5 THEN 'Released Unknown' WHEN 4 THEN NULL
                         ELSE 'Released Sub-legal' END END AS disposition,
               nullif(l_quantity, 13) AS estimate
        FROM {{lineitem}}""",
    "v_commercial": f"""
        SELECT cast(o_orderdate AS date) AS fishing_date,
               {pick("Area D Gillnet|Area G Troll|Area B Seine|Trap|Area E Gillnet", "o_custkey")} AS licence_area,
               {pick("Nootka|Tlupana|Esperanza|", "o_orderkey")} AS area_name,
               CASE WHEN o_orderkey % 3 = 0 THEN 23 ELSE 25 END AS mgmt_area,
               cast(nullif(o_orderkey % 60, 17) AS int) AS chinook_kept,
               cast(nullif(o_custkey % 40, 13) AS int) AS chinook_reld
        FROM {{orders}}""",
    "v_report": f"""
        SELECT 1995 + cast(l_orderkey % 7 AS int) AS year,
               {pick("TOTAL NATURAL SPAWNING RIVER POPULATION|FRESH WATER SPORT FISHERY|NATIVE FISHERY|"
                     "FISH REMOVED FROM THE SYSTEM:|OTHER|", "l_suppkey")} AS estimate_type,
               {pick("Nitinat River|Nitinat Lake", "l_orderkey")} AS location,
               {pick("surplus to needs|for broodstock|given to natives|other purposes|ESSR harvest|Food Fish|Culls|"
                     "Morts|0|Total|SUBTOTAL line|If Applicable note|River was open July|"
                     "* Not including broodstock||spawners counted|Number of fish given to others",
                     "l_partkey")} AS details,
               CASE WHEN l_tax = 0 AND l_quantity = 3 THEN 'n/a' ELSE {text("cast(l_quantity as int)")} END AS u,
               {text("cast(l_quantity as int) + 1")} AS m,
               {text("cast(l_quantity as int) + l_linenumber")} AS f,
               CASE WHEN l_quantity = 50 AND l_linenumber = 1 THEN NULL
                    ELSE {text("l_linenumber")} END AS j,
               {text("l_linenumber * 2")} AS i
        FROM {{lineitem}}""",
    "v_samples": f"""
        SELECT 1998 + cast(u % 4 AS int) AS year, {pick(MONTHS, "e")} AS month,
               make_date(1998 + cast(u % 4 AS int), 1 + cast(e % 12 AS int), 1 + cast(k % 28 AS int))
                 AS collection_date,
               CASE event_type WHEN 'view' THEN 'Sport' WHEN 'click' THEN 'Sport' WHEN 'purchase' THEN 'GILL NET'
                    WHEN 'signup' THEN 'FREEZER TROLL'
                    ELSE CASE WHEN k % 2 = 0 THEN 'Escapement' ELSE 'SEINE net' END END AS sample_type,
               {pick("25|25|21|22|25|26|25|x", "e + u")} AS area,
               {pick("Nootka Sound|Barkley Sound||Nitinat", "k")} AS area_name,
               {pick(SAMPLE_PLACES, "k + e")} AS subarea,
               {pick("Tlupana Inlet|Nootka|Esperanza|", "e")} AS run_recon_area,
               {pick("Conuma R|Gold R||Burman R", "u")} AS landing_site,
               cast(nullif(1 + (e + u + k) % 7, 7) AS int) AS resolved_age,
               {pick(STOCKS, "u + k")} AS resolved_stock_origin,
               {pick("NWVI|SWVI|SWVI|NWVI|ECVI||Puget Sound", "u * 3 + k")} AS resolved_stock_rollup,
               {pick("CWT|Otolith Stock|DNA|DNA|", "e")} AS resolved_stock_source,
               {pick("Y|N|", "k + e")} AS hatchery_origin, {pick("Y|N|N|", "u")} AS adipose_fin_clipped,
               {pick("Not Marked|No Sample|H5|", "e + 2 * u")} AS thermalmark,
               CASE WHEN e % 3 = 0 THEN NULL ELSE 'B' || {text("u")} END AS otolith_box,
               CASE WHEN e % 4 = 0 THEN NULL ELSE {text("k")} END AS otolith_specimen,
               CASE WHEN k % 5 = 0 THEN NULL ELSE 'S' || {text("u")} END AS scale_book,
               {pick("RG||UD", "e")} AS part_age_code,
               {pick("0|12345|A77||0.5|00", "k + u")} AS cwt_head_label,
               {pick("No Tag|181234|", "e + u")} AS cwt_result,
               CASE WHEN u % 2 = 0 THEN 1998 + cast(u % 4 AS int) - 2 - cast(e % 4 AS int) END AS cwt_brood_year,
               {pick("W12||W77", "k")} AS specimen_reference_dna_no,
               {pick("CONUMA_RIVER|NO SAMPLE||BURMAN_R", "e + k")} AS dna_results_stock_1,
               {pick("GOLD_R|", "e")} AS dna_stock_2,
               {pick("Conuma River|Nitinat River|", "k")} AS region_1_name,
               cast(1 + k AS double) / 100 AS prob_1,
               {pick("M|F|J|", "e + u")} AS sex
        FROM (SELECT event_id AS e, user_id AS u, event_type,
                     cast(replace(replace(props, '{{{{"k": ', ''), '}}}}', '') AS int) AS k
              FROM {{events}}) AS ev""",
    "v_lookup": f"""
        SELECT 'sport' AS sector, {pick(_pairs(LOOKUP_AREAS, 1), "n_nationkey")} AS run_recon_area,
               {pick(_pairs(LOOKUP_AREAS, 0), "n_nationkey")} AS creel_sub_area,
               48 + cast(n_nationkey AS double) / 8 AS lat, -126 - cast(n_nationkey AS double) / 16 AS long,
               'note ' || n_name AS notes
        FROM {{nation}}
        UNION ALL
        SELECT 'commercial', {pick("commercial Gillnet Nootka|commercial Troll Esperanza|"
                                   "commercial Seine Tlupana|commercial Gillnet Tlupana|commercial NA Nootka",
                                   "r_regionkey")},
               NULL, 49 + cast(r_regionkey AS double) / 8, -127 + cast(r_regionkey AS double) / 16, r_name
        FROM {{region}}
        UNION ALL
        SELECT {pick("5 Nations EO|5 Nations EO|escapement|escapement|FN", "r_regionkey")},
               {pick("5 Nations Outer Nootka|5 Nations Muchalat|escapement Conuma R|"
                     "escapement Nitinat River Spawners|FN FSC", "r_regionkey")},
               NULL, 50 + cast(r_regionkey AS double) / 8, -128 + cast(r_regionkey AS double) / 16, r_name
        FROM {{region}}""",
    "v_streams": f"""
        SELECT {pick(_pairs(STREAMS, 0), "c_custkey")} AS waterbody_name,
               {pick(_pairs(STREAMS, 1), "c_custkey")} AS area
        FROM {{customer}}""",
    "v_gsi": f"""
        SELECT 'F' || {text("o_orderkey")} AS indiv,
               {pick("A25_07(Jul)|A25_08(Aug)|A25_06(Jun)|A25_09(Sep)|A25_10", "o_custkey")} AS collection,
               'x' AS month_jb_added,
               {pick("PBT|GSI|likely_duplicate||GSI", "o_orderkey")} AS id_source,
               {pick("NoKy|SWVI|NPS|Fraser|", "o_custkey + o_orderkey")} AS repunit_1,
               {pick("SWVI|NoKy|", "o_custkey")} AS repunit_2,
               {pick("CONUMA_RIVER|SAN_JUAN-UPPER|BURMAN_R|gold river (lower)|", "o_orderkey + 3 * o_custkey")}
                 AS collection_1,
               {pick("NITINAT_R|", "o_orderkey")} AS collection_2,
               cast(nullif(50 + o_custkey % 51, 99) AS double) AS prob_1,
               cast(o_custkey % 51 AS double) AS prob_2
        FROM {{orders}}""",
    "v_pbt": f"""
        SELECT {pick("CONUMA_RIVER|SAN_JUAN|BURMAN_R|", "p_partkey")} AS collection,
               {pick("NoKy|SWVI|NPS|Fraser", "p_partkey + p_size")} AS repunit,
               cast(2 + p_partkey % 4 AS int) AS age, 'BC' AS prov_state, p_size AS sum,
               cast(nullif(p_partkey % 5, 4) AS int) AS jul, cast(nullif(p_size % 4, 1) AS int) AS aug
        FROM {{part}}""",
    "v_block_aabm": f"""
        SELECT {pick("Aug|Sept|July|June|May|", "o_custkey")} AS month,
               cast(o_orderkey % 7 AS double) AS k24, cast(nullif(o_orderkey % 50, 9) AS double) AS k25,
               cast(1 AS double) AS k26
        FROM {{orders}}""",
    "v_block_muchalaht": f"""
        SELECT {pick("Aug|Sept|July", "c_custkey")} AS month, cast(c_custkey % 20 AS double) AS k25
        FROM {{customer}}""",
    "v_block_conuma": f"""
        SELECT {pick("Aug|Sept|July|Oct", "p_partkey")} AS month, cast(p_size AS double) AS k25 FROM {{part}}""",
    "v_block_essr": f"""
        SELECT {pick("Sept|September", "s_suppkey")} AS month, cast(s_suppkey % 9 AS double) AS k25
        FROM {{supplier}}""",
    "v_block_other": f"""
        SELECT {pick("Aug|June", "event_id")} AS month, cast(user_id % 4 AS double) AS k25 FROM {{events}}""",
    "v_hatchery": f"""
        SELECT CASE WHEN l_suppkey % 5 = 4 THEN '' ELSE {pick("Conuma R|Nitinat R|Robertson Cr|Burman R", "l_suppkey")}
                    END AS spawning_stock,
               CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE 'B' || {text("l_orderkey")} END AS bag_no,
               CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE {text("l_linenumber")} END AS vial_no,
               CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE 'S' || {text("l_orderkey")} END AS book_no,
               CASE WHEN l_suppkey % 11 = 0 OR l_partkey % 13 = 0 THEN NULL
                    ELSE {text("l_linenumber")} END AS scale_sample_no,
               CASE WHEN l_linenumber <= 2 THEN 'T' || {text("l_partkey")} END AS cwt_tag_code,
               {pick("31|41||51|3M", "l_orderkey")} AS scale_gilbert_age,
               {pick("RG|||UD|NS|1M", "l_orderkey + l_suppkey")} AS scale_part_age,
               {pick("4||", "l_partkey")} AS total_age_yrs
        FROM {{lineitem}}""",
    "v_batches": f"""
        SELECT n_nationkey AS id, CASE WHEN n_nationkey % 8 = 7 THEN 'NC' ELSE 'SC' END AS sector,
               CASE WHEN n_nationkey % 9 = 8 THEN 2021 ELSE 2022 END AS sample_year,
               'P' || {text("n_nationkey")} AS project_name, 'WCVI' AS region,
               'A' || {text("n_nationkey % 5")} AS area, 'Chinook' AS species, 2022 AS recovery_year,
               'Adult' AS life_history
        FROM {{nation}}""",
    "v_projects": f"""
        SELECT n_nationkey AS id, 'Hatchery ' || n_name AS location FROM {{nation}}""",
    "v_containers": f"""
        SELECT 'S' || {text("o_orderkey")} AS id, cast(o_orderkey % 24 AS int) AS batch_id,
               cast(o_custkey % 25 AS int) AS field_container_id, o_orderpriority AS container_notes,
               cast(o_custkey % 3 AS int) AS analyst_name,
               '2022-09-' || {text("10 + o_custkey % 20")} AS cnt_start_date, '2022-10-05' AS cnt_end_date
        FROM {{orders}}""",
    "v_readings": f"""
        SELECT cast(o_orderkey % 24 AS int) AS id, 'S' || {text("o_orderkey")} AS container_id,
               'P' || {text("o_orderkey % 24")} AS project_name, 'WCVI' AS region,
               'A' || {text("o_orderkey % 24 % 5")} AS area,
               CASE WHEN o_custkey % 17 = 3 THEN 'Coho' ELSE 'Chinook' END AS species,
               CASE WHEN o_custkey % 10 = 9 THEN 2021 ELSE 2022 END AS recovery_year, 'Adult' AS life_history,
               {text("1 + o_orderkey % 7")} AS fish_number, {pick("31|41|51|3M||21|32", "o_custkey")} AS gr_age,
               {pick("R||", "o_custkey")} AS scale_condition
        FROM {{orders}}""",
    "v_otoliths": f"""
        SELECT CASE o_custkey % 3 WHEN 0 THEN 'H-ROBERTSON CR' WHEN 1 THEN 'H-CONUMA R ' ELSE 'H-NITINAT R' END
                 AS facility,
               CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE 'B' || {text("o_orderkey")} END AS box_code,
               CASE WHEN o_orderkey % 3 = 2 THEN NULL
                    ELSE {text("1 + cast(floor(o_orderkey / 7) as int) % 7")} END AS cell_number,
               'H' || {text("cast(floor(o_custkey / 2) as int)")} AS hatch_code,
               {pick("RG||1M", "o_orderkey")} AS part_age_code, {pick("31|41|", "o_custkey")} AS age_gr
        FROM {{orders}}""",
    "v_tags": f"""
        SELECT CASE WHEN p_partkey % 5 = 3 THEN NULL ELSE 'T' || {text("p_partkey")} END AS tagcode,
               'Chinook' AS species_name, 'Project ' || {text("p_size")} AS project_name,
               cast(nullif(2015 + p_partkey % 5, 2019) AS int) AS brood_year,
               cast(2016 + p_partkey % 5 AS int) AS release_year,
               {pick("S-Conuma R|S-Nitinat R||S-Robertson Cr", "p_partkey")} AS stock_site_name, 'WCVI' AS
               stock_psc_region_name, 'Hatchery ' || p_brand AS hatchery_site_name,
               'WCVI' AS hatchery_psc_region_name, p_type AS release_site_name,
               'WCVI' AS release_psc_region_name, {pick("Smolt|Fry|", "p_size")} AS stage_code
        FROM {{part}}""",
    "v_marks": f"""
        SELECT cast(2015 + p_partkey % 6 AS int) AS brood_year, 'AG' AS agency,
               'H-F' || {text("p_partkey % 7")} AS facility, cast(2016 + p_partkey % 6 AS int) AS release_year,
               {pick("H-CONUMA RIVER|H-NITINAT R|S-SAN JUAN-UPPER|S-BURMAN R (EAST)|", "p_partkey + p_size")} AS stock,
               CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE 'H' || {text("cast(floor(p_partkey / 30) as int)")} END
                 AS hatch_code,
               {pick("BRITISH COLUMBIA|BRITISH COLUMBIA|ALASKA||WASHINGTON|BRITISH COLUMBIA|BRITISH COLUMBIA",
                     "p_size + p_partkey")}
                 AS state_province,
               p_type AS site, cast(nullif(p_size * 1000, 7000) AS bigint) AS number_released
        FROM {{part}}""",
    "v_ages": f"""
        SELECT cast(2020 + o_orderkey % 3 AS int) AS fiscal_year,
               {pick("CONUMA RIVER HATCHERY -2021|CONUMA RIVER HATCHERY -2021|OTHER HATCHERY", "o_custkey")} AS project,
               {pick("WCVI|WCVI|ECVI|", "o_orderkey")} AS geographic_location,
               {pick("Conuma River|Canton Creek|Sucwoa River|Tlupana River|Gold River", "o_custkey")} AS location,
               {pick("21|31|41|51|61|1M|2M|3M|4M|5M|", "o_orderkey + o_custkey")} AS gr_age
        FROM {{orders}}""",
    "v_escapement": f"""
        SELECT p_partkey AS row_no, cast(2015 + p_partkey % 8 AS int) AS year, p_name AS stock, p_type AS unused_1,
               CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'B' || {text("p_size")} END AS otolith_box,
               CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE {text("p_partkey")} END AS otolith_specimen,
               p_brand AS unused_2, 'S' || {text("p_size")} AS scale_book,
               CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE {text("p_partkey % 10")} END AS scale,
               p_retailprice AS unused_3
        FROM {{part}}""",
    "v_snapshots": f"""
        SELECT event_id, value, {pick("2022-02-10|2022-11-03|2023-02-22|2021-07-01", "user_id")} AS snapshot
        FROM {{events}}""",
}


def tables_of(name: str) -> list[str]:
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", VIEWS[name])))


@cache
def _schema(sf_dir: str, table: str) -> StructType:
    """Schema of a table, so that its footers are read once and not per query."""
    return SparkSession.active().read.parquet(f"{sf_dir}/{table}.parquet").schema


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the tables of one folder, as a DataFrame."""
    frames = {
        t: spark.read.schema(_schema(sf_dir, t)).parquet(f"{sf_dir}/{t}.parquet") for t in tables_of(name)
    }
    return spark.sql(VIEWS[name], **frames)


def view_sql(name: str) -> str:
    """The view's query with plain table names."""
    return VIEWS[name].format(**{t: t for t in tables_of(name)})
