"""The queries again in plain SQL, written apart from the library."""

from __future__ import annotations

from driver.views import view_sql

ORACLES: dict[str, str] = {}


def steps(final: str, views: str = "", **ctes: str) -> str:
    """One statement: the named views, further steps in order, and the final select."""
    parts = {**{v: view_sql(v) for v in views.split()}, **ctes}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n" + final


def pasted(*cols: str, sep: str = " ") -> str:
    return f" || '{sep}' || ".join(f"coalesce(cast({c} as varchar), 'NA')" for c in cols)


def title(expr: str) -> str:
    """Upper-case the first letter of every run of word characters."""
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({expr}), '[a-z0-9''_]+|[^a-z0-9''_]+'), "
        "lambda w: upper(w[1]) || w[2:]), '')"
    )


def equal(a: str, b: str, *keys: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def same(a: str, b: str, *keys: str) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)


UFID = pasted("year", "run_recon_area", "month", sep="-")
UFID_WEEK = pasted("year", "run_recon_area", "month", "statweek", sep="-")
MONTH_LIST = (
    "('January','February','March','April','May','June','July','August','September','October','November','December')"
)


def week_sql(d: str) -> str:
    """Statistical week by the %U week-of-year formula."""
    return (
        f"coalesce(cast(month({d}) as varchar), 'NA') || coalesce(cast(cast(strftime({d}, '%U') as int) - "
        f"cast(strftime(date_trunc('month', {d}), '%U') as int) + 1 as varchar), 'NA')"
    )


# Catch and escapement

CONUMA_AREA = """CASE
  WHEN {c} = '25D' THEN 'sport Tlupana'
  WHEN {c} = '25L' THEN 'sport Muchalat'
  WHEN {c} IN ('25E','25F','25JI') THEN 'sport Inner Esperanza'
  WHEN {c} IN ('25I','25PO') THEN 'sport Outer Nootka/corridor'
  WHEN {c} IN ('25JO','25K') THEN 'sport Outer Esperanza/corridor'
  WHEN {c} IN ('25M','25N','25O','25PI') THEN 'sport Inner Nootka' {more} END"""
NITINAT_AREA = """CASE
  WHEN {c} IN ('21A','21B','Area 21') THEN 'sport Area 21 Terminal'
  WHEN {c} = '121C' THEN 'sport Outer Nitinat corridor'
  WHEN {c} = '22A' THEN 'sport Nitinat Lake and River' END"""


def sport_sql(area: str) -> dict[str, str]:
    area = area.format(c="creel_sub_area", more="")
    return {
        "sport0": f"""SELECT year, CASE WHEN month IN {MONTH_LIST} THEN month END AS month,
            try_cast(substr(pfma, 6, 4) AS int) AS pfma, creel_sub_area, disposition, estimate,
            'sport' AS sector, 'catch' AS input_data_type, {area} AS run_recon_area
            FROM v_catch WHERE species = 'CHINOOK SALMON'""",
        "sport": f"SELECT *, {UFID} AS ufid FROM sport0",
    }


def mortality_sql(where: str, total: str = "total_mort") -> dict[str, str]:
    return {
        "wide": f"""SELECT year, month, pfma, creel_sub_area, sector, input_data_type, run_recon_area, ufid,
            sum(estimate) FILTER (WHERE disposition = 'Kept') AS kept,
            sum(estimate) FILTER (WHERE disposition = 'Released Legal') AS released_legal,
            sum(estimate) FILTER (WHERE disposition = 'Released Sub-legal') AS released_sub_legal,
            sum(estimate) FILTER (WHERE disposition IS NULL
              OR disposition NOT IN ('Kept', 'Released Legal', 'Released Sub-legal')) AS other_disposition
            FROM sport WHERE {where} GROUP BY ALL""",
        "mort": f"""SELECT *, released_legal * 2e-1 AS release_mort,
            CASE WHEN released_legal IS NULL THEN kept
                 WHEN kept IS NULL THEN round_even(released_legal * 2e-1, 0)
                 ELSE round_even(kept + released_legal * 2e-1, 0) END AS {total} FROM wide""",
    }


COMM = {
    "comm0": f"""SELECT *, 'catch' AS input_data_type, 'commercial' AS sector, cast(year(fishing_date) AS int) AS year,
        monthname(fishing_date) AS month, try_cast({week_sql('fishing_date')} AS int) AS statweek,
        CASE WHEN contains(licence_area, 'Gillnet') THEN 'Gillnet' WHEN contains(licence_area, 'Troll') THEN 'Troll'
             WHEN contains(licence_area, 'Seine') THEN 'Seine' END AS gear FROM v_commercial""",
    "comm1": f"SELECT *, {pasted('sector', 'gear', 'area_name')} AS run_recon_area FROM comm0",
    "comm": f"SELECT *, {UFID_WEEK} AS ufid FROM comm1",
    "comm_mort": """SELECT * EXCLUDE (mgmt_area, chinook_kept, chinook_reld), mgmt_area AS pfma,
        chinook_kept AS kept, chinook_reld AS released_unk,
        chinook_reld * CASE gear WHEN 'Gillnet' THEN 5e-1 WHEN 'Seine' THEN 2e-1 WHEN 'Troll' THEN 2e-1 END
          AS release_mort,
        round_even(chinook_kept + chinook_reld * CASE gear WHEN 'Gillnet' THEN 5e-1 WHEN 'Seine' THEN 2e-1
          WHEN 'Troll' THEN 2e-1 END, 0) AS total_mort FROM comm""",
}
BLOCKS = {
    "five0": """
        SELECT 'Five Nations AABM Chinook sold 2021' AS catch_data_source, month AS m, k25 AS kept FROM v_block_aabm
        UNION ALL SELECT 'Five Nations ISBM Muchalaht  Chinook sold -', month, k25 FROM v_block_muchalaht
        UNION ALL SELECT 'Five Nations ISBM Conuma Chinook sold - Esperanza/Nootka', month, k25 FROM v_block_conuma
        UNION ALL SELECT 'Five Nations Conuma ESSR', month, k25 FROM v_block_essr
        UNION ALL SELECT 'Some other report', month, k25 FROM v_block_other""",
    "five1": """SELECT catch_data_source, CASE m WHEN 'Aug' THEN 'August' WHEN 'Sept' THEN 'September' ELSE m END AS month,
        25 AS pfma, kept, 2000 AS year, 'catch' AS input_data_type, '5 Nations EO' AS sector,
        CASE WHEN catch_data_source LIKE '%ISBM Conuma%' OR catch_data_source LIKE '%AABM%' THEN '5 Nations Outer Nootka'
             WHEN catch_data_source LIKE '%ISBM Muchalaht%' THEN '5 Nations Muchalat'
             WHEN catch_data_source LIKE '%Conuma ESSR%' THEN '5 Nations Conuma ESSR' ELSE 'FLAG' END AS run_recon_area
        FROM five0""",
    "five": f"SELECT *, {UFID} AS ufid FROM five1",
}
BLOCK_VIEWS = "v_block_aabm v_block_muchalaht v_block_conuma v_block_essr v_block_other"
REPORT = {
    "rep0": """SELECT * FROM v_report WHERE
        (details IS NULL OR (details NOT IN ('Number of fish given to others','Culls','Morts','0','Total')
          AND NOT contains(details, 'TOTAL') AND NOT contains(details, 'If Applicable')
          AND NOT contains(details, 'River was open') AND NOT contains(details, 'Not including broodstock')))""",
    "rep1": """SELECT year, estimate_type, location, details, 'U' AS sex, u AS n FROM rep0
        UNION ALL SELECT year, estimate_type, location, details, 'M', m FROM rep0
        UNION ALL SELECT year, estimate_type, location, details, 'F', f FROM rep0
        UNION ALL SELECT year, estimate_type, location, details, 'J', j FROM rep0
        UNION ALL SELECT year, estimate_type, location, details, 'I', i FROM rep0""",
    "rep2": """SELECT year, estimate_type, location, details, sex, try_cast(n AS double) AS n, 22 AS pfma,
        'Nitinat' AS stock, CASE WHEN estimate_type = 'TOTAL NATURAL SPAWNING RIVER POPULATION' THEN 'escapement'
          WHEN estimate_type LIKE '%FRESH WATER SPORT FISHERY%' THEN 'sport'
          WHEN estimate_type LIKE '%NATIVE FISHERY%' THEN 'FN'
          WHEN estimate_type LIKE '%FISH REMOVED%' THEN 'escapement' END AS sector FROM rep1""",
    "rep3": """SELECT *, CASE
          WHEN estimate_type = 'TOTAL NATURAL SPAWNING RIVER POPULATION' AND location LIKE '%River%'
            THEN 'escapement Nitinat River Spawners'
          WHEN estimate_type = 'FISH REMOVED FROM THE SYSTEM:' AND details LIKE '%surplus%' THEN 'escapement ESSR'
          WHEN sector = 'escapement' AND (details LIKE '%for broodstock%' OR details LIKE '%given to natives%'
            OR details LIKE '%other purposes%') THEN 'escapement Hatchery broodstock, morts'
          WHEN sector = 'sport' AND location LIKE '%River%' THEN 'sport Area 22 Nitinat River'
          WHEN sector = 'FN' AND details LIKE '%ESSR%' THEN 'FN EO (Native ESSR)'
          WHEN sector = 'FN' AND details LIKE '%Food Fish%' THEN 'FN FSC' END AS run_recon_area,
        CASE WHEN sector IN ('sport', 'FN') THEN 'September'
             WHEN estimate_type = 'FISH REMOVED FROM THE SYSTEM:' THEN 'September'
             WHEN estimate_type = 'TOTAL NATURAL SPAWNING RIVER POPULATION' THEN 'October' END AS month,
        CASE WHEN sector IN ('sport', 'FN') THEN 'catch' WHEN sector = 'escapement' THEN 'escapement' END
          AS input_data_type,
        CASE WHEN sector = 'sport' THEN '22A' END AS creel_sub_area FROM rep2""",
    "rep": f"SELECT *, CASE WHEN run_recon_area IS NOT NULL THEN {UFID} END AS ufid FROM rep3",
}
STRICT_SUM = "CASE WHEN count(n) = count(*) THEN sum(n) END"
REPORT_TOTALS = {
    "river": f"""SELECT pfma, year, sector, run_recon_area, ufid, month, creel_sub_area, input_data_type,
        {STRICT_SUM} AS kept, {STRICT_SUM} AS total FROM rep
        WHERE run_recon_area = 'sport Area 22 Nitinat River' AND sex IN ('M','F','U') GROUP BY ALL""",
    "fn": f"""SELECT pfma, year, sector, run_recon_area, ufid, month, input_data_type,
        {STRICT_SUM} AS kept, {STRICT_SUM} AS total FROM rep
        WHERE sector = 'FN' AND run_recon_area IS NOT NULL AND sex IN ('M','F','U') GROUP BY ALL""",
    "esc": f"""SELECT pfma, year, sector, run_recon_area, ufid, month, input_data_type, sex,
        {STRICT_SUM} AS total FROM rep
        WHERE sector = 'escapement' AND run_recon_area IS NOT NULL AND sex IN ('M','F','U','J') GROUP BY ALL""",
}


def located(rows: str, sector: str, keys: tuple[str, ...]) -> str:
    return (
        f"SELECT a.*, l.lat, l.long FROM ({rows}) a LEFT JOIN (SELECT * FROM v_lookup WHERE sector = '{sector}') l "
        f"ON {same('a', 'l', *keys)}"
    )


CONUMA_CATCH = {
    **sport_sql(CONUMA_AREA),
    **mortality_sql("pfma = 25 AND year BETWEEN 1997 AND 2000"),
    **COMM,
    **BLOCKS,
    "g1": located("SELECT * FROM mort", "sport", ("sector", "run_recon_area", "creel_sub_area")),
    "g2": located("SELECT * FROM comm_mort WHERE pfma = 25", "commercial", ("sector", "run_recon_area")),
    "g3": located(
        "SELECT *, kept AS total_mort FROM five WHERE month IN ('June','July','August','September')", "5 Nations EO",
        ("sector", "run_recon_area"),
    ),
    "whole": "SELECT * FROM g1 UNION ALL BY NAME SELECT * FROM g2 UNION ALL BY NAME SELECT * FROM g3",
    "caught": f"SELECT *, {pasted('run_recon_area', 'input_data_type')} AS label FROM whole",
}
CONUMA_CATCH_VIEWS = f"v_catch v_commercial v_lookup {BLOCK_VIEWS}"
NITINAT_CATCH = {
    **sport_sql(NITINAT_AREA),
    **mortality_sql("pfma IN (21, 22) AND year BETWEEN 1997 AND 2001", "total"),
    **REPORT,
    **REPORT_TOTALS,
    "g1": located("SELECT * FROM mort", "sport", ("sector", "run_recon_area", "creel_sub_area")),
    "g2": located("SELECT * FROM river", "sport", ("sector", "run_recon_area", "creel_sub_area")),
    "g3": located("SELECT * FROM fn", "FN", ("sector", "run_recon_area")),
    "g4": located("SELECT * FROM esc", "escapement", ("sector", "run_recon_area")),
    "whole": "SELECT * FROM g1 UNION ALL BY NAME SELECT * FROM g2 UNION ALL BY NAME SELECT * FROM g3 "
    "UNION ALL BY NAME SELECT * FROM g4",
    "caught": f"SELECT *, {pasted('run_recon_area', 'input_data_type')} AS label FROM whole",
}
NITINAT_CATCH_VIEWS = "v_catch v_report v_lookup"

_sport = sport_sql(CONUMA_AREA)
ORACLES["sport_catch"] = steps("SELECT * FROM sport", "v_catch", **_sport)
ORACLES["area_lookup"] = steps(
    "SELECT creel_sub_area, "
    + CONUMA_AREA.format(
        c="creel_sub_area",
        more="WHEN creel_sub_area IN ('21A','21B','Area 21') THEN 'sport Area 21 Terminal' "
        "WHEN creel_sub_area = '121C' THEN 'sport Outer Nitinat corridor' "
        "WHEN creel_sub_area = '22A' THEN 'sport Nitinat Lake and River'",
    )
    + " AS run_recon_area, count(*) AS n FROM v_catch GROUP BY 1, 2",
    "v_catch",
)
ORACLES["fishery_region"] = steps(
    f"SELECT *, {pasted('pfma', 'month', sep=', ')} AS pfma_month, "
    f"{pasted('fish_cat_reg', 'month', sep=', ')} AS region_month FROM r",
    "v_catch",
    r="""SELECT *, CASE
        WHEN pfma = 'PFMA 10' THEN 'outSmith(10)'
        WHEN pfma IN ('PFMA 11','PFMA 111') THEN 'upperQCS(11,111)'
        WHEN pfma = 'PFMA 12' THEN 'nJST(12)'
        WHEN pfma IN ('PFMA 13','PFMA 14','PFMA 15','PFMA 16') THEN 'nGST(13,14,15,16)'
        WHEN pfma IN ('PFMA 17','PFMA 18','PFMA 28','PFMA 29') OR creel_sub_area IN ('19A','19B','Area 19 (GS)')
          THEN 'sGST(17,18,19AB,28,29)'
        WHEN creel_sub_area IN ('20DB','20DI','20DO','19C','19D','19E','20C','20D','Area 19 (JDF)','Area 20 (East)')
          THEN 'JDFeast(19CDE,20CD)'
        WHEN creel_sub_area IN ('20A','20B','20E','Area 20 (West)','Area 20 (WCVI)') THEN 'JDFwest(Renfrew 20ABE)'
        WHEN pfma = 'PFMA 21' THEN 'Nitinat'
        WHEN pfma = 'PFMA 23' AND creel_sub_area IN ('23A','23B','Area 23 (Alberni Canal)') THEN 'Alberni(23A,B)'
        WHEN pfma = 'PFMA 23' AND (regexp_full_match(creel_sub_area, '23[C-Q]')
          OR creel_sub_area IN ('Area 23','Area 23 (Barkley)')) THEN 'Barkley(23C-Q)'
        WHEN pfma = 'PFMA 24' THEN 'Clayoquot' WHEN pfma = 'PFMA 25' THEN 'Nootka/Esp'
        WHEN pfma = 'PFMA 26' THEN 'Kyuquot' WHEN pfma = 'PFMA 27' THEN 'Quatsino'
        WHEN pfma IN ('PFMA 121','PFMA 122','PFMA 123','PFMA 124') THEN 'SWVIoutside-1nm121-124'
        WHEN pfma IN ('PFMA 125','PFMA 126','PFMA 127') THEN 'NWVI-1nm-corridor125-127'
        WHEN contains(pfma, 'US7') THEN 'US7' END AS fish_cat_reg FROM v_catch""",
)
ORACLES["sport_mortality"] = steps("SELECT * FROM mort", "v_catch", **_sport, **mortality_sql("true"))
ORACLES["sport_totals"] = steps(
    "SELECT * FROM mort", "v_catch", **_sport, **mortality_sql("pfma = 25 AND year BETWEEN 1997 AND 2000")
)
ORACLES["stat_week"] = steps(
    f"SELECT fishing_date, count(*) AS n, {week_sql('fishing_date')} AS statweek FROM v_commercial GROUP BY fishing_date",
    "v_commercial",
)
ORACLES["commercial_catch"] = steps("SELECT * FROM comm", "v_commercial", **COMM)
ORACLES["commercial_mortality"] = steps("SELECT * FROM comm_mort", "v_commercial", **COMM)
ORACLES["nations_catch"] = steps("SELECT * FROM five", BLOCK_VIEWS, **BLOCKS)
ORACLES["hatchery_report"] = steps("SELECT * FROM rep", "v_report", **REPORT)
for _name, _cte in (("river_sport_total", "river"), ("fn_total", "fn"), ("escapement_total", "esc")):
    ORACLES[_name] = steps(f"SELECT * FROM {_cte}", "v_report", **REPORT, **REPORT_TOTALS)
ORACLES["report_totals"] = steps(
    "SELECT * FROM river UNION ALL BY NAME SELECT * FROM fn UNION ALL BY NAME SELECT * FROM esc", "v_report",
    **REPORT, **REPORT_TOTALS,
)
ORACLES["compile_catch"] = steps("SELECT * FROM caught", CONUMA_CATCH_VIEWS, **CONUMA_CATCH)
ORACLES["compile_catch_nitinat"] = steps("SELECT * FROM caught", NITINAT_CATCH_VIEWS, **NITINAT_CATCH)
ORACLES["hot_full_join"] = steps(
    "SELECT coalesce(k.month, d.month) AS month, licence_area, count(*) AS n, sum(estimate) AS estimate, sum(days) AS days "
    "FROM k FULL JOIN d ON k.month IS NOT DISTINCT FROM d.month GROUP BY 1, 2",
    "v_catch v_commercial",
    k="SELECT month, pfma, creel_sub_area, sum(estimate) AS estimate FROM v_catch GROUP BY ALL",
    d="SELECT strftime(fishing_date, '%B') AS month, licence_area, count(*) AS days FROM v_commercial GROUP BY ALL",
)
ORACLES["sport_dispositions"] = steps(
    "SELECT year, month, pfma, "
    + ", ".join(
        f"sum(estimate) FILTER (WHERE disposition = '{d}') AS {d.lower().replace(' ', '_').replace('-', '_')}"
        for d in ("Kept", "Released Legal", "Released Sub-legal", "Released Unknown")
    )
    + ", sum(estimate) FILTER (WHERE disposition IS NULL) AS undeclared FROM v_catch GROUP BY year, month, pfma",
    "v_catch",
)
ORACLES["natural_full_join"] = steps(
    f"SELECT coalesce(k.creel_sub_area, p.creel_sub_area) AS creel_sub_area, estimate, run_recon_area, lat "
    f"FROM k FULL JOIN p ON {same('k', 'p', 'creel_sub_area')}",
    "v_catch v_lookup",
    k="SELECT creel_sub_area, sum(estimate) AS estimate FROM v_catch GROUP BY creel_sub_area",
    p="SELECT creel_sub_area, run_recon_area, lat FROM v_lookup WHERE sector = 'sport'",
)

# Biological samples

SAMPLE_SUB_AREAS = (
    "'25PI','25JO','125Q','25JI','25L','25N','25PO','25F','125A','25E','25D','125G','125K','25O','25I'"
)
UNUSED = "otolith_box, otolith_specimen, thermalmark, scale_book, part_age_code, cwt_head_label, specimen_reference_dna_no"


def samples_sql(area: str, sub_areas: str, where: str) -> dict[str, str]:
    return {
        "bio0": f"""SELECT * EXCLUDE ({UNUSED}),
            CASE WHEN resolved_age IS NOT NULL AND resolved_stock_origin IS NOT NULL THEN 'age and stock comp'
                 WHEN resolved_age IS NOT NULL THEN 'age'
                 WHEN resolved_stock_origin IS NOT NULL THEN 'stock comp' END AS input_data_type,
            CASE WHEN sample_type LIKE '%TROLL%' THEN 'Troll' WHEN sample_type LIKE '%SEINE%' THEN 'Seine'
                 WHEN sample_type LIKE '%GILL NET%' THEN 'Gillnet' END AS gear,
            CASE WHEN sample_type = 'Sport' THEN 'sport'
                 WHEN sample_type LIKE '%GILL NET%' OR sample_type LIKE '%TROLL%' THEN 'commercial'
                 WHEN sample_type = 'Escapement' THEN 'escapement' END AS sector
            FROM v_samples WHERE {where}""",
        "bio1": f"""SELECT * EXCLUDE (run_recon_area, area, dna_results_stock_1), dna_results_stock_1 AS dna_stock_1,
            try_cast(area AS int) AS pfma,
            CASE WHEN sector = 'sport' AND subarea IN ({sub_areas}) THEN subarea END AS creel_sub_area,
            CASE WHEN sector = 'commercial' THEN {week_sql('collection_date')} END AS statweek,
            {area} AS run_recon_area FROM bio0""",
        "bio": f"""SELECT *, CASE WHEN sector = 'commercial' THEN {UFID_WEEK}
            WHEN sector IN ('sport', 'escapement') THEN {UFID} END AS ufid FROM bio1""",
    }


CONUMA_SAMPLE_AREA = (
    "CASE WHEN sector = 'sport' THEN "
    + CONUMA_AREA.format(c="subarea", more="")
    + " WHEN sector = 'commercial' THEN 'commercial ' || coalesce(gear, 'NA') || ' ' || "
    "coalesce(CASE run_recon_area WHEN 'Tlupana Inlet' THEN 'Tlupana' ELSE run_recon_area END, 'NA') "
    "WHEN sector = 'escapement' AND landing_site = 'Conuma R' THEN 'escapement Conuma R' "
    "WHEN sector = 'escapement' AND landing_site IS NOT NULL THEN 'escapement Misc ' || landing_site END"
)
CONUMA_SAMPLES = samples_sql(
    CONUMA_SAMPLE_AREA, SAMPLE_SUB_AREAS, "subarea IS NULL OR NOT contains(subarea, 'Area 26')"
)
NITINAT_SAMPLES = samples_sql(
    "CASE WHEN sector = 'sport' THEN " + NITINAT_AREA.format(c="subarea") + " END",
    SAMPLE_SUB_AREAS + ",'21A','21B','22A','121C'", "true",
)
MONTH_TEXT = (
    "CASE WHEN collection LIKE '%Jun%' THEN 'June' WHEN collection LIKE '%Jul%' THEN 'July' "
    "WHEN collection LIKE '%Aug%' THEN 'August' WHEN collection LIKE '%Sep%' THEN 'September' END"
)


def region(c: str) -> str:
    return f"CASE {c} WHEN 'NoKy' THEN 'NWVI' WHEN 'SWVI' THEN 'SWVI' WHEN 'NPS' THEN 'Puget Sound' END"


GSI = {
    "gsi": f"""SELECT 'stock comp' AS input_data_type, {MONTH_TEXT} AS month, 1999 AS year,
        'DNA-' || id_source AS resolved_stock_source,
        CASE WHEN id_source = 'PBT' THEN 'Y' ELSE 'N' END AS hatchery_origin, '5 Nations EO' AS sector, 25 AS pfma,
        '5 Nations Outer Nootka' AS run_recon_area, {region('repunit_1')} AS region_1_rollup,
        {region('repunit_2')} AS region_2_rollup, collection_1 AS dna_stock_1, collection_2 AS dna_stock_2, prob_1, prob_2,
        CASE WHEN prob_1 >= 75 THEN {title("replace(collection_1, '_', ' ')")} END AS resolved_stock_origin,
        CASE WHEN prob_1 >= 75 THEN {region('repunit_1')} END AS resolved_stock_rollup
        FROM v_gsi WHERE id_source <> 'likely_duplicate'""",
}
CONUMA_BIO = {
    **CONUMA_SAMPLES,
    **GSI,
    "b1": located("SELECT * FROM bio WHERE sector = 'sport' AND pfma = 25", "sport", ("sector", "creel_sub_area")),
    "b2": located(
        "SELECT * FROM bio WHERE sector = 'commercial' AND pfma = 25", "commercial", ("sector", "run_recon_area")
    ),
    "b3": located("SELECT * FROM bio WHERE sector = 'escapement'", "escapement", ("sector", "run_recon_area")),
    "b4": located("SELECT * FROM gsi", "5 Nations EO", ("sector", "run_recon_area")),
    "whole_bio": "SELECT * FROM b1 UNION ALL BY NAME SELECT * FROM b2 UNION ALL BY NAME SELECT * FROM b3 "
    "UNION ALL BY NAME SELECT * FROM b4",
    "sampled": f"SELECT *, {pasted('run_recon_area', 'input_data_type')} AS label FROM whole_bio",
}
CONUMA_BIO_VIEWS = "v_samples v_gsi v_lookup"

ORACLES["biosamples"] = steps("SELECT * FROM bio", "v_samples", **CONUMA_SAMPLES)
ORACLES["biosamples_nitinat"] = steps("SELECT * FROM bio", "v_samples", **NITINAT_SAMPLES)
ORACLES["georeference"] = steps(
    located(
        "SELECT sector, creel_sub_area, run_recon_area, ufid, resolved_age FROM bio WHERE sector = 'sport'", "sport",
        ("sector", "creel_sub_area"),
    ),
    "v_samples v_lookup", **CONUMA_SAMPLES,
)
ORACLES["gsi_results"] = steps("SELECT * FROM gsi", "v_gsi", **GSI)
ORACLES["pbt_ages"] = steps(
    f"SELECT resolved_stock_origin, resolved_stock_rollup, resolved_age, month, 'DNA-PBT' AS resolved_stock_source "
    "FROM p, generate_series(1, n)",
    "v_pbt",
    p=f"""SELECT {title("replace(collection, '_', ' ')")} AS resolved_stock_origin,
        {region('repunit')} AS resolved_stock_rollup, age AS resolved_age, 'July' AS month, jul AS n FROM v_pbt
        WHERE jul IS NOT NULL
        UNION ALL SELECT {title("replace(collection, '_', ' ')")}, {region('repunit')}, age, 'August', aug FROM v_pbt
        WHERE aug IS NOT NULL""",
)
ORACLES["compile_biodata"] = steps("SELECT * FROM sampled", CONUMA_BIO_VIEWS, **CONUMA_BIO)
ORACLES["compile_biodata_nitinat"] = steps(
    f"SELECT *, {pasted('run_recon_area', 'input_data_type')} AS label FROM b1", "v_samples v_lookup",
    **NITINAT_SAMPLES,
    b1=located("SELECT * FROM bio WHERE sector = 'sport' AND pfma IN (21, 22)", "sport", ("sector", "creel_sub_area")),
)
ORACLES["sample_overview"] = steps(
    "SELECT year, sample_type, count(*) AS n FROM v_samples GROUP BY year, sample_type", "v_samples"
)
ORACLES["thermal_marks"] = steps(
    "SELECT *, 'stock composition' AS input_data_type FROM v_readings WHERE species = 'Chinook'", "v_readings"
)
ORACLES["age_composition"] = steps(
    "SELECT fiscal_year, esc_location, gr_age2, project, age_n, age_total, age_n / age_total AS age_propn, "
    "'SEP Conuma Hatchery broodstock age data, ' || esc_location AS age_data_source, 'age' AS data_class FROM t",
    "v_ages",
    a="""SELECT fiscal_year, location AS esc_location, project, CASE WHEN gr_age IN ('21','1M') THEN 2
        WHEN gr_age IN ('31','2M') THEN 3 WHEN gr_age IN ('41','3M') THEN 4 WHEN gr_age IN ('51','4M') THEN 5 END
        AS gr_age2 FROM v_ages WHERE fiscal_year = 2021 AND project = 'CONUMA RIVER HATCHERY -2021'
        AND geographic_location = 'WCVI' AND gr_age IN ('21','31','41','51','1M','2M','3M','4M')""",
    t="""SELECT DISTINCT *, count(*) OVER (PARTITION BY fiscal_year, esc_location, gr_age2, project) AS age_n,
        count(*) OVER (PARTITION BY fiscal_year, esc_location) AS age_total FROM a""",
)

# Sample sufficiency

SUFFICIENCY = {
    **CONUMA_CATCH,
    **CONUMA_BIO,
    "totals": """SELECT sector, run_recon_area, ufid, coalesce(sum(kept), 0) AS total_kept FROM caught
        WHERE run_recon_area IS NOT NULL AND year = 2000 GROUP BY ALL HAVING coalesce(sum(kept), 0) > 0""",
    "ages": """SELECT sector, run_recon_area, ufid, count(*) AS n_age_samples FROM sampled
        WHERE run_recon_area IS NOT NULL AND resolved_age IS NOT NULL GROUP BY ALL""",
    "stocks": """SELECT run_recon_area, ufid, count(*) AS n_stockcomp_samples FROM sampled
        WHERE run_recon_area IS NOT NULL AND resolved_stock_origin IS NOT NULL GROUP BY ALL""",
    "enough": f"""SELECT t.*, n_age_samples, n_stockcomp_samples,
        CASE WHEN n_age_samples IS NULL OR n_age_samples < 10 THEN 'FLAG' END AS age_samplesize_flag,
        CASE WHEN n_stockcomp_samples IS NULL OR n_stockcomp_samples < 10 THEN 'FLAG' END AS stockcomp_samplesize_flag
        FROM totals t LEFT JOIN ages a ON {same('t', 'a', 'sector', 'run_recon_area', 'ufid')}
        LEFT JOIN stocks s ON {same('t', 's', 'run_recon_area', 'ufid')}""",
    "orphans": "SELECT * FROM enough WHERE age_samplesize_flag = 'FLAG' OR stockcomp_samplesize_flag = 'FLAG'",
}
_suff_views = f"{CONUMA_CATCH_VIEWS} v_samples v_gsi"


def suff(final: str) -> str:
    return steps(final, _suff_views, **SUFFICIENCY)


ORACLES["sample_sufficiency"] = suff("SELECT * FROM enough")
ORACLES["orphan_ufids"] = suff("SELECT * FROM orphans")
ORACLES["orphan_candidates"] = suff(
    "SELECT * FROM sampled WHERE run_recon_area IN (SELECT run_recon_area FROM orphans)"
)
ORACLES["missed_samples"] = suff(
    "SELECT run_recon_area, ufid, count(*) AS n FROM sampled WHERE year = 2000 AND run_recon_area IN "
    "(SELECT run_recon_area FROM orphans WHERE n_age_samples IS NULL OR n_stockcomp_samples IS NULL) GROUP BY ALL"
)
ORACLES["orphan_table"] = suff(
    "SELECT * REPLACE (coalesce(n_age_samples, 0) AS n_age_samples, "
    "coalesce(n_stockcomp_samples, 0) AS n_stockcomp_samples) FROM orphans"
)
ORACLES["fishery_counts"] = steps(
    "SELECT sector, run_recon_area, ufid, year, count(*) AS n, count(resolved_age) AS age, "
    "count(resolved_stock_origin) AS stock FROM sampled GROUP BY ALL",
    CONUMA_BIO_VIEWS, **CONUMA_BIO,
)
ORACLES["orphan_display"] = suff(
    'SELECT sector AS "Sector", run_recon_area AS "Run reconstruction area", ufid, total_kept AS "CK caught in 2000", '
    'coalesce(n_age_samples, 0) AS "# Resolved age samples", coalesce(n_stockcomp_samples, 0) AS "# Resolved stock comp samples", '
    'age_samplesize_flag AS "Flag for # age samples (<10)", '
    'stockcomp_samplesize_flag AS "Flag for # stock comp samples (<10)" FROM orphans'
)
ORACLES["sectors"] = steps("SELECT DISTINCT sector FROM caught", CONUMA_CATCH_VIEWS, **CONUMA_CATCH)

# Review tables


def points_sql(column: str, year: int) -> str:
    return f"""SELECT *, CASE WHEN {column} < 500 THEN 4 WHEN {column} < 1000 THEN 7 WHEN {column} < 1500 THEN 10
        ELSE 14 END AS radius FROM (SELECT sector, run_recon_area, lat, long, label, coalesce(sum({column}), 0)
        AS {column} FROM caught WHERE year = {year} AND run_recon_area IS NOT NULL GROUP BY ALL) p WHERE {column} > 0"""


ORACLES["catch_points"] = steps(points_sql("kept", 2000), CONUMA_CATCH_VIEWS, **CONUMA_CATCH)
POINT = "year, sector, run_recon_area, creel_sub_area, lat, long"


def sample_points_sql(years: str) -> str:
    return steps(
        "SELECT l.*, n, CASE WHEN n < 10 THEN 3 WHEN n < 50 THEN 6 WHEN n < 75 THEN 8 WHEN n < 100 THEN 10 ELSE 12 END "
        f"AS radius FROM l JOIN c ON {same('l', 'c', *POINT.split(', '))}",
        CONUMA_BIO_VIEWS, **CONUMA_BIO,
        s=f"SELECT {POINT}, label FROM sampled WHERE lat IS NOT NULL AND year IN ({years})",
        l="SELECT DISTINCT * FROM s",
        c=f"SELECT {POINT}, count(*) AS n FROM s GROUP BY {POINT}",
    )


ORACLES["sample_points"] = sample_points_sql("1999")
ORACLES["sample_points_all_years"] = sample_points_sql("1997, 1998, 1999, 2000")
ORACLES["temporal_catch"] = steps(
    "SELECT year, sector, run_recon_area, CASE WHEN month IN ('May','June','July','August','September','October') "
    "THEN month END AS month, sum(kept) AS kept FROM caught WHERE run_recon_area IS NOT NULL AND year = 2000 "
    "AND kept > 0 GROUP BY 1, 2, 3, 4",
    CONUMA_CATCH_VIEWS, **CONUMA_CATCH,
)
ORACLES["temporal_samples"] = steps(
    "SELECT year, sector, run_recon_area, month, count(*) AS n, CASE WHEN count(*) > 10 THEN '>10' "
    "WHEN count(*) < 10 THEN '<10' END AS sample_class FROM sampled WHERE run_recon_area IS NOT NULL "
    "GROUP BY year, sector, run_recon_area, month",
    CONUMA_BIO_VIEWS, **CONUMA_BIO,
)
ORACLES["temporal_catch_nitinat"] = steps(
    "SELECT year, sector, run_recon_area, CASE WHEN month IN ('May','June','July','August','September','October') "
    "THEN month END AS month, sum(total) AS total FROM caught WHERE run_recon_area IS NOT NULL AND year = 2001 "
    "AND total > 0 GROUP BY 1, 2, 3, 4",
    NITINAT_CATCH_VIEWS, **NITINAT_CATCH,
)
ORACLES["temporal_samples_nitinat"] = steps(
    "SELECT year, sector, run_recon_area, month, count(*) AS n, CASE WHEN count(*) > 10 THEN '>10' "
    "WHEN count(*) < 10 THEN '<10' END AS sample_class FROM b1 WHERE run_recon_area IS NOT NULL "
    "GROUP BY year, sector, run_recon_area, month",
    "v_samples v_lookup", **NITINAT_SAMPLES,
    b1=located("SELECT * FROM bio WHERE sector = 'sport' AND pfma IN (21, 22)", "sport", ("sector", "creel_sub_area")),
)
ORACLES["ufid_table"] = steps(
    "SELECT sector, run_recon_area, ufid, coalesce(sum(kept), 0) AS total_kept FROM caught "
    "WHERE run_recon_area IS NOT NULL AND year = 2000 GROUP BY ALL HAVING coalesce(sum(kept), 0) > 0",
    CONUMA_CATCH_VIEWS, **CONUMA_CATCH,
)
ORACLES["ufid_table_nitinat"] = steps(
    "SELECT sector, run_recon_area, ufid, coalesce(sum(total), 0) AS total_kept FROM caught "
    "WHERE run_recon_area IS NOT NULL AND year = 2001 GROUP BY ALL",
    NITINAT_CATCH_VIEWS, **NITINAT_CATCH,
)

# Whole runs


def stacked(**tables: str) -> str:
    """All tables in one; a name's underscores stand for the blanks of the table's."""
    return " UNION ALL BY NAME ".join(
        f"SELECT '{name.replace('_', ' ')}' AS table_name, * FROM ({sql}) t" for name, sql in tables.items()
    )


ORACLES["conuma_report"] = stacked(
    **{"catch": ORACLES["compile_catch"], "samples": ORACLES["compile_biodata"]},
    sample_overview=steps("SELECT year, sample_type, count(*) AS n FROM bio GROUP BY ALL", "v_samples", **CONUMA_SAMPLES),
    sufficiency=ORACLES["sample_sufficiency"], orphans=ORACLES["orphan_ufids"], orphan_table=ORACLES["orphan_table"],
    orphan_candidates=ORACLES["orphan_candidates"], missed_samples=ORACLES["missed_samples"],
    catch_points=ORACLES["catch_points"], temporal_catch=ORACLES["temporal_catch"],
    temporal_samples=ORACLES["temporal_samples"], fisheries=ORACLES["ufid_table"],
    **{f"sample_points_{back}": sample_points_sql(str(2000 - back)) for back in range(4)},
)


def nitinat_points_sql(year: int) -> str:
    return steps(
        "SELECT l.*, n, CASE WHEN n < 10 THEN 3 WHEN n < 50 THEN 6 WHEN n < 75 THEN 8 WHEN n < 100 THEN 10 ELSE 12 END "
        f"AS radius FROM l JOIN c ON {same('l', 'c', *POINT.split(', '))}",
        "v_samples v_lookup", **NITINAT_SAMPLES,
        b1=located("SELECT * FROM bio WHERE sector = 'sport' AND pfma IN (21, 22)", "sport", ("sector", "creel_sub_area")),
        s=f"SELECT {POINT}, {pasted('run_recon_area', 'input_data_type')} AS label FROM b1 WHERE lat IS NOT NULL AND year = {year}",
        l="SELECT DISTINCT * FROM s",
        c=f"SELECT {POINT}, count(*) AS n FROM s GROUP BY {POINT}",
    )


ORACLES["nitinat_report"] = stacked(
    **{"catch": ORACLES["compile_catch_nitinat"], "samples": ORACLES["compile_biodata_nitinat"]},
    catch_points=steps(points_sql("total", 2001), NITINAT_CATCH_VIEWS, **NITINAT_CATCH),
    temporal_catch=ORACLES["temporal_catch_nitinat"], temporal_samples=ORACLES["temporal_samples_nitinat"],
    fisheries=ORACLES["ufid_table_nitinat"], **{f"sample_points_{back}": nitinat_points_sql(2001 - back) for back in range(2)},
)

# Stock groups

STREAMS = {
    "st0": "SELECT DISTINCT waterbody_name, area FROM v_streams",
    "st1": f"""SELECT {title('waterbody_name')} AS name, try_cast(regexp_replace(area, '[A-z]+', '', 'g') AS int) AS area
        FROM st0""",
    "streams": """SELECT replace(CASE name WHEN 'Qualicum River' THEN 'Big Qualicum River'
        WHEN 'Tranquil Creek' THEN 'Tranquil River' ELSE name END, 'Toquart', 'Toquaht') AS resolved_stock_origin,
        area AS area_origin FROM st1 WHERE name <> 'Salmon River' AND area <> 29
        UNION ALL SELECT 'Robertson Creek', 23 UNION ALL SELECT 'Omega Pacific Hatchery', 23""",
}


def group_sql(focal: str) -> str:
    return (
        f"CASE WHEN resolved_stock_origin IS NULL OR stock_group = 'NON-WCVI' OR stock_group IN ({focal}) "
        "THEN term_sum WHEN area_origin IN (23, 25) THEN hat_nat || ' Other Area ' || area_origin "
        "ELSE hat_nat || ' Other WCVI' END"
    )


ORACLES["stream_areas"] = steps("SELECT * FROM streams", "v_streams", **STREAMS)
ORACLES["code_stock_groups"] = steps(
    "SELECT *, CASE WHEN term_con = term_nit THEN 'TRUE' END AS qc_term_con_nit, "
    "CASE WHEN term_con = term_area23 THEN 'TRUE' END AS qc_term_con_23, "
    "CASE WHEN term_nit = term_area23 THEN 'TRUE' END AS qc_term_nit_23 FROM coded",
    "v_samples v_streams",
    **STREAMS,
    c0="""SELECT b.*, area_origin,
        CASE WHEN hatchery_origin = 'Y' THEN 'Hatchery'
             WHEN adipose_fin_clipped = 'N' AND thermalmark = 'Not Marked' THEN 'Natural' ELSE 'Unknown' END AS hat_nat,
        CASE WHEN b.resolved_stock_origin IS NULL THEN 'Unknown'
             WHEN resolved_stock_rollup IS NULL OR resolved_stock_rollup NOT IN ('NWVI', 'SWVI') THEN 'NON-WCVI'
             WHEN b.resolved_stock_origin = 'Tofino Hatchery' THEN 'BEDWELL'
             ELSE upper(regexp_replace(b.resolved_stock_origin, '\\b( River| Creek)\\b', '', 'g')) END AS stock_group
        FROM v_samples b LEFT JOIN streams s ON b.resolved_stock_origin IS NOT DISTINCT FROM s.resolved_stock_origin""",
    c1="SELECT *, hat_nat || ' ' || stock_group AS term_sum FROM c0",
    coded="SELECT *, "
    + group_sql("'BEDWELL','BURMAN','CONUMA','KAOUK','MARBLE','NITINAT','ROBERTSON','SAN JUAN'") + " AS term_con, "
    + group_sql("'CONUMA','NITINAT','ROBERTSON','SAN JUAN'") + " AS term_nit, "
    + group_sql("'CONUMA','NITIANT','ROBERTSON'") + " AS term_area23 FROM c1",
)

# Hatchery linkage

SCALE_KEYS = """{book} AS r_scale_book_num, {cell} AS r_scale_cell_num, {book} || '-' || {cell} AS r_scale_book_cell_concat"""
OTOLITH_KEYS = """{box} AS r_otolith_box_num, {vial} AS r_otolith_vial_num, {box} || '-' || {vial} AS r_otolith_box_vial_concat"""
HATCHERY = {
    "hs": "SELECT *, " + SCALE_KEYS.format(book="book_no", cell="scale_sample_no") + ", "
    + OTOLITH_KEYS.format(box="bag_no", vial="vial_no")
    + ", cwt_tag_code AS r_tagcode FROM v_hatchery WHERE spawning_stock <> ''",
}
BATCHES = {
    "ids": "SELECT id FROM v_batches WHERE sector = 'SC' AND sample_year = 2022",
    "rd": "SELECT r.* FROM v_readings r WHERE id IN (SELECT id FROM ids)",
    "cn": """SELECT * REPLACE (cast(field_container_id AS varchar) AS field_container_id,
        cast(analyst_name AS varchar) AS analyst_name, cast(cnt_start_date AS date) AS cnt_start_date,
        cast(cnt_end_date AS date) AS cnt_end_date) FROM v_containers WHERE batch_id IN (SELECT id FROM ids)""",
}
SCALES = {
    **BATCHES,
    "bc": """SELECT coalesce(b.id, c.batch_id) AS batch_id, p.location, b.project_name, b.region, b.area, b.species,
        b.recovery_year, b.life_history, c.id AS container_id, c.field_container_id, c.container_notes, c.analyst_name,
        c.cnt_start_date, c.cnt_end_date
        FROM (SELECT * FROM v_batches WHERE id IN (SELECT id FROM ids)) b JOIN v_projects p ON p.id = b.id
        FULL JOIN cn c ON c.batch_id = b.id""",
    "sc0": f"""SELECT coalesce(bc.batch_id, r.batch_id) AS batch_id, location,
        coalesce(bc.project_name, r.project_name) AS project_name, coalesce(bc.region, r.region) AS region,
        coalesce(bc.area, r.area) AS area, coalesce(bc.species, r.species) AS species,
        coalesce(bc.recovery_year, r.recovery_year) AS recovery_year,
        coalesce(bc.life_history, r.life_history) AS life_history,
        coalesce(bc.container_id, r.container_id) AS container_id, field_container_id, container_notes, analyst_name,
        cnt_start_date, cnt_end_date, fish_number, gr_age, scale_condition
        FROM bc FULL JOIN (SELECT id AS batch_id, * EXCLUDE (id) FROM rd) r
        ON {same('bc', 'r', 'batch_id', 'project_name', 'region', 'area', 'species', 'recovery_year', 'life_history',
                 'container_id')}""",
    "sc": "SELECT *, " + SCALE_KEYS.format(book="container_id", cell="fish_number") + " FROM sc0",
}
SCALE_VIEWS = "v_batches v_projects v_containers v_readings"
OTOLITHS = {
    "oto": "SELECT * REPLACE (CASE facility WHEN 'H-ROBERTSON CR' THEN 'H-ROBERTSON CREEK H' "
    "WHEN 'H-CONUMA R ' THEN 'H-CONUMA RIVER H ' ELSE facility END AS facility), "
    + OTOLITH_KEYS.format(box="box_code", vial="cell_number") + " FROM v_otoliths",
}
TAGS = {
    "tags": """SELECT tagcode, tagcode AS r_tagcode, species_name AS tag_species_name, project_name AS tag_project_name,
        brood_year AS tag_brood_year, release_year AS tag_release_year, stock_site_name AS tag_stock_site_name,
        stock_psc_region_name AS tag_stock_psc_region_name, hatchery_site_name AS tag_hatchery_site_name,
        hatchery_psc_region_name AS tag_hatchery_psc_region_name, release_site_name AS tag_release_site_name,
        release_psc_region_name AS tag_release_psc_region_name, stage_code AS tag_stage_code FROM v_tags""",
}
MARKS = {
    "marks": """SELECT brood_year, agency, facility, release_year, stock, hatch_code, state_province, site,
        brood_year AS r_brood_year, hatch_code AS r_hatch_code FROM v_marks WHERE state_province <> 'ALASKA'""",
}
LINK_SCALES = {
    "ls": "SELECT h.*, s.* EXCLUDE (r_scale_book_num, r_scale_cell_num, r_scale_book_cell_concat) FROM hs h "
    f"LEFT JOIN sc s ON {equal('h', 's', 'r_scale_book_num', 'r_scale_cell_num')}",
}


def link_otolith_sql(left: str) -> str:
    return (
        f"SELECT h.*, o.* EXCLUDE (r_otolith_box_num, r_otolith_vial_num, r_otolith_box_vial_concat) FROM {left} h "
        f"LEFT JOIN oto o ON {equal('h', 'o', 'r_otolith_box_num', 'r_otolith_vial_num', 'r_otolith_box_vial_concat')}"
    )


RESOLVED = {
    **HATCHERY, **SCALES, **OTOLITHS, **TAGS, **LINK_SCALES,
    "lo": link_otolith_sql("ls"),
    "lt": f"SELECT h.*, t.* EXCLUDE (r_tagcode) FROM lo h LEFT JOIN tags t ON {equal('h', 't', 'r_tagcode')}",
    "ra": """SELECT *, CASE WHEN total_age_yrs IS NOT NULL THEN scale_gilbert_age
        WHEN (scale_gilbert_age IS NULL OR scale_part_age IN ('RG','UD','LL','NS')) AND right(gr_age, 1) IN ('1', '2')
          THEN gr_age END AS r_resolved_gr_age FROM lt""",
    "rt": """SELECT *, CASE WHEN tag_brood_year IS NOT NULL THEN cast(2022 - tag_brood_year AS varchar)
        WHEN (left(r_resolved_gr_age, 1) BETWEEN '0' AND '9' AND right(gr_age, 1) = '1') OR right(gr_age, 1) = '2'
          THEN left(r_resolved_gr_age, 1) END AS r_resolved_total_age FROM ra""",
    "resolved": """SELECT *, 2022 AS r_sample_year, hatch_code AS r_hatch_code,
        coalesce(tag_brood_year, 2022 - try_cast(r_resolved_total_age AS int)) AS r_brood_year FROM rt""",
}
RESOLVED_VIEWS = f"v_hatchery {SCALE_VIEWS} v_otoliths v_tags"

ORACLES["hatchery_samples"] = steps("SELECT * FROM hs", "v_hatchery", **HATCHERY)
ORACLES["batch_meta"] = steps(
    "SELECT b.id, location, project_name, containers FROM v_batches b JOIN v_projects p ON p.id = b.id "
    "LEFT JOIN (SELECT batch_id, count(*) AS containers FROM v_containers GROUP BY 1) c ON c.batch_id = b.id",
    "v_batches v_projects v_containers",
)
ORACLES["container_meta"] = steps("SELECT * FROM cn", "v_batches v_containers v_readings", **BATCHES)
ORACLES["scale_ages"] = steps("SELECT * FROM sc", SCALE_VIEWS, **SCALES)
ORACLES["scale_reconcile"] = steps(
    "SELECT *, joined_rows - unaged_rows = reading_rows AS reconciled FROM (SELECT "
    "(SELECT count(*) FROM sc) AS joined_rows, "
    "(SELECT count(*) FROM sc WHERE gr_age IS NULL AND scale_condition IS NULL) AS unaged_rows, "
    "(SELECT count(*) FROM rd) AS reading_rows) t",
    SCALE_VIEWS, **SCALES,
)
ORACLES["otolith_marks"] = steps("SELECT * FROM oto", "v_otoliths", **OTOLITHS)
ORACLES["mark_master"] = steps("SELECT * FROM marks", "v_marks", **MARKS)
ORACLES["tag_releases"] = steps("SELECT * FROM tags", "v_tags", **TAGS)
ORACLES["link_scales"] = steps("SELECT * FROM ls", f"v_hatchery {SCALE_VIEWS}", **HATCHERY, **SCALES, **LINK_SCALES)
ORACLES["link_otoliths"] = steps(link_otolith_sql("hs"), "v_hatchery v_otoliths", **HATCHERY, **OTOLITHS)
ORACLES["link_tags"] = steps(
    f"SELECT h.*, t.* EXCLUDE (r_tagcode) FROM hs h LEFT JOIN tags t ON {equal('h', 't', 'r_tagcode')}",
    "v_hatchery v_tags", **HATCHERY, **TAGS,
)
ORACLES["link_tags_never"] = steps(
    "SELECT h.*, t.* EXCLUDE (r_tagcode) FROM hs h LEFT JOIN tags t ON h.r_tagcode = t.r_tagcode",
    "v_hatchery v_tags", **HATCHERY, **TAGS,
)
ORACLES["factored_tags"] = steps(
    "SELECT spawning_stock, tag_brood_year, count(*) AS n FROM hs h LEFT JOIN nt t ON h.r_tagcode IS NOT DISTINCT FROM t.r_tagcode GROUP BY ALL",
    "v_hatchery v_tags", **HATCHERY, **TAGS,
    nt="SELECT * REPLACE (CASE WHEN NOT coalesce(tag_brood_year % 3 = 0, false) THEN r_tagcode END AS r_tagcode) FROM tags",
)
ORACLES["resolve_ages"] = steps(
    "SELECT spawning_stock, r_scale_book_cell_concat, r_otolith_box_vial_concat, r_tagcode, gr_age, hatch_code, "
    "tag_brood_year, r_resolved_gr_age, r_resolved_total_age, r_sample_year, r_brood_year, r_hatch_code FROM resolved",
    RESOLVED_VIEWS, **RESOLVED,
)
_MARKED = (
    "SELECT h.*, m.* EXCLUDE (r_brood_year, r_hatch_code) FROM (SELECT {cols} FROM resolved) h LEFT JOIN marks m ON "
    + equal("h", "m", "r_brood_year", "r_hatch_code")
)
ORACLES["link_marks"] = steps(
    _MARKED.format(cols="r_otolith_box_vial_concat, r_brood_year, r_hatch_code"),
    f"{RESOLVED_VIEWS} v_marks", **RESOLVED, **MARKS,
)
ORACLES["resolved_stock"] = steps(
    f"SELECT coalesce(tag_stock_site_name, {title('substr(stock, 3)')}) AS r_resolved_stock_id, r_resolved_total_age, "
    "count(*) AS n FROM mk GROUP BY 1, 2",
    f"{RESOLVED_VIEWS} v_marks", **RESOLVED, **MARKS,
    mk=_MARKED.format(cols="tag_stock_site_name, r_resolved_total_age, r_brood_year, r_hatch_code"),
)
ORACLES["age_gain_check"] = steps(
    "SELECT *, base_missing = linked_missing AS same FROM (SELECT "
    "(SELECT count(*) FROM hs WHERE scale_gilbert_age IS NULL AND book_no IS NULL) AS base_missing, "
    "(SELECT count(*) FROM ls WHERE scale_gilbert_age IS NULL AND book_no IS NULL) AS linked_missing) t",
    f"v_hatchery {SCALE_VIEWS}", **HATCHERY, **SCALES, **LINK_SCALES,
)
ORACLES["age_discrepancies"] = steps(
    "SELECT batch_id, r_scale_book_cell_concat, scale_gilbert_age, gr_age, 'FALSE' AS dif FROM ls "
    "WHERE (scale_gilbert_age IS NULL OR gr_age IS NULL OR scale_gilbert_age <> gr_age) "
    "AND (batch_id IS NOT NULL OR r_scale_book_cell_concat IS NOT NULL)",
    f"v_hatchery {SCALE_VIEWS}", **HATCHERY, **SCALES, **LINK_SCALES,
)
_CODE = "r_otolith_box_vial_concat"
_REPEATED = f"SELECT {_CODE} FROM hs WHERE {_CODE} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
ORACLES["duplicate_codes"] = steps(_REPEATED, "v_hatchery", **HATCHERY)
ORACLES["without_duplicates"] = steps(
    f"SELECT * FROM hs WHERE {_CODE} IS NULL OR {_CODE} NOT IN ({_REPEATED})", "v_hatchery", **HATCHERY
)
ORACLES["otoliths_without_mark"] = steps(
    "SELECT * FROM oto WHERE NOT EXISTS (SELECT 1 FROM marks WHERE marks.hatch_code IS NOT DISTINCT FROM oto.hatch_code)",
    "v_otoliths v_marks", **OTOLITHS, **MARKS,
)
ORACLES["linked_stock_ages"] = steps(
    f"SELECT coalesce(tag_stock_site_name, {title('substr(stock, 3)')}) AS r_resolved_stock_id, r_resolved_gr_age, "
    "r_resolved_total_age, r_brood_year, count(*) AS n FROM mk GROUP BY 1, 2, 3, 4",
    f"{RESOLVED_VIEWS} v_marks", **RESOLVED, **MARKS,
    mk=_MARKED.format(cols="tag_stock_site_name, r_resolved_gr_age, r_resolved_total_age, r_brood_year, r_hatch_code"),
)
ORACLES["mark_crosstab"] = steps(
    "SELECT hatch_code, facility, stock, "
    + ", ".join(
        f"CASE WHEN count(*) FILTER (WHERE brood_year = {y} AND number_released IS NULL) = 0 THEN "
        f"cast(sum(number_released) FILTER (WHERE brood_year = {y}) AS bigint) END AS \"{y}\""
        for y in range(2015, 2021)
    )
    + " FROM v_marks WHERE brood_year BETWEEN 2015 AND 2020 AND state_province = 'BRITISH COLUMBIA' GROUP BY 1, 2, 3",
    "v_marks",
)
ORACLES["reused_hatch_codes"] = steps(
    "SELECT hatch_code, greatest(f, s) AS times_used FROM (SELECT hatch_code, "
    "count(DISTINCT coalesce(facility, '~')) AS f, count(DISTINCT coalesce(stock, '~')) AS s FROM v_marks "
    "WHERE brood_year BETWEEN 2015 AND 2020 AND state_province = 'BRITISH COLUMBIA' GROUP BY 1) t "
    "WHERE greatest(f, s) > 1",
    "v_marks",
)
ORACLES["select_blocks"] = steps(
    "SELECT year, stock, otolith_box, otolith_specimen, scale_book, scale, "
    + SCALE_KEYS.format(book="scale_book", cell="scale") + ", "
    + OTOLITH_KEYS.format(box="otolith_box", vial="otolith_specimen") + ", year AS r_sample_year FROM v_escapement",
    "v_escapement",
)

# Quality rules

QC = {
    "1": ("Oto missing", "Cases where there are otolith box/vial numbers but are returning 'No Sample'",
          "otolith_box IS NOT NULL AND otolith_specimen IS NOT NULL AND thermalmark = 'No Sample'"),
    "2": ("Scale missing", "Scale book and number but no age, and no explanation given (e.g., resorbed etc)",
          "resolved_age IS NULL AND part_age_code IS NULL AND scale_book IS NOT NULL"),
    "3.1": ("CWT missing", "A CWT head label was submitted but the stock ID result is blank",
            "cwt_head_label IS NOT NULL AND cwt_result IS NULL"),
    "3.2": ("CWT label 0", "CWT head label entered as '0'", "cwt_head_label = '0'"),
    "4": ("DNA missing", "Whatman sheet/DNA tracking numbers exist but no GSI result (blank)",
          "specimen_reference_dna_no IS NOT NULL AND dna_results_stock_1 IS NULL OR dna_results_stock_1 = 'NO SAMPLE'"),
    "5.1": ("ID flag CWT-DNA", "Stock ID assigned by CWT but GSI >=80% disagrees",
            "resolved_stock_source = 'CWT' AND prob_1 >= 8e-1 AND resolved_stock_origin <> region_1_name"),
    "5.2": ("ID flag OTO-DNA", "Stock ID assigned by otolith thermal mark but GSI >=80% disagrees",
            "resolved_stock_source = 'Otolith Stock' AND prob_1 >= 8e-1 AND resolved_stock_origin <> region_1_name"),
    "5.3": ("ID flag GSI LT 0.8", "A stock ID assigned by DNA with <80% certainty",
            "resolved_stock_source = 'DNA' AND prob_1 < 8e-1"),
    "5.4": ("ID flag PBT", "Hatchery origin given as a blank, but some possibility for PBT (PROB=1.00). Note this "
            "should be approached with lots of caution and is stock-specific.",
            "hatchery_origin IS NULL AND prob_1 = 1 AND dna_stock_2 IS NULL"),
    "5.5": ("ID flag SUS(assumed)", "Fish identified as Southern US (assumed) but has other information available for "
            "stock ID (e.g., GSI)",
            "resolved_stock_origin = 'SUS (assumed)' AND cwt_result IS NOT NULL AND cwt_result <> 'No Tag' "
            "AND thermalmark IS NOT NULL AND thermalmark NOT IN ('No Sample', 'Not Marked') "
            "AND dna_results_stock_1 IS NOT NULL AND dna_results_stock_1 <> 'NO SAMPLE'"),
    "6": ("Age flag", "Cases where the RESOLVED_AGE does not match the catch YEAR minus the CWT_BROOD_YEAR",
          "year - cwt_brood_year <> resolved_age"),
    "7": ("Area_Name blank", "Carry over - not sure if still needed", "area_name IS NULL"),
    "8": ("Non-std sex", "Sex designation does not fall as M or F - propose changing all other designations to "
          "'Unknown'", "sex IS NULL OR sex NOT IN ('M', 'F')"),
}


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ORACLES["qc_summary"] = steps(
    " UNION ALL ".join(
        f"SELECT '{issue_id}' AS issue_id, {_quoted(name)} AS issue, (SELECT count(*) FROM v_samples WHERE {test}) "
        f"AS count, {_quoted(definition)} AS definition"
        for issue_id, (name, definition, test) in QC.items()
    ),
    "v_samples",
)
for _issue, (_n, _d, _test) in QC.items():
    ORACLES["qc_" + _issue.replace(".", "_")] = steps(f"SELECT * FROM v_samples WHERE {_test}", "v_samples")

# Sources and sinks

ORACLES["query_doc"] = steps(
    "SELECT fiscal_year, project, location, gr_age FROM v_ages WHERE fiscal_year IN (2021, 2022) "
    "AND geographic_location = 'WCVI' AND location IN ('Conuma River', 'Gold River')",
    "v_ages",
)
ORACLES["decode_rows"] = steps("SELECT * FROM v_tags", "v_tags")
ORACLES["latest_snapshot"] = steps(
    "SELECT * FROM v_snapshots WHERE snapshot = (SELECT max(snapshot) FROM v_snapshots)", "v_snapshots"
)
ORACLES["read_many"] = steps(
    "SELECT nullif(spawning_stock, '') AS spawning_stock, * EXCLUDE (spawning_stock), 'part.csv' AS file_source FROM v_hatchery", "v_hatchery"
)
ORACLES["read_extract"] = steps("SELECT waterbody_name, area FROM v_streams", "v_streams")
ORACLES["read_layouts"] = steps(
    "SELECT waterbody_name, area, 2 * count(*) AS n, 2 AS files FROM v_streams GROUP BY ALL", "v_streams"
)
ORACLES["read_readings"] = steps("SELECT * FROM v_readings", "v_readings")
ORACLES["stack_frames"] = steps(
    "SELECT tagcode, brood_year, NULL AS hatch_code FROM v_tags UNION ALL SELECT NULL, brood_year, hatch_code FROM v_marks",
    "v_tags v_marks",
)
ORACLES["write_bundle_roundtrip"] = (
    stacked(Summary=ORACLES["qc_summary"])
    + f" UNION ALL BY NAME SELECT '7 - Area' AS table_name, * FROM ({ORACLES['qc_7']}) t"
    + " UNION ALL BY NAME SELECT 'metadata' AS table_name, * FROM (VALUES ('Summary', 'counts'), ('7 - Area', NULL)) m(sheets, description)"
)
ORACLES["quality_report"] = stacked(Summary=ORACLES["qc_summary"]) + "".join(
    f" UNION ALL BY NAME SELECT {_quoted(f'{i} - {name}')} AS table_name, * FROM ({ORACLES['qc_' + i.replace('.', '_')]}) t"
    for i, (name, _, _) in QC.items()
)
_LINKED = steps(
    "SELECT h.* RENAME (hatch_code AS hatch_code_x, facility AS facility_x), "
    "m.* EXCLUDE (r_brood_year, r_hatch_code) RENAME (hatch_code AS hatch_code_y, facility AS facility_y), "
    f"coalesce(tag_stock_site_name, {title('substr(stock, 3)')}) AS r_resolved_stock_id FROM resolved h LEFT JOIN marks m ON "
    + equal("h", "m", "r_brood_year", "r_hatch_code"),
    f"{RESOLVED_VIEWS} v_marks", **RESOLVED, **MARKS,
)
_LINK_TABLES = {
    "1 - all samples linked": _LINKED, "2 - hatchery samples": ORACLES["hatchery_samples"], "3 - scale ages": ORACLES["scale_ages"],
    "4 - otolith marks": ORACLES["otolith_marks"], "5 - tag releases": ORACLES["tag_releases"], "6 - mark master": ORACLES["mark_master"],
    "metadata": "SELECT * FROM (VALUES " + ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in (
        ("1 - all samples linked", "Hatchery samples joined to scale ages, otolith marks, tag releases and the mark "
         "master. Tags come first for stock and age, then otolith stock and scale age."),
        ("2 - hatchery samples", "Hatchery samples as landed, with link keys."),
        ("3 - scale ages", "Scale batches, containers and age readings as landed, joined, with link keys."),
        ("4 - otolith marks", "Otolith recoveries as landed, with link keys."),
        ("5 - tag releases", "Tag releases decoded from the landed payload."),
        ("6 - mark master", "Thermal mark master as landed, outside Alaska, with link keys."),
    )) + ") m(sheets, description)",
}
ORACLES["link_bundle"] = " UNION ALL BY NAME ".join(f"SELECT {_quoted(n)} AS table_name, * FROM ({sql}) t" for n, sql in _LINK_TABLES.items())
ORACLES["link_exports"] = (
    "SELECT table_name, r_otolith_box_vial_concat, r_scale_book_cell_concat, r_tagcode, count(*) AS n FROM ("
    f"SELECT 'master' AS table_name, * FROM ({ORACLES['hatchery_samples']}) a UNION ALL BY NAME "
    f"SELECT 'join' AS table_name, * FROM ({_LINKED}) b) t GROUP BY ALL"
)
ORACLES["snapshot_index"] = steps(
    "SELECT 1 AS number, 'first' AS stamp, 'marks' AS table_name, count(*) AS n_rows FROM v_marks "
    "UNION ALL SELECT 1, 'first', 'tags', count(*) FROM v_tags UNION ALL SELECT 2, 'second', 'marks', count(*) FROM marks",
    "v_marks v_tags", **MARKS,
)
ORACLES["cast_missing"] = steps(
    "SELECT coalesce(bag_no, 'NA') || '-' || coalesce(vial_no, 'NA') AS pasted, bag_no || '-' || vial_no AS guarded, "
    "coalesce(scale_part_age NOT IN ('RG','UD','LL','NS'), true) AS readable, "
    "coalesce(right(scale_gilbert_age, 1) IN ('1', '2'), false) AS full_age, count(*) AS n FROM v_hatchery "
    "GROUP BY 1, 2, 3, 4",
    "v_hatchery",
)
