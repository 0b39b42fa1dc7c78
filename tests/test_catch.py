"""Catch and escapement operators on small hand-written inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater import rules
from tidewater.operators import catch, review
from tidewater.operators.reshape import stack_frames
from tidewater.sources import schemas
from tests.helpers import formatted_plan, frame, one, records, rows

CHINOOK = "CHINOOK SALMON"


@pytest.fixture
def sport(spark):
    data = [
        (2021, "August", "PFMA 25", "25D", CHINOOK, "Kept", 410.0),
        (2021, "August", "PFMA 25", "25D", CHINOOK, "Released Legal", 12.5),
        (2021, "July", "PFMA 25", "25L", CHINOOK, "Released Legal", 30.0),
        (2021, "July", "PFMA 25", "25ZZ", CHINOOK, "Kept", 7.0),
        (2020, "July", "PFMA 25", "25K", CHINOOK, "Released Sub-legal", 3.0),
        (2017, "July", "PFMA 25", "25K", CHINOOK, "Kept", 5.0),
        (2021, "September", "PFMA 121", "121C", CHINOOK, "Kept", 9.0),
        (2021, "Sept", "PFMA 21", "Area 21", CHINOOK, "Kept", 4.0),
        (2021, "August", "PFMA 25", "25D", "COHO SALMON", "Kept", 99.0),
    ]
    return spark.createDataFrame(data, schemas.SPORT_CATCH)


@pytest.fixture
def lookup(spark):
    data = [
        ("sport", "sport Tlupana", "25D", 49.5, -126.5, "n"),
        ("sport", None, "25ZZ", 49.9, -126.9, "n"),
        ("sport", "sport Area 22 Nitinat River", "22A", 48.8, -124.7, "n"),
        ("commercial", "commercial Gillnet Nootka", None, 49.6, -126.6, "n"),
        ("commercial", "commercial Gillnet Nootka", "x", 49.7, -126.7, "repeated"),
        ("5 Nations EO", "5 Nations Muchalat", None, 49.8, -126.1, "n"),
        ("FN", "FN FSC", None, 48.9, -124.9, "n"),
        ("escapement", "escapement ESSR", None, 48.7, -124.8, "n"),
    ]
    return spark.createDataFrame(data, schemas.SPATIAL_LOOKUP)


def test_sport_catch_labels(sport):
    out = catch.sport_catch(sport, rules.CONUMA_SPORT_AREAS)
    found = rows(out.filter("estimate in (410.0, 7.0, 4.0)"), "estimate", "pfma", "run_recon_area", "month", "ufid")
    assert found == [
        (4.0, 21, None, None, "2021-NA-NA"),
        (410.0, 25, "sport Tlupana", "August", "2021-sport Tlupana-August"),
        (7.0, 25, None, "July", "2021-NA-July"),
    ]
    assert out.count() == 8


def test_sport_mortality_totals(sport):
    out = catch.sport_mortality(catch.sport_catch(sport, rules.CONUMA_SPORT_AREAS))
    found = rows(out.filter("pfma = 25 and year = 2021"), "creel_sub_area", "kept", "release_mort", "total_mort")
    assert found == [("25D", 410.0, 2.5, 412.0), ("25L", None, 6.0, 6.0), ("25ZZ", 7.0, None, 7.0)]
    lone = one(out.filter("year = 2020"), "kept", "released_sub_legal", "total_mort")
    assert lone == (None, 3.0, None)


def test_sport_totals_equal_the_stepwise_result(sport):
    short = catch.sport_totals(sport, rules.CONUMA_SPORT_AREAS, (25,), 2021, 3)
    steps = catch.sport_mortality(
        catch.sport_catch(sport, rules.CONUMA_SPORT_AREAS).filter("pfma = 25 and year between 2018 and 2021"))
    assert sorted(short.columns) == sorted(steps.columns)
    assert rows(short, *sorted(short.columns)) == rows(steps, *sorted(steps.columns))


def test_sport_totals_filter_reaches_the_scan(sport, spark, tmp_path):
    sport.write.parquet(str(tmp_path / "sport"))
    landed = spark.read.parquet(str(tmp_path / "sport"))
    out = catch.sport_totals(landed, rules.CONUMA_SPORT_AREAS, (25,), 2021, 3)
    plan = formatted_plan(out)
    assert "EqualTo(pfma,PFMA 25)" in plan and "GreaterThanOrEqual(year,2018)" in plan
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize(
    "pfma, sub_area, region",
    [
        ("PFMA 10", "10A", "outSmith(10)"), ("PFMA 29", "x", "sGST(17,18,19AB,28,29)"),
        ("PFMA 19", "19A", "sGST(17,18,19AB,28,29)"), ("PFMA 19", "19C", "JDFeast(19CDE,20CD)"),
        ("PFMA 20", "20A", "JDFwest(Renfrew 20ABE)"), ("PFMA 21", "21A", "Nitinat"),
        ("PFMA 23", "23A", "Alberni(23A,B)"), ("PFMA 23", "23Q", "Barkley(23C-Q)"), ("PFMA 24", "23A", "Clayoquot"),
        ("PFMA 23", "other", None), ("US7 North", None, "US7"), (None, None, None),
    ],
)
def test_fishery_regions(spark, pfma, sub_area, region):
    df = records(spark, schemas.SPORT_CATCH, {"pfma": pfma, "creel_sub_area": sub_area, "month": "July"})
    out = catch.fishery_region(df)
    assert one(out, "fish_cat_reg", "region_month") == (region, f"{region or 'NA'}, July")


@pytest.fixture
def commercial(spark):
    data = [
        (dt.date(2021, 8, 17), "Area D Gillnet", "Nootka", 25, 100, 5),
        (dt.date(2021, 8, 17), "Trap", "Nootka", 25, 10, 5),
        (dt.date(2021, 9, 1), "Area G Troll", "Tlupana", 25, 10, 4),
        (dt.date(2021, 8, 17), "Area B Seine", "Nootka", 23, 1, 1),
    ]
    return spark.createDataFrame(data, schemas.COMMERCIAL_CATCH)


def test_commercial_catch_and_mortality(commercial):
    out = catch.commercial_mortality(catch.commercial_catch(commercial))
    found = rows(out.filter("pfma = 25"), "ufid", "gear", "kept", "released_unk", "release_mort", "total_mort")
    assert found == [
        ("2021-commercial Gillnet Nootka-August-83", "Gillnet", 100, 5, 2.5, 102.0),
        ("2021-commercial NA Nootka-August-83", None, 10, 5, None, None),
        ("2021-commercial Troll Tlupana-September-91", "Troll", 10, 4, 0.8, 11.0),
    ]


@pytest.fixture
def blocks(spark):
    aabm = frame(spark, "`Five Nations AABM Chinook sold 2021` string, `PFMA 24` double, `PFMA 25` double",
                 ("Aug", 5.0, 6.0), ("May", 7.0, 8.0))
    muchalaht = frame(spark, "`Five Nations ISBM Muchalaht  Chinook sold -` string, `PFMA 25` double", ("Sept", 3.0))
    other = frame(spark, "Unknown string, `PFMA 25` double", ("July", 1.0))
    return [aabm, muchalaht, other]


def test_nations_catch(blocks):
    out = catch.nations_catch(blocks, 2021)
    assert rows(out, "run_recon_area", "month", "pfma", "kept", "ufid") == [
        ("5 Nations Muchalat", "September", 25, 3.0, "2021-5 Nations Muchalat-September"),
        ("5 Nations Outer Nootka", "August", 25, 6.0, "2021-5 Nations Outer Nootka-August"),
        ("5 Nations Outer Nootka", "May", 25, 8.0, "2021-5 Nations Outer Nootka-May"),
        ("FLAG", "July", 25, 1.0, "2021-FLAG-July"),
    ]


@pytest.fixture
def report(spark):
    natural, removed = "TOTAL NATURAL SPAWNING RIVER POPULATION", "FISH REMOVED FROM THE SYSTEM:"
    data = [
        (2021, natural, "Nitinat River", None, "1", "10", "20", "3", "9"),
        (2021, natural, "Nitinat River", "SUBTOTAL", "1", "1", "1", "1", "1"),
        (2021, removed, "Hatchery", "surplus to needs", "0", "5", "6", "7", "8"),
        (2021, removed, "Hatchery", "for broodstock", "1", "1", "1", "1", "1"),
        (2021, "FRESH WATER SPORT FISHERY", "Nitinat River", "kept", "2", "3", "4", "5", "6"),
        (2021, "FRESH WATER SPORT FISHERY", "Nitinat Lake", "kept", "2", "3", "4", "5", "6"),
        (2021, "NATIVE FISHERY", "Nitinat River", "Food Fish", "1", None, "1", "1", "1"),
        (2021, "NATIVE FISHERY", "Nitinat River", "ESSR harvest", "1", "n/a", "1", "1", "1"),
        (2021, "NATIVE FISHERY", "Nitinat River", "* Not including broodstock", "1", "1", "1", "1", "1"),
        (2021, "NATIVE FISHERY", "Nitinat River", "Culls", "1", "1", "1", "1", "1"),
    ]
    return spark.createDataFrame(data, schemas.HATCHERY_REPORT)


def test_hatchery_report_lines(report):
    out = catch.hatchery_report(report)
    assert out.count() == 7 * 5
    found = rows(out.filter("sex = 'M'"), "sector", "run_recon_area", "month", "input_data_type", "n")
    assert found == [
        ("FN", "FN EO (Native ESSR)", "September", "catch", None),
        ("FN", "FN FSC", "September", "catch", None),
        ("escapement", "escapement ESSR", "September", "escapement", 5.0),
        ("escapement", "escapement Hatchery broodstock, morts", "September", "escapement", 1.0),
        ("escapement", "escapement Nitinat River Spawners", "October", "escapement", 10.0),
        ("sport", None, "September", "catch", 3.0),
        ("sport", "sport Area 22 Nitinat River", "September", "catch", 3.0),
    ]
    assert rows(out.filter("run_recon_area is null"), "ufid") == [(None,)] * 5


def test_report_totals(report):
    lines = catch.hatchery_report(report)
    assert one(catch.river_sport_total(lines), "kept", "total", "creel_sub_area") == (9.0, 9.0, "22A")
    assert rows(catch.fn_total(lines), "run_recon_area", "kept") == [("FN EO (Native ESSR)", None), ("FN FSC", None)]
    spawners = catch.escapement_total(lines).filter("run_recon_area like '%Spawners'")
    assert rows(spawners, "sex", "total") == [("F", 20.0), ("J", 3.0), ("M", 10.0), ("U", 1.0)]


def test_one_pass_report_totals_equal_the_three(report):
    lines = catch.hatchery_report(report)
    parts = stack_frames([catch.river_sport_total(lines), catch.fn_total(lines), catch.escapement_total(lines)])
    columns = sorted(parts.columns)
    assert rows(catch.report_totals(report), *columns) == rows(parts, *columns)


def _conuma_parts(sport, commercial, blocks, lookup):
    five = catch.nations_catch(blocks, 2021).filter("month in ('June', 'July', 'August', 'September')")
    return [
        catch.georeference(catch.sport_totals(sport, rules.CONUMA_SPORT_AREAS, (25,), 2021, 3), lookup, "sport"),
        catch.georeference(
            catch.commercial_mortality(catch.commercial_catch(commercial).filter("mgmt_area = 25")), lookup,
            "commercial", ["creel_sub_area"]),
        catch.georeference(five.withColumn("total_mort", F.col("kept")), lookup, "5 Nations EO", ["creel_sub_area"]),
    ]


def test_compiled_catch_by_union_by_join_and_in_one_pass(sport, commercial, blocks, lookup):
    parts = _conuma_parts(sport, commercial, blocks, lookup)
    whole = catch.compile_catch(parts)
    columns = sorted(whole.columns)
    expected = rows(whole, *columns)
    assert rows(catch.compile_catch(parts, "full"), *columns) == expected
    compiled = catch.conuma_catch(
        sport, catch.commercial_catch(commercial), catch.nations_catch(blocks, 2021), lookup, 2021)
    assert rows(compiled, *columns) == expected


def test_compiled_catch_details(sport, commercial, blocks, lookup):
    out = catch.conuma_catch(
        sport, catch.commercial_catch(commercial), catch.nations_catch(blocks, 2021), lookup, 2021)
    # the repeated lookup key doubles the gillnet row, and the unmapped sub-area finds its position by null keys
    assert out.filter("gear = 'Gillnet'").count() == 2
    assert one(out.filter("creel_sub_area = '25ZZ'"), "lat", "label") == (49.9, "NA catch")
    assert out.filter("month = 'May'").count() == 0
    assert out.filter("pfma <> 25").count() == 0


def test_compiled_catch_keeps_rows_and_kept_fish(sport, commercial, blocks, lookup):
    unique = lookup.filter("notes <> 'repeated'")
    parts = _conuma_parts(sport, commercial, blocks, unique)
    whole = catch.compile_catch(parts)
    assert whole.count() == sum(p.count() for p in parts)
    total = lambda df: df.agg(F.sum("kept")).first()[0] or 0
    assert total(whole) == sum(total(p) for p in parts)


def test_nitinat_catch(sport, report, lookup):
    out = catch.nitinat_catch(sport, report, lookup, 2022)
    assert rows(out.filter("sector = 'sport'"), "run_recon_area", "kept", "total", "lat") == [
        ("sport Area 21 Terminal", 4.0, 4.0, None), ("sport Area 22 Nitinat River", 9.0, 9.0, 48.8)]
    # 121C is mapped to an area but lies outside areas 21 and 22
    assert out.filter("run_recon_area like '%corridor'").count() == 0
    parts = [
        catch.georeference(catch.sport_totals(sport, rules.NITINAT_SPORT_AREAS, (21, 22), 2022, 4, total="total"),
                           lookup, "sport"),
        catch.georeference(catch.river_sport_total(catch.hatchery_report(report)), lookup, "sport"),
        catch.georeference(catch.fn_total(catch.hatchery_report(report)), lookup, "FN", ["creel_sub_area"]),
        catch.georeference(
            catch.escapement_total(catch.hatchery_report(report)), lookup, "escapement", ["creel_sub_area"]),
    ]
    columns = sorted(out.columns)
    assert rows(catch.compile_catch(parts, "full"), *columns) == rows(out, *columns)


def test_review_of_catch(spark):
    schema = ("year int, sector string, run_recon_area string, lat double, long double, label string, month string, "
              "ufid string, kept double")
    data = [(2021, "sport", "A", 1.0, 2.0, "A catch", "July", "u1", k) for k in (400.0, None, 99.0)]
    data += [(2021, "sport", "A", 1.0, 2.0, "A catch", "January", "u2", 1.0)]
    data += [(2021, "sport", "B", None, None, "B catch", "July", "u3", 0.0), (2021, "x", None, 1.0, 1.0, "c", "July", "u4", 5.0)]
    data += [(2020, "sport", "A", 1.0, 2.0, "A catch", "July", "u5", 7.0)]
    caught = spark.createDataFrame(data, schema)
    assert rows(review.catch_points(caught, 2021), "run_recon_area", "kept", "radius") == [("A", 500.0, 7)]
    assert rows(review.temporal_catch(caught, 2021), "run_recon_area", "month", "kept") == [
        ("A", None, 1.0), ("A", "July", 499.0)]
    assert rows(review.ufid_table(caught, 2021), "ufid", "total_kept") == [("u1", 499.0), ("u2", 1.0)]
    kept = review.ufid_table(caught, 2021, keep_zero=True, by_month=True)
    assert [r["ufid"] for r in kept.collect()][-1] == "u2"
    assert rows(kept, "ufid", "total_kept") == [("u1", 499.0), ("u2", 1.0), ("u3", 0.0)]
