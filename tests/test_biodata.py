"""Sample operators, sufficiency and sample review tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater import rules
from tidewater.operators import biodata, catch, review, sufficiency
from tidewater.sources import schemas
from tests.helpers import frame, one, records, rows

BASE = {"year": 2021, "month": "August", "collection_date": dt.date(2021, 8, 17), "area": "25"}


def conuma(df):
    return biodata.biosamples(df, rules.CONUMA_SPORT_AREAS, rules.CONUMA_SAMPLE_SUB_AREAS, river="conuma")


@pytest.fixture
def samples(spark):
    return records(
        spark, schemas.BIOSAMPLES,
        {**BASE, "sample_type": "Sport", "subarea": "25D", "resolved_age": 4, "resolved_stock_origin": "Conuma River"},
        {**BASE, "sample_type": "Sport", "subarea": "25K", "resolved_age": 3},
        {**BASE, "sample_type": "Sport", "subarea": "Area 26 x", "resolved_age": 3},
        {**BASE, "sample_type": "SEINE set", "resolved_age": 3},
        {**BASE, "sample_type": "GILL NET", "run_recon_area": "Tlupana Inlet", "resolved_stock_origin": "Burman River"},
        {**BASE, "sample_type": "FREEZER TROLL", "run_recon_area": None, "collection_date": None},
        {**BASE, "sample_type": "Escapement", "landing_site": "Conuma R", "area": "x"},
        {**BASE, "sample_type": "Escapement", "landing_site": "Gold R"},
        {**BASE, "sample_type": "Escapement"},
    )


def test_biosamples(samples):
    out = conuma(samples)
    found = rows(out, "sample_type", "input_data_type", "gear", "sector", "creel_sub_area", "run_recon_area", "ufid")
    assert found == sorted(
        [
            ("Sport", "age and stock comp", None, "sport", "25D", "sport Tlupana", "2021-sport Tlupana-August"),
            ("Sport", "age", None, "sport", None, "sport Outer Esperanza/corridor",
             "2021-sport Outer Esperanza/corridor-August"),
            ("SEINE set", "age", "Seine", None, None, None, None),
            ("GILL NET", "stock comp", "Gillnet", "commercial", None, "commercial Gillnet Tlupana",
             "2021-commercial Gillnet Tlupana-August-83"),
            ("FREEZER TROLL", None, "Troll", "commercial", None, "commercial Troll NA",
             "2021-commercial Troll NA-August-NANA"),
            ("Escapement", None, None, "escapement", None, "escapement Conuma R", "2021-escapement Conuma R-August"),
            ("Escapement", None, None, "escapement", None, "escapement Misc Gold R",
             "2021-escapement Misc Gold R-August"),
            ("Escapement", None, None, "escapement", None, None, "2021-NA-August"),
        ],
        key=lambda t: [(v is not None, str(v)) for v in t],
    )
    assert "scale_book" not in out.columns and "dna_stock_1" in out.columns


def test_nitinat_samples_only_name_sport_areas(spark, samples):
    extra = records(spark, schemas.BIOSAMPLES, {**BASE, "sample_type": "Sport", "subarea": "22A", "area": "22"})
    out = biodata.biosamples(
        samples.union(extra), rules.NITINAT_SPORT_AREAS, rules.NITINAT_SAMPLE_SUB_AREAS, river="nitinat")
    assert out.count() == 10
    assert rows(out.filter("run_recon_area is not null"), "run_recon_area", "creel_sub_area", "pfma") == [
        ("sport Nitinat Lake and River", "22A", 22)]
    assert rows(out.filter("sector = 'escapement'"), "ufid") == [("2021-NA-August",)] * 3


@pytest.fixture
def gsi(spark):
    schema = ("indiv string, collection string, month_jb_added string, id_source string, `repunit.1` string, "
              "`collection.1` string, `prob.1` double")
    return frame(
        spark, schema,
        ("f1", "A25_07(Jul)", "x", "PBT", "NoKy", "SAN_JUAN-UPPER", 75.0),
        ("f2", "A25_08(Aug)", "x", "GSI", "Fraser", "BURMAN_R", 74.9),
        ("f3", "A25_08(Aug)", "x", "GSI", "SWVI", "BURMAN_R", None),
        ("f4", "A25_08(Aug)", "x", "likely_duplicate", "SWVI", "BURMAN_R", 99.0),
        ("f5", "A25_08(Aug)", "x", None, "SWVI", "BURMAN_R", 99.0),
    )


def test_gsi_results(gsi):
    out = biodata.gsi_results(gsi, 2020)
    assert {"indiv", "id_source", "month_jb_added"}.isdisjoint(out.columns)
    assert rows(out, "month", "dna_stock_1", "region_1_rollup", "prob_1", "resolved_stock_origin",
                "resolved_stock_rollup", "hatchery_origin", "resolved_stock_source") == [
        ("August", "BURMAN_R", None, 74.9, None, None, "N", "DNA-GSI"),
        ("August", "BURMAN_R", "SWVI", None, None, None, "N", "DNA-GSI"),
        ("July", "SAN_JUAN-UPPER", "NWVI", 75.0, "San Juan-Upper", "NWVI", "Y", "DNA-PBT"),
    ]


def test_pbt_ages(spark):
    wide = frame(
        spark, "collection string, repunit string, age int, prov_state string, sum int, `A (Jul)` int, `A (Aug)` int",
        ("CONUMA_RIVER", "NoKy", 3, "BC", 4, 3, None), ("BURMAN_R", "Fraser", 4, "BC", 1, 0, 1))
    assert rows(biodata.pbt_ages(wide, ["A (Jul)", "A (Aug)"])) == [
        ("Burman R", None, 4, "August", "DNA-PBT")] + [("Conuma River", "NWVI", 3, "July", "DNA-PBT")] * 3


def test_compiled_biodata_equals_sector_by_sector(spark, samples, gsi):
    lookup = spark.createDataFrame(
        [
            ("sport", "sport Tlupana", "25D", 1.0, 2.0, "n"), ("sport", "elsewhere", None, 3.0, 4.0, "n"),
            ("commercial", "commercial Gillnet Tlupana", "zz", 5.0, 6.0, "n"),
            ("escapement", "escapement Conuma R", None, 7.0, 8.0, "n"),
            ("5 Nations EO", "5 Nations Outer Nootka", None, 9.0, 9.5, "n"),
        ],
        schemas.SPATIAL_LOOKUP,
    )
    clean, typed = conuma(samples), biodata.gsi_results(gsi, 2020)
    out = biodata.conuma_biodata(clean, typed, lookup)
    parts = [
        catch.georeference(clean.filter("sector = 'sport' and pfma = 25"), lookup, "sport", ["run_recon_area"]),
        catch.georeference(clean.filter("sector = 'commercial' and pfma = 25"), lookup, "commercial", ["creel_sub_area"]),
        catch.georeference(clean.filter("sector = 'escapement'"), lookup, "escapement", ["creel_sub_area"], sector_text=True),
        catch.georeference(typed, lookup, "5 Nations EO", ["creel_sub_area"]),
    ]
    columns = sorted(out.columns)
    assert rows(out, *columns) == rows(biodata.compile_biodata(parts), *columns)
    assert out.count() == 2 + 2 + 3 + 3
    # a sport sample without an accepted sub-area meets the lookup row without one
    assert one(out.filter("subarea = '25K'"), "lat") == 3.0


def test_age_composition(spark):
    data = [(2021, rules.BROODSTOCK_PROJECT, "WCVI", "Conuma River", a) for a in ("21", "1M", "31", "41", "41", "61")]
    data += [(2020, rules.BROODSTOCK_PROJECT, "WCVI", "Conuma River", "31"), (2021, "other", "WCVI", "Conuma River", "31")]
    df = spark.createDataFrame(data, "fiscal_year int, project string, geographic_location string, location string, gr_age string")
    out = biodata.age_composition(df, 2021)
    assert rows(out, "gr_age2", "age_n", "age_total", "age_propn") == [(2, 2, 5, 0.4), (3, 1, 5, 0.2), (4, 2, 5, 0.4)]
    assert [r["gr_age2"] for r in out.collect()] == [2, 3, 4]
    assert rows(out, "age_data_source")[0] == ("SEP Conuma Hatchery broodstock age data, Conuma River",)


@pytest.fixture
def fisheries(spark):
    """Fisheries with 9, 10, 11 and no samples."""
    caught = frame(
        spark, "year int, sector string, run_recon_area string, ufid string, kept double",
        (2021, "sport", "A", "u9", 5.0), (2021, "sport", "A", "u10", 5.0), (2021, "sport", "A", "u10", None),
        (2021, "sport", "B", "u11", 5.0), (2021, "sport", "C", "u0", 1.0), (2021, "sport", "C", "none", 0.0),
        (2021, "sport", None, "lost", 9.0), (2020, "sport", "A", "old", 3.0),
    )
    bio = []
    for ufid, area, ages, stocks in (("u9", "A", 9, 12), ("u10", "A", 10, 10), ("u11", "B", 11, 9)):
        n = max(ages, stocks)
        bio += [(2021, "sport", area, ufid, 4 if k < ages else None, "S" if k < stocks else None) for k in range(n)]
    bio += [(2019, "sport", "C", "other", 4, "S"), (2021, "sport", "C", "late", 4, None), (2021, None, None, None, 4, "S")]
    # stock samples of another sector count, age samples do not
    bio += [(2021, "commercial", "B", "u11", 3, "S")]
    return caught, spark.createDataFrame(
        bio, "year int, sector string, run_recon_area string, ufid string, resolved_age int, resolved_stock_origin string")


def test_sample_sufficiency(fisheries):
    out = sufficiency.sample_sufficiency(*fisheries, 2021)
    assert rows(out, "ufid", "total_kept", "n_age_samples", "n_stockcomp_samples", "age_samplesize_flag",
                "stockcomp_samplesize_flag") == [
        ("u0", 1.0, None, None, "FLAG", "FLAG"), ("u10", 5.0, 10, 10, None, None),
        ("u11", 5.0, 11, 10, None, None), ("u9", 5.0, 9, 12, "FLAG", None)]


def test_orphans_and_their_candidates(fisheries):
    caught, bio = fisheries
    orphans = sufficiency.orphan_ufids(sufficiency.sample_sufficiency(caught, bio, 2021))
    assert rows(orphans, "ufid") == [("u0",), ("u9",)]
    candidates = sufficiency.orphan_candidates(bio, orphans)
    assert rows(candidates.groupBy("run_recon_area").count()) == [("A", 22), ("C", 2)]
    assert rows(sufficiency.missed_samples(bio, orphans, 2021)) == [("C", "late", 1)]
    assert rows(sufficiency.orphan_table(orphans), "ufid", "n_age_samples", "n_stockcomp_samples") == [
        ("u0", 0, 0), ("u9", 9, 12)]


def test_sample_points_and_classes(spark):
    place = (2021, "sport", "A", "25D", 1.0, 2.0)
    data = [(*place, "A age", "July")] * 9 + [(*place, "A stock comp", "July")]
    data += [(2020, "sport", "A", "25D", 1.0, 2.0, "A age", "July")] * 11
    data += [(2021, "sport", "B", None, None, None, "B age", "July")] * 3
    bio = spark.createDataFrame(
        data, "year int, sector string, run_recon_area string, creel_sub_area string, lat double, long double, "
              "label string, month string")
    assert rows(review.sample_points(bio, 2021), "label", "n", "radius") == [("A age", 10, 6), ("A stock comp", 10, 6)]
    assert rows(review.sample_points(bio, 2021, 1), "label", "n") == [("A age", 11)]
    assert rows(review.temporal_samples(bio), "year", "run_recon_area", "n", "sample_class") == [
        (2020, "A", 11, ">10"), (2021, "A", 10, None), (2021, "B", 3, "<10")]


def test_overview_and_marks(spark, samples):
    assert ("Sport", 3) in rows(biodata.sample_overview(samples), "sample_type", "n")
    marks = frame(spark, "species string", ("Chinook",), ("Coho",))
    assert rows(biodata.thermal_marks(marks)) == [("Chinook", "stock composition")]
