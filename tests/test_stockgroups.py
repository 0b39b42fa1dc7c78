"""Stream areas and stock-group coding."""

import pytest

from tidewater import rules
from tidewater.operators import stockgroups
from tidewater.sources import schemas
from tests.helpers import frame, one, records, rows


@pytest.fixture
def streams(spark):
    return frame(
        spark, "waterbody_name string, area string",
        ("BURMAN RIVER", "25"), ("BURMAN RIVER", "25"), ("TOQUART RIVER", "23A"), ("TOQUART RIVER", "23B"),
        ("SALMON RIVER", "13"), ("HARRISON RIVER", "29D"), ("QUALICUM RIVER", "14"), ("TRANQUIL CREEK", "24"),
        ("NO AREA CREEK", None), (None, "23"), ("MARBLE RIVER", "27"), ("GOLD RIVER", "25"), ("SOMASS RIVER", "23"),
        ("QUINSAM RIVER", "13"),
    )


def test_stream_areas(streams):
    found = rows(stockgroups.stream_areas(streams))
    assert found == sorted([
        ("Burman River", 25), ("Toquaht River", 23), ("Toquaht River", 23), ("Big Qualicum River", 14),
        ("Tranquil River", 24), ("Marble River", 27), ("Gold River", 25), ("Somass River", 23), ("Quinsam River", 13),
        ("Robertson Creek", 23), ("Omega Pacific Hatchery", 23)])
    assert rows(stockgroups.stream_areas(streams, dedupe=True)).count(("Toquaht River", 23)) == 1


def coded(spark, streams, focal=rules.FOCAL_STOCKS, **fish):
    df = records(spark, schemas.BIOSAMPLES, fish)
    return stockgroups.code_stock_groups(df, stockgroups.stream_areas(streams), focal)


@pytest.mark.parametrize(
    "fish, origin",
    [
        ({"hatchery_origin": "Y", "adipose_fin_clipped": "N", "thermalmark": "Not Marked"}, "Hatchery"),
        ({"adipose_fin_clipped": "N", "thermalmark": "Not Marked"}, "Natural"),
        ({"adipose_fin_clipped": "Y", "thermalmark": "Not Marked"}, "Unknown"),
        ({}, "Unknown"),
    ],
)
def test_hatchery_or_natural(spark, streams, fish, origin):
    assert one(coded(spark, streams, **fish), "hat_nat", "term_sum") == (origin, f"{origin} Unknown")


@pytest.mark.parametrize(
    "stock, rollup, group, con, nit, area23",
    [
        ("Conuma River", "NWVI", "CONUMA", "CONUMA", "CONUMA", "CONUMA"),
        ("Burman River", "SWVI", "BURMAN", "BURMAN", "Other Area 25", "Other Area 25"),
        ("Robertson Creek", "SWVI", "ROBERTSON", "ROBERTSON", "ROBERTSON", "ROBERTSON"),
        ("Tofino Hatchery", "SWVI", "BEDWELL", "BEDWELL", "Other WCVI", "Other WCVI"),
        ("Nitinat River", "SWVI", "NITINAT", "NITINAT", "NITINAT", "Other WCVI"),
        ("Somass River", "SWVI", "SOMASS", "Other Area 23", "Other Area 23", "Other Area 23"),
        ("Quinsam River", "SWVI", "QUINSAM", "Other WCVI", "Other WCVI", "Other WCVI"),
        ("Conuma River", None, "NON-WCVI", "NON-WCVI", "NON-WCVI", "NON-WCVI"),
        ("Conuma River", "ECVI", "NON-WCVI", "NON-WCVI", "NON-WCVI", "NON-WCVI"),
        (None, "SWVI", "Unknown", "Unknown", "Unknown", "Unknown"),
    ],
)
def test_groups(spark, streams, stock, rollup, group, con, nit, area23):
    out = coded(spark, streams, resolved_stock_origin=stock, resolved_stock_rollup=rollup, hatchery_origin="Y")
    assert one(out, "stock_group", "term_con", "term_nit", "term_area23") == (
        group, f"Hatchery {con}", f"Hatchery {nit}", f"Hatchery {area23}")
    assert one(out, "qc_term_con_nit", "qc_term_con_23", "qc_term_nit_23") == (
        "TRUE" if con == nit else None, "TRUE" if con == area23 else None, "TRUE" if nit == area23 else None)


def test_spelled_focal_list_keeps_nitinat(spark, streams):
    out = coded(spark, streams, rules.FOCAL_STOCKS_SPELLED, resolved_stock_origin="Nitinat River",
                resolved_stock_rollup="SWVI")
    assert one(out, "term_area23") == "Unknown NITINAT"


def test_streams_with_two_sub_areas_repeat_their_fish(spark, streams):
    fish = {"resolved_stock_origin": "Toquaht River", "resolved_stock_rollup": "SWVI"}
    assert coded(spark, streams, **fish).count() == 2
