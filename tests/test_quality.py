"""Each quality rule on rows that just pass and just fail."""

import pytest

from tidewater.operators import quality
from tidewater.sources import schemas
from tests.helpers import records, rows

SOUND = {
    "sex": "F", "area_name": "Nootka", "year": 2021, "resolved_age": 4, "part_age_code": "x", "hatchery_origin": "N",
}
SUS = {
    "resolved_stock_origin": "SUS (assumed)", "cwt_result": "181234", "thermalmark": "H5", "dna_results_stock_1": "X",
}
CASES = {
    "1": ([{"otolith_box": "B", "otolith_specimen": "1", "thermalmark": "No Sample"}],
          [{"otolith_box": "B", "thermalmark": "No Sample"},
           {"otolith_box": "B", "otolith_specimen": "1"}]),
    "2": ([{"scale_book": "S", "resolved_age": None, "part_age_code": None}],
          [{"scale_book": "S", "resolved_age": None}, {"resolved_age": None, "part_age_code": None}]),
    "3.1": ([{"cwt_head_label": "7"}], [{"cwt_head_label": "7", "cwt_result": "No Tag"}]),
    "3.2": ([{"cwt_head_label": "0", "cwt_result": "x"}], [{"cwt_head_label": "A0", "cwt_result": "x"}]),
    "4": ([{"specimen_reference_dna_no": "W"}, {"dna_results_stock_1": "NO SAMPLE"}],
          [{"specimen_reference_dna_no": "W", "dna_results_stock_1": "X"}]),
    "5.1": ([{"resolved_stock_source": "CWT", "prob_1": 0.8, "resolved_stock_origin": "A", "region_1_name": "B"}],
            [{"resolved_stock_source": "CWT", "prob_1": 0.79, "resolved_stock_origin": "A", "region_1_name": "B"},
             {"resolved_stock_source": "CWT", "prob_1": 0.9, "resolved_stock_origin": "A"}]),
    "5.2": ([{"resolved_stock_source": "Otolith Stock", "prob_1": 0.9, "resolved_stock_origin": "A",
              "region_1_name": "B"}],
            [{"resolved_stock_source": "Otolith Stock", "prob_1": 0.9, "resolved_stock_origin": "A",
              "region_1_name": "A"}]),
    "5.3": ([{"resolved_stock_source": "DNA", "prob_1": 0.79}], [{"resolved_stock_source": "DNA", "prob_1": 0.8}]),
    "5.4": ([{"hatchery_origin": None, "prob_1": 1.0}], [{"hatchery_origin": None, "prob_1": 1.0, "dna_stock_2": "x"}]),
    "5.5": ([SUS], [{**SUS, "cwt_result": "No Tag"}, {**SUS, "thermalmark": None}, {**SUS, "thermalmark": "Not Marked"}]),
    "6": ([{"cwt_brood_year": 2018}], [{"cwt_brood_year": 2017}, {"cwt_brood_year": None}]),
    "7": ([{"area_name": None}], []),
    "8": ([{"sex": None}, {"sex": "J"}], [{"sex": "M"}]),
}


@pytest.mark.parametrize("issue_id", quality.QC_IDS)
def test_rule(spark, issue_id):
    failing, passing = CASES[issue_id]
    df = records(spark, schemas.BIOSAMPLES, SOUND, *[{**SOUND, **c} for c in failing + passing])
    assert quality.qc_failures(df, issue_id).count() == len(failing)


def test_summary_counts_equal_the_failing_rows(spark):
    every = [{**SOUND, **c} for failing, passing in CASES.values() for c in failing + passing]
    df = records(spark, schemas.BIOSAMPLES, *every)
    summary = dict(rows(quality.qc_summary(df), "issue_id", "count"))
    assert list(summary) == sorted(quality.QC_IDS)
    for issue_id in quality.QC_IDS:
        assert summary[issue_id] == quality.qc_failures(df, issue_id).count() > 0


def test_summary_reads_the_samples_once(spark):
    df = records(spark, schemas.BIOSAMPLES, SOUND)
    plan = quality.qc_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_tables_are_named_by_issue(spark):
    names = list(quality.qc_tables(records(spark, schemas.BIOSAMPLES, SOUND)))
    assert names[:2] == ["Summary", "1 - Oto missing"] and len(names) == 14
