"""Quality rules of the sample table."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewater import rules
from tidewater.functions.missing import not_in, number


QC_IDS = ("1", "2", "3.1", "3.2", "4", "5.1", "5.2", "5.3", "5.4", "5.5", "6", "7", "8")


class Rule(NamedTuple):
    issue: str
    definition: str
    fails: Column


def _c(name: str) -> Column:
    return F.col(name)


def _dna_disagrees(source: str) -> Column:
    return (
        (_c("resolved_stock_source") == source)
        & (_c("prob_1") >= rules.QC_MIN_FRACTION)
        & (_c("resolved_stock_origin") != _c("region_1_name"))
    )


def qc_rules() -> dict[str, Rule]:
    """Rules by issue id: short name, definition and the test a failing row meets."""
    cwt, mark, dna = _c("cwt_result"), _c("thermalmark"), _c("dna_results_stock_1")
    return {
        # Issue ids, names and definitions.
        "1": Rule(
            "Oto missing",
            "Cases where there are otolith box/vial numbers but are returning 'No Sample'",
            _c("otolith_box").isNotNull() & _c("otolith_specimen").isNotNull() & (mark == "No Sample"),
        ),
        "2": Rule(
            "Scale missing",
            "Scale book and number but no age, and no explanation given (e.g., resorbed etc)",
            _c("scale_book").isNotNull() & _c("resolved_age").isNull() & _c("part_age_code").isNull(),
        ),
        "3.1": Rule(
            "CWT missing",
            "A CWT head label was submitted but the stock ID result is blank",
            _c("cwt_head_label").isNotNull() & cwt.isNull(),
        ),
        "3.2": Rule("CWT label 0", "CWT head label entered as '0'", _c("cwt_head_label") == "0"),
        "4": Rule(
            "DNA missing",
            "Whatman sheet/DNA tracking numbers exist but no GSI result (blank)",
            (_c("specimen_reference_dna_no").isNotNull() & dna.isNull()) | (dna == "NO SAMPLE"),
        ),
        "5.1": Rule(
            "ID flag CWT-DNA", "Stock ID assigned by CWT but GSI >=80% disagrees", _dna_disagrees("CWT")
        ),
        "5.2": Rule(
            "ID flag OTO-DNA", "Stock ID assigned by otolith thermal mark but GSI >=80% disagrees",
            _dna_disagrees("Otolith Stock"),
        ),
        "5.3": Rule(
            "ID flag GSI LT 0.8",
            "A stock ID assigned by DNA with <80% certainty",
            (_c("resolved_stock_source") == "DNA") & (_c("prob_1") < rules.QC_MIN_FRACTION),
        ),
        "5.4": Rule(
            "ID flag PBT",
            "Hatchery origin given as a blank, but some possibility for PBT (PROB=1.00). Note this should be "
            "approached with lots of caution and is stock-specific.",
            _c("hatchery_origin").isNull() & (_c("prob_1") == 1) & _c("dna_stock_2").isNull(),
        ),
        "5.5": Rule(
            "ID flag SUS(assumed)",
            "Fish identified as Southern US (assumed) but has other information available for stock ID (e.g., GSI)",
            (_c("resolved_stock_origin") == "SUS (assumed)")
            & (cwt != "No Tag")
            & ~mark.isin("No Sample", "Not Marked")
            & (dna != "NO SAMPLE"),
        ),
        "6": Rule(
            "Age flag",
            "Cases where the RESOLVED_AGE does not match the catch YEAR minus the CWT_BROOD_YEAR",
            _c("year") - _c("cwt_brood_year") != _c("resolved_age"),
        ),
        "7": Rule("Area_Name blank", "Carry over - not sure if still needed", _c("area_name").isNull()),
        "8": Rule(
            "Non-std sex",
            "Sex designation does not fall as M or F - propose changing all other designations to 'Unknown'",
            not_in("sex", ("M", "F")),
        ),
    }


def qc_failures(df: DataFrame, issue_id: str) -> DataFrame:
    """Rows failing one rule."""
    return df.filter(qc_rules()[issue_id].fails)


def _summary_rows(counts: DataFrame) -> DataFrame:
    """One row per rule from one row with a count per rule."""
    lines = [
        F.struct(
            F.lit(issue_id).alias("issue_id"),
            F.lit(rule.issue).alias("issue"),
            F.col(f"`{issue_id}`").alias("count"),
            F.lit(rule.definition).alias("definition"),
        )
        for issue_id, rule in qc_rules().items()
    ]
    return counts.select(F.inline(F.array(*lines)))


def qc_counts() -> list[Column]:
    """Failing rows of each rule, named by its id."""
    return [F.count_if(rule.fails).alias(issue_id) for issue_id, rule in qc_rules().items()]


def qc_summary(df: DataFrame) -> DataFrame:
    """Number of failing rows per rule, all rules counted in one scan."""
    return _summary_rows(df.agg(*qc_counts()))


def qc_summary_of(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """The summary from counts that are known already."""
    row = tuple(counts[issue_id] for issue_id in QC_IDS)
    return _summary_rows(spark.createDataFrame([row], ", ".join(f"`{i}` long" for i in QC_IDS)))


def qc_exploded(df: DataFrame) -> DataFrame:
    """Every row once for each rule it fails, with the rule's ``issue_id``; rows that fail none are left out."""
    failed = F.array_compact(F.array(*[F.when(rule.fails, F.lit(i)) for i, rule in qc_rules().items()]))
    return df.select("*", F.explode(failed).alias("issue_id"))


def qc_table_name(issue_id: str) -> str:
    return f"{issue_id} - {qc_rules()[issue_id].issue}"


def qc_tables(df: DataFrame) -> dict[str, DataFrame]:
    """The summary and one table of failing rows per rule, by report name."""
    return {"Summary": qc_summary(df)} | {qc_table_name(i): qc_failures(df, i) for i in QC_IDS}
