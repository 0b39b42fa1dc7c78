"""Declared schemas of the landed extracts, under column-safe names."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "date": T.DateType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


SPORT_CATCH = _schema(
    year="int", month="string", pfma="string", creel_sub_area="string", species="string", disposition="string",
    estimate="double",
)
COMMERCIAL_CATCH = _schema(
    fishing_date="date", licence_area="string", area_name="string", mgmt_area="int", chinook_kept="int",
    chinook_reld="int",
)
BIOSAMPLES = _schema(
    year="int", month="string", collection_date="date", sample_type="string", area="string", area_name="string",
    subarea="string", run_recon_area="string", landing_site="string", resolved_age="int",
    resolved_stock_origin="string", resolved_stock_rollup="string", resolved_stock_source="string",
    hatchery_origin="string", adipose_fin_clipped="string", thermalmark="string", otolith_box="string",
    otolith_specimen="string", scale_book="string", part_age_code="string", cwt_head_label="string",
    cwt_result="string", cwt_brood_year="int", specimen_reference_dna_no="string", dna_results_stock_1="string",
    dna_stock_2="string", region_1_name="string", prob_1="double", sex="string",
)
HATCHERY_REPORT = _schema(
    year="int", estimate_type="string", location="string", details="string", u="string", m="string", f="string",
    j="string", i="string",
)
SPATIAL_LOOKUP = _schema(
    sector="string", run_recon_area="string", creel_sub_area="string", lat="double", long="double", notes="string",
)
STREAMS = _schema(waterbody_name="string", area="string")
HATCHERY_SAMPLES = _schema(
    spawning_stock="string", bag_no="string", vial_no="string", book_no="string", scale_sample_no="string",
    cwt_tag_code="string", scale_gilbert_age="string", scale_part_age="string", total_age_yrs="string",
)
BATCHES = _schema(
    id="int", sector="string", sample_year="int", project_name="string", region="string", area="string",
    species="string", recovery_year="int", life_history="string",
)
PROJECTS = _schema(id="int", location="string")
CONTAINERS = _schema(
    id="string", batch_id="int", field_container_id="string", container_notes="string", analyst_name="string",
    cnt_start_date="string", cnt_end_date="string",
)
READINGS = _schema(
    id="int", container_id="string", project_name="string", region="string", area="string", species="string",
    recovery_year="int", life_history="string", fish_number="string", gr_age="string", scale_condition="string",
)
OTOLITH_MARKS = _schema(
    facility="string", box_code="string", cell_number="string", hatch_code="string", part_age_code="string",
    age_gr="string",
)
MARK_MASTER = _schema(
    brood_year="int", agency="string", facility="string", release_year="int", stock="string", hatch_code="string",
    state_province="string", site="string", number_released="bigint",
)

# Self-describing payload: column names, type tags and rows of text cells.
PAYLOAD = T.StructType(
    [
        T.StructField("Names", T.ArrayType(T.StringType())),
        T.StructField("Types", T.ArrayType(T.StringType())),
        T.StructField("Rows", T.ArrayType(T.StructType([T.StructField("Cells", T.ArrayType(T.StringType()))]))),
    ]
)
TAG_RELEASE_TYPES = {
    "Tagcode": "string", "Species Name": "string", "Project Name": "string", "Brood Year": "int",
    "Release Year": "int", "Stock Site Name": "string", "Stock PSC Region Name": "string",
    "Hatchery Site Name": "string", "Hatchery PSC Region Name": "string", "Release Site Name": "string",
    "Release PSC Region Name": "string", "Stage Code": "string",
}
STREAM_TYPES = {"Waterbody Name": "string", "Area": "string"}
