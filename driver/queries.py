"""One query per operator, over the views of ``driver.views``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from driver.views import view
from tidewater import rules
from tidewater.functions import dates, missing
from tidewater.functions.recode import area_label
from tidewater.operators import (
    biodata, catch, hatchery, joins, quality, reshape, review, stockgroups, sufficiency,
)
from tidewater.plans.hatchery_link import (
    LinkInputs, link_tables, scale_table, write_join_file, write_link_bundle, write_master,
)
from tidewater.plans.sample_reports import write_quality_report
from tidewater.plans.terminal_run import ConumaInputs, NitinatInputs, write_conuma_run, write_nitinat_run
from tidewater.session import settle, shared_folder
from tidewater.sinks import bundle
from tidewater.sinks.publish import publish_tables, read_published, snapshot_index as snapshots
from tidewater.sources import readers, schemas

Query = Callable[[SparkSession, str], DataFrame]

CONUMA_YEAR = 2000
NITINAT_YEAR = 2001
LINK_YEAR = 2022
MARK_YEARS = (2015, 2016, 2017, 2018, 2019, 2020)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


class Inputs:
    """Views of one folder by short name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, f"v_{name}")


# Inputs shared by several queries


def _blocks(i: Inputs) -> list[DataFrame]:
    one = {"k25": "PFMA 25"}
    return [
        i.block_aabm.withColumnsRenamed(
            {"month": "Five Nations AABM Chinook sold 2021", "k24": "PFMA 24", "k26": "PFMA 26", **one}
        ),
        i.block_muchalaht.withColumnsRenamed({"month": "Five Nations ISBM Muchalaht  Chinook sold -", **one}),
        i.block_conuma.withColumnsRenamed(
            {"month": "Five Nations ISBM Conuma Chinook sold - Esperanza/Nootka", **one}
        ),
        i.block_essr.withColumnsRenamed({"month": "Five Nations Conuma ESSR", **one}),
        i.block_other.withColumnsRenamed({"month": "Some other report", **one}),
    ]


def _gsi_extract(i: Inputs) -> DataFrame:
    dotted = {f"{name}_{n}": f"{name}.{n}" for name in ("repunit", "collection", "prob") for n in (1, 2)}
    return i.gsi.withColumnsRenamed(dotted)


def _samples(i: Inputs) -> DataFrame:
    return biodata.biosamples(
        i.samples, rules.CONUMA_SPORT_AREAS, rules.CONUMA_SAMPLE_SUB_AREAS, river="conuma"
    )


def _conuma_catch(i: Inputs) -> DataFrame:
    return catch.conuma_catch(
        i.catch, catch.commercial_catch(i.commercial), catch.nations_catch(_blocks(i), CONUMA_YEAR), i.lookup,
        CONUMA_YEAR,
    )


def _conuma_bio(i: Inputs) -> DataFrame:
    return biodata.conuma_biodata(_samples(i), biodata.gsi_results(_gsi_extract(i), CONUMA_YEAR - 1), i.lookup)


def _nitinat_catch(i: Inputs) -> DataFrame:
    return catch.nitinat_catch(i.catch, i.report, i.lookup, NITINAT_YEAR)


def _nitinat_bio(i: Inputs) -> DataFrame:
    samples = biodata.biosamples(
        i.samples, rules.NITINAT_SPORT_AREAS, rules.NITINAT_SAMPLE_SUB_AREAS, river="nitinat"
    )
    return biodata.nitinat_biodata(samples, i.lookup)


def _sufficiency(i: Inputs) -> DataFrame:
    return sufficiency.sample_sufficiency(_conuma_catch(i), _conuma_bio(i), CONUMA_YEAR)


def _tag_payload(i: Inputs) -> DataFrame:
    """The tag releases as self-describing payloads, one per release."""
    names = list(schemas.TAG_RELEASE_TYPES)
    cells = F.array(*[F.col(c).cast("string") for c in rules.TAG_COLUMNS])
    return i.tags.select(
        F.array(*[F.lit(n) for n in names]).alias("Names"),
        F.array(*[F.lit("int32" if t == "int" else t) for t in schemas.TAG_RELEASE_TYPES.values()]).alias("Types"),
        F.array(F.struct(cells.alias("Cells"))).alias("Rows"),
    )


def _link_inputs(i: Inputs) -> LinkInputs:
    return LinkInputs(
        i.hatchery, i.batches, i.projects, i.containers, i.readings, i.otoliths, _tag_payload(i), i.marks
    )


def _hatchery(i: Inputs) -> DataFrame:
    return hatchery.hatchery_samples(i.hatchery)


def _scales(i: Inputs) -> tuple[DataFrame, DataFrame]:
    return scale_table(_link_inputs(i), LINK_YEAR)


def _otoliths_linked(i: Inputs) -> DataFrame:
    linked = hatchery.link_scales(_hatchery(i), _scales(i)[0])
    return hatchery.link_otoliths(linked, hatchery.otolith_marks(i.otoliths))


def _resolved(i: Inputs) -> DataFrame:
    linked = hatchery.link_tags(_otoliths_linked(i), hatchery.tag_releases(i.tags))
    return hatchery.resolve_ages(linked, LINK_YEAR)


RESOLVED_COLUMNS = (
    "spawning_stock", "r_scale_book_cell_concat", "r_otolith_box_vial_concat", "r_tagcode", "gr_age", "hatch_code",
    "tag_brood_year", "r_resolved_gr_age", "r_resolved_total_age", "r_sample_year", "r_brood_year", "r_hatch_code",
)


# Catch and escapement


@query
def sport_catch(spark, sf_dir):
    return catch.sport_catch(Inputs(spark, sf_dir).catch, rules.CONUMA_SPORT_AREAS)


@query
def area_lookup(spark, sf_dir):
    areas = {**rules.CONUMA_SPORT_AREAS, **rules.NITINAT_SPORT_AREAS}
    rows = Inputs(spark, sf_dir).catch.select(
        "creel_sub_area", area_label("creel_sub_area", areas, "sport").alias("run_recon_area")
    )
    return rows.groupBy("creel_sub_area", "run_recon_area").agg(F.count(F.lit(1)).alias("n"))


@query
def fishery_region(spark, sf_dir):
    return catch.fishery_region(Inputs(spark, sf_dir).catch)


@query
def sport_mortality(spark, sf_dir):
    return catch.sport_mortality(catch.sport_catch(Inputs(spark, sf_dir).catch, rules.CONUMA_SPORT_AREAS))


@query
def sport_totals(spark, sf_dir):
    rows = Inputs(spark, sf_dir).catch
    return catch.sport_totals(rows, rules.CONUMA_SPORT_AREAS, (25,), CONUMA_YEAR, 3)


@query
def stat_week(spark, sf_dir):
    days = Inputs(spark, sf_dir).commercial.groupBy("fishing_date").agg(F.count(F.lit(1)).alias("n"))
    return days.withColumn("statweek", dates.stat_week("fishing_date"))


@query
def commercial_catch(spark, sf_dir):
    return catch.commercial_catch(Inputs(spark, sf_dir).commercial)


@query
def commercial_mortality(spark, sf_dir):
    return catch.commercial_mortality(catch.commercial_catch(Inputs(spark, sf_dir).commercial))


@query
def nations_catch(spark, sf_dir):
    return catch.nations_catch(_blocks(Inputs(spark, sf_dir)), CONUMA_YEAR)


@query
def hatchery_report(spark, sf_dir):
    return catch.hatchery_report(Inputs(spark, sf_dir).report)


@query
def river_sport_total(spark, sf_dir):
    return catch.river_sport_total(catch.hatchery_report(Inputs(spark, sf_dir).report))


@query
def fn_total(spark, sf_dir):
    return catch.fn_total(catch.hatchery_report(Inputs(spark, sf_dir).report))


@query
def escapement_total(spark, sf_dir):
    return catch.escapement_total(catch.hatchery_report(Inputs(spark, sf_dir).report))


@query
def report_totals(spark, sf_dir):
    return catch.report_totals(Inputs(spark, sf_dir).report)


@query
def georeference(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    samples = _samples(i).filter(F.col("sector") == "sport")
    kept = samples.select("sector", "creel_sub_area", "run_recon_area", "ufid", "resolved_age")
    return catch.georeference(kept, i.lookup, "sport", ["run_recon_area"])


@query
def natural_full_join(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    kept = i.catch.groupBy("creel_sub_area").agg(F.sum("estimate").alias("estimate"))
    places = i.lookup.filter(F.col("sector") == "sport").select("creel_sub_area", "run_recon_area", "lat")
    return joins.natural_join(kept, places, "full", hot="left")


@query
def hot_full_join(spark, sf_dir):
    """Catch and commercial landings by month, both sides with few and large keys, counted by what they share."""
    i = Inputs(spark, sf_dir)
    kept = i.catch.groupBy("month", "pfma", "creel_sub_area").agg(F.sum("estimate").alias("estimate"))
    days = i.commercial.groupBy(F.date_format("fishing_date", "MMMM").alias("month"), "licence_area").agg(F.count(F.lit(1)).alias("days"))
    met = joins.join_on(kept, days, ["month"], "full", hot="both")
    return met.groupBy("month", "licence_area").agg(F.count(F.lit(1)).alias("n"), F.sum("estimate").alias("estimate"), F.sum("days").alias("days"))


@query
def sport_dispositions(spark, sf_dir):
    """Sport catch by area and month, a column for every disposition that occurs."""
    rows = Inputs(spark, sf_dir).catch.select("year", "month", "pfma", "disposition", "estimate")
    return reshape.spread_occurring(rows, "disposition", "estimate", missing="undeclared")


@query
def compile_catch(spark, sf_dir):
    return _conuma_catch(Inputs(spark, sf_dir))


@query
def compile_catch_nitinat(spark, sf_dir):
    return _nitinat_catch(Inputs(spark, sf_dir))


# Biological samples


@query
def biosamples(spark, sf_dir):
    return _samples(Inputs(spark, sf_dir))


@query
def biosamples_nitinat(spark, sf_dir):
    return biodata.biosamples(
        Inputs(spark, sf_dir).samples, rules.NITINAT_SPORT_AREAS, rules.NITINAT_SAMPLE_SUB_AREAS, river="nitinat"
    )


@query
def gsi_results(spark, sf_dir):
    return biodata.gsi_results(_gsi_extract(Inputs(spark, sf_dir)), CONUMA_YEAR - 1)


@query
def pbt_ages(spark, sf_dir):
    wide = Inputs(spark, sf_dir).pbt.withColumnsRenamed({"jul": "A25_07(Jul)", "aug": "A25_08(Aug)"})
    return biodata.pbt_ages(wide, ["A25_07(Jul)", "A25_08(Aug)"])


@query
def compile_biodata(spark, sf_dir):
    return _conuma_bio(Inputs(spark, sf_dir))


@query
def compile_biodata_nitinat(spark, sf_dir):
    return _nitinat_bio(Inputs(spark, sf_dir))


@query
def sample_overview(spark, sf_dir):
    return biodata.sample_overview(Inputs(spark, sf_dir).samples)


@query
def thermal_marks(spark, sf_dir):
    return biodata.thermal_marks(Inputs(spark, sf_dir).readings)


@query
def age_composition(spark, sf_dir):
    return biodata.age_composition(Inputs(spark, sf_dir).ages, 2021)


# Sample sufficiency


@query
def sample_sufficiency(spark, sf_dir):
    return _sufficiency(Inputs(spark, sf_dir))


@query
def orphan_ufids(spark, sf_dir):
    return sufficiency.orphan_ufids(_sufficiency(Inputs(spark, sf_dir)))


@query
def fishery_counts(spark, sf_dir):
    """The count table of one extract brought up to date with another's, cut where the year begins."""
    bio = settle(_conuma_bio(Inputs(spark, sf_dir)), "samples")
    older = F.coalesce(F.col("year") < CONUMA_YEAR, F.lit(False))
    return sufficiency.add_counts(
        sufficiency.fishery_counts(bio.filter(older)), sufficiency.fishery_counts(bio.filter(~older))
    )


def _counted(i: Inputs, bio: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The samples' counts, and the orphans that follow from them."""
    counts = settle(sufficiency.fishery_counts(bio), "counts")
    enough = sufficiency.sufficiency_of_counts(_conuma_catch(i), counts, CONUMA_YEAR)
    return counts, settle(sufficiency.orphan_ufids(enough), "orphans")


@query
def orphan_candidates(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    bio = settle(_conuma_bio(i), "samples")
    return sufficiency.orphan_candidates(bio, _counted(i, bio)[1])


@query
def missed_samples(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return sufficiency.missed_of_counts(*_counted(i, _conuma_bio(i)), CONUMA_YEAR)


@query
def orphan_table(spark, sf_dir):
    return sufficiency.orphan_table(sufficiency.orphan_ufids(_sufficiency(Inputs(spark, sf_dir))))


# Review tables


@query
def catch_points(spark, sf_dir):
    return review.catch_points(_conuma_catch(Inputs(spark, sf_dir)), CONUMA_YEAR)


@query
def sample_points(spark, sf_dir):
    return review.sample_points(_conuma_bio(Inputs(spark, sf_dir)), CONUMA_YEAR, 1)


@query
def sample_points_all_years(spark, sf_dir):
    return review.sample_points(_conuma_bio(Inputs(spark, sf_dir)), CONUMA_YEAR, range(4))


@query
def temporal_catch_nitinat(spark, sf_dir):
    return review.temporal_catch(_nitinat_catch(Inputs(spark, sf_dir)), NITINAT_YEAR, "total")


@query
def temporal_samples_nitinat(spark, sf_dir):
    return review.temporal_samples(_nitinat_bio(Inputs(spark, sf_dir)))


@query
def temporal_catch(spark, sf_dir):
    return review.temporal_catch(_conuma_catch(Inputs(spark, sf_dir)), CONUMA_YEAR)


@query
def temporal_samples(spark, sf_dir):
    return review.temporal_samples(_conuma_bio(Inputs(spark, sf_dir)))


@query
def ufid_table(spark, sf_dir):
    return review.ufid_table(_conuma_catch(Inputs(spark, sf_dir)), CONUMA_YEAR)


@query
def ufid_table_nitinat(spark, sf_dir):
    caught = _nitinat_catch(Inputs(spark, sf_dir))
    return review.ufid_table(caught, NITINAT_YEAR, "total", keep_zero=True, by_month=True)


def _stacked(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables of a published set in one, with each row's table name; a column that is text in one is text in all."""
    text = {c for df in tables.values() for c, kind in df.dtypes if kind == "string"}
    named = [
        df.withColumns({c: F.col(f"`{c}`").cast("string") for c, kind in df.dtypes if c in text and kind != "string"})
        .withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{bundle.unique_suffix()}"


def _conuma_inputs(i: Inputs) -> ConumaInputs:
    return ConumaInputs(i.catch, i.commercial, _blocks(i), i.samples, _gsi_extract(i), i.lookup)


@query
def conuma_report(spark, sf_dir):
    """A whole run written, published and read back."""
    base = _fresh(spark, "conuma")
    write_conuma_run(_conuma_inputs(Inputs(spark, sf_dir)), CONUMA_YEAR, base, "run")
    return _stacked(read_published(spark, base))


@query
def nitinat_report(spark, sf_dir):
    """A whole run written, published and read back."""
    i, base = Inputs(spark, sf_dir), _fresh(spark, "nitinat")
    write_nitinat_run(NitinatInputs(i.catch, i.report, i.samples, i.lookup), NITINAT_YEAR, base, "run")
    return _stacked(read_published(spark, base))


@query
def snapshot_index(spark, sf_dir):
    """Two sets of tables published after another: every table with its rows, from the manifests alone."""
    i, base = Inputs(spark, sf_dir), _fresh(spark, "snapshots")
    for stamp, tables in (("first", {"marks": i.marks, "tags": i.tags}), ("second", {"marks": hatchery.mark_master(i.marks)})):
        publish_tables(tables, base, stamp)
    return snapshots(spark, base).select("number", "stamp", "table_name", "n_rows")


# Stock groups


@query
def stream_areas(spark, sf_dir):
    return stockgroups.stream_areas(Inputs(spark, sf_dir).streams)


@query
def code_stock_groups(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return stockgroups.code_stock_groups(i.samples, settle(stockgroups.stream_areas(i.streams), "streams"))


# Hatchery linkage


@query
def hatchery_samples(spark, sf_dir):
    return _hatchery(Inputs(spark, sf_dir))


@query
def batch_meta(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    described = hatchery.batch_meta(i.projects, i.batches).select("id", "location", "project_name")
    counts = i.containers.groupBy(F.col("batch_id").alias("id")).agg(F.count(F.lit(1)).alias("containers"))
    return joins.join_on(described, counts, ["id"])


@query
def container_meta(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    ids = hatchery.select_batches(i.batches, "SC", LINK_YEAR)
    return hatchery.container_meta(hatchery.in_batches(i.containers, ids, "batch_id"))


@query
def scale_ages(spark, sf_dir):
    return _scales(Inputs(spark, sf_dir))[0]


@query
def scale_reconcile(spark, sf_dir):
    return hatchery.scale_reconcile(*_scales(Inputs(spark, sf_dir)))


@query
def otolith_marks(spark, sf_dir):
    return hatchery.otolith_marks(Inputs(spark, sf_dir).otoliths)


@query
def mark_master(spark, sf_dir):
    return hatchery.mark_master(Inputs(spark, sf_dir).marks)


@query
def tag_releases(spark, sf_dir):
    return hatchery.tag_releases(Inputs(spark, sf_dir).tags)


@query
def link_scales(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return hatchery.link_scales(_hatchery(i), _scales(i)[0])


@query
def link_otoliths(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return hatchery.link_otoliths(_hatchery(i), hatchery.otolith_marks(i.otoliths))


@query
def link_tags(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return hatchery.link_tags(_hatchery(i), hatchery.tag_releases(i.tags))


@query
def link_tags_never(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return hatchery.link_tags(_hatchery(i), hatchery.tag_releases(i.tags), na_matches="never")


@query
def factored_tags(spark, sf_dir):
    """Samples by stock and tag brood year with missing tag codes matching each other, from counts of both sides."""
    i = Inputs(spark, sf_dir)
    linked = hatchery.factored_tags(_hatchery(i), _na_tags(i))
    return linked.counts(["spawning_stock"], ["tag_brood_year"]).withColumn("n", F.col("n").cast("long"))


def _na_tags(i: Inputs) -> DataFrame:
    """Tag releases of which one brood year has lost its codes."""
    tags = hatchery.tag_releases(i.tags)
    lost = F.pmod(F.col("tag_brood_year"), F.lit(3)) == 0
    return tags.withColumn("r_tagcode", F.when(~F.coalesce(lost, F.lit(False)), F.col("r_tagcode")))


@query
def resolve_ages(spark, sf_dir):
    return _resolved(Inputs(spark, sf_dir)).select(*RESOLVED_COLUMNS)


@query
def link_marks(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    aged = _resolved(i).select("r_otolith_box_vial_concat", "r_brood_year", "r_hatch_code")
    return hatchery.link_marks(aged, hatchery.mark_master(i.marks))


@query
def resolved_stock(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    linked = hatchery.link_marks(_resolved(i), hatchery.mark_master(i.marks))
    named = linked.withColumn("r_resolved_stock_id", hatchery.resolved_stock())
    return named.groupBy("r_resolved_stock_id", "r_resolved_total_age").agg(F.count(F.lit(1)).alias("n"))


@query
def age_gain_check(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    samples = _hatchery(i)
    return hatchery.age_gain_check(samples, hatchery.link_scales(samples, _scales(i)[0]))


@query
def age_discrepancies(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return hatchery.age_discrepancies(hatchery.link_scales(_hatchery(i), _scales(i)[0]))


@query
def duplicate_codes(spark, sf_dir):
    return hatchery.duplicate_codes(_hatchery(Inputs(spark, sf_dir)))


@query
def without_duplicates(spark, sf_dir):
    return hatchery.without_duplicates(_hatchery(Inputs(spark, sf_dir)))


@query
def otoliths_without_mark(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    marks = hatchery.mark_master(i.marks).select("hatch_code")
    return joins.rows_not_in(hatchery.otolith_marks(i.otoliths), marks, "hatch_code")


@query
def linked_stock_ages(spark, sf_dir):
    """The whole linkage from landed inputs, counted by resolved stock, age and brood year."""
    linked = link_tables(_link_inputs(Inputs(spark, sf_dir)), LINK_YEAR)["1 - all samples linked"]
    keys = ("r_resolved_stock_id", "r_resolved_gr_age", "r_resolved_total_age", "r_brood_year")
    return linked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query
def mark_crosstab(spark, sf_dir):
    return hatchery.mark_crosstab(Inputs(spark, sf_dir).marks, MARK_YEARS)


@query
def reused_hatch_codes(spark, sf_dir):
    return hatchery.reused_hatch_codes(Inputs(spark, sf_dir).marks, MARK_YEARS)


@query
def select_blocks(spark, sf_dir):
    blocks = [("year", "stock"), ("otolith_box", "otolith_specimen"), ("scale_book", "scale")]
    return hatchery.escapement_samples(Inputs(spark, sf_dir).escapement, blocks)


# Quality rules


@query
def qc_summary(spark, sf_dir):
    return quality.qc_summary(Inputs(spark, sf_dir).samples)


def _failures(issue_id: str) -> Query:
    return lambda spark, sf_dir: quality.qc_failures(Inputs(spark, sf_dir).samples, issue_id)


for _issue in quality.QC_IDS:
    QUERIES["qc_" + _issue.replace(".", "_")] = _failures(_issue)


# Sources and sinks


QUERY_DOC = {
    "Schema": "AGES",
    "DataSource": "READINGS",
    "Fields": ["fiscal_year", "project", "location", "gr_age"],
    "Aggregates": [],
    "Filters": [
        {"Column": "fiscal_year", "Value": "2021,2022"},
        {"Column": "geographic_location", "Value": "WCVI"},
        {"Column": "location", "Value": "Conuma River,Gold River"},
    ],
    "Orders": [],
}


@query
def query_doc(spark, sf_dir):
    return readers.apply_query_doc(Inputs(spark, sf_dir).ages, QUERY_DOC)


@query
def decode_rows(spark, sf_dir):
    return readers.decode_rows(_tag_payload(Inputs(spark, sf_dir)), schemas.TAG_RELEASE_TYPES)


@query
def latest_snapshot(spark, sf_dir):
    return readers.latest_snapshot(Inputs(spark, sf_dir).snapshots, "snapshot")


@query
def read_many(spark, sf_dir):
    folder = f"{shared_folder(spark)}/csv-{bundle.unique_suffix()}"
    bundle.write_table(Inputs(spark, sf_dir).hatchery, folder, fmt="csv")
    return readers.read_many(spark, f"{folder}/*.csv", schemas.HATCHERY_SAMPLES).withColumn(
        "file_source", F.regexp_replace("file_source", r"^part-.*[.]csv$", "part.csv"))


@query
def read_extract(spark, sf_dir):
    """Streams landed as csv under a header line and read back, header and blank lines left out."""
    folder = f"{shared_folder(spark)}/csv-{bundle.unique_suffix()}"
    bundle.write_table(Inputs(spark, sf_dir).streams, folder, fmt="csv")
    return readers.read_extract(spark, folder, schemas.STREAMS, fmt="csv", preamble="^waterbody_name$")


@query
def read_layouts(spark, sf_dir):
    """Streams landed as csv files of two layouts, read as one table by the names in each header."""
    folder, streams = _fresh(spark, "layouts"), Inputs(spark, sf_dir).streams
    bundle.write_table(streams.select("waterbody_name", "area"), f"{folder}/one", fmt="csv")
    bundle.write_table(streams.select("area", F.lit("x").alias("by"), "waterbody_name"), f"{folder}/two", fmt="csv")
    read = readers.read_many(spark, [f"{folder}/one", f"{folder}/two"], schemas.STREAMS)
    return read.groupBy("waterbody_name", "area").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file_source").alias("files"))


@query
def read_readings(spark, sf_dir):
    """Scale readings landed as json records and read back under their schema."""
    folder, readings = _fresh(spark, "json"), Inputs(spark, sf_dir).readings
    bundle.write_table(readings, folder, fmt="json")
    return readers.read_readings(spark, folder, readings.schema)


@query
def sectors(spark, sf_dir):
    return sufficiency.sectors(_conuma_catch(Inputs(spark, sf_dir)))


@query
def orphan_display(spark, sf_dir):
    return sufficiency.orphan_display(sufficiency.orphan_ufids(_sufficiency(Inputs(spark, sf_dir))), CONUMA_YEAR)


@query
def stack_frames(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return reshape.stack_frames([i.tags.select("tagcode", "brood_year"), i.marks.select("hatch_code", "brood_year")])


@query
def quality_report(spark, sf_dir):
    """The quality report written in one scan, and all its tables read back."""
    base = _fresh(spark, "quality")
    write_quality_report(Inputs(spark, sf_dir).samples, base, "stamp")
    return _stacked(read_published(spark, base))


@query
def link_bundle(spark, sf_dir):
    """The link bundle written under display names, and all its tables read back."""
    base = _fresh(spark, "links")
    write_link_bundle(_link_inputs(Inputs(spark, sf_dir)), LINK_YEAR, base, "stamp")
    return _stacked(read_published(spark, base))


@query
def link_exports(spark, sf_dir):
    """The master and the join file, read back and counted by what both have."""
    i, folder = Inputs(spark, sf_dir), _fresh(spark, "exports")
    linked = link_tables(_link_inputs(i), LINK_YEAR, staged=True)["1 - all samples linked"]
    files = {"master": write_master(i.hatchery, folder, "s"), "join": write_join_file(linked, folder, "s")}
    own = {shown: name for name, shown in rules.LINK_DISPLAY.items()}
    keys = ["r_otolith_box_vial_concat", "r_scale_book_cell_concat", "r_tagcode"]
    return _stacked({name: spark.read.parquet(p).withColumnsRenamed(own).select(*keys) for name, p in files.items()}).groupBy(
        "table_name", *keys).agg(F.count(F.lit(1)).alias("n"))


@query
def write_bundle_roundtrip(spark, sf_dir):
    """A bundle with descriptions, all its tables read back."""
    samples = Inputs(spark, sf_dir).samples
    tables = {"Summary": quality.qc_summary(samples), "7 - Area": quality.qc_failures(samples, "7")}
    base = f"{shared_folder(spark)}/report-{bundle.unique_suffix()}"
    paths = bundle.write_bundle(tables, base, "stamp", descriptions={"Summary": "counts"})
    return _stacked({name: spark.read.parquet(path) for name, path in paths.items()})


@query
def cast_missing(spark, sf_dir):
    """Null-safe helpers on one table: pasted keys, guarded keys, membership."""
    rows = Inputs(spark, sf_dir).hatchery
    keyed = rows.select(
        missing.paste("bag_no", "vial_no", sep="-").alias("pasted"),
        missing.join_present("bag_no", "vial_no").alias("guarded"),
        missing.not_in("scale_part_age", rules.UNREADABLE_SCALES).alias("readable"),
        missing.matches("scale_gilbert_age", "1$|2$").alias("full_age"),
    )
    return keyed.groupBy("pasted", "guarded", "readable", "full_age").agg(F.count(F.lit(1)).alias("n"))
