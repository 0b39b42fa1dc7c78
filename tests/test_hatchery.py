"""Hatchery linkage on small hand-written inputs."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import hatchery
from tidewater.plans import hatchery_link
from tidewater.session import Stage
from tidewater.sources import schemas
from tests.helpers import frame, one, records, rows

YEAR = 2022


@pytest.fixture
def samples(spark):
    stock = {"spawning_stock": "Conuma R"}
    return hatchery.hatchery_samples(records(
        spark, schemas.HATCHERY_SAMPLES,
        {**stock, "bag_no": "B1", "vial_no": "1", "book_no": "S1", "scale_sample_no": "1", "cwt_tag_code": "T1",
         "scale_gilbert_age": "41", "total_age_yrs": "4"},
        {**stock, "bag_no": "B1", "vial_no": "2", "book_no": "S1", "scale_sample_no": "2"},
        {**stock, "bag_no": "B1", "vial_no": None, "book_no": "S2", "scale_sample_no": "9"},
        {**stock, "scale_gilbert_age": "3M", "scale_part_age": "RG"},
        {"spawning_stock": "", "bag_no": "B9", "vial_no": "9"},
        {"spawning_stock": None, "bag_no": "B9", "vial_no": "9"},
    ))


def test_samples_get_link_keys(samples):
    assert rows(samples, "r_otolith_box_vial_concat", "r_scale_book_cell_concat", "r_tagcode") == [
        (None, None, None), (None, "S2-9", None), ("B1-1", "S1-1", "T1"), ("B1-2", "S1-2", None)]


@pytest.fixture
def inputs(spark):
    batch = {"sector": "SC", "sample_year": YEAR, "project_name": "P", "region": "R", "area": "A", "species": "Chinook",
             "recovery_year": YEAR, "life_history": "Adult"}
    reading = {k: batch[k] for k in ("project_name", "region", "area", "species", "recovery_year", "life_history")}
    batches = records(spark, schemas.BATCHES, {"id": 1, **batch}, {"id": 2, **batch}, {"id": 3, **batch, "sector": "NC"},
                      {"id": 4, **batch, "sample_year": 2021})
    projects = frame(spark, schemas.PROJECTS, (1, "Conuma"), (2, "Nitinat"), (3, "North"))
    containers = records(
        spark, schemas.CONTAINERS,
        {"id": "S1", "batch_id": 1, "cnt_start_date": "2022-09-01"}, {"id": "S2", "batch_id": 1},
        {"id": "S8", "batch_id": 3})
    readings = records(
        spark, schemas.READINGS,
        {"id": 1, "container_id": "S1", "fish_number": "1", "gr_age": "41", **reading},
        {"id": 1, "container_id": "S1", "fish_number": "2", "gr_age": "31", **reading},
        {"id": 1, "container_id": "S1", "fish_number": "3", "gr_age": "32", **{**reading, "recovery_year": 2021}},
        {"id": 3, "container_id": "S8", "fish_number": "1", "gr_age": "51", **reading},
    )
    otoliths = records(
        spark, schemas.OTOLITH_MARKS,
        {"facility": "H-CONUMA R ", "box_code": "B1", "cell_number": "1", "hatch_code": "H1"},
        {"facility": "H-ROBERTSON CR", "box_code": "B1", "cell_number": "2", "hatch_code": "H2"},
        {"facility": "H-X", "box_code": None, "cell_number": None, "hatch_code": "H9"},
    )
    names = list(schemas.TAG_RELEASE_TYPES)
    cells = ["T1", "Chinook", "Proj", "2018", "2019"] + ["Site"] * 6 + ["Smolt"]
    payload = spark.createDataFrame([(names, ["string"] * len(names), [(cells,)])], schemas.PAYLOAD)
    marks = records(
        spark, schemas.MARK_MASTER,
        {"brood_year": 2019, "hatch_code": "H2", "stock": "H-BURMAN RIVER", "state_province": "BRITISH COLUMBIA"},
        {"brood_year": 2019, "hatch_code": "H2", "stock": "S-GOLD", "state_province": "BRITISH COLUMBIA"},
        {"brood_year": 2018, "hatch_code": "H1", "stock": "S-CONUMA", "state_province": "ALASKA"},
        {"brood_year": 2018, "hatch_code": "H1", "stock": "S-NONE", "state_province": None},
    )
    raw = samples_raw(spark)
    return hatchery_link.LinkInputs(raw, batches, projects, containers, readings, otoliths, payload, marks)


def samples_raw(spark):
    stock = {"spawning_stock": "Conuma R"}
    return records(
        spark, schemas.HATCHERY_SAMPLES,
        {**stock, "bag_no": "B1", "vial_no": "1", "book_no": "S1", "scale_sample_no": "1", "cwt_tag_code": "T1",
         "scale_gilbert_age": "41", "total_age_yrs": "4"},
        {**stock, "bag_no": "B1", "vial_no": "2", "book_no": "S1", "scale_sample_no": "2"},
        {**stock, "scale_gilbert_age": "3M", "scale_part_age": "RG"},
    )


def test_scale_ages_keep_unmatched_rows_of_every_table(inputs):
    scales, readings = hatchery_link.scale_table(inputs, YEAR)
    assert rows(scales, "batch_id", "location", "container_id", "fish_number", "gr_age", "r_scale_book_cell_concat") == [
        (1, None, "S1", "3", "32", "S1-3"),       # reading whose recovery year does not match
        (1, "Conuma", "S1", "1", "41", "S1-1"),
        (1, "Conuma", "S1", "2", "31", "S1-2"),
        (1, "Conuma", "S2", None, None, None),    # container without readings
        (2, "Nitinat", None, None, None, None),   # batch without containers
    ]
    assert readings.count() == 3
    assert one(hatchery.scale_reconcile(scales, readings)) == (5, 2, 3, True)
    assert one(scales.filter("container_id = 'S1' and fish_number = '1'"), "cnt_start_date").isoformat() == "2022-09-01"


def test_linked_samples(inputs):
    tables = hatchery_link.link_tables(inputs, YEAR, na_matches="na")
    linked = tables["1 - all samples linked"]
    # the mark master holds two stocks for one code and year, so that sample is repeated; the sample without
    # otolith or scale keys meets the otolith and the batch that lack them too
    assert rows(linked, "r_otolith_box_vial_concat", "batch_id", "facility_x", "tagcode", "r_resolved_gr_age",
                "r_resolved_total_age", "r_brood_year", "r_resolved_stock_id") == [
        (None, 2, "H-X", None, None, None, None, None),
        ("B1-1", 1, "H-CONUMA RIVER H ", "T1", "41", "4", 2018, "Site"),
        ("B1-2", 1, "H-ROBERTSON CREEK H", None, "31", "3", 2019, "Burman River"),
        ("B1-2", 1, "H-ROBERTSON CREEK H", None, "31", "3", 2019, "Gold"),
    ]
    never = hatchery_link.link_tables(inputs, YEAR)["1 - all samples linked"]
    assert rows(never.filter("r_otolith_box_num is null"), "batch_id", "facility_x") == [(None, None)]
    assert [df.count() for df in list(tables.values())[1:]] == [3, 5, 3, 1, 2]


def test_checks(inputs):
    checks = hatchery_link.check_tables(inputs, YEAR, na_matches="na")
    assert one(checks["scale reconcile"], "reconciled") is True
    assert one(checks["age gain"]) == (0, 0, True)
    assert rows(checks["age discrepancies"]) == [
        (1, "S1-2", None, "31", "FALSE"), (2, None, "3M", None, "FALSE")]
    # without keys nothing is linked, so the sample has no batch
    never = hatchery_link.check_tables(inputs, YEAR)
    assert rows(never["age discrepancies"]) == [(1, "S1-2", None, "31", "FALSE")]


@pytest.mark.parametrize(
    "total, own, part, lab, resolved",
    [
        ("4", "41", None, "31", "41"), (None, None, None, "31", "31"), (None, None, None, "3M", None),
        (None, "41", "RG", "32", "32"), (None, "41", "1M", "31", None), (None, "41", "RG", None, None),
        ("4", None, None, "31", None),
    ],
)
def test_resolved_scale_age(spark, total, own, part, lab, resolved):
    df = frame(spark, "total_age_yrs string, scale_gilbert_age string, scale_part_age string, gr_age string",
               (total, own, part, lab))
    assert one(df.select(hatchery.resolved_gr_age())) == resolved


@pytest.mark.parametrize(
    "brood, age, lab, total",
    [
        (2018, None, None, "4"), (None, "31", "31", "3"), (None, "M1", "31", None),
        (None, "M1", "32", "M"),   # a lab age ending in 2 passes whatever the first test says
        (None, None, "32", None), (None, "31", None, None),
    ],
)
def test_resolved_total_age_precedence(spark, brood, age, lab, total):
    df = frame(spark, "tag_brood_year int, r_resolved_gr_age string, gr_age string", (brood, age, lab))
    assert one(df.select(hatchery.resolved_total_age(YEAR))) == total


def test_duplicates(spark):
    df = frame(spark, "r_otolith_box_vial_concat string, x int", ("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5))
    assert rows(hatchery.duplicate_codes(df)) == [("a",)]
    assert rows(hatchery.without_duplicates(df)) == [(None, 4), (None, 5), ("b", 3)]


def test_mark_tables(spark):
    bc = {"state_province": "BRITISH COLUMBIA", "stock": "s"}
    marks = records(
        spark, schemas.MARK_MASTER,
        {**bc, "brood_year": 2018, "hatch_code": "H1", "facility": "f", "number_released": 5},
        {**bc, "brood_year": 2018, "hatch_code": "H1", "facility": "f", "number_released": 6},
        {**bc, "brood_year": 2019, "hatch_code": "H1", "facility": "f", "number_released": 6},
        {**bc, "brood_year": 2019, "hatch_code": "H1", "facility": "f", "number_released": None},
        {**bc, "brood_year": 2019, "hatch_code": "H1", "facility": "g", "number_released": 1},
        {**bc, "brood_year": 2019, "hatch_code": "H2", "facility": None, "number_released": 1},
        {**bc, "brood_year": 2019, "hatch_code": "H3", "facility": "f", "stock": "s"},
        {**bc, "brood_year": 2019, "hatch_code": "H3", "facility": "f", "stock": None},
        {**bc, "brood_year": 2010, "hatch_code": "H4", "facility": "f"},
    )
    wide = hatchery.mark_crosstab(marks, [2018, 2019])
    assert wide.columns == ["hatch_code", "facility", "stock", "2018", "2019"]
    assert rows(wide.filter("hatch_code = 'H1'")) == [("H1", "f", "s", 11, None), ("H1", "g", "s", None, 1)]
    assert rows(hatchery.reused_hatch_codes(marks, [2018, 2019])) == [("H1", 2), ("H3", 2)]


def test_escapement_samples(spark):
    df = frame(
        spark, "year int, skip int, otolith_box string, otolith_specimen string, scale_book string, scale string",
        (2021, 0, "B", "1", "S", None))
    out = hatchery.escapement_samples(df, [("year", "year"), ("otolith_box", "scale")])
    assert "skip" not in out.columns
    assert one(out, "r_otolith_box_vial_concat", "r_scale_book_cell_concat", "r_sample_year") == ("B-1", None, 2021)


def test_links_equal_the_three_key_join(spark, inputs):
    """Book and cell decide the match; the joined text never changes it."""
    samples = hatchery.hatchery_samples(inputs.samples)
    scales, _ = hatchery_link.scale_table(inputs, YEAR)
    keys = ["r_scale_book_num", "r_scale_cell_num", "r_scale_book_cell_concat"]
    three = samples.alias("a").join(
        scales.alias("b"), F.expr(" and ".join(f"a.{k} = b.{k}" for k in keys)), "left")
    two = hatchery.link_scales(samples, scales)
    assert rows(three, "bag_no", "vial_no", "gr_age", "batch_id") == rows(two, "bag_no", "vial_no", "gr_age", "batch_id")


@pytest.fixture
def plain_shuffles(spark):
    """Neither broadcast nor adaptive, as the partitions of large tables are dealt."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_samples_without_a_key_are_dealt_to_all_tasks(plain_shuffles):
    spark = plain_shuffles
    code = F.concat(F.lit("B"), F.col("id"))
    aged = spark.range(2000).select(
        code.alias("r_otolith_box_vial_concat"), F.when(F.col("id") < 10, 2019).alias("r_brood_year"),
        F.when(F.col("id") < 500, F.lit("H1")).alias("r_hatch_code"))
    marks = frame(spark, "r_brood_year int, r_hatch_code string, stock string",
                  (2019, "H1", "a"), (2019, "H1", "b"), (2019, None, "c"), (None, "H1", "d"), (None, None, "e"))
    linked = hatchery.link_marks(aged, marks)
    assert linked.columns == ["r_otolith_box_vial_concat", "r_brood_year", "r_hatch_code", "stock"]
    assert rows(linked.groupBy("stock").count()) == [(None, 1990), ("a", 10), ("b", 10)]
    lone = linked.filter("stock is null").groupBy(F.spark_partition_id()).count()
    assert lone.count() > 4 and lone.agg(F.max("count")).first()[0] < 600


def test_samples_are_not_sorted_to_meet_scales_and_otoliths(plain_shuffles, inputs):
    samples = hatchery.hatchery_samples(inputs.samples)
    linked = hatchery.link_otoliths(samples, hatchery.otolith_marks(inputs.otoliths))
    plan = linked._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort " not in plan
    assert rows(linked, "bag_no", "vial_no", "hatch_code") == [(None, None, None), ("B1", "1", "H1"), ("B1", "2", "H2")]


@pytest.mark.parametrize("na_matches", ["never", "na"])
def test_all_links_equal_the_links_one_by_one(inputs, na_matches):
    tables = hatchery_link.link_tables(inputs, YEAR, na_matches=na_matches)
    _, samples, scales, otoliths, tags, marks = tables.values()
    scales = scales.withColumn("facility", F.lit("F"))  # a name of the otoliths and of the marks too
    linked = hatchery.link_scales(samples, scales, na_matches=na_matches)
    linked = hatchery.link_otoliths(linked, otoliths, na_matches=na_matches)
    linked = hatchery.resolve_ages(hatchery.link_tags(linked, tags, na_matches=na_matches), YEAR)
    linked = hatchery.link_marks(linked, marks, na_matches=na_matches).withColumn("r_resolved_stock_id", hatchery.resolved_stock())
    for repeats in ({}, hatchery.sample_repeats(samples)):
        packed = hatchery.link_all(samples, scales, otoliths, tags, marks, YEAR, na_matches=na_matches, repeats=repeats)
        assert packed.dtypes == linked.dtypes
        assert sorted(map(str, packed.collect())) == sorted(map(str, linked.collect()))


def test_linked_samples_are_moved_packed_and_without_repeats(plain_shuffles, inputs):
    """At each link the samples hold their own columns, one for each link before it, and what deals those without a key."""
    linked = hatchery_link.link_tables(inputs, YEAR)["1 - all samples linked"]
    plan = linked._jdf.queryExecution().optimizedPlan().toString()
    heads = plan.split("Relation")[0].split("LogicalRDD")[0].splitlines()
    joins = [i for i, line in enumerate(heads) if "Join LeftOuter" in line]
    # Below a join its left side comes first.
    moved = [heads[i + 1].split("[", 1)[1].count(", ") + 1 for i in joins if "Project [" in heads[i + 1]]
    assert moved and max(moved) <= 24, moved


@pytest.mark.parametrize("na_matches", ["never", "na"])
def test_staged_links_equal_those_of_one_plan(inputs, na_matches):
    one_plan, staged = (
        hatchery_link.link_tables(inputs, YEAR, na_matches=na_matches, staged=s)["1 - all samples linked"] for s in (False, True)
    )
    assert staged.dtypes == one_plan.dtypes
    assert sorted(map(str, staged.collect())) == sorted(map(str, one_plan.collect()))


def test_staged_links_keep_one_table(spark, inputs, monkeypatch):
    stages, settle = {}, Stage.settle
    monkeypatch.setattr(Stage, "settle", lambda self, df, name: stages.update({name: self}) or settle(self, df, name))
    hatchery_link.link_tables(inputs, YEAR, staged=True)
    assert list(stages) == ["scales", "otoliths", "tags"] and len(set(map(id, stages.values()))) == 1
    folder = spark._jvm.org.apache.hadoop.fs.Path(stages["tags"].path)
    there = [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder.getParent())]
    assert folder.getName() in there and not [t for t in there if t.startswith(("scales-", "otoliths-"))]


@pytest.mark.parametrize("na_matches", ["never", "na"])
def test_samples_without_a_key_are_not_moved_to_a_staged_link(inputs, na_matches):
    tables, moved = hatchery_link.link_tables(inputs, YEAR), []
    _, samples, scales, *_ = tables.values()
    link = lambda left, right, **how: moved.append(left) or hatchery.link_scales(left, right, **how)
    linked = hatchery._link_some(link, samples, scales, hatchery.SCALE_KEYS, na_matches)
    plain = hatchery.link_scales(samples, scales, na_matches=na_matches)
    assert linked.dtypes == plain.dtypes and sorted(map(str, linked.collect())) == sorted(map(str, plain.collect()))
    keyed = "r_scale_book_num is not null and r_scale_cell_num is not null"
    assert 0 < samples.filter(keyed).count() < samples.count()
    assert moved[0].count() == (samples.filter(keyed) if na_matches == "never" else samples).count()
