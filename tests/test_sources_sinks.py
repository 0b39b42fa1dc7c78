"""Readers, writers and composed runs."""

import datetime as dt
import json
import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidewater import rules, session
from tidewater.operators import quality
from tidewater.plans import sample_reports
from tidewater.sinks import bundle
from tidewater.sources import readers, schemas
from tests.helpers import frame, one, records, rows


def test_extract_with_preamble(spark, tmp_path):
    path = tmp_path / "streams.csv"
    path.write_text("Report of 2022-02-10,\nby someone,\nwaterbody_name,area\nBURMAN RIVER,25\nGOLD RIVER,\n")
    out = readers.read_extract(
        spark, str(path), schemas.STREAMS, fmt="csv", preamble="^(Report of|by someone|waterbody_name)")
    assert rows(out) == [("BURMAN RIVER", "25"), ("GOLD RIVER", None)]


def test_extract_cells_that_do_not_convert_are_null(spark, tmp_path):
    path = tmp_path / "lookup.csv"
    path.write_text("sector,run_recon_area,creel_sub_area,lat,long,notes\nsport,A,25D,49.5,x,\n")
    assert rows(readers.read_extract(spark, str(path), schemas.SPATIAL_LOOKUP, fmt="csv")) == [
        ("sport", "A", "25D", 49.5, None, None)]


def test_parquet_extract_reads_only_used_columns(spark, tmp_path):
    records(spark, schemas.BIOSAMPLES, {"year": 2021, "sex": "M"}).write.parquet(str(tmp_path / "bio"))
    out = readers.read_extract(spark, str(tmp_path / "bio"), schemas.BIOSAMPLES).filter("year = 2021").select("sex")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<year:int,sex:string>" in plan and rows(out) == [("M",)]


def test_many_files_are_tagged_with_their_name(spark, tmp_path):
    header = ",".join(schemas.HATCHERY_SAMPLES.names)
    for name in ("All_a.csv", "All_b.csv", "other.csv"):
        (tmp_path / name).write_text(f"{header}\n{name},B,1,,,,,,\n")
    out = readers.read_many(spark, f"{tmp_path}/All_*.csv", schemas.HATCHERY_SAMPLES)
    assert rows(out, "spawning_stock", "file_source", "book_no") == [
        ("All_a.csv", "All_a.csv", None), ("All_b.csv", "All_b.csv", None)]


def test_payload_rows_are_found_by_name_and_cast(spark, tmp_path):
    one_way = {"Names": ["A Name", "Count", "Share"], "Types": ["String", "Int32", "Single"],
               "Rows": [{"Cells": ["x", "1", "0.5"]}, {"Cells": ["y", None, "z"]}]}
    other = {"Names": ["Count", "Share", "A Name"], "Types": ["Int32", "Single", "String"],
             "Rows": [{"Cells": ["7", "1.5", "w"]}]}
    (tmp_path / "a.json").write_text(json.dumps(one_way))
    (tmp_path / "b.json").write_text(json.dumps(other, indent=1))
    types = readers.tagged_types(one_way["Names"], one_way["Types"])
    assert types == {"A Name": "string", "Count": "int", "Share": "double"}
    out = readers.decode_rows(readers.read_payload(spark, str(tmp_path), multi_line=True), types)
    assert rows(out, "a_name", "count", "share") == [("w", 7, 1.5), ("x", 1, 0.5), ("y", None, None)]


def test_query_document(spark):
    df = frame(spark, "FISCAL_YEAR int, SBJ_ID int, STAGE string, `SAMPLE_#` string",
               (2021, 5, "Adult", "a"), (2018, 5, "Adult", "b"), (2021, 6, "Adult", "c"), (2021, 5, None, "d"))
    doc = {"Fields": ["SAMPLE_#", "FISCAL_YEAR"], "Aggregates": [], "Orders": [],
           "Filters": [{"Column": "FISCAL_YEAR", "Value": "2019,2021"}, {"Column": "SBJ_ID", "Value": "5"},
                       {"Column": "STAGE", "Value": "Adult"}]}
    assert rows(readers.apply_query_doc(df, doc)) == [("a", 2021)]
    with pytest.raises(ValueError):
        readers.apply_query_doc(df, {**doc, "Orders": ["FISCAL_YEAR"]})


def test_latest_snapshot_reads_only_its_partition(spark, tmp_path):
    df = frame(spark, "x int, day string", (1, "2022-02-10"), (2, "2023-02-22"), (3, "2023-02-22"))
    df.write.partitionBy("day").parquet(str(tmp_path / "snap"))
    out = readers.latest_snapshot(spark.read.parquet(str(tmp_path / "snap")), "day")
    assert rows(out, "x") == [(2,), (3,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_bundle_with_descriptions(spark, tmp_path):
    tables = {"1 - all": frame(spark, "r_tagcode string", ("T1",)), "2 - none": frame(spark, "x int", (1,))}
    paths = bundle.write_bundle(
        tables, f"{tmp_path}/out", "2023-05-01_1200", descriptions={"1 - all": "everything"},
        names=rules.LINK_DISPLAY)
    assert paths["1 - all"] == f"{tmp_path}/out_2023-05-01_1200/1_all"
    assert spark.read.parquet(paths["1 - all"]).columns == ["(R) TAGCODE"]
    assert rows(spark.read.parquet(paths["metadata"])) == [("1 - all", "everything"), ("2 - none", None)]


def test_stamps_and_coded_names(spark, tmp_path):
    assert bundle.time_stamp(dt.datetime(2023, 2, 8, 7, 5)) == "2023-02-08_0705"
    assert bundle.coded_path("dir/Samples.xlsx", "s") == "dir/Samples_CODED_s"
    samples = records(spark, schemas.BIOSAMPLES, {"hatchery_origin": "Y", "resolved_stock_origin": "Gold River"})
    streams = frame(spark, schemas.STREAMS, ("GOLD RIVER", "25"))
    path = sample_reports.write_coded(samples, streams, f"{tmp_path}/Samples.csv", "s")
    assert path == f"{tmp_path}/Samples_CODED_s"
    assert one(spark.read.parquet(path), "`Term Sum (R)`", "`TermCON (R)`") == ("Hatchery NON-WCVI", "Hatchery NON-WCVI")


class _Session:
    """Stands for a session with some settings."""

    def __init__(self, **conf):
        self.sparkContext = SimpleNamespace(applicationId="app-1")
        self.conf = SimpleNamespace(get=lambda key, *default: conf.get(key, *default))


def test_shared_folder_follows_the_session():
    conf = {"spark.checkpoint.dir": "hdfs://shared/checks/", "spark.sql.warehouse.dir": "hdfs://house"}
    assert session.shared_folder(_Session(**conf)) == "hdfs://shared/checks/tidewater/app-1"
    del conf["spark.checkpoint.dir"]
    assert session.shared_folder(_Session(**conf)) == "hdfs://house/tidewater/app-1"


def test_settled_tables_keep_rows_and_schema(spark):
    settled = session.settle(frame(spark, "x int, y string", (1, None), (2, "b")), "t")
    assert rows(settled) == [(1, None), (2, "b")]
    assert session.shared_folder(spark) in settled.inputFiles()[0]


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {str(f) for d in folders for f in Path(d.getPath()).rglob("shuffle_*.data")}


@pytest.mark.parametrize("write", ["bundle", "stage"])
def test_shuffle_files_go_once_a_table_is_written(spark, tmp_path, write):
    before, old = shuffle_files(spark), spark.conf.get(session.CLEANUP, None)
    df = spark.range(1000).repartition(4, "id")
    if write == "bundle":
        at = bundle.write_table(df, str(tmp_path / "t"))
    else:
        at = session.Stage().settle(df, "t").inputFiles()[0]
    for _ in range(100):  # they are deleted meanwhile
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and spark.read.parquet(at).count() > 0 and spark.conf.get(session.CLEANUP, None) == old


def test_settled_small_side_is_broadcast_by_its_size(spark):
    small = session.settle(frame(spark, "k int", (1,)), "t")
    plan = spark.range(10).withColumn("k", F.col("id") % 3).join(small, "k", "left_semi")
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()


def test_qc_rule_ids_match_the_table():
    assert quality.QC_IDS == tuple(dict.fromkeys(quality.QC_IDS)) and len(quality.QC_IDS) == 13


def test_csv_columns_are_found_by_name_in_every_file(spark, tmp_path):
    (tmp_path / "a one.csv").write_text("area,waterbody_name\n25,BURMAN RIVER\n")
    (tmp_path / "b.csv").write_text("Streams of 2020,,\nprinted,by,hand\nwaterbody_name,other,area\nGOLD RIVER,x,26\nA,y,\n")
    (tmp_path / "c.csv").write_text('\ufeffwaterbody_name, area \n"TOFINO, CREEK",24\n')
    (tmp_path / "d.csv").write_text('"x","x","area","waterbody_name"\n1,2,23,"KAOUK ""K"" RIVER"\n')
    (tmp_path / "empty.csv").write_text("")
    got = readers.read_many(spark, str(tmp_path), schemas.STREAMS, preamble="^(Streams|printed)")
    assert rows(got.select("waterbody_name", "area", "file_source")) == [
        ("A", None, "b.csv"), ("BURMAN RIVER", "25", "a one.csv"), ("GOLD RIVER", "26", "b.csv"),
        ('KAOUK "K" RIVER', "23", "d.csv"), ("TOFINO, CREEK", "24", "c.csv"),
    ]
    assert got.columns == [*schemas.STREAMS.names, "file_source"]
    extract = readers.read_extract(spark, str(tmp_path / "a one.csv"), schemas.STREAMS, fmt="csv")
    assert rows(extract) == [("BURMAN RIVER", "25")] and extract.columns == schemas.STREAMS.names


def test_csv_files_without_the_columns_fail_before_any_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text("area,waterbody_name\n25,BURMAN RIVER\n")
    (tmp_path / "b.csv").write_text("area,river\n25,waterbody_name area\n")
    with pytest.raises(ValueError, match="no csv header.*b.csv"):
        readers.read_extract(spark, str(tmp_path), schemas.STREAMS, fmt="csv")
    (tmp_path / "b.csv").write_text("area,waterbody_name\nwaterbody_name,area\n")
    with pytest.raises(ValueError, match="several csv headers"):
        readers.read_extract(spark, str(tmp_path), schemas.STREAMS, fmt="csv")


def test_json_lines_are_read_one_record_a_line(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"x": 1, "y": "a"}\n{"x": 2}\n')
    schema = frame(spark, "x int, y string").schema
    assert rows(readers.read_readings(spark, str(tmp_path), schema)) == [(1, "a"), (2, None)]
