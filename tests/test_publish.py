"""Sets of tables published as a whole, runs that are taken up again, and counts that merge."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from driver.queries import CONUMA_YEAR, Inputs, _conuma_bio, _conuma_catch, _conuma_inputs
from tests.helpers import frame, records, rows
from tidewater.operators import quality, sufficiency
from tidewater.plans import sample_reports, terminal_run
from tidewater.session import settle
from tidewater.sinks.publish import Publication, Store, publish_tables, read_published, run_steps, snapshot_index
from tidewater.sources import schemas

SF_DIR = "/root/testdata/sf0.001"


def table(spark, *values):
    return frame(spark, "x int, `two words` string", *[(v, None) for v in values])


def failing(spark):
    return spark.range(10).select(F.raise_error(F.lit("lost")).cast("int").alias("x"))


def test_a_set_is_replaced_as_a_whole_or_not_at_all(spark, tmp_path):
    base = f"{tmp_path}/report"
    with pytest.raises(FileNotFoundError):
        read_published(spark, base)
    assert publish_tables({"a": table(spark, 1), "b c": table(spark, 2, 2)}, base, "day", descriptions={"a": "one"}) == 1
    before = read_published(spark, base)
    assert rows(before["a"]) == [(1, None)] and rows(before["metadata"]) == [("a", "one"), ("b c", None)]
    # The second table of the next set fails: readers go on with the set before, all of it.
    with pytest.raises(Exception, match="lost"):
        publish_tables({"a": table(spark, 7), "b c": failing(spark)}, base, "day")
    now = read_published(spark, base)
    assert rows(now["a"]) == [(1, None)] and rows(now["b c"], "x") == [(2,), (2,)]
    # Under the same stamp the first table is finished; the set is published with what was written then.
    assert publish_tables({"a": failing(spark), "b c": table(spark, 8)}, base, "day") == 2
    now = read_published(spark, base)
    assert set(now) == {"a", "b c"} and rows(now["a"]) == [(7, None)] and rows(now["b c"], "x") == [(8,)]
    # What was read before keeps its files.
    assert rows(before["b c"], "x") == [(2,), (2,)]


def test_empty_tables_and_display_names_are_read_back(spark, tmp_path):
    base = str(tmp_path)
    publish_tables({"none": table(spark), "some": table(spark, 3)}, base, "s", names={"x": "The (X)"})
    got = read_published(spark, base, "s")
    assert got["none"].columns == got["some"].columns == ["x", "two words"] and rows(got["some"], "x") == [(3,)] and not rows(got["none"])
    with pytest.raises(FileNotFoundError):
        read_published(spark, base, "other")
    assert "The (X)" in spark.read.parquet(f"{base}/versions/*/some").columns


def test_the_index_of_sets_is_made_without_reading_tables(spark, tmp_path):
    base = str(tmp_path)
    for stamp, values in (("monday", (1, 2)), ("tuesday", (2, 1)), ("monday", (5,))):
        publish_tables({"t": table(spark, *values)}, base, stamp)
    index = snapshot_index(spark, base)
    found = [tuple(r) for r in index.orderBy("number").collect()]
    assert [r[:3] + (r[4],) for r in found] == [(1, "monday", "t", 2), (2, "tuesday", "t", 2), (3, "monday", "t", 1)]
    assert found[0][5] == found[1][5] != found[2][5]  # the same rows in another order have the same digest
    assert len({r[3] for r in found}) == 3
    assert "Scan parquet" not in index._jdf.queryExecution().executedPlan().toString()
    assert rows(read_published(spark, base, "monday")["t"], "x") == [(5,)] and rows(read_published(spark, base, "tuesday")["t"], "x") == [(1,), (2,)]


def test_two_runs_cannot_publish_the_same_number(spark, tmp_path):
    one, two = Publication(spark, str(tmp_path), "a"), Store(spark, str(tmp_path))
    one.write("t", table(spark, 1))
    two.write("manifests/00000001.json", "{}")
    assert two.names("manifests") == ["00000001.json"]
    with pytest.raises(FileExistsError):
        two.write("manifests/00000001.json", "{}")


def test_a_run_goes_on_at_the_first_table_it_had_not_finished(spark, tmp_path):
    calls = Counter()

    def step(name, make):
        def run(t):
            calls[name] += 1
            return make(t)

        return run

    broken = [True]
    steps = {
        "shared": step("shared", lambda t: table(spark, 1, 2, 3)),
        "large": step("large", lambda t: t["shared"].filter("x > 1")),
        "last": step("last", lambda t: failing(spark) if broken[0] else t["large"].filter("x > 2")),
    }
    with pytest.raises(Exception, match="lost"):
        run_steps(spark, steps, str(tmp_path), "run", hidden=("shared",))
    broken[0] = False
    assert run_steps(spark, steps, str(tmp_path), "run", hidden=("shared",)) == 1
    assert calls == {"shared": 1, "large": 1, "last": 2}
    got = read_published(spark, str(tmp_path))
    assert set(got) == {"large", "last"} and rows(got["last"], "x") == [(3,)]
    assert run_steps(spark, steps, str(tmp_path), "run") == 2 and calls["shared"] == 2  # published runs are done anew


def test_a_whole_run_reads_the_samples_and_the_catch_once(spark, tmp_path):
    i = Inputs(spark, SF_DIR)
    marked = {}
    for name in ("samples", "catch"):
        path = str(tmp_path / name)
        getattr(i, name).write.parquet(path)
        marked[name] = spark.read.parquet(path)
    inputs = _conuma_inputs(i)
    inputs = terminal_run.ConumaInputs(marked["catch"], inputs.commercial, inputs.nations, marked["samples"], inputs.gsi, inputs.lookup)
    read = Counter()

    def counted(step):
        def run(t):
            df = step(t)
            for name in marked:
                read[name] += any(f"{tmp_path}/{name}/" in f for f in df.inputFiles())
            return df

        return run

    steps = {name: counted(step) for name, step in terminal_run.conuma_steps(inputs, CONUMA_YEAR).items()}
    run_steps(spark, steps, f"{tmp_path}/out", "run", hidden=terminal_run.CONUMA_HIDDEN)
    assert read == {"samples": 1, "catch": 1}
    got = read_published(spark, f"{tmp_path}/out")
    lazy = terminal_run.conuma_tables(inputs, CONUMA_YEAR)
    assert set(got) == set(lazy) and len(got) == 16
    for name in ("sufficiency", "missed samples", "sample points 1", "temporal samples"):
        assert rows(got[name]) == rows(lazy[name].select(*got[name].columns))


# ---------------------------------------------------------------- quality report


def test_quality_report_replaces_the_previous_one(spark, tmp_path):
    first = records(spark, schemas.BIOSAMPLES, {"sex": "J"}, {"sex": "M"}, {"sex": "J", "cwt_head_label": "0"})
    for df in (first, first.filter("sex = 'M'")):
        sample_reports.write_quality_report(df, f"{tmp_path}/qc", "now")
        got = read_published(spark, f"{tmp_path}/qc")
        assert len(got) == 14
        for name, want in quality.qc_tables(df).items():
            assert rows(got[name]) == rows(want), name


def test_quality_report_reads_the_samples_once(spark, tmp_path):
    """Rows are counted while they are read, so a second scan would double what is counted."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    samples = records(spark, schemas.BIOSAMPLES, *[{"sex": "J" if k % 3 else "M"} for k in range(50)])
    sample_reports.write_quality_report(samples.mapInArrow(count, samples.schema), f"{tmp_path}/qc", "once")
    assert seen.value == 50
    assert dict(rows(read_published(spark, f"{tmp_path}/qc")["Summary"], "issue_id", "count"))["8"] == 33


# ---------------------------------------------------------------- counts


def test_counts_give_what_the_samples_give(spark):
    i = Inputs(spark, SF_DIR)
    bio, caught = settle(_conuma_bio(i), "bio"), settle(_conuma_catch(i), "caught")
    counts = sufficiency.fishery_counts(bio)
    parts = [bio.filter(F.coalesce(F.pmod(F.xxhash64("ufid"), F.lit(3)) == k, F.lit(k == 0))) for k in range(3)]
    merged = sufficiency.add_counts(*[sufficiency.fishery_counts(p) for p in parts])
    assert rows(merged) == rows(counts) and counts.count() > 50
    halves = [sufficiency.fishery_counts(h) for h in (bio.filter("resolved_age > 3"), bio.filter("resolved_age <= 3 or resolved_age is null"))]
    assert rows(sufficiency.add_counts(*halves)) == rows(counts)  # one fishery's samples in several extracts
    for n in (1, 10, 40):
        want = sufficiency.sample_sufficiency(caught, bio, CONUMA_YEAR, min_n=n)
        got = sufficiency.sufficiency_of_counts(caught, merged, CONUMA_YEAR, min_n=n)
        assert rows(got.select(*want.columns)) == rows(want)
    orphans = sufficiency.orphan_ufids(want)
    assert rows(sufficiency.missed_of_counts(merged, orphans, CONUMA_YEAR)) == rows(sufficiency.missed_samples(bio, orphans, CONUMA_YEAR))


def test_counts_of_no_samples(spark):
    bio = frame(spark, "sector string, run_recon_area string, ufid string, year int, resolved_age int, resolved_stock_origin string")
    caught = frame(spark, "sector string, run_recon_area string, ufid string, year int, kept double", ("sport", "A", "u", CONUMA_YEAR, 5.0))
    counts = sufficiency.fishery_counts(bio)
    enough = sufficiency.sufficiency_of_counts(caught, counts, CONUMA_YEAR)
    assert rows(enough, "total_kept", "n_age_samples", "stockcomp_samplesize_flag") == [(5.0, None, "FLAG")]
    assert sufficiency.missed_of_counts(counts, sufficiency.orphan_ufids(enough), CONUMA_YEAR).count() == 0


def test_rows_are_named_before_they_are_observed(spark, tmp_path, monkeypatch):
    """A row that is named after it was observed would be laid out twice."""
    from pyspark.sql.classic.dataframe import DataFrame

    seen, observe = [], DataFrame.observe
    monkeypatch.setattr(DataFrame, "observe", lambda df, *a: seen.append(df.columns) or observe(df, *a))
    out = Publication(spark, str(tmp_path / "named"), "s")
    back = out.write("t", table(spark, 1, 2), {"x": "Shown X", "two words": "Two."})
    assert back.columns == ["x", "two words"] and rows(back, "x") == [(1,), (2,)]
    plain = Publication(spark, str(tmp_path / "plain"), "s")
    plain.write("t", table(spark, 1, 2))
    assert out.entries["t"]["digest"] == plain.entries["t"]["digest"] and out.entries["t"]["n_rows"] == 2
    assert seen[0] == ["Shown X", "Two."]
