"""Publish a set of tables as a whole: staged files, and one manifest that makes them visible.

Below ``base`` every run has a folder of its own in ``versions``, and ``manifests`` holds one numbered file for each
published set. A reader takes the tables of one manifest, so it sees a set before or after it is published, and
never a mixture; a run that fails leaves the last set in place. A run that is started again under the same stamp
goes on after the tables it had finished.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidewater.operators.reshape import display_names
from tidewater.sinks.bundle import describe_tables, folder_name, time_stamp

INDEX = "number long, stamp string, table_name string, path string, n_rows long, digest decimal(38,0)"


class Store:
    """Small files next to the tables, in whichever store Spark's own configuration gives for the path."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.base = spark._jvm, base.rstrip("/")
        self.fs = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self._path(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(folder)))

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """A file that is there whole or not at all; one of this name must not exist."""
        own = self._path(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(own, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self._path(name)) or not self.fs.rename(own, self._path(name)):
            self.fs.delete(own, False)
            raise FileExistsError(f"{self.base}/{name} was written by another run")

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def _digest(df: DataFrame):
    """Sum of row hashes: the same for the same rows in any order."""
    return F.coalesce(F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")), F.lit(0)).alias("digest")


class Publication:
    """The tables of one run, written one by one and published together.

    Each table's number of rows and digest are observed while it is written, so nothing is read twice.
    """

    def __init__(self, spark: SparkSession, base: str, stamp: str | None = None):
        self.spark, self.store = spark, Store(spark, base)
        self.stamp = stamp or time_stamp()
        self.entries: dict[str, dict] = {}
        # An attempt that was not published is taken up again; its folder is marked by its file of that name.
        mark = f"open/{folder_name(self.stamp)}"
        if folder_name(self.stamp) in self.store.names("open"):
            self.folder = self.store.read(mark)
        else:
            self.folder = f"versions/{folder_name(self.stamp)}-{uuid.uuid4().hex[:12]}"
            self.store.write(mark, self.folder)
        # Tables that an earlier attempt under this stamp has finished.
        for name in self.store.names(f"{self.folder}/done"):
            if name.endswith(".json"):
                entry = json.loads(self.store.read(f"{self.folder}/done/{name}"))
                self.entries[entry["table"]] = entry

    def place(self, table: str) -> str:
        return f"{self.store.base}/{self.folder}/{folder_name(table)}"

    def add(self, table: str, place: str, schema: StructType, n_rows: int, digest=None, names: Mapping[str, str] | None = None) -> None:
        """Enter a table whose files are written."""
        entry = {
            "table": table, "path": place.removeprefix(f"{self.store.base}/"), "schema": schema.jsonValue(), "n_rows": n_rows,
            "digest": None if digest is None else str(digest), "names": dict(names or {}),
        }
        self.store.write(f"{self.folder}/done/{folder_name(table)}.json", json.dumps(entry))
        self.entries[table] = entry

    def write(self, table: str, df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
        """Write a table, under display names if given, and read it back under its own."""
        if table not in self.entries:
            seen = Observation()
            # Named before it is observed, so that a row is laid out once.
            shown = display_names(df, names or {})
            observed = shown.observe(seen, F.count(F.lit(1)).alias("n_rows"), _digest(shown))
            observed.write.mode("overwrite").parquet(self.place(table))
            self.add(table, self.place(table), shown.schema, seen.get["n_rows"], seen.get["digest"], {c: s for c, s in zip(df.columns, shown.columns) if c != s})
        return self.read(table)

    def read(self, table: str) -> DataFrame:
        return _frame(self.spark, self.store.base, self.entries[table])

    def commit(self) -> int:
        """Make the tables visible as the newest set; returns its number."""
        numbers = _numbers(self.store)
        number = numbers[-1] + 1 if numbers else 1
        manifest = {"number": number, "stamp": self.stamp, "tables": list(self.entries.values())}
        self.store.write(_manifest(number), json.dumps(manifest))
        self.store.delete(f"open/{folder_name(self.stamp)}")  # the next run under this stamp starts afresh
        return number


def _manifest(number: int) -> str:
    return f"manifests/{number:08d}.json"


def _numbers(store: Store) -> list[int]:
    return [int(n.removesuffix(".json")) for n in store.names("manifests") if n.endswith(".json")]


def _frame(spark: SparkSession, base: str, entry: dict) -> DataFrame:
    schema = StructType.fromJson(entry["schema"])
    own = {shown: name for name, shown in entry["names"].items()}
    if not entry["n_rows"]:
        return spark.createDataFrame([], schema).withColumnsRenamed(own)
    return spark.read.schema(schema).parquet(f"{base}/{entry['path']}").withColumnsRenamed(own)


def _latest(store: Store, stamp: str | None) -> dict:
    for number in reversed(_numbers(store)):
        manifest = json.loads(store.read(_manifest(number)))
        if stamp in (None, manifest["stamp"]):
            return manifest
    raise FileNotFoundError(f"nothing is published in {store.base}" + (f" under {stamp}" if stamp else ""))


def read_published(spark: SparkSession, base: str, stamp: str | None = None) -> dict[str, DataFrame]:
    """The tables of the newest set, or of the newest under a stamp, each under its own column names."""
    store = Store(spark, base)
    return {e["table"]: _frame(spark, store.base, e) for e in _latest(store, stamp)["tables"]}


def snapshot_index(spark: SparkSession, base: str) -> DataFrame:
    """A row for every table of every published set: where it lies, its number of rows and, if taken, its digest.

    Comes from the manifests alone; no data is read.
    """
    store = Store(spark, base)
    rows = []
    for number in _numbers(store):
        manifest = json.loads(store.read(_manifest(number)))
        rows += [
            (number, manifest["stamp"], e["table"], f"{store.base}/{e['path']}", e["n_rows"], e["digest"] and Decimal(e["digest"]))
            for e in manifest["tables"]
        ]
    return spark.createDataFrame(rows, INDEX)


def publish_tables(
    tables: Mapping[str, DataFrame], base: str, stamp: str | None = None, *, descriptions: Mapping[str, str] | None = None,
    names: Mapping[str, str] | None = None,
) -> int:
    """Write all tables and publish them together; returns the number of the set."""
    spark = next(iter(tables.values())).sparkSession
    out = Publication(spark, base, stamp)
    tables = dict(tables)
    if descriptions is not None:
        tables["metadata"] = describe_tables(tables, descriptions)
    for name, df in tables.items():
        out.write(name, df, names)
    return out.commit()


Step = Callable[[Mapping[str, DataFrame]], DataFrame]


def run_steps(
    spark: SparkSession, steps: Mapping[str, Step], base: str, stamp: str | None = None, *, hidden: tuple[str, ...] = (),
    names: Mapping[str, str] | None = None,
) -> int:
    """Compute the tables of a run in order and publish them together.

    A step gets the tables before it as they were written, so what several tables share is computed once, and a
    run that is started again goes on at the first table it had not finished. ``hidden`` tables are
    shared by others and not part of the set.
    """
    out = Publication(spark, base, stamp)
    done: dict[str, DataFrame] = {}
    for name, step in steps.items():
        done[name] = out.read(name) if name in out.entries else out.write(name, step(done), names)
    for name in hidden:
        out.entries.pop(name)
    return out.commit()
