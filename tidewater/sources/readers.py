"""Read landed extracts with declared schemas; nothing is inferred from the data."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.functions.missing import matches
from tidewater.functions.text import snake_name
from tidewater.operators.reshape import cast_columns
from tidewater.sources.schemas import PAYLOAD


def standard_names(df: DataFrame) -> DataFrame:
    """Column-safe names for every column."""
    return df.toDF(*[snake_name(c) for c in df.columns])


#: Distinct header lines of one extract; more are taken for a mistake in its path.
MOST_HEADERS = 1_000


def _headers(spark: SparkSession, path: str | Sequence[str], names: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by the names of their columns in order, from a scan that keeps just the lines that hold all names.

    A file's header is the one line whose cells include every name; a file without one, or with two that
    differ, fails. What comes to the driver is a line and a list of file paths for each header.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    holds_all = reduce(lambda a, b: a & b, [F.col("value").contains(n) for n in names])
    found = lines.groupBy("file").agg(F.collect_set(F.when(holds_all, F.col("value"))).alias("lines"))
    by_line = found.groupBy("lines").agg(F.sort_array(F.collect_list("file")).alias("files")).limit(MOST_HEADERS + 1).collect()
    if len(by_line) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different csv headers in {path}")
    out: dict[tuple[str, ...], list[str]] = {}
    for row in by_line:
        cells = {tuple(c.strip() for c in next(csv.reader([line.removeprefix("\ufeff")]))) for line in row["lines"]}
        headers = [c for c in cells if set(names) <= set(c)]
        if len(headers) != 1:
            kind = "several csv headers" if headers else "no csv header"
            raise ValueError(f"{kind} with the columns {list(names)} in {row['files'][:5]}")
        out.setdefault(headers[0], []).extend(unquote(f) for f in row["files"])
    return out


def _read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType, preamble: str | None) -> DataFrame:
    """Files of one header at a time, each by a projection of its own order; ``file_source`` is the file's name."""
    parts = []
    for header, files in _headers(spark, path, schema.names).items():
        # Places stand for names: a header may repeat names that are not asked for.
        text = StructType([StructField(f"c{k}", StringType()) for k in range(len(header))])
        place = {n: F.col(f"c{header.index(n)}") for n in schema.names}
        lines = spark.read.schema(text).csv(files, header=False, escape='"')
        is_header = reduce(lambda a, b: a & b, [F.trim(c).eqNullSafe(F.lit(n)) | F.trim(c).eqNullSafe(F.lit("\ufeff" + n)) for n, c in place.items()])
        lines = lines.filter(~is_header)
        if preamble is not None:
            lines = lines.filter(~matches("c0", preamble))
        named = lines.select(
            *[c.alias(n) for n, c in place.items()],
            F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))).alias("file_source"),
        )
        parts.append(cast_columns(named, {f.name: f.dataType.simpleString() for f in schema.fields}))
    if not parts:
        return spark.createDataFrame([], StructType([*schema.fields, StructField("file_source", StringType())]))
    return reduce(DataFrame.union, parts)


def read_extract(
    spark: SparkSession, path: str | Sequence[str], schema: StructType, *, fmt: str = "parquet",
    preamble: str | None = None,
) -> DataFrame:
    """A tabular extract under its declared schema.

    Csv columns are found by the names in each file's own header, in whatever order; other columns are left
    out, and a file without all names fails. Lines above the header are left out by ``preamble``, a regex for
    their first cell. Cells that do not convert become null. Headers are found in a scan of their own,
    which keeps nothing but them.
    """
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(*([path] if isinstance(path, str) else path))
    if fmt != "csv":
        raise ValueError(f"fmt must be 'parquet' or 'csv', not {fmt!r}")
    return _read_csv(spark, path, schema, preamble).drop("file_source")


def read_many(
    spark: SparkSession, glob: str | Sequence[str], schema: StructType, *, preamble: str | None = None
) -> DataFrame:
    """All csv files matching a pattern as one table, tagged with their file name; each is read by its own header."""
    return _read_csv(spark, glob, schema, preamble)


def read_payload(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Landed self-describing payloads, one json document per line, or per file for small ``multi_line`` ones."""
    return spark.read.schema(PAYLOAD).json(path, multiLine=multi_line)


def decode_rows(payload: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Rows of self-describing payloads as typed columns.

    ``types`` declares the wanted columns (``tagged_types`` turns type tags into
    it). Each cell is found by its column's position in the payload's own name
    list, so payloads may order columns differently.
    """
    rows = payload.select("Names", F.explode("Rows.Cells").alias("cells"))
    return rows.select(
        *[
            F.get("cells", F.array_position("Names", F.lit(name)).cast("int") - 1)
            .try_cast(kind)
            .alias(snake_name(name))
            for name, kind in types.items()
        ]
    )


def tagged_types(names: Sequence[str], tags: Sequence[str]) -> dict[str, str]:
    """Spark types for a payload's type tags: ``int*`` to int, ``single*`` to double, else string."""
    def kind(tag: str) -> str:
        tag = tag.lower()
        return "int" if "int" in tag else "double" if "single" in tag else "string"

    return {name: kind(tag) for name, tag in zip(names, tags)}


def read_readings(spark: SparkSession, path: str, schema: StructType, *, multi_line: bool = False) -> DataFrame:
    """Landed json records, one per line, or an array or object per file for small ``multi_line`` ones."""
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def apply_query_doc(df: DataFrame, doc: Mapping) -> DataFrame:
    """Run a declarative query document: keep its fields where every filter column has a listed value."""
    for part in ("Aggregates", "Orders"):
        if doc.get(part):
            raise ValueError(f"query documents with {part} are not supported")
    types = dict(df.dtypes)
    for item in doc.get("Filters", []):
        column = F.col(f"`{item['Column']}`")
        values = [F.lit(v.strip()).cast(types[item["Column"]]) for v in item["Value"].split(",")]
        df = df.filter(column.isin(*values))
    return df.select(*[F.col(f"`{name}`") for name in doc["Fields"]])


def latest_snapshot(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest snapshot; on a partition column only its files are read."""
    newest = df.select(F.max(column)).scalar()
    return df.filter(F.col(column) == newest)
