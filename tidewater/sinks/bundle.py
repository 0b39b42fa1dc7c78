"""Write named tables to time-stamped folders, one table per subfolder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame

from tidewater.operators.reshape import display_names
from tidewater.session import freed_shuffles

STAMP = "%Y-%m-%d_%H%M"


def time_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime(STAMP)


def unique_suffix() -> str:
    return uuid.uuid4().hex


def folder_name(table: str) -> str:
    """Table name as a folder: blanks and symbols become underscores."""
    return re.sub(r"[^0-9A-Za-z.]+", "_", table).strip("_")


def describe_tables(tables: Mapping[str, DataFrame], descriptions: Mapping[str, str]) -> DataFrame:
    """Table of sheet names and their descriptions."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, descriptions.get(name)) for name in tables]
    return spark.createDataFrame(rows, "sheets string, description string")


def write_table(
    df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "errorifexists",
    names: Mapping[str, str] | None = None,
) -> str:
    """Write one table, under display names if given; parquet is packed by zstd, and no shuffle files are left behind."""
    df = display_names(df, names or {})
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    with freed_shuffles(df.sparkSession):
        writer.format(fmt).save(path)
    return path


def write_bundle(
    tables: Mapping[str, DataFrame], base: str, stamp: str | None = None, *,
    descriptions: Mapping[str, str] | None = None, fmt: str = "parquet", mode: str = "errorifexists",
    names: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Write all tables below ``base_stamp``; returns the path of each.

    ``descriptions`` adds a ``metadata`` table. ``mode="overwrite"`` with a fixed
    stamp replaces the previous report.
    """
    tables = dict(tables)
    if descriptions is not None:
        tables["metadata"] = describe_tables(tables, descriptions)
    target = f"{base}_{stamp or time_stamp()}"
    return {
        name: write_table(df, f"{target}/{folder_name(name)}", fmt=fmt, mode=mode, names=names)
        for name, df in tables.items()
    }


def coded_path(source: str, stamp: str | None = None) -> str:
    """Path of a coded export, named after its source: ``x.csv`` -> ``x_CODED_stamp``."""
    return f"{re.sub(r'[.](xlsx|csv|parquet)$', '', source.rstrip('/'))}_CODED_{stamp or time_stamp()}"


def export_coded(df: DataFrame, source: str, stamp: str | None = None, **options) -> str:
    """Single-table export named after the source it was coded from."""
    return write_table(df, coded_path(source, stamp), **options)
