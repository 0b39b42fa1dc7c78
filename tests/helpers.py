from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as sorted tuples; missing values sort first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])


def one(df: DataFrame, *columns: str):
    """The single value, or tuple of values, of a one-row result."""
    found = rows(df, *columns)
    assert len(found) == 1, found
    return found[0] if len(found[0]) > 1 else found[0][0]


def frame(spark, schema, *data) -> DataFrame:
    return spark.createDataFrame([tuple(d) for d in data], schema)


def records(spark, schema, *dicts) -> DataFrame:
    """Rows given by name under a declared schema; what is left out is null."""
    unknown = {k for d in dicts for k in d} - set(schema.names)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(d.get(n) for n in schema.names) for d in dicts], schema)


def formatted_plan(df: DataFrame) -> str:
    """The plan with untruncated scan details, as ``explain("formatted")`` prints it."""
    utils = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")
