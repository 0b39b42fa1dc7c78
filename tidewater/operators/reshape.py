"""Long/wide reshaping, row repetition, unions and column selection by name or position."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.functions.text import snake_name

# Longest array built when a row is repeated.
_CHUNK = 1000


def spread_sum(
    df: DataFrame,
    names_from: str,
    values_from: str,
    names: Sequence,
    *,
    ids: Sequence[str] | None = None,
    to_column: Callable[[object], str] = lambda v: snake_name(str(v)),
    other: str | None = None,
) -> DataFrame:
    """Long to wide over declared names; repeated cells are summed.

    All other columns are the row identity unless ``ids`` is given. Values under a name that is
    not declared, or under none, are summed in the column ``other``; without that column they
    fail the query, so that none is lost. Written as one aggregation, so the data is combined
    before its single shuffle.
    """
    if ids is None:
        ids = [c for c in df.columns if c not in (names_from, values_from)]
    cells = [
        F.sum(F.when(F.col(names_from) == name, F.col(values_from))).alias(to_column(name)) for name in names
    ]
    rest = F.col(names_from).isNull() | ~F.col(names_from).isin(*names)
    if other is not None:
        return df.groupBy(*ids).agg(*cells, F.sum(F.when(rest, F.col(values_from))).alias(other))
    undeclared = F.concat(F.lit(f"undeclared {names_from}: "), F.coalesce(F.col(names_from).cast("string"), F.lit("null")))
    checked = F.when(rest, F.raise_error(undeclared).cast("boolean")).otherwise(F.lit(True))
    return df.filter(checked).groupBy(*ids).agg(*cells)


#: Columns that a pivot over the names that occur may get.
MOST_NAMES = 200


def spread_occurring(
    df: DataFrame, names_from: str, values_from: str, *, ids: Sequence[str] | None = None, most: int = MOST_NAMES,
    missing: str = "na",
) -> DataFrame:
    """Long to wide over all names that occur; repeated cells are summed.

    A first pass finds the names, of which there may be ``most``; more fail, before any row is summed. Values
    without a name are summed in the column ``missing``, which is there only if there are such rows. Two names that
    would give one column fail.
    """
    found = df.select(names_from).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} different values of {names_from}")
    if not found:
        return df.select(*(ids or [c for c in df.columns if c not in (names_from, values_from)])).distinct()
    names = sorted((r[0] for r in found if r[0] is not None), key=str)
    columns = [snake_name(str(n)) for n in names]
    if len(set(columns)) < len(columns):
        raise ValueError(f"values of {names_from} that give one column: {[n for n, c in zip(names, columns) if columns.count(c) > 1]}")
    has_missing = any(r[0] is None for r in found)
    return spread_sum(df, names_from, values_from, names, ids=ids, other=missing if has_missing else None)


def gather(
    df: DataFrame, columns: Sequence[str], names_to: str, values_to: str, *, drop_null: bool = False
) -> DataFrame:
    """Wide to long over the given columns."""
    ids = [c for c in df.columns if c not in columns]
    long = df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in columns], names_to, values_to)
    return long.filter(F.col(values_to).isNotNull()) if drop_null else long


def stack_blocks(blocks: Iterable[DataFrame], label_to: str, id_to: str, names_to: str, values_to: str) -> DataFrame:
    """Stack wide report blocks whose first column header is the block's label.

    Each block is melted: the header of its first column becomes a value, the
    remaining columns become (name, value) pairs.
    """
    parts = []
    for block in blocks:
        label, *wide = block.columns
        renamed = block.withColumnRenamed(label, id_to)
        parts.append(gather(renamed, wide, names_to, values_to).select(F.lit(label).alias(label_to), "*"))
    return reduce(DataFrame.unionByName, parts)


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its count says; a missing or zero count gives no row.

    Counts are expanded in two steps so that no row needs an array longer than
    its number of chunks or one chunk.
    """
    chunks = F.ceil(F.col(times) / _CHUNK).cast("int")
    chunked = df.select("*", F.posexplode(F.array_repeat(F.lit(1), chunks)).alias("__chunk", "__one"))
    size = F.least(F.lit(_CHUNK), F.col(times) - F.col("__chunk") * _CHUNK).cast("int")
    copies = chunked.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), size)))
    return copies.drop("__chunk", "__one", "__copy", times)


def stack_frames(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name, filling columns a part lacks."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def add_rows(df: DataFrame, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """Append literal rows; columns a row leaves out are null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    literals = F.array(
        *[F.struct(*[F.lit(row.get(c)).cast(t).alias(c) for c, t in types.items()]) for row in rows]
    )
    extra = df.sparkSession.range(1).select(F.inline(literals))
    return df.unionByName(extra)


def drop_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Drop the columns from ``first`` to ``last`` in position order."""
    names = df.columns
    return df.drop(*names[names.index(first): names.index(last) + 1])


def select_blocks(df: DataFrame, blocks: Sequence[tuple[str, str]]) -> DataFrame:
    """Keep several column ranges of one wide table, given by first and last name."""
    names = df.columns
    keep = [c for first, last in blocks for c in names[names.index(first): names.index(last) + 1]]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def rename_by_pattern(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Apply regex replacements, in order, to every column name."""
    names = df.columns
    for pattern, new in patterns.items():
        names = [re.sub(pattern, new, c) for c in names]
    return df.toDF(*names)


def add_name_suffix(df: DataFrame, token: str, suffix: str) -> DataFrame:
    """Suffix every column whose name contains a token, ignoring case."""
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if token.lower() in c.lower()})


def map_columns(df: DataFrame, token: str, fn: Callable[[Column], Column]) -> DataFrame:
    """Apply one column function to every column whose name contains a token, ignoring case."""
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c in df.columns if token.lower() in c.lower()})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; what does not convert becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def display_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
