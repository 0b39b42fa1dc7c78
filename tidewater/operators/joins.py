"""Joins on shared or named columns where a missing key matches a missing key.

No broadcast is forced: Spark broadcasts a side when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides, with
adaptive skew splitting for hot keys, missing ones among them. One thing it cannot do
alone is done here: a full join is written as a left join plus the unmatched rest
so that its hot side can be split, or, with hot keys on both sides, these are counted first and joined apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.session import settle


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    names = set(right.columns)
    return [c for c in left.columns if c in names]


def _suffix_clashes(left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes: tuple[str, str]):
    clash = [c for c in shared_columns(left, right) if c not in keys]
    return (
        left.withColumnsRenamed({c: c + suffixes[0] for c in clash}),
        right.withColumnsRenamed({c: c + suffixes[1] for c in clash}),
    )


def join_on(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    na_matches: str = "na",
    hot: str | None = None,
    suffixes: tuple[str, str] = ("_x", "_y"),
    spread_by: Sequence[str] = (),
    hashed: bool = False,
) -> DataFrame:
    """Join on named keys; clashing other columns get suffixes.

    ``how`` is ``left``, ``inner`` or ``full``. ``na_matches`` is ``na`` (null
    keys match each other) or ``never``. ``hot`` names the side of a full join that may hold hot keys, or ``both``.
    ``spread_by`` names columns of the left side of a left join; rows that lack a key, and so meet nothing, are
    then dealt to all tasks by these in place of one task for all. ``hashed`` asks for tables of the right side's
    rows in place of sorting both: for a right side that is too large to broadcast and has no hot keys.
    """
    if na_matches not in ("na", "never"):
        raise ValueError(f"na_matches must be 'na' or 'never', not {na_matches!r}")
    if not keys:
        raise ValueError("no join keys")
    if how == "full":
        return _full_join(left, right, keys, na_matches, hot, suffixes)
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    left, right = _suffix_clashes(left, right, keys, suffixes)
    names = left.columns + [c for c in right.columns if c not in keys]
    if spread_by and how == "left" and na_matches == "never":
        left, right, keys = _spread(left, right, keys, [c for c in spread_by if c in left.columns])
    right = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    joined = left.join(right.hint("shuffle_hash") if hashed else right, _condition(keys, na_matches), how)
    return joined.select(*[F.col(_quote(c)) for c in names])


#: Values that deal rows without a key to tasks; few, as each such row carries one.
SPREAD_OVER = 1 << 16


def _spread(left: DataFrame, right: DataFrame, keys: Sequence[str], by: Sequence[str]):
    """Both sides with one more key: zero, but on left rows that lack a key a hash that stays when a task is run again."""
    own = [F.col(_quote(k)) for k in keys]
    lacks = reduce(lambda a, b: a | b, [k.isNull() for k in own])
    dealt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(_quote(c)) for c in by]), F.lit(SPREAD_OVER))
    # Always zero; a plain zero would be folded into the condition and be no key any more.
    zero = F.pmod(F.xxhash64(*own), F.lit(1).cast("long"))
    left = left.withColumn("__spread", F.when(lacks, dealt).otherwise(F.lit(0).cast("long")))
    return left, right.withColumn("__spread", zero), [*keys, "__spread"]


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _condition(keys: Sequence[str], na_matches: str) -> Column:
    pairs = [(F.col(_quote(k)), F.col(_quote(f"__r_{k}"))) for k in keys]
    if na_matches == "na":
        return reduce(lambda a, b: a & b, [a.eqNullSafe(b) for a, b in pairs])
    return reduce(lambda a, b: a & b, [a == b for a, b in pairs])


def _full_join(left, right, keys, na_matches, hot, suffixes) -> DataFrame:
    left, right = _suffix_clashes(left, right, keys, suffixes)
    names = left.columns + [c for c in right.columns if c not in keys]
    if hot is None:
        right_keys = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
        joined = left.join(right_keys, _condition(keys, na_matches), "full")
        merged = {k: F.coalesce(F.col(_quote(k)), F.col(_quote(f"__r_{k}"))) for k in keys}
        return joined.select(*[merged.get(c, F.col(_quote(c))).alias(c) for c in names])
    if hot == "both":
        return _hot_full_join(left, right, keys, na_matches).select(*[F.col(_quote(c)) for c in names])
    if hot not in ("left", "right"):
        raise ValueError(f"hot must be 'left', 'right' or 'both', not {hot!r}")
    # Left join from the hot side, whose skewed partitions adaptive execution can
    # split, plus the rows of the other side whose key never occurs there.
    big, small = (left, right) if hot == "left" else (right, left)
    matched = join_on(big, small, keys, "left", na_matches=na_matches)
    seen = big.select(*[F.col(_quote(k)).alias(f"__r_{k}") for k in keys]).distinct()
    unmatched = small.join(seen, _condition(keys, na_matches), "left_anti")
    both = matched.unionByName(unmatched, allowMissingColumns=True)
    return both.select(*[F.col(_quote(c)) for c in names])


#: A key is hot that holds this share of a side's rows, so a side has at most as many hot keys as its inverse.
HOT_SHARE = 1 / 200
#: Stripes of a hot key's rows on each side; every pair of stripes is a join key of its own.
STRIPES = 4


def _keys_of(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [F.col(_quote(k)).alias(f"__r_{k}") for k in keys]


def hot_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], *, na_matches: str = "na", share: float = HOT_SHARE) -> DataFrame:
    """Keys under their names with ``__r_`` in front that hold the share of either side's rows and occur on both; at most 2 / share."""
    found = []
    for df in (left, right):
        counts = df.groupBy(*_keys_of(df, keys)).agg(F.count(F.lit(1)).alias("__n"))
        found.append(counts.filter(F.col("__n") >= share * df.count()).drop("__n"))
    # Settled, its true size lets Spark broadcast it in all that follows.
    hot = settle(found[0].union(found[1]).distinct(), "hot-keys")
    if na_matches == "never":
        hot = hot.dropna()
    for df in (left, right):
        present = df.join(F.broadcast(hot), _condition(keys, "na"), "left_semi").select(*_keys_of(df, keys)).distinct()
        hot = settle(present, "hot-keys")
    return hot


def _hot_full_join(left: DataFrame, right: DataFrame, keys: Sequence[str], na_matches: str) -> DataFrame:
    """A full join whose hot keys may lie on both sides.

    The few hot keys that occur on both sides are an inner join of striped rows: a left row has one stripe and is
    repeated for every right stripe, a right row the other way round, so each pair of rows meets once and a key's
    pairs are dealt to as many tasks as there are pairs of stripes. All other rows are joined plainly.
    """
    hot = F.broadcast(hot_keys(left, right, keys, na_matches=na_matches))

    def parted(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        return df.join(hot, _condition(keys, "na"), "left_semi"), df.join(hot, _condition(keys, "na"), "left_anti")

    def striped(df: DataFrame, own: str, other: str) -> DataFrame:
        # Equal rows lie in many partitions, whose numbers stay when a task is run again.
        stripe = F.pmod(F.spark_partition_id() + F.xxhash64(*[F.col(_quote(c)) for c in df.columns]), F.lit(STRIPES)).cast("int")
        every = F.explode(F.array(*map(F.lit, range(STRIPES))))
        return df.withColumn(own, stripe).withColumn(other, every)

    (left_hot, left_rest), (right_hot, right_rest) = parted(left), parted(right)
    stripes = ["__left_stripe", "__right_stripe"]
    met = join_on(
        striped(left_hot, *stripes), striped(right_hot, *stripes[::-1]), [*keys, *stripes], "inner", na_matches=na_matches
    ).drop(*stripes)
    return met.unionByName(join_on(left_rest, right_rest, keys, "full", na_matches=na_matches))


@dataclass(frozen=True)
class Factored:
    """A left join kept as its two sides, which meet only in what is asked for.

    Where n left rows and m right rows share a key, or both lack it, the join has n x m rows; this has n + m.
    Counts are taken from each side's counts by key, which are multiplied, so their cost is linear in the sides and
    in what they are counted by.
    """

    left: DataFrame
    right: DataFrame
    keys: tuple[str, ...]
    na_matches: str = "na"

    def expand(self) -> DataFrame:
        """The joined rows."""
        return join_on(self.left, self.right, self.keys, "left", na_matches=self.na_matches)

    def _left_only(self, *columns: str) -> list[str]:
        return [*self.keys, *[c for c in columns if c not in self.keys]]

    def counts(self, left_by: Sequence[str] = (), right_by: Sequence[str] = ()) -> DataFrame:
        """Rows of the join, ``n``, by columns of the left side, keys included, and other columns of the right.

        A left row without a match counts once, with the right columns missing.
        """
        own = self.left.groupBy(*self._left_only(*left_by)).agg(F.count(F.lit(1)).alias("__left"))
        other = self.right.groupBy(*self._left_only(*right_by)).agg(F.count(F.lit(1)).alias("__right"))
        met = join_on(own, other, self.keys, "left", na_matches=self.na_matches)
        rows = F.col("__left").cast("decimal(19,0)") * F.coalesce("__right", F.lit(1))
        return met.groupBy(*[F.col(_quote(c)) for c in (*left_by, *right_by)]).agg(F.sum(rows).cast("decimal(38,0)").alias("n"))

    def largest(self) -> DataFrame:
        """Rows of the join for each key, the largest first: what an expansion would multiply."""
        return self.counts(left_by=self.keys).orderBy(F.desc("n"))


def factored_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *, na_matches: str = "na") -> Factored:
    """A left join that is not expanded; clashing other columns get suffixes as in ``join_on``."""
    left, right = _suffix_clashes(left, right, keys, ("_x", "_y"))
    return Factored(left, right, tuple(keys), na_matches)


def natural_join(left: DataFrame, right: DataFrame, how: str = "left", **options) -> DataFrame:
    """Join on every column name the two frames share."""
    keys = shared_columns(left, right)
    if not keys:
        raise ValueError("the frames share no column names")
    return join_on(left, right, keys, how, **options)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself, failing at run time if a key occurs more than once.

    Meant for lookup tables, where a repeated key would multiply the rows joined to it.
    """
    rest = F.struct(*[c for c in df.columns if c not in keys])
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.any_value(rest).alias("__rest"))
    message = F.lit(f"lookup key {list(keys)} is not unique")
    single = F.when(F.col("__n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return grouped.filter(single).select(*keys, "__rest.*").select(*df.columns)


def rows_in(df: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Rows whose value occurs in a one-column frame; missing matches missing."""
    keys = values.select(F.col(column).alias(f"__r_{column}")).distinct()
    return df.join(keys, _condition([column], "na"), "left_semi")


def rows_not_in(df: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Rows whose value does not occur in a one-column frame."""
    keys = values.select(F.col(column).alias(f"__r_{column}")).distinct()
    return df.join(keys, _condition([column], "na"), "left_anti")
