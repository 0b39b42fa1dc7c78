"""Missing-value semantics of the source analyses, spelled out as Spark columns.

Spark's three-valued logic differs from the analyses in a handful of places:
membership and pattern tests are never null there, pasting writes "NA" for a
missing part, and a conditional with a missing test is itself missing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

NA_TEXT = "NA"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def paste(*parts: Column | str, sep: str = " ") -> Column:
    """Join parts as text; a missing part is written as ``NA``."""
    return F.concat_ws(
        sep, *[F.coalesce(col(p).cast("string"), F.lit(NA_TEXT)) for p in parts]
    )


def join_present(*parts: Column | str, sep: str = "-") -> Column:
    """Join parts as text; the result is null unless every part is present."""
    pieces: list[Column] = []
    for p in parts:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(col(p).cast("string"))
    return F.concat(*pieces)


def is_in(c: Column | str, values: Iterable) -> Column:
    """Membership that is false, not null, for a missing value."""
    return F.coalesce(col(c).isin(*values), F.lit(False))


def not_in(c: Column | str, values: Iterable) -> Column:
    """Non-membership that is true for a missing value."""
    return ~is_in(c, values)


def matches(c: Column | str, pattern: str) -> Column:
    """Regex search that is false for a missing value."""
    return F.coalesce(col(c).rlike(pattern), F.lit(False))


def has_text(c: Column | str, text: str) -> Column:
    """Literal substring search that is false for a missing value."""
    return F.coalesce(col(c).contains(text), F.lit(False))


def if_else(test: Column, yes, no) -> Column:
    """Two-way choice that is null where the test is null."""
    return F.when(test, yes).when(~test, no)


def first_match(choices: Iterable[tuple[Column, object]]) -> Column:
    """Value of the first true test; a missing test counts as false, no match is null."""
    out = None
    for test, value in choices:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def sum_or_zero(c: Column | str) -> Column:
    """Sum that skips nulls; zero when nothing is left."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def sum_or_null(c: Column | str) -> Column:
    """Sum that is null as soon as one value is null."""
    c = col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def number(c: Column | str, to: str = "double") -> Column:
    """Text to number; text that is no number becomes null."""
    return col(c).try_cast(to)


def round_half_even(c: Column | str) -> Column:
    return F.bround(col(c), 0)
