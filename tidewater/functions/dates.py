"""Calendar helpers: month names, month ranks and the statistical week."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from tidewater import rules
from tidewater.functions.missing import col, first_match, has_text, is_in, paste


def month_name(d: Column | str) -> Column:
    """Full English month name of a date."""
    return F.date_format(col(d), "MMMM")


def month_label(c: Column | str, levels=rules.MONTHS) -> Column:
    """Keep a month name that is a known level; anything else is null."""
    return F.when(is_in(c, levels), col(c))


def month_rank(c: Column | str, levels=rules.MONTHS) -> Column:
    """1-based position of a month name among the levels, else null."""
    rank = F.array_position(F.array(*[F.lit(m) for m in levels]), col(c))
    return F.nullif(rank, F.lit(0)).cast("int")


def _sunday_week(d: Column) -> Column:
    """Week of the year where weeks start on Sunday and days before the first one are week 0."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7)


def stat_week(d: Column | str) -> Column:
    """Month number followed by the Sunday-based week within the month, as text.

    The third week of August is ``83``. A missing date gives ``NANA``, the two
    missing parts written out.
    """
    d = col(d)
    in_month = _sunday_week(d) - _sunday_week(F.trunc(d, "month")) + 1
    return paste(F.month(d), in_month.cast("int"), sep="")


def month_in_text(c: Column | str, tokens: Mapping[str, str] = rules.MONTH_TOKENS) -> Column:
    """Month name for the first month abbreviation found inside a text."""
    return first_match((has_text(c, token), F.lit(name)) for token, name in tokens.items())
