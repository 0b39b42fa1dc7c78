"""Value recodes driven by the tables in ``rules``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from tidewater import rules
from tidewater.functions.missing import col, first_match, has_text, number


def recode(c: Column | str, table: Mapping) -> Column:
    """Exact-value recode; unlisted values become null."""
    return first_match((col(c) == old, F.lit(new)) for old, new in table.items())


def area_label(sub_area: Column | str, areas: Mapping[str, Sequence[str]], prefix: str) -> Column:
    """Run-reconstruction area of a creel sub-area, null when unmapped."""
    return first_match(
        (col(sub_area).isin(*subs), F.lit(f"{prefix} {area}")) for area, subs in areas.items()
    )


def gear_from_text(c: Column | str, tokens: Mapping[str, str]) -> Column:
    """Gear named by the first token found in a text."""
    return first_match((has_text(c, token), F.lit(gear)) for token, gear in tokens.items())


def size_bin(c: Column | str, steps: Sequence[tuple[float, int]], top: int) -> Column:
    """Plot size of a count: the first step whose bound exceeds it, else ``top``."""
    c = col(c)
    bins = [(c < bound, F.lit(size)) for bound, size in steps]
    return first_match([*bins, (c.isNotNull(), F.lit(top))])


def genetic_region(c: Column | str) -> Column:
    return recode(c, rules.GENETIC_REGIONS)


def total_age(gr_age: Column | str) -> Column:
    """Total age of a two-character Gilbert-Rich age code."""
    return recode(gr_age, rules.GILBERT_RICH_AGES)


def pfma_number(c: Column | str) -> Column:
    """Management area number of a text such as ``PFMA 25``."""
    return number(F.substring(col(c), 6, 4), "int")
