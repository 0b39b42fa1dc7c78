"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tidewater.functions.missing import col

# A word restarts after any character that is not a letter, mark, digit,
# apostrophe or underscore.
_WORD_RESTART = r"(?<=[^\p{L}\p{M}\p{N}'_])"


def title_case(c: Column | str) -> Column:
    """Capitalise every word, also after hyphens and brackets (``San-Juan``)."""
    words = F.split(F.lower(col(c)), _WORD_RESTART)
    return F.array_join(F.transform(words, lambda w: F.initcap(w)), "")


def snake_name(name: str) -> str:
    """Column-safe form of a display name: ``Scale Book #`` -> ``scale_book``."""
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_").lower()
