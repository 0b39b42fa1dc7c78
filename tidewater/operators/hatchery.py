"""Link hatchery samples to scale ages, otolith marks, tag releases and the mark master."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewater import rules
from tidewater.functions.missing import (
    col, first_match, is_in, join_present, matches, number,
)
from tidewater.functions.recode import recode
from tidewater.functions.text import title_case
from tidewater.operators.joins import Factored, factored_join, join_on, rows_not_in
from tidewater.operators.reshape import select_blocks
from tidewater.session import Stage

SCALE_KEYS = ("r_scale_book_num", "r_scale_cell_num")
OTOLITH_KEYS = ("r_otolith_box_num", "r_otolith_vial_num")
TAG_KEYS = ("r_tagcode",)
MARK_KEYS = ("r_brood_year", "r_hatch_code")
#: What deals samples without a link's key to tasks.
SPREAD = ("r_otolith_box_vial_concat", *OTOLITH_KEYS, *SCALE_KEYS)
#: Columns of hatchery samples whose text is that of a link key.
SAMPLE_TEXTS = {
    "bag_no": "r_otolith_box_num", "vial_no": "r_otolith_vial_num",
    "book_no": "r_scale_book_num", "scale_sample_no": "r_scale_cell_num",
}


def with_scale_keys(df: DataFrame, book: str, cell: str) -> DataFrame:
    """Scale book, cell and book-cell under their common names, as text."""
    return df.withColumns(
        {
            "r_scale_book_num": col(book).cast("string"),
            "r_scale_cell_num": col(cell).cast("string"),
            "r_scale_book_cell_concat": join_present(book, cell),
        }
    )


def with_otolith_keys(df: DataFrame, box: str, vial: str) -> DataFrame:
    """Otolith box, vial and box-vial under their common names, as text."""
    return df.withColumns(
        {
            "r_otolith_box_num": col(box).cast("string"),
            "r_otolith_vial_num": col(vial).cast("string"),
            "r_otolith_box_vial_concat": join_present(box, vial),
        }
    )


def hatchery_samples(df: DataFrame) -> DataFrame:
    """Hatchery biosamples with a stock, under the common link keys."""
    named = df.filter(F.col("spawning_stock") != "").withColumn("book_no", F.col("book_no").cast("string"))
    keyed = with_scale_keys(with_otolith_keys(named, "bag_no", "vial_no"), "book_no", "scale_sample_no")
    return keyed.withColumn("r_tagcode", F.col("cwt_tag_code"))


def sample_repeats(samples: DataFrame) -> dict[str, Column]:
    """Columns of ``hatchery_samples`` that follow from its link keys, which therefore need not be moved beside them."""
    kinds = dict(samples.dtypes)
    same = {c: F.col(key) for c, key in SAMPLE_TEXTS.items() if kinds[c] == "string"}
    return same | {
        "cwt_tag_code": F.col("r_tagcode"),
        "r_otolith_box_vial_concat": join_present(*OTOLITH_KEYS),
        "r_scale_book_cell_concat": join_present(*SCALE_KEYS),
    }


def escapement_samples(df: DataFrame, blocks: Sequence[tuple[str, str]]) -> DataFrame:
    """Chosen column blocks of the escapement sheet under the common link keys."""
    kept = select_blocks(df, blocks)
    keyed = with_scale_keys(
        with_otolith_keys(kept, "otolith_box", "otolith_specimen"), "scale_book", "scale"
    )
    return keyed.withColumn("r_sample_year", F.col("year"))


def select_batches(batches: DataFrame, sector: str, year: int) -> DataFrame:
    """Ids of the scale batches of one sector and sample year."""
    return batches.filter((F.col("sector") == sector) & (F.col("sample_year") == year)).select("id").distinct()


def in_batches(records: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """Records of the chosen batches, as one table."""
    return records.join(ids.select(F.col("id").alias(column)), column, "left_semi")


def batch_meta(projects: DataFrame, batches: DataFrame) -> DataFrame:
    """Batch descriptions with the location of their project."""
    return projects.select("id", "location").join(batches, "id", "inner")


def container_meta(df: DataFrame) -> DataFrame:
    """Containers with text labels and start and end dates."""
    text = {c: F.col(c).cast("string") for c in ("field_container_id", "container_notes", "analyst_name")}
    dates = {c: F.to_date(F.col(c)) for c in ("cnt_start_date", "cnt_end_date")}
    return df.withColumns({**text, **dates})


def scale_ages(batches: DataFrame, containers: DataFrame, readings: DataFrame) -> DataFrame:
    """Batches, containers and age readings in one table; unmatched rows of each are kept.

    Containers have many rows per batch. The readings' key holds the container, so a plain full join will do.
    """
    described = join_on(
        batches.withColumnRenamed("id", "batch_id"),
        containers.withColumnRenamed("id", "container_id"),
        ["batch_id"],
        "full",
        hot="right",
    )
    joined = join_on(
        described, readings.withColumnRenamed("id", "batch_id"), list(rules.READING_KEYS), "full"
    )
    return with_scale_keys(joined, "container_id", "fish_number")


def scale_reconcile(joined: DataFrame, readings: DataFrame) -> DataFrame:
    """One row: do the joined rows less the unaged ones equal the readings?"""
    unaged = F.col("gr_age").isNull() & F.col("scale_condition").isNull()
    counts = joined.select(F.lit(1).alias("j"), unaged.cast("int").alias("u"), F.lit(0).alias("r")).unionByName(
        readings.select(F.lit(0).alias("j"), F.lit(0).alias("u"), F.lit(1).alias("r"))
    )
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in
             (("j", "joined_rows"), ("u", "unaged_rows"), ("r", "reading_rows"))]
    return counts.agg(*total).withColumn(
        "reconciled", F.col("joined_rows") - F.col("unaged_rows") == F.col("reading_rows")
    )


def otolith_marks(df: DataFrame) -> DataFrame:
    """Otolith recoveries with facility names as the mark master spells them."""
    facility = F.coalesce(recode("facility", rules.FACILITY_RENAMES), F.col("facility"))
    return with_otolith_keys(df.withColumn("facility", facility), "box_code", "cell_number")


def mark_master(df: DataFrame) -> DataFrame:
    """Thermal marks released outside Alaska, under the common keys."""
    kept = df.filter(F.col("state_province") != "ALASKA").select(*rules.MARK_COLUMNS)
    return kept.withColumns({"r_brood_year": F.col("brood_year"), "r_hatch_code": F.col("hatch_code")})


def tag_releases(df: DataFrame) -> DataFrame:
    """Coded-wire-tag releases; descriptive columns get a ``tag_`` prefix."""
    kept = df.select(*rules.TAG_COLUMNS).withColumnsRenamed(
        {c: f"tag_{c}" for c in rules.TAG_COLUMNS if c != "tagcode"}
    )
    return kept.withColumn("r_tagcode", F.col("tagcode"))


def _link(left: DataFrame, right: DataFrame, keys: Sequence[str], na_matches: str, hashed: bool = False) -> DataFrame:
    """A sample without a key meets nothing, unless ``na_matches="na"`` lets it meet every right row without one.

    Most samples lack some key, so those without are dealt to all tasks. ``hashed`` is for right sides as large as
    the samples with few rows to a key; the samples are then not sorted.
    """
    return join_on(left, right, keys, "left", na_matches=na_matches, spread_by=SPREAD, hashed=hashed and na_matches == "never")


def link_scales(
    samples: DataFrame, scales: DataFrame, *, na_matches: str = "never"
) -> DataFrame:
    """Attach scale ages by book and cell; the joined book-cell text follows from the two."""
    return _link(samples, scales.drop("r_scale_book_cell_concat"), SCALE_KEYS, na_matches, hashed=True)


def link_otoliths(
    samples: DataFrame, otoliths: DataFrame, *, na_matches: str = "never"
) -> DataFrame:
    """Attach otolith marks by box and vial; the joined box-vial text follows from the two."""
    return _link(samples, otoliths.drop("r_otolith_box_vial_concat"), OTOLITH_KEYS, na_matches, hashed=True)


def link_tags(
    samples: DataFrame, tags: DataFrame, *, na_matches: str = "never"
) -> DataFrame:
    """Attach tag releases by tag code."""
    return _link(samples, tags, TAG_KEYS, na_matches)


def factored_tags(samples: DataFrame, tags: DataFrame) -> Factored:
    """Samples and tag releases with missing codes matching each other, counted without being multiplied."""
    return factored_join(samples, tags, ["r_tagcode"])


def link_marks(
    samples: DataFrame, marks: DataFrame, *, na_matches: str = "never"
) -> DataFrame:
    """Attach the mark master by brood year and hatch code."""
    return _link(samples, marks, MARK_KEYS, na_matches)


def resolved_gr_age() -> Column:
    """Hatchery's own scale age, else a readable lab age ending in 1 or 2."""
    own, lab = F.col("scale_gilbert_age"), F.col("gr_age")
    readable = matches(lab, "1$|2$")
    return first_match(
        [
            (F.col("total_age_yrs").isNotNull(), own),
            (own.isNull() & readable, lab),
            (is_in("scale_part_age", rules.UNREADABLE_SCALES) & readable, lab),
        ]
    )


def resolved_total_age(year: int) -> Column:
    """Age from the tag's brood year, else the first digit of the resolved scale age.

    The scale test reads (starts with a digit and lab age ends in 1) or lab age ends in 2.
    """
    brood, age, lab = F.col("tag_brood_year"), F.col("r_resolved_gr_age"), F.col("gr_age")
    from_scale = (matches(age, "^[0-9]") & lab.endswith("1")) | lab.endswith("2")
    return first_match(
        [
            (brood.isNotNull(), (F.lit(year) - number(brood, "int")).cast("string")),
            (from_scale, F.substring(age, 1, 1)),
        ]
    )


def resolved_brood_year() -> Column:
    """Brood year of the tag, else sample year less total age."""
    return F.coalesce(
        number("tag_brood_year", "int"),
        F.when(
            F.col("tag_brood_year").isNull(), F.col("r_sample_year") - number("r_resolved_total_age", "int")
        ),
    )


def resolve_ages(df: DataFrame, year: int) -> DataFrame:
    """Resolved scale age, total age, brood year and hatch code of linked samples."""
    return (
        df.withColumn("r_resolved_gr_age", resolved_gr_age())
        .withColumn("r_resolved_total_age", resolved_total_age(year))
        .withColumn("r_sample_year", F.lit(year))
        .withColumns({"r_brood_year": resolved_brood_year(), "r_hatch_code": F.col("hatch_code")})
    )


def resolved_stock() -> Column:
    """Stock site of the tag, else the mark's stock name after its two-letter prefix."""
    from_mark = title_case(F.substr(F.col("stock"), F.lit(3)))
    return F.coalesce(F.col("tag_stock_site_name"), from_mark)


def age_gain_check(samples: DataFrame, linked: DataFrame) -> DataFrame:
    """One row: is the number of samples without own age and scale book the same after the link?"""
    missing = (F.col("scale_gilbert_age").isNull() & F.col("book_no").isNull()).cast("int")
    counts = samples.select(missing.alias("b"), F.lit(0).alias("a")).unionByName(
        linked.select(F.lit(0).alias("b"), missing.alias("a"))
    )
    return counts.agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("base_missing"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("linked_missing"),
    ).withColumn("same", F.col("base_missing") == F.col("linked_missing"))


def age_discrepancies(linked: DataFrame) -> DataFrame:
    """Identified samples whose own and lab scale ages differ, or lack one."""
    same = F.coalesce(F.col("scale_gilbert_age") == F.col("gr_age"), F.lit(False))
    identified = F.col("batch_id").isNotNull() | F.col("r_scale_book_cell_concat").isNotNull()
    return linked.filter(~same & identified).select(
        "batch_id", "r_scale_book_cell_concat", "scale_gilbert_age", "gr_age", F.lit("FALSE").alias("dif")
    )


def duplicate_codes(df: DataFrame, code: str = "r_otolith_box_vial_concat") -> DataFrame:
    """Codes that occur on more than one row."""
    counts = df.filter(F.col(code).isNotNull()).groupBy(code).agg(F.count(F.lit(1)).alias("__n"))
    return counts.filter(F.col("__n") > 1).select(code)


def without_duplicates(df: DataFrame, code: str = "r_otolith_box_vial_concat") -> DataFrame:
    """Rows whose code is missing or occurs once; the few repeated codes are taken out by an anti join."""
    return rows_not_in(df, duplicate_codes(df, code), code)


def mark_crosstab(marks: DataFrame, years: Sequence[int], province: str = "BRITISH COLUMBIA") -> DataFrame:
    """Numbers released by hatch code, facility and stock, one column per brood year."""
    wanted = marks.filter(F.col("brood_year").isin(*years) & (F.col("state_province") == province))
    brood, n = F.col("brood_year"), F.col("number_released")
    # One missing number makes its whole cell missing.
    cells = [
        F.when(F.count_if((brood == y) & n.isNull()) == 0, F.sum(F.when(brood == y, n))).alias(str(y)) for y in years
    ]
    return wanted.groupBy("hatch_code", "facility", "stock").agg(*cells)


def reused_hatch_codes(marks: DataFrame, years: Sequence[int], province: str = "BRITISH COLUMBIA") -> DataFrame:
    """Hatch codes used by more than one facility or stock."""
    def distinct_values(name: str) -> Column:
        return F.count_distinct(name) + F.max(F.col(name).isNull().cast("int"))

    return (
        marks.filter(F.col("brood_year").isin(*years) & (F.col("state_province") == province))
        .groupBy("hatch_code")
        .agg(F.greatest(distinct_values("facility"), distinct_values("stock")).alias("times_used"))
        .filter(F.col("times_used") > 1)
    )


def _packed(right: DataFrame, keys: Sequence[str], slot: str) -> DataFrame:
    """The keys, and all other columns in one, which takes no room in samples that meet nothing."""
    return right.select(*keys, F.struct(*[_named(c) for c in right.columns if c not in keys]).alias(slot))


def _named(*path: str) -> Column:
    return F.col(".".join("`" + p.replace("`", "``") + "`" for p in path))


def _with_fields(fields: Mapping[str, Column], right: DataFrame, keys: Sequence[str], slot: str) -> dict[str, Column]:
    """Columns of linked samples by name, once ``right`` is in ``slot``; clashing ones get suffixes as in ``join_on``."""
    own = [c for c in right.columns if c not in keys]
    left = {c + "_x" if c in own else c: value for c, value in fields.items()}
    return left | {c + "_y" if c in fields else c: _named(slot, c) for c in own}


def _link_some(
    link: Callable[..., DataFrame], left: DataFrame, right: DataFrame, keys: Sequence[str], na_matches: str
) -> DataFrame:
    """The same rows as ``link`` gives; rows that lack a key and so meet nothing are not moved."""
    if na_matches != "never":
        return link(left, right, na_matches=na_matches)
    lacks = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return link(left.filter(~lacks), right).unionByName(left.filter(lacks), allowMissingColumns=True)


def link_all(
    samples: DataFrame, scales: DataFrame, otoliths: DataFrame, tags: DataFrame, marks: DataFrame,
    year: int, *, na_matches: str = "never", repeats: Mapping[str, Column] | None = None, staged: bool = False,
) -> DataFrame:
    """All four links in order, with resolved ages, brood year and stock.

    Samples move from link to link with what they met packed in one column a link, and without their ``repeats``,
    columns that follow from their others; all are laid out, and ages resolved, after the last link.

    With ``staged``, what a link has made is written before the next one reads it, in place of what the link before
    has made: the disk then holds the shuffle files of one link and not of all, and samples without a link's key
    are not among them. This writes samples three times more.
    """
    repeats, stage = repeats or {}, Stage()
    fields = {c: repeats.get(c, _named(c)) for c in samples.columns}
    linked = samples.drop(*repeats)
    scales, otoliths = scales.drop("r_scale_book_cell_concat"), otoliths.drop("r_otolith_box_vial_concat")
    for link, right, keys, slot in (
        (link_scales, scales, SCALE_KEYS, "__scales"),
        (link_otoliths, otoliths, OTOLITH_KEYS, "__otoliths"),
        (link_tags, tags, TAG_KEYS, "__tags"),
    ):
        fields = _with_fields(fields, right, keys, slot)
        packed = _packed(right, keys, slot)
        if staged:
            linked = stage.settle(_link_some(link, linked, packed, keys, na_matches), slot.strip("_"))
        else:
            linked = link(linked, packed, na_matches=na_matches)

    named = linked.withColumns({c: value for c, value in fields.items() if c not in linked.columns})
    kept = [_named(c) for c in linked.columns if c not in MARK_KEYS]
    linked, marks_of = resolve_ages(named, year).select(*kept, *MARK_KEYS), _packed(marks, MARK_KEYS, "__marks")
    # Few samples have both keys; the others need not be moved once more.
    linked = _link_some(link_marks, linked, marks_of, MARK_KEYS, na_matches)
    # The keys are taken as they were moved, all else is resolved here.
    laid_out = [value.alias(c) for c, value in fields.items()]
    aged = resolve_ages(linked.select(*laid_out, "__marks", *[_named(c).alias("__moved_" + c) for c in MARK_KEYS]), year)
    fields = {c: _named(c) for c in aged.columns if not c.startswith("__")} | {c: _named("__moved_" + c) for c in MARK_KEYS}
    fields = _with_fields(fields, marks, MARK_KEYS, "__marks")
    out = aged.select(*[value.alias(c) for c, value in fields.items()])
    return out.withColumn("r_resolved_stock_id", resolved_stock())
