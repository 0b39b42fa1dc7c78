"""Hatchery linkage: standardise the five inputs, link them, and bundle the result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidewater import rules
from tidewater.operators import hatchery
from tidewater.session import settle
from tidewater.sinks.bundle import time_stamp, write_table
from tidewater.sinks.publish import Step, run_steps
from tidewater.sources.readers import decode_rows
from tidewater.sources.schemas import TAG_RELEASE_TYPES

DESCRIPTIONS = {
    "1 - all samples linked": "Hatchery samples joined to scale ages, otolith marks, tag releases and the mark "
    "master. Tags come first for stock and age, then otolith stock and scale age.",
    "2 - hatchery samples": "Hatchery samples as landed, with link keys.",
    "3 - scale ages": "Scale batches, containers and age readings as landed, joined, with link keys.",
    "4 - otolith marks": "Otolith recoveries as landed, with link keys.",
    "5 - tag releases": "Tag releases decoded from the landed payload.",
    "6 - mark master": "Thermal mark master as landed, outside Alaska, with link keys.",
}


@dataclass(frozen=True)
class LinkInputs:
    samples: DataFrame
    batches: DataFrame
    projects: DataFrame
    containers: DataFrame
    readings: DataFrame
    otoliths: DataFrame
    tag_payload: DataFrame
    marks: DataFrame


def scale_table(inputs: LinkInputs, year: int, sector: str = "SC") -> tuple[DataFrame, DataFrame]:
    """Joined scale ages of one sector and year, and the readings they came from."""
    # Both are small: their true size lets Spark broadcast them.
    ids = settle(hatchery.select_batches(inputs.batches, sector, year), "batch-ids")
    batches = hatchery.batch_meta(inputs.projects, hatchery.in_batches(inputs.batches, ids)).drop(
        "sector", "sample_year"
    )
    batches = settle(batches, "batches")
    containers = hatchery.container_meta(hatchery.in_batches(inputs.containers, ids, "batch_id"))
    readings = hatchery.in_batches(inputs.readings, ids)
    return hatchery.scale_ages(batches, containers, readings), readings


def link_steps(inputs: LinkInputs, year: int, *, na_matches: str = "never", staged: bool = False) -> dict[str, Step]:
    """The five standardised inputs and the samples linked to them, by report name, each from the tables before it."""
    linked, samples, scales, otoliths, tags, marks = DESCRIPTIONS
    return {
        samples: lambda t: hatchery.hatchery_samples(inputs.samples),
        scales: lambda t: scale_table(inputs, year)[0],
        otoliths: lambda t: hatchery.otolith_marks(inputs.otoliths),
        tags: lambda t: hatchery.tag_releases(decode_rows(inputs.tag_payload, TAG_RELEASE_TYPES)),
        marks: lambda t: hatchery.mark_master(inputs.marks),
        linked: lambda t: hatchery.link_all(
            t[samples], t[scales], t[otoliths], t[tags], t[marks], year, na_matches=na_matches,
            repeats=hatchery.sample_repeats(t[samples]), staged=staged,
        ),
    }


def link_tables(inputs: LinkInputs, year: int, *, na_matches: str = "never", staged: bool = False) -> dict[str, DataFrame]:
    """The linked samples and the five standardised inputs, by report name.

    ``staged`` is for what needs all columns of very many samples: links are then written one after the other.
    """
    done: dict[str, DataFrame] = {}
    for name, step in link_steps(inputs, year, na_matches=na_matches, staged=staged).items():
        done[name] = step(done)
    return {name: done[name] for name in DESCRIPTIONS}


def check_tables(inputs: LinkInputs, year: int, *, na_matches: str = "never") -> dict[str, DataFrame]:
    """The checks made along the way: reconciliation, age gain, discrepancies and repeats."""
    samples = hatchery.hatchery_samples(inputs.samples)
    scales, readings = scale_table(inputs, year)
    linked = hatchery.link_scales(samples, scales, na_matches=na_matches)
    return {
        "scale reconcile": hatchery.scale_reconcile(scales, readings),
        "age gain": hatchery.age_gain_check(samples, linked),
        "age discrepancies": hatchery.age_discrepancies(linked),
        "duplicate codes": hatchery.duplicate_codes(samples),
    }


def write_link_bundle(
    inputs: LinkInputs, year: int, base: str, stamp: str | None = None, *, na_matches: str = "never"
) -> int:
    """Write the bundle under display names and publish it; the linked samples are built from the written inputs."""
    spark = inputs.samples.sparkSession
    steps = link_steps(inputs, year, na_matches=na_matches)
    lines = list(DESCRIPTIONS.items())
    steps["metadata"] = lambda t: spark.createDataFrame(lines, "sheets string, description string")
    return run_steps(spark, steps, base, stamp, names=rules.LINK_DISPLAY)


def write_master(samples: DataFrame, folder: str, stamp: str | None = None) -> str:
    """Export the hatchery samples of all facilities with their link keys; returns the path."""
    path = f"{folder}/ALL_FACILITIES_{stamp or time_stamp()}"
    return write_table(hatchery.hatchery_samples(samples), path, names=rules.LINK_DISPLAY)


def write_join_file(linked: DataFrame, folder: str, stamp: str | None = None) -> str:
    """Export linked samples under the same display names; returns the path."""
    return write_table(linked, f"{folder}/JOIN_{stamp or time_stamp()}", names=rules.LINK_DISPLAY)
