"""Terminal run reconstruction of the two rivers, from landed extracts to review tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidewater import rules
from tidewater.operators import biodata, catch, review, sufficiency
from tidewater.session import settle
from tidewater.sinks.publish import Step, run_steps


@dataclass(frozen=True)
class ConumaInputs:
    sport: DataFrame
    commercial: DataFrame
    nations: Sequence[DataFrame]
    samples: DataFrame
    gsi: DataFrame
    lookup: DataFrame


@dataclass(frozen=True)
class NitinatInputs:
    sport: DataFrame
    report: DataFrame
    samples: DataFrame
    lookup: DataFrame


#: Tables that others of a run share and that are no results themselves.
CONUMA_HIDDEN, NITINAT_HIDDEN = ("standard samples", "sample counts", "all sample points"), ("all sample points",)


def _points_of(year: int) -> Step:
    return lambda t: t["all sample points"].filter(F.col("year") == year)


def conuma_steps(
    inputs: ConumaInputs, rr_year: int, *, report_year: int | None = None, nations_year: int | None = None,
    gsi_year: int | None = None,
) -> dict[str, Step]:
    """Compiled catch and samples, sample sufficiency, orphans and review tables, each from the tables before it."""
    year = report_year or rr_year
    return {
        "catch": lambda t: catch.conuma_catch(
            inputs.sport, catch.commercial_catch(inputs.commercial),
            catch.nations_catch(inputs.nations, nations_year or rr_year), inputs.lookup, rr_year,
        ),
        "standard samples": lambda t: biodata.biosamples(
            inputs.samples, rules.CONUMA_SPORT_AREAS, rules.CONUMA_SAMPLE_SUB_AREAS, river="conuma"
        ),
        "samples": lambda t: biodata.conuma_biodata(
            t["standard samples"], biodata.gsi_results(inputs.gsi, gsi_year or rr_year - 1), inputs.lookup
        ),
        "sample overview": lambda t: biodata.sample_overview(t["standard samples"]),
        "sample counts": lambda t: sufficiency.fishery_counts(t["samples"]),
        "sufficiency": lambda t: sufficiency.sufficiency_of_counts(t["catch"], t["sample counts"], rr_year),
        "orphans": lambda t: sufficiency.orphan_ufids(t["sufficiency"]),
        "orphan table": lambda t: sufficiency.orphan_table(t["orphans"]),
        "orphan candidates": lambda t: sufficiency.orphan_candidates(t["samples"], t["orphans"]),
        "missed samples": lambda t: sufficiency.missed_of_counts(t["sample counts"], t["orphans"], year),
        "catch points": lambda t: review.catch_points(t["catch"], year),
        "temporal catch": lambda t: review.temporal_catch(t["catch"], year),
        "temporal samples": lambda t: review.temporal_samples(t["samples"]),
        "fisheries": lambda t: review.ufid_table(t["catch"], year),
        "all sample points": lambda t: review.sample_points(t["samples"], year, range(4)),
        **{f"sample points {back}": _points_of(year - back) for back in range(4)},
    }


def nitinat_steps(inputs: NitinatInputs, rr_year: int, *, report_year: int | None = None) -> dict[str, Step]:
    """Compiled catch, escapement and samples with the review tables, each from the tables before it."""
    year = report_year or rr_year
    return {
        "catch": lambda t: catch.nitinat_catch(inputs.sport, inputs.report, inputs.lookup, rr_year),
        "samples": lambda t: biodata.nitinat_biodata(
            biodata.biosamples(inputs.samples, rules.NITINAT_SPORT_AREAS, rules.NITINAT_SAMPLE_SUB_AREAS, river="nitinat"),
            inputs.lookup,
        ),
        "catch points": lambda t: review.catch_points(t["catch"], year, "total"),
        "temporal catch": lambda t: review.temporal_catch(t["catch"], year, "total"),
        "temporal samples": lambda t: review.temporal_samples(t["samples"]),
        "fisheries": lambda t: review.ufid_table(t["catch"], year, "total", keep_zero=True, by_month=True),
        "all sample points": lambda t: review.sample_points(t["samples"], year, range(2)),
        **{f"sample points {back}": _points_of(year - back) for back in range(2)},
    }


def _lazy(steps: Mapping[str, Step], hidden: tuple[str, ...], settled: tuple[str, ...]) -> dict[str, DataFrame]:
    done: dict[str, DataFrame] = {}
    for name, step in steps.items():
        done[name] = settle(step(done), "step") if name in settled else step(done)
    return {name: df for name, df in done.items() if name not in hidden}


def conuma_tables(inputs: ConumaInputs, rr_year: int, **years: int | None) -> dict[str, DataFrame]:
    """The tables of a Conuma run without writing it; ``years`` as of ``conuma_steps``.

    What several tables share and is small whatever the samples' number is settled.
    """
    return _lazy(conuma_steps(inputs, rr_year, **years), CONUMA_HIDDEN, ("sample counts", "sufficiency", "all sample points"))


def nitinat_tables(inputs: NitinatInputs, rr_year: int, **years: int | None) -> dict[str, DataFrame]:
    """The tables of a Nitinat run without writing it."""
    return _lazy(nitinat_steps(inputs, rr_year, **years), NITINAT_HIDDEN, ("all sample points",))


def write_conuma_run(inputs: ConumaInputs, rr_year: int, base: str, stamp: str | None = None, **years: int | None) -> int:
    """Write a whole run, each input read once, and publish it; started again, it goes on where it stopped."""
    return run_steps(inputs.samples.sparkSession, conuma_steps(inputs, rr_year, **years), base, stamp, hidden=CONUMA_HIDDEN)


def write_nitinat_run(inputs: NitinatInputs, rr_year: int, base: str, stamp: str | None = None, **years: int | None) -> int:
    return run_steps(inputs.samples.sparkSession, nitinat_steps(inputs, rr_year, **years), base, stamp, hidden=NITINAT_HIDDEN)
