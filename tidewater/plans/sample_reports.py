"""Reports on the sample table: stock-group coding and quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from tidewater import rules
from tidewater.operators.quality import QC_IDS, qc_counts, qc_exploded, qc_summary_of, qc_table_name
from tidewater.operators.stockgroups import code_stock_groups, stream_areas
from tidewater.session import settle
from tidewater.sinks.bundle import export_coded
from tidewater.sinks.publish import Publication


def write_coded(samples: DataFrame, streams: DataFrame, source: str, stamp: str | None = None) -> str:
    """Code the samples and export them next to their source.

    The stream table is settled first: it is small whatever it was drawn from,
    and at its true size it is broadcast, so the samples are not shuffled.
    """
    areas = settle(stream_areas(streams), "streams")
    return export_coded(code_stock_groups(samples, areas), source, stamp, names=rules.CODED_DISPLAY)


def write_quality_report(samples: DataFrame, base: str, stamp: str | None = None) -> int:
    """Publish the summary and the failing rows of every rule, from one scan of the samples.

    Each row is written once for each rule it fails, into that rule's folder; the counts are observed on
    the way. The report replaces the one before as a whole (``read_published`` gives the newest).
    """
    spark = samples.sparkSession
    out = Publication(spark, base, stamp)
    place, seen = out.place("failures"), Observation()
    rows = qc_exploded(samples.observe(seen, *qc_counts()))
    if "Summary" not in out.entries:
        rows.write.mode("overwrite").partitionBy("issue_id").parquet(place)
        counts = seen.get
        for issue_id in QC_IDS:
            name = qc_table_name(issue_id)
            if name not in out.entries:
                out.add(name, f"{place}/issue_id={issue_id}", samples.schema, counts[issue_id])
        # Last, so that an attempt that ends here is taken up after the one scan.
        out.write("Summary", qc_summary_of(spark, counts))
    return out.commit()
