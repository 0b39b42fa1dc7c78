"""URL filters by a sort-merge range join of reversed-host keys.

A host's labels in reverse, each closed by a dot, are its key, so a rule's host and all its
subdomains are the interval of keys that begin with the rule's. Rules and urls are sorted by key into
ranges, and a sweep over each range keeps the stack of the rules whose interval is open: nested intervals
close in the reverse order of opening. An open rule fits where the url's path begins with its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.llm.shared import only
from tidewater.session import settle

RULES = StructType([StructField(n, StringType()) for n in ("host", "path", "verdict")])
#: Rows of a range.
PER_RANGE = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or end; another ``://`` further on is nothing special."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*(/[^?#]*)", 1), F.lit(""))


def reversed_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _prefixes(key: Column) -> Column:
    """The key's own prefixes that end with a label."""
    labels = F.split(key, r"\.")
    n = F.size(labels) - 1
    return F.transform(F.sequence(F.lit(1), n), lambda k: F.concat(F.array_join(F.slice(labels, 1, k), "."), F.lit(".")))


class Sweep:
    """The stack of rules whose intervals are open at a key; keys come in ascending order."""

    def __init__(self):
        self.part, self.open = None, []

    def move(self, part: int, key: str) -> None:
        if part != self.part:
            self.part, self.open = part, []
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()

    def add(self, key: str, path: str, verdict: str) -> None:
        """Rules with one key share a level, longer paths first, blocking ones before others."""
        if not self.open or self.open[-1][0] != key:
            self.open.append((key, []))
        level = self.open[-1][1]
        if (path, verdict) not in level:
            level.append((path, verdict))
            level.sort(key=lambda r: (-len(r[0]), r[1] != "block"))

    def match(self, path: str) -> tuple[str, str, str] | None:
        """Longest host and path together; of equals the longer host."""
        best = None
        for key, level in reversed(self.open):
            for own, verdict in level:
                if path.startswith(own):
                    if best is None or len(key) + len(own) > len(best[0]) + len(best[1]):
                        best = (key, own, verdict)
                    break
        return best


def _swept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sweep = Sweep()
    for batch in batches:
        out = []
        columns = (batch[c].to_pylist() for c in ("part", "key", "kind", "page_id", "host", "path", "verdict"))
        for part, key, kind, page_id, host, path, verdict in zip(*columns):
            sweep.move(part, key)
            if kind == 0:
                sweep.add(key, path, verdict)
                continue
            found = sweep.match(path)
            rule = None
            if found:
                rule = ".".join(reversed(found[0][:-1].split("."))) + found[1]
            out.append((page_id, host, path, rule, found[2] if found else None))
        if out:
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["page_id", "host", "path", "rule", "verdict"]
            )


def filter_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", per_range: int = PER_RANGE) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict`` in any number. A rule fits its host and all
    subdomains where the url's path begins with the rule's; the longest host and path together wins,
    of equals the one with the longer host; one rule with two verdicts blocks.

    Urls of one host are spread over ranges by a hash of the url, so a hot host fills no task.
    A range that begins amid open rules gets them with its first key: they are the rules whose key is one
    of that key's prefixes, as many as the host has labels.

    Cases: null urls and those without ``://`` have empty host and path, fit no rule and get
    ``otherwise``; rules with a null or empty host are left out, a null path is empty; repeated rows
    and rules change nothing; null ids are kept; an empty table gives no rows.
    """
    url = F.col("url")
    pages = only(pages, page_id="long", url="string").select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.xxhash64("url").alias("spread")
    )
    rules = rules.where("host != ''").select(
        F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    ).distinct()
    rules = settle(rules.withColumn("key", reversed_key(F.col("host"))), "rules")
    nothing = F.lit(None)
    events = pages.select(
        reversed_key(F.col("host")).alias("key"), F.lit(1).alias("kind"), "spread", "page_id", "host", "path",
        nothing.cast("string").alias("verdict"),
    ).union(rules.select("key", F.lit(0), F.lit(0).cast("long"), nothing.cast("long"), "host", "path", "verdict"))
    events = settle(events, "events")
    ranges = max(1, -(-events.count() // per_range))
    placed = events.repartitionByRange(ranges, "key", "kind", "spread").withColumn("part", F.spark_partition_id())
    placed = settle(placed, "ranges")
    firsts = placed.groupBy("part").agg(F.min("key").alias("first"))
    openers = firsts.select("part", F.explode(_prefixes(F.col("first"))).alias("key")).join(rules, "key").select(
        "key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("spread"), nothing.cast("long").alias("page_id"),
        "host", "path", "verdict", "part",
    )
    order = ["part", "key", "kind"]
    swept = placed.union(openers).repartition("part").sortWithinPartitions(*order).mapInArrow(
        _swept, "page_id long, host string, path string, rule string, verdict string"
    )
    return swept.withColumn("verdict", F.coalesce("verdict", F.lit(otherwise)))


#: The rules of the registered query, fixed by its contract.
CONTRACT_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)

ORACLE = r"""
with parts as (
  select page_id,
    case when strpos(url, '://') > 0 then translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
    case when strpos(url, '://') > 0 then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*(/[^?#]*)', 1)
      else '' end as path
  from pages
), ruled as (
  select *, case
    when (host = 'www.example.com' or host like '%.www.example.com') and path like '/en/%' then 'www.example.com/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/en/%' then 'example.com/en/'
    when (host = 'net' or host like '%.net') and path like '/es/%' then 'net/es/'
    when (host = 'net' or host like '%.net') and path like '/fr/%' then 'net/fr/'
    when (host = 'com' or host like '%.com') and path like '/%' then 'com/' end as rule
  from parts
)
select page_id, host, path, rule,
  case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' else 'allow' end as verdict
from ruled
"""
