"""The registered queries of this folder: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.alignment import align_tokens
from tidewater.llm.class_lm import lm_scores
from tidewater.llm.collocations import ORACLE as PHRASE_ORACLE, collocations
from tidewater.llm.embedding_dedup import near_embeddings
from tidewater.llm.encoders import BYTE_BPE, PIECE_BPE, ship
from tidewater.llm.exact_dedup import exact_dedup
from tidewater.llm.language_id import identify_languages
from tidewater.llm.mixing import mix
from tidewater.llm.ngram_join import ngram_classes
from tidewater.llm.quality import quality_scores
from tidewater.llm.sentence_pieces import send_vocabulary, token_report
from tidewater.llm.token_counts import token_counts
from tidewater.llm.training_order import write_shards
from tidewater.llm.url_filter import CONTRACT_RULES, ORACLE as URL_ORACLE, RULES, filter_urls

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(_read(spark, sf_dir, "documents"), send_vocabulary(spark))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(_read(spark, sf_dir, "embeddings"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_read(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(_read(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_read(spark, sf_dir, "documents"))


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_shards(_read(spark, sf_dir, "documents"), send_vocabulary(spark))


def op8_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_read(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_read(spark, sf_dir, "documents")).drop("mark", "source")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_read(spark, sf_dir, "pages"), spark.createDataFrame(list(CONTRACT_RULES), RULES))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_read(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_read(spark, sf_dir, "documents"), ship(spark, BYTE_BPE))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(_read(spark, sf_dir, "documents"), ship(spark, BYTE_BPE), ship(spark, PIECE_BPE))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_quality, op2_sentence_pieces, op3_embedding_dedup, op4_language_id, op5_ngram_join, op6_exact_dedup, op7_training_order,
    op8_class_lm, op9_mixing, op10_url_filter, op11_collocations, op12_token_counts, op13_alignment,
)}

# The same results by comparing all pairs and following links recursively, which only small tables allow.
_NEAR_VECTORS = """with recursive usable as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and list_aggregate(embedding, 'count') = len(embedding)
), unit as (
  select vec_id, label, e, sqrt(list_dot_product(e, e)) as n from usable
), near as (
  select a.vec_id as u, b.vec_id as v from unit a join unit b
    on a.label = b.label and a.vec_id <> b.vec_id and a.n > 0 and b.n > 0
  where list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93
), reach as (
  select u, v from near union select r.u, n.v from reach r join near n on n.u = r.v
), least as (select u, min(v) as m from reach group by u), links as (select u, count(*) as n from near group by u)
select vec_id, coalesce(l.n, 0) as n_links, least(vec_id, coalesce(m, vec_id)) as component_id,
  vec_id = least(vec_id, coalesce(m, vec_id)) as kept
from embeddings left join links l on l.u = vec_id left join least on least.u = vec_id
"""

_NEAR_TEXTS = r"""with recursive worded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents
), shingled as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end) as s from worded
), sizes as (select doc_id, count(*) as n from shingled group by doc_id),
pairs as (
  select a.doc_id as u, b.doc_id as v, count(*) as o from shingled a join shingled b on a.s = b.s and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id
), near as (
  select u, v from pairs join sizes x on x.doc_id = u join sizes y on y.doc_id = v where 100 * o >= 75 * (x.n + y.n - o)
), reach as (
  select u, v from near union select r.u, n.v from reach r join near n on n.u = r.v
), least as (select u, min(v) as m from reach group by u)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id left join least l on l.u = d.doc_id
"""

_EQUAL_TEXTS = r"""with plain as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
), grouped as (select t, min(doc_id) as keep_id, count(*) as group_size from plain group by t)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(p.t) as text_sha256
from plain p join grouped g on p.t = g.t
"""

ORACLES: dict[str, str] = {
    "op3_embedding_dedup": _NEAR_VECTORS, "op5_ngram_join": _NEAR_TEXTS, "op6_exact_dedup": _EQUAL_TEXTS,
    "op10_url_filter": URL_ORACLE, "op11_collocations": PHRASE_ORACLE,
}
