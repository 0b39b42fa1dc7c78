"""Mixing, shards, url filters and the pipeline."""

import re
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.helpers import frame
from tests.oracle_check import compare
from tidewater.llm import training_order
from tidewater.llm.mixing import mix, mixed_documents, mixture, permuted
from tidewater.llm.queries import ORACLES, QUERIES
from tidewater.llm.sentence_pieces import MODEL, send_vocabulary
from tidewater.llm.training_order import CLOSE, Order, read_sequences, write_shards
from tidewater.llm.url_filter import CONTRACT_RULES, RULES, filter_urls

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, taken string, slot string"


def docs(spark, *rows):
    return frame(spark, DOCS, *[(*r, "x", "y") for r in rows])


# ---------------------------------------------------------------- mixing

@pytest.mark.parametrize("n", [1, 2, 3, 10, 64, 1000])
def test_permutation_is_one_to_one(spark, n):
    got = [r[0] for r in spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long"))).collect()]
    assert sorted(got) == list(range(n)) and (n < 10 or got != list(range(n)))


def targets_of(sizes, weights=(5, 2, 1), cap=3):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    held = {}
    while True:
        open_ = [s for s in names if s not in held]
        left = sum(sizes.values()) - sum(held.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return held | share
        held |= {s: cap * sizes[s] for s in over}


def test_mix_reaches_targets_and_repeats_itself(spark):
    rows = [(k, f"w{k} " * (40 + k % 700), "abcd"[min(3, k % 9)]) for k in range(300)]
    rows += [(400 + k, "tiny words", "aa") for k in range(4)] + [(500, None, "b"), (501, "", None), (502, "one  two", None), (None, "x y", "a"), (7, rows[7][1], rows[7][2])]
    df = docs(spark, *rows)
    got = mix(df).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = targets_of(sizes)
    assert len(got) == len(rows) and any(want[s] == 3 * sizes[s] for s in sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r.size
    for s in sizes:
        taken = sum(r.taken for r in got if r.source == s)
        assert abs(taken - want[s]) <= max(32, 0.02 * want[s])
    again = mix(df.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mix(docs(spark)).count() == 0


def test_every_slot_takes_one_block_and_shards_draw_like_the_whole(spark):
    rows = [(k, f"w{k} " * (40 + k % 700), "abcd"[min(3, k % 9)]) for k in range(300)]
    rows += [(500, None, "b"), (501, "", None), (502, "one  two", None)]
    df = docs(spark, *rows)
    got = mixture(df, block=16, shard=256).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
    sizes, by_slot, text = {}, {}, {k: t for k, t, _ in rows}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    for r in got:
        by_slot.setdefault((r.shard, r.slot), []).append(r)
    slots = sorted(s for _, s in by_slot)
    # Every slot once, but for one a source that rounding would give beyond its cap.
    assert len(slots) == len(set(slots)) and slots[0] == 0 and slots[-1] + 1 - len(slots) <= len(sizes)
    assert all(s // 256 == k for k, s in by_slot)
    repeats, drawn = {}, {}
    for (k, _), parts in by_slot.items():
        parts.sort(key=lambda r: r["at"])
        source, index = parts[0]["source"], parts[0]["index"]
        assert {(r["source"], r["index"]) for r in parts} == {(source, index)}
        # The parts fill the block from its beginning, each with words its document has.
        assert [r["at"] for r in parts] == np.cumsum([0] + [r["words"] for r in parts])[:-1].tolist()
        assert sum(r["words"] for r in parts) == min(16, sizes[source] - 16 * index)
        assert all(0 <= r["start"] and r["start"] + r["words"] <= size(text[r["doc_id"]]) for r in parts)
        repeats[source, index] = repeats.get((source, index), 0) + 1
        drawn.setdefault(k, {}).setdefault(source, 0)
        drawn[k][source] += 1
    # Epochs of permutations: a source's blocks are drawn equally often, but for the last epoch, and at most three times.
    for s in sizes:
        times = [repeats.get((s, i), 0) for i in range(-(-sizes[s] // 16))]
        assert max(times) - min(times) <= 1 and max(times) <= 3
    # Counts of a shard lie around its share of the totals as multinomial draws do.
    n, full = len(slots), [k for k in drawn if (k + 1) * 256 <= len(slots)]
    total = {s: sum(d.get(s, 0) for d in drawn.values()) for s in sizes}
    spread = [(drawn[k].get(s, 0) - 256 * total[s] / n) / max(1, (256 * total[s] / n * (1 - total[s] / n)) ** 0.5) for k in full for s in sizes if total[s] > 100]
    assert len(spread) > 50 and max(map(abs, spread)) < 5 and 0.6 < np.std(spread) < 1.4
    # What each document gives is what the slots take.
    taken = {}
    for r in got:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["words"]
    assert {r.doc_id: r.taken for r in mix(df, block=16, shard=256).collect()} == {k: taken.get(k, 0) for k, _, _ in rows}
    again = mixture(df.repartition(5), block=16, shard=256).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_documents_keep_their_columns_and_their_words_near_the_targets(spark):
    rows = [(k, f"w{k} " * (20 + k % 50), "abc"[k % 3]) for k in range(900)]
    out = mixed_documents(docs(spark, *rows, (1000, None, "a")))
    assert out.columns == ["doc_id", "text", "source", "taken", "slot"]
    words = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("n")).collect()}
    want = targets_of({s: sum(20 + k % 50 for k in range(900) if k % 3 == j) for j, s in enumerate("abc")})
    assert all(abs(words[s] - want[s]) < 0.05 * want[s] for s in "abc")
    assert out.where("doc_id = 1000").count() == 1


# ---------------------------------------------------------------- shards

@pytest.mark.parametrize("n", [1, 2, 5, 64, 1000])
def test_order_is_a_keyed_permutation(n):
    order = Order(n)
    slots = order.slot(np.arange(n))
    assert sorted(slots) == list(range(n)) and (order.sequence(slots) == np.arange(n)).all()
    assert n < 64 or (slots != Order(n, key=1).slot(np.arange(n))).any()


@pytest.mark.parametrize("block", [1, 7, 4_096])
def test_shards_hold_every_text_and_are_read_from_any_slot(spark, tmp_path, block):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(k, "some words here " * (k % 30), "a") for k in range(60)] + [(70, None, "a"), (None, "null id", "a"), (5, "again", "a"), (71, "z" * 20_000, "a")]
    docs(spark, *rows).repartition(3).write.parquet(str(tmp_path / "docs"))
    sent, out = send_vocabulary(spark), str(tmp_path / "out")
    placed = write_shards(spark.read.parquet(str(tmp_path / "docs")), sent, out, length=16, shard=40, block=block).collect()
    read = dict(read_sequences(out))
    assert sum(n for _, n in {(r.shard, r.shard_tokens) for r in placed}) == sum(r.n_tokens + 1 for r in placed) or len({r.shard for r in placed}) * 40 < len(read)
    assert list(read) == list(range(len(read)))
    stream = np.concatenate([read[k] for k in Order(len(read)).slot(np.arange(len(read)))])
    found = []
    for r in placed:
        at = r.sequence * 16 + r.byte_offset % 32 // 2
        ids = stream[at : at + r.n_tokens].tolist()
        assert stream[at + r.n_tokens] == CLOSE and r.slot == r.shard * 40 + r.byte_offset // 32
        found.append((r.doc_id, ids))
    assert sorted(found, key=str) == sorted([(k, library.encode(t or "")) for k, t, _ in rows], key=str)
    assert [s for s, _ in read_sequences(out, 38, 5)] == [38, 39, 40, 41, 42]
    assert all((a == b).all() for (_, a), b in zip(read_sequences(out, 38, 5), [read[k] for k in range(38, 43)]))


def test_shards_of_nothing(spark, tmp_path):
    docs(spark).write.parquet(str(tmp_path / "docs"))
    out = write_shards(spark.read.parquet(str(tmp_path / "docs")), send_vocabulary(spark), str(tmp_path / "out"))
    assert out.count() == 0 and list(read_sequences(str(tmp_path / "out"))) == []


# ---------------------------------------------------------------- url filters

URLS = [
    "http://a.com/x", "HTTP://A.Example.COM/en/1?q", "http://www.example.com/en/", "http://deep.www.example.com/en/x#y",
    "https://notexample.com/en/", "http://example.net/es/q", "http://net/fr/", "http://example.com", "http://example.com?/en/",
    "no scheme", None, "", "://", "http:///path", "x://y.org/a://b.com/", "http://example.com/en", "http://a..com/",
    "http://foo.net?u=http://x.org/es/a", "http://foo.net#http://x/fr/b", "http://a.com?u=http://b/c", "http://a.com/x?u=http://net/es/",
    "a:://net/fr/x", "http://net://es/", "http://example.com:80/en/", "http://xcom/", "http://com/" + "p" * 50_000, "http://line\nbreak.com/en/\nx",
]


@pytest.mark.parametrize("per_range", [3, 200_000])
def test_urls_equal_brute_force(spark, per_range):
    rules = [*CONTRACT_RULES, ("org", None, "block"), ("example.com", "/en/", "allow"), (None, "/", "block"), ("", "/", "block"), ("Example.NET", "/es/q", "allow")]
    kept = {}
    for host, path, verdict in rules:
        if host:
            key = (host.lower(), path or "")
            kept[key] = "block" if "block" in (verdict, kept.get(key)) else verdict

    def judge(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host) :]).group()
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fit = [(len(h) + len(p), len(h), h, p) for h, p in kept if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if not fit:
            return host, path, None, "allow"
        _, _, h, p = max(fit)
        return host, path, h + p, kept[h, p]

    rows = [(k % 25, u) for k, u in enumerate(URLS * 3)] + [(None, "http://a.com/")]
    pages = frame(spark, "page_id long, url string, host string, rule string, part int", *[(*r, "h", "r", 1) for r in rows])
    got = filter_urls(pages, spark.createDataFrame(rules, RULES), per_range=per_range).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((k, *judge(u))) for k, u in rows)
    assert filter_urls(pages.limit(0), spark.createDataFrame(rules, RULES)).count() == 0
    assert {r.verdict for r in filter_urls(pages, spark.createDataFrame([], RULES), "block").collect()} == {"block"}


# ---------------------------------------------------------------- queries and pipeline

@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), SF_DIR, ORACLES[name]) == ""


def test_one_query_for_each_operator_and_the_pipeline():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d", n)} == set(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_join", "mixing", "sentence_pieces"]


PIPE = "doc_id long, text string, lang string, source string, n_chars long, kept string, __id string"


def piped(spark, *rows):
    return frame(spark, PIPE, *[(*r, len(r[1] or ""), "x", "y") for r in rows])


def test_stages_decide_and_keep_columns(spark):
    long = " ".join(f"word{chr(97 + k % 26)}{k}" for k in range(60))
    rows = [(1, long, "en", "a"), (2, long.replace(" ", "\n"), "en", "a"), (3, long + " tail", "en", "b"), (1, long, "en", "a"),
            (4, None, "en", "a"), (5, "", "en", "a"), (6, "12 34", "en", "b"), (7, "quite another text", "en", None), (None, "no id here", "en", "b")]
    df = piped(spark, *rows)
    stage = dict(corpus_pipeline.STAGES)
    ids = lambda d: sorted((r.doc_id for r in d.collect()), key=str)
    a = stage["language_id"](spark, df, SF_DIR)
    assert ids(a) == [1, 1, 2, 3, 7, None] and a.columns == df.columns
    b = stage["exact_dedup"](spark, a, SF_DIR)
    assert ids(b) == [1, 3, 7, None] and b.columns == df.columns
    c = stage["ngram_join"](spark, b, SF_DIR)
    assert ids(c) == [1, 7, None] and c.columns == df.columns
    d = stage["mixing"](spark, c, SF_DIR)
    assert d.columns == df.columns and set(ids(d)) <= {1, 7, None}
    assert stage["sentence_pieces"](spark, d, SF_DIR).columns == ["doc_id", "ids"]


def test_language_stage_without_labels_keeps_every_text_with_a_letter(spark):
    df = piped(spark, (1, "some text", None, "a"), (2, "日本", None, "a"), (3, "12 !", None, "a"), (4, None, None, "a"), (5, "", None, "a"))
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, df, SF_DIR)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2] and kept.columns == df.columns


def test_stages_of_an_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, piped(spark), SF_DIR).count() == 0


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF_DIR).where("ids is null").count() == 0


def test_words_are_packed_at_once_and_the_first_are_kept(monkeypatch):
    monkeypatch.setattr(training_order, "REMEMBERED", 100)
    monkeypatch.setattr(training_order, "KEPT", 40)
    words, calls, real = training_order.Words(Path(MODEL).read_bytes(), "uint16"), [], np.array
    texts = [f"the of word{k} é  two" if k % 7 == 0 else f"the of word{k} unheard{k}of" for k in range(200)] + ["", None or ""]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = [np.array(ids, "uint16").tobytes() for ids in library.encode(texts)]
    asked, plain = [], words.encoder.plain_ids
    monkeypatch.setattr(words.encoder, "plain_ids", lambda x: asked.extend(x) or plain(x))
    monkeypatch.setattr(np, "array", lambda *x, **y: calls.append(x) or real(*x, **y))
    assert [x for at in range(0, len(texts), 20) for x in words.encode(texts[at : at + 20])] == want
    assert not calls and asked.count("the") == asked.count("of") == 1 and len(words) < 300


def test_pipeline_hands_small_batches_to_python_and_leaves_the_session_as_it_was(spark, monkeypatch):
    seen, before = [], spark.conf.get(corpus_pipeline.BATCH)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("look", lambda spark, docs, d: seen.append(spark.conf.get(corpus_pipeline.BATCH)) or docs)])
    assert corpus_pipeline.run(spark, SF_DIR).count() and seen == [str(corpus_pipeline.AT_ONCE)]
    assert spark.conf.get(corpus_pipeline.BATCH) == before
