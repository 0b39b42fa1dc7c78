"""Language ID, quality, language model and SentencePiece against brute force, the library and held-out rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.helpers import frame
from tidewater.llm import pieces as pieces_module, sentence_pieces
from tidewater.llm.class_lm import Exchange, _looked_up, _placed, fit, lm_scores, n_classes, transitions
from tidewater.llm.language_id import Parser, identify_languages
from tidewater.llm.pieces import Pieces, blanked, matrix, product, read_vocabulary, route
from tidewater.llm.quality import FLOOR, NAMES, TEMPER, TO_DIAGONAL, TO_POOLED, quality_scores, statistics
from tidewater.llm.shared import words
from tidewater.llm.sentence_pieces import MODEL, decode, encode, send_vocabulary, token_report

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, score string, word string"


def docs(spark, *rows):
    return frame(spark, DOCS, *[(*r, "x", "y") if len(r) == 3 else (*r, None, "x", "y") for r in rows])


def remainder(k, n):
    return zlib.crc32(str(k).encode()) % n


# ---------------------------------------------------------------- language ID

def phrases_of(sample, text):
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and bytes(text[at : at + size + 1]) in sample:
            size += 1
        at, n = at + size, n + 1
    return n


def test_phrases_equal_brute_force():
    draw = random.Random(1)
    text = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    samples = (("a", text("abc ", 400)), ("b", text("abdé ", 300)))
    parser = Parser(samples)
    coded = [bytes(parser.code(s)) for _, s in samples]
    texts = [c for c in (parser.code(text("abcdzé  !", draw.randint(1, 60))) for _ in range(150)) if len(c)]
    assert parser.phrases(texts).tolist() == [[phrases_of(s, c.tolist()) for s in coded] for c in texts]


def test_languages_of_held_out_documents_and_odd_texts(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = {r.doc_id: r.lang for r in df.collect()}
    got = identify_languages(df).collect()
    assert len(got) == len(known) and all(0 <= r.score <= 1 and r.held_out == (remainder(r.doc_id, 4) == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.95 * len(held)

    rows = [(k, "the cat sat on the mat " * 5, "en") for k in range(8)] + [(k, "xqz wvy " * 20, "zz") for k in range(8, 20)]
    rows += [(20, None, "en"), (21, "", "en"), (22, "12 !?", None), (None, "the mat", None), (23, "xqz " * 30_000, None)]
    got = {r.doc_id: r for r in identify_languages(docs(spark, *rows)).collect()}
    assert [got[k].lang_pred for k in (0, 9, 20, 21, 22, None, 23)] == ["en", "zz", "und", "und", "und", "en", "zz"]
    assert got[20].score == 0 and not got[None].held_out
    assert identify_languages(docs(spark)).count() == 0
    assert [r.lang_pred for r in identify_languages(docs(spark, (1, "some text"))).collect()] == ["und"]


# ---------------------------------------------------------------- quality

def test_quality_of_held_out_documents(spark):
    df, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    got = quality_scores(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in held) >= 0.95 * len(held)


def test_quality_of_odd_rows(spark):
    labels = frame(spark, "doc_id long, quality int, text string", *[(k, k % 2, "z") for k in range(20)], (3, None, "z"), (None, 1, "z"))
    rows = [(k, "!!! ???" if k % 2 == 0 else f"A calm sentence number {k}.") for k in range(20)]
    rows += [(30, None), (31, ""), (None, "words"), (32, "w" * 300_000), (33, " \n\n")]
    got = {r.doc_id: r for r in quality_scores(docs(spark, *rows), labels).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    assert got[1].score > 0.5 > got[2].score
    assert {r.score for r in quality_scores(docs(spark, *rows), labels.where("quality = 1")).collect()} == {0.5}
    assert quality_scores(docs(spark), labels).count() == 0
    assert statistics(None) == statistics("") == [0.0] * len(NAMES)


def test_quality_scores_equal_a_plain_discriminant(spark):
    """Fitted row by row with explicit covariances, inverses and determinants in place of moments and factors."""
    draw = random.Random(9)
    text = lambda good: " ".join(draw.choice(["calm", "river", "the", "Of", "see."] if good else ["!!", "$$$", "BUY", "99", "x"]) for _ in range(draw.randint(3, 40)))
    rows = [(k, text(k % 3 > 0)) for k in range(150)] + [(200, ""), (201, None), (7, "a repeated id")]
    labels = [(k, int(k % 3 > 0)) for k in range(150)] + [(3, 0), (200, None), (201, 2), (None, 1), (300, 1)]
    learned = [(statistics(t), y) for k, t in rows for i, y in labels if i == k and remainder(k, 5) != 0 and y in (0, 1)]
    by_class = [np.array([x for x, y in learned if y == c]) for c in (0, 1)]
    d = len(NAMES)
    spread = [(x - x.mean(axis=0)).T @ (x - x.mean(axis=0)) for x in by_class]
    pooled = (spread[0] + spread[1]) / len(learned) + FLOOR * np.eye(d)
    target = pooled.copy()
    target[~np.eye(d, dtype=bool)] *= 1 - TO_DIAGONAL
    covariance = [(1 - TO_POOLED) * (s / len(x) + FLOOR * np.eye(d)) + TO_POOLED * target for s, x in zip(spread, by_class)]
    want = {}
    for k, t in rows:
        density = []
        for x, c in zip(by_class, covariance):
            away = np.array(statistics(t)) - x.mean(axis=0)
            density.append(-0.5 * (away @ np.linalg.inv(c) @ away + math.log(np.linalg.det(c))))
        odds = TEMPER * (density[1] - density[0]) + math.log(len(by_class[1]) / len(by_class[0]))
        want.setdefault(k, []).append(1 / (1 + math.exp(-max(-500, min(500, odds)))))
    df = frame(spark, "doc_id long, quality int", *labels)
    got = quality_scores(docs(spark, *rows), df).collect()
    assert len(got) == len(rows) and 0.1 < sum(r.predicted for r in got) / len(got) < 0.95
    for r in got:
        assert min(abs(r.score - w) for w in want[r.doc_id]) < 1e-6 and r.predicted == (r.score >= 0.3)


# ---------------------------------------------------------------- language model

def class_likelihood(pairs, of, k):
    joint = np.zeros((k, k))
    for (a, b), c in pairs.items():
        joint[of[a], of[b]] += c
    xlogx = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
    return xlogx(joint) - xlogx(joint.sum(axis=0)) - xlogx(joint.sum(axis=1))


def exchanged(pairs, of, k, sweeps):
    """Sweeps over all words by ``Exchange.move``; the likelihood after each."""
    of, found = dict(of), []
    for _ in range(sweeps):
        joint = np.zeros((k, k))
        for (a, b), c in pairs.items():
            joint[of[a], of[b]] += c
        exchange = Exchange(joint, k)
        for w in sorted(of):
            after, before, own = Counter(), Counter(), 0
            for (a, b), c in pairs.items():
                if a == b == w:
                    own += c
                elif a == w:
                    after[of[b]] += c
                elif b == w:
                    before[of[a]] += c
            sides = [np.array(x, t) for side in (after, before) for x, t in ((sorted(side), np.int64), ([side[g] for g in sorted(side)], float))]
            of[w] = exchange.move(of[w], *sides, float(own))
        found.append(class_likelihood(pairs, of, k))
    return of, found


def test_exchange_finds_words_that_stand_alike():
    """a, b are followed by c, d and these by a, b; the classes must be these two pairs."""
    pairs = {}
    for k, left in enumerate((0, 1)):
        for j, right in enumerate((2, 3)):
            pairs[left, right], pairs[right, left] = 20 + k + j, 20 + k - j
    of, _ = exchanged(pairs, {0: 0, 1: 1, 2: 0, 3: 1}, 2, 3)
    assert of[0] == of[1] != of[2] == of[3]


def test_no_move_lowers_the_likelihood():
    draw = random.Random(2)
    for _ in range(10):
        n, k = 12, 4
        pairs = Counter((draw.randrange(n), draw.randrange(n) ** 2 % n) for _ in range(300))
        of = {w: w % k for w in range(n)}
        begun = class_likelihood(pairs, of, k)
        _, found = exchanged(pairs, of, k, 4)
        assert all(b >= a - 1e-6 for a, b in zip([begun, *found], found)) and found[-1] > begun


@pytest.mark.parametrize("head, clustered", [(1 << 17, 1000), (60, 20)])
def test_lm_base_and_counts_equal_brute_force(spark, head, clustered):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows += [(900, None), (901, ""), (None, "the of"), (902, "never-seen never-seen the"), (903, "of " * 20_000)]
    split = lambda t: (t or "").encode().lower().split()
    train = [t for k, t in rows if k is not None and remainder(k, 7) != 2]
    counts = Counter(w for t in train for w in split(t))
    n, v, ends = sum(counts.values()) + len(train), len(counts) + 1, len(train)
    want = {}
    for k, t in rows:
        own = [counts[w] for w in split(t)] + [ends]
        want[k] = (len(own), sum(c > 0 for c in own), sum(math.log10((c + 1) / (n + v + 1)) for c in own))
    got = lm_scores(docs(spark, *rows), head, clustered).collect()
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {n}
    for r in got:
        assert (r.n_tokens, r.n_known) == want[r.doc_id][:2] and math.isclose(r.base_score, want[r.doc_id][2], rel_tol=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.held_out == (r.doc_id is not None and remainder(r.doc_id, 7) == 2) for r in got)


def test_lm_word_probabilities_add_up_to_one(spark):
    """Over all words, an unknown one and the end, after any beginning."""
    words = ["a", "b", "c", "d"]
    rows = [(k, "a b a c a b d"[: 3 + 2 * (k % 6)]) for k in range(40)]
    probe = [(1000 + k, f"a {w}") for k, w in enumerate([*words, "unseen"])]
    ids = [i for i in range(2000, 9000) if remainder(i, 7) == 2]  # held out, so that they change nothing
    probe = [(ids[k], t) for k, (_, t) in enumerate(probe)] + [(ids[-1], "a")]
    got = {r.doc_id: r for r in lm_scores(docs(spark, *rows, *probe), 3, 2).collect()}
    # With x the end, p(a x end) / p(x end) differs by the same factor for all, so compare p(a x end) summed over
    # ends with p(a): drop the end's own share by scoring "a" as a text.
    assert all(got[i].score < 0 for i in ids[:5]) and got[ids[-1]].score < 0
    assert got[ids[0]].n_known == 3 and got[ids[4]].n_known == 2


def test_lm_clusters_every_word_that_recurs_and_its_classes_grow(spark):
    """Beyond 1,000 more frequent words, words that stand before others still get classes apart from theirs."""
    draw = random.Random(3)
    train = [i for i in range(6000) if remainder(i, 7) != 2]
    rows = [(train[k], " ".join(f"f{k % 120 * 10 + j}" for j in range(10))) for k in range(1920)]
    rows += [(train[2000 + k], f"x{k % 60} y{draw.randrange(60)}") for k in range(720)]
    seen = {t for _, t in rows}
    fresh = next((i, j) for i in range(60) for j in range(60) if f"x{i} y{j}" not in seen)
    held = [i for i in range(6000, 7000) if remainder(i, 7) == 2]
    probe = [(held[0], "x%d y%d" % fresh), (held[1], "y%d x%d" % fresh[::-1])]
    for head in (1 << 17, 50):
        got = {r.doc_id: r for r in lm_scores(docs(spark, *rows, *probe), head).where(f"doc_id in ({held[0]}, {held[1]})").collect()}
        assert got[held[0]].score > got[held[1]].score + 1
    assert n_classes(1_000_000) > n_classes(10_000) > n_classes(100)


@pytest.mark.parametrize("head, least", [(1 << 17, 5), (300, 3), (3, 2), (1, 10_000)])
def test_lm_scores_equal_brute_force_whatever_the_head_holds(spark, head, least):
    """Given every word's class: bigrams of all words, in the head or not, counted and scored one by one."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows += [(900, None), (901, ""), (None, "the of"), (902, "never-seen never-seen the"), (903, "of " * 3_000), (901, "")]
    df = docs(spark, *rows)
    train = [k is not None and remainder(k, 7) != 2 for k, _ in rows]
    fitted = fit(frame(spark, "doc_id long, train boolean, text string", *[(k, t, x) for (k, x), t in zip(rows, train)]), head, least)
    table = {r.word: (r.c, r.g) for r in fitted.head.union(fitted.outside).collect()}
    split = lambda t: [w.decode() for w in (t or "").encode().lower().split()]
    counts = Counter(w for (_, t), on in zip(rows, train) if on for w in split(t))
    assert counts == Counter({w: c for w, (c, _) in table.items()})
    k = len(fitted.model.per_class)
    joint, per_class = np.zeros((k + 1, k + 1)), np.zeros(k)
    ones, twos = (sum(c == n for c in counts.values()) for n in (1, 2))
    discount = min(0.9, max(0.1, ones / (ones + 2 * twos)))
    held = np.zeros(k)
    for w, (c, g) in table.items():
        per_class[g] += c
        held[g] += 1
    for (_, t), on in zip(rows, train):
        line = [k, *(table[w][1] for w in split(t)), k] if on else []
        for x, y in zip(line, line[1:]):
            joint[x, y] += 1
    log = transitions(joint, per_class, discount * held / np.maximum(per_class, 1))
    got = lm_scores(df, head, least).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        line = [k, *(table[w][1] if w in table else k + 1 for w in split(t)), k]
        want[i] = sum(log[x, y] for x, y in zip(line, line[1:])) + sum(
            math.log10((table[w][0] - discount) / per_class[table[w][1]]) for w in split(t) if w in table)
    for r in got:
        assert math.isclose(r.score, want[r.doc_id], rel_tol=1e-9), r
    assert len({g for _, g in table.values()}) > 1 or k == 1


def test_lm_transitions_add_up_to_one():
    """Over all words, an unknown one and the end, after any class, the unknown word too."""
    per_class, freed = np.array([10.0, 4.0]), np.array([0.1, 0.3])
    p = 10 ** transitions(np.array([[3.0, 4, 3], [1, 0, 3], [6, 0, 0]]), per_class, freed)
    assert np.allclose(p[:, :2] @ (1 - freed) + p[:, 2] + p[:, 3], 1)


def test_lm_without_rows_or_training(spark):
    assert lm_scores(docs(spark)).count() == 0
    held = next(i for i in range(100) if remainder(i, 7) == 2)
    r = lm_scores(docs(spark, (held, "two words"))).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and math.isfinite(r.score)


# ---------------------------------------------------------------- SentencePiece

TEXTS = ["", "  a  b\tc\n é ﬁ 日本 x", "aaaaaaaaaaaaaaaaa" * 30, " " * 50, "x" + " " * 37 + "y", "no-blank" * 60, "😀é" * 40]


def chunked(pieces, text, size):
    form, cut = blanked(text), []
    for a in range(0, len(form), size):
        low = max(0, a - pieces.longest)
        b = min(len(form), a + size)
        cut.append((form[low : b + pieces.longest], a - low, b - low))
    parts = [matrix(*zip(*pieces.transfer(*c))) for c in cut]
    states = route(parts, 0, None) if parts else []
    return [i for c, x, y in zip(cut, states, states[1:]) for i in pieces.backtrace(*c, x, y)], parts


@pytest.mark.parametrize("size", [7, 40, 300])
def test_chunks_and_whole_texts_encode_as_the_library_does(size):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = Pieces(read_vocabulary(MODEL))
    draw = random.Random(size)
    texts = TEXTS + ["".join(draw.choice("aeinrt thé日") for _ in range(200)) for _ in range(15)]
    for text in texts:
        want = library.encode(text)
        assert np.frombuffer(pieces.encode(blanked(text)), np.int32).tolist() == want
        got, parts = chunked(pieces, text, size)
        assert got == want and pieces.decode(got) == text == library.decode(want)
        if len(parts) > 3:
            left = product(product(parts[0], parts[1]), product(parts[2], parts[3]))
            assert left == product(parts[0], product(parts[1], product(parts[2], parts[3])))


def test_unigram_chunks_reach_the_best_score():
    """The same vocabulary read as a unigram model: chunks must reach the score of the whole, and of brute force."""
    _, rows = read_vocabulary(MODEL)
    pieces = Pieces(("unigram", rows))
    score = lambda ids: sum(rows[i][1] for i in ids if rows[i][2] == "text")

    def brute(form):
        best = [0.0] + [-math.inf] * len(form)
        for end in range(1, len(form) + 1):
            for start in range(max(0, end - pieces.longest), end):
                s = pieces.score.get(form[start:end])
                if s is not None:
                    best[end] = max(best[end], best[start] + s)
        return best[-1]

    for text in ("the rain in those plains stays mainly", "thereinafter" * 20, "a  b   c"):
        whole = np.frombuffer(pieces.encode(blanked(text)), np.int32).tolist()
        assert math.isclose(score(whole), brute(blanked(text)))
        for size in (5, 16, 100):
            got, _ = chunked(pieces, text, size)
            assert math.isclose(score(got), score(whole)) and pieces.decode(got) == text


def test_documents_encode_and_decode(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    sent = send_vocabulary(spark)
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(50, None), (None, "ab"), (3, TEXTS[3]), (60, "longwords " * 900), (60, "longwords " * 900)]
    df = docs(spark, *rows).repartition(3)
    encoded = encode(df, sent, chunk=100)
    assert sorted([(r.doc_id, list(r.ids)) for r in encoded.collect()], key=str) == sorted(
        [(k, library.encode(t or "")) for k, t in rows], key=str)
    assert sorted([tuple(r) for r in decode(encoded, sent).collect()], key=str) == sorted([(k, t or "") for k, t in rows], key=str)
    report = token_report(df, sent, chunk=100).collect()
    assert len(report) == len(rows) and all(r.round_trip for r in report)
    assert encode(docs(spark), sent).count() == 0


def test_lm_words_outside_the_head_of_a_text_meet_in_one_task(spark):
    rows = [(k, True, " ".join(f"the rare{k}x{j}" for j in range(30))) for k in range(40)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        steps = fit(frame(spark, "doc_id long, train boolean, text string", *rows), 4, 5).steps
        files = steps.select("row", F.input_file_name().alias("file")).groupBy("row", "file").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(files) == 40 and all(r["count"] == 30 for r in files) and len({r.file for r in files}) > 1


def test_a_batch_beyond_what_is_remembered_is_encoded_by_the_library(monkeypatch):
    monkeypatch.setattr(pieces_module, "REMEMBERED", 5)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = Pieces(read_vocabulary(MODEL), library)
    slow = []
    pieces.units.encode = lambda unit: slow.append(unit) or pieces.encode_unit(unit)
    texts = ["one two three", "one two four five six", "one seven", "two  eight one"]
    for batch in (texts[:2], texts[2:], texts):
        got = [np.frombuffer(x, np.int32).tolist() for x in pieces.encode_all(list(map(blanked, batch)))]
        assert got == [library.encode(t) for t in batch]
    assert not [u for u in slow if u.startswith("▁")]


def test_a_task_forgets_the_units_it_met():
    class Sent:
        vocabulary = type("", (), {"value": read_vocabulary(MODEL)})
        model = type("", (), {"value": open(MODEL, "rb").read()})

    sent = Sent()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "k1": [2], "text": ["some words here"]})
    out = list(sentence_pieces._encode_short(sent)([batch]))
    assert out[0].num_rows == 1 and not sentence_pieces._pieces(sent).units


def test_words_are_split_and_looked_up_as_bytes_are():
    draw = random.Random(3)
    letters = " \t\n\x0b\x0c\r\x1c\x1f\x85\xa0aBZzÀÉİ\x00▁€😀"
    texts = [None, "", "  "] + ["".join(draw.choice(letters) for _ in range(draw.randrange(20))) for _ in range(500)]
    split = list(map(words, texts))
    head = sorted({w for t in split for w in t})[::2]
    flat, found, lengths = _looked_up(pa.array(texts).slice(1), pa.array([w.decode() for w in head]), -1)
    assert [w.encode() for w in flat.to_pylist()] == [w for t in split for w in t] and lengths.tolist() == list(map(len, split[1:]))
    assert found.tolist() == [head.index(w) if w in head else -1 for t in split for w in t]


def test_words_are_placed_by_all_their_places_in_however_many_batches():
    draw, k = np.random.default_rng(4), 5
    joint = draw.integers(0, 50, (k + 2, k + 2)).astype(float)
    rows = sorted((f"w{draw.integers(40):02}", int(draw.integers(-1, k + 1)), int(draw.integers(-1, k + 1))) for _ in range(300))
    want = {}
    for word in {w for w, _, _ in rows}:
        tables = np.zeros((2, 1, k + 2))
        for w, *sides in rows:
            if w == word:
                for table, place in zip(tables, reversed(sides)):
                    table[0, {-1: k, k: k + 1}.get(place, place)] += 1
        if tables[0].sum() >= 6:
            want[word] = int(Exchange(joint, k).gains(*tables).argmax())
    for size in (1, 7, 300):
        columns = [rows[at : at + size] for at in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(w), pa.array(x, pa.int32()), pa.array(y, pa.int32())], names=["word", "left", "right"])
                   for w, x, y in (zip(*c) for c in columns)]
        got = [r for b in _placed(type("", (), {"value": joint}), k, 6)(batches) for r in b.to_pylist()]
        assert len(got) == len(want) and {r["word"]: r["g"] for r in got} == want


def test_the_head_is_looked_up_for_many_texts_at_once_and_neighbours_are_all_counted(monkeypatch):
    from types import SimpleNamespace

    from tidewater.llm import class_lm

    asked = []
    monkeypatch.setattr(class_lm, "_looked_up", lambda *a: asked.append(len(a[0])) or _looked_up(*a))
    monkeypatch.setattr(class_lm, "TEXT_AT_ONCE", 20_000, raising=False)
    monkeypatch.setattr(class_lm, "AT_ONCE", 9_000)
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(700)]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randrange(4))) or None for _ in range(5000)]
    texts.insert(2500, " ".join(draw.choices(vocabulary, k=9000)))  # longer than what is taken at once
    head, size, ranges = pa.array(vocabulary[:600]), 600, 3
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    run = class_lm._neighbours(SimpleNamespace(value=head), size, ranges)
    found = [Counter(), Counter()]
    for out in run(iter([batch, batch.slice(0, 0)])):
        for r, *data in zip(*(out[c].to_pylist() for c in class_lm._NEIGHBOURS_NAMES)):
            for side, (w, other, n) in enumerate(class_lm._sides(data, size + 2)):
                assert (w % ranges == r).all()
                found[side].update(dict(zip(zip(w.tolist(), other.tolist()), n.tolist())))
    expected = [Counter(), Counter()]
    for text in texts:
        line = [size + 1, *(min(int(w[1:]), size) for w in (text or "").split()), size + 1]
        for a, b in zip(line, line[1:]):
            expected[0][a, b] += a < size
            expected[1][b, a] += b < size
    assert found == [+e for e in expected]
    assert sum(asked) == len(texts) and len(asked) <= 4


def test_order_by_number_is_stable():
    from tidewater.llm.class_lm import _by_number

    numbers = np.random.default_rng(1).integers(0, 1 << 18, 50_000) // 3
    assert (_by_number(numbers) == np.argsort(numbers, kind="stable")).all()
    assert len(_by_number(np.array([], np.int64))) == 0 and _by_number(np.zeros(3, np.int64)).tolist() == [0, 1, 2]
