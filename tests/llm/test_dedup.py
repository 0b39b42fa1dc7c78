"""Exact dedup, n-gram join and embedding dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

import tidewater.llm.ngram_join as ngram_join
from tests.helpers import frame
from tidewater.llm.components import components
from tidewater.llm.embedding_dedup import joined as embedding_joined, near_embeddings
from tidewater.llm.exact_dedup import ContentTable, exact_dedup, grace
from tidewater.llm.shared import BATCH_BYTES, LIGHT
from tidewater.llm.shingles import set_key, shingle_set

DOCS = "doc_id long, text string, kept string, component_id string"


def docs(spark, *rows):
    """Documents with columns whose names the operators use themselves."""
    return frame(spark, DOCS, *[(*r, "x", "y") for r in rows])


def classes(nodes, linked):
    """Smallest node reachable from each."""
    of = {n: n for n in nodes}
    for _ in nodes:
        for a in nodes:
            for b in nodes:
                if linked(a, b):
                    of[a] = of[b] = min(of[a], of[b])
    return of


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (8, 7), (50, 50)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(frame(spark, "u long, v long", *edges), "t").collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}
    assert components(frame(spark, "u long, v long"), "t").count() == 0


# ---------------------------------------------------------------- exact dedup

def test_table_tells_texts_with_one_hash_apart():
    table = ContentTable()
    for h, text, doc_id in ((5, b"a", 3), (5, b"b", 2), (5, b"a", None), (5, b"a", 1)):
        table.add(h, text, doc_id, 1)
    assert list(table.records()) == [(5, b"a", 1, 3), (5, b"b", 2, 1)]


@pytest.mark.parametrize("limit", [1, 400, 10**9])
def test_grace_partitions_until_tables_fit(tmp_path, limit):
    draw = random.Random(2)
    texts = [str(draw.randrange(60)).encode() * 5 for _ in range(400)]
    rows = [(int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little"), t, k, 1) for k, t in enumerate(texts)]
    got = {t: (k, n) for _, t, k, n in grace(rows, str(tmp_path), limit)}
    assert got == {t: (texts.index(t), texts.count(t)) for t in texts}
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("limit", [60, 48 << 20])
def test_exact_dedup_equals_brute_force(spark, limit):
    draw = random.Random(3)
    rows = [(k, draw.choice(["a b", "a  b", "a\t\nb", "", None, " ", "x" * 5000, "é b", "a b "])) for k in range(80)]
    rows += [(5, rows[5][1]), (None, "a b"), (None, "alone"), (None, "alone")]
    norm = [re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    want = []
    for (k, _), t in zip(rows, norm):
        ids = [i for (i, _), s in zip(rows, norm) if s == t and i is not None]
        keep = min(ids, default=None)
        want.append((k, keep, norm.count(t), k == keep, hashlib.sha256(t.encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup(docs(spark, *rows).repartition(3), limit).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert exact_dedup(docs(spark)).count() == 0


# ---------------------------------------------------------------- n-gram join

def brute_set(text, size=5):
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]
    size = min(size, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


def test_shingles_are_those_of_the_words():
    for text in ("", None, " \n", "a", "A b\tc  d e", "A b\tc  d e f a b c d e", "x\u00a0y É é z w v", "q " * 3000):
        assert len(shingle_set(text)) == len(brute_set(text))
    assert (shingle_set("A b c d E") == shingle_set(" a\nB c d e ")).all()
    assert (shingle_set("a b") != shingle_set("a b c")).all()


@pytest.mark.parametrize("crowded", [0, 10**9])
def test_t_occurrence_equals_counting(monkeypatch, crowded):
    monkeypatch.setattr(ngram_join, "CROWDED", crowded)
    draw = random.Random(4)
    for _ in range(150):
        lists = [np.array(sorted(draw.sample(range(40), draw.randint(1, 30)))) for _ in range(draw.randint(1, 25))]
        lists.sort(key=len)
        least = draw.randint(1, 20)
        counts = np.bincount(np.concatenate(lists), minlength=40)
        assert sorted(ngram_join.t_occurrence(lists, least)) == [(k, int(c)) for k, c in enumerate(counts) if c >= least]


def near_copies(seed, n=60):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghij") + draw.choice("klmnopqrst") + draw.choice("uvwxyz")
    passage = [word() for _ in range(30)]
    rows, bases = [], [[word() for _ in range(draw.choice([3, 8, 40, 90]))] for _ in range(12)]
    for k in range(n):
        words = list(draw.choice(bases))
        for _ in range(draw.choice([0, 0, 1, 2, 4])):
            words[draw.randrange(len(words))] = word()
        if draw.random() < 0.3:
            words += passage
        rows.append((k * 7 % 101, " ".join(words)))
    return rows


@pytest.mark.parametrize("few, block", [(1, 50), (32, 1_000_000)])
def test_ngram_classes_equal_brute_force(spark, monkeypatch, few, block):
    monkeypatch.setattr(ngram_join, "FEW", few)
    rows = near_copies(5) + [(200, ""), (201, None), (202, " \n"), (203, "One two"), (204, "one  TWO"), (205, "w " * 20_000)]
    sets = {k: brute_set(t) for k, t in rows}
    same = lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    of = classes(list(sets), same)
    got = ngram_join.ngram_classes(docs(spark, *rows).repartition(4), block=block).collect()
    assert sorted(tuple(r) for r in got) == sorted((k, len(sets[k]), of[k]) for k in sets)


def test_ngram_classes_of_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(3, text), (3, text), (3, "other words here"), (None, text + " x"), (None, "alone"), (9, None), (None, None)]
    got = sorted((tuple(r) for r in ngram_join.ngram_classes(docs(spark, *rows)).collect()), key=str)
    assert got == sorted([(3, 26, 3), (3, 26, 3), (3, 1, 3), (None, 27, 3), (None, 1, None), (9, 0, 9), (None, 0, None)], key=str)
    assert ngram_join.ngram_classes(docs(spark)).count() == 0


@pytest.mark.parametrize("turn", [1, -1])
def test_texts_with_one_id_keep_their_own_near_copies(spark, turn):
    """Each of two texts of one id has a near copy; a third near copy has an id of its own."""
    one, two = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    rows = [(3, one), (3, two), (11, two + " x"), (12, one + " x"), (13, one + " x y"), (None, two + " z"), (5, "alone here")]
    got = sorted((tuple(r) for r in ngram_join.ngram_classes(docs(spark, *rows[::turn])).collect()), key=str)
    assert [(r[0], r[2]) for r in got] == [(11, 3), (12, 3), (13, 3), (3, 3), (3, 3), (5, 5), (None, 3)]
    # The classes of the two texts stay apart: without the id in common, each is named by its smallest.
    rows = [(30, one), (30, two), (11, two + " x"), (12, one + " x")]
    got = sorted(tuple(r) for r in ngram_join.ngram_classes(docs(spark, *rows[::turn])).collect())
    assert [(r[0], r[2]) for r in got] == [(11, 11), (12, 12), (30, 11), (30, 12)]


def test_a_set_of_many_groups_is_sent_in_bounded_batches():
    texts = [" ".join(f"w{k}-{i}" for i in range(300)) for k in range(100)]
    keys = [set_key(shingle_set(t)) for t in texts]
    rows = pa.RecordBatch.from_pydict({
        "text": texts, "h1": [k[0] for k in keys], "h2": [k[1] for k in keys], "name": list(range(100)),
        "component": [7] * 100, "blocks": pa.array([60] * 100, pa.int32()),
    })
    sent = list(ngram_join._members(5)(iter([rows])))
    assert sum(b.num_rows for b in sent) == 59 * 100 and max(b.nbytes for b in sent) < 1.1 * LIGHT
    met = [(key, *pair) for b in sent for key, *pair in zip(*(b[c].to_pylist() for c in ("key", "low", "high")))]
    own = {k: (h[1] & 0x7FFFFFFFFFFFFFFF) % 60 for k, h in enumerate(keys)}
    assert sorted(met) == sorted((k, min(own[k], b), max(own[k], b)) for k in own for b in range(60) if b != own[k])


def test_repeated_shingles_of_a_task_are_counted_in_bounded_memory(monkeypatch):
    monkeypatch.setattr(ngram_join, "COUNTED", 400, raising=False)
    monkeypatch.setattr(ngram_join, "DISTINCT", 1_000, raising=False)
    held, top = [], ngram_join._top
    monkeypatch.setattr(ngram_join, "_top", lambda t, c: held.append(sum(map(len, t))) or top(t, c))
    common = " ".join(f"c{i}" for i in range(9))
    texts = [" ".join(f"w{k // 2}-{i}" for i in range(100 - k % 2)) + f" {common}" for k in range(200)]
    rows = pa.RecordBatch.from_pydict({"key": list(range(200)), "spot": list(range(200)), "doc_id": list(range(200)), "text": texts})
    out = pa.Table.from_batches(ngram_join._describe(5)(iter([rows])))
    assert max(held) < 1_600  # 10,000 shingles occur twice each
    seen = {t: n for t, n in zip(out["token"].to_pylist(), out["seen"].to_pylist()) if t is not None}
    assert {seen[t] for t in shingle_set(common).view(np.int64).tolist()} == {200}


def test_batches_for_the_ngram_join_are_light_and_the_session_stays_as_it_was(spark, monkeypatch):
    before, seen, settle = spark.conf.get(BATCH_BYTES), [], ngram_join.settle
    monkeypatch.setattr(ngram_join, "settle", lambda df, name: seen.append(spark.conf.get(BATCH_BYTES)) or settle(df, name))
    assert ngram_join.ngram_classes(docs(spark, (1, "a b c"), (2, "a b c"))).count() == 2
    assert seen and set(seen) == {str(LIGHT)} and spark.conf.get(BATCH_BYTES) == before


# ---------------------------------------------------------------- embeddings

VECTORS = "vec_id long, embedding array<float>, label int, node string, bucket string"


@pytest.mark.parametrize("block", [7, 2048])
def test_near_embeddings_equal_brute_force(spark, block):
    draw = np.random.default_rng(6)
    base = draw.standard_normal((6, 16))
    rows = []
    for k in range(90):
        v = base[k % 6] + draw.choice([0, 0.02, 0.08, 0.15]) * draw.standard_normal(16)
        rows.append((k, [float(x) for x in v.astype(np.float32)], int(k % 4 == 0)))
    rows += [(100, rows[0][1], rows[0][2]), (100, rows[0][1], rows[0][2]), (101, [2 * x for x in rows[1][1]], rows[1][2])]
    odd = [(110, None, 0), (111, [0.0] * 16, 0), (112, [1.0, None] * 8, 0), (113, [float("nan")] * 16, 0),
           (114, rows[0][1], None), (115, [], 0), (116, [float("inf")] * 16, 0), (117, [1.0], 0), (117, [-1.0], 0)]
    x = np.array([r[1] for r in rows], np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    of = classes(list(range(len(rows))), lambda a, b: near[a, b])
    ids = [r[0] for r in rows]
    smallest = {c: min(ids[k] for k in of if of[k] == c) for c in of.values()}
    want = [(ids[k], int(near[k].sum()) - 1, smallest[of[k]], ids[k] == smallest[of[k]]) for k in of]
    want += [(r[0], 0, r[0], True) for r in odd]
    df = frame(spark, VECTORS, *[(*r, "a", "b") for r in rows + odd])
    assert sorted(tuple(r) for r in near_embeddings(df, block=block).collect()) == sorted(want)


def test_links_within_a_cluster_are_rows_no_more(spark, monkeypatch):
    """Four hundred near copies have 79,800 links, and each vector a row for a table at most."""
    from tidewater.llm import embedding_dedup

    draw = np.random.default_rng(3)
    base = draw.standard_normal(16)
    rows = [(k, [float(x) for x in base + 0.01 * draw.standard_normal(16)], 1) for k in range(400)]
    written = {}
    plain = embedding_dedup.settle
    monkeypatch.setattr(embedding_dedup, "settle", lambda df, name: written.setdefault(name, plain(df, name)))
    got = near_embeddings(frame(spark, VECTORS, *[(*r, "a", "b") for r in rows]), block=64).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(399, 0)}
    # Blocks of a bucket, of which there are 7, are checked against each other.
    assert written["links"].count() <= 400 * embedding_dedup.TABLES * 7


def test_joined_classes_are_those_of_the_links():
    draw = np.random.default_rng(4)
    for _ in range(50):
        a, b = draw.integers(0, 40, (2, 25))
        root = embedding_joined(np.arange(40), a[:10], b[:10])
        root = embedding_joined(root, a[10:], b[10:])
        linked = set(zip(a.tolist(), b.tolist()))
        of = classes(list(range(40)), lambda x, y: (x, y) in linked or (y, x) in linked)
        smallest = {c: min(k for k in of if of[k] == c) for c in of.values()}
        assert root.tolist() == [smallest[of[k]] for k in range(40)]


def test_near_embeddings_of_nothing(spark):
    assert near_embeddings(frame(spark, VECTORS)).count() == 0
