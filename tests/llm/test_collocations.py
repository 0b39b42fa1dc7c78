"""Quotient filters and collocations against plain counting."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.helpers import frame
from tidewater.llm import collocations as module
from tidewater.llm.collocations import collocations
from tidewater.llm.quotient_filter import MOST_BITS, Packing, QuotientFilter


@pytest.mark.parametrize("width", [1, 2, 7, 19, 21, 22, 29, MOST_BITS])
def test_packing_can_be_undone_and_filters_lose_nothing(width):
    draw = np.random.default_rng(width)
    packing = Packing(width)
    ids = [draw.integers(0, 1 << width, 3_000) for _ in range(3)]
    again = packing.unpack(*packing.pack(*ids))
    assert all((a == b).all() for a, b in zip(ids, again))
    ids = [np.concatenate([x, x[:500], np.repeat(x[:1], 700), np.repeat(x[1:2], 254)]) for x in ids]  # counts beyond a byte, too
    want = Counter(zip(*(x.tolist() for x in ids)))
    keys = packing.pack(*ids)
    halves = [QuotientFilter.of(packing.half, *(k[cut] for k in keys)) for cut in (slice(None, 2_000), slice(2_000, None))]
    for prefix in (0, min(packing.half, 3)):
        parts = defaultdict(list)
        for f in halves:
            for which, part in f.split(prefix):
                data = part.to_bytes()
                back = QuotientFilter.from_bytes(data, which)
                assert all((getattr(back, x) == getattr(part, x)).all() for x in ("left", "right", "counts")) and back.to_bytes() == data
                parts[which].append(back)
        got = Counter()
        for same in parts.values():
            merged = QuotientFilter.merged(same)
            order = list(zip(merged.left.tolist(), merged.right.tolist()))
            assert order == sorted(set(order))
            got.update(dict(zip(zip(*(x.tolist() for x in packing.unpack(merged.left, merged.right))), merged.counts.tolist())))
        assert got == want


def test_filters_are_compact_and_may_be_empty():
    packing = Packing(19)
    draw = np.random.default_rng(1)
    f = QuotientFilter.of(packing.half, *packing.pack(*(draw.integers(0, 1 << 19, 100_000) for _ in range(3))))
    assert len(f.to_bytes()) < 7 * len(f)  # 24 in three 64-bit ids, 8 in one
    none = QuotientFilter.of(packing.half, np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    assert len(QuotientFilter.from_bytes(none.to_bytes(), 0)) == 0 and none.split(2) == []
    with pytest.raises(ValueError):
        Packing(MOST_BITS + 1)


def brute(rows, least, top):
    counts = defaultdict(Counter)
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if len(p) == 2 and any(len(q) == 3 and p in (q[:2], q[1:]) and c >= least and 100 * c >= 50 * a for q, c in f.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            yield lang, rank, phrase.decode(), -a, l, r, n, -score


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("sizes", [{}, {"row_words": 100, "own_ids": 15, "at_once": 300}])  # the second: many parts and ranges
def test_rows_equal_brute_force(spark, sizes):
    draw = random.Random(4)
    words = ["New", "york", "é", "É", "the", "of", "日本", "a\x1cb", "x\x00", "\x85y", "o'k", "of-the"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "! ", "\r\n"]
    rows = []
    for k in range(300):
        text = "".join(draw.choice(words if draw.random() < 0.8 else words[:2]) + draw.choice(gaps) for _ in range(draw.randint(0, 25)))
        rows.append((draw.choice(["en", "fr", None, "und"]), text))
    rows += [("de", "one two three " * 400), ("de", None), (None, None), ("es", ""), ("es", "rare words only"), rows[0], rows[0]]
    df = frame(spark, "lang string, text string, c string, id string", *[(*r, "x", "y") for r in rows]).repartition(3)
    got = [tuple(r[c] for c in COLUMNS) for r in collocations(df, least=4, top=30, **sizes).collect()]
    assert sorted(got) == sorted(brute(rows, 4, 30)) and {r[0] for r in got} == {"en", "fr", "und", "de"}


def test_large_counts_and_empty_tables(spark):
    """Squares of counts beyond 64 bits stay whole."""
    f = spark.createDataFrame([(3_000_000_000_000, 3_000_000_000_001, 5_000_000_000_000)], "a long, l long, r long")
    assert f.select(module._score("a", "l", "r")).first()[0] == 1_000_000 * 3_000_000_000_000**2 // (3_000_000_000_001 * 5_000_000_000_000)
    empty = collocations(frame(spark, "lang string, text string"))
    assert empty.count() == 0 and tuple(empty.columns) == COLUMNS
    assert collocations(frame(spark, "lang string, text string", ("en", None))).count() == 0


def test_a_task_sorts_its_phrases_in_half_the_room():
    packing, n = Packing(17), 200_000
    x = np.random.default_rng(3).integers(0, 60, n)
    halves = packing.pack(x, x[::-1], 0 * x)
    keys = packing.joined(*halves)
    assert keys.nbytes == 8 * n and Packing(22).joined(*Packing(22).pack(x, x, x)) is None
    tracemalloc.start()
    one = QuotientFilter.of_keys(packing.half, keys)
    room = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    two = QuotientFilter.of(packing.half, *halves)
    assert all((getattr(one, x) == getattr(two, x)).all() for x in ("left", "right", "counts"))
    assert room < 8 * n  # beside the keys, which are sorted in their place
