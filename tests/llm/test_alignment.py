"""Alignment of two tokenizers against a plain loop over byte offsets."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.helpers import frame
from tidewater.llm import alignment
from tidewater.llm.alignment import align_tokens
from tidewater.llm.encoders import BYTE_BPE, PIECE_BPE, byte_of_sign, load, ship

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(rows):
    a_lib = Tokenizer.from_file(BYTE_BPE)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    sign = byte_of_sign()

    def a_tokens(text):
        e = a_lib.encode(" " + text, add_special_tokens=False)
        return [(i, bytes(sign[c] for c in t)) for i, t in zip(e.ids, e.tokens)]

    def b_tokens(text):
        out = []
        for i in b_lib.encode(text):
            p = b_lib.id_to_piece(i)
            out.append((i, bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()))
        return out

    def ends(tokens):
        at, out = 0, []
        for i, t in tokens:
            at += len(t)
            out.append((at, i))
        return out

    made = []
    for doc_id, text in rows:
        a, b = (a_tokens(text), b_tokens(text)) if text else ([], [])
        if any(b"".join(t for _, t in x) != b" " + (text or "").encode() for x in (a, b)):
            a, b = [], []
        a, b = ends(a), ends(b)
        shared = sorted({e for e, _ in a} & {e for e, _ in b})
        links = [(i, j) for e, i in a for f, j in b if e == f] if len(a) < 500 else [
            (i, dict(b)[e]) for d in [dict(b)] for e, i in a if e in d]
        groups, low = [], 0
        for high in shared:
            sides = [",".join(str(i) for e, i in x if low < e <= high) for x in (a, b)] if len(a) < 500 else None
            groups.append(sides)
            low = high
        made.append((doc_id, a, b, shared, links, groups))
    counts = Counter(pair for m in made for pair in m[4])
    most = defaultdict(int)
    for (_, j), c in counts.items():
        most[j] = max(most[j], c)
    for doc_id, a, b, shared, links, groups in made:
        digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if a and len(a) < 500 else "" if not a else None
        yield doc_id, len(a), len(b), len(shared), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest


def odd_rows():
    draw = random.Random(5)
    alphabet = ["a", "in", "the", "é", "日本", "😀", " ", "  ", "\n", "\t", "'s", "123", "<|endoftext|>", "<s>", "<0x41>", "."]
    rows = [(k, "".join(draw.choice(alphabet) for _ in range(draw.randint(1, 120)))) for k in range(60)]
    return rows + [(100, None), (101, ""), (102, "has a ▁ sign"), (106, "of ▁▁ and on"), (107, "a " * 40 + "▁b"), (103, "\x00 nul"), (None, "x y"), (3, rows[3][1]), (104, " lead"), (105, " ")]


@pytest.mark.parametrize("head", [1 << 17, 20, 0])
def test_rows_equal_brute_force(spark, head):
    rows = odd_rows()
    df = frame(spark, "doc_id long, text string, row string, pair string", *[(*r, "x", "y") for r in rows]).repartition(3)
    got = [tuple(r[c] for c in COLUMNS) for r in align_tokens(df, ship(spark, BYTE_BPE), ship(spark, PIECE_BPE), head).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    assert any(r[1] == 0 for r in got) and any(r[5] < r[4] for r in got)


def test_whole_table_and_empty_table(spark, monkeypatch):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    a, b = ship(spark, BYTE_BPE), ship(spark, PIECE_BPE)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align_tokens(df, a, b).collect()}
    want = {r[0]: r for r in brute(rows)}
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert got[k][:-1] == r[:-1] and r[-1] in (None, got[k][-1])
    empty = align_tokens(df.limit(0), a, b)
    assert empty.count() == 0 and tuple(empty.columns) == COLUMNS
    # A small memory forgets windows and changes nothing.
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    aligner = alignment.Aligner(load(a), load(b))
    text = rows[0][1]
    encoded = list(aligner.encode([text, "", text, "x"]))
    (groups, links), none, again, _ = aligner.align(encoded)
    assert len(links) == want[rows[0][0]][4] and hashlib.sha256(groups).hexdigest() == got[rows[0][0]][-1]
    assert groups.count(b";") + 1 == want[rows[0][0]][3] and len(aligner.windows) <= 5
    assert none[0] == b"" and not len(none[1]) and again[0] == groups and (again[1] == links).all()
    # Windows whose hashes meet are told apart.
    monkeypatch.setattr(alignment, "_window_hash", lambda ids, starts, salt: (ids[starts] if salt > 2 else 0 * starts).astype(np.uint64))
    assert aligner.align(encoded)[0][0] == groups
    assert aligner.align(list(aligner.encode([""]))) [0][0] == b""


def test_new_windows_of_many_texts_are_aligned_at_once(spark, monkeypatch):
    aligner = alignment.Aligner(load(ship(spark, BYTE_BPE)), load(ship(spark, PIECE_BPE)))
    texts = [f"word{k} the of unheard{k}of é{k}" for k in range(50)]
    calls, real = [], alignment.Windows._aligned
    monkeypatch.setattr(alignment.Windows, "_aligned", lambda self, keys: calls.append(len(keys)) or real(self, keys))
    encoded = list(aligner.encode(texts))
    together = aligner.align(encoded)
    assert len(calls) == 1 and calls[0] > 100
    aligner.windows.clear()
    for one, (groups, links) in zip(encoded, together):
        assert aligner.align([one])[0][0] == groups and (aligner.align([one])[0][1] == links).all()
    # A window whose sides spell different bytes has no groups; those beside it keep theirs.
    keys = [(a.tobytes(), b.tobytes()) for a, b in encoded[:2]]
    ((first, _), (none, links), (last, _)) = aligner.windows.look_up([keys[0], (keys[0][0], keys[1][1]), keys[1]])
    assert (first, last) == (together[0][0], together[1][0]) and none == links == b""
