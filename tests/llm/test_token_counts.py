"""Token counts by splicing against the library itself."""

import json
import random

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.helpers import frame
from tidewater.llm.encoders import BYTE_BPE, FOLDER, PIECE_BPE, Json, Model, load, ship
from tidewater.llm.token_counts import spliced_parts, token_counts

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_tokens string, k1 string"


def docs(spark, *rows):
    return frame(spark, DOCS, *[(*r, "x", "y") for r in rows])


def counter(path):
    if path.endswith(".model"):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda t: len(library.encode(t))
    library = Tokenizer.from_file(path)
    return lambda t: len(library.encode(t, add_special_tokens=False))


def odd_texts():
    draw = random.Random(7)
    alphabet = ["a", "b", "é", "日", "😀", " ", "  ", "\n", "\t ", "'s", "'re", "'", "12", ".", "!?", "<|endoftext|>", "<|end", "▁", " ", "</s>"]
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(100, 400))) for _ in range(60)]
    texts += ["x" * 3_000, "a b " * 600, " " * 2_000, "\n" * 1_500 + "x", "日本" * 900, "we're'll've" * 200, "<|endoftext|>" * 90]
    return texts + ["word " * 50 + "z" * 700 + " tail" * 40, "q" * 260 + " end", "no-blank" * 300 + " " + "k" * 900]


@pytest.mark.parametrize("path", [BYTE_BPE, PIECE_BPE])
def test_spliced_counts_equal_the_library(spark, path):
    texts, count = odd_texts(), counter(path)
    rows = [*enumerate(texts), (900, None), (901, ""), (None, "a b"), (3, texts[3]), (902, texts[3])]
    got = token_counts(docs(spark, *rows).repartition(4), ship(spark, path), limit=300, chunk=60, overlap=24).collect()
    want = sorted((str(k), len((t or "").encode()), count(t or ""), count(t or "") > 300) for k, t in rows)
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == want


def test_parts_lie_end_to_end_and_widen_only_where_needed(spark):
    sent = ship(spark, BYTE_BPE)
    count = counter(BYTE_BPE)
    texts = {1: "plain words here " * 100, 2: "plain words " * 20 + "y" * 900 + " and more words" * 40}
    giants = frame(spark, "k1 long, k2 long, text string", *[(k, k, t) for k, t in texts.items()])
    parts = spliced_parts(giants, sent, chunk=100, overlap=24).orderBy("k1", "part").collect()
    for k, text in texts.items():
        own = [p for p in parts if p.k1 == k]
        assert own[0].start == 0 and own[-1].stop == len(text)
        assert all(a.stop == b.start for a, b in zip(own, own[1:]))
        assert [count(text[p.start : p.stop]) for p in own] == [p.n_tokens for p in own]
    assert max(p.stop - p.start for p in parts if p.k1 == 1) < 200
    assert max(p.stop - p.start for p in parts if p.k1 == 2) >= 900


def test_whole_table_and_other_vocabularies(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for path, chunk in ((BYTE_BPE, 2_000), (f"{FOLDER}/word_bpe_49k.json", 2_000)):
        sent, count = ship(spark, path), counter(path)
        got = token_counts(df, sent, chunk=chunk, overlap=64).collect()
        assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == {k: (len(t.encode()), count(t)) for k, t in texts.items()}
        assert len(got) == len(texts)
    assert load(sent).reach is None  # of that one no boundary is proven, so its texts are encoded whole
    assert token_counts(docs(spark), ship(spark, BYTE_BPE)).count() == 0


def test_begins_of_a_model_are_where_blanks_follow():
    with open(PIECE_BPE, "rb") as f:
        encoder = Model(f.read())
    at, before, n = encoder.begins("ab  cd é日 x", [])
    assert at == [2, 6, 9] and len(before) == 3 and n == len(encoder.library.encode("ab  cd é日 x"))


def test_the_fast_library_gives_the_same_ids_or_is_not_used():
    with open(BYTE_BPE, "rb") as f:
        data = f.read()
    encoder = Json(data)
    assert encoder.fast is not None
    for text in odd_texts():
        assert encoder.counts([text]) == [counter(BYTE_BPE)(text)]
        assert encoder.plain_ids([text])[0] == encoder.fast.encode_ordinary(text)
    about = json.loads(data)
    about["model"]["merges"][300], about["model"]["merges"][301] = about["model"]["merges"][301], about["model"]["merges"][300]
    assert Json(json.dumps(about).encode()).fast is None
