"""Language ID by cross-parsing entropy.

A suffix automaton of each language's sample accepts exactly its substrings. A text is parsed
greedily into phrases, each the longest match with the sample; the language whose sample
needs the fewest phrases, normalised to bits a character as ``phrases * log2(sample) / length``, wins.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.functions import pandas_udf

from tidewater.llm.shared import fold, only, rest

UNKNOWN = "und"
#: The fit's bounds: documents of a language, characters taken from each, characters of a
#: language's sample, and of all samples together.
SAMPLE_DOCS, DOC_CHARS, SAMPLE_CHARS, ALL_CHARS = 64, 4_096, 20_000, 400_000
#: Letters with a symbol of their own; rarer ones share the remaining symbols.
OWN_LETTERS, SHARED_SYMBOLS = 100, 27
#: Characters that are parsed in step; no phrase crosses from one such window to the next.
WINDOW = 2_048


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 starts."""
    out: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for s in symbols:
        cur = len(out)
        out.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and s not in out[p]:
            out[p][s] = cur
            p = link[p]
        if p >= 0:
            q = out[p][s]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                copy = len(out)
                out.append(dict(out[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and out[p].get(s) == q:
                    out[p][s] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return out


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class Parser:
    """Cross-parses texts against the samples of all languages at once."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.langs = [lang for lang, _ in samples]
        self.symbol = np.where(_letters(), 1 + OWN_LETTERS + np.arange(0x110000) % SHARED_SYMBOLS, 0).astype(np.uint8)
        seen = Counter(c for _, text in samples for c in text.lower() if c.isalpha())
        for k, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:OWN_LETTERS]):
            self.symbol[ord(c)] = 1 + k
        coded = [self.code(text) for _, text in samples]
        used = np.unique(np.concatenate(coded)) if coded else np.zeros(0, np.uint8)
        # Symbols that no sample has become the last column, which never continues a phrase.
        dense = np.full(256, len(used), np.int64)
        dense[used] = np.arange(len(used))
        self.dense, self.width = dense, len(used) + 1
        self.bits = np.array([np.log2(len(c) + 1) for c in coded])
        tables, self.roots, base = [], [], 0
        for c in coded:
            states = suffix_automaton(dense[c].tolist())
            # A cell holds twice the next state, plus one where the phrase had to end first.
            start = np.full(self.width, 2 * (base + len(states)) + 1, np.int64)
            for s, to in states[0].items():
                start[s] = 2 * (base + to) + 1
            table = np.tile(start, (len(states) + 1, 1))
            for k, moves in enumerate(states):
                for s, to in moves.items():
                    table[k, s] = 2 * (base + to)
            tables.append(table)
            self.roots.append(base)
            base += len(states) + 1
        self.table = np.concatenate(tables).astype(np.int32).ravel() if tables else np.zeros(0, np.int32)

    def code(self, text: str | None) -> np.ndarray:
        """Symbols of the lower-cased text; a run of other characters than letters is one blank, none at the ends."""
        s = self.symbol[np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        if not len(s):
            return s
        kept = (s != 0) | np.append(True, s[:-1] != 0)
        s = s[kept]
        return s[int(s[0] == 0) : len(s) - int(s[-1] == 0 and len(s) > 1)]

    def phrases(self, coded: list[np.ndarray]) -> np.ndarray:
        """Phrases of every text (rows) under every language (columns)."""
        total = np.zeros((len(coded), len(self.langs)), np.int64)
        pieces = [(k, at) for k, c in enumerate(coded) for at in range(0, len(c), WINDOW)]
        pieces.sort(key=lambda p: p[1] - len(coded[p[0]]) if p[1] + WINDOW > len(coded[p[0]]) else -WINDOW)
        if not pieces:
            return total
        lengths = np.array([min(WINDOW, len(coded[k]) - at) for k, at in pieces])
        grid = np.zeros((lengths[0], len(pieces)), np.int32)
        for column, ((k, at), n) in enumerate(zip(pieces, lengths)):
            grid[:n, column] = self.dense[coded[k][at : at + n]]
        owner = np.array([k for k, _ in pieces])
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # windows longer than each step
        states = np.tile(np.array(self.roots, np.int32)[:, None], (1, len(pieces)))
        counts = np.zeros((len(self.langs), len(pieces)), np.int32)
        for step, n in enumerate(active.tolist()):
            at = states[:, :n] * np.int32(self.width)
            at += grid[step, :n]
            cell = self.table[at]
            if step:  # no phrase ends before the first symbol
                counts[:, :n] += cell & 1
            states[:, :n] = cell >> 1
        counts += 1  # the phrase that the end of the window closes
        np.add.at(total, owner, counts.T)
        return total

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        coded = [self.code(t) for t in texts]
        some = np.array([bool(c.any()) for c in coded], bool)
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if self.langs and some.any():
            rows = np.flatnonzero(some)
            lengths = np.array([len(coded[k]) for k in rows])
            bits = self.phrases([coded[k] for k in rows]) * self.bits / lengths[:, None]
            best = bits.argmin(axis=1)
            two = np.partition(bits, 1, axis=1)[:, :2] if len(self.langs) > 1 else None
            for i, k in enumerate(rows.tolist()):
                langs[k] = self.langs[best[i]]
                scores[k] = 1.0 if two is None else float(1 - two[i, 0] / two[i, 1])
        return langs, scores


@lru_cache(maxsize=1)
def _parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(samples)


def language_samples(docs: DataFrame) -> tuple[tuple[str, str], ...]:
    """A bounded sample of text for every language of the labelled ``doc_id, text, lang`` rows.

    The documents with the smallest hashes of (id, text) are taken; the bounds are the constants above.
    """
    docs = only(docs, doc_id="long", text="string", lang="string").where("lang is not null and text is not null")
    spot = F.xxhash64("doc_id", "text")
    picked = docs.select("lang", spot.alias("spot"), F.substring("text", 1, DOC_CHARS).alias("text"))
    picked = picked.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("spot", "text")))
    rows = picked.where(F.col("k") <= SAMPLE_DOCS).orderBy("lang", "k").collect()
    texts: dict[str, str] = {}
    for r in rows:
        texts[r["lang"]] = f"{texts[r['lang']]} {r['text']}" if r["lang"] in texts else r["text"]
    bound = min(SAMPLE_CHARS, ALL_CHARS // max(1, len(texts)))
    return tuple((lang, t[:bound]) for lang, t in sorted(texts.items()) if any(c.isalpha() for c in t[:bound]))


def language(samples: tuple[tuple[str, str], ...], text: str) -> Column:
    """Struct ``lang_pred, score`` of a text column; the samples go to the tasks, which build the automata."""

    @pandas_udf("lang_pred string, score double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        parser = _parser(samples)
        langs, scores = [], []
        for at in range(0, len(texts), 2_000):
            part = parser.judge(texts.iloc[at : at + 2_000].tolist())
            langs += part[0]
            scores += part[1]
        rest()
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    return judged(F.col(text))


def identify_languages(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Samples come from documents with a language whose id's CRC leaves another remainder than 2
    by 4; whole texts are judged, by nothing but their characters. The score is the share
    by which the best language undercuts the second, 1 with a single language.

    Cases: null texts, empty ones and those without a letter are ``und`` with score 0, as are all
    where no language could be learned; equal entropies go to the first language by code
    point; repeated rows give equal rows; a null id is neither learned from nor held
    out; an empty table gives no rows.
    """
    samples = language_samples(docs.where(fold("doc_id", 4) != 2))
    docs = only(docs, doc_id="long", text="string")
    judged = docs.select(
        "doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        language(samples, "text").alias("judged"),
    )
    return judged.select("doc_id", "held_out", "judged.lang_pred", "judged.score")
