"""Public tokenizers as the tasks get them: the bytes of a vocabulary file, whose size the file fixes.

``.json`` files are read by the library ``tokenizers``, ``.model`` files by ``sentencepiece``.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
FOLDER = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = f"{FOLDER}/byte_bpe_50k.json", f"{FOLDER}/piece_bpe_32k.model"
BLANK = "▁"
#: Fixed value: the pattern of byte-level vocabularies, by which a text is cut into the stretches that are merged.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space between two characters that are none always begins a match of that pattern.
_SINGLE = re.compile(r"(?<=\S) (?=\S)")


class Shipped:
    """A vocabulary file sent to the tasks; told apart by its broadcast."""

    def __init__(self, data: Broadcast, kind: str, name: int):
        self.data, self.kind, self.name = data, kind, name

    def __hash__(self):
        return self.name

    def __eq__(self, other):
        return self.name == other.name


def ship(spark: SparkSession, path: str) -> Shipped:
    sent = spark.sparkContext.broadcast(Path(path).read_bytes())
    return Shipped(sent, Path(path).suffix, sent._jbroadcast.id())


@lru_cache(maxsize=4)
def load(sent: Shipped) -> "Json | Model":
    return (Json if sent.kind == ".json" else Model)(sent.data.value)


def byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself and the others, in order, from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Json:
    """A vocabulary of the library ``tokenizers``.

    With a byte-level vocabulary and its usual pattern, text is matched from left to right, each match seeing
    at most two characters beyond its end, and every match is merged by itself. So a place where two scans of
    overlapping texts both begin a match is one from which they agree, up to the end of the shorter.
    Special strings are found first; they are another ``reach`` characters that can be cut off.
    """

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(data)
        about = json.loads(data)
        pre, added = about.get("pre_tokenizer") or {}, about.get("added_tokens") or []
        proven = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not about.get("normalizer") and not about.get("post_processor")
            and not any(t[x] for t in added for x in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        #: Characters at the end of a cut text before which all is as in the whole text; none if that is not proven.
        self.reach = max((len(t["content"]) for t in added), default=0) + 4 if proven else None

        self.fast = self._same_merges(about) if proven else None

    def _same_merges(self, about: dict):
        """The same merges by the library ``tiktoken``, which is several times faster; none if they are not the same.

        Ids must follow the order of merges, and both must encode every 61st character alike in all surroundings.
        """
        import tiktoken

        sign, model = byte_of_sign(), about["model"]
        vocab, merges = model["vocab"], model["merges"]
        special = {t["content"]: t["id"] for t in about.get("added_tokens") or []}
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
        if any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return None
        if len(sign) + len(joined) != len(vocab) or any(vocab.get(t) != len(sign) + k for k, t in enumerate(joined)):
            return None
        ranks = {bytes(sign[c] for c in t): i for t, i in vocab.items()}
        fast = tiktoken.Encoding("own", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=special)
        probe = [f"a{chr(c)}a 1{chr(c)}1 !{chr(c)}! {chr(c)}  {chr(c)}x" for c in range(0, 0x110000, 61) if not 0xD800 <= c < 0xE000]
        same = [x.ids for x in self.library.encode_batch_fast(probe, add_special_tokens=False)] == [fast.encode_ordinary(t) for t in probe]
        return fast if same else None

    def counts(self, texts: list[str]) -> list[int]:
        if self.fast is not None:
            return [len(self.fast.encode(t, allowed_special="all")) for t in texts]
        return list(map(len, self.library.encode_batch_fast(texts, add_special_tokens=False)))

    def begins(self, text: str, zones: list[tuple[int, int]]) -> tuple[list[int], list[int], int]:
        """Places in the zones where matches begin, the number of tokens before each, and of all.

        Single spaces will do, if every zone has one; else the library tells all places.
        """
        by_zone = [[m.start() for m in _SINGLE.finditer(text, a, b)] for a, b in zones]
        if all(by_zone) and self.fast is not None:
            at = sorted({x for found in by_zone for x in found})
            counts = self.counts([text[a:b] for a, b in zip([0, *at], [*at, len(text)])])
            before = np.cumsum(counts).tolist()
            return at, before[:-1], before[-1]
        found = self.library.encode(text, add_special_tokens=False)
        ids, at = found.word_ids, found.offsets
        first = [k for k in range(len(ids)) if not k or ids[k] != ids[k - 1]]
        return [at[k][0] for k in first], first, len(ids)

    def plain_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids with special strings taken as ordinary text."""
        if self.fast is not None:
            return [self.fast.encode_ordinary(t) for t in texts]
        self.library.encode_special_tokens = True
        try:
            return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        finally:
            self.library.encode_special_tokens = False

    def token_bytes(self) -> list[bytes]:
        sign = byte_of_sign()
        out = [b""] * (max(self.library.get_vocab(True).values(), default=-1) + 1)
        for token, i in self.library.get_vocab(True).items():
            out[i] = bytes(sign[c] for c in token) if all(c in sign for c in token) else token.encode()
        return out


class Model:
    """A SentencePiece model.

    Where no piece holds a blank behind another character and the text is not normalised, every blank after a
    character that is none begins a piece, whatever the text before.
    """

    def __init__(self, data: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        pieces = map(self.library.id_to_piece, range(self.library.get_piece_size()))
        proven = not any(BLANK in p.lstrip(BLANK) for p in pieces) and self.library.normalize(" ﬁ  Å ") == "▁▁ﬁ▁▁Å▁"
        self.reach = 1 if proven else None

    def counts(self, texts: list[str]) -> list[int]:
        return list(map(len, self.library.encode(texts, num_threads=1)))

    def begins(self, text: str, zones: list[tuple[int, int]]) -> tuple[list[int], list[int], int]:
        """Places, in the zones or not, where a blank follows another character, the number of pieces before each, and of all."""
        pieces = self.library.encode(text, return_type="proto").pieces
        # The library gives places in bytes.
        place = np.cumsum(np.frombuffer(text.encode(), np.uint8) & 0xC0 != 0x80) - 1
        found = [
            (at, k) for k, p in enumerate(pieces) if 0 < p.begin < p.end
            for at in [int(place[p.begin])] if text[at] in f" {BLANK}" and text[at - 1] not in f" {BLANK}"
        ]
        return [at for at, _ in found], [k for _, k in found], len(pieces)

    def plain_ids(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)

    def token_bytes(self) -> list[bytes]:
        lib = self.library
        return [
            bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(map(lib.id_to_piece, range(lib.get_piece_size())))
        ]
