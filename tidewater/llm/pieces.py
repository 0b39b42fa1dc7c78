"""A SentencePiece vocabulary, and the lattice of its pieces over a text.

Works for both kinds of model: ``unigram``, whose encoding is the path of the best total score, and
``bpe``, whose encoding is the one path in which every two neighbours stay as they are when
their joint text is merged by itself. Both are paths of a max-plus recurrence: scores add for the
first, and for the second a pair of neighbours weighs 0 or minus infinity.
"""

from __future__ import annotations

import re
from itertools import accumulate, chain
from math import inf

import numpy as np

BLANK = "▁"
_UNITS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
#: A blank after another character.
_CUT = re.compile(f"(?<=[^{BLANK}]){BLANK}")
#: Units up to this length are merged pair by pair, longer ones go through the lattice.
SHORT_UNIT = 40
#: Encoded units, between batches, and pairs of pieces that a worker remembers before it starts anew; these bound memory only.
REMEMBERED, PAIRS = 200_000, 400_000
UNK_PENALTY = 10.0

Vocabulary = tuple[str, tuple[tuple[str, float, str], ...]]


def read_vocabulary(path: str, kind: str = "bpe") -> Vocabulary:
    """``kind`` and, in order of ids, ``(piece, score, role)`` of a model file; read on the driver, of fixed size."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)

    def role(i: int) -> str:
        if sp.is_byte(i):
            return "byte"
        if sp.is_unknown(i):
            return "unknown"
        return "other" if sp.is_control(i) or sp.is_unused(i) else "text"

    return kind, tuple((sp.id_to_piece(i), sp.get_score(i), role(i)) for i in range(sp.get_piece_size()))


def blanked(text: str | None) -> str:
    """The form that is encoded: a blank in front, and blanks for spaces."""
    return BLANK + text.replace(" ", BLANK) if text else ""


class _Units(dict):
    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        ids = np.array(self.encode(unit), np.int32).tobytes()
        if len(unit) <= SHORT_UNIT:
            self[unit] = ids
        return ids


class Pieces:
    """``library`` may be the public encoder of the same model; it then encodes many new units at once."""

    def __init__(self, vocabulary: Vocabulary, library=None):
        self.kind, rows = vocabulary
        self.library = library
        self.ids = {p: i for i, (p, _, role) in enumerate(rows) if role == "text"}
        self.score = {p: s for p, s, role in rows if role == "text"}
        self.longest = max(map(len, self.ids), default=1)
        byte = {p: i for i, (p, _, role) in enumerate(rows) if role == "byte"}
        self.byte_ids = [byte[f"<0x{b:02X}>"] for b in range(256)] if len(byte) == 256 else None
        self.unknown = next((i for i, (_, _, role) in enumerate(rows) if role == "unknown"), 0)
        self.unknown_score = min(self.score.values(), default=0.0) - UNK_PENALTY
        #: No piece reaches from a character that is no blank over a blank, so units can be cut there.
        self.cuts = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.ids)
        self.texts = [
            bytes([int(p[3:5], 16)]) if role == "byte" else p.encode() if role == "text" else b""
            for p, _, role in rows
        ]
        #: Whether two pieces stay as they are, by both ids in one number.
        self.pairs: dict[int, bool] = {}
        self.units = _Units(self.encode_unit)

    # ---- pieces and ids

    def id_list(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            if (i := self.ids.get(p)) is not None:
                out.append(i)
            else:
                out += [self.byte_ids[b] for b in p.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]
        return out

    def merged(self, text: str) -> list[str]:
        """Merge the adjacent pair of the best score, the leftmost of equals, until no pair is a piece."""
        parts, score = list(text), self.score.get
        scores = [score(a + b, -inf) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > -inf:
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], -inf)
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], -inf)
        return parts

    def _stay(self, left: str, right: str) -> bool:
        return self.merged(left + right) == ([left, right] if left else [right])

    def fits(self, left: str, right: str) -> bool:
        """Whether the joint text of two neighbours is merged to just them; single characters without a piece have no id."""
        a, b = self.ids.get(left, -1) if left else len(self.texts), self.ids.get(right, -1)
        if a < 0 or b < 0:
            return self._stay(left, right)
        pair = a << 32 | b
        if (found := self.pairs.get(pair)) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[pair] = self._stay(left, right)
        return found

    # ---- the lattice

    def paths(self, text: str, start: int, last: str, stop: int):
        """Best paths from ``start``, which the piece ``last`` led to, over the pieces of ``text``.

        Gives ``{position: (score, start of the last piece)}`` of the positions before ``stop``, and
        ``{(start, end): score}`` of the pieces that reach ``stop`` or beyond.
        """
        cells: dict[int, tuple[float, int]] = {start: (0.0, -1)}
        exits: dict[tuple[int, int], float] = {}
        bpe = self.kind == "bpe"
        for at in range(start, stop):
            if at not in cells:
                continue
            so_far, back = cells[at]
            before = (last if back < 0 else text[back:at]) if bpe else ""
            for end in range(at + 1, min(at + self.longest, len(text)) + 1):
                piece = text[at:end]
                score = self.score.get(piece)
                if score is None:
                    if end > at + 1:
                        continue
                    score = self.unknown_score
                if bpe:
                    if not self.fits(before, piece):
                        continue
                    score = 0.0
                if end >= stop:
                    exits[at, end] = so_far + score
                elif end not in cells or so_far + score > cells[end][0]:
                    cells[end] = (so_far + score, at)
        return cells, exits

    @staticmethod
    def trace(text: str, cells: dict[int, tuple[float, int]], at: int) -> list[str]:
        out = []
        while (back := cells[at][1]) >= 0:
            out.append(text[back:at])
            at = back
        return out[::-1]

    def encode_unit(self, unit: str) -> list[int]:
        if self.kind == "bpe" and len(unit) <= SHORT_UNIT:
            return self.id_list(self.merged(unit))
        return self.id_list(self.best(unit)[0])

    def best(self, unit: str) -> tuple[list[str], float]:
        cells, exits = self.paths(unit, 0, "", len(unit))
        (at, _), score = max(exits.items(), key=lambda e: e[1])
        return self.trace(unit, cells, at) + [unit[at:]], score

    def unit_score(self, unit: str) -> float:
        return 0.0 if self.kind == "bpe" else self.best(unit)[1]

    def encode(self, form: str) -> bytes:
        """Ids, as 32-bit integers, of a blanked text."""
        return self.encode_all([form])[0]

    def encode_all(self, forms: list[str]) -> list[bytes]:
        by_form = [_UNITS.findall(form) if self.cuts else [form] if form else [] for form in forms]
        if self.library is not None and self.cuts:
            met = {u for units in by_form for u in units}
            new = met.difference(self.units)
            if len(self.units) + len(new) > REMEMBERED:
                # What was known of these units goes too, so all are new.
                self.units.clear()
                new = met
            self._learn(new)
        elif len(self.units) > REMEMBERED:
            self.units.clear()
        return [b"".join(map(self.units.__getitem__, units)) for units in by_form]

    def _learn(self, units: set[str]) -> None:
        """Short units that begin with a blank, which the library puts in front of a text itself."""
        new = [u for u in units if u[0] == BLANK and 1 < len(u) <= SHORT_UNIT]
        # Their ids are packed end to end at once, and cut.
        ids = self.library.encode([u[1:].replace(BLANK, " ") for u in new], num_threads=1)
        packed = np.fromiter(chain.from_iterable(ids), np.int32).tobytes()
        ends = [4 * n for n in accumulate(map(len, ids))]
        self.units.update(zip(new, map(packed.__getitem__, map(slice, [0, *ends], ends))))

    def forget(self) -> None:
        """Give up the units and pairs remembered, which are met anew."""
        self.units.clear()
        self.pairs.clear()

    def decode(self, ids) -> str:
        joined = b"".join(map(self.texts.__getitem__, ids))
        text = joined.decode("utf-8", "replace").replace(BLANK, " ")
        return text[1:] if text.startswith(" ") else text

    # ---- chunks

    def states(self, text: str, at: int) -> list[tuple[int, int]]:
        """Pieces that begin before ``at`` and end there or later."""
        return [
            (s, e)
            for s in range(max(0, at - self.longest), at)
            for e in range(at, min(s + self.longest, len(text)) + 1)
            if text[s:e] in self.ids or e == s + 1
        ]

    def code(self, s: int, e: int, at: int) -> int:
        """A state by its distances from the boundary; a unigram path only needs to know where it is."""
        return (at - s) * 1024 + e - at if self.kind == "bpe" else e - at

    def _frame(self, text: str, a: int, b: int) -> tuple[int, int] | None:
        """First and last place in [a, b] where units can be cut."""
        if not self.cuts:
            return None
        low, high = max(a, 1), min(b, len(text) - 1)
        if (first := _CUT.search(text, low, high + 1)) is None:
            return None
        last = text.rfind(BLANK, low, high + 1)
        while text[last - 1] == BLANK:
            last = text.rfind(BLANK, low, last)
        return first.start(), last

    def _entries(self, text: str, a: int) -> dict[int, list[tuple[int, str]]]:
        """By code: where a path that comes in with this state goes on, and the piece it came with."""
        if a == 0:
            return {0: [(0, "")]}
        out: dict[int, list[tuple[int, str]]] = {}
        for s, e in self.states(text, a):
            found = out.setdefault(self.code(s, e, a), [])
            if not found:
                found.append((e, text[s:e]))
        return out

    def transfer(self, text: str, a: int, b: int) -> list[tuple[int, int, float]]:
        """The max-plus matrix of the chunk ``[a, b)``: best score from each state at ``a`` to each at ``b``.

        ``text`` also holds the characters around the chunk that pieces over its ends may cover. A piece
        counts for the chunk in which it begins. Only finite cells are given.
        """
        frame, out = self._frame(text, a, b), []

        def leave(exits, offset):
            best: dict[int, float] = {}
            for (s, e), score in exits.items():
                k = self.code(s, e, b)
                best[k] = max(best.get(k, -np.inf), offset + score)
            return best

        if frame is None:
            for entry, ((e, piece),) in self._entries(text, a).items():
                if e >= b:  # the piece covers the whole chunk
                    out.append((entry, self.code(e - len(piece), e, b) if piece else 0, 0.0))
                else:
                    out += [(entry, x, w) for x, w in leave(self.paths(text, e, piece, b)[1], 0.0).items()]
            return out
        u, v = frame
        middle = 0.0 if self.kind == "bpe" else sum(map(self.unit_score, _UNITS.findall(text[u:v])))
        tail = leave(self.paths(text, v, "", b)[1], middle) if v < b else None
        for entry, ((e, piece),) in self._entries(text, a).items():
            if e > u:
                continue
            if e == u:
                heads = {(u - len(piece), u): 0.0}
            else:
                heads = {k: w for k, w in self.paths(text[:u], e, piece, u)[1].items()}
            if not heads:
                continue
            score = max(heads.values())
            if tail is not None:
                out += [(entry, x, score + w) for x, w in tail.items()]
            elif u < v:  # the chunk ends at a cut, so with the last piece of the unit before it
                unit = _UNITS.findall(text[u:v])[-1]
                piece = self.best(unit)[0][-1]
                out.append((entry, self.code(b - len(piece), b, b), score + middle))
            else:  # u == v == b
                out += [(entry, x, w) for x, w in leave(heads, 0.0).items()]
        return out

    def backtrace(self, text: str, a: int, b: int, entry: int, leaving: int) -> list[int]:
        """Ids of the pieces that begin in the chunk, on the best path between two known states."""
        (e, piece), = self._entries(text, a)[entry]
        if e >= b:
            return []
        frame = self._frame(text, a, b)

        def end(text, cells, exits, stop):
            (s, e), _ = max(exits.items(), key=lambda x: x[1])
            return self.trace(text, cells, s) + [text[s:e]]

        def ending(cells, exits):
            return end(text, cells, {k: w for k, w in exits.items() if self.code(*k, b) == leaving}, b)

        if frame is None:
            return self.id_list(ending(*self.paths(text, e, piece, b)))
        u, v = frame
        ids: list[int] = []
        if e < u:
            cells, exits = self.paths(text[:u], e, piece, u)
            ids += self.id_list(end(text, cells, exits, u))
        ids += np.frombuffer(self.encode(text[u:v]), np.int32).tolist()
        if v < b:
            ids += self.id_list(ending(*self.paths(text, v, "", b)))
        return ids


Cells = dict[int, dict[int, float]]


def matrix(i, j, w) -> Cells:
    out: Cells = {}
    for a, b, x in zip(i, j, w):
        out.setdefault(int(a), {})[int(b)] = float(x)
    return out


def product(left: Cells, right: Cells) -> Cells:
    """Max-plus product; associative."""
    out: Cells = {}
    for a, row in left.items():
        best: dict[int, float] = {}
        for b, x in row.items():
            for c, y in right.get(b, {}).items():
                if x + y > best.get(c, -np.inf):
                    best[c] = x + y
        if best:
            out[a] = best
    return out


def route(parts: list[Cells], entry: int, leaving: int | None) -> list[int]:
    """States at all boundaries of a chain of matrices on its best path; the last may be free."""
    ahead: list[dict[int, tuple[float, int]]] = []
    front: dict[int, float] = {entry: 0.0}
    for part in parts:
        best: dict[int, tuple[float, int]] = {}
        for a, x in front.items():
            for b, y in part.get(a, {}).items():
                if b not in best or x + y > best[b][0]:
                    best[b] = (x + y, a)
        ahead.append(best)
        front = {b: x for b, (x, _) in best.items()}
    at = leaving if leaving is not None else max(sorted(front), key=front.get)
    out = [at]
    for best in reversed(ahead):
        at = best[at][1]
        out.append(at)
    return out[::-1]
