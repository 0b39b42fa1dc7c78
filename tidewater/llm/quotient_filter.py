"""Counting quotient filters over permuted n-grams: lossless, compact, and merged like sorted lists.

An n-gram of word ids is packed into two halves of ``half`` bits and permuted by a Feistel network, which can be
undone. The permuted key's leading bits are its quotient, which a bitmap of occupied slots and one of the ends of
runs stand for; all its other bits are the remainder and are kept in full, so no two n-grams are
ever taken for one. Counts up to 255 take a byte, a count of one takes none, larger ones take nine.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from tidewater.llm.shared import mix64, runs

_U = np.uint64
ROUNDS, KEY = 4, 20_250_301
#: Bits of a word id so that a half fits 48 bits.
MOST_BITS = 32
_HEAD = struct.Struct("<QBBBIIII")


def _mask(bits: int) -> np.uint64:
    return _U((1 << bits) - 1)


@dataclass(frozen=True)
class Packing:
    """Up to three word ids of ``width`` bits, in two permuted halves."""

    width: int

    def __post_init__(self):
        if not 0 < self.width <= MOST_BITS:
            raise ValueError(f"word ids of {self.width} bits; at most {MOST_BITS} can be packed")

    @property
    def half(self) -> int:
        return (3 * self.width + 1) // 2

    def _turn(self, left: np.ndarray, right: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        mask = _mask(self.half)
        for r in range(ROUNDS)[:: -1 if back else 1]:
            salt = _U((KEY * 0x9E3779B97F4A7C15 + r) & 0xFFFFFFFFFFFFFFFF)
            if back:
                left, right = right ^ (mix64(left + salt) & mask), left
            else:
                left, right = right, left ^ (mix64(right + salt) & mask)
        return left, right

    def pack(self, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y, z = (v.astype(_U) for v in (x, y, z))
        upper = self.half - self.width  # bits of the middle id in the left half
        lower = self.width - upper
        left = x << _U(upper) | y >> _U(lower)
        return self._turn(left, (y & _mask(lower)) << _U(self.width) | z, False)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray | None:
        """Both halves as one piece of 64 bits, if they fit."""
        return left << _U(self.half) | right if 2 * self.half <= 64 else None

    def unpack(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        left, right = self._turn(left, right, True)
        upper = self.half - self.width
        lower = self.width - upper
        y = (left & _mask(upper)) << _U(lower) | right >> _U(self.width)
        return tuple(v.astype(np.int64) for v in (left >> _U(upper), y, right & _mask(self.width)))


def counted_keys(half: int, keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys of one piece in order, as halves, with how often they occur; the array given is sorted in its place."""
    keys.sort()
    starts, n = runs(keys)
    keys = keys[starts]
    return keys >> _U(half), keys & _mask(half), n


def counted(half: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with how often they occur or what their counts add up to."""
    if 2 * half <= 64:
        keys = left << _U(half) | right
        if counts is None:
            return counted_keys(half, keys)
        order = np.argsort(keys, kind="stable")  # finds the sorted stretches of merged filters
        starts, _ = runs(keys[order])
        n = np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]
        keys = keys[order][starts]
        return keys >> _U(half), keys & _mask(half), n
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    new = np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]))[: len(left)]
    starts = np.flatnonzero(new)
    if counts is None:
        n = np.diff(np.append(starts, len(left)))
    else:
        n = np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]
    return left[starts], right[starts], n


def _low_bytes(values: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def _from_low_bytes(data: bytes, n: int, rows: int) -> np.ndarray:
    out = np.zeros((rows, 8), np.uint8)
    if n:
        out[:, :n] = np.frombuffer(data, np.uint8).reshape(rows, n)
    return out.reshape(-1).view("<u8").astype(_U)


class QuotientFilter:
    """Sorted distinct keys that share their first ``prefix`` bits, and their counts."""

    def __init__(self, half: int, prefix: int, left: np.ndarray, right: np.ndarray, counts: np.ndarray):
        self.half, self.prefix = half, prefix
        self.left, self.right, self.counts = left, right, counts

    @classmethod
    def of(cls, half: int, left: np.ndarray, right: np.ndarray) -> "QuotientFilter":
        """A filter of the keys as they occur."""
        return cls(half, 0, *counted(half, left, right))

    @classmethod
    def of_keys(cls, half: int, keys: np.ndarray) -> "QuotientFilter":
        """A filter of keys of one piece as they occur, as ``Packing.joined`` makes them; the array is sorted in its place."""
        return cls(half, 0, *counted_keys(half, keys))

    @classmethod
    def merged(cls, filters: Sequence["QuotientFilter"]) -> "QuotientFilter":
        """One filter with the sums of all counts."""
        half, prefix = filters[0].half, filters[0].prefix
        parts = [np.concatenate([getattr(f, x) for f in filters]) for x in ("left", "right", "counts")]
        return cls(half, prefix, *counted(half, *parts))

    def __len__(self) -> int:
        return len(self.left)

    def split(self, prefix: int) -> list[tuple[int, "QuotientFilter"]]:
        """Filters by the first ``prefix`` bits of their keys, with these bits; empty ones are left out."""
        which = (self.left >> _U(self.half - prefix)).astype(np.int64)
        starts, n = runs(which)
        return [
            (int(which[a]), QuotientFilter(self.half, prefix, self.left[a : a + k], self.right[a : a + k], self.counts[a : a + k]))
            for a, k in zip(starts.tolist(), n.tolist())
        ]

    def to_bytes(self) -> bytes:
        """Slots, runs, remainders and counters; the prefix's own bits are not stored."""
        n, free = len(self), self.half - self.prefix
        # A sixteenth of a slot to eight slots for each key, so that what is left of the left half is whole bytes.
        rest = min(free, max(0, free - n.bit_length() + 4)) // 8
        q = free - 8 * rest
        slots = ((self.left & _mask(free)) >> _U(8 * rest)).astype(np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[slots] = True
        ends = np.append(slots[1:] != slots[:-1], True)[:n]
        many, over = self.counts > 1, self.counts > 255
        parts = [
            np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), np.packbits(many).tobytes(),
            np.minimum(self.counts[many], 256).astype(np.int64).__sub__(1).astype(np.uint8).tobytes(),
        ]
        large = self.counts[over].astype("<i8").tobytes()
        head = _HEAD.pack(n, self.half, self.prefix, rest, *map(len, parts))
        remainders = _low_bytes(self.left & _mask(8 * rest), rest) + _low_bytes(self.right, -(-self.half // 8))
        return head + b"".join(parts) + remainders + large

    @classmethod
    def from_bytes(cls, data: bytes, first_bits: int) -> "QuotientFilter":
        """The filter again; ``first_bits`` are the bits its keys share."""
        n, half, prefix, rest, *lengths = _HEAD.unpack_from(data)
        at, parts = _HEAD.size, []
        for size in (*lengths, n * rest, n * -(-half // 8)):
            parts.append(data[at : at + size])
            at += size
        free = half - prefix
        slots = np.flatnonzero(np.unpackbits(np.frombuffer(parts[0], np.uint8), count=1 << (free - 8 * rest)))
        ends = np.unpackbits(np.frombuffer(parts[1], np.uint8), count=n)
        slot = slots[np.cumsum(ends) - ends].astype(_U) if n else np.zeros(0, _U)
        left = _U(first_bits) << _U(free) | slot << _U(8 * rest) | _from_low_bytes(parts[4], rest, n)
        counts = np.ones(n, np.int64)
        many = np.flatnonzero(np.unpackbits(np.frombuffer(parts[2], np.uint8), count=n))
        counts[many] = np.frombuffer(parts[3], np.uint8).astype(np.int64) + 1
        counts[counts > 255] = np.frombuffer(data, "<i8", offset=at)
        return cls(half, prefix, left, _from_low_bytes(parts[5], -(-half // 8), n), counts)
