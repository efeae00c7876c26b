"""A counting quotient filter in numpy arrays.

A fingerprint of 64 bits is slice (the upper bits, the same for a whole filter), quotient and
remainder. The quotient numbers a home slot; the remainders of one quotient lie in a run of
neighbouring slots, ascending, at their home or as soon after it as earlier runs leave room. Three
bits a slot say where things are: ``occupied`` (some fingerprint has this quotient), ``run_end``
(the last slot of a run) and ``counter`` (the slot holds a digit of the count of the remainder
before it). The k-th occupied quotient owns the run of the k-th run end, so nothing else needs to
be stored, and all fingerprints can be read off again in order. A remainder seen once takes a
slot; one seen c times is followed by the digits of c-1. Slots are as many bytes as a
remainder needs; runs don't wrap around, slots past the last home take what is left over.
"""

from __future__ import annotations

import struct

import numpy as np

HEAD = struct.Struct("<BBq")
LOAD = 0.8


def _merged(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two ascending lists without repeats, walked together: keys and added counts."""
    if len(a) < len(b):
        a, n, b, m = b, m, a, n
    at = np.searchsorted(a, b)
    both = np.zeros(len(b), bool)
    inside = at < len(a)
    both[inside] = a[at[inside]] == b[inside]
    counts = n.copy()
    counts[at[both]] += m[both]
    return np.insert(a, at[~both], b[~both]), np.insert(counts, at[~both], m[~both])


class QuotientFilter:
    """Fingerprints that share their ``slice_bits`` upper bits, with counts."""

    def __init__(self, slice_bits: int, quotient_bits: int, top: int, occupied, run_end, counter, slots):
        self.slice_bits, self.quotient_bits, self.top = slice_bits, quotient_bits, top
        self.occupied, self.run_end, self.counter, self.slots = occupied, run_end, counter, slots

    @classmethod
    def build(cls, prints: np.ndarray, counts: np.ndarray | None = None, slice_bits: int = 0) -> QuotientFilter:
        """prints: unsigned 64-bit, of one slice, in any order; counts: how often each (1 if not given)."""
        prints, back = np.unique(prints, return_inverse=True)
        total = np.zeros(len(prints), np.int64)
        np.add.at(total, back, 1 if counts is None else counts)
        return cls._of(prints, total, slice_bits)

    @classmethod
    def _of(cls, prints: np.ndarray, counts: np.ndarray, slice_bits: int) -> QuotientFilter:
        """prints ascending, without repeats."""
        quotient_bits = min(max(3, int(np.ceil(np.log2(max(1, len(prints)) / LOAD)))), 56 - slice_bits)
        remainder_bits = 64 - slice_bits - quotient_bits
        width = -(-remainder_bits // 8)
        top = int(prints[0]) >> (64 - slice_bits) if len(prints) and slice_bits else 0
        remainders = prints & np.uint64((1 << remainder_bits) - 1)
        homes = ((prints >> np.uint64(remainder_bits)) & np.uint64((1 << quotient_bits) - 1)).astype(np.int64)
        digits, rest = np.zeros(len(prints), np.int64), (counts - 1).astype(np.uint64)
        while rest.any():
            digits += rest > 0
            rest = rest >> np.uint64(8 * width) if width < 8 else np.zeros_like(rest)
        taken = digits + 1
        before = np.cumsum(taken) - taken
        place = np.maximum.accumulate(homes - before) + before if len(prints) else homes
        size = max(1 << quotient_bits, int(place[-1] + taken[-1]) if len(prints) else 0)
        occupied = np.zeros(1 << quotient_bits, bool)
        occupied[homes] = True
        run_end, counter, slots = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, np.uint64)
        slots[place] = remainders
        last = np.r_[homes[1:] != homes[:-1], True] if len(prints) else np.zeros(0, bool)
        run_end[(place + digits)[last]] = True
        rest = (counts - 1).astype(np.uint64)
        for k in range(1, int(digits.max(initial=0)) + 1):
            some = digits >= k
            counter[place[some] + k] = True
            slots[place[some] + k] = rest[some] & np.uint64((1 << (8 * width)) - 1)
            rest = rest >> np.uint64(8 * width) if width < 8 else np.zeros_like(rest)
        return cls(slice_bits, quotient_bits, top, occupied, run_end, counter, slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].copy())

    @property
    def remainder_bits(self) -> int:
        return 64 - self.slice_bits - self.quotient_bits

    def _values(self, rows=slice(None)) -> np.ndarray:
        some = self.slots[rows]
        wide = np.zeros((len(some), 8), np.uint8)
        wide[:, : some.shape[1]] = some
        return wide.view("<u8")[:, 0]

    def _runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(quotient, first slot, slot after the last) of each run."""
        quotients, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end) + 1
        return quotients, np.maximum(quotients, np.r_[0, ends[:-1]] if len(ends) else ends), ends

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """All fingerprints ascending, and their counts."""
        quotients, starts, ends = self._runs()
        if not len(quotients):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        sizes = ends - starts
        used = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        values, digit = self._values(used), self.counter[used]
        first = np.flatnonzero(~digit)
        owner = np.repeat(quotients, sizes)[first].astype(np.uint64) << np.uint64(self.remainder_bits)
        prints = owner | values[first]
        if self.slice_bits:
            prints |= np.uint64(self.top << (64 - self.slice_bits))
        counts, taken = np.ones(len(first), np.int64), np.diff(first, append=len(used)) - 1
        for k in range(1, int(taken.max(initial=0)) + 1):
            some = taken >= k
            counts[some] += (values[first[some] + k] << np.uint64(8 * self.slots.shape[1] * (k - 1))).astype(np.int64)
        return prints, counts

    def count(self, fingerprint: int) -> int:
        """How often a fingerprint was added: one run is read."""
        home = (fingerprint >> self.remainder_bits) & ((1 << self.quotient_bits) - 1)
        if fingerprint >> (64 - self.slice_bits) != self.top or not self.occupied[home]:
            return 0
        quotients, starts, ends = self._runs()
        run = int(np.searchsorted(quotients, home))
        a, b = int(starts[run]), int(ends[run])
        values, digit = self._values(slice(a, b)).tolist(), self.counter[a:b].tolist()
        for k, value in enumerate(values):
            if not digit[k] and value == fingerprint & ((1 << self.remainder_bits) - 1):
                more = next((j for j in range(k + 1, len(digit)) if not digit[j]), len(digit))
                return 1 + sum(x << (8 * self.slots.shape[1] * j) for j, x in enumerate(values[k + 1 : more]))
        return 0

    def merge(self, other: QuotientFilter) -> QuotientFilter:
        """Lossless: both are read in order and walked together; counts of equal fingerprints add up."""
        if self.slice_bits != other.slice_bits:
            raise ValueError("filters of different slices")
        return QuotientFilter._of(*_merged(*self.items(), *other.items()), self.slice_bits)

    def dump(self) -> bytes:
        bits = (np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.counter))
        return HEAD.pack(self.slice_bits, self.quotient_bits, len(self.slots)) + struct.pack("<q", self.top) + b"".join(bits) + self.slots.tobytes()

    @classmethod
    def load(cls, data: bytes) -> QuotientFilter:
        slice_bits, quotient_bits, size = HEAD.unpack_from(data)
        (top,) = struct.unpack_from("<q", data, HEAD.size)
        at, parts = HEAD.size + 8, []
        for n in (1 << quotient_bits, size, size):
            parts.append(np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at), count=n).view(bool))
            at += -(-n // 8)
        width = -(-(64 - slice_bits - quotient_bits) // 8)
        return cls(slice_bits, quotient_bits, top, *parts, np.frombuffer(data, np.uint8, size * width, at).reshape(size, width))
