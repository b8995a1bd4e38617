"""A counting quotient filter over 64-bit fingerprints that merges without loss.

A fingerprint's high bits, the quotient, name its home slot; the other bits, the remainder, are
what a slot holds, packed to just so many bits. Remainders of one quotient are a run of
slots in rising order, at home or as close behind it as earlier runs leave room. Two bits a
slot tell runs apart: which quotients have one (``occupied``) and where each ends
(``runends``). Counts are in the slots too: a remainder twice stands for two, and a larger
count is a number in digits between two copies of it, which begins lower than the remainder
and so cannot be taken for further ones.

Quotient and remainder together are the whole fingerprint, so nothing is lost, and reading a
filter from the first slot to the last gives fingerprints in order: two filters merge in one
pass over both, whatever their sizes, into the filter of all their input.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

BITS = 64
#: Bits of a remainder, at least, so that counts take few digits.
LEAST_REMAINDER = 8
_HEAD = "<BQ"


def _digits(number: int, base: int) -> list[int]:
    out = [number % base]
    while number >= base:
        number //= base
        out.append(number % base)
    return out[::-1]


def _counter(remainder: int, count: int, bits: int) -> list[int]:
    """The slots of a remainder that is counted more than once."""
    if count == 2:
        return [remainder] * 2
    if remainder == 0:
        if count == 3:
            return [0] * 3
        return [0, *(d + 1 for d in _digits(count - 4, (1 << bits) - 1)), 0, 0]
    # Neither 0 nor the remainder is a digit.
    digits = [d + 1 + (d + 1 >= remainder) for d in _digits(count - 3, (1 << bits) - 2)]
    return [remainder, *([0] if digits[0] >= remainder else []), *digits, remainder]


def _number(digits: list[int], base: int, skipped: int) -> int:
    number = 0
    for d in digits:
        number = number * base + d - 1 - (0 < skipped < d)
    return number


def _read_run(slots: list[int], bits: int) -> list[tuple[int, int]]:
    """Remainders and counts of a run that has counters."""
    out, i, n = [], 0, len(slots)
    while i < n:
        x = slots[i]
        if x == 0:
            pair = next((k for k in range(i + 1, n - 1) if slots[k] == slots[k + 1] == 0), None)
            if slots[i : i + 3] == [0] * 3:
                out.append((0, 3))
                i += 3
            elif slots[i : i + 2] == [0, 0]:
                out.append((0, 2))
                i += 2
            elif pair is not None:
                out.append((0, 4 + _number(slots[i + 1 : pair], (1 << bits) - 1, 0)))
                i = pair + 2
            else:
                out.append((0, 1))
                i += 1
        elif i + 1 < n and slots[i + 1] == x:
            out.append((x, 2))
            i += 2
        elif i + 1 < n and slots[i + 1] < x:
            end = slots.index(x, i + 1)
            digits = slots[i + 1 + (slots[i + 1] == 0) : end]
            out.append((x, 3 + _number(digits, (1 << bits) - 2, x)))
            i = end + 1
        else:
            out.append((x, 1))
            i += 1
    return out


def _pack(values: np.ndarray, bits: int) -> bytes:
    """Values of so many bits each, without gaps."""
    rows = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, BITS - bits :]
    return np.packbits(rows).tobytes()


def _unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    rows = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    whole = np.zeros((n, BITS), dtype=np.uint8)
    whole[:, BITS - bits :] = rows
    return np.packbits(whole, axis=1).view(">u8").reshape(-1).astype(np.uint64)


class CountingQuotientFilter:
    """Fingerprints with their counts in slots; see the module."""

    def __init__(self, quotient_bits: int, occupied: np.ndarray, runends: np.ndarray, slots: np.ndarray) -> None:
        self.quotient_bits = quotient_bits
        self.occupied = occupied
        self.runends = runends
        self.slots = slots
        self._read: tuple[np.ndarray, np.ndarray] | None = None

    @property
    def remainder_bits(self) -> int:
        return BITS - self.quotient_bits

    @classmethod
    def build(
        cls, fingerprints: np.ndarray, quotient_bits: int | None = None, counts: np.ndarray | None = None
    ) -> CountingQuotientFilter:
        """A filter of fingerprints in any order; without ``quotient_bits`` of a size by its entries."""
        keys, place = np.unique(fingerprints.astype(np.uint64), return_inverse=True)
        if counts is None:
            total = np.bincount(place, minlength=len(keys)).astype(np.int64)
        else:
            total = np.zeros(len(keys), dtype=np.int64)
            np.add.at(total, place, counts)
        return cls._of_sorted(keys, total, quotient_bits)

    @classmethod
    def _of_sorted(cls, keys: np.ndarray, counts: np.ndarray, bits: int | None = None) -> CountingQuotientFilter:
        if bits is None:
            # Counters mostly take two or three slots.
            wanted = len(keys) + 2 * int((counts > 1).sum())
            bits = min(BITS - LEAST_REMAINDER, max(0, (wanted - 1).bit_length()))
        rest = BITS - bits
        quotients = (keys >> np.uint64(rest)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        remainders = keys & np.uint64((1 << rest) - 1) if bits else keys
        many = np.flatnonzero(counts > 1)
        written = {int(i): _counter(int(remainders[i]), int(counts[i]), rest) for i in many}
        sizes = np.ones(len(keys), dtype=np.int64)
        sizes[many] = [len(written[int(i)]) for i in many]
        values = np.repeat(remainders, sizes)
        begins = np.cumsum(sizes) - sizes
        for i, digits in written.items():
            values[begins[i] : begins[i] + len(digits)] = np.array(digits, dtype=np.uint64)
        names, first = np.unique(quotients, return_index=True)
        lengths = np.add.reduceat(sizes, first) if len(names) else np.empty(0, np.int64)
        return cls._placed(bits, names, lengths, values)

    @classmethod
    def _placed(cls, bits: int, names: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> CountingQuotientFilter:
        """A filter of the runs of these quotients, their slots one behind the other in ``values``."""
        # A run starts at home or right behind the run before it.
        packed = np.cumsum(lengths) - lengths
        starts = packed + np.maximum.accumulate(names - packed) if len(names) else packed
        n = max(1 << bits, int(starts[-1] + lengths[-1]) if len(names) else 0)
        occupied, runends = np.zeros(1 << bits, dtype=bool), np.zeros(n, dtype=bool)
        slots = np.zeros(n, dtype=np.uint64)
        occupied[names] = True
        runends[starts + lengths - 1] = True
        slots[np.repeat(starts - packed, lengths) + np.arange(len(values))] = values
        return cls(bits, occupied, runends, slots)

    def _runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Quotient, first slot and slot behind the last one of each run."""
        names, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.runends) + 1
        return names, np.maximum(names, np.append(0, ends[:-1])[: len(ends)]), ends

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints in rising order and their counts."""
        if self._read is not None:
            return self._read
        names, starts, ends = self._runs()
        lengths = ends - starts
        run = np.repeat(np.arange(len(names)), lengths)
        place = np.arange(len(run)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
        values = self.slots[place]
        # A run without counters rises throughout.
        same = run[1:] == run[:-1]
        counted = np.zeros(len(names), dtype=bool)
        counted[run[1:][same & (values[1:] <= values[:-1])]] = True
        plain = ~counted[run]
        keys, counts = [values[plain]], [np.ones(int(plain.sum()), np.int64)]
        owners = [run[plain]]
        for r in np.flatnonzero(counted).tolist():
            read = _read_run(self.slots[starts[r] : ends[r]].tolist(), self.remainder_bits)
            keys.append(np.array([x for x, _ in read], dtype=np.uint64))
            counts.append(np.array([c for _, c in read], dtype=np.int64))
            owners.append(np.full(len(read), r))
        key, count, owner = np.concatenate(keys), np.concatenate(counts), np.concatenate(owners).astype(np.int64)
        order = np.argsort(owner, kind="stable")
        key, count = key[order], count[order]
        if self.quotient_bits:
            key = key | (names[owner[order]].astype(np.uint64) << np.uint64(self.remainder_bits))
        self._read = key, count
        return self._read

    def fingerprints(self) -> np.ndarray:
        return self.entries()[0]

    @property
    def counts(self) -> np.ndarray:
        return self.entries()[1]

    @property
    def remainders(self) -> np.ndarray:
        """The remainders of all runs, each once, run by run."""
        if not self.quotient_bits:
            return self.fingerprints()
        return self.fingerprints() & np.uint64((1 << self.remainder_bits) - 1)

    @property
    def runs(self) -> np.ndarray:
        """How many different remainders each quotient has."""
        keys = self.fingerprints()
        quotients = (keys >> np.uint64(self.remainder_bits)).astype(np.int64) if self.quotient_bits else np.zeros(len(keys), np.int64)
        return np.bincount(quotients, minlength=1 << self.quotient_bits)

    def merge(self, *others: CountingQuotientFilter) -> CountingQuotientFilter:
        """The filter of all inputs, two at a time: their entries are in order already."""
        parts = [self, *others]
        while len(parts) > 1:
            parts = [a._merged(b) for a, b in zip(parts[0::2], parts[1::2])] + parts[len(parts) // 2 * 2 :]
        return parts[0]

    def _merged(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        (a, a_counts), (b, b_counts) = self.entries(), other.entries()
        keys = np.empty(len(a) + len(b), dtype=np.uint64)
        counts = np.empty(len(keys), dtype=np.int64)
        # Each entry goes behind the smaller ones of the other filter; equal ones become neighbours.
        for own, own_counts, there, side in ((a, a_counts, b, "left"), (b, b_counts, a, "right")):
            at = np.arange(len(own)) + np.searchsorted(there, own, side=side)
            keys[at], counts[at] = own, own_counts
        first = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
        sums = np.add.reduceat(counts, np.flatnonzero(first)) if len(keys) else counts
        return self._of_sorted(keys[first], sums)

    def count(self, fingerprint: int) -> int:
        """How often a fingerprint was put in: its run is found by rank and select."""
        quotient = int(fingerprint) >> self.remainder_bits
        rest = int(fingerprint) & ((1 << self.remainder_bits) - 1)
        if not len(self.occupied) or not self.occupied[quotient]:
            return 0
        rank = int(np.count_nonzero(self.occupied[: quotient + 1]))
        ends = np.flatnonzero(self.runends)
        start = max(quotient, int(ends[rank - 2]) + 1 if rank > 1 else 0)
        run = _read_run(self.slots[start : int(ends[rank - 1]) + 1].tolist(), self.remainder_bits)
        return dict(run).get(rest, 0)

    def repeated(self) -> np.ndarray:
        """The fingerprints counted more than once."""
        keys, counts = self.entries()
        return keys[counts > 1]

    def to_bytes(self) -> bytes:
        """Without the empty slots: where runs stand follows from their lengths."""
        _, starts, ends = self._runs()
        lengths = ends - starts
        packed = np.cumsum(lengths) - lengths
        used = np.arange(int(lengths.sum())) + np.repeat(starts - packed, lengths)
        flags = np.packbits(self.occupied).tobytes() + np.packbits(self.runends[used]).tobytes()
        return struct.pack(_HEAD, self.quotient_bits, len(used)) + flags + _pack(self.slots[used], self.remainder_bits)

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        bits, n = struct.unpack_from(_HEAD, data)
        at = struct.calcsize(_HEAD)
        flags = []
        for size in (1 << bits, n):
            length = -(-size // 8)
            flags.append(np.unpackbits(np.frombuffer(data, np.uint8, length, at), count=size))
            at += length
        ends = np.flatnonzero(flags[1]) + 1
        lengths = np.diff(ends, prepend=0)
        return cls._placed(bits, np.flatnonzero(flags[0]), lengths, _unpack(data[at:], BITS - bits, n))

    @classmethod
    def merge_all(cls, blocks: Iterable[bytes]) -> CountingQuotientFilter:
        """Merge serialised filters like a counter counts: two of a level become one of the next."""
        levels: dict[int, CountingQuotientFilter] = {}
        for block in blocks:
            one, level = cls.from_bytes(block), 0
            while level in levels:
                one, level = levels.pop(level)._merged(one), level + 1
            levels[level] = one
        if not levels:
            raise ValueError("nothing to merge")
        first, *others = levels.values()
        return first.merge(*others)
