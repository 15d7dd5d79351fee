"""A two-level n-gram trie in Elias-Fano code, memory-mapped; all operations work on arrays of queries.

Level 1 holds the contexts' ids and, for each, a pointer to its first successor; level 2 holds the successors' ids and their
quantised probabilities. Contexts, pointers and successors are monotone sequences: within a context the successors
ascend, and each context's successors are raised by the last value of the context before, so that the whole level ascends.
A successor is found by a search relative to that value, within the context's range.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np

_ONE = np.uint64(1)


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Positions of the k-th (from 0) ones; `before` counts the ones up to the end of each word."""
    word = np.searchsorted(before, k, side="right")
    rest = (k - np.where(word > 0, before[word - 1], 0)).astype(np.int64)
    value = words[word]
    at = np.zeros(len(k), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(value & ((_ONE << np.uint64(width)) - _ONE)).astype(np.int64)
        right = rest >= low
        rest -= np.where(right, low, 0)
        at += np.where(right, width, 0)
        value = np.where(right, value >> np.uint64(width), value)
    return word * 64 + at


class Monotone:
    """A non-decreasing sequence: the low bits of each value packed, the high parts as a bit vector in unary."""

    def __init__(self, upper: np.ndarray, low: np.ndarray, n: int, bits: int):
        self.upper, self.low, self.n, self.bits = upper, low, n, bits
        ones = np.bitwise_count(upper).astype(np.int64)
        self.ones, self.zeros = np.cumsum(ones), np.cumsum(64 - ones)
        self.window = np.ndarray((len(low) - 7,), "<u8", low.data, strides=(1,))

    @staticmethod
    def encode(values: np.ndarray) -> dict[str, np.ndarray]:
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (values >> bits) + np.arange(n)
        upper = np.zeros(((int(high[-1]) if n else 0) // 64 + 2) * 8, np.uint8)
        upper_bits = np.zeros(len(upper) * 8, np.uint8)
        upper_bits[high] = 1
        upper[:] = np.packbits(upper_bits, bitorder="little")
        if bits:
            low = np.packbits((values[:, None] >> np.arange(bits) & 1).astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.zeros(0, np.uint8)
        return {"upper": upper.view("<u8"), "low": np.concatenate([low, np.zeros(16, np.uint8)]), "shape": np.array([n, bits])}

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.int64)
        bit = i * self.bits
        read = self.window[bit >> 3] >> (bit & 7).astype(np.uint64)
        return (read & ((_ONE << np.uint64(self.bits)) - _ONE)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        return (_select(self.upper, self.ones, i) - i) << self.bits | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The index of the first value that is at least x; n if there is none."""
        out = np.full(len(x), self.n)
        if not self.n:
            return out
        last = int(self.access(np.array([self.n - 1]))[0])
        inside = np.flatnonzero(x <= last)
        high, low = x[inside] >> self.bits, x[inside] & ((1 << self.bits) - 1)
        # values whose high part is below h stand before the h-th zero of the bit vector
        begin = np.where(high > 0, _select(~self.upper, self.zeros, np.maximum(high - 1, 0)) - np.maximum(high - 1, 0), 0)
        until = _select(~self.upper, self.zeros, high) - high
        while len(open_ := np.flatnonzero(begin < until)):
            middle = (begin[open_] + until[open_]) >> 1
            less = self._low(middle) < low[open_]
            begin[open_] = np.where(less, middle + 1, begin[open_])
            until[open_] = np.where(less, until[open_], middle)
        out[inside] = begin
        return out


LEVELS = ("contexts", "pointers", "successors")


class Trie:
    """Quantised log10 probabilities of (context, successor), in files that are mapped and not read."""

    #: Probabilities are stored in steps of this part of a decade, in 16 bits: down to 10**-16, to 0.06 per cent.
    STEP = 16 / 65535

    def __init__(self, folder: str):
        load = lambda name: np.load(Path(folder) / f"{name}.npy", mmap_mode="r")
        for level in LEVELS:
            shape = load(f"{level}-shape")
            setattr(self, level, Monotone(load(f"{level}-upper"), load(f"{level}-low"), int(shape[0]), int(shape[1])))
        self.codes = load("codes")

    @classmethod
    def write(cls, folder: str, context: np.ndarray, successor: np.ndarray, probability: np.ndarray) -> None:
        """Writes the levels; rows are distinct and sorted by context, then successor."""
        begins = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
        lasts = np.append(begins[1:], len(context)) - 1
        raised = np.concatenate([[0], np.cumsum(successor[lasts] + 1)[:-1]]) if len(begins) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(begins, len(context)))
        levels = (context[begins], np.append(begins, len(context)), successor + 1 + np.repeat(raised, sizes))
        for level, values in zip(LEVELS, levels, strict=True):
            for name, data in Monotone.encode(values.astype(np.int64)).items():
                np.save(Path(folder) / f"{level}-{name}.npy", data)
        codes = np.rint(-np.log10(np.maximum(probability, 1e-16)) / cls.STEP)
        np.save(Path(folder) / "codes.npy", np.minimum(codes, 65534).astype(np.uint16))

    def codes_of(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """The stored code of each pair; 65535 where there is none."""
        out = np.full(len(context), 65535, np.uint16)
        if not self.contexts.n:
            return out
        at = self.contexts.find(context)
        known = np.flatnonzero(at < self.contexts.n)
        known = known[self.contexts.access(at[known]) == context[known]]
        at = at[known]
        begin, until = self.pointers.access(at), self.pointers.access(at + 1)
        raised = np.where(begin > 0, self.successors.access(np.maximum(begin - 1, 0)), 0)
        wanted = successor[known] + 1 + raised
        spot = self.successors.find(wanted)
        held = np.flatnonzero(spot < until)
        held = held[self.successors.access(spot[held]) == wanted[held]]
        out[known[held]] = self.codes[spot[held]]
        return out

    @classmethod
    def probability(cls, codes: np.ndarray) -> np.ndarray:
        return np.where(codes == 65535, 0.0, 10.0 ** (-codes.astype(float) * cls.STEP))
