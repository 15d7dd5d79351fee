"""Matched letters of many text pairs at once: the longest common block, then the same left and right of it, for all pairs
of a batch together, as whole-array steps."""

from __future__ import annotations

from collections.abc import Callable


def block_scorer() -> Callable:
    """`score(a, b)`: the ratio of each pair of two lists of texts. Local functions, which travel to executors whole."""

    def matched(a: list[str], b: list[str]):
        """Letters in the common blocks of each pair; of equally long blocks the first in `a`, then in `b`, is taken."""
        import numpy as np

        def codes(texts: list[str]):
            width = max(1, *map(len, texts))
            return np.array(texts, f"<U{width}").view(np.uint32).reshape(len(texts), width)

        left, right = codes(a), codes(b)
        total = np.zeros(len(a), np.int64)
        pair, from_a, from_b = (np.arange(len(a)), *(np.zeros(len(a), np.int64) for _ in range(2)))
        to_a, to_b = np.array(list(map(len, a))), np.array(list(map(len, b)))
        column = np.arange(right.shape[1])
        while len(pair):
            open_b = (column >= from_b[:, None]) & (column < to_b[:, None])
            here = right[pair]
            # run[p, j + 1]: letters up to a's current one and b's j that agree
            run = np.zeros((len(pair), right.shape[1] + 1), np.int32)
            size, end_a, end_b = (np.zeros(len(pair), np.int64) for _ in range(3))
            rows = np.arange(len(pair))
            for step in range(int((to_a - from_a).max())):
                at = from_a + step
                letter = left[pair, np.minimum(at, left.shape[1] - 1)]
                same = (here == letter[:, None]) & open_b & (at < to_a)[:, None]
                run[:, 1:] = np.where(same, run[:, :-1] + 1, 0)
                first = run[:, 1:].argmax(axis=1)
                longest = run[rows, first + 1]
                better = longest > size
                size, end_a, end_b = (np.where(better, x, y) for x, y in ((longest, size), (at + 1, end_a), (first + 1, end_b)))
            np.add.at(total, pair, size)
            found = size > 0
            before = found & (end_a - size > from_a) & (end_b - size > from_b)
            after = found & (end_a < to_a) & (end_b < to_b)
            pair, from_a, to_a, from_b, to_b = (
                np.concatenate([x[before], y[after]])
                for x, y in ((pair, pair), (from_a, end_a), (end_a - size, to_a), (from_b, end_b), (end_b - size, to_b))
            )
        return total

    def score(a: list[str], b: list[str], at_once: int = 2048):
        import difflib

        import numpy as np

        out = np.ones(len(a))
        # texts of 200 letters and more leave frequent letters out of the search: one by one, as the definition has it
        long = [i for i, y in enumerate(b) if len(y) >= 200]
        for i in long:
            out[i] = difflib.SequenceMatcher(None, a[i], b[i]).ratio()
        some = [i for i, (x, y) in enumerate(zip(a, b, strict=True)) if len(y) < 200 and x != y]
        some.sort(key=lambda i: (len(b[i]), len(a[i])))  # pairs of like lengths together
        for at in range(0, len(some), at_once):
            part = some[at : at + at_once]
            left, right = [a[i] for i in part], [b[i] for i in part]
            letters = np.array([len(x) + len(y) for x, y in zip(left, right, strict=True)])
            out[part] = 2.0 * matched(left, right) / letters
        return out

    return score
