"""Toxicity by a subsequence string kernel (op 7).

The kernel of two strings is the sum over common subsequences of `ORDER` characters, each weighted by DECAY to the power of
the length it spans in either string, so inserted characters weaken a match instead of breaking it. Landmarks are word
beginnings and words picked greedily from labelled training sentences: each next one covers the most toxic documents,
covered ones counting half for each time, with forms that are ten times as frequent there as in clean ones. They end at `landmarks` or where the next
one adds less than LEAST_COVERED documents, a count and not a share, so that more labels bring rarer insults. A word's similarity to a landmark is
its kernel with it over the landmark's kernel with itself, and the Nyström matrix is that of landmarks scaled alike; it counts as 0 below FLOOR, and unless the word has all but two (three at least) of the landmark's neighbouring
character pairs, with at most two characters inserted in each. A sentence takes the highest similarity of its words to each landmark, mapped by the
Nyström matrix (inverse root of the landmarks' kernel). A linear support vector machine is trained on such sentences; a
text's margin is that of its worst sentence, and a logistic regression on other training documents makes it a probability.

Single characters in a row with any number of spaces, points, dashes or stars between them ("i d i o t", "i..d..i..o..t") are also read as one word. Words longer than 48 characters are read in
overlapping windows. The whole text counts. Fitted on at most `per_class` documents of each class; the logistic
regression counts each as the number of labels it stands for, so that the probability does not depend on the cap. With labels of one
class only, or none, every text gets the smoothed share of toxic labels. Null and empty texts have the margin of a
sentence without matches. Null ids and repeated rows each get a row. Empty table: no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .inputs import fold, map_texts, texts, worker_store
from .training import labelled_sample, logistic, sigmoid, squared_hinge

ORDER, DECAY = 3, 0.6
LONGEST, OVERLAP, GAPS, MISSING, FLOOR = 48, 16, 3, 2, 0.25
#: A landmark must add so many toxic documents, one covered already counting half for each time.
LEAST_COVERED = 1.5
#: Bound of the table of known words in one worker; it is emptied when full. Results do not depend on it.
REMEMBERED = 400_000

_SPACED = re.compile(r"(?<!\S)[^\s.\-_*](?:[ .\-_*]+[^\s.\-_*]){3,}(?!\S)")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")


def sentence_words(sentence: str) -> list[str]:
    """Words in lower case behind a mark of their beginning."""
    low = sentence.lower()
    words = low.split()
    words += [re.sub(r"[ .\-_*]", "", m) for m in _SPACED.findall(low)]
    return ["^" + w for w in words]


def windows(word: str) -> list[str]:
    return [word] if len(word) <= LONGEST else [word[i : i + LONGEST] for i in range(0, len(word) - OVERLAP, LONGEST - OVERLAP)]


def codes(words: list[str]) -> np.ndarray:
    """Characters as numbers, a row for each word, filled up with 0."""
    out = np.zeros((len(words), max(map(len, words), default=1)), np.int32)
    for k, w in enumerate(words):
        out[k, : len(w)] = np.frombuffer(w.encode("utf-32-le"), np.int32)
    return out


def kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The subsequence kernel of each row of `left` with the same row of `right` (codes, 0 fills up)."""
    n, a, b = left.shape[0], left.shape[1], right.shape[1]
    match = (left[:, :, None] == right[:, None, :]) & (left > 0)[:, :, None]
    inner = np.ones((n, a + 1, b + 1))
    for _ in range(ORDER - 1):
        following = np.zeros((n, a + 1, b + 1))
        for i in range(1, a + 1):
            row = np.zeros((n, b + 1))
            for j in range(1, b + 1):
                row[:, j] = DECAY * row[:, j - 1] + DECAY * DECAY * match[:, i - 1, j - 1] * inner[:, i - 1, j - 1]
            following[:, i] = DECAY * following[:, i - 1] + row
        inner = following
    return DECAY * DECAY * (match * inner[:, :-1, :-1]).sum(axis=(1, 2))


class Landmarks:
    """Similarities of words to landmark strings."""

    def __init__(self, strings: list[str]):
        self.codes = codes(strings)
        self.own = kernel(self.codes, self.codes)
        self.pairs: dict[tuple[int, int], int] = {}
        member = []
        for row in self.codes:
            own = {(x, y) for x, y in zip(row[:-1].tolist(), row[1:].tolist(), strict=True) if y}
            member.append([self.pairs.setdefault(p, len(self.pairs)) for p in own])
        self.member = np.zeros((len(self.pairs), len(strings)), np.float32)
        for k, own in enumerate(member):
            self.member[own, k] = 1
        self.least = np.maximum(self.member.sum(axis=0) - MISSING, 3)
        keys = np.array([x << 24 | y for x, y in self.pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.index = keys[order], order

    def similarities(self, words: list[str]) -> dict[str, np.ndarray]:
        """The row of every word that has a similarity above 0."""
        found: dict[str, np.ndarray] = {}
        parts = [(w, p) for w in words for p in windows(w)]
        for at in range(0, len(parts), 8192):
            some = parts[at : at + 8192]
            table = codes([p for _, p in some])
            have = np.zeros((len(some), len(self.pairs)), np.float32)
            for gap in range(1, GAPS + 1):
                pair = table[:, :-gap].astype(np.int64) << 24 | table[:, gap:]
                spot = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
                row, column = np.nonzero(self.keys[spot] == pair)
                have[row, self.index[spot[row, column]]] = 1
            row, mark = np.nonzero(have @ self.member >= self.least)
            length = (table > 0).sum(axis=1)
            order = np.argsort(length[row], kind="stable")
            row, mark = row[order], mark[order]
            for start in range(0, len(row), 4096):
                r, m = row[start : start + 4096], mark[start : start + 4096]
                values = kernel(table[r, : length[r[-1]]], self.codes[m]) / self.own[m]
                near = values >= FLOOR
                for i, k, v in zip(r[near].tolist(), m[near].tolist(), values[near].tolist(), strict=True):
                    word = some[i][0]
                    if word not in found:
                        found[word] = np.zeros(len(self.own))
                    found[word][k] = max(found[word][k], v)
        return found


def pick_landmarks(toxic: list[set[str]], clean: list[set[str]], most: int) -> list[str]:
    """Word beginnings of 4 to 8 characters and whole words, greedily by newly covered toxic documents."""

    def forms(words: set[str]) -> set[str]:
        plain = {w.strip(".,;:!?'\"()") for w in words}
        return {w[: n + 1] for w in plain for n in range(4, 9) if len(w) > n} | {w for w in plain if 5 <= len(w) <= 17}

    seen = Counter(f for words in toxic for f in forms(words))
    seen = Counter({f: n for f, n in seen.items() if n >= 2})
    against = Counter(f for words in clean for f in forms(words) if f in seen)
    good = {f for f, n in seen.items() if n / max(len(toxic), 1) >= 10 * (against[f] + 0.5) / max(len(clean), 1)}
    holds: dict[str, set[int]] = {f: set() for f in good}
    for k, words in enumerate(toxic):
        for f in forms(words) & good:
            holds[f].add(k)
    rate = {f: against[f] / max(len(clean), 1) for f in good}
    covered, chosen = np.zeros(len(toxic)), []
    at = {f: np.fromiter(ks, np.int64, len(ks)) for f, ks in holds.items()}
    while len(chosen) < most and at:
        # a document counts half as much each time it is covered; of forms that cover as much, the longest is the most particular
        best = max(at, key=lambda f: ((0.5 ** covered[at[f]]).sum() - 3 * rate[f] * len(toxic), len(f), f))
        if (0.5 ** covered[at[best]]).sum() < LEAST_COVERED:
            break
        chosen.append(best)
        covered[at[best]] += 1
        at = {f: x for f, x in at.items() if not f.startswith(best) and not best.startswith(f)}
    return chosen


@dataclass(frozen=True)
class Model:
    strings: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    slope: float
    intercept: float

    def margins(self, bodies: list[str]) -> list[float]:
        if not self.strings:
            return [0.0] * len(bodies)
        store = worker_store()
        if store.get("toxicity model") != self.strings:
            store |= {"toxicity model": self.strings, "landmarks": Landmarks(list(self.strings)), "known words": set(), "hot words": {}}
        known, hot = store["known words"], store["hot words"]
        if len(known) >= REMEMBERED:
            known.clear()
            hot.clear()
        split = [set(sentence_words(t)) for t in bodies]
        new = set().union(*split).difference(known)
        hot.update(store["landmarks"].similarities(sorted(new)))
        known |= new
        weights, out = np.array(self.weights), []
        for text, words in zip(bodies, split, strict=True):
            most = self.bias
            held = words & hot.keys()
            if len(held) == 1:  # its sentence has no other similarity
                most = max(most, float(hot[held.pop()] @ weights) + self.bias)
            elif held:
                for sentence in _SENTENCE.split(text):
                    rows = [hot[w] for w in sentence_words(sentence) if w in hot]
                    if rows:
                        most = max(most, float(np.max(rows, axis=0) @ weights) + self.bias)
            out.append(most)
        return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, held_out: int = 2, per_class: int = 2000, landmarks: int = 256) -> Model:
    """Fits on documents outside the held-out fold; half of the sample trains and the other half calibrates."""
    sample, stands_for = labelled_sample(docs, labels, label, folds, held_out, 2 * per_class)
    half = F.pmod(F.xxhash64("doc_id", "label"), F.lit(2))
    rows = sorted((r["half"], r["label"], r["doc_id"], r["text"]) for r in sample.select("doc_id", "label", "text", half.alias("half")).filter("half = 0").collect())
    sides = [[r[3] for r in rows if r[1] == k] for k in (0, 1)]
    counts = [len(side) * stands_for[k] for k, side in enumerate(sides)]
    share = (counts[1] + 1) / (sum(counts) + 2)
    constant = Model((), (), 0.0, 0.0, float(np.log(share / (1 - share))))
    if not all(sides):
        return constant
    bags = [[set(sentence_words(t)) for t in side] for side in sides]
    strings = pick_landmarks(bags[1], bags[0], landmarks)
    if not strings:
        return constant
    marks = Landmarks(strings)
    hot = marks.similarities(sorted(set().union(*bags[0], *bags[1])))
    features, target = [np.zeros(len(strings))], [0]
    for k, side in enumerate(sides):
        for text in side:
            own = [np.max(r, axis=0) for s in _SENTENCE.split(text) if (r := [hot[w] for w in sentence_words(s) if w in hot])]
            if k and own:  # a toxic document is known to have one toxic sentence at least
                own = [max(own, key=lambda x: (x.max(), x.sum()))]
            features += own
            target += [k] * len(own)
    among = kernel(np.repeat(marks.codes, len(strings), axis=0), np.tile(marks.codes, (len(strings), 1))).reshape(len(strings), -1)
    among = among / np.outer(marks.own, marks.own)  # landmarks are scaled as they are in similarities
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    nystrom = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    weights, bias = squared_hinge(np.array(features) @ nystrom, np.array(target))
    model = Model(tuple(strings), tuple((nystrom @ weights).tolist()), bias, 1.0, 0.0)

    def measure(ids: list, bodies: list[str]) -> dict:
        return {"doc_id": pa.array(ids, pa.int64()), "x": pa.array(model.margins(bodies), pa.float64())}

    other = sample.filter(half == 1).select(F.col("label").cast("long").alias("doc_id"), "text")
    pairs = np.array(sorted((r["doc_id"], r["x"]) for r in map_texts(other, measure, "doc_id long, x double").collect()), float).reshape(-1, 2)
    if len(set(pairs[:, 0])) < 2:
        return Model(model.strings, model.weights, bias, 2.0, 0.0)
    slope, intercept = logistic(pairs[:, 1:], pairs[:, 0], ridge=0.1, rows=stands_for[pairs[:, 0].astype(int)])
    return Model(model.strings, model.weights, bias, float(slope[0]), intercept)


def score(docs: DataFrame, model: Model, folds: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def run(ids: list, bodies: list[str]) -> dict:
        x = np.array(model.margins(bodies), float)
        return {"doc_id": pa.array(ids, pa.int64()), "score": pa.array(sigmoid(model.slope * x + model.intercept), pa.float64())}

    found = map_texts(texts(docs), run, "doc_id long, score double")
    return found.select(
        "doc_id",
        (fold("doc_id", folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
