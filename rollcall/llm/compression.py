"""Quality by compression with class dictionaries (op 4).

One zstandard dictionary is trained on blocks of good and one on blocks of bad labelled texts. A text is cut into blocks;
each is compressed with both, and the difference of the two sizes (bad minus good) is taken per byte and per root of the
bytes: the second tells how sure the first is. Blocks keep them alike for short and long texts, where a text would else
become its own dictionary. A logistic regression on other labelled texts turns both, with the logarithm of the length,
into a probability. The whole text counts.

The dictionaries are fitted on at most `per_class` documents of a class, eight blocks of each, and calibrated on as many
others, each counted as the number of labels it stands for, so that scores do not depend on the cap. With labels of one class only, or none, every text gets the smoothed share of good labels.
Null and empty texts count as one byte without a difference. Null ids and repeated rows each get a row. Empty table: no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .inputs import fold, map_texts, texts, worker_store
from .training import labelled_sample, logistic, sigmoid

BLOCK, DICTIONARY, LEVEL = 512, 32_768, 3


def blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def compressor(data: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(data)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)


@dataclass(frozen=True)
class Model:
    good: bytes | None
    bad: bytes | None
    weights: tuple[float, float, float]
    intercept: float

    def features(self, text: str) -> tuple[float, float, float]:
        """The difference per byte and per root of the bytes, and the logarithm of the bytes."""
        store = worker_store()
        if store.get("compression model") is not self.good:
            store["compression model"] = self.good
            store["compressors"] = (compressor(self.good), compressor(self.bad))
        good, bad = (c.compress for c in store["compressors"])
        data = text.encode()
        difference, size = sum([len(bad(b)) - len(good(b)) for b in blocks(data)]), max(1, len(data))
        return difference / size, difference / size**0.5, math.log(size)

    def score(self, text: str) -> float:
        x = self.features(text) if self.good is not None else (0.0, 0.0, 0.0)
        return float(sigmoid(np.float64(sum(w * f for w, f in zip(self.weights, x, strict=True)) + self.intercept)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0, per_class: int = 2000) -> Model:
    """Fits on documents outside the held-out fold; half of the sample, by hash, trains and the other half calibrates."""
    sample, stands_for = labelled_sample(docs, labels, label, folds, held_out, 2 * per_class)
    half = sample.withColumn("half", F.pmod(F.xxhash64("doc_id", "label"), F.lit(2)))

    def cut(ids: list, bodies: list[str]) -> dict:
        found = []
        for text in bodies:
            own = [b for b in blocks(text.encode()) if len(b) >= 32]
            found.append([own[i] for i in sorted({int(k) for k in np.linspace(0, len(own) - 1, 8)})] if own else [])
        return {"doc_id": pa.array(ids, pa.int64()), "blocks": pa.array(found, pa.list_(pa.binary()))}

    chosen = half.select(F.expr("label * 2 + half").alias("doc_id"), "text")  # at most 4 * per_class rows
    rows = map_texts(chosen, cut, "doc_id long, blocks array<binary>").collect()
    samples = [sorted(bytes(b) for r in rows if r["doc_id"] == 2 * k for b in r["blocks"]) for k in (0, 1)]
    counts = [sum(r["doc_id"] // 2 == k for r in rows) * stands_for[k] for k in (0, 1)]
    if not all(samples):
        share = (counts[1] + 1) / (sum(counts) + 2)
        return Model(None, None, (0.0, 0.0, 0.0), float(np.log(share / (1 - share))))
    model = Model(dictionary(samples[1]), dictionary(samples[0]), (20.0, 0.0, 0.0), 0.0)

    def measure(ids: list, bodies: list[str]) -> dict:
        return {"doc_id": pa.array(ids, pa.int64()), "x": pa.array([list(model.features(t)) for t in bodies], pa.list_(pa.float64()))}

    other = half.filter("half = 1").select(F.col("label").cast("long").alias("doc_id"), "text")
    rows = sorted((r["doc_id"], *r["x"]) for r in map_texts(other, measure, "doc_id long, x array<double>").collect())
    table = np.array(rows, float).reshape(-1, 4)
    if len(set(table[:, 0])) < 2:
        return model
    weights, intercept = logistic(table[:, 1:], table[:, 0], rows=stands_for[table[:, 0].astype(int)])
    return Model(model.good, model.bad, tuple(weights.tolist()), intercept)


def score(docs: DataFrame, model: Model, folds: int = 5, held_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def run(ids: list, bodies: list[str]) -> dict:
        return {"doc_id": pa.array(ids, pa.int64()), "score": pa.array([model.score(t) for t in bodies], pa.float64())}

    found = map_texts(texts(docs), run, "doc_id long, score double")
    return found.select(
        "doc_id",
        (fold("doc_id", folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
