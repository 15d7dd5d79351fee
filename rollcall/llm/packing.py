"""Vector best-fit packing (op 1).

Every document becomes token ids; only those longer than a sequence are cut, into whole sequences and one shorter first
piece. A piece asks for three things: tokens, one place among the documents of a sequence, and attention cost (the square
of its length). A sequence has a residual capacity of each. Pieces are placed longest first; among the open sequences that
can take the piece under every capacity, the one with the highest weighted dot product of demand and residual ("dot"), or
the smallest weighted norm of what would be left ("norm"), is chosen; a new one is opened if none can.

A piece's demands follow from its length alone, so the placement is decided for the number of pieces of each length (at
most `capacity` numbers, whatever the size of the corpus), in runs of equal sequences. A decision gives a run of pieces of
one length their sequences, so the plan is a list of runs: each run of sequences takes pieces of ever smaller lengths
whose sum is within the capacity, so at most sqrt(2 * capacity) different ones, and at most three runs begin per length:
at most 3 * capacity * sqrt(2 * capacity) rows (140,000 at 1024). Pieces are numbered within their length by all tasks at
once (a salted count, then offsets), and look their number up in the plan.

Null text: empty, which is packed as the end id alone. Null ids and repeated rows are packed like others. Empty table: no
rows.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import stage
from .inputs import map_texts, texts, worker_store

#: Bound of the table of encoded words in one worker; it is emptied when full. Results do not depend on it.
REMEMBERED = 400_000

#: Fixed value: the pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class _Words(dict):
    """Ids of a word with the space before it, encoded when first asked for; None if it cannot be encoded apart.

    The file numbers its merges in their order, so its own vocabulary serves as ranks to the `tiktoken` library, which is
    quicker on single words and gives the same ids; `tests/llm` compares them.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the library gives the characters that stand for bytes in ascending order of the printable ones, then the others
        stand = sorted(pre_tokenizers.ByteLevel.alphabet(), key=ord)
        kept = [ord(c) for c in stand if ord(c) < 256]
        others = iter(c for c in stand if ord(c) >= 256)
        byte_of = {chr(b) if b in kept else next(others): b for b in range(256)}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False).items()
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary if t not in self.special}
        self.encode = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes | None:
        apart = word and not word[0].isspace() and not any(s in word for s in self.special)
        found = self[word] = array("I", self.encode(" " + word)).tobytes() if apart else None
        return found


class WordTokens:
    """Ids of a text by the `tokenizers` library, as little-endian unsigned 32-bit numbers, remembering words.

    The byte-level pattern always begins a new match at a space that stands before a visible character, so the words of a
    text, each with its space, are encoded apart. A text in which a space stands before another white-space character, or
    that holds a special token, is encoded as a whole.
    """

    def __init__(self, path: str):
        self.words = _Words(path)
        self.firsts: dict[str, bytes] = {"": b""}

    def encode(self, bodies: list[str]) -> list[bytes]:
        words, firsts = self.words, self.firsts
        if len(words) >= REMEMBERED or len(firsts) >= REMEMBERED:
            words.clear()
            self.firsts = firsts = {"": b""}
        ids, out = words.__getitem__, []
        for text in bodies:
            first, *rest = text.split(" ")
            if first not in firsts:
                firsts[first] = words.whole(first)
            try:
                out.append(firsts[first] + b"".join(map(ids, rest)))
            except TypeError:  # a word that cannot be encoded apart
                out.append(words.whole(text))
        return out


def word_tokens(path: str) -> WordTokens:
    store = worker_store()
    if ("word tokens", path) not in store:
        store["word tokens", path] = WordTokens(path)
    return store["word tokens", path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (binary, little-endian unsigned 32-bit) of every piece."""
    end = np.array([end_id], "<u4").tobytes()

    def run(ids: list, bodies: list[str]) -> dict:
        out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        for doc_id, data in zip(ids, word_tokens(tokenizer_path).encode(bodies), strict=True):
            data += end
            n = len(data) // 4
            cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                part = data[4 * a : 4 * b]
                for name, value in zip(out, (doc_id, k, a, b - a, zlib.crc32(part), part), strict=True):
                    out[name].append(value)
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return {n: pa.array(v, t) for (n, v), t in zip(out.items(), types, strict=True)}

    return map_texts(texts(docs, id_col, text_col), run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def plan(counts: dict[int, int], capacities: tuple[int, int, int], weights: tuple[float, float, float] = (1.0, 1.0, 1.0), rule: str = "norm") -> np.ndarray:
    """Rows (length, first, n, sequence, each, offset): pieces first .. first + n - 1 of a length go to sequences from
    `sequence` on, `each` to a sequence, from `offset` on. Sorted by length and first.

    A run of open sequences is (first sequence, how many, tokens, documents, cost left of each).
    """
    room = np.array(capacities, float)
    w = np.array(weights, float)
    runs: list[tuple[int, int, int, int, int]] = []
    rows, sequences = [], 0
    for length in sorted((k for k, v in counts.items() if v), reverse=True):
        left, first = counts[length], 0
        need = np.array([length, 1, length * length])
        if (need > room).any():
            raise ValueError(f"a piece of {length} tokens does not fit an empty sequence")
        while left:
            state = np.array([r[2:] for r in runs], float).reshape(-1, 3)
            able = np.flatnonzero((state >= need).all(axis=1))
            if len(able):
                rest = state[able]
                if rule == "dot":
                    score = (w * (need / room) * (rest / room)).sum(axis=1)
                else:
                    score = -(w * ((rest - need) / room) ** 2).sum(axis=1)
                at = int(able[np.argmax(score)])
                start, many, tokens, places, cost = runs.pop(at)
            else:
                (tokens, places, cost), start = capacities, sequences
                many = None
            each = min(tokens // length, places, cost // (length * length))
            if many is None:
                many = -(-left // each)
                sequences += many
            full = min(many, left // each)
            begun = []
            if full:
                rows.append((length, first, full * each, start, each, capacities[0] - tokens))
                first, left = first + full * each, left - full * each
                begun.append((start, full, tokens - each * length, places - each, cost - each * length * length))
            if left and full < many:
                rows.append((length, first, left, start + full, left, capacities[0] - tokens))
                begun.append((start + full, 1, tokens - left * length, places - left, cost - left * length * length))
                full, left = full + 1, 0
            if full < many:
                begun.append((start + full, many - full, tokens, places, cost))
            runs += [r for r in begun if r[2] > 0 and r[3] > 0 and r[4] > 0]
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def pack(cut: DataFrame, capacity: int = 1024, max_documents: int | None = None, max_cost: int | None = None, weights: tuple[float, float, float] = (1.0, 1.0, 1.0), rule: str = "norm") -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32); `cut` must be a written table.

    `max_documents` and `max_cost` are None where only tokens bind: a sequence of `capacity` tokens holds at most
    `capacity` pieces of at most `capacity` squared cost.
    """
    spark = cut.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    held = stage(dealt.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # at most `capacity` rows: a length and its number of pieces
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = plan(counts, (capacity, max_documents or capacity, max_cost or capacity * capacity), weights, rule)
    starts = held.withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)))
    own = W.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = (
        dealt.withColumn("nth", F.row_number().over(own) - 1)
        .join(starts.select("length", "salt", F.coalesce("before", F.lit(0)).alias("before")), ["length", "salt"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("nth"))
    )
    shared = spark.sparkContext.broadcast(table)  # bounded, see above
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        keys = runs[:, 0] << 48 | runs[:, 1]
        for batch in batches:
            length, nth = batch.column("length").to_numpy(), batch.column("nth").to_numpy()
            if not len(nth):
                continue
            run = runs[np.searchsorted(keys, length << 48 | nth, side="right") - 1]
            at = nth - run[:, 1]
            where = [run[:, 3] + at // run[:, 4], run[:, 5] + at % run[:, 4] * length]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names[:5]), *map(pa.array, where)], names=names)

    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, **how) -> DataFrame:
    """Cuts and packs documents; the ids themselves can be had from `pieces` by doc_id, piece and start."""
    cut = pieces(docs, tokenizer_path, capacity, end_id).drop("ids")
    return pack(stage(cut, "pieces"), capacity, **how)
