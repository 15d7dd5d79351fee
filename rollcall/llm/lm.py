"""Language-model scores from an Elias-Fano n-gram trie (op 10).

The model is a word bigram with Dirichlet smoothing: log10 of (c(v w) + m p(w)) / (c(v) + m), where p is the smoothed unigram
(c(w) + 0.5) / (N + 0.5 (V + 1)) and a text's first word follows a start mark. The part c(v w) / (c(v) + m) of every bigram of
the training documents is kept, quantised, in tries; m p(w) / (c(v) + m) needs only the unigram counts.

All counts are over all training documents, and both the counts and the tries are dealt out, so nothing is broadcast:
1. Tasks read documents into chunks of about `chunk_tokens` tokens (a longer text is one chunk): each token as a number,
   the distinct words, and their counts in training texts. The chunks are a written table.
2. The distinct words of each chunk go to shards by hash. A shard adds up their counts, numbers the words that training
   texts have, and answers each chunk with numbers and counts. The chunks' table is bucketed, so that only answers move.
3. Each chunk sends its distinct bigrams of known words, with their training counts and c(v), to shards by hash of the
   bigram, so that a frequent word's bigrams are spread over all shards.
4. A shard adds up the counts, writes its trie to files of its own, maps them, and answers each chunk with codes.
5. Each chunk scores its texts.
What is exchanged is one entry per distinct word or bigram of a chunk, packed; it grows with the input, as do the tries.
The shards are as many as `spark.sql.shuffle.partitions`, or as asked for. Lost tasks are run again from the written tables.

Null text: empty, which is the end token alone. Null ids are in fold 0 and keep their row, as do repeated rows. Without
training documents N and V are 0. Empty table: no rows.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_path, stage
from .eliasfano import Trie
from .inputs import fold, texts, words_of

#: The end token's word; no word is empty.
END = b""


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _split(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


def chunks(docs: DataFrame, chunk_tokens: int = 1_000_000) -> DataFrame:
    """One row per chunk of (doc_id, train, text): ids, training flags, tokens per document, token numbers, words, counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["chunk", "ids", "train", "sizes", "tokens", "words", "counts"]
        at, words, ids, train, sizes, tokens, held = 0, {END: 0}, [], [], [], [], 0

        def row() -> pa.RecordBatch:
            number = np.concatenate(tokens)
            weight = np.repeat(np.array(train), sizes)
            counts = np.bincount(number, weights=weight, minlength=len(words)).astype(np.int64)
            values = [
                TaskContext.get().partitionId() << 32 | at, ids, train, sizes, _pack(number),
                zstandard.ZstdCompressor(level=1).compress(b"\n".join(words)), _pack(counts),
            ]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            for doc_id, flag, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = words_of(text)
                own.append(END)
                tokens.append(np.array([words.setdefault(w, len(words)) for w in own], np.int32))
                ids.append(doc_id)
                train.append(flag)
                sizes.append(len(own))
                held += len(own)
                if held >= chunk_tokens:
                    yield row()
                    at, words, ids, train, sizes, tokens, held = at + 1, {END: 0}, [], [], [], [], 0
        if ids:
            yield row()

    schema = "chunk long, ids array<long>, train array<boolean>, sizes array<int>, tokens binary, words binary, counts binary"
    return docs.select("doc_id", "train", "text").mapInArrow(run, schema)


def _shards_of_words(words: list[bytes], shards: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % shards


def _rows(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns.values()], names=list(columns))


def _table(columns: dict[str, tuple[list, pa.DataType]]) -> pa.Table:
    return pa.Table.from_batches([_rows(columns)])


def _bucketed(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Writes `df` as a table bucketed by a column, in the shared folder; what groups it by that column need not move it."""
    spark = df.sparkSession
    path = scratch_path(spark, "chunks")
    name = "rollcall_" + path.rsplit("/", 1)[1].replace("-", "_")
    df.write.format("parquet").bucketBy(buckets, column).option("path", path).saveAsTable(name)
    return spark.table(name)


def count_words(staged: DataFrame, shards: int) -> DataFrame:
    """Answers (chunk, shard, numbers, counts) in the order of the chunk's words of that shard.

    A row with chunk -1 tells how many known words (`numbers`) and training tokens (`counts`) the shard has.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = _split(data)
                own = _unpack(counts, "<i8")
                shard = _shards_of_words(words, shards)
                found: list[list] = [[], [], [], []]
                for s in np.unique(shard).tolist():
                    at = np.flatnonzero(shard == s)
                    some = b"\n".join([words[i] for i in at.tolist()])
                    for column, value in zip(found, (s, chunk, zstandard.ZstdCompressor(level=1).compress(some), _pack(own[at])), strict=True):
                        column.append(value)
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield _rows({n: (v, k) for n, v, k in zip(("shard", "chunk", "words", "counts"), found, kinds, strict=True)})

    def answer(table: pa.Table) -> pa.Table:
        asked = table.to_pydict()
        index: dict[bytes, int] = {}
        numbers = [np.array([index.setdefault(w, len(index)) for w in _split(data)], np.int64) for data in asked["words"]]
        total = np.zeros(len(index), np.int64)
        for at, counts in zip(numbers, asked["counts"], strict=True):
            total[at] += _unpack(counts, "<i8")  # a chunk has each word once
        known = total > 0
        number = np.where(known, np.cumsum(known) - 1, -1)
        shard = asked["shard"][0]
        chunk = [*asked["chunk"], -1]
        ranks = [_pack(number[at].astype(np.int32)) for at in numbers] + [_pack(np.array([known.sum()], np.int32))]
        counts = [_pack(total[at]) for at in numbers] + [_pack(np.array([total.sum()]))]
        return _table({"chunk": (chunk, pa.int64()), "shard": ([shard] * len(chunk), pa.int32()), "numbers": (ranks, pa.binary()), "counts": (counts, pa.binary())})

    asked = staged.select("chunk", "words", "counts").mapInArrow(ask, "shard int, chunk long, words binary, counts binary")
    return asked.groupBy("shard").applyInArrow(answer, "chunk long, shard int, numbers binary, counts binary")


class Vocabulary:
    """What is known of all words: training tokens, known words, and where each shard's numbers begin."""

    def __init__(self, answers: DataFrame, shards: int):
        # one row for each shard
        rows = answers.filter("chunk = -1").collect()
        sizes = np.zeros(shards + 1, np.int64)
        for r in rows:
            sizes[r["shard"] + 1] = _unpack(r["numbers"], "<i4")[0]
        self.first = np.cumsum(sizes)
        self.known = int(self.first[-1])
        self.tokens = sum(int(_unpack(r["counts"], "<i8")[0]) for r in rows)
        self.shards = shards


class Chunk:
    """A chunk with the answers to its words: per token the word's number (-1: unknown) and training count."""

    def __init__(self, own: dict, answers: dict, v: Vocabulary):
        words = _split(own["words"][0])
        shard = _shards_of_words(words, v.shards)
        number, count = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64)
        for s, ranks, counts in zip(answers["shard"], answers["numbers"], answers["counts"], strict=True):
            at = np.flatnonzero(shard == s)
            rank = _unpack(ranks, "<i4")
            number[at] = np.where(rank >= 0, rank + v.first[s], -1)
            count[at] = _unpack(counts, "<i8")
        tokens = _unpack(own["tokens"][0], "<i4")
        self.ids, self.train, self.sizes = own["ids"][0], np.array(own["train"][0], bool), np.array(own["sizes"][0], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.word, self.count = number[tokens], count[tokens]
        # the start mark is numbered after all words; it stands before as many texts as there are ends
        self.before = np.empty_like(self.word)
        self.before[1:] = self.word[:-1]
        self.before[self.starts] = v.known
        self.count_before = np.empty_like(self.count)
        self.count_before[1:] = self.count[:-1]
        self.count_before[self.starts] = count[0]
        self.pairs = np.flatnonzero((self.word >= 0) & (self.before >= 0) & (self.count_before > 0))
        key = self.before[self.pairs] * (v.known + 1) + self.word[self.pairs]
        self.keys, self.inverse = np.unique(key, return_inverse=True)
        with np.errstate(over="ignore"):
            mixed = self.keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.shard = ((mixed >> np.uint64(33)) % np.uint64(v.shards)).astype(np.int64)


def score(docs: DataFrame, train: Column, smoothing: float = 100.0, chunk_tokens: int = 1_000_000, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score; `train`, a condition on doc_id, tells what to learn from.

    A shard is one task's work: about 30 bytes of memory for each of its share of the chunks' distinct bigrams.
    """
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts(docs, id_col, text_col).withColumn("train", F.coalesce(train, F.lit(False)))
    staged = _bucketed(chunks(rows, chunk_tokens), "chunk", shards)
    words = stage(count_words(staged, shards), "word-counts")
    v = Vocabulary(words, shards)
    answers = words.filter("chunk >= 0").select(F.col("chunk").alias("of"), "shard", "numbers", "counts")

    def ask(own: pa.Table, answered: pa.Table) -> pa.Table:
        c = Chunk(own.to_pydict(), answered.to_pydict(), v)
        weight = np.repeat(c.train, c.sizes)[c.pairs]
        counts = np.bincount(c.inverse, weights=weight, minlength=len(c.keys)).astype(np.int32)
        before = np.zeros(len(c.keys), np.int64)
        before[c.inverse] = c.count_before[c.pairs]
        found: list[list] = [[], [], [], [], []]
        for s in np.unique(c.shard).tolist():
            at = np.flatnonzero(c.shard == s)
            keys = np.diff(c.keys[at], prepend=0)
            values = (s, own["chunk"][0].as_py(), _pack(keys), _pack(counts[at]), _pack(before[at]))
            for column, value in zip(found, values, strict=True):
                column.append(value)
        kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 3)
        return _table({n: (x, k) for n, x, k in zip(("shard", "chunk", "keys", "counts", "before"), found, kinds, strict=True)})

    def answer(table: pa.Table) -> pa.Table:
        asked = table.to_pydict()
        keys = [np.cumsum(_unpack(x, "<i8")) for x in asked["keys"]]
        all_keys, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([_unpack(x, "<i4") for x in asked["counts"]]), minlength=len(all_keys))
        before = np.zeros(len(all_keys), np.int64)
        before[at] = np.concatenate([_unpack(x, "<i8") for x in asked["before"]])
        context, successor = all_keys // (v.known + 1), all_keys % (v.known + 1)
        seen = total > 0
        with tempfile.TemporaryDirectory() as folder:
            Trie.write(folder, context[seen], successor[seen], total[seen] / (before[seen] + smoothing))
            codes = Trie(folder).codes_of(context, successor)[at]
        parts = np.split(codes, np.cumsum([len(k) for k in keys])[:-1])
        return _table({"chunk": (asked["chunk"], pa.int64()), "shard": (asked["shard"], pa.int32()), "codes": ([_pack(p) for p in parts], pa.binary())})

    def finish(own: pa.Table, answered: pa.Table) -> pa.Table:
        both = answered.to_pydict()
        is_word = [x is not None for x in both["numbers"]]
        pick = lambda name, flag: [x for x, w in zip(both[name], is_word, strict=True) if w is flag]
        c = Chunk(own.to_pydict(), {n: pick(n, True) for n in ("shard", "numbers", "counts")}, v)
        codes = np.full(len(c.keys), 65535, np.uint16)
        for s, data in zip(pick("shard", False), pick("codes", False), strict=True):
            codes[c.shard == s] = _unpack(data, "<u2")
        unigram = (c.count + 0.5) / (v.tokens + 0.5 * (v.known + 1))
        whole = smoothing * unigram / (c.count_before + smoothing)
        whole[c.pairs] += Trie.probability(codes)[c.inverse]
        add = lambda x: np.add.reduceat(x, c.starts)
        return _table(
            {
                "doc_id": (c.ids, pa.int64()),
                "n_tokens": (c.sizes, pa.int64()),
                "n_known": (add((c.count > 0).astype(np.int64)), pa.int64()),
                "train_tokens": (np.full(len(c.sizes), v.tokens), pa.int64()),
                "base_score": (add(np.log10(unigram)), pa.float64()),
                "score": (add(np.log10(whole)), pa.float64()),
            }
        )

    asked = staged.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(
        ask, "shard int, chunk long, keys binary, counts binary, before binary"
    )
    codes = stage(asked.groupBy("shard").applyInArrow(answer, "chunk long, shard int, codes binary"), "bigram-codes")
    none = F.lit(None).cast("binary")
    told = answers.select("of", "shard", "numbers", "counts", none.alias("codes")).union(
        codes.select("chunk", "shard", none, none, "codes")
    )
    return staged.groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(
        finish, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def score_documents(docs: DataFrame, folds: int = 5, held_out: int = 1, **how) -> DataFrame:
    """Scores all documents, learning from those outside the held-out fold of their id."""
    found = score(docs, fold("doc_id", folds) != held_out, **how)
    return found.withColumn("held_out", fold("doc_id", folds) == held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
