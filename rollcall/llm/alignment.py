"""Cross-tokenizer alignment by external spill counting (op 13).

Each text is encoded by a byte-level BPE (A, on a space and the text) and a sentence-piece BPE (B, which adds that space).
Byte offsets where tokens of both end cut the tokens into groups; an A and a B token whose bytes overlap are a link.

*Spill.* While a task reads documents it gathers records (pair of ids, document, links). At `spill_records` records it sorts
them by (digit of the A id, A id, B id, document), which is the radix partition and the sort of every run at once, and writes
one run for each digit: blocks of pairs with the number of documents that hold them (`heads`), and the documents themselves
(`body`), both compressed by zstandard. Runs are written to the shared folder as a table. A pair that is in every document
has one entry in a run's heads, so no pair is hot.

*Merge.* The heads of a digit's runs are merged through a heap of the last pair of each run's block, so that one block of a
run is open at a time, in passes of at most `fan` runs or so. The last pass goes by A id (the major side of the order), which
gives an A id's highest count as soon as its pairs have gone by.

*Back.* The runs are read again, in groups of about `fan` runs of a digit, beside that digit's merged counts; what each run
adds to its documents is summed by document.

Where no piece of B holds a space mark behind another character, or a line break, both encoders cut at every single space
and single line break before a visible character; the words between are encoded and aligned once and remembered. Other texts are
encoded and aligned as a whole, with the same result.

Texts that are null or empty, or of which either encoder does not give back the bytes (B cannot hold U+2581), have no tokens:
zeros and an empty digest. Every row is a document of its own, also with a null or repeated id or text. Long texts are encoded
whole; a text alone may pass `spill_records`. Ties: every pair with an A id's highest count is a best one. Other columns are
left out, so they cannot clash. Empty table: no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .bytelevel import ByteLevel
from .inputs import texts, worker_store

#: Bound of the table of remembered words in one worker; it is emptied when full. Results do not depend on it.
REMEMBERED = 400_000
#: Pairs in a block of a run's heads.
BLOCK = 8192
#: Bits of a token id within a pair's key.
ID_BITS = 24

_STATS = ["n_a", "n_b", "n_groups", "n_links"]
_RUNS = "run long, part int, slot int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, heads array<binary>, body binary"


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << ID_BITS | b.astype(np.int64)


class Encoders:
    """Both encoders, on many words at once."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = ByteLevel(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.a_bytes = self.a.bytes
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.comma, self.bar, self.semicolon = ([f"{i}{mark}" for i in range(most)] for mark in ",|;")
        self.space = self.b.piece_to_id("▁")
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces)
        self.lines_apart = self.apart and not any("\n" in p for p in pieces)

    def separable(self, word: str) -> bool:
        """A space, or a line break that is part of `word`, then a visible character."""
        line = word[:1] == "\n"
        return (self.lines_apart if line else self.apart) and not (word[1:2] if line else word[:1]).isspace() and len(word) > line

    def align(self, words: list[str], whole: bool = False) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(groups as text, counts and whether it is sound, number of pairs, pairs, links of each) of words, or of one text."""
        spaced = [w if w[:1] == "\n" and not whole else " " + w for w in words]
        found = self.b.encode(words, num_threads=1)
        for k, w in enumerate(spaced):
            if w[0] == "\n":  # without the space that B has put before it
                found[k] = found[k][1:] if found[k][:1] == [self.space] else []
        joined = "".join(spaced)
        a_ids, b_ids = self.a.encode(joined), list(chain.from_iterable(found))
        data = joined.encode()
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != data or b"".join(map(self.b_bytes.__getitem__, b_ids)) != data:
            if len(words) == 1:
                none = np.zeros(0, np.int64)
                yield [""], np.zeros((1, 5), np.int64), np.zeros(1, np.int64), none, none
            else:
                yield from self.align(words[: len(words) // 2])
                yield from self.align(words[len(words) // 2 :])
            return
        a, b = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        word_end = np.cumsum([len(w.encode()) for w in spaced])
        # every stretch between two ends of either side is one link; every end of both closes a group
        ends, common = np.union1d(a_end, b_end), np.intersect1d(a_end, b_end)
        if not np.isin(word_end, common).all():
            raise ValueError("a token reaches over a space: the encoders cannot take words apart")
        keys = pair_key(a[np.searchsorted(a_end, ends)], b[np.searchsorted(b_end, ends)])
        n = len(words)
        held, links = np.unique(np.searchsorted(word_end, ends) << 2 * ID_BITS | keys, return_counts=True)
        per_word = [np.bincount(np.searchsorted(word_end, x), minlength=n) for x in (a_end, b_end, common, ends)]
        counts = np.column_stack([*per_word, np.ones(n, np.int64)])
        a_last, b_last = (np.isin(x, common, assume_unique=True).tolist() for x in (a_end, b_end))
        comma, bar, semicolon = self.comma, self.bar, self.semicolon
        items = [bar[i] if last else comma[i] for i, last in zip(a_ids, a_last, strict=True)]
        items += [semicolon[i] if last else comma[i] for i, last in zip(b_ids, b_last, strict=True)]
        order = np.argsort(np.concatenate([np.searchsorted(common, a_end) * 2, np.searchsorted(common, b_end) * 2 + 1]), kind="stable")
        items = np.array(items, object)[order].tolist()
        edges = np.concatenate([[0], np.cumsum(per_word[0] + per_word[1])]).tolist()
        strings = ["".join(items[x:z]) for x, z in zip(edges, edges[1:], strict=False)]
        many = np.bincount(held >> 2 * ID_BITS, minlength=n)
        yield strings, counts, many, held & (1 << 2 * ID_BITS) - 1, links


class _Grown:
    """A number array that rows are added to."""

    def __init__(self, *shape: int):
        self.data, self.n = np.zeros((1024, *shape), np.int64), 0

    def add(self, rows: np.ndarray) -> None:
        while self.n + len(rows) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.data[self.n : self.n + len(rows)] = rows
        self.n += len(rows)


class Words(dict):
    """Number of every word met so far: -1 if it cannot be taken apart from its text."""

    def __init__(self, encoders: Encoders):
        super().__init__()
        self.encoders = encoders
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.strings: list[str] = []
        #: counts and whether the word is sound; start and number of its pairs; pairs; links of each
        self.stats, self.spans, self.pairs, self.links = _Grown(5), _Grown(2), _Grown(), _Grown()

    def put(self, words: list[str], whole: bool = False) -> None:
        for strings, counts, many, pairs, links in self.encoders.align(words, whole):
            self.strings += strings
            self.stats.add(counts)
            self.spans.add(np.column_stack([self.pairs.n + np.cumsum(many) - many, many]))
            self.pairs.add(pairs)
            self.links.add(links)

    def of(self, bodies: list[str]) -> list[list[int]]:
        """Numbers of the words of each text; a text that cannot be taken apart is one word."""
        split = [t.replace("\n", " \n").split(" ") if t else [] for t in bodies]
        new = [w for w in set(chain.from_iterable(split)) if w not in self]
        able = [w for w in new if self.encoders.separable(w)]
        self.update(dict.fromkeys(new, -1))
        for at in range(0, len(able), 4096):
            some = able[at : at + 4096]
            self.update(zip(some, range(len(self.strings), len(self.strings) + len(some)), strict=True))
            self.put(some)
        numbers = []
        for text, words in zip(bodies, split, strict=True):
            found = list(map(self.__getitem__, words))
            if -1 in found:
                self.put([text], whole=True)
                found = [len(self.strings) - 1]
            numbers.append(found)
        return numbers


def _words(a_path: str, b_path: str) -> Words:
    store = worker_store()
    if ("aligned words", a_path, b_path) not in store:
        store["aligned words", a_path, b_path] = Words(Encoders(a_path, b_path))
    return store["aligned words", a_path, b_path]


def _aligned(words: Words, bodies: list[str]) -> tuple[dict[str, np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Counts and digest of each text, and (text number, key, links), a row for each text and word that it holds."""
    if len(words.strings) >= REMEMBERED:
        words.forget()
    numbers = words.of(bodies)
    flat = np.fromiter(chain.from_iterable(numbers), np.int64, sum(map(len, numbers)))
    text = np.repeat(np.arange(len(bodies)), [len(x) for x in numbers])
    counts = words.stats.data[flat]
    sound = np.ones(len(bodies), bool)
    sound[text[counts[:, 4] == 0]] = False
    sound &= [bool(x) for x in numbers]
    sums = np.zeros((len(bodies), 4), np.int64)
    np.add.at(sums, text, counts[:, :4])
    sums[~sound] = 0
    string = words.strings.__getitem__
    digests = [hashlib.sha256("".join(map(string, x))[:-1].encode()).hexdigest() if ok else "" for x, ok in zip(numbers, sound, strict=True)]
    held, times = np.unique((text * len(words.strings) + flat)[sound[text]], return_counts=True)
    text, flat = np.divmod(held, max(len(words.strings), 1))
    start, many = words.spans.data[flat].T
    at = np.repeat(start - np.concatenate([[0], np.cumsum(many)[:-1]]).astype(np.int64), many) + np.arange(many.sum())
    return dict(zip(_STATS, sums.T, strict=True)), digests, np.repeat(text, many), words.pairs.data[at], words.links.data[at] * np.repeat(times, many)


def _packed(*columns: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(len(columns[0]).to_bytes(8, "little") + b"".join(c.tobytes() for c in columns))


def _unpacked(data: bytes, *types: str) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 8
    for t in types:
        size = int.from_bytes(raw[:8], "little") * np.dtype(t).itemsize
        out.append(np.frombuffer(raw, t, offset=at, count=size // np.dtype(t).itemsize))
        at += size
    return out


def _firsts(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(sorted_keys) else np.zeros(0, np.int64)


def _blocks(keys: np.ndarray, counts: np.ndarray) -> list[bytes]:
    return [_packed(keys[i : i + BLOCK], counts[i : i + BLOCK]) for i in range(0, len(keys), BLOCK)]


def _runs(parts: int, text: np.ndarray, keys: np.ndarray, links: np.ndarray) -> Iterator[tuple[int, list[bytes], bytes]]:
    """(digit, heads, body) of the records of one spill; `text` never falls."""
    digit = (keys >> ID_BITS) % parts
    order = np.argsort(digit << 2 * ID_BITS | keys, kind="stable")
    digit, keys, text, links = digit[order], keys[order], text[order], links[order]
    record = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])]))
    links = np.add.reduceat(links, record)
    digit, keys, text = digit[record], keys[record], text[record]
    edges = np.searchsorted(digit, np.arange(parts + 1))
    for p in range(parts):
        a, z = edges[p], edges[p + 1]
        if a < z:
            first = _firsts(keys[a:z])
            docs = np.diff(np.append(first, z - a))
            yield p, _blocks(keys[a:z][first], docs), _packed(text[a:z].astype(np.uint32), links[a:z].astype(np.uint32))


def spill(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", parts: int = 32, spill_records: int = 1_500_000) -> DataFrame:
    """One row for each document (`part` null; run and slot are its place) and for each run (run, part, heads, body)."""
    names = [x.split(" ")[0] for x in _RUNS.split(", ")]
    schema = pa.schema(
        [("run", pa.int64()), ("part", pa.int32()), ("slot", pa.int32()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in _STATS),
         ("groups_sha256", pa.string()), ("heads", pa.list_(pa.binary())), ("body", pa.binary())]
    )

    def table(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[c], schema.field(c).type) if c in columns else pa.nulls(n, schema.field(c).type) for c in names], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(a_path, b_path)
        this, slot, gathered, held = TaskContext.get().partitionId() << 32, 0, [], 0

        def spilled() -> Iterator[pa.RecordBatch]:
            if held:
                for p, heads, body in _runs(parts, *(np.concatenate(x) for x in zip(*gathered, strict=True))):
                    yield table(1, run=[this], part=[p], heads=[heads], body=[body])

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                piece = batch.slice(at, 128)
                stats, digests, text, keys, links = _aligned(words, piece.column(1).to_pylist())
                n = piece.num_rows
                yield table(n, run=np.full(n, this), slot=np.arange(slot, slot + n, dtype=np.int32), doc_id=piece.column(0), groups_sha256=digests, **stats)
                gathered.append((text + slot, keys, links))
                slot, held = slot + n, held + len(keys)
                if held >= spill_records:
                    yield from spilled()
                    this, slot, gathered, held = this + 1, 0, [], 0
        yield from spilled()

    return stage(texts(docs, id_col, text_col).mapInArrow(run, _RUNS), "alignment-runs")


def merged(runs: Iterable[Iterable[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (keys, sums) in ascending order from runs of such blocks, each ascending, one block of each open at a time.

    The top of the heap is the lowest last key of the open blocks: no later block can hold a key up to it.
    """
    left = [iter(r) for r in runs]
    blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def take(k: int) -> None:
        block = next((b for b in left[k] if len(b[0])), None)
        if block is None:
            blocks.pop(k, None)
        else:
            blocks[k] = block
            heapq.heappush(heap, (int(block[0][-1]), k))

    for k in range(len(left)):
        take(k)
    while heap:
        bound, done, parts = heap[0][0], [], []
        while heap and heap[0][0] == bound:
            done.append(heapq.heappop(heap)[1])
        for k, (keys, counts) in blocks.items():
            n = int(np.searchsorted(keys, bound, side="right"))
            if n:
                parts.append((keys[:n], counts[:n]))
                blocks[k] = (keys[n:], counts[n:])
        keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")
        first = _firsts(keys[order])
        yield keys[order][first], np.add.reduceat(counts[order], first)
        for k in done:
            take(k)


def _heads(blocks: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    return ((k, c) for k, c in (_unpacked(b, "<i8", "<i8") for b in blocks))


def with_best(blocks: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, counts, whether the count is its A id's highest): an A id's pairs are held until the next A id begins."""
    keys = counts = np.zeros(0, np.int64)

    def judged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = _firsts(keys >> ID_BITS)
        most = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(keys))))
        return keys, counts, counts == most

    for more_keys, more_counts in blocks:
        keys, counts = np.concatenate([keys, more_keys]), np.concatenate([counts, more_counts])
        whole = int(np.searchsorted(keys >> ID_BITS, keys[-1] >> ID_BITS))
        if whole:
            yield judged(keys[:whole], counts[:whole])
        keys, counts = keys[whole:], counts[whole:]
    if len(keys):
        yield judged(keys, counts)


def count_pairs(runs: DataFrame, fan: int = 64) -> DataFrame:
    """part and `heads`, the blocks of each digit's merged pairs, from the table of `spill`."""

    def fewer(rows: pd.DataFrame) -> pd.DataFrame:
        out = [b for keys, counts in merged(_heads(h) for h in rows.heads) for b in _blocks(keys, counts)]
        return pd.DataFrame({"run": [int(rows.run.min())], "part": [int(rows.part.iloc[0])], "heads": [out]})

    level = runs.filter(F.col("part").isNotNull()).select("run", "part", "heads")
    while True:
        # one number: the most runs of a digit
        most = level.groupBy("part").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return level.select("part", "heads")
        nth = F.pmod(F.xxhash64("run"), F.lit(-(-most // fan)))
        level = stage(level.withColumn("nth", nth).groupBy("part", "nth").applyInPandas(fewer, "run long, part int, heads array<binary>"), "merged-runs")


def pair_counts(counted: DataFrame) -> DataFrame:
    """a_id, b_id, n_docs and is_best of every pair, from `count_pairs`."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for heads in batch.column(0):
                for keys, counts, best in with_best(_heads(h.as_py() for h in heads.values)):
                    columns = [keys >> ID_BITS, keys & (1 << ID_BITS) - 1, counts, best]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["a_id", "b_id", "n_docs", "is_best"])

    return counted.select("heads").mapInArrow(listed, "a_id long, b_id long, n_docs long, is_best boolean")


def align_documents(docs: DataFrame, a_path: str, b_path: str, fan: int = 64, **how) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    runs = spill(docs, a_path, b_path, **how)
    counted = count_pairs(runs, fan)
    own = runs.filter(F.col("part").isNotNull())
    n_runs = own.groupBy("part").count().agg(F.max("count")).first()[0] or 1
    groups = -(-n_runs // fan)
    left = own.select("run", "part", "heads", "body", F.pmod(F.xxhash64("run"), F.lit(groups)).cast("int").alias("nth"))
    right = counted.select(F.col("part").alias("of"), F.col("heads").alias("all"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("its"))

    def back(rows: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows):
            # a digit's distinct pairs: their number is bounded by the two vocabularies
            keys, n_docs, best = (np.concatenate(x) for x in zip(*with_best(_heads(counts["all"].iloc[0])), strict=True))
            for run, heads, body in zip(rows.run, rows.heads, rows.body, strict=True):
                text, links = _unpacked(body, "<u4", "<u4")
                held, times = (np.concatenate(x) for x in zip(*_heads(heads), strict=True))
                at = np.repeat(np.searchsorted(keys, held), times)
                sums = np.zeros((int(text.max()) + 1, 3), np.int64)
                links = links.astype(np.int64)
                np.add.at(sums, text, np.column_stack([links * best[at], links * n_docs[at], links]))
                some = np.flatnonzero(sums[:, 2])
                out.append(pd.DataFrame({"its_run": run, "its_slot": some, "n_best": sums[some, 0], "count_sum": sums[some, 1]}))
        return pd.concat(out) if out else pd.DataFrame({"its_run": [], "its_slot": [], "n_best": [], "count_sum": []})

    added = left.groupBy("part", "nth").cogroup(right.groupBy("of", "its")).applyInPandas(back, "its_run long, its_slot int, n_best long, count_sum long")
    sums = added.groupBy("its_run", "its_slot").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    rows = runs.filter(F.col("part").isNull())
    found = rows.join(sums, (F.col("run") == F.col("its_run")) & (F.col("slot") == F.col("its_slot")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return found.select("doc_id", *_STATS, *zero, "groups_sha256")
