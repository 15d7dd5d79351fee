"""SimHash near-duplicates with pigeonring filtering (op 8).

A fingerprint has 64 bits. Two fingerprints link at `max_bits` or fewer differing bits. The 64 bits are a ring of
`max_bits + 1` segments. If two fingerprints link, then for some start every chain of l consecutive segments from
there differs in at most floor(l * max_bits / (max_bits + 1)) = l - 1 bits (the pigeonring principle). So from that
start the first segment is equal, the second differs in at most one bit and so is equal in one of its halves, the third
in at most two and so is equal in one of its thirds. A candidate key is the fingerprint masked to one such choice;
`depth` segments are used. Candidates of one key then pass the chain test for all lengths, then the full Hamming test.
No linked pair is missed and none is capped.

Copies meet before the search: it runs on distinct fingerprints. Each key gives only star edges of its linked groups
to the smallest member, never all pairs, and those meet in a distributed large-star / small-star contraction.

Null text: empty. Texts without words have fingerprint zero and link like any other. Null ids keep their row; a
component's id is its smallest id that is not null, or null. Repeated rows each get a row. Empty table: no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .inputs import map_texts, texts, words_of


def fingerprint(words: list[bytes], shingle: int = 3) -> int:
    """SimHash of the word shingles, repeats included: bit b is 1 if set in over half of the hashes."""
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=False)]
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at : at + 65536], dtype=">u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprint_udf(shingle: int = 3):
    """The fingerprint of a text, as a column."""

    @F.pandas_udf("long")
    def of(bodies: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(words_of(t), shingle) for t in bodies], dtype="int64")

    return of


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and `fp` (signed 64 bits) of every row of (doc_id, text)."""

    def run(ids: list, bodies: list[str]) -> dict:
        return {"doc_id": pa.array(ids, pa.int64()), "fp": pa.array([fingerprint(words_of(t), shingle) for t in bodies], pa.int64())}

    return map_texts(docs, run, "doc_id long, fp long")


def _parts(bits: list[int], n: int) -> list[list[int]]:
    return [list(x) for x in np.array_split(bits, n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ring_masks(max_bits: int, depth: int) -> tuple[list[int], list[list[int]]]:
    """The mask of every key, and for each key the masks of its chains of 1, 2, ... segments."""
    segments = _parts(list(range(64)), max_bits + 1)
    masks, chains = [], []
    for start in range(len(segments)):
        ring = segments[start:] + segments[:start]
        running = list(itertools.accumulate(ring, lambda a, b: a + b))
        steps = [sum(1 << int(b) for b in x) for x in running]
        for choice in itertools.product(*(_parts(ring[j], j + 1) for j in range(min(depth, len(ring))))):
            masks.append(sum(1 << int(b) for part in choice for b in part))
            chains.append(steps)
    return masks, chains


def _linked(fps: np.ndarray, steps: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs pass the chain test of every length; the longest chain is the whole ring, so the Hamming test."""
    differ = fps[i] ^ fps[j]
    ok = np.ones(len(i), bool)
    for length in range(1, len(steps) + 1):
        at = np.flatnonzero(ok)
        if not len(at):
            break
        ok[at] = np.bitwise_count(differ[at] & steps[length - 1]) <= length - 1
    return ok


def _stars(fps: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked groups among one key's fingerprints: each member but the smallest, with the smallest. `fps` is unsigned."""
    n = len(fps)
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    at, width, top = 0, 1, np.arange(n)
    while at < n - 1:  # rows of the triangle of pairs, a bounded block at a time; joined groups need no more tests
        rows = np.arange(at, min(at + width, n - 1))
        i, j = np.nonzero((np.arange(n)[None, :] > rows[:, None]) & (top[None, :] != top[rows][:, None]))
        ok = _linked(fps, steps, rows[i], j)
        for a, b in zip(rows[i[ok]].tolist(), j[ok].tolist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
        top = np.array([find(x) for x in range(n)])
        at, width = at + width, min(2 * width, max(1, 2_000_000 // n))
    member = np.flatnonzero(top != np.arange(n))
    return fps[member], fps[top[member]]


def edges(distinct: DataFrame, max_bits: int = 3, depth: int = 3) -> DataFrame:
    """Star edges (src, dst) that connect exactly the linked fingerprints; `distinct` has `fp` once each."""
    masks, chains = ring_masks(max_bits, depth)
    steps = [np.array(c, np.uint64) for c in chains]
    keys = F.array(*(F.struct(F.lit(k).alias("ring"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part")) for k, m in enumerate(masks)))
    keyed = distinct.select("fp", F.explode(keys).alias("key")).select("key.ring", "key.part", "fp")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch.to_pandas())
                last = held[-1]
                if len(last) and (held[0].ring.iloc[0], held[0].part.iloc[0]) == (last.ring.iloc[-1], last.part.iloc[-1]):
                    continue  # one key so far; its group may go on
            rows = pd.concat(held, ignore_index=True) if held else None
            if rows is None or not len(rows):
                continue
            ring, part = rows.ring.to_numpy(), rows.part.to_numpy()
            fps = rows.fp.to_numpy().view(np.uint64)
            new = np.flatnonzero(np.concatenate([[True], (ring[1:] != ring[:-1]) | (part[1:] != part[:-1])]))
            until = np.append(new[1:], len(rows))
            if batch is not None:  # the last key waits for the next batch
                held = [rows.iloc[new[-1] :]]
                new, until = new[:-1], until[:-1]
            src, dst = [], []
            pairs = np.flatnonzero(until - new == 2)
            if len(pairs):
                i = new[pairs]
                by_ring = ring[i]
                for k in np.unique(by_ring):
                    at = i[by_ring == k]
                    ok = _linked(fps, steps[k], at, at + 1)
                    src.append(np.maximum(fps[at[ok]], fps[at[ok] + 1]))
                    dst.append(np.minimum(fps[at[ok]], fps[at[ok] + 1]))
            for g in np.flatnonzero(until - new > 2):
                a, b = _stars(np.sort(fps[new[g] : until[g]]), steps[ring[new[g]]])
                src.append(a)
                dst.append(b)
            if src:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (src, dst)], names=["src", "dst"]
                )

    dealt = keyed.repartition("ring", "part").sortWithinPartitions("ring", "part")
    return dealt.mapInArrow(solve, "src long, dst long").distinct()


def contract(links: DataFrame) -> DataFrame:
    """Connected components of (src, dst): one row (node, root) per node that has a link; root is the smallest node.

    Alternating large-star and small-star steps; each is a pre-aggregated minimum and a join, so no node's
    neighbours are gathered in one task. Every round is a written table.
    """
    now = stage(links.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).filter("u <> v").distinct(), "links")
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        now = stage(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(),
            "links",
        )
        seen = now.agg(F.count("u"), F.sum(F.hash("u", "v").cast("decimal(20,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
        mark = seen


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fp, root (the component's smallest fingerprint), component_id (its smallest id)."""
    rows = stage(fingerprints(texts(docs, id_col, text_col), shingle), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    found = stage(contract(edges(distinct, max_bits)), "components")
    placed = distinct.join(found, distinct.fp == found.node, "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    placed = stage(placed.join(least, "root").select("fp", "root", "component_id"), "placed")
    return rows.join(placed, "fp").select("doc_id", "fp", "root", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
