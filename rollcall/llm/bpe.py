"""Byte-level BPE by prefix dynamic programming (op 3).

For every byte prefix of a pre-token there is exactly one token that can end its encoding; `PrefixTable` stores that
token's length and id for each prefix. A token may follow another only if the bytes of both, put together, encode to
just these two (`Vocabulary.follows`), so a prefix is solved from shorter ones. Appending adds rows and changes none.
After an edit, rows are solved again from the edit on, until as many rows in a row as the longest token has bytes
agree with the old ones; all later rows are then the old ones too.

A pre-token that is a token as a whole is that token, as in the usual rank-file encoders.

Null text: empty, which has no ids. Long texts are split into pre-tokens and never cut. Repeated rows each get a row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .inputs import map_texts, texts, worker_store

#: Bound of the table of solved pre-tokens in one worker; it is emptied when full. Results do not depend on it.
REMEMBERED = 600_000


class Vocabulary:
    """Token bytes by rank, with the pair test that the dynamic program rests on."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._pairs: dict[int, bool] = {}
        self._spines: dict[int, tuple[list[int], list[int]] | None] = {}
        #: Every ending of every token, with the token that it is itself or -1.
        self._endings = {token[i:]: -1 for token in ranks for i in range(len(token))} | ranks

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def merged(self, data: bytes) -> tuple[list[int], tuple[int, int] | None]:
        """Plain merging, lowest rank first and leftmost among equals, and the two tokens of the last merge."""
        parts, last = [data[i : i + 1] for i in range(len(data))], None
        while len(parts) > 1:
            found = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                break
            i = min(found)[1]
            last = (self.ranks[parts[i]], self.ranks[parts[i + 1]])
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts], last

    def spines(self, token: int) -> tuple[list[int], list[int]] | None:
        """The tokens at the left and at the right edge of `token` while it is merged, from one byte up to itself.

        None if merging its bytes does not give it; such a token occurs only as a whole pre-token.
        """
        if token not in self._spines:
            self._spines[token] = None
            ids, last = self.merged(self.bytes_of[token])
            if ids == [token]:
                low, high = (self.spines(last[0]), self.spines(last[1])) if last else (([], []), ([], []))
                if low is None or high is None or (last and max(last) > token):
                    raise ValueError("a merge needs a token of higher rank; these ranks are not from merging")
                self._spines[token] = ([*low[0], token], [*high[1], token])
        return self._spines[token]

    def follows(self, left: int, right: int) -> bool:
        """Whether no merge crosses from `left` to `right` when the bytes of both are merged together.

        Merges happen in the order of rank, so the tokens at the border grow along both spines in that order; a token
        made of the two at the border is merged if it comes before both next steps, and the leftmost of equals first.
        """
        known = self._pairs.get(left << 32 | right)
        if known is not None:
            return known
        if len(self._pairs) >= REMEMBERED:
            self._pairs.clear()
        ranks, data = self.ranks, self.bytes_of
        ups, downs = self.spines(left)[1], self.spines(right)[0]
        i = j = 0
        known = True
        while True:
            after_left = ups[i + 1] if i + 1 < len(ups) else 1 << 62
            after_right = downs[j + 1] if j + 1 < len(downs) else 1 << 62
            crossing = ranks.get(data[ups[i]] + data[downs[j]])
            if crossing is not None and crossing < after_left and crossing <= after_right:
                known = False
                break
            if after_left == after_right == 1 << 62:
                break
            if after_left <= after_right:
                i += 1
            else:
                j += 1
        self._pairs[left << 32 | right] = known
        return known

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixTable:
    """The last token of every byte prefix of one pre-token; row i is for the first i + 1 bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def _solve(self, end: int, last: list[int]) -> int:
        """Tries the tokens that end here, shortest first; no longer one can once the bytes end none."""
        v, data = self.vocabulary, self.data
        endings, spines, pairs = v._endings, v._spines, v._pairs
        for start in range(end - 1, -1, -1):
            token = endings.get(data[start:end])
            if token is None:
                break
            if token < 0 or (spines[token] if token in spines else v.spines(token)) is None:
                continue
            if start == 0:
                return token
            known = pairs.get(last[start - 1] << 32 | token)
            if known or known is None and v.follows(last[start - 1], token):
                return token
        raise ValueError("the vocabulary lacks a single byte")

    def become(self, data: bytes) -> None:
        """Makes this the table of `data`, keeping the rows of the prefix that both share."""
        same, least = 0, min(len(data), len(self.data))
        while same < least and data[same] == self.data[same]:
            same += 1
        del self.last[same:]
        self.data = data[:same]
        self.append(data[same:])

    def append(self, more: bytes) -> None:
        at = len(self.data)
        self.data += more
        for end in range(at + 1, len(self.data) + 1):
            self.last.append(self._solve(end, self.last))

    def edit(self, start: int, stop: int, new: bytes) -> int:
        """Replaces bytes start to stop by `new`; returns how many rows were solved again."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        last, same = old[:start], 0
        while len(last) < len(self.data):
            end = len(last) + 1
            last.append(self._solve(end, last))
            same = same + 1 if end > start + len(new) and last[-1] == old[end - 1 - shift] else 0
            if same >= self.vocabulary.longest:
                break
        solved = len(last) - start
        self.last = last + old[len(last) - shift :]
        return solved

    def ids(self) -> list[int]:
        if self.data in self.vocabulary.ranks:
            return [self.vocabulary.ranks[self.data]]
        found, end = [], len(self.data)
        while end:
            found.append(self.last[end - 1])
            end -= len(self.vocabulary.bytes_of[found[-1]])
        return found[::-1]


class Encoder:
    """Encodes whole texts, remembering pre-tokens."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.split = regex.compile(pattern).findall
        self.solved: dict[str, list[int]] = {}

    def solve(self, pieces: set[str]) -> Iterator[tuple[str, list[int]]]:
        """The ids of each piece; in sorted order, so that each keeps the rows of the prefix it shares with the last."""
        table, ranks = PrefixTable(self.vocabulary), self.vocabulary.ranks
        for data, piece in sorted((p.encode(), p) for p in pieces):
            whole = ranks.get(data)
            if whole is not None:
                yield piece, [whole]
            else:
                table.become(data)
                yield piece, table.ids()

    def encode(self, text: str) -> list[int]:
        if len(self.solved) >= REMEMBERED:
            self.solved.clear()
        pieces = self.split(text)
        self.solved.update(self.solve(set(pieces).difference(self.solved)))
        return [i for p in pieces for i in self.solved[p]]


def encoder(path: str, pattern: str) -> Encoder:
    """This worker's encoder for a rank file."""
    store = worker_store()
    if ("bpe", path, pattern) not in store:
        store["bpe", path, pattern] = Encoder(Vocabulary.read(path), pattern)
    return store["bpe", path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array) and decoded (the bytes that the ids stand for) of every row."""

    def run(ids: list, bodies: list[str]) -> dict:
        e = encoder(path, pattern)
        found = [e.encode(t) for t in bodies]
        return {"doc_id": pa.array(ids, pa.int64()), "ids": pa.array(found, pa.list_(pa.int32())), "decoded": pa.array([e.vocabulary.decode(x) for x in found], pa.binary())}

    return map_texts(texts(docs, id_col, text_col), run, "doc_id long, ids array<int>, decoded binary")


def digest_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: the digests of `encode_documents`.

    Works per pre-token: its ids as text, their number and the bytes they decode to are put together once.
    """

    def run(ids: list, bodies: list[str]) -> dict:
        e = encoder(path, pattern)
        store: dict = worker_store().setdefault(("bpe digests", path, pattern), {})
        if len(store) >= REMEMBERED:
            store.clear()
        split = [e.split(t) for t in bodies]
        for piece, found in e.solve(set().union(*split).difference(store)):
            store[piece] = (",".join(map(str, found)).encode(), len(found), e.vocabulary.decode(found))
        n, hashes, decoded = [], [], []
        for pieces in split:
            known = [store[p] for p in pieces]
            n.append(sum([x[1] for x in known]))
            hashes.append(hashlib.sha256(b",".join([x[0] for x in known])).hexdigest())
            decoded.append(hashlib.sha256(b"".join([x[2] for x in known])).hexdigest())
        return {"doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": hashes, "decoded_sha256": decoded}

    return map_texts(texts(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
