"""Cross-tokenizer alignment (op 13)."""

import bisect
import collections
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer
from rollcall.llm import alignment as al, queries
from rollcall.llm.bytelevel import ByteLevel, by_rank

PATHS = (P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    token = ByteLevel(PATHS[0]).bytes

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def document(text):
        """Ids of both, links and groups, by comparing all byte ranges within a group; None without tokens."""
        if not text:
            return None
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts = [token[i] for i in ids[0]], [piece(i) for i in ids[1]]
        if any(b"".join(p) != (" " + text).encode() for p in parts):
            return None
        x, y = ([0, *np.cumsum([len(p) for p in side]).tolist()] for side in parts)
        both = sorted(set(x) & set(y))
        groups, links = [], []
        for low, high in zip(both, both[1:], strict=False):
            i, j = (range(bisect.bisect_left(e, low), bisect.bisect_left(e, high)) for e in (x, y))
            groups.append(",".join(str(ids[0][k]) for k in i) + "|" + ",".join(str(ids[1][k]) for k in j))
            links += [(ids[0][k], ids[1][m]) for k in i for m in j if max(x[k], y[m]) < min(x[k + 1], y[m + 1])]
        return len(ids[0]), len(ids[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    def corpus(rows):
        found = [(d, document(t)) for d, t in rows]
        count = collections.Counter(p for _, f in found if f for p in set(f[3]))
        best = {}
        for (i, _), n in count.items():
            best[i] = max(best.get(i, 0), n)
        out = []
        for d, f in found:
            out.append((d, 0, 0, 0, 0, 0, 0, "") if f is None else (d, *f[:3], len(f[3]), sum(count[p] == best[p[0]] for p in f[3]), sum(count[p] for p in f[3]), f[4]))
        return sorted(out, key=repr), count, best

    return corpus


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_against_brute_force(spark, tables, docs, plain):
    want, _, _ = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(queries.op13_spill_counted_alignment(spark, tables)) == want


def test_many_spills_and_passes(spark, docs, plain):
    """Spills of a few hundred records, three digits and at most two runs in a pass give the same."""
    some = docs.repartition(5)
    want, count, best = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(al.align_documents(some, *PATHS, fan=2, parts=3, spill_records=20_000)) == want
    runs = al.spill(some, *PATHS, parts=3, spill_records=20_000)
    assert runs.filter("part is not null").count() > 12
    got = rows_of(al.pair_counts(al.count_pairs(runs, fan=2)))
    assert got == sorted(((a, b, n, n == best[a]) for (a, b), n in count.items()), key=repr)


TEXTS = [
    "a", " a", "a ", "a  b", "  a\n\nb", "a \nb", "a\n b", "\n", "\na", "a\n", "a\n\n\nb c", "x\t y\tz", "tab\t\nline", "<|endoftext|> and <s> </s> <unk>", "don't we'll", "日本語 テキスト\n日本",
    "a▁b", "fine words then▁mark", "é é ü x  y", "　wide", "a\x00b", "🙂 🙂🙂 x", "1234567 89", "a" * 3000, "word " * 500, "!!! ??? ...", "\r\nx\r\ny", " ", "   ", "x\x1cy \x1c z",
    "ﬁne ① ²", "Á b", "​ x", "end\n ", " x  ",
]


def test_texts_that_cannot_be_taken_apart(spark, plain):
    rows = list(enumerate(TEXTS))
    assert rows_of(al.align_documents(spark.createDataFrame(rows, "doc_id long, text string"), *PATHS)) == plain(rows)[0]


def test_odd_rows(spark, odd_docs, no_docs, plain):
    assert al.align_documents(no_docs, *PATHS).collect() == []
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert rows_of(al.align_documents(odd_docs, *PATHS)) == plain(rows)[0]


@pytest.mark.parametrize("block", [1, 3, 8192])
def test_heap_merge(block, monkeypatch):
    monkeypatch.setattr(al, "BLOCK", block)
    rng = np.random.default_rng(block)
    runs, want = [], collections.Counter()
    for _ in range(7):
        keys = np.unique(rng.integers(0, 60, rng.integers(0, 40))) << (al.ID_BITS - 3)
        counts = rng.integers(1, 5, len(keys))
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        runs.append(al._blocks(keys, counts))
    got = [(int(k), int(c)) for keys, counts in al.merged(al._heads(r) for r in runs) for k, c in zip(keys, counts, strict=True)]
    assert got == sorted(want.items())
    most = {}
    for k, c in want.items():
        most[k >> al.ID_BITS] = max(most.get(k >> al.ID_BITS, 0), c)
    judged = [(int(k), bool(b)) for keys, _, best in al.with_best(al.merged(al._heads(r) for r in runs)) for k, b in zip(keys, best, strict=True)]
    assert judged == [(k, c == most[k >> al.ID_BITS]) for k, c in sorted(want.items())]


def test_files_that_ranks_cannot_stand_for():
    import json

    file = json.loads(Tokenizer.from_file(PATHS[0]).to_str())
    assert by_rank(file)
    swapped = {**file, "model": {**file["model"], "merges": file["model"]["merges"][1::-1] + file["model"]["merges"][2:]}}
    assert not by_rank(swapped)
    assert not by_rank({**file, "pre_tokenizer": None})
    assert not by_rank({**file, "normalizer": {"type": "NFC"}})
