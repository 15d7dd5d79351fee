"""Byte-level BPE (op 3) and packing (op 1), against the public libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from rollcall.llm import bpe, packing, queries

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
IDS = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(RANKS)


@pytest.fixture(scope="module")
def judge(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_query_against_tiktoken(spark, tables, texts_of, judge):
    got = {r.doc_id: r for r in queries.op3_prefix_bpe(spark, tables).collect()}
    for doc_id, text in texts_of:
        ids = judge.encode_ordinary(text)
        assert got[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é\n\t0!ß漢🙂'sthe \x1c\x85́ "), max_size=60))
def test_any_text(vocabulary, judge, text):
    e = bpe.Encoder(vocabulary, public_tokenizers.PATTERN)
    ids = e.encode(text)
    assert ids == judge.encode_ordinary(text)
    assert vocabulary.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 1500, " " * 999, "漢" * 500])
def test_long_pieces(vocabulary, judge, text):
    assert bpe.Encoder(vocabulary, public_tokenizers.PATTERN).encode(text) == judge.encode_ordinary(text)


def test_edits_and_appends(vocabulary):
    rng = random.Random(5)
    for _ in range(150):
        data = "".join(rng.choice(["a", "the", "ing", "é", "漢", "er", " "]) for _ in range(rng.randint(0, 60))).encode()
        table = bpe.PrefixTable(vocabulary, data)
        begin = rng.randint(0, len(data))
        end, new = rng.randint(begin, len(data)), rng.choice([b"", b"x", b"theing"])
        table.edit(begin, end, new)
        fresh = bpe.PrefixTable(vocabulary, data[:begin] + new + data[end:])
        assert (table.last, table.ids()) == (fresh.last, fresh.ids())
        table.append(b"ings")
        fresh.append(b"ings")
        assert table.last == bpe.PrefixTable(vocabulary, table.data).last == fresh.last


def test_edit_solves_only_near_rows(vocabulary):
    table = bpe.PrefixTable(vocabulary, b"thequickbrown" * 400)
    assert table.edit(100, 101, b"z") <= 4 * vocabulary.longest


def test_encode_odd_documents(odd_docs, no_docs, judge):
    rows = bpe.encode_documents(odd_docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == odd_docs.count()
    assert all(judge.decode_bytes(r.ids) == bytes(r.decoded) for r in rows)
    digests = bpe.digest_documents(odd_docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(len(r.ids) for r in rows) == sorted(r.n_tokens for r in digests)
    assert bpe.digest_documents(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_word_tokens_are_those_of_the_library():
    tokenizer, words = Tokenizer.from_file(IDS), packing.WordTokens(IDS)
    rng = random.Random(3)
    parts = ["a", "é", "  ", "\n", "\t", "0", "!", "漢", "🙂", " ", " ", "\x1c", "\x85", "'s", "the", "́", "<|endoftext|>", "\xa0"]
    some = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + ["", " ", "a ", " a", "\n"]
    for text, got in zip(some, words.encode(some), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check_packing(rows, texts, capacity=1024, max_documents=None):
    tokenizer = Tokenizer.from_file(IDS)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert sum(r.length for r in own) == len(ids) and all(r.length == capacity for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for own in sequences.values():
        own.sort()
        assert [a for a, _ in own] == np.cumsum([0, *(n for _, n in own)])[:-1].tolist()
        assert sum(n for _, n in own) <= capacity and (max_documents is None or len(own) <= max_documents)
    return len(sequences)


def test_packing_query(spark, tables, texts_of):
    rows = queries.op1_best_fit_packing(spark, tables).collect()
    n = check_packing(rows, texts_of)
    assert n <= -(-sum(r.length for r in rows) // 1024) * 1.01 + 1


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(docs, texts_of, rule):
    rows = packing.pack_documents(docs, IDS, max_documents=3, max_cost=1024 * 1024, weights=(1.0, 0.5, 0.2), rule=rule).collect()
    check_packing(rows, texts_of, max_documents=3)


def test_cost_binds():
    table = packing.plan({10: 7, 6: 5}, (100, 100, 136))
    used = {}
    for length, _, n, sequence, each, _ in table.tolist():
        for k in range(n):
            used[sequence + k // each] = used.get(sequence + k // each, 0) + length * length
    assert max(used.values()) <= 136 and len(used) == 7
    with pytest.raises(ValueError, match="does not fit"):
        packing.plan({10: 1}, (100, 100, 99))


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), min_size=1, max_size=12), st.integers(1, 6), st.sampled_from(["norm", "dot"]))
def test_plan_places_every_piece_once(counts, places, rule):
    table = packing.plan(counts, (50, places, 2500), rule=rule)
    spans, held = {}, {}
    for length, first, n, sequence, each, offset in table.tolist():
        for k in range(n):
            spans.setdefault(sequence + k // each, []).append((offset + k % each * length, length))
            held.setdefault(length, []).append(first + k)
    assert {k: sorted(v) for k, v in held.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert sorted(spans) == list(range(len(spans)))
    for own in spans.values():
        own.sort()
        assert [a for a, _ in own] == np.cumsum([0, *(n for _, n in own)])[:-1].tolist()
        assert sum(n for _, n in own) <= 50 and len(own) <= places


def test_pack_odd_documents(odd_docs, no_docs):
    rows = packing.pack_documents(odd_docs, IDS).collect()
    assert sum(r.piece == 0 for r in rows) == odd_docs.count()
    assert sorted(r.length for r in rows if r.doc_id in (2, 3)) == [1, 1]
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sorted(s)[k][0] == sum(n for _, n in sorted(s)[:k]) for s in spans.values() for k in range(len(s)))
    assert packing.pack_documents(no_docs, IDS).count() == 0
