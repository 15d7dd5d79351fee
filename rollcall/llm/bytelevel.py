"""A byte-level BPE file as an encoder without special tokens, and the bytes of its tokens.

Where the file's parts say that its merges are numbered in the order of its ids and that it splits texts by the usual pattern
alone, the rank library encodes with the file's own vocabulary, which is quicker; else the `tokenizers` library does.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

#: Fixed value: the pattern of byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        # the characters that stand for bytes: the printable ones for themselves, the others in ascending order
        stand = sorted(pre_tokenizers.ByteLevel.alphabet(), key=ord)
        kept = {ord(c) for c in stand if ord(c) < 256}
        others = iter(c for c in stand if ord(c) >= 256)
        byte_of = {chr(x) if x in kept else next(others): x for x in range(256)}
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        vocabulary = {t: i for t, i in tokenizer.get_vocab(with_added_tokens=False).items() if t not in special}
        self.bytes = [b""] * tokenizer.get_vocab_size()
        for t, i in vocabulary.items():
            self.bytes[i] = bytes(byte_of[c] for c in t)
        self.encode: Callable[[str], list[int]]
        if by_rank(json.loads(tokenizer.to_str())):
            ranks = {self.bytes[i]: i for i in vocabulary.values()}
            self.encode = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def by_rank(file: dict) -> bool:
    """Whether ids may serve as ranks: one merge for each longer token, in the order of ids, and the usual pattern alone."""
    model, before = file["model"], file["pre_tokenizer"]
    plain = model["type"] == "BPE" and not file["normalizer"] and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
    split = before and before["type"] == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if not (plain and split):
        return False
    made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    return None not in made and all(x < y for x, y in zip(made, made[1:], strict=False))

