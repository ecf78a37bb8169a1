"""Token ids of byte-level vocabularies."""

from __future__ import annotations

import json
import os
import re

#: The split of a byte-level vocabulary (fixed values): the parts with text, and white space.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
SPACES = r"\s+(?!\S)|\s+"
#: Characters that all Unicode versions class alike; texts with others go through the tokenizer itself.
PLAIN = re.compile("[\x00-\u024f\u2010-\u205e\u20ac]*").fullmatch
#: White space that stands beside white space. Without it, the split needs no look ahead, which is much faster.
WIDE = re.compile(r"\s\s").search


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte: printable ones for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteLevel:
    """Ids by the tokenizer at ``path``. Texts of plain characters take a faster library with the same merges; it needs
    ids that follow the merges, a vocabulary of another build is refused. ``marks``: strings of special tokens inside
    texts become those tokens, as the tokenizer does by default; otherwise they are plain text."""

    def __init__(self, path: str, marks: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, split = spec["model"]["vocab"], spec["pre_tokenizer"] or {}
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or merged != sorted(merged):
            raise ValueError(f"{path} is no byte-level vocabulary in the order of its merges")
        spelt = byte_characters()
        self.bytes = {i: bytes(spelt[c] for c in token) for token, i in vocab.items() if all(c in spelt for c in token)}
        ranks = {b: i for i, b in self.bytes.items()}
        self.wide, self.narrow = (tiktoken.Encoding("byte level", pat_str=f"{PARTS}|{spaces}", mergeable_ranks=ranks, special_tokens={})
                                  for spaces in (SPACES, r"\s"))
        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = not marks
        self.marks = [t["content"] for t in spec["added_tokens"]] if marks else []

    def ids(self, text: str) -> list[int]:
        if not PLAIN(text) or any(mark in text for mark in self.marks):
            return self.exact.encode(text, add_special_tokens=False).ids
        return (self.wide if WIDE(text) else self.narrow).encode_ordinary(text)
