"""Token ids of a public byte-level BPE vocabulary file.

The vocabulary is read from the tokenizer's JSON file whose path is a parameter. A byte-level BPE whose ids follow its
merge order gives the same ids through a rank table, several times faster; that path is used for texts whose characters
all lie below U+0250, where the two libraries' character classes agree, and that hold no added token's string, and the JSON
tokenizer itself for all others. Tests hold the two against each other.
"""

from __future__ import annotations

import json
import os
import re
from functools import cached_property

import numpy as np

#: Fixed value: the split pattern that byte-level BPE files of this kind are made with.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ODD = re.compile("[^\x09\x0a\x0d\x20-\x7e\xa1-\xac\xae-ɏ]")
_CACHE: dict[str, "Encoder"] = {}


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts; either library's tables are loaded when a text first needs them."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec.get("model", {}).get("vocab", {})
        ids = [*(vocab.values() if isinstance(vocab, dict) else range(len(vocab))), *(x["id"] for x in spec.get("added_tokens", []))]
        self.width = 2 if ids and max(ids) < 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.added = [x["content"] for x in spec.get("added_tokens", []) if x["content"]]
        self.fast = self._ranks(spec)

    @cached_property
    def slow(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    @staticmethod
    def _ranks(spec: dict):
        import tiktoken

        model, pre = spec.get("model", {}), spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer") or pre.get("add_prefix_space"):
            return None
        special = {x["content"] for x in spec.get("added_tokens", [])}
        alphabet = _byte_alphabet()
        try:
            ranks = {bytes(alphabet[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
            return tiktoken.Encoding("byte_bpe", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
        except (KeyError, ValueError):
            return None

    def ids(self, text: str) -> list[int]:
        if self.fast is not None and not _ODD.search(text) and not any(x in text for x in self.added):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


def encoder(path: str) -> Encoder:
    """One encoder for each path and Python worker."""
    if path not in _CACHE:
        _CACHE[path] = Encoder(path)
    return _CACHE[path]
