"""A byte-level BPE vocabulary file (``tokenizers`` JSON) as plain tables.

Only the fields the operators need are read: the vocabulary, the ranked merges
and the added tokens. The file's path is a parameter; it is read once per
Python worker and never copied.
"""

from __future__ import annotations

import json
from functools import lru_cache

import regex

# Fixed value: the pre-tokenising pattern of the byte-level tokenizers.
WORD_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                r"|\s+(?!\S)|\s+")

#: Room for one id where a pair of ids is one integer.
ID_BITS = 24


def _byte_symbols() -> dict[str, int]:
    """Printable stand-in character -> byte, by the byte-level rule: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tables of one byte-level BPE file.

    ``byte_id[b]``  id of the single-byte token of byte ``b``
    ``rank``        ``left id << ID_BITS | right id`` -> rank of the merge
    ``merged``      rank -> merged id
    ``byte_pair_rank``  ``left byte << 8 | right byte`` -> rank of the merge or None
    ``token_bytes`` id -> bytes of the token
    ``special``     text of an added token -> id
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec["normalizer"]
                or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or model.get("dropout") or model.get("ignore_merges")):
            raise ValueError(f"{path}: only plain byte-level BPE vocabularies are supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens with strip or word flags are not supported")
        symbols, vocab = _byte_symbols(), model["vocab"]
        self.token_bytes = {i: bytes(symbols[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        self.byte_id = [vocab[c] for c, _ in sorted(symbols.items(), key=lambda x: x[1])]
        self.byte_pair_rank: list[int | None] = [None] * (1 << 16)
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[left] << ID_BITS | vocab[right]] = rank
            self.merged.append(vocab[left + right])
            if len(left) == len(right) == 1:
                self.byte_pair_rank[symbols[left] << 8 | symbols[right]] = rank
        self._words = regex.compile(WORD_PATTERN)
        self._special = (regex.compile("(" + "|".join(map(regex.escape, sorted(
            self.special, key=len, reverse=True))) + ")") if self.special else None)

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text, in order; added tokens stand alone."""
        if self._special is None or not self._special.search(text):
            return self._words.findall(text)
        out: list[str] = []
        for i, part in enumerate(self._special.split(text)):
            if i % 2:
                out.append(part)
            else:
                out.extend(self._words.findall(part))
        return out


class Recent(dict):
    """A cache bounded by two generations: when the young one is full it becomes
    the old one, so what is used often stays. A missing key is computed."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > CACHE_CHARS:
                return value
        self.put(key, value)
        return value

    def peek(self, key):
        """The kept value, or None."""
        value = self.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value


#: Longest word (characters) that a cache keeps.
CACHE_CHARS = 64


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)
