"""BPE encoding by prefix-sharing trie traversal, and decoding.

The distinct new words of a batch go into a byte trie. A depth-first walk
carries, for each prefix on the current path, the last token of that prefix's
encoding: the only token that ends here, starts where a shorter prefix ends,
and may follow that prefix's own last token. Encodings of shared prefixes are
therefore computed once, and a word's encoding is read back along the path.

Whether token b may follow token a is decided from the merge ranks alone:
undoing the merges at the seam, latest first, must never meet a pair that
would have been merged across the seam before one of its sides was used up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerly.llm.common import flatten, without
from ledgerly.llm.vocabulary import CACHE_CHARS, ID_BITS, Recent, Vocabulary, load

#: Words kept in one generation of a worker's cache.
CACHE_WORDS = 1 << 18
#: Distinct words inserted into one trie at most; more go into the next one.
TRIE_WORDS = 1 << 15
#: Bounds of the tables that fill up with use: added automaton steps, known seams.
MOST_STEPS, MOST_SEAMS = 1 << 18, 1 << 18
_NEVER = 1 << 60


class TrieEncoder:
    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        # Of each merged token: its rank and its two parts.
        self.made = {t: r for r, t in enumerate(vocab.merged)}
        self.left = {vocab.merged[r]: pair >> ID_BITS for pair, r in vocab.rank.items()}
        self.right = {vocab.merged[r]: pair & (1 << ID_BITS) - 1 for pair, r in vocab.rank.items()}
        if any(self.made.get(p, -1) >= r for t, r in self.made.items()
               for p in (self.left[t], self.right[t])):
            raise ValueError("a merge uses a token that a later merge makes")
        #: right token -> {left token: whether the seam holds}
        self.known_seams: dict[int, dict[int, bool]] = {}
        self.seams = 0
        self._build_automaton([*vocab.byte_id, *(
            t for t, r in self.made.items() if self._seam_holds(self.left[t], self.right[t], r, r))])
        self.packed = Recent(self._encode_word, CACHE_WORDS)

    def _build_automaton(self, tokens: list[int]) -> None:
        """Suffix automaton (Aho-Corasick) over the tokens that BPE can make at
        all: a state stands for the longest token prefix that ends here, and
        ``enders`` has the tokens that end here with their lengths, longest
        first. ``step`` (by state, then byte) grows as missing transitions are met."""
        self.step: list[dict[int, int]] = [{}]
        self.steps = 0
        self.enders: list[list[tuple[int, int]]] = [[]]
        self.fail = [0]
        layers: list[list[tuple[int, int, int]]] = [[]]
        for t in tokens:
            s = 0
            for depth, byte in enumerate(self.vocab.token_bytes[t]):
                if byte not in self.step[s]:
                    self.step[s][byte] = len(self.enders)
                    self.step.append({})
                    self.enders.append([])
                    self.fail.append(0)
                    while len(layers) <= depth:
                        layers.append([])
                    layers[depth].append((s, byte, self.step[s][byte]))
                s = self.step[s][byte]
            self.enders[s].append((t, depth + 1))
        for layer in layers:
            for parent, byte, s in layer:
                if parent:
                    self.fail[s] = self._next(self.fail[parent], byte)
                    self.enders[s] = self.enders[s] + self.enders[self.fail[s]]

    def _next(self, state: int, byte: int) -> int:
        first = state
        while (found := self.step[state].get(byte)) is None and state:
            state = self.fail[state]
        found = found or 0
        if self.steps < MOST_STEPS and byte not in self.step[first]:
            self.step[first][byte] = found
            self.steps += 1
        return found

    def _seam_holds(self, a: int, b: int, use_a: int, use_b: int) -> bool:
        """No merge crosses the seam between tokens a and b, which other merges
        use up at ranks use_a and use_b. Equal ranks: the left pair goes first."""
        rank, made = self.vocab.rank, self.made
        while True:
            r = rank.get(a << ID_BITS | b)
            if r is not None and r < use_a and r <= use_b:
                return False
            made_a, made_b = made.get(a, -1), made.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                use_a, a = made_a, self.right[a]
            else:
                use_b, b = made_b, self.left[b]

    def follows(self, a: int, b: int) -> bool:
        known = self.known_seams.setdefault(b, {}).get(a)
        if known is None:
            if self.seams >= MOST_SEAMS:
                self.known_seams.clear()
                self.seams = 0
            known = self._seam_holds(a, b, _NEVER, _NEVER)
            self.known_seams.setdefault(b, {})[a] = known
            self.seams += 1
        return known

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Packed ids of each distinct word, through one trie.

        The trie is kept as its words in byte order, which is its depth-first
        order: a word's path starts with the path that it shares with the word
        before it, and only the nodes after that are new."""
        special, out = self.vocab.special, {}
        trie = sorted([(w.encode(), w) for w in words if w not in special])
        for w in words:
            if w in special:
                out[w] = _packed([special[w]])
        step, enders, seams, none = self.step, self.enders, self.known_seams.get, {}
        # Of each prefix on the path: the automaton's state, the last token,
        # and where that token starts.
        room = max((len(raw) for raw, _ in trie), default=0) + 1
        states, last, start = [0] * room, [-1] * room, [0] * room
        before = b""
        for raw, word in trie:
            shared = 0
            for x, y in zip(before, raw):  # noqa: B905 - one is longer
                if x != y:
                    break
                shared += 1
            before, state, depth = raw, states[shared], shared
            for byte in raw[shared:]:
                following = step[state].get(byte)
                state = self._next(state, byte) if following is None else following
                depth += 1
                for token, size in enders[state]:
                    at = depth - size
                    if not at:
                        break
                    holds = seams(token, none).get(last[at])
                    if holds or holds is None and self.follows(last[at], token):
                        break
                states[depth], last[depth], start[depth] = state, token, at
            ids = []
            while depth:
                ids.append(last[depth])
                depth = start[depth]
            ids.reverse()
            out[word] = _packed(ids)
        return out

    def _encode_word(self, word: str) -> bytes:
        return self.encode_words([word])[word]

    def encode_texts(self, texts: list[str | None]) -> list[bytes]:
        """Packed ids of whole texts: the words not yet known go through tries
        together, and then every text is put together from its words. The ids
        of all words of these texts are held beside the cache, so a word is
        encoded once here however small the cache is."""
        known, words_of = self.packed, self.vocab.words
        split = [words_of(t) if t else [] for t in texts]
        ids = {w: known.peek(w) for w in set().union(*split)}
        new = sorted(w for w, packed in ids.items() if packed is None)
        for i in range(0, len(new), TRIE_WORDS):
            for w, packed in self.encode_words(new[i:i + TRIE_WORDS]).items():
                ids[w] = packed
                if len(w) <= CACHE_CHARS:
                    known.put(w, packed)
        return [b"".join(map(ids.__getitem__, words)) for words in split]


def _packed(ids: list[int]) -> bytes:
    return pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=4)
def encoder(path: str) -> TrieEncoder:
    return TrieEncoder(load(path))


#: Characters of text handled together at most (a longer text stands alone),
#: and texts decoded together.
CHUNK_CHARS, DECODE_ROWS = 1 << 20, 512


def chunks(texts: Iterable[str | None], most: int = CHUNK_CHARS) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t or "") > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t or "")
    if part:
        yield part


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text",
                     decoded: str | None = None) -> DataFrame:
    """``docs`` plus ``n_tokens`` and ``token_ids`` (binary: the ids as
    little-endian unsigned 32-bit integers, the layout of training shards), and
    the text decoded from these ids if ``decoded`` names a column for it (the
    same as ``decode_documents``, without a second trip through Python).

    Added tokens' strings inside a text become their ids; nothing is added,
    cut or padded. Null and empty texts have no ids (empty binary). Every row
    is encoded on its own, so ties and repeated rows change nothing. Map-only."""
    back = f"`{decoded}` string" if decoded else ""

    @pandas_udf("n_tokens long, token_ids binary" + (f", {back}" if back else ""))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        e = encoder(vocabulary)
        for texts in batches:
            for part in chunks(texts):
                ids = e.encode_texts(part)
                out = {"n_tokens": [len(x) // 4 for x in ids], "token_ids": ids}
                if decoded:
                    out[decoded] = [decode_ids(x, e.vocab) for x in ids]
                yield pd.DataFrame(out)

    names = {"n_tokens", "token_ids", *([decoded] if decoded else [])}
    base = without(docs, *names - {text})
    return flatten(base.withColumn("__encoded", encode(F.col(f"`{text}`"))), "__encoded")


def decode_ids(packed: bytes | None, vocab: Vocabulary) -> str:
    ids = np.frombuffer(packed or b"", "<u4").tolist()
    return b"".join(map(vocab.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def decode_documents(encoded: DataFrame, vocabulary: str, ids: str = "token_ids",
                     out: str = "decoded_text") -> DataFrame:
    """``encoded`` plus the text of the packed ids; added tokens give their
    strings, byte sequences that are no UTF-8 the replacement character. Null
    ids give an empty text."""

    @pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = load(vocabulary)
        for packed in batches:
            for at in range(0, len(packed), DECODE_ROWS):
                yield pd.Series([decode_ids(x, vocab) for x in packed.iloc[at:at + DECODE_ROWS]],
                                dtype="object")

    return without(encoded, out).withColumn(out, decode(F.col(f"`{ids}`")))
