import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerly.llm import bpe_trie, token_counts
from ledgerly.llm.queries import VOCABULARY, op2_heap_token_counts, op3_trie_bpe
from tests.llm.cases import crowded, frame, sample_rows
from tests.llm.conftest import SF

LIBRARY = Tokenizer.from_file(VOCABULARY)
#: White space other than space and newline.
OTHER_SPACE = "".join(c for c in map(chr, range(0x110000)) if c not in " \n" and c.isspace())


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_op2_equals_the_library(spark, sf_docs):
    got = {r["doc_id"]: r for r in op2_heap_token_counts(spark, SF).collect()}
    assert len(got) == len(sf_docs)
    for doc, text in sf_docs:
        n = len(ids_of(text))
        r = got[doc]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((text or "").encode()), n, n > 512)


def test_op3_equals_the_library(spark, sf_docs):
    got = {r["doc_id"]: r for r in op3_trie_bpe(spark, SF).collect()}
    for doc, text in sf_docs:
        ids = ids_of(text)
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        r = got[doc]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_edge_cases(spark):
    df = crowded(frame(spark))
    counted = token_counts.count_tokens(df, VOCABULARY).collect()
    encoded = bpe_trie.decode_documents(bpe_trie.encode_documents(df, VOCABULARY), VOCABULARY).collect()
    assert len(counted) == len(encoded) == len(sample_rows())
    for r in counted:
        assert r["n_tokens"] == len(ids_of(r["text"])) and r["Extra"] == "clash"
    for r in encoded:
        assert np.frombuffer(r["token_ids"], "<u4").tolist() == ids_of(r["text"])
        assert r["decoded_text"] == (r["text"] or "")
    at_once = bpe_trie.encode_documents(df, VOCABULARY, decoded="kept_text")
    assert sorted((r["token_ids"], r["kept_text"]) for r in at_once.collect()) == sorted(
        (r["token_ids"], r["decoded_text"]) for r in encoded)
    none = df.limit(0)
    assert token_counts.count_tokens(none, VOCABULARY).count() == 0
    assert bpe_trie.encode_documents(none, VOCABULARY).count() == 0


def test_invalid_ids_decode_with_replacement(spark):
    half = np.array(ids_of("é")[:1], "<u4")  # perhaps half a character
    raw = np.array([LIBRARY.token_to_id("Ã")], "<u4")
    df = spark.createDataFrame([(bytearray(half.tobytes()),), (bytearray(raw.tobytes()),), (None,)],
                               "token_ids binary")
    got = [r["decoded_text"] for r in bpe_trie.decode_documents(df, VOCABULARY).collect()]
    assert got == [LIBRARY.decode(half.tolist(), skip_special_tokens=False),
                   LIBRARY.decode(raw.tolist(), skip_special_tokens=False), ""]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abetonrs '.\n\t<|>é漢1 "), st.characters(
    exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    ids = ids_of(text)
    assert token_counts.counter(VOCABULARY).text(text) == len(ids)
    assert np.frombuffer(bpe_trie.encoder(VOCABULARY).encode_texts([text])[0], "<u4").tolist() == ids


def test_white_space_that_offsets_an_empty_run(spark):
    texts = ["a\tb\n", "a\n\nb\u00a0c", "a b\tc\td", "a  b\tc", "\na\rb", "a \u3000b\x1cc", "a\x85\nb c"]
    df = frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)])
    counted = token_counts.count_tokens(df, VOCABULARY).collect()
    encoded = bpe_trie.decode_documents(bpe_trie.encode_documents(df, VOCABULARY), VOCABULARY).collect()
    assert [r["n_tokens"] for r in sorted(counted)] == [len(ids_of(t)) for t in texts]
    for r in encoded:
        assert np.frombuffer(r["token_ids"], "<u4").tolist() == ids_of(r["text"])
        assert r["decoded_text"] == r["text"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'. \n" + OTHER_SPACE), max_size=12))
def test_any_white_space(text):
    ids = ids_of(text)
    assert token_counts.counter(VOCABULARY).text(text) == len(ids)
    assert np.frombuffer(bpe_trie.encoder(VOCABULARY).encode_texts([text])[0], "<u4").tolist() == ids


def test_long_words_and_small_caches():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcdeinorst") for _ in range(n)) for n in (70, 500, 20_000)]
    texts += [" ".join("".join(rnd.choice("aeinrst") for _ in range(rnd.randrange(1, 9)))
                       for _ in range(300)) for _ in range(20)]
    e, c = bpe_trie.TrieEncoder(bpe_trie.load(VOCABULARY)), token_counts.Counter(bpe_trie.load(VOCABULARY))
    e.packed.most = c.count.most = 50  # many generations
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode_texts(texts)] == list(map(ids_of, texts))
    assert [c.text(t) for t in texts] == [len(ids_of(t)) for t in texts]
    assert len(e.packed) <= 50 and len(c.count) <= 50
