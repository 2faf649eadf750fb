import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerly.llm import substring_dedup as S
from ledgerly.llm.queries import op7_count_min_substrings
from tests.llm.cases import crowded, frame, kept_words, sample_rows, words
from tests.llm.conftest import SF


def test_query(spark, sf_docs):
    got = {r["doc_id"]: r for r in op7_count_min_substrings(spark, SF).collect()}
    for (doc, text), kept in zip(sf_docs, kept_words([t for _, t in sf_docs]), strict=True):
        r = got[doc]
        assert (r["n_words"], r["n_removed"]) == (len(words(text)), len(words(text)) - len(kept))
        assert r["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_edge_cases_with_a_full_and_an_empty_sketch(spark):
    df = crowded(frame(spark))
    want = sorted(" ".join(k) for k in kept_words([t for _, t, *_ in sample_rows()]))
    for bits in (6, 20):  # a sketch without any selectivity stays exact
        rows = S.remove_repeats(df, sketch_bits=bits).collect()
        assert sorted(r["kept_text"] for r in rows) == want and rows[0]["Extra"] == "clash"
    assert S.remove_repeats(df.limit(0), sketch_bits=10).count() == 0


def test_short_windows(spark):
    texts = ["a b c a b c", "a a a a a", "b c a", "", None, "q w e r"]
    df = frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)])
    for width in (1, 2, 3, 5):
        got = {r["doc_id"]: r["kept_text"] for r in S.remove_repeats(df, width=width, sketch_bits=10).collect()}
        assert [got[i] for i in range(len(texts))] == [" ".join(k) for k in kept_words(texts, width)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), min_size=1, max_size=4),
       st.integers(1, 20))
def test_equal_windows_have_anchors_at_distinct_places(docs, width):
    """No underestimate: a window that occurs n times has an anchor hash that
    occurs at n or more places."""
    w = S.Windows([" ".join(d) for d in docs], width)
    gram, place = w.anchors()
    places = {}
    for g, p in zip(gram.tolist(), place.tolist(), strict=True):
        places.setdefault(g, set()).add(p)
    seen = {}
    flat = [x for d in docs for x in d]
    for s, g in zip(w.start.tolist(), gram.tolist(), strict=True):
        key = tuple(flat[s:s + width])
        seen.setdefault(key, []).append(g)
    for found in seen.values():
        assert len(set(found)) == 1 and len(places[found[0]]) >= len(found)


def test_anchor_ranges_beyond_the_bound(spark, sf_docs):
    """A small bound takes the anchors in three ranges; the result is the same."""
    docs = sf_docs[:120]
    df = frame(spark, [(i, t, "", "", 0) for i, t in docs])
    anchors, windows = S.count_anchors(df.select("text"), 35)
    assert 0 < anchors < windows
    bits = next(b for b in range(6, 30) if S.sketch_shape(anchors, b)[1] <= 3)
    assert S.sketch_shape(anchors, bits)[1] in (2, 3) and S.sketch_shape(anchors, 28)[1] == 1
    got = {r["doc_id"]: r["kept_text"] for r in S.remove_repeats(df, max_sketch_bits=bits).collect()}
    want = kept_words([t for _, t in docs])
    assert got == {i: " ".join(k) for (i, _), k in zip(docs, want, strict=True)}
    assert S.sketch_shape(0, 28) == (10, 1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \t\n\x0b\x1c\u00a0\u2003é"), max_size=300), max_size=5))
def test_word_hashes_tell_words_apart(texts):
    w = S.Windows(texts, 1)
    flat = [x for t in texts for x in t.encode().split()]
    assert w.counts.tolist() == [len(t.encode().split()) for t in texts] and len(w.hashes) == len(flat)
    assert len(set(w.hashes.tolist())) == len(set(flat))
    assert len(set(zip(flat, w.hashes.tolist(), strict=True))) == len(set(flat))


def test_word_hashes_over_spans():
    """Words at span edges, and words longer than a span, hash as anywhere."""
    texts = ["x" * S.SPAN + " aa " + "y" * (S.SPAN - 3) + " bb aa " + "cc " * S.SPAN, "aa bb cc", "z" * 200]
    w = S.Windows(texts, 1)
    flat = [x for t in texts for x in t.encode().split()]
    assert len(set(zip(flat, w.hashes.tolist(), strict=True))) == len(set(flat)) == len(set(w.hashes.tolist()))


def test_rolled_hashes_depend_on_the_words_alone():
    h = np.arange(100, dtype=np.uint64) * np.uint64(7919)
    twice = np.concatenate([h, h])
    for width in (1, 2, 3, 8, 28, 35):
        r = S._rolled(twice, width, 1)
        assert len(r) == 200 - width + 1 and (r[:100 - width + 1] == r[100:100 + 100 - width + 1]).all()
        assert len(set(r[:100 - width + 1].tolist())) == 100 - width + 1
