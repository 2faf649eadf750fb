import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerly.llm import vector_codes as V
from ledgerly.llm.queries import op13_equal_average_codes
from tests.llm.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, parts=4, entries=256, rounds=4):
    """Plain Python over rows of (vec_id, vector, label); all distances."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    order = sorted((r for r in kept if r[1] and len(r[1]) % parts == 0),
                   key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(order[0][1]) if order else 0
    width = dim // parts
    cut = {id(r): [[math.floor(1024 * x) if abs(x) < 2.0**52 else 1024 * int(x)
                    for x in r[1][p * width:(p + 1) * width]] for p in range(parts)]
           for r in order if len(r[1]) == dim}
    books = [[cut[id(r)][p] for r in order[:entries] if len(r[1]) == dim] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for x in cut.values():
                groups.setdefault(nearest(p, x[p])[1], []).append(x[p])
            new.append([[sum(c) // len(c) for c in zip(*groups[i])] if i in groups else e
                        for i, e in enumerate(books[p])])
        books = new
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    coded = []
    for r in kept:
        if id(r) in cut:
            found = [nearest(p, cut[id(r)][p]) for p in range(parts)]
            coded.append((r[0], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), r[2]))
        else:
            coded.append((r[0], None, None, r[2]))
    total = {}
    for _, _, error, label in coded:
        total[label] = (total.get(label) or 0) + error if error is not None else total.get(label)
    return sorted(((i, c, e, total[lab], digest) for i, c, e, lab in coded), key=repr)


def results(df):
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"])
                   for r in df.collect()), key=repr)


def vectors(n, dim=8, seed=0, spread=0.3):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-1, 1) for _ in range(dim)] for _ in range(5)]
    return [[float(np.float32(x + rnd.gauss(0, spread))) for x in rnd.choice(centres)] for _ in range(n)]


def test_search_finds_the_nearest():
    rnd = np.random.default_rng(3)
    for dim, spread in ((1, 20), (3, 4), (16, 400), (2, 1 << 27)):
        book = rnd.integers(-spread, spread, (200, dim))
        assert V._double_is_exact(book) == (spread < 1 << 20)
        part = np.concatenate([rnd.integers(-spread, spread, (500, dim)), book[:50]])
        distance = ((part[:, None, :] - book[None]) ** 2).sum(axis=2)
        index, best = V.Codebook(book).nearest(part)
        assert (index == distance.argmin(axis=1)).all() and (best == distance.min(axis=1)).all()
        index, best = V.Codebook(book.astype(object)).nearest(part[:60].astype(object))
        assert (index == distance[:60].argmin(axis=1)).all() and (best == distance[:60].min(axis=1)).all()


def test_search_ends_early(monkeypatch):
    monkeypatch.setattr(V, "WALK_ENTRIES", 1)
    book = V.Codebook(np.array([[1 << 29], [0], [10], [-300]]))
    seen = []
    walk = book._walk

    def watched(x, own, ordered, squares):
        class Looked(np.ndarray):
            def __getitem__(self, key):
                seen.append(key)
                return np.asarray(self)[key]
        return walk(x, own, ordered.view(Looked), squares)

    book._walk = watched
    index, best = book.nearest(np.array([[4], [6], [5]]))
    assert index.tolist() == [1, 2, 1] and best.tolist() == [16, 16, 25]
    # by sum: -300, 0, 10, 2^29; the ends are never looked at
    assert {(s.start, s.stop) for s in seen} == {(1, 2), (2, 3)}


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in rows]
    assert results(op13_equal_average_codes(spark, SF)) == expected(rows)


def test_fit_over_many_tasks(spark):
    rows = [(i, v, i % 3 or None) for i, v in enumerate(vectors(400))]
    df = spark.createDataFrame(rows, SCHEMA)
    want = expected(rows, entries=16)
    assert results(V.compress_vectors(df.repartition(7), entries=16)) == want
    assert results(V.compress_vectors(df.coalesce(1), entries=16, most_labels=0)) == want


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(30))]
    rows += rows[:3]                                            # repeated rows
    rows += [(None, vectors(1, seed=9)[0], None), (31, None, 1), (32, [], 1), (33, [1.0] * 7, 5),
             (34, [1.0] * 4, 5), (35, [None] + [1.0] * 7, 1), (36, [nan] + [1.0] * 7, 1),
             (37, [-inf] + [1.0] * 7, 1), (38, [0.0] * 8, None), (39, [-1e-9] * 8, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert results(V.compress_vectors(df)) == expected(rows)


def test_huge_components(spark):
    rows = [(i, v, 0) for i, v in enumerate(vectors(12))] + [(20, [3e38] * 8, 0), (21, [-3e38, 1e20] * 4, 1)]
    wide = spark.createDataFrame(rows, SCHEMA.replace("float", "double"))
    got = results(V.compress_vectors(wide))
    want = [(i, c, e if e < 1 << 63 else None, s if s < 1 << 63 else None, d)
            for i, c, e, s, d in expected(rows)]
    assert got == sorted(want, key=repr)


def test_extra_columns_and_empty_table(spark):
    rows = [(i, v, i % 2) for i, v in enumerate(vectors(20))]
    df = spark.createDataFrame(rows, SCHEMA)
    crowded = df.select("*", *[F.lit("x").alias(c) for c in ("code", "error", "label_error", "slot", "Extra")])
    got = V.compress_vectors(crowded)
    assert results(got) == expected(rows) and got.first()["Extra"] == "x" and got.first()["slot"] == "x"
    empty = V.compress_vectors(df.limit(0))
    assert empty.count() == 0 and {"code", "error", "label_error", "codebooks_sha256"} <= set(empty.columns)
