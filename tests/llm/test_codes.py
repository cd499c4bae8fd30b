import hashlib

import numpy as np
import pytest

from tidemark.llm import codes


def brute(rows, parts=16, entries=64, rounds=2):
    """(id, code, error) and the codebooks, one part at a time, in Python integers."""
    import math

    sound = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = sorted(((i is None, i or 0), [math.floor(256 * x) for x in v]) for i, v in sound)
    d = len(ints[0][1]) // parts if ints else 0
    cut = [[tuple(v[p * d : p * d + d]) for p in range(parts)] for _, v in ints]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = {}
            for v in cut:
                own.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            new.append([tuple(sum(c) // len(own[k]) for c in zip(*own[k], strict=True)) if k in own else e for k, e in enumerate(books[p])])
        books = new
    found = [[nearest(v[p], books[p]) for p in range(parts)] for v in cut]
    text = ",".join(str(c) for book in books for e in book for c in e)
    out = [(None if i[0] else i[1], "".join(f"{k:02x}" for _, k in f), sum(e for e, _ in f)) for (i, _), f in zip(ints, found, strict=True)]
    return sorted(out, key=str), hashlib.sha256(text.encode()).hexdigest()


def found(df, **more):
    rows, books, uses = codes.coded(codes.vectors(df), **more)
    return sorted(((r.vec_id, r.code.hex(), sum(r.errors)) for r in rows.collect()), key=str), codes.books_sha256(books), uses


SHAPE = "vec_id long, embedding array<float>, label int, code string, x int"


@pytest.mark.parametrize("spread", [0.02, 0.2, 30.0])
def test_against_brute_force(spark, spread):
    rng = np.random.default_rng(int(spread * 100))
    centres = rng.normal(0, spread, (9, 32))
    rows = [(int(i) * 3 % 1000, [float(np.float32(x)) for x in centres[rng.integers(9)] + rng.normal(0, spread / 4, 32)]) for i in range(700)]
    rows += [(2000 + i, rows[5][1]) for i in range(300)]
    df = spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], SHAPE).repartition(5)
    got, digest, uses = found(df)
    assert (got, digest) == brute(rows)
    assert sum(uses[1]) == sum(uses[2]) == 16 * len(rows) and uses[1][0] > 0


def test_edges(spark):
    v = [0.5] * 15 + [-0.25]
    rows = [(3, v), (3, v), (None, [1.0] * 16), (1, None), (2, [float("nan")] + v[1:]), (4, [float("inf")] + v[1:]), (5, [None] + v[1:]), (6, [0.001] * 16), (7, [-0.001] * 16)]
    df = spark.createDataFrame([(i, x, None, "c", 2) for i, x in rows], SHAPE)
    assert found(df)[:2] == brute(rows)
    other = df.unionByName(spark.createDataFrame([(8, [1.0] * 32, 1, "c", 2), (9, [], 1, "c", 2), (10, [1.0] * 7, 1, "c", 2)], SHAPE))
    assert found(other)[:2] == brute(rows)
    assert found(df.limit(0))[0] == []
    with pytest.raises(Exception, match="must be below"):
        found(spark.createDataFrame([(1, [1e6] * 16, 1, "c", 2)], SHAPE))


def test_query_sums_labels(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want, digest = brute([(r.vec_id, r.embedding) for r in rows])
    label = {r.vec_id: r.label for r in rows}
    got = codes.op12(spark, sf).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == sorted(want) and {r.codebooks_sha256 for r in got} == {digest}
    for r in got:
        assert r.label_error == sum(e for i, _, e in want if label[i] == label[r.vec_id])


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(1)
    x, book = rng.integers(-200, 200, (400, 4)).astype(float), rng.integers(-200, 200, (64, 4)).astype(float)
    state = codes.searched(x, book, 8)
    for _ in range(4):
        new = book + rng.integers(-9, 9, book.shape)
        moved = np.sqrt(((new - book) ** 2).sum(axis=1)) * (1 + 1e-12)
        code, own, near, low, outer, depth = codes.bounded(x, state[0], state[2], state[3], state[4], new, moved)
        true = codes.squared(x, new)
        assert (code == true.argmin(axis=1)).all() and (own == true.min(axis=1)).all()
        dist = np.sqrt(true)
        assert (np.take_along_axis(dist, near, axis=1) >= low).all()
        rest = dist.copy()
        np.put_along_axis(rest, np.concatenate([code[:, None], near], axis=1), np.inf, axis=1)
        assert (rest.min(axis=1) >= outer).all() and (np.diff(low.astype(float), axis=1) >= 0).all()
        state, book = (code, own, near, low, outer), new
    assert (codes.kept_bounds(np.array([90, 5, 5, 0]), 16), codes.kept_bounds(np.array([1] + [0] * 11 + [9]), 16)) == (8, 12)
