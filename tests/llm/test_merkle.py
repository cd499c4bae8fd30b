import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[1], row[2], row[3], text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def climbed(tree, i, now):
    others = []
    for level in tree[:-1]:
        a = i - i % 3
        run = level[a : a + 3]
        others += run[: i - a] + run[i - a + 1 :]
        now = h("".join([*run[: i - a], now, *run[i - a + 1 :]]))
        i //= 3
    return others, now


def brute(rows, edit):
    """Rows of (doc_id, source, lang, n_chars, text) to the query's rows, sorted as text."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4]))) for s in sources}
    trees = {s: levels([leaf(r, r[4]) for r in own[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    root, out = top[-1][0], []
    for j, s in enumerate(sources):
        for i, r in enumerate(own[s]):
            a, now = climbed(trees[s], i, leaf(r, edit(r)))
            b, now = climbed(top, j, now)
            out.append((r[0], trees[s][0][i], trees[s][-1][0], root, h("".join(a + b)), now, now == root))
    return sorted(out, key=str)


def tampered(r):
    return r[4].replace("\n", "") if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r[4]


def answered(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows, tampered)
    assert answered(merkle.op13(spark, sf)) == want and {w[-1] for w in want} == {True, False}


SHAPE = "doc_id long, source string, lang string, n_chars long, text string"


def proved(spark, rows, edit):
    docs = spark.createDataFrame([(*r, edit(r), 1, "x") for r in rows], SHAPE + ", other string, place int, `row` string")
    new = merkle.leaf(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "other")))
    df = merkle.proved(merkle.manifest(docs, new))
    return df.withColumn("verified", F.col("folded_root") == F.col("root"))


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 4, None: 1, "b": 3}, {"a": 2200, "B": 729, "b": 730}, {f"s{i}": 1 + i % 2 for i in range(800)}])
def test_shapes(spark, sizes):
    rows = [(i if i else None, s, None if i % 3 else "en", i, None if i % 5 == 0 else "é\n" * (i % 4)) for s, n in sizes.items() for i in range(n)]
    assert answered(proved(spark, rows, lambda r: (r[4] or "") + "!" if r[3] % 2 else r[4])) == brute(rows, lambda r: (r[4] or "") + "!" if r[3] % 2 else r[4])


def test_repeats_and_empty(spark):
    rows = [(7, "a", "en", 1, "same")] * 5 + [(7, "a", "en", 1, "other"), (8, "", "en", 1, ""), (8, None, None, None, None)] + [(9, "a", "en", 1, "long text\n" * 200000)]
    assert answered(proved(spark, rows, tampered)) == brute(rows, tampered)
    assert proved(spark, rows, tampered).limit(0).count() == 0
    empty = spark.createDataFrame([], SHAPE)
    assert merkle.proved(merkle.manifest(empty)).count() == 0


def test_states_resume():
    rng = np.random.default_rng(0)
    kids = rng.integers(0, 2**32, (8, 5, 3), dtype=np.uint32)
    text = lambda d: [np.ascontiguousarray(x).astype(">u4").tobytes().hex() for x in d.T]
    digests, states = merkle.grown(kids, 1)
    assert text(digests[1][:, :, 0]) == [h("".join(text(kids[:, g]))) for g in range(5)]
    # the state before slot 1 knows slot 0 only: another child there and the sibling to its right make the new parent
    new = rng.integers(0, 2**32, (8, 5), dtype=np.uint32)
    state = merkle.absorbed(merkle.absorbed(states[0][:, :, 1], new), kids[:, :, 2])
    want = [h(a + b + c) for a, b, c in zip(text(kids[:, :, 0]), text(new), text(kids[:, :, 2]), strict=True)]
    assert text(merkle.closed(state, np.full(5, 3))) == want
