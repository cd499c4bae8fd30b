import random

import numpy as np
import xxhash

from tidemark.llm import simhash as s


def brute_fp(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def brute_components(rows):
    fps = [f for _, f in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [least.get(root(i)) for i in range(len(rows))]


def test_whole_table_against_brute_force(spark, sf):
    rows = [(r.doc_id, brute_fp(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = sorted((d, f"{f:016x}", c) for (d, f), c in zip(rows, brute_components(rows), strict=True))
    assert sorted(tuple(r) for r in s.op8(spark, sf).collect()) == expected


def test_edges_and_one_of_each(spark):
    rows = [(5, None, "a"), (4, "", "b"), (4, "", "c"), (9, "one Two", "d"), (8, "one two", "d"), (7, "é   È x\ty", "e"), (7, "é È X y", "f"), (None, "alone here without id", "g"), (3, "q " * 30000, "h"), (3, "other words entirely here now", "i")]
    docs = spark.createDataFrame([(d, t, x, 1) for d, t, x in rows], "doc_id long, text string, fp string, component_id int")
    got = sorted((str(r.doc_id), r.fp & (2**64 - 1), str(r.component_id)) for r in s.near_duplicates(docs).collect())
    fps = [(d, brute_fp(t)) for d, t, _ in rows]
    assert got == sorted((str(d), f, str(c)) for (d, f), c in zip(fps, brute_components(fps), strict=True))
    kept = s.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["4", "8", "7", "None", "3", "3"])
    assert s.near_duplicates(docs.limit(0)).count() == 0 and s.one_of_each(docs.limit(0)).count() == 0


def test_bit_sliced_blocks():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    fps, block = [], []
    for g in range(80):
        for _ in range(int(rng.integers(1, 9)) if g % 20 else 150):
            x = int(base[g % 30])
            for b in rng.integers(0, 64, int(rng.integers(0, 6))):
                x ^= 1 << int(b)
            fps.append(x)
            block.append(g)
    for radius in (0, 1, 3, 4):
        roots = s.linked(np.array(fps, np.uint64), np.array(block), radius)
        up = list(range(len(fps)))

        def root(x):
            while up[x] != x:  # noqa: B023
                x = up[x]  # noqa: B023
            return x

        for i in range(len(fps)):
            for j in range(i):
                if block[i] == block[j] and (fps[i] ^ fps[j]).bit_count() <= radius:
                    up[root(i)] = root(j)
        pairs = {(int(a), root(i)) for i, a in enumerate(roots)}
        assert len(pairs) == len(set(map(int, roots))) == len({root(i) for i in range(len(fps))})


def test_hot_group_is_split(spark, monkeypatch):
    monkeypatch.setattr(s, "BLOCK", 16)
    random.seed(1)
    fps = {0}
    while len(fps) < 300:  # a chain of close fingerprints
        x = random.choice(sorted(fps))
        fps.add(x ^ (1 << random.randrange(63)) ^ (1 << random.randrange(63)))
    far = [0x7F0F00FF12345678 ^ (0xFFFF << 20)]
    edges = s.links(spark.createDataFrame([(int(f),) for f in [*fps, *far]], "fp long"))
    roots = {r.node: r.root for r in s.components(edges).collect()}
    assert {roots.get(f, f) for f in fps} == {0} or len({roots.get(f, f) for f in fps}) == 1
    assert far[0] not in roots


def test_one_of_each_keeps_clashing_columns(spark):
    rows = [(1, "a b c d", 1), (2, "a b c d", 2), (None, "a b c d", 3), (None, "other words of it", 4), (5, "other words of it", 5), (None, "alone it stands here", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, one_row int").selectExpr("*", "1 as __id", "2 as __hash", "3 as One_Id", "4 as fp", "5 as root")
    kept = s.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.one_row for r in kept.collect()) == [1, 5, 6]
    assert kept.where("__id = 1 and __hash = 2 and One_Id = 3 and fp = 4 and root = 5").count() == 3
    assert s.one_of_each(docs.limit(0)).count() == 0
