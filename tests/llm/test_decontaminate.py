import hashlib
import re

import pytest

from tidemark.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, bench, size=10, slop=0):
    windows = []
    for item, text in bench:
        w = words(text)
        windows += [(item, w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, items = set(), set()
        for item, x in windows:
            for p in range(-slop, len(w) + slop):
                if all(any(w[q] == t for q in range(max(0, p + o - slop), min(len(w) - 1, p + o + slop) + 1)) for o, t in enumerate(x)):
                    hit |= set(range(max(0, p), min(len(w), p + len(x))))
                    items |= {str(item)} - {"None"}
        names = sorted(items)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "a b c d e f g h i j k"), (12, "Short ITEM é"), (2, ""), (3, None), (4, "...,"), (12, "x y"), (5, "the the the the the the the the the the"), (None, "null item words")]
DOCS = [
    (1, "z A-b,c d\ne f g h i j k! z"), (2, "a b c d e f g h i"), (3, "short item é short item e"), (4, None), (5, ""), (6, "the " * 30), (7, "x"), (7, "x y"), (7, "x y"),
    (8, "k"), (None, "x. Y"), (9, "null item words " * 3), (10, "Éa É"), (11, "w " * 40000 + "x y"), (12, "x"), (13, "y short item"), (14, "item short é"),
]


@pytest.mark.parametrize("slop", [0, 1])
def test_matches_brute_force(spark, slop, monkeypatch):
    docs = spark.createDataFrame([(*r, 0, "x") for r in DOCS], "doc_id long, text string, shard int, items string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = DOCS if not slop else [r for r in DOCS if r[0] != 11]
    docs = docs if not slop else docs.where("doc_id is null or doc_id <> 11")
    got = d.search(d.build_index(docs), bench, slop=slop)
    got = sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.spans)) for r in got.collect()), key=str)
    assert got == brute(rows, ITEMS, slop=slop)


def test_blocks_and_shards_of_any_size_give_the_same(spark, sf, monkeypatch):
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    index = d.build_index(docs)
    key = lambda df: sorted((r.doc_id, r.n_words, tuple(map(tuple, r.spans)), tuple(r["items"])) for r in df.collect())
    one = key(d.search(index, bench))
    monkeypatch.setattr(d, "BLOCK_WORDS", 2000)
    assert key(d.search(index, bench)) == one
    monkeypatch.setattr(d, "HELD_BYTES", 1)  # each shard by itself
    monkeypatch.setattr(d, "KEPT_BYTES", 100)  # the benchmark is read again for each
    assert key(d.search(index, bench.repartition(3))) == one
    assert any(x[2] for x in one)


def test_whole_table_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    grams: dict[tuple, set] = {}
    for item, text in bench:
        w = words(text)
        for i in range(max(1, len(w) - 9)):
            grams.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    expected = []
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    items |= grams[tuple(w[i : i + n])]
        expected.append((doc_id, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    assert sorted(tuple(r) for r in d.op1(spark, sf).collect()) == sorted(expected)


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert d.search(d.build_index(docs.limit(0)), bench).count() == 0
    assert all(not r.spans for r in d.search(d.build_index(docs), bench.limit(0)).collect())
    clean = d.clean_documents(docs.selectExpr("*", "1 as hit", "2 as Hash", "3 as _hit", "4 as row"), bench)
    assert clean.columns == ["doc_id", "text", "hit", "Hash", "_hit", "row"]
    kept = [x for x in DOCS if x[0] in (2, 4, 5, 8, 10, 12, 13, 14)] + [(7, "x")]  # not the other text of its id
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted(kept, key=str)
