"""The pipeline against plain Python on the smallest tables and on a small table of edges."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tests.llm.test_decontaminate import brute
from tests.llm.test_quality_mix_shard import brute_counts, jump_hash
from tests.llm.test_simhash import brute_components, brute_fp
from tidemark.llm import mixing


def expected(docs, bench):
    """Documents after quality (base rule: too few labels for more), near-dedup and decontamination."""
    good = [d for d in docs if (c := brute_counts(d[1]))[0] >= 10 and 100 * c[4] <= 20 * c[0]]
    fps = [(d[0], brute_fp(d[1])) for d in good]
    once = [d for d, c in zip(good, brute_components(fps), strict=True) if d[0] == c]
    hit = {x[0] for x in brute([(d[0], d[1]) for d in once], bench) if x[-1]}
    return [d for d in once if d[0] not in hit]


@pytest.mark.parametrize("rows", [120])
def test_run_against_brute_force(spark, sf, tmp_path, rows):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    picked = d.orderBy("n_chars").limit(rows)  # brute force is slow on long texts
    folder = str(tmp_path)
    picked.write.parquet(f"{folder}/documents.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    docs = [tuple(r) for r in picked.collect()]
    want = expected(docs, [(r.item_id, r.text) for r in bench.collect()])
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == [*d.columns, "shard"]
    out = got.collect()
    copies = Counter(r.doc_id for r in out)
    assert set(copies) <= {x[0] for x in want} and max(copies.values()) <= 2
    assert all(tuple(r)[:-1] in {x for x in want} and r.shard == jump_hash(r.doc_id, 40) for r in out)
    size = {x[0]: brute_counts(x[1])[0] for x in want}
    sums, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for x in want:
        sums[x[3]] += size[x[0]]
        most[x[3]] = max(most[x[3]], size[x[0]])
        taken[x[3]] += copies[x[0]] * size[x[0]]
    for s, t in mixing.targets(sums).items():
        assert abs(taken[s] - t) <= 2 * most[s]
    again = corpus_pipeline.run(spark, folder)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, out))


def test_stages_on_edges_and_empty_tables(spark, sf, tmp_path):
    shape = "doc_id long, text string, lang string, source string, n_chars long, shard string"
    words = " ".join(f"w{i}" for i in range(40))
    rows = [(1, words, "en", "a", 1, "x"), (1, words, "en", "a", 1, "x"), (2, words, None, None, None, None), (None, words + " more", "en", "a", 1, "x"), (3, None, None, None, None, "x"), (4, "", "en", "b", 0, "x"), (5, " ".join(f"v{i}" for i in range(60000)), "en", "b", 1, "x")]
    for docs in (spark.createDataFrame(rows, shape), spark.createDataFrame([], shape)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
            path = f"{tmp_path}/{name}-{n}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            assert [c for c in docs.columns if c != "shard"] == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert {r.doc_id for r in docs.collect()} <= {1, 2, 5, None}
        if n:
            assert 5 in {r.doc_id for r in docs.collect()} and 2 not in {r.doc_id for r in docs.collect()}
