import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def true_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def price(at, cost, path, width):
    pad = lambda n: 0 if n & (n - 1) == 0 else width - n
    return sum(pad(at[b] - at[a]) + cost[b] + packing.EACH for a, b in itertools.pairwise(path))


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(1, 8), min_size=1, max_size=9), st.data())
def test_choice_is_least_of_all(gaps, data):
    at = np.append(0, np.cumsum(gaps))
    cost = np.array(data.draw(st.lists(st.sampled_from([0, 4, 32]), min_size=len(at), max_size=len(at))))
    ways = []
    for k in range(len(at)):
        for mid in itertools.combinations(range(1, len(at) - 1), k):
            path = [0, *mid, len(at) - 1]
            if all(at[b] - at[a] <= 8 for a, b in itertools.pairwise(path)):
                ways.append(price(at, cost, path, 8))
    got = packing.choose(at, cost, 8)
    assert price(at, cost, got, 8) == min(ways)
    assert all(at[b] - at[a] <= 8 for a, b in itertools.pairwise(got))


def checked(rows, docs, width=packing.WIDTH):
    """Pieces hold each document's ids once and in order, sequences have no gaps; gives the sequences' lengths."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(docs)
    for d, parts in by_doc.items():
        want, at = true_ids(docs[d]), 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(np.array(want[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want)
    lengths = []
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= width
        lengths.append(at)
    return lengths


def test_whole_table_round_trip(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    lengths = checked(packing.op11(spark, sf).collect(), docs)
    padding = sum(0 if n & (n - 1) == 0 else packing.WIDTH - n for n in lengths)
    assert padding < 0.025 * sum(lengths)


EDGES = {0: None, 1: "", 2: "One. Two! Three?\nFour", 3: "a<|endoftext|>b", 4: "word " * 30000, 5: "x" * 5000, 6: "é 😀 3.14.", 7: " ", 8: "No end here " * 500 + "."}


@pytest.mark.parametrize("block", [64, 5000, packing.BLOCK])
def test_edges_in_blocks(spark, block):
    docs = spark.createDataFrame([(d, t, "x") for d, t in EDGES.items()], "doc_id long, text string, ids string").coalesce(1)
    pieces = packing.packed(docs, block=block).cache()
    rows = pieces.selectExpr("doc_id", "start", "octet_length(ids) div 4 as length", "crc32(ids) as ids_crc32", "doc_tokens", "sequence_id", "offset").collect()
    checked(rows, EDGES)
    for r in packing.sequences(pieces).withColumn("a", packing.ids_array(packing.F.col("ids"))).collect():
        n, own = r.n_tokens, [p for p in pieces.collect() if p.sequence_id == r.sequence_id]
        want = np.frombuffer(b"".join(p.ids for p in sorted(own, key=lambda p: p.offset)), "<u4").tolist()
        assert len(want) == n and r.a[:n] == want
        assert len(r.a) == (n if n & (n - 1) == 0 else packing.WIDTH) and set(r.a[n:]) <= {packing.PAD}
    pieces.unpersist()


def test_empty_null_ids_and_repeats(spark):
    docs = spark.createDataFrame([(None, "a b"), (3, "same text."), (3, "same text.")], "doc_id long, text string")
    rows = packing.packed(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["3", "3", "None"]
    assert packing.packed(docs.limit(0)).count() == 0 and packing.sequences(packing.packed(docs.limit(0))).count() == 0


def test_cuts_prefer_documents_then_sentences():
    closes, opens = np.zeros((2, 10), bool)
    closes[1], opens[2] = True, True
    ids = np.array([5] * 6 + [1, 2] + [5] * 6 + [0], np.uint32)
    at, cost = packing.places(ids, np.array([15]), closes, opens, 8)
    assert dict(zip(at.tolist(), cost.tolist(), strict=True))[7] == packing.SENTENCE and cost[-1] == 0
    assert np.diff(at).max() <= 8
