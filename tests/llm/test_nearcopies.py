import random

import numpy as np

import corpus_pipeline
from tidemark.llm import nearcopies as n


def brute_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} - {()}


def brute_alike(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def brute_kept(rows):
    """The smallest id of each component; ids are given once."""
    sets = [brute_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if brute_alike(sets[i], sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return sorted(least.values())


def changed(rng, words, times):
    w = list(words)
    for i in rng.sample(range(len(w)), times):
        w[i] = f"c{rng.random()}"
    return w


def near_rows():
    """Families about the limit of 0.8, a chain whose ends are far apart, a shared passage, and short or empty texts."""
    rng, texts = random.Random(4), []
    passage = [f"p{i}" for i in range(30)]
    for k in range(25):
        base = [f"{k}w{i}" for i in range(150)]
        texts += [" ".join(changed(rng, base, t)) for t in (0, 0, 1, 2, 3, 4, 5, 8)]
        texts.append(" ".join(passage + [f"{k}x{i}" for i in range(40)]))
    chain = [f"chain{i}" for i in range(200)]
    for _ in range(8):
        texts.append(" ".join(chain))
        chain = changed(rng, chain, 2)
    texts += ["", None, " \t", "One two", "one  TWO", "one two three", texts[0].upper()]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts, 1)]


def test_stage_drops_every_near_copy(spark, sf):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = corpus_pipeline.drop_near_copies(spark, docs, sf)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(rows)


def test_large_groups_are_split(spark, sf, monkeypatch):
    monkeypatch.setattr(n, "PART", 2)
    monkeypatch.setattr(n, "CHUNK", 1)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf).collect()) == brute_kept(rows)


def test_repeated_and_null_ids(spark):
    words = [f"w{i}" for i in range(60)]
    near = " ".join([*words[:-1], "other"])
    rows = [(None, " ".join(words), 1), (4, near, 2), (4, near, 2), (4, "far " * 7, 3), (None, "quite another text that stands alone", 4)]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string, fp int"), "")
    assert sorted(((r.doc_id or 0), r.fp) for r in kept.collect()) == [(0, 4), (4, 2), (4, 3)]
    assert corpus_pipeline.drop_near_copies(spark, kept.limit(0), "").count() == 0


def test_alike_blocks():
    rng = np.random.default_rng(2)
    sets, block = [], []
    for g in range(40):
        for _ in range(int(rng.integers(1, 9))):
            sets.append(np.unique(rng.integers(g % 3, 14 + g % 3, 20).astype(np.uint64)))
            block.append(g)
    got = n.alike(sets, np.array(block))
    held = [set(s.tolist()) for s in sets]
    for i in range(len(sets)):
        group = {i}
        while True:
            more = {j for j in range(len(sets)) if block[j] == block[i] and any(brute_alike(held[j], held[k]) for k in group)}
            if more <= group:
                break
            group |= more
        assert set(np.flatnonzero(got == got[i]).tolist()) == group


def brute_fingerprint(held):
    """As an integer: each bit that over half of the mixed hashes have."""
    out = 0
    for k, times in enumerate(n._TIMES.tolist()):
        ones = [0] * 64
        for x in held.tolist():
            x = x * times % 2**64
            x = (x ^ x >> 32) * int(n._MIX) % 2**64
            x ^= x >> 29
            for b in range(64):
                ones[b] += x >> b & 1
        out |= sum(1 << 64 * k + b for b in range(64) if 2 * ones[b] > len(held))
    return out


def brute_groups(bits):
    """Groups of two or more, of fingerprints that share a deal's bits and are close in the compared words."""
    blocks, up = {}, list(range(len(bits)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, f in enumerate(bits):
        for k, picked in enumerate(n._PICK.tolist()):
            blocks.setdefault((k, *(f >> b & 1 for b in picked)), []).append(i)
    for own in blocks.values():
        for i in own:
            for j in own:
                if j < i and ((bits[i] ^ bits[j]) % 2 ** (64 * n.WORDS)).bit_count() <= n.RADIUS:
                    up[root(i)] = root(j)
    groups = {}
    for i in range(len(bits)):
        groups.setdefault(root(i), set()).add(i)
    return sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_candidates_are_close_fingerprints(spark, monkeypatch):
    rows = [r for r in near_rows() if r[0] % 3]
    sets = {}
    for _, t in rows:
        s = n.shingle_set((t or "").encode())
        sets.setdefault(int(np.int64(np.uint64(n.xxhash.xxh64_intdigest(s.tobytes(), 42)))), s)
    bits = [brute_fingerprint(s) for s in sets.values()]
    assert [int.from_bytes(n.fingerprint(s).tobytes(), "little") for s in sets.values()] == bits
    at = {fp: i for i, fp in enumerate(sets)}
    found = n.written(n.sketches(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)), "sketches")
    for block in (n.BLOCK, 2):
        monkeypatch.setattr(n, "BLOCK", block)
        groups = {}
        for r in n.candidates(found).collect():
            groups.setdefault(r.root, []).append(at[r.node])
        assert sorted(sorted(g) for g in groups.values()) == brute_groups(bits)


def test_close_sets_share_a_block_and_far_ones_do_not_meet():
    rng = np.random.default_rng(5)
    far = []
    for common, own in ((400, 50), (40, 5), (8, 1)):  # 0.8, each
        for _ in range(40):
            base = rng.integers(0, 2**64, common + 2 * own, np.uint64)
            a, b = (np.unpackbits(n.fingerprint(x), bitorder="little") for x in (base[: common + own], np.concatenate([base[:common], base[common + own :]])))
            differ = a != b
            assert differ[: 64 * n.WORDS].sum() <= n.RADIUS and (~differ[n._PICK].any(axis=1)).any()
            far.append(a[: 64 * n.WORDS])
    assert min((x != y).sum() for i, x in enumerate(far) for y in far[:i]) > n.RADIUS


def test_large_blocks_come_out_whole(monkeypatch):
    monkeypatch.setattr(n, "COMPARED", 8)
    rng = np.random.default_rng(6)
    sizes = [3, 30, 1, 4, 5, 2, 40]
    block = np.repeat(np.arange(len(sizes)), sizes)
    words = rng.integers(0, 2**64, (len(block), n.WORDS), np.uint64)
    words[1], words[35] = words[0] ^ np.uint64(7), words[34] ^ np.uint64(1)
    rows = n._rows(block, words)
    for most in (4, 0):
        out = [r for b in n._compared(most)(iter([rows.slice(i, 3) for i in range(0, len(block), 3)])) for r in b.to_pylist()]
        whole = [r["block"] for r in out if r["block"] >= 0]
        assert sorted(whole) == [b for b in block.tolist() if most and sizes[b] > most]
        name = n.names(words).tolist()
        assert {frozenset((r["w0"], r["w1"])) for r in out if r["block"] < 0} == {frozenset(name[0:2]), frozenset(name[34:36])}
