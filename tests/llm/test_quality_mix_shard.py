import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import mixing, quality, sharding


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    c = Counter(win)
    covered = {j for i, x in enumerate(win) if c[x] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text), dup, len(covered)


def test_quality_counts(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in quality.op10(spark, sf).collect()}
    assert len(got) == len(texts)
    for d, t in texts.items():
        r, want = got[d], brute_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("text", [None, "", " \t\n", "a b c d e a b c d e", "x\nx\n x\n\nx", "a " * 70000, "é€😀  b c <|>", "a b a b a b a b a b", "one"])
def test_quality_edges(text):
    assert quality.counts_of((text or "").encode())[:5] == brute_counts(text)


def test_quality_thresholds_hold_their_risk(spark):
    rng = np.random.default_rng(5)
    rows, marks = [], []
    for i in range(6000):
        good = rng.random() < 0.85
        n = 40
        symbols = rng.random() < (0.0005 if good else 0.8)
        text = " ".join(f"w{rng.integers(1e6)}" + ("%%%" if symbols else "") for _ in range(n))
        rows.append((i, text, "en" if i % 5 else None, "k"))
        marks.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, cutoffs string").repartition(4)
    labels = spark.createDataFrame([*marks, (3, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality.verdicts(docs, labels).collect()}
    bad = [i for i, g in marks if not g and rows[i][2]]
    assert np.mean([not got[i] for i in bad]) > 0.6
    for stratum in ("en", None):
        assert np.mean([not got[i] for i, g in marks if g and rows[i][2] == stratum]) <= quality.RISK
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(got.values())
    assert quality.verdicts(docs, labels.limit(0)).where("not kept").count() == 0
    assert quality.good_documents(docs.limit(0), labels).count() == 0
    clash = docs.selectExpr("*", "1 as __c", "2 as rule_counts", "3 as Stratum", "4 as c")
    assert quality.good_documents(clash, labels).columns == clash.columns and quality.good_documents(clash, labels).where("__c = 1 and rule_counts = 2 and c = 4").count() == kept.count()


def brute_cutoffs(rows):
    """Cutoffs by stratum from (stratum, counts by name, good), one row at a time, by the rules in words."""
    from math import comb

    out, strata = {}, sorted({s for s, _, _ in rows})
    able = lambda k: sum((1 - quality.RISK) ** sum(g for x, _, g in rows if x == s) <= quality.LEVEL / k for s in strata)
    shares = min(k for k in range(1, len(strata) + 1) if able(k) <= k)
    for s in strata:
        own = [([float(f(c)) for f, _, _ in quality.RULES.values()], g) for x, c, g in rows if x == s]
        grids = [list(map(float, quality.grid(r))) for r in quality.RULES]
        bad, good = [v for v, g in own if not g], [v for v, g in own if g]
        over = lambda v, state: any(k >= 0 and x > grids[i][k] for i, (x, k) in enumerate(zip(v, state, strict=True)))
        state, walk = [-1] * len(grids), []
        for _ in grids:
            left = [v for v in bad if not over(v, state)]
            worth = {(i, k): sum(v[i] > grids[i][k] for v in left) / max(1, len(bad)) - (k - state[i]) / quality.GRID for i in range(len(grids)) for k in range(state[i] + 1, quality.GRID)}
            (i, k), most = max(worth.items(), key=lambda x: (x[1], -x[0][0], -x[0][1]))
            if most <= 0:
                break
            walk += [(i, j) for j in range(state[i] + 1, k + 1)]
            state[i] = k
        left, more = [v for v in bad if not over(v, state)], []
        for i in range(len(grids)):
            at, had = state[i], 0
            while at < quality.GRID - 1:
                rates = {k: (sum(v[i] > grids[i][k] for v in left) - had) / (k - at) for k in range(at + 1, quality.GRID)}
                k = max(rates, key=lambda k: (rates[k], -k))
                if rates[k] <= 0:
                    break
                more += [(-rates[k], i, j) for j in range(at + 1, k + 1)]
                at, had = k, sum(v[i] > grids[i][k] for v in left)
        walk += [(i, k) for _, i, k in sorted(more)]
        state, best = [-1] * len(grids), (0.0, None)
        for i, k in walk if good and bad else ():
            state[i] = max(state[i], k)
            lost, gained = sum(over(v, state) for v in good), sum(over(v, state) for v in bad)
            chance = sum(comb(len(good), j) * quality.RISK**j * (1 - quality.RISK) ** (len(good) - j) for j in range(lost + 1))
            if chance > quality.LEVEL / shares:
                break
            worth = gained / len(bad) - quality.REGRET * lost / len(good)
            if worth > best[0] + 1e-12:
                best = (worth, list(state))
        if best[1]:
            out[s] = {r: grids[i][best[1][i]] for i, r in enumerate(quality.RULES) if best[1][i] >= 0}
    return out


def test_verdicts_of_the_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    counts = {d: dict(zip(quality._COUNTS, quality.counts_of((r.text or "").encode()), strict=True)) for d, r in docs.items()}
    failed = {d: c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"] for d, c in counts.items()}
    trials = {}  # copies of a text are one trial
    for d in docs:
        if marks.get(d) is not None and not failed[d]:
            trials.setdefault((docs[d].lang or "", docs[d].text), []).append((counts[d], marks[d] == 1))
    cut = brute_cutoffs([(lang, own[0][0], all(g for _, g in own)) for (lang, _), own in trials.items()])
    assert cut
    got = {r.doc_id: r for r in quality.op10(spark, sf).collect()}
    rejected = 0
    for d, r in docs.items():
        own = cut.get(r.lang or "", {})
        want = not failed[d] and all(quality.RULES[k][0](counts[d]) <= x for k, x in own.items())
        assert (got[d].base_failed, got[d].kept) == (failed[d], want), d
        rejected += not failed[d] and not want
    assert rejected > 0


def test_few_labels_get_cutoffs(spark):
    """300 good labels a language, four languages: one rule tells 30 of 32 bad ones, another one more."""
    rows, marks = [], []
    for lang in ("en", "de", "fr", "es"):
        for i in range(332):
            words = [f"{lang}{i}x{j}" for j in range(30)]
            if 300 <= i < 330:
                words = [w + "%%" for w in words]
            elif i == 330:
                words = [w.upper() for w in words]
            rows.append((len(rows), " ".join(words), lang))
            marks.append((rows[-1][0], int(i < 300)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.kept for r in quality.verdicts(docs, spark.createDataFrame(marks, "doc_id long, quality int")).collect()}
    for k in range(4):
        own = [got[k * 332 + i] for i in range(332)]
        assert all(own[:300]) and not any(own[300:331]) and own[331]


@pytest.mark.parametrize("copies", [1, 3])
def test_copies_of_good_texts_certify_nothing(spark, copies):
    """100 good texts are too few, however often they are repeated; 300 different ones are enough."""
    words = lambda i, sign: " ".join(f"w{i}x{j}{sign}" for j in range(30))
    good = [words(i % (100 if copies == 3 else 300), "") for i in range(300)]
    bad = [words(1000 + i, "%%") for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(good + bad)], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, int(i < 300)) for i in range(340)], "doc_id long, quality int")
    assert quality.verdicts(docs, marks).where("not kept").count() == (0 if copies == 3 else 40)
    assert quality.good_documents(docs, marks).count() == (340 if copies == 3 else 300)


def test_only_strata_that_can_be_certified_share_the_level():
    one = quality.LEVEL
    assert quality.level_of([149]) == quality.level_of([149, 35, 0]) == quality.level_of([200, 140, 100, 3]) == one
    assert quality.level_of([182, 182]) == quality.level_of([400, 182, 50, 50]) == one / 2
    assert quality.level_of([217] * 4) == one / 4 and quality.level_of([]) == one and quality.level_of([3, 4]) == one


def test_walk_is_nested_and_complete():
    gain = np.zeros((len(quality.RULES), quality.GRID))
    gain[0, 4:], gain[0, 20:], gain[2, 40:] = 30, 50, 1
    moves = quality.advance(gain, [-1] * 5, 52)
    assert moves == [(0, i) for i in range(21)]
    gain[0] = 0
    assert quality.advance(gain, [20, -1, -1, -1, -1], 52) == []
    assert quality.remaining(gain, [20, -1, -1, -1, -1]) == [(2, i) for i in range(41)]


def test_binomial_tail_is_exact():
    from math import comb

    for n, p in ((10, 0.3), (200, 0.01)):
        want = np.cumsum([comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)])
        assert np.allclose(quality.tail(np.arange(n + 1), n, p), want)
    bins, none, bad = np.array([0, 47, 48]), np.array([0, 0, 0]), np.array([0, 50, 0])
    pick = lambda good, left=bad: quality.choose("symbols", bins, np.array([0, 0, good]), none, left, good, 50, 0.01, 0.01)
    assert pick(3000) == quality.grid("symbols")[47]
    assert pick(20) is None  # too few
    assert pick(3000, none) is None  # nothing that other rules leave


def test_targets():
    t = mixing.targets({"a": 100, "b": 100, "c": 100, None: 100})
    assert t["a"] == 200 and sum(t.values()) == 600 and all(v <= 200 for v in t.values())
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


def test_mix(spark, sf):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = mixing.op5(spark, sf).collect()
    assert sorted(map(tuple, mixing.op5(spark, sf).collect())) == sorted(map(tuple, got))
    source, size = {d: s for d, _, s in rows}, {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in rows}
    sums = defaultdict(int)
    for d in size:
        sums[source[d]] += size[d]
    want, taken = mixing.targets(sums), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r["size"] == size[r.doc_id] and r.source_size == sums[source[r.doc_id]] and abs(r.target - want[source[r.doc_id]]) < 1e-6
        assert r.taken % max(1, r["size"]) == 0 and 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
    most = defaultdict(int)
    for d in size:
        most[source[d]] = max(most[source[d]], size[d])
    for s in sums:
        assert abs(taken[s] - want[s]) <= 2 * most[s] + 0.05 * want[s]


def test_mix_edges(spark):
    rows = [(1, None, None, 1), (1, None, None, 1), (None, "a b", "s", 2), (2, "", "t", 3), *[(3, "x y z", "s", 4)] * 5, (4, "w " * 50000, "u", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    sized = mixing.systematic(mixing.sizes(docs)).collect()
    assert len(sized) == len(rows)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in sized)
    assert mixing.mixed(docs.limit(0)).count() == 0
    clash = docs.selectExpr("*", "1 as __d", "2 as __r", "3 as mix_id", "4 as Copies", "5 as mix_times")
    assert mixing.mixed(clash).columns == clash.columns and mixing.mixed(clash).where("__d = 1 and __r = 2 and mix_id = 3 and copies = 4 and mix_times = 5").count() == out.count()


def test_repeated_rows_share_their_copies(spark):
    docs = spark.createDataFrame([(i // 3, "a b c" if i % 3 else "x y z", None if i % 2 else "s", i) for i in range(90)] + [(None, None, None, 90)] * 3, "doc_id long, text string, source string, n int")
    copies = {(r.doc_id, r.row, r.source): 0 for r in mixing.systematic(mixing.sizes(docs)).collect()}
    for r in mixing.systematic(mixing.sizes(docs)).collect():
        copies[r.doc_id, r.row, r.source] += r.copies
    got = Counter((r.doc_id, r.row, r.source) for r in mixing.mixed(docs).selectExpr("doc_id", "xxhash64(text) as row", "source").collect())
    assert got == Counter({k: n for k, n in copies.items() if n})


def jump_hash(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = sharding.op9(spark, sf).collect()
    slots = defaultdict(list)
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (jump_hash(r.doc_id, 40), jump_hash(r.doc_id, 41))
        assert r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and len(got) == len(texts)


def test_shard_edges(spark):
    rows = [(-5, None, 1), (None, "", 2), (None, "", 2), (2**63 - 1, "é", 3), (-(2**63), "a" * 200000, 4)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    got = sharding.placed(docs).collect()
    assert len(got) == 15
    for r in got:
        assert r.shard == jump_hash(r.doc_id or 0, 40)
    assert {r["size"] for r in got} == {16, 18, 200016}
    assert sharding.placed(docs.limit(0)).count() == 0 and sharding.sharded(docs).columns == ["doc_id", "text", "slot", "shard"]
