"""Operator 10, quality rules with risk-controlled thresholds.

Each rule is a figure of the text that is high in bad documents. The cutoffs of all rules are chosen together
for each stratum (language) on labelled documents. A walk of nested joint cutoffs is laid down from the bad
documents alone: first the rules that reject most of what is left for the fewest steps of a fixed grid, each to
where that pays, then all other steps by the same measure. Good documents have no part in it, so they may test
it: going down the walk, a step is certified while an exact binomial test rejects "more than ``RISK`` of the good
documents are lost" by all rules together at its level; the walk ends at the first failure, so its
steps need no further correction and, with probability 1 - ``LEVEL``, no stratum loses more than ``RISK`` of its good
documents. Strata whose labels are too few for any outcome to certify share no level, as they cannot fail (``level_of``).
Of the certified steps that with the best balance of bad and good documents rejected is taken. Without losses 149 good
labels certify where one stratum alone has as many, and 217 where four have.

Null and empty texts have no words and fail the base rule; long texts are counted whole, in linear time. Documents of an
unlabelled language are judged by the base rule only. Labels: a document is good if all its labels are 1; null labels are
ignored. Exact copies of a labelled text are one trial of its language (told by XXH64 of the text), as they are not independent, and good
only if all of them are; near copies count apart. The guarantee is on good texts that pass the base rule. Figures that equal a cutoff pass; steps that tie are taken in the order of rules and
grid. Without labels nothing but the base rule applies; an empty table gives no rows. Extra columns, whatever their names, are
ignored by ``verdicts`` and kept by ``good_documents``.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import raw_texts, table, unused, written

#: Good documents that all rules together may lose in a stratum, and the chance that this fails anywhere.
RISK, LEVEL = 0.02, 0.05
#: What a lost good document weighs against a rejected bad one.
REGRET = 10
WINDOW = 5
MIN_WORDS, MAX_REPEATED = 10, 20

_SPACE = bytes(range(9, 14)) + b" "
_FOLLOW = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(0x41, 0x5B))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
_NOT_WORD = re.compile(rb"[ \t-\r]*")

#: rule: (figure of the counts, most lenient cutoff, strictest cutoff)
RULES = {
    "symbols": (lambda c: c["n_symbols"] / c["n_words"], 4.0, 0.02),
    "repeats": (lambda c: c["n_repeat_words"] / c["n_words"], 0.2, 0.01),
    "dup_lines": (lambda c: c["n_dup_lines"] / c["n_lines"], 0.9, 0.02),
    "upper": (lambda c: c["n_upper"] / c["word_chars"], 0.9, 0.05),
    "long_words": (lambda c: c["word_chars"] / c["n_words"], 40.0, 6.0),
}
GRID = 48


def grid(rule: str) -> np.ndarray:
    """The cutoffs of a rule, from the most lenient to the strictest."""
    return np.geomspace(*RULES[rule][1:], GRID)


def counts_of(text: bytes) -> tuple[int, ...]:
    """The figures named in ``_COUNTS`` for one UTF-8 text."""
    words = text.split()  # of bytes: ASCII white space only
    n = len(words)
    if not n:
        return (0,) * len(_COUNTS)
    seen, repeated, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            repeated += line in seen
            seen.add(line)
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    covered = 0
    often = Counter(windows)
    if len(often) < len(windows):
        end = 0
        for i, w in enumerate(windows):
            if often[w] > 1:
                covered += i + WINDOW - max(end, i)
                end = i + WINDOW
    bare = text.translate(None, _SPACE + _FOLLOW)
    return n, len(bare), len(text) - len(text.translate(None, _SYMBOLS)), repeated, covered, lines, len(text) - len(text.translate(None, _UPPER))


_SHAPE = ", ".join(f"{c} long" for c in _COUNTS)


def counts(text: Column) -> Column:
    """A struct of the figures in ``_COUNTS``."""

    @F.arrow_udf(f"struct<{_SHAPE.replace(' long', ':long')}>")
    def run(col: pa.Array) -> pa.Array:
        columns = list(zip(*map(counts_of, raw_texts(col)), strict=True)) or [[] for _ in _COUNTS]
        return pa.StructArray.from_arrays([pa.array(list(c), pa.int64()) for c in columns], list(_COUNTS))

    return run.asNondeterministic()(text.cast("string"))  # so that the optimizer does not run it twice


def stratum(lang: str) -> Column:
    return F.coalesce(F.col(lang).cast("string"), F.lit(""))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (c["n_repeat_words"] * 100 > c["n_words"] * MAX_REPEATED)


def tail(k: np.ndarray, n: int, p: float) -> np.ndarray:
    """P(X <= k) for X binomial(n, p), k ascending."""
    i = np.arange(int(k.max(initial=0)) + 1)
    log = np.array([math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) for x in i.tolist()]) + i * math.log(p) + (n - i) * math.log1p(-p)
    return np.minimum(1.0, np.cumsum(np.exp(log)))[k]


def level_of(goods: list[int]) -> float:
    """The level of each stratum's test, from the good labels of all: ``LEVEL`` / k for the smallest k such that no more than k strata could be certified at it.

    A test that cannot reject even without losses makes no error, so only those that can share the level (Tarone 1990); nothing but sizes decides.
    """
    least = [(1 - RISK) ** n for n in goods]
    return LEVEL / next((k for k in range(1, len(goods) + 1) if sum(p <= LEVEL / k for p in least) <= k), 1)


def best_step(bins: np.ndarray, good: np.ndarray, good_left: np.ndarray, bad_left: np.ndarray, n_good: int, n_bad: int, risk: float, level: float, steps: int) -> int | None:
    """The step to take of a walk; bin b holds the rows rejected by step b and none before it. All of ``good`` certifies, the rest weighs."""
    lost, wasted, gained = (np.bincount(bins, x, steps + 1)[:steps].cumsum() for x in (good, good_left, bad_left))
    if not n_good or not n_bad:
        return None
    failed = np.flatnonzero(tail(lost.astype(np.int64), n_good, risk) > level)
    certified = int(failed[0]) if len(failed) else steps
    worth = (gained / n_bad - REGRET * wasted / n_good)[:certified]
    return int(worth.argmax()) if certified and worth.max() > 0 else None


def choose(rule: str, bins: np.ndarray, good: np.ndarray, good_left: np.ndarray, bad_left: np.ndarray, n_good: int, n_bad: int, risk: float, level: float) -> float | None:
    """The cutoff of one rule by itself, where the walk is its grid."""
    step = best_step(bins, good, good_left, bad_left, n_good, n_bad, risk, level, GRID)
    return None if step is None else float(grid(rule)[step])


def advance(gain: np.ndarray, state: list[int], n_bad: int) -> list[tuple[int, int]]:
    """The moves (rule, place) of the rule that pays most, a step of the grid costing 1 / ``GRID`` of all bad rows.

    ``gain`` has, for each rule and place, the bad rows left by ``state`` that the cutoff rejects.
    """
    places = np.arange(GRID) - np.array(state)[:, None]
    worth = np.where(places > 0, gain / max(1, n_bad) - places / GRID, -np.inf)
    rule, place = divmod(int(worth.argmax()), GRID)
    return [(rule, i) for i in range(state[rule] + 1, place + 1)] if worth.max() > 0 else []


def remaining(gain: np.ndarray, state: list[int]) -> list[tuple[int, int]]:
    """All further moves that reject bad rows, by the rows a step gains (along the hull of each rule's gains)."""
    moves = []
    for rule, at in enumerate(state):
        had = 0.0
        while at < GRID - 1:
            rate = (gain[rule, at + 1 :] - had) / np.arange(1, GRID - at)
            if rate.max() <= 0:
                break
            to = at + 1 + int(rate.argmax())
            moves += [(-float(rate.max()), rule, i) for i in range(at + 1, to + 1)]
            at, had = to, gain[rule, to]
    return [(rule, i) for _, rule, i in sorted(moves)]


def _bin(rule: str) -> Column:
    """How many cutoffs of the grid a row passes."""
    value = RULES[rule][0](F.col("c"))
    return F.aggregate(F.array(*[F.lit(float(g)) for g in grid(rule)]), F.lit(0), lambda acc, g: acc + (value <= g).cast("int"))


def thresholds(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """stratum and cutoffs (a map by rule) from rows of doc_id, stratum, counts ``c`` and the text's hash ``t``.

    What reaches the driver are counts by stratum, rule and bin or by stratum and step, and cutoffs.
    """
    marks = labels.where(F.col(quality).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg((F.min(quality) == 1).alias("good"))
    trials = rows.where(~base_failed(F.col("c"))).join(marks, "doc_id").groupBy("stratum", "t").agg(F.bool_and("good").alias("good"), F.first("c").alias("c"))
    judged = written(trials.select("stratum", "good", *[_bin(r).alias(r) for r in RULES]), "rule-bins")
    sizes = {r["stratum"]: (r["good"], r["bad"]) for r in judged.groupBy("stratum").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).collect()}
    spark = rows.sparkSession
    state = {s: [-1] * len(RULES) for s in sizes}
    walk: dict[str, list[tuple[int, int]]] = {s: [] for s in sizes}
    for turn in range(len(RULES) + 1):
        at = written(spark.createDataFrame(list(state.items()), "stratum string, state array<int>"), "walk-state")
        left = judged.where(~F.col("good")).join(at, "stratum").select("stratum", "state", F.array(*RULES).alias("bins")).where(F.forall(F.arrays_zip("bins", "state"), lambda x: x["bins"] > x["state"]))
        gain = {s: np.zeros((len(RULES), GRID + 1)) for s in sizes}
        for r in left.select("stratum", F.posexplode("bins").alias("rule", "bin")).groupBy("stratum", "rule", "bin").count().collect():
            gain[r["stratum"]][r["rule"], r["bin"]] = r["count"]
        moved = False
        for s in sizes:
            by = gain[s][:, :GRID].cumsum(axis=1)
            moves = advance(by, state[s], sizes[s][1]) if turn < len(RULES) else []
            moved |= bool(moves)
            walk[s] += moves
            for rule, place in moves:
                state[s][rule] = place
        if not moved:
            break
    for s in sizes:  # by what was left when the last turn began: nothing has moved since
        walk[s] += remaining(gain[s][:, :GRID].cumsum(axis=1), state[s])
    # for each rule and bin the first step whose cutoff rejects it
    first = {s: np.full((len(RULES), GRID + 1), len(w)) for s, w in walk.items()}
    for s, w in walk.items():
        for step, (rule, place) in reversed(list(enumerate(w))):
            first[s][rule, : place + 1] = np.minimum(first[s][rule, : place + 1], step)
    steps = written(spark.createDataFrame([(s, f.tolist()) for s, f in first.items()], "stratum string, first array<array<int>>"), "walk")
    step = F.least(*[F.col("first")[i][F.col(r)] for i, r in enumerate(RULES)])
    sums = judged.join(steps, "stratum").groupBy("stratum", step.alias("step")).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    by: dict[str, list] = {}
    for r in sums.collect():
        by.setdefault(r["stratum"], []).append((r["step"], r["good"], r["bad"]))
    found: dict[str, dict[str, float]] = {}
    level = level_of([good for good, _ in sizes.values()])
    for s, cells in sorted(by.items()):
        at_step, good, bad = (np.array(x) for x in zip(*cells, strict=True))
        taken = best_step(at_step, good, good, bad, *sizes[s], RISK, level, len(walk[s]))
        if taken is not None:
            found[s] = {list(RULES)[rule]: float(grid(list(RULES)[rule])[place]) for rule, place in walk[s][: taken + 1]}
    made = [(s, cut) for s, cut in found.items() if cut]
    # as a written table its size is known, so that texts are not shuffled by language to meet it
    return written(rows.sparkSession.createDataFrame(made, "stratum string, cutoffs map<string,double>"), "cutoffs")


def passes(c: Column, cutoffs: Column) -> Column:
    """Whether no rule's figure exceeds its cutoff."""
    over = lambda r: F.coalesce(RULES[r][0](c) > F.try_element_at(cutoffs, F.lit(r)), F.lit(False))
    return F.when(base_failed(c), False).otherwise(~F.greatest(*[over(r) for r in RULES]))


def verdicts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, stratum, the counts, base_failed and kept for every document."""
    rows = written(docs.select(F.col(doc_id).cast("long").alias("doc_id"), stratum(lang).alias("stratum"), counts(F.col(text)).alias("c"), F.xxhash64(text).alias("t")), "quality")
    cut = thresholds(rows, labels)
    return rows.join(cut, "stratum", "left").select("doc_id", "stratum", "c.*", base_failed(F.col("c")).alias("base_failed"), passes(F.col("c"), F.col("cutoffs")).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass; all columns stay. The texts are read twice rather than shuffled."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), stratum(lang).alias("stratum"), counts(F.col(text)).alias("c"), F.xxhash64(text).alias("t"))
    s, c, k = (unused(docs, x) for x in ("rule_stratum", "rule_counts", "rule_cutoffs"))
    cut = thresholds(rows, labels).select(F.col("stratum").alias(s), F.col("cutoffs").alias(k))
    judged = docs.withColumn(c, counts(F.col(text))).join(cut, stratum(lang) == F.col(s), "left")
    return judged.where(passes(F.col(c), F.col(k))).select(*docs.columns)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    rows = verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
