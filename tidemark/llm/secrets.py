"""Operator 6, secret scans: base patterns, and formats inferred from labelled credentials.

Base matches (assign, access, hex) label the credentials. A bounded sample of each kind's distinct values becomes a prefix
tree over character classes; states whose outcomes are statistically compatible (Hoeffding bound) are merged
into a probabilistic automaton, one a kind. Every long token of every text is a candidate, those that base patterns match
among them: one is reported as ``format`` if under some kind's automaton its likelihood a character is no less than that of nearly
all held-out credentials, and the whole token is more likely by it than under the automata of ordinary tokens, by ``LEAD``. So a labelled credential is
found again by its format alone, and so is an unlabelled one; base spans stay whatever the automata say.

Texts are scanned twice, once for the samples and once for the spans; no candidate is stored. Null and empty texts have no
spans. Long texts and tokens are scanned and scored whole, in linear time. Spans that tie in start and kind go by their end. Repeated
rows give repeated rows; extra columns, whatever their names, are ignored; an empty table gives no rows. With fewer than ``FEWEST``
labelled values a kind has no automaton and adds nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import raw_texts, table, written

KINDS = ("assign", "access", "hex")
#: Ordinary tokens: of letters only, and with digits or signs.
ORDINARY = ("word", "sign")
#: Distinct labelled values of a kind (and ordinary tokens) that the automata are fitted on, a third of them held out.
SAMPLE = 900
#: How many times the sample is sorted to find it.
SPARE = 4
#: Fewest labelled values of a kind.
FEWEST = 12
#: The merge test's level, the held-out credentials below the threshold, the room a character below them where they are
#: too few to tell, and the log-odds against ordinary tokens.
ALPHA, BELOW, ROOM, LEAD = 0.05, 0.01, 1.0, 3.0
#: Classes a state may see, for the share of those it never saw.
OUTCOMES = 10
#: Verdicts that a task keeps at hand, of tokens up to so many characters.
KEPT, SHORT = 100_000, 128
#: Fixed patterns of the base scan and of candidates.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_.-]{11,}[A-Za-z0-9+/_-](?:={1,2}(?![A-Za-z0-9+/_.=-]))?")
_WORDS = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)

#: For each state its ways by class (next state, probability), the probability to end there and that of a way never seen.
Automaton = list[tuple[dict[str, tuple[int, float]], float, float]]


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of the base scan, by start, then kind."""
    found = []
    if _WORDS.search(text):
        found += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, token) of all tokens of 12 or more characters; full stops at the end are none of them."""
    return [(m.start(), m.end(), m[0]) for m in CANDIDATE.finditer(text)]


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct (kind, value) of each batch: credentials by kind, and tokens that no base span touches as ``ORDINARY`` ones."""
    for batch in batches:
        seen: set[tuple[str, str]] = set()
        for raw in raw_texts(batch.column(0)):
            text = raw.decode()
            base = base_spans(text)
            seen.update((kind, value) for kind, _, _, value in base)
            k, spans = 0, sorted((a, b) for _, a, b, _ in base)
            for a, b, value in candidates(text):
                while k < len(spans) and spans[k][1] <= a:
                    k += 1
                if len(value) <= SHORT and not any(x < b and y > a for x, y in spans[k : k + 8]):
                    seen.add((ORDINARY[not value.isalpha()], value))
        rows = list(seen)
        yield pa.record_batch([pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.string())], ["kind", "value"])


#: Characters by class: digits 9, a-f a, other lower case z, upper case A, others as they are.
_CLASS = str.maketrans({c: "9" if c.isdigit() else "a" if c in "abcdef" else "z" if c.islower() else "A" for c in "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def classes(value: str) -> str:
    """A token's characters by class."""
    return value.translate(_CLASS)


def infer(words: list[str], alpha: float = ALPHA) -> Automaton:
    """The probabilistic automaton of some words of classes."""
    ends, ways, counts = [0], [{}], [0]  # the prefix tree
    for w in words:
        s = 0
        counts[0] += 1
        for c in w:
            if c not in ways[s]:
                ways[s][c] = [len(ends), 0]
                ends.append(0)
                ways.append({})
                counts.append(0)
            ways[s][c][1] += 1
            s = ways[s][c][0]
            counts[s] += 1
        ends[s] += 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(f: int, n: int, g: int, m: int) -> bool:
        return n > 0 and m > 0 and abs(f / n - g / m) > bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            n, m = counts[x], counts[y]
            if differ(ends[x], n, ends[y], m):
                return False
            for c in ways[x].keys() | ways[y].keys():
                p, q = ways[x].get(c), ways[y].get(c)
                if differ(p[1] if p else 0, n, q[1] if q else 0, m):
                    return False
                if p and q and p[0] != x:
                    todo.append((p[0], q[0]))
        return True

    def fold(a: int, b: int) -> None:
        """Adds the tree at ``b`` to state ``a``."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            counts[x] += counts[y]
            ends[x] += ends[y]
            for c, (t, n) in ways[y].items():
                if c in ways[x]:
                    ways[x][c][1] += n
                    todo.append((ways[x][c][0], t))
                else:
                    ways[x][c] = [t, n]

    kept = [0]
    while True:
        front = sorted((ways[s][c][0], s, c) for s in kept for c in ways[s] if ways[s][c][0] not in kept)
        if not front:
            break
        state, parent, c = front[0]
        for r in kept:
            if compatible(r, state):
                ways[parent][c][0] = r
                fold(r, state)
                break
        else:
            kept.append(state)
    name = {s: i for i, s in enumerate(kept)}
    return [({c: (name[t], n / counts[s]) for c, (t, n) in ways[s].items()}, ends[s] / counts[s], 0.5 / (counts[s] + 0.5 * OUTCOMES)) for s in kept]


def likelihood(model: Automaton, word: str) -> float:
    """The log-likelihood a character of a word of classes."""
    s, total = 0, 0.0
    for c in word:
        ways, _, unseen = model[s]
        t, p = ways.get(c, (s, 0.0))
        total += math.log(max(p, unseen))
        s = t
    return (total + math.log(max(model[s][1], model[s][2]))) / (len(word) + 1)


def sampled(docs: DataFrame, text: str = "text") -> dict[str, list[str]]:
    """For each kind, and each of ``ORDINARY`` tokens, at most ``SAMPLE`` distinct values, those with the least hashes."""
    values = written(docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_values, "kind string, value string").distinct().withColumn("hash", F.xxhash64("value")), "credentials")
    # of so many values, evenly hashed, the SAMPLE least lie below this share of all hashes: few rows are left to sort
    below = [F.when(F.col("kind") == r["kind"], F.lit(min(2**63 - 1, -(2**63) + SPARE * SAMPLE * 2**64 // r["n"]))) for r in values.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()]
    least = Window.partitionBy("kind").orderBy("hash", "value")
    top = values.where(F.col("hash") <= F.coalesce(*below, F.lit(0))).withColumn("n", F.row_number().over(least)).where(F.col("n") <= SAMPLE)
    out: dict[str, list[str]] = {kind: [] for kind in (*KINDS, *ORDINARY)}
    for r in top.orderBy("kind", "n").collect():
        out[r["kind"]].append(r["value"])
    return out


def fitted(sample: dict[str, list[str]]) -> dict:
    """Automata and thresholds by kind, and the automata of ordinary tokens."""
    usual = [infer([classes(x) for x in sample[kind]]) for kind in ORDINARY if sample[kind]]
    models = {}
    for kind in KINDS:
        words = [classes(x) for x in sample[kind]]
        if len(words) >= FEWEST:
            model = infer([w for i, w in enumerate(words) if i % 3])
            held = sorted(likelihood(model, w) for w in words[::3])
            models[kind] = (model, held[int(BELOW * len(held))] - (ROOM if BELOW * len(held) < 1 else 0.0))
    return {"models": models, "usual": usual}


def judged(value: str, fit: dict) -> tuple[str, float] | None:
    """The kind whose automaton gives a token the greatest likelihood a character, and that, if it is a credential by it."""
    word = classes(value)
    usual = max((likelihood(m, word) for m in fit["usual"]), default=-math.inf)
    best = None
    for kind, (model, least) in fit["models"].items():
        score = likelihood(model, word)
        if score >= least and (score - usual) * (len(word) + 1) >= LEAD and (best is None or score > best[1]):
            best = (kind, score)
    return best


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("like", pa.string()), ("likelihood", pa.float64())])
_SHAPE = "array<struct<kind:string,start:long,end:long,value:string,like:string,likelihood:double>>"


def spans_of(text: str, fit: dict, known: dict) -> list[dict]:
    """All spans of a text; ``known`` keeps verdicts by token class."""
    out = [{"kind": k, "start": a, "end": b, "value": v, "like": None, "likelihood": None} for k, a, b, v in base_spans(text)]
    for a, b, value in candidates(text) if fit["models"] else ():
        key = classes(value)
        if key in known:
            best = known[key]
        else:
            best = judged(value, fit)
            if len(key) <= SHORT:
                if len(known) >= KEPT:
                    known.clear()
                known[key] = best
        if best:
            out.append({"kind": "format", "start": a, "end": b, "value": value, "like": best[0], "likelihood": best[1]})
    return out


def _scanner(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([spans_of(raw.decode(), held.value, known) for raw in raw_texts(batch.column(1))], pa.list_(_SPAN))], ["doc_id", "spans"])

    return run


def scanned(docs: DataFrame, fit: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end, value; of formats the kind they are like and the likelihood) of every document."""
    held = docs.sparkSession.sparkContext.broadcast(fit)  # a few automata of bounded samples
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_scanner(held), f"doc_id long, spans {_SHAPE}")


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``scanned`` with the automata of the documents' own labels."""
    return scanned(docs, fitted(sampled(docs, text)), doc_id, text)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of secrets in every document, and what each format span is like, with its likelihood a character."""
    rows = secrets(table(spark, sf_dir, "documents"))
    place = lambda s: F.when(s["kind"] == "assign", 0).when(s["kind"] == "access", 1).when(s["kind"] == "hex", 2).otherwise(3)
    told = lambda spans: F.array_join(F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), place(s).alias("b"), s["end"].alias("c"), s["kind"].alias("d")))), lambda s: F.concat_ws(":", s["d"], s["a"], s["c"])), ",")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base, more = F.filter("spans", lambda s: s["kind"] != "format"), F.filter("spans", lambda s: s["kind"] == "format")
    like = F.array_join(F.transform(more, lambda s: F.concat_ws(":", s["like"], s["start"], s["end"], F.format_number(s["likelihood"], 3))), ",")
    return rows.select("doc_id", *map(n, KINDS), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"), n("format"), like.alias("formats"))
