"""Operator 13, a Merkle manifest of a dataset whose parents keep the hash states before each child.

A leaf is the SHA-256 of a document's fields. Within a source leaves stand by id; every ``FANOUT`` consecutive nodes become the hash of
their digests as hexadecimal text, until one is left; the sources' subroots become the root likewise. A digest as text is 64 bytes, one
block of SHA-256, so the state of the hash before each child slot is eight words. The manifest stores these states. Folding a replaced
leaf resumes the state before its slot with the new digest and the siblings to its right only, level by level.

The tree is kept in tiers: a row holds up to ``FANOUT ** LEVELS`` consecutive nodes, all digests above them and a state for each child
slot, so a source of n documents takes log(n) / log(729) rounds, each over 729 times fewer rows. Texts are read once, by SQL functions;
then ids and digests are numbered by ranges, so that one source may hold most documents. SHA-256 itself is written in NumPy over many
nodes at a time, because its state must be stored and taken up again by other tasks.

Nulls in any field are ``-``; a null source is a source of its own and comes first, a null id comes before all others. Empty and long
texts are hashed whole. Documents of one id stand by their leaves; rows that are equal in all fields tie, and it makes no difference
which comes first. An empty table gives no rows. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
#: Levels of a tier; its rows hold up to 729 nodes.
LEVELS = 6
#: Columns of an array that are hashed together, so that they stay in the cache.
LANES = 2048


def _primes(n: int) -> list[int]:
    found = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(x: int) -> int:
    r = round(x ** (1 / 3))
    while r**3 > x:
        r -= 1
    while (r + 1) ** 3 <= x:
        r += 1
    return r


#: The first 32 bits of the fractions of square and cube roots of primes, as the standard has them.
START = np.array([math.isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def schedule(words: np.ndarray) -> np.ndarray:
    """The 64 round inputs of blocks of 16 words, (16, n) to (64, n)."""
    w = np.empty((64, words.shape[1]), np.uint32)
    w[:16] = words
    for t in range(16, 64):
        a, b = w[t - 15], w[t - 2]
        w[t] = w[t - 16] + w[t - 7] + (_turn(a, 7) ^ _turn(a, 18) ^ (a >> np.uint32(3))) + (_turn(b, 17) ^ _turn(b, 19) ^ (b >> np.uint32(10)))
    return w + ROUND[:, None]


def rounds(state: np.ndarray, inputs: np.ndarray) -> np.ndarray:
    """The states, (8, n), after blocks whose round inputs are (64, n)."""
    a, b, c, d, e, f, g, h = state
    for w in inputs:
        t = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + w
        s = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        h, g, f, e, d, c, b, a = g, f, e, d + t, c, b, a, t + s
    return state + np.stack([a, b, c, d, e, f, g, h])


def hex_words(digest: np.ndarray) -> np.ndarray:
    """Digests, (8, n), as the words of their hexadecimal text, (16, n)."""
    half = np.stack([digest >> np.uint32(16), digest & np.uint32(0xFFFF)], axis=1).reshape(16, -1)
    half = (half | (half << np.uint32(8))) & np.uint32(0x00FF00FF)
    half = (half | (half << np.uint32(4))) & np.uint32(0x0F0F0F0F)
    letter = ((half + np.uint32(0x06060606)) >> np.uint32(4)) & np.uint32(0x01010101)
    return half + np.uint32(0x30303030) + letter * np.uint32(0x27)


def absorbed(state: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """The states, (8, n), after one child digest each, (8, n)."""
    out = np.empty_like(state)
    for i in range(0, state.shape[1], LANES):
        part = slice(i, i + LANES)
        out[:, part] = rounds(state[:, part], schedule(hex_words(digest[:, part])))
    return out


def _closing(n: int) -> np.ndarray:
    block = np.zeros((16, 1), np.uint32)
    block[0], block[15] = 1 << 31, 512 * n
    return schedule(block)[:, 0]


#: Round inputs of the block that ends a message of 0 to FANOUT digests.
CLOSING = np.stack([_closing(n) for n in range(FANOUT + 1)], axis=1)


def closed(state: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The digests, (8, n), of nodes with so many children."""
    out = np.empty_like(state)
    for i in range(0, state.shape[1], LANES):
        part = slice(i, i + LANES)
        out[:, part] = rounds(state[:, part], CLOSING[:, counts[part]])
    return out


def levels_of(n: int) -> int:
    """How often ``n`` nodes are gathered until one is left."""
    k = 0
    while FANOUT**k < n:
        k += 1
    return k


def grown(leaves: np.ndarray, height: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """All digests of ``g`` trees over m leaves each, (8, g, m), level by level, and the states before each child's slot."""
    digests, states = [leaves], []
    g = leaves.shape[1]
    for _ in range(height):
        now = digests[-1]
        m = now.shape[2]
        p = -(-m // FANOUT)
        state = np.repeat(START, g * p).reshape(8, g, p)
        before = np.empty((8, g, m), np.uint32)
        for k in range(FANOUT):
            child = now[:, :, k::FANOUT]
            some = child.shape[2]
            before[:, :, k::FANOUT] = state[:, :, :some]
            state[:, :, :some] = absorbed(state[:, :, :some].reshape(8, -1), child.reshape(8, -1)).reshape(8, g, some)
        counts = np.full(p, FANOUT)
        counts[-1] = m - FANOUT * (p - 1)
        digests.append(closed(state.reshape(8, -1), np.tile(counts, g)).reshape(8, g, p))
        states.append(before)
    return digests, states


def _bytes(levels: list[np.ndarray]) -> np.ndarray:
    """(8, g, m) for each level as (g, all bytes), level by level."""
    return np.concatenate([np.ascontiguousarray(x.transpose(1, 2, 0)).astype(">u4").view(np.uint8).reshape(x.shape[1], -1) for x in levels], axis=1)


def _words(raw: np.ndarray) -> np.ndarray:
    """(..., 32) bytes as (8, n) words."""
    return np.ascontiguousarray(raw.reshape(-1, 32)).view(">u4").astype(np.uint32).T.copy()


def _fixed(col: pa.Array) -> np.ndarray:
    """The values of a column of 32 bytes each, (n, 32)."""
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, 32)


def _shapes(*columns: np.ndarray) -> Iterator[tuple[tuple[int, ...], np.ndarray]]:
    """The distinct rows of some columns and where they are."""
    kinds, which = np.unique(np.stack(columns, axis=1), axis=0, return_inverse=True)
    for i, kind in enumerate(kinds.tolist()):
        yield tuple(kind), np.flatnonzero(which.ravel() == i)


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds height, digests and states to rows with n (nodes of the whole level) and kids (digests of some consecutive ones)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n, kids = batch["n"].to_numpy(), batch["kids"]
        begin = np.append(0, np.cumsum(kids.value_lengths().to_numpy()))
        flat = _fixed(kids.flatten())
        height = np.array([min(LEVELS, levels_of(x)) for x in n.tolist()])
        digests, states = [b""] * len(n), [b""] * len(n)
        for (m, h), rows in _shapes(np.diff(begin), height):
            leaves = _words(flat[begin[rows][:, None] + np.arange(m)]).reshape(8, len(rows), m)
            made, before = grown(leaves, h)
            for i, x in zip(rows, _bytes(made), strict=True):
                digests[i] = x.tobytes()
            for i, x in zip(rows, _bytes(before) if before else (), strict=bool(before)):
                states[i] = x.tobytes()
        kept = [c for c in batch.schema.names if c != "kids"]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(height, pa.int32()), pa.array(digests, pa.binary()), pa.array(states, pa.binary())], [*kept, "height", "digests", "states"])


#: A step of a path: slot, children of the parent, state before the slot, siblings from left to right.
STEP = 2 + 32 + 32 * (FANOUT - 1)


def paths_of(digests: np.ndarray, states: np.ndarray, m: int, height: int) -> np.ndarray:
    """The steps from each of m nodes up to the top of ``g`` rows' trees, (g, m, height, STEP)."""
    g = len(digests)
    out = np.zeros((g, m, height, STEP), np.uint8)
    place, digest_at, state_at, width = np.arange(m), 0, 0, m
    for level in range(height):
        row = digests[:, digest_at : digest_at + 32 * width].reshape(g, width, 32)
        slot = place % FANOUT
        count = np.minimum(width - (place - slot), FANOUT)
        out[:, :, level, 0], out[:, :, level, 1] = slot, count
        out[:, :, level, 2:34] = states[:, state_at : state_at + 32 * width].reshape(g, width, 32)[:, place]
        for j in range(FANOUT - 1):  # sibling j is child j, or j + 1 from the slot on
            k = j + (j >= slot)
            has = np.flatnonzero(k < count)
            out[:, has, level, 34 + 32 * j : 66 + 32 * j] = row[:, (place - slot + k)[has]]
        digest_at += 32 * width
        state_at += 32 * width
        width = -(-width // FANOUT)
        place = place // FANOUT
    return out


def folded(leaf: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The top digests, (8, n), of replaced leaves, (8, n), along their paths, (n, levels, STEP)."""
    now = leaf
    for level in range(steps.shape[1]):
        step = steps[:, level]
        slot, count = step[:, 0].astype(int), step[:, 1].astype(int)
        state = absorbed(_words(step[:, 2:34]), now)
        others = step[:, 34:].reshape(len(step), FANOUT - 1, 32)
        for right in range(FANOUT - 1):
            rows = np.flatnonzero(slot + right < count - 1)
            if len(rows):
                state[:, rows] = absorbed(state[:, rows], _words(others[rows, (slot + right)[rows]]))
        now = closed(state, count)
    return now


def proofs(steps: np.ndarray) -> list[str]:
    """The SHA-256 of each path's siblings as text."""
    n, levels = steps.shape[:2]
    has = np.arange(FANOUT - 1) < steps[:, :, 1:2].astype(int) - 1
    text = steps[:, :, 34:].reshape(n, levels, FANOUT - 1, 32)[has].tobytes().hex().encode()
    end = np.cumsum(has.sum(axis=(1, 2))) * 64
    return [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(np.append(0, end[:-1]).tolist(), end.tolist(), strict=True)]


def _rows(batch: pa.RecordBatch, nodes: int = 4096) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """Rows of a batch that have one shape, of about so many nodes, with their digests and the steps (rows, nodes, levels, STEP) to the root."""
    path, digests, states, height = (batch[c] for c in ("path", "digests", "states", "height"))
    size = np.array([len(x.as_py()) // 32 for x in digests])
    above = np.array([len(x.as_py()) // STEP for x in path])
    for (total, h, up), every in _shapes(size, height.to_numpy(), above):
        m = next(m for m in range(1, total + 1) if sum(-(-m // FANOUT**k) for k in range(h + 1)) == total)
        most = max(1, nodes // m)
        for at in range(0, len(every), most):
            rows = every[at : at + most]
            one = lambda col: np.stack([np.frombuffer(col[int(i)].as_py(), np.uint8) for i in rows])  # noqa: E731, B023
            d = one(digests)
            steps = paths_of(d, one(states), m, h)
            rest = np.broadcast_to(one(path).reshape(len(rows), 1, up, STEP), (len(rows), m, up, STEP))
            yield rows, m, d, np.concatenate([steps, rest], axis=2)


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row and path of each child: the columns key and roots of its row, its place in the level and its steps to the root."""
    for batch in batches:
        for rows, m, _, steps in _rows(batch):
            if not len(rows):
                continue
            picked = pa.array(np.repeat(rows, m))
            place = np.repeat(batch["place"].take(pa.array(rows)).to_numpy(), m) * FANOUT**LEVELS + np.tile(np.arange(m), len(rows))
            path = [x.tobytes() for x in steps.reshape(len(rows) * m, -1)]
            yield pa.RecordBatch.from_arrays([batch["source"].take(picked), pa.array(place), pa.array(path, pa.binary()), batch["subroot"].take(picked), batch["root"].take(picked)], ["source", "place", "path", "subroot", "root"])


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each leaf: its proof, and the root folded from its replacement."""
    text = lambda words: [x.tobytes().hex() for x in np.ascontiguousarray(words.T).astype(">u4")]
    for batch in batches:
        ids, new = batch["ids"], batch["replaced"]
        begin = np.append(0, np.cumsum(ids.value_lengths().to_numpy()))
        ids, new = ids.flatten(), _fixed(new.flatten()) if batch.num_rows else None
        for rows, m, digests, steps in _rows(batch):
            picked = (begin[rows][:, None] + np.arange(m)).ravel()
            steps = steps.reshape(len(rows) * m, -1, STEP)
            of_row = pa.array(np.repeat(rows, m))
            leaf = [x.tobytes().hex() for x in digests[:, : 32 * m].reshape(-1, 32)]
            out = [ids.take(pa.array(picked)), pa.array(leaf), batch["subroot"].take(of_row), batch["root"].take(of_row), pa.array(proofs(steps)), pa.array(text(folded(_words(new[picked]), steps)))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])


def leaf(*fields: Column) -> Column:
    """The digest of some fields, as bytes: each ``-`` if null, else its bytes, ``:`` and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (f.cast("string") for f in fields)]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def numbered(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``rows`` with place (from 0, by ``order`` in each ``key``) and n (rows of the key).

    Sorted ranges are numbered each for itself and then moved by the counts of those before, so no task holds a whole key.
    """
    by = [F.col(c).asc_nulls_first() for c in key + order]
    ranged = written(rows.repartitionByRange(*by, F.col("tie")).withColumn("part", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("part", *key).agg(F.count(F.lit(1)).alias("some"))
    every = Window.partitionBy(*key)
    ahead = F.coalesce(F.sum("some").over(every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = written(counts.select("part", *key, ahead.alias("ahead"), F.sum("some").over(every).alias("n")), "counts")
    inside = Window.partitionBy("part", *key).orderBy(*[F.col(c).asc_nulls_first() for c in order], F.col("tie"))
    ranked = ranged.withColumn("rank", F.row_number().over(inside))
    met = ranked.part == counts.part
    for c in key:
        met &= ranked[c].eqNullSafe(counts[c])
    return ranked.join(counts, met).select(*(ranked[c] for c in rows.columns if c != "tie"), (F.col("ahead") + F.col("rank") - 1).alias("place"), "n")


@dataclass
class Manifest:
    """The tiers of all sources' trees, from the leaves up, and those of the tree over the subroots. All are written tables."""

    sources: list[DataFrame]
    top: list[DataFrame]


def _tiers(nodes: DataFrame, also: list[str]) -> list[DataFrame]:
    """Tiers of the trees over nodes (source, place, n, digest and, on the lowest tier, other columns)."""
    width = FANOUT**LEVELS
    most = nodes.agg(F.max("n")).first()[0] or 1
    out = []
    while True:
        kids = F.array_sort(F.collect_list(F.struct("place", "digest", *also)))  # of at most ``width`` nodes
        rows = nodes.groupBy("source", "n", F.floor(F.col("place") / width).cast("long").alias("row")).agg(kids.alias("all"))
        picked = lambda c: F.transform("all", lambda k: k[c])
        rows = rows.select("source", F.col("row").alias("place"), "n", picked("digest").alias("kids"), *(picked(c).alias(c) for c in also))
        kinds = {"doc_id": "array<long>", "replaced": "array<binary>"}
        shape = ", ".join(["source string, place long, n long", *(f"{c} {kinds[c]}" for c in also), "height int, digests binary, states binary"])
        out.append(written(rows.mapInArrow(_grow, shape), "tier"))
        if most <= width:
            return out
        most, also = -(-most // width), []
        nodes = out[-1].where(F.col("n") > width).select("source", "place", F.ceil(F.col("n") / width).cast("long").alias("n"), top_digest().alias("digest"))


def top_digest() -> Column:
    return F.expr("substring(digests, -32)")


def manifest(docs: DataFrame, replaced: Column | None = None, fields: tuple[str, ...] = FIELDS, doc_id: str = "doc_id", source: str = "source") -> Manifest:
    """The manifest of some documents; ``replaced`` is another digest of each, for folding."""
    own = leaf(*(F.col(f) for f in fields))
    rows = docs.select(F.col(source).cast("string").alias("source"), F.col(doc_id).cast("long").alias("doc_id"), own.alias("digest"), (own if replaced is None else replaced).alias("replaced"))
    leaves = written(rows.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    sources = _tiers(numbered(leaves, ["source"], ["doc_id", "digest"]), ["doc_id", "replaced"])
    tops = [t.where(F.col("n") <= FANOUT**LEVELS).select("source", top_digest().alias("digest")) for t in sources]
    subroots = tops[0]
    for t in tops[1:]:
        subroots = subroots.unionByName(t)
    placed = written(numbered(subroots.withColumn("tie", F.lit(0)), [], ["source"]), "subroots")
    top = _tiers(placed.select(F.lit(None).cast("string").alias("source"), "place", "n", "digest"), [])
    # the lowest row of the upper tree is found by the source's place
    return Manifest(sources, [*top, placed])


def proved(made: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256 and folded_root of every document of a manifest."""
    *top, placed = made.top
    shape = "source string, place long, path binary, subroot string, root string"
    root = F.lower(F.hex(top_digest()))
    ways = None
    for tier in reversed(top):
        if ways is None:
            rows = tier.withColumns({"path": F.lit(b""), "subroot": F.lit(None).cast("string"), "root": root})
        else:
            rows = tier.join(ways.drop("source"), "place")
        ways = written(rows.select("source", "place", "digests", "states", "height", "path", "subroot", "root").mapInArrow(_descend, shape), "paths")
    ends = placed.join(ways.drop("source"), "place").select(F.col("source").alias("of"), "path", F.lower(F.hex("digest")).alias("subroot"), "root")
    above = None
    for k, tier in reversed(list(enumerate(made.sources))):
        last = F.col("n") <= FANOUT**LEVELS
        rows = tier.where(last).join(ends, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        if above is not None:
            up = above.select(F.col("source").alias("of"), F.col("place").alias("at"), "path", "subroot", "root")
            met = F.col("source").eqNullSafe(F.col("of")) & (F.col("place") == F.col("at"))
            rows = rows.unionByName(tier.where(~last).join(up, met).drop("of", "at"))
        if k:
            above = written(rows.select("source", "place", "digests", "states", "height", "path", "subroot", "root").mapInArrow(_descend, shape), "paths")
    found = rows.select("doc_id", "replaced", "digests", "states", "height", "path", "subroot", "root").withColumnRenamed("doc_id", "ids")
    return found.mapInArrow(_prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest; where 2 divides the checksum of its id its text is folded without line ends."""
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = proved(manifest(docs, leaf(*(text if f == "text" else F.col(f) for f in FIELDS))))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(text if f == "text" else f) for f in FIELDS) + ")"


_EVEN = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)) % 2 = 1"""

OP13_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT *, row_number() OVER (ORDER BY doc_id) AS k, {_sql_leaf("text")} AS leaf,
         CASE WHEN {_EVEN} THEN {_sql_leaf("replace(text, chr(10), '')")} ELSE {_sql_leaf("text")} END AS changed
  FROM documents),
nodes(source, height, place, digest, n) AS (
  SELECT source, 0, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1, leaf, count(*) OVER (PARTITION BY source) FROM docs
  UNION ALL
  SELECT source, height + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), any_value((n + 2) // 3)
  FROM nodes WHERE n > 1 GROUP BY source, height, place // 3),
upper_nodes(height, place, digest, n) AS (
  SELECT 0, row_number() OVER (ORDER BY source NULLS FIRST) - 1, digest, count(*) OVER () FROM nodes WHERE n = 1
  UNION ALL
  SELECT height + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), any_value((n + 2) // 3)
  FROM upper_nodes WHERE n > 1 GROUP BY height, place // 3),
branches AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS branch FROM nodes WHERE n = 1),
steps AS (
  SELECT b.branch, false AS up, m.height, m.place, m.n, m.digest FROM nodes m JOIN branches b ON m.source IS NOT DISTINCT FROM b.source
  UNION ALL SELECT NULL, true, height, place, n, digest FROM upper_nodes),
runs AS (
  SELECT branch, up, height, place // 3 AS parent, any_value(n) AS n, list(digest ORDER BY place) AS digests FROM steps GROUP BY ALL),
walk(k, branch, up, height, place, n, proof, now) AS (
  SELECT k, b.branch, false, 0, p.place, p.n, '', d.changed
  FROM docs d JOIN branches b ON d.source IS NOT DISTINCT FROM b.source
  JOIN (SELECT k AS pk, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM docs) p ON p.pk = d.k
  UNION ALL
  SELECT w.k, w.branch, w.up OR w.n = 1, CASE WHEN w.n = 1 THEN 0 ELSE w.height + 1 END,
    CASE WHEN w.n = 1 THEN w.branch ELSE w.place // 3 END,
    CASE WHEN w.n = 1 THEN (SELECT count(*) FROM branches) ELSE (w.n + 2) // 3 END,
    CASE WHEN w.n = 1 THEN w.proof ELSE w.proof || coalesce(list_aggregate(list_concat(r.digests[1 : w.place % 3], r.digests[w.place % 3 + 2 : 3]), 'string_agg', ''), '') END,
    CASE WHEN w.n = 1 THEN w.now ELSE sha256(list_aggregate(list_concat(r.digests[1 : w.place % 3], [w.now], r.digests[w.place % 3 + 2 : 3]), 'string_agg', '')) END
  FROM walk w LEFT JOIN runs r ON r.branch IS NOT DISTINCT FROM (CASE WHEN w.up THEN NULL ELSE w.branch END) AND r.up = w.up AND r.height = w.height AND r.parent = w.place // 3
  WHERE w.n > 1 OR NOT w.up)
SELECT d.doc_id, d.leaf, b.subroot, (SELECT digest FROM upper_nodes WHERE n = 1) AS root, sha256(coalesce(w.proof, '')) AS proof_sha256, w.now AS folded_root,
       w.now = (SELECT digest FROM upper_nodes WHERE n = 1) AS verified
FROM walk w JOIN docs d USING (k) JOIN branches b ON d.source IS NOT DISTINCT FROM b.source
WHERE w.up AND w.n = 1
"""
