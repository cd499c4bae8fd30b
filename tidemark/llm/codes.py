"""Operator 12, vector codes by k-means in parts with adaptive bounds.

Components become integers, a vector is cut into equal parts, and each part has a codebook of its own. Codebooks begin as
the parts of the first vectors and are moved to the means of the parts they hold, round by round.

Only the first round measures every part against every entry. It persists, for each part, the code, the ``b`` closest entries
after it with lower bounds of their distances, in rising order, and one outer bound below all other distances. Later rounds
take from each bound what its entry has moved since (from the outer bound, what any entry has moved at most) and make the row rise again
from the far end. The distance to the part's own entry is taken exactly; where it lies below the first bound the code stays. Otherwise the
entries whose bounds do not exceed it are measured in integers, and where it is not below the outer bound, all of them.
How deep the bounds were needed is counted over each batch of rows, which then keeps the smallest ``b`` that served ``SERVED`` of its parts that
bounds could serve, from ``LEAST`` up to the present one. Bounds are kept in 16 bits and always rounded down, so they decide only what is
certain; every code is that of an exhaustive search over exact integers, ties going to the lower index.

Partial sums of a batch are added in SQL by part and entry: at most 1,024 rows a batch, whatever the vectors. Codebooks (parts x entries)
are all that reaches the driver and the tasks. No vector is shuffled but to meet the sum of its label.

Vectors that are null or hold null or non-finite components are dropped. The length is that which most vectors have (the shorter of
two as frequent) among the lengths that can be cut; vectors of other lengths have no parts and are dropped. Components of ``LARGEST`` or more
are refused with an error, since their distances are not exact. Fewer vectors than entries make a smaller codebook. A null id
comes after all others; of one id the vector that is smaller component by component comes first, and repeated rows are coded
each for itself. Null labels count together. An empty table gives no rows. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, written

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Bounds of the first round, and the fewest that later rounds keep.
FIRST, LEAST = ENTRIES // 4, ENTRIES // 8
SERVED = 0.99
#: Components below this give squared distances of a part below 2^53.
LARGEST = 1 << 23
#: Vectors that are handled together in a task.
ROWS = 1024


def squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of (n, d) integers from (k, d), as floats."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ book.T) + (book * book).sum(axis=1)


def lower(x: np.ndarray) -> np.ndarray:
    """The largest 16-bit floats that are not above ``x``; below zero it is no bound at all and stays below."""
    y = np.clip(x, -60000, 60000).astype(np.float16)
    return np.where(y > x, np.nextafter(y, np.float16(-np.inf)), y)


def searched(x: np.ndarray, book: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code, squared distance, closest other entries, their bounds and the outer bound, by an exhaustive search."""
    d = squared(x, book)
    n, k = d.shape
    code = d.argmin(axis=1)
    own = d[np.arange(n), code]
    d[np.arange(n), code] = np.inf
    b = min(b, k - 1)
    near = np.argpartition(d, b - 1, axis=1)[:, :b] if b else np.zeros((n, 0), np.int64)
    found = np.take_along_axis(d, near, axis=1)
    order = found.argsort(axis=1)
    near, found = np.take_along_axis(near, order, axis=1), np.take_along_axis(found, order, axis=1)
    np.put_along_axis(d, near, np.inf, axis=1)
    # a root is rounded by less than a unit of its last place, which the 16-bit floats lie far below
    return code, own, near, lower(np.sqrt(found) * (1 - 1e-12)), lower(np.sqrt(d.min(axis=1)) * (1 - 1e-12))


def bounded(x: np.ndarray, code: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray, book: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``searched``, from the bounds of the round before and what each entry has moved; last, how many bounds each part needed.

    One more than there are bounds stands for a part that was measured against all entries.
    """
    n, b = near.shape
    outer = outer.astype(float) - moved.max(initial=0)
    low = low.astype(float) - moved[near]
    low = np.minimum.accumulate(np.concatenate([low, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
    diff = x - book[code]
    own = (diff * diff).sum(axis=1)
    up = np.sqrt(own) * (1 + 1e-12)
    depth = (low <= up[:, None]).sum(axis=1)  # bounds rise, so these are the first ones
    code, near, low, outer = code.copy(), near.copy(), low[:, :b], low[:, b].copy()
    for z in np.unique(depth[(depth > 0) & (depth <= b)]).tolist():
        rows = np.flatnonzero(depth == z)
        some = np.concatenate([code[rows, None], near[rows, :z]], axis=1)
        diff = x[rows, None, :] - book[some]
        d = (diff * diff).sum(axis=2)
        # the own entry leads, the others follow by distance and index
        order = np.lexsort((some, d), axis=1)
        some, d = np.take_along_axis(some, order, axis=1), np.take_along_axis(d, order, axis=1)
        code[rows], own[rows] = some[:, 0], d[:, 0]
        near[rows, :z] = some[:, 1:]
        low[rows, :z] = np.minimum(np.sqrt(d[:, 1:]) * (1 - 1e-12), low[rows, z, None] if z < b else outer[rows, None])
    rows = np.flatnonzero(depth > b)
    low, outer = lower(low), lower(outer)
    if len(rows):
        code[rows], own[rows], near[rows], low[rows], outer[rows] = searched(x[rows], book, b)
    return code, own, near, low, outer, depth


def vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = PARTS) -> DataFrame:
    """vec_id, label and the integer components of the vectors that can be coded."""
    x = F.col(embedding)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = rows.where(x.isNotNull() & finite).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), x.alias("x"))
    cut = sound.where((F.size("x") > 0) & (F.size("x") % parts == 0))
    length = cut.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    whole = F.transform("x", lambda v: F.floor(v.cast("double") * SCALE).cast("double"))
    checked = F.transform(whole, lambda v: F.when(F.abs(v) < LARGEST, v.cast("int")).otherwise(F.raise_error(F.lit(f"components must be below {LARGEST / SCALE}")).cast("int")))
    return cut.where(F.size("x") == (length["d"] if length else 0)).select("vec_id", "label", checked.alias("ints"))


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """(parts, entries, d): the parts of the vectors with the smallest ids."""
    found = rows.select("vec_id", "ints").orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    d = len(found[0]["ints"]) // parts if found else 0
    return np.array([r["ints"] for r in found], float).reshape(len(found), parts, d).transpose(1, 0, 2).copy()


def _ints(batch: pa.RecordBatch) -> np.ndarray:
    return batch["ints"].flatten().to_numpy().astype(float).reshape(batch.num_rows, -1)


def _packed(col: pa.Array, kind: type, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(len(col), *shape)


def _round(books: np.ndarray, moved: np.ndarray | None, keep: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One assignment of all parts, as new state of at most ``keep`` bounds: by an exhaustive search, or from the state before."""
    parts, k, d = books.shape
    keep = min(keep, k - 1)

    def coded_rows(batch: pa.RecordBatch, had: int) -> pa.RecordBatch:
        """Rows that all have so many bounds."""
        n = batch.num_rows
        x = _ints(batch).reshape(n, parts, d)
        depths = np.zeros(k + 1, np.int64)
        if moved is None:
            b = keep
            found = [searched(x[:, p], books[p], b) for p in range(parts)]
        else:
            code, near, low, outer = _packed(batch["code"], np.uint8, parts), _packed(batch["near"], np.uint8, parts, had), _packed(batch["low"], np.float16, parts, had), _packed(batch["outer"], np.float16, parts)
            found = []
            for p in range(parts):
                *f, depth = bounded(x[:, p], code[:, p].astype(int), near[:, p].astype(int), low[:, p], outer[:, p], books[p], moved[p])
                found.append(f)
                depths += np.bincount(np.where(depth > had, k, depth), minlength=k + 1)
            b = min(keep, kept_bounds(depths[:k], had))
        code, errors, near, low, outer = (np.stack(c, axis=1) for c in zip(*found, strict=True))
        if b < near.shape[2]:  # a bound that is dropped joins the outer one
            outer = np.minimum(outer, low[:, :, b])
        pack = lambda a, kind: pa.array([r.tobytes() for r in a.astype(kind)], pa.binary())
        spent = [depths.tolist()] + [None] * (n - 1)
        out = [batch["vec_id"], batch["label"], batch["ints"], pack(code, np.uint8), pack(near[:, :, :b], np.uint8), pack(low[:, :, :b], np.float16), pack(outer, np.float16), pa.array(errors.astype(np.int64).tolist(), pa.list_(pa.int64())), pa.array(spent, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(out, ["vec_id", "label", "ints", "code", "near", "low", "outer", "errors", "depths"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            had = np.zeros(batch.num_rows, int) if moved is None else np.array([len(x.as_py()) // parts for x in batch["near"]], int)
            for b in np.unique(had).tolist():
                rows = np.flatnonzero(had == b)
                for at in range(0, len(rows), ROWS):
                    yield coded_rows(batch.take(pa.array(rows[at : at + ROWS])), b)

    return run


def _sums(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x, code = _ints(batch).astype(np.int64).reshape(n, parts, -1), _packed(batch["code"], np.uint8, parts)
            out = []
            for p in range(parts):
                used, which = np.unique(code[:, p], return_inverse=True)
                total = np.zeros((len(used), x.shape[2]), np.int64)
                np.add.at(total, which, x[:, p])
                out += [(p, int(c), at, int(v), int(m)) for c, row, m in zip(used, total, np.bincount(which), strict=True) for at, v in enumerate(row)]
            yield pa.RecordBatch.from_pylist([dict(zip(("part", "entry", "at", "total", "n"), r, strict=True)) for r in out])

    return run


def moved_books(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks at the floored means of the parts they hold; unused entries stay."""
    sums = rows.select("ints", "code").mapInArrow(_sums(books.shape[0]), "part long, entry long, at long, total long, n long")
    new = books.copy()
    for r in sums.groupBy("part", "entry", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect():  # parts x entries x d rows
        new[r["part"], r["entry"], r["at"]] = int(r["total"]) // r["n"]
    return new


def kept_bounds(depths: np.ndarray, b: int) -> int:
    """How many bounds are kept next, where so many parts needed 0, 1 ... ``b`` bounds."""
    within = np.cumsum(depths[: b + 1])
    return min(b, max(LEAST, int(np.argmax(within >= SERVED * within[-1]))))


def coded(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, first: int = FIRST) -> tuple[DataFrame, np.ndarray, list[list[int]]]:
    """The vectors (vec_id, label, ints, from ``vectors``) with code (a byte a part) and errors (exact squared distances, a part each); the
    codebooks; and for each round how many parts needed 0, 1 ... bounds, those measured against all entries last (none in the first).
    """
    schema = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, ints array<int>, code binary, near binary, low binary, outer binary, errors array<long>, depths array<long>"
    books = first_books(rows, parts, entries)
    uses: list[list[int]] = []
    if not books.size:
        return rows.sparkSession.createDataFrame([], schema), books, uses
    moved, now = None, rows
    for k in range(rounds + 1):
        now = written(now.mapInArrow(_round(books, moved, first if k < rounds else 0), schema), "codes")
        spent = {r["pos"]: r["n"] for r in now.where("depths is not null").select(F.posexplode("depths")).groupBy("pos").agg(F.sum("col").alias("n")).collect()}  # a number a depth
        uses.append([spent.get(i, 0) for i in range(books.shape[1] + 1)])
        if k < rounds:
            new = moved_books(now, books)
            step = new - books
            moved, books = np.sqrt((step * step).sum(axis=2)) * (1 + 1e-12), new
    return now, books, uses


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def code_text(code: Column) -> Column:
    return F.lower(F.hex(code))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code and errors."""
    rows, books, _ = coded(vectors(table(spark, sf_dir, "embeddings")))
    error = F.aggregate("errors", F.lit(0).cast("long"), lambda a, e: a + e)
    rows = rows.select("vec_id", "label", code_text(F.col("code")).alias("code"), error.alias("error"))
    sums = written(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "labels")
    rows = rows.join(sums, rows.label.eqNullSafe(sums.of))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))


def _sql_round(n: int) -> str:
    """CTEs: the assignment to books ``n``, and the books after it."""
    return f"""
near{n} AS MATERIALIZED (
  SELECT k, part, arg_min(entry, (dist, entry)) AS entry, min(dist) AS dist FROM (
    SELECT p.k, p.part, b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist FROM parts p JOIN book{n} b USING (part))
  GROUP BY k, part),
book{n + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{n} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY j) AS v FROM (
      SELECT part, entry, j, ((s - ((s % n) + n) % n) // n)::BIGINT AS mean FROM (
        SELECT part, entry, j, sum(x)::BIGINT AS s, count(*) AS n FROM (
          SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM parts JOIN near{n} USING (k, part))
        GROUP BY ALL)) GROUP BY part, entry) m USING (part, entry))"""


OP12_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS ints,
         row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS k
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT k, p::INTEGER AS part, ints[p * len(ints) // {PARTS} + 1 : (p + 1) * len(ints) // {PARTS}] AS v FROM kept, range({PARTS}) AS r(p)),
book0 AS MATERIALIZED (SELECT part, k - 1 AS entry, v FROM parts WHERE k <= {ENTRIES}),
{_sql_round(0)}, {_sql_round(1)}, {_sql_round(2)},
codes AS (SELECT k, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM near2 GROUP BY k)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book2) AS codebooks_sha256
FROM kept JOIN codes USING (k)
"""
