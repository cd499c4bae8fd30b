"""Operator 8, SimHash near-dedup with bit-sliced comparison.

A document's fingerprint has a bit set where over half the XXH64 hashes (seed 42) of its 3-word shingles
have it. Equal fingerprints are one class. Classes within ``RADIUS`` differing bits are linked: of five
bands of the 64 bits at least two are untouched by three differing bits, so fingerprints are dealt ten
times, by each pair of bands, and compared inside the resulting blocks. There the fingerprints lie
vertically, one bit plane after another; for each distance between two rows of a block all pairs are
compared at once, 64 to a machine word, with differing bits added up by carry-save counters, and words
whose pairs all exceed the radius are abandoned. Blocks beyond ``BLOCK`` rows are split into parts,
and each two parts meet in a block of their own, so no task holds a large block and no link is lost.
A block reports a spanning forest of its links, not the links themselves; components follow by
alternating large-star and small-star steps over tables in the shared folder.

Null and empty texts have fingerprint zero and are linked like others; long texts are hashed whole. A null id takes part and is never
the smallest id of a component unless all are null (then component_id is null). Repeated rows give repeated rows; equal
fingerprints tie and are one class; an empty table gives no rows; extra columns, whatever their names, are ignored by
``near_duplicates`` and kept as they are by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import plain_columns, raw_texts, table, unused, written

SHINGLE = 3
RADIUS = 3
#: (first bit, bits) of the five bands.
BANDS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Rows of a part; two parts at most meet in a block.
BLOCK = 1024
#: Rows from which a block is compared by itself.
LARGE = 64
#: Rows that are compared at once, whole blocks together.
CHUNK = 1 << 15


def shingles(text: bytes, words: int = SHINGLE) -> np.ndarray:
    """The hash of each shingle of a UTF-8 text; a text of fewer words is one shingle, one without words has none."""
    w = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not w:
        return np.zeros(0, np.uint64)
    grams = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False)) if len(w) >= words else [b" ".join(w)]
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64, max(1, len(w) - words + 1))


def fingerprint(text: bytes, words: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text."""
    h = shingles(text, words)
    n = len(h)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for part in np.split(h, range(1 << 14, n, 1 << 14)):
        ones += np.add.reduce(np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.uint16)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([*batch.columns[:2], pa.array([fingerprint(t) for t in raw_texts(batch.column(2))], pa.int64())], ["doc_id", "row", "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row (a hash of the text) and fp of every document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, row long, fp long")


def planes_of(fps: np.ndarray) -> np.ndarray:
    """A row for each bit, packed 64 to a word: row b has bit b of every fingerprint. A fingerprint is one word or a row of words."""
    words = fps.reshape(len(fps), fps.shape[1] if fps.ndim > 1 else 1)
    bits = np.unpackbits(np.ascontiguousarray(words.astype("<u8")).view(np.uint8), axis=1, bitorder="little").T
    packed = np.packbits(np.ascontiguousarray(bits), axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view("<u8")


def _moved(planes: np.ndarray, by: int) -> np.ndarray:
    """The planes with row i + by in the place of row i."""
    words, bits = divmod(by, 64)
    out = np.zeros_like(planes)
    out[:, : planes.shape[1] - words] = planes[:, words:]
    if bits:
        out >>= np.uint64(bits)
        out[:, : planes.shape[1] - words - 1] |= planes[:, words + 1 :] << np.uint64(64 - bits)
    return out


def within(differ: Callable[[int, np.ndarray], np.ndarray], asked: np.ndarray, radius: int = RADIUS, planes: int = 64) -> np.ndarray:
    """The bits of ``asked`` (packed pairs, 64 to a word) whose pairs differ in at most ``radius`` of the planes.

    ``differ(b, words)`` tells for some words which of their pairs differ in plane b.
    """
    live = np.flatnonzero(asked)
    mask = asked[live]
    width = max(1, radius.bit_length())
    ahead = (1 << width) - 1 - radius  # counters begin here and run over at radius + 1
    counters = [np.full(len(live), 2**64 - 1 if ahead >> k & 1 else 0, np.uint64) for k in range(width)]
    for b in range(planes):
        if not len(live):
            break
        carry = differ(b, live)
        for k in range(width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        mask &= ~carry
        if b % 8 == 7:
            some = np.flatnonzero(mask)
            if len(some) < 0.8 * len(mask):
                live, mask, counters = live[some], mask[some], [c[some] for c in counters]
    word, bit = np.nonzero(np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return live[word] * 64 + bit


def join_sets(up: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of each a and b in the forest ``up``, and shortens all its paths."""
    while True:
        while not np.array_equal(up, up[up]):
            up[:] = up[up]
        a, b = np.minimum(up[a], up[b]), np.maximum(up[a], up[b])
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(up, b, a)


def _packed(mask: np.ndarray) -> np.ndarray:
    bits = np.packbits(mask, axis=-1, bitorder="little")
    return np.ascontiguousarray(np.pad(bits, [(0, 0)] * (mask.ndim - 1) + [(0, -bits.shape[-1] % 8)])).view("<u8")


def _join_small(fps: np.ndarray, sizes: np.ndarray, up: np.ndarray, radius: int) -> None:
    """Links in many blocks at once, the largest first: row i against row i + 1, then i + 2 ..."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    planes = planes_of(fps)
    for by in range(1, int(sizes.max(initial=0))):
        n = int(sizes[: np.searchsorted(-sizes, -by, "left")].sum())
        words = -(-n // 64)
        here, there = planes[:, :words], _moved(planes, by)[:, :words]
        rows = within(lambda b, w: here[b][w] ^ there[b][w], _packed(np.arange(n) + by < ends[:n]), radius, len(planes))  # noqa: B023
        join_sets(up, rows, rows + by)


def _join_large(fps: np.ndarray, up: np.ndarray, first: int, radius: int, slab: int = 512) -> None:
    """Links in one block: each row's bits, spread over whole words, against all rows' planes."""
    n, planes = len(fps), planes_of(fps)
    words = planes.shape[1]
    for i in range(0, n, slab):
        own = fps[i : i + slab].reshape(len(fps[i : i + slab]), -1)
        spread = [np.where(own[:, b // 64] >> np.uint64(b % 64) & np.uint64(1), np.uint64(2**64 - 1), np.uint64(0)) for b in range(len(planes))]
        asked = _packed(np.arange(n) > np.arange(i, i + len(own))[:, None]).ravel()
        hits = within(lambda b, w: planes[b][w % words] ^ spread[b][w // words], asked, radius, len(planes))  # noqa: B023
        join_sets(up, first + i + hits // (words * 64), first + hits % (words * 64))


def linked(fps: np.ndarray, block: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For rows in runs of equal ``block``: each row's root, the same for rows that a chain of links in its block joins."""
    if not len(block):
        return np.zeros(0, np.int64)
    edge = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    sizes = np.diff(np.append(edge, len(block)))
    by_size = np.argsort(-sizes, kind="stable")
    order = np.concatenate([np.arange(edge[k], edge[k] + sizes[k]) for k in by_size])
    sizes, fps, up = sizes[by_size], fps[order], np.arange(len(order))
    large = int(np.searchsorted(-sizes, -LARGE, "right"))
    at = np.concatenate([[0], np.cumsum(sizes)])
    for k in range(large):
        _join_large(fps[at[k] : at[k + 1]], up, int(at[k]), radius)
    rest = up[at[large] :] - at[large]
    _join_small(fps[at[large] :], sizes[large:], rest, radius)
    up[at[large] :] = rest + at[large]
    root = np.empty(len(order), np.int64)
    root[order] = order[up]
    return root


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (block, fp), sorted by block: pairs (a, b) of fingerprints that span the links of each block."""
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def done(block: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        root = linked(fp.view(np.uint64), block)
        pairs = np.unique(np.stack([fp, fp[root]])[:, root != np.arange(len(root))], axis=1)
        return pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    for batch in batches:
        kept.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
        held += batch.num_rows
        if held >= CHUNK:
            block, fp = (np.concatenate(x) for x in zip(*kept, strict=True))
            cut = int(np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))[-1])
            if cut:  # the last block may go on in the next batch
                yield done(block[:cut], fp[:cut])
            kept, held = [(block[cut:], fp[cut:])], len(block) - cut
    if held:
        yield done(*(np.concatenate(x) for x in zip(*kept, strict=True)))


def links(fps: DataFrame) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``fp`` at most ``RADIUS`` bits apart."""
    band = lambda i: F.shiftrightunsigned("fp", BANDS[i][0]).bitwiseAND((1 << BANDS[i][1]) - 1)
    keys = [F.lit(t).cast("long") * (1 << 26) + band(i) * (1 << 13) + band(j) for t, (i, j) in enumerate(combinations(range(len(BANDS)), 2))]
    dealt = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / BLOCK)
    part = F.pmod(F.xxhash64("fp"), parts)
    met = dealt.join(sizes, "key").withColumn("parts", parts).withColumn("part", part)
    met = met.withColumn("other", F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0).cast("long"))).otherwise(F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda x: x != F.col("part")))))
    block = F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other"))
    rows = met.select(block.alias("block"), "fp").repartition("block").sortWithinPartitions("block", "fp")
    return rows.mapInArrow(_forest, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component that has an edge (a, b)."""
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        edges = written(small, "edges")
        # order of rows and of sums does not matter to these figures; equal ones mean an equal set of edges
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).distinct()
        before = now


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id of its component, for every document."""
    rows = written(fingerprints(docs, doc_id, text), "fingerprints")
    return grouped(rows, links(rows.select("fp").distinct()))


def grouped(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` (doc_id, row, fp) with root and component_id, by links (a, b) between values of fp."""
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(edges)
    rooted = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "row", "fp", "root", "component_id")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", found: Callable[..., DataFrame] = near_duplicates) -> DataFrame:
    """One document of each component, that with the smallest id (nulls last); all columns stay.

    ``found`` names the components, as ``near_duplicates`` does. If the smallest id is repeated in its component, the text with the smaller hash stays, once.
    """
    d, r, z, n = (unused(docs, x) for x in ("one_id", "one_row", "one_null", "one_turn"))
    # ids without nulls, so that joins and windows deal rows alike
    keys = lambda col: {d: F.coalesce(col, F.lit(0).cast("long")), z: col.isNull()}
    rows = found(docs, doc_id, text)
    kept = rows.where(F.col("component_id").eqNullSafe(F.col("doc_id"))).groupBy("root").agg(F.min("doc_id").alias("least"), F.min("row").alias("first"))
    stays = F.col("doc_id").eqNullSafe(F.col("least")) & (F.col("row") == F.col("first"))
    each = rows.join(kept, "root").groupBy("doc_id", "row").agg(F.max(stays).alias("stays"), F.count(F.lit(1)).alias("n"))
    each = written(each.where(~F.col("stays") | (F.col("n") > 1)).withColumns(keys(F.col("doc_id"))).select(d, z, F.col("row").alias(r), "stays"), "copies")
    # texts meet only what goes, not all that stays; of rows that are repeated as they are, one is numbered out. What goes grows
    # with the documents, so it is merged at every size rather than broadcast while it is small
    mine = docs.withColumns({**keys(F.col(doc_id).cast("long")), r: F.xxhash64(text)})
    rest = mine.join(each.where(~F.col("stays")).drop("stays").hint("merge"), [d, r, z], "left_anti")
    twice = each.where("stays").drop("stays")
    if twice.isEmpty():
        return rest.select(*docs.columns)
    once = Window.partitionBy(d, r, z).orderBy(F.xxhash64(*plain_columns(docs)))
    numbered = rest.join(twice, [d, r, z], "left_semi").withColumn(n, F.row_number().over(once)).where(F.col(n) == 1)
    return rest.join(twice, [d, r, z], "left_anti").select(*docs.columns).unionByName(numbered.select(*docs.columns))
