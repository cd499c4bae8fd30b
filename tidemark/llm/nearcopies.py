"""Near copies for the pipeline: texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more, by SimHash.

Texts with equal sets are one class. Candidates come from operator 8's method at a radius wide enough for 0.8:
each set has a fingerprint of ``BITS`` bits, the first ``WORDS`` words of which are compared bit-sliced. Two sets at
0.8 differ in 15 % of the bits, so no bands of 64 bits at that distance stay free of differences and small. Hence
fingerprints are dealt ``DEALS`` times, by ``PICKED`` bits each time, and compared inside the resulting blocks. A pair at
0.8 shares no block with probability 5e-7 and differs in more than ``RADIUS`` bits with 1e-7, and a closer pair with less.
Blocks beyond ``BLOCK`` rows are dealt anew in parts that meet two by two, so no task compares a large block.

An exact check follows: groups that candidates join are gathered once with their texts; there every pair is
compared by its exact sets, so what is linked is exact. Groups beyond ``PART`` classes are split into parts that
meet two by two. Components of the links follow as in operator 8.

Words are as in operator 8. Texts without words have the empty set and are one class. Ids may be null or repeated, as
in operator 8; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import raw_texts, written
from tidemark.llm.simhash import components, grouped, join_sets, linked, shingles

SHINGLE = 5
#: Texts are linked from this similarity on, as a fraction.
ALIKE = (4, 5)
#: Bits of a fingerprint, words of it that are compared, and differing bits there at most.
BITS, WORDS, RADIUS = 1024, 3, 57
#: Times that a fingerprint is dealt, and bits that each time deal it by.
DEALS, PICKED = 176, 14
#: Fingerprints of a part; two parts at most meet in a block.
BLOCK = 2048
#: Fingerprints that are compared at once, whole blocks together.
COMPARED = 1 << 17
#: Classes of a part; two parts at most meet in a block.
PART = 512
#: Bytes of texts that are compared at once, whole blocks together.
CHUNK = 1 << 22

_RNG = np.random.default_rng(8)
_TIMES = _RNG.integers(0, 2**64, BITS // 64, np.uint64) | np.uint64(1)
_MIX, *_NAME = _RNG.integers(0, 2**64, WORDS + 1, np.uint64) | np.uint64(1)
_PICK = np.stack([_RNG.permutation(BITS)[:PICKED] for _ in range(DEALS)])


def shingle_set(text: bytes) -> np.ndarray:
    return np.unique(shingles(text, SHINGLE))


def fingerprint(held: np.ndarray) -> np.ndarray:
    """The bytes of a set's fingerprint: a bit is set where over half the hashes, mixed anew for each word, have it."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(held), 255):  # so many ones fit in a byte
        x = held[i : i + 255, None] * _TIMES
        x ^= x >> np.uint64(32)
        x *= _MIX
        x ^= x >> np.uint64(29)
        ones += np.add.reduce(np.unpackbits(x.astype("<u8", copy=False).view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(held), bitorder="little")


def names(words: np.ndarray) -> np.ndarray:
    """One number for the compared words of each fingerprint."""
    return (words * np.array(_NAME, np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t) for t in raw_texts(batch.column(2))]
        fp = np.array([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets], np.uint64).view(np.int64)
        bits = np.array([fingerprint(s) for s in sets], np.uint8).reshape(len(sets), BITS // 8)
        near = names(bits.view("<u8")[:, :WORDS])
        yield pa.record_batch([*batch.columns[:2], pa.array(fp), pa.array(near), pa.array([b.tobytes() for b in bits], pa.binary())], ["doc_id", "row", "fp", "near", "bits"])


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row (a hash of the text), fp (a hash of the set of shingles), bits (its fingerprint) and near (its compared words' name) of every document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_sketches, "doc_id long, row long, fp long, near long, bits binary")


_COMPARED = [f"w{k}" for k in range(WORDS)]
_ROW = ", ".join(["block long", *(f"{w} long" for w in _COMPARED)])


def _rows(block: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(block.astype(np.int64, copy=False)), *(pa.array(np.ascontiguousarray(w).view(np.int64)) for w in words.T)], ["block", *_COMPARED])


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint once for each deal, with the block that it falls into."""
    deal = np.arange(DEALS) << PICKED
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            own = np.frombuffer(b"".join(batch.column(0).slice(i, 512).to_pylist()), np.uint8).reshape(-1, BITS // 8)
            bits = np.unpackbits(own, axis=1, bitorder="little")[:, _PICK.ravel()].reshape(len(own), DEALS, PICKED)
            block = deal + np.packbits(bits, axis=2, bitorder="little").view("<u2")[:, :, 0]
            yield _rows(block.ravel(), np.repeat(own.view("<u8")[:, :WORDS], DEALS, axis=0))


def _compared(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over fingerprints sorted by block: links (-1, a, b, 0) between names that span those of some blocks at once.

    Blocks beyond ``most`` rows, if it is not 0, come out as they are.
    """

    def done(block: np.ndarray, words: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, turn, sizes = np.unique(block, return_inverse=True, return_counts=True)
        large = sizes[turn] > (most or len(block))
        if large.any():
            yield _rows(block[large], words[large])
        block, words = block[~large], words[~large]
        # one forest over all these blocks, each name to the least: blocks then agree on most links of a large group
        name, own = np.unique(names(words), return_inverse=True)
        up = np.arange(len(name))
        join_sets(up, own, own[linked(words, block, RADIUS)])
        pairs = np.stack([name, name[up]])[:, up != np.arange(len(up))]
        if pairs.shape[1]:
            yield _rows(np.full(pairs.shape[1], -1), np.vstack([pairs, np.zeros((WORDS - 2, pairs.shape[1]), np.int64)]).T.view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        held, over = 0, None
        for batch in batches:
            block, *cols = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            words = np.stack(cols, axis=1).view(np.uint64)
            if over is not None:
                more = block == over  # the large block goes on
                if more.any():
                    yield _rows(block[more], words[more])
                block, words = block[~more], words[~more]
            kept.append((block, words))
            held += len(block)
            if held >= COMPARED:
                block, words = (np.concatenate(x) for x in zip(*kept, strict=True))
                cut = int(np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))[-1])
                if cut:  # the last block may go on in the next batch
                    yield from done(block[:cut], words[:cut])
                kept, held = [(block[cut:], words[cut:])], len(block) - cut
                if most and held > most:
                    yield _rows(*kept[0])
                    over, kept, held = block[-1], [], 0
        if held:
            yield from done(*(np.concatenate(x) for x in zip(*kept, strict=True)))

    return run


def _fewer(links: DataFrame) -> DataFrame:
    """The same components by fewer links: what a name is linked to, a few for each deal, is linked to the least of it."""
    each = links.groupBy("a").agg(F.min("b").alias("least"), F.collect_set("b").alias("all"))
    return each.select(F.explode(F.concat(F.array("a"), F.filter("all", lambda b: b != F.col("least")))).alias("a"), F.col("least").alias("b")).distinct()


def near_names(rows: DataFrame) -> DataFrame:
    """Links (a, b) between names ``near`` of fingerprints that a block brings together, at most ``RADIUS`` bits apart; they span all such."""
    each = rows.groupBy("near").agg(F.min("bits").alias("bits")).select("bits")
    in_blocks = lambda dealt: dealt.repartition("block").sortWithinPartitions("block")
    found = written(in_blocks(each.mapInArrow(_dealt, _ROW)).mapInArrow(_compared(BLOCK), _ROW), "compared")
    links = found.where("block = -1").select(F.col("w0").alias("a"), F.col("w1").alias("b"))
    large = found.where("block <> -1")
    if large.isEmpty():
        return _fewer(links)
    sizes = large.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    met = large.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64(*_COMPARED), F.col("parts")))
    met = met.withColumn("other", F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda x: x != F.col("part"))))
    block = F.xxhash64("block", F.least("part", "other"), F.greatest("part", "other"))
    rest = in_blocks(met.select(block.alias("block"), *_COMPARED)).mapInArrow(_compared(0), _ROW)
    return _fewer(links.unionByName(rest.select(F.col("w0").alias("a"), F.col("w1").alias("b"))))


def candidates(rows: DataFrame) -> DataFrame:
    """(node, root): classes fp that a chain of close fingerprints joins, with one name for each such group."""
    one = rows.groupBy("fp").agg(F.first("near").alias("near"))
    found = components(near_names(rows))
    found = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    several = one.groupBy("near").agg(F.count(F.lit(1)).alias("n"))  # classes may have equal fingerprints
    named = several.join(found, F.col("near") == F.col("node"), "left").where("n > 1 or root is not null").select("near", F.coalesce("root", "near").alias("root"))
    return one.join(named, "near").select(F.col("fp").alias("node"), "root")


def alike(sets: list[np.ndarray], block: np.ndarray) -> np.ndarray:
    """For sets in runs of equal ``block``: each one's root, the same for those that a chain of alike sets in its block joins."""
    up = list(range(len(sets)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    edge = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
    for first, end in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        own = sets[first:end]
        size = np.array([len(s) for s in own])
        # the rows that hold each shingle lie together, in the order of rows
        terms, term = np.unique(np.concatenate(own), return_inverse=True)
        holders = np.repeat(np.arange(len(own)), size)[np.argsort(term, kind="stable")]
        start = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))])
        at = np.concatenate([[0], np.cumsum(size)])
        left = len(own) - 1  # joins until all are one
        for i in range(len(own) - 1):
            if not left:
                break
            mine = term[at[i] : at[i + 1]]
            runs = start[mine + 1] - start[mine]
            places = np.arange(runs.sum()) + np.repeat(start[mine] - (np.cumsum(runs) - runs), runs)
            both = np.bincount(holders[places], minlength=len(own))
            both[: i + 1] = 0
            for j in np.flatnonzero((both > 0) & (both * ALIKE[1] >= (size[i] + size - both) * ALIKE[0])).tolist():
                a, b = root(first + i), root(first + j)
                if a != b:
                    up[max(a, b)] = min(a, b)
                    left -= 1
    return np.array([root(x) for x in range(len(sets))], np.int64)


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (block, fp, text), sorted by block: pairs (a, b) of classes that span the links of each block."""
    blocks: list[np.ndarray] = []
    fps: list[np.ndarray] = []
    sets: list[np.ndarray] = []
    held = 0

    def done(block: np.ndarray, fp: np.ndarray, own: list[np.ndarray]) -> pa.RecordBatch:
        root = alike(own, block)
        apart = (root != np.arange(len(root))) & (fp != fp[root])
        return pa.record_batch([pa.array(fp[apart]), pa.array(fp[root][apart])], ["a", "b"])

    for batch in batches:
        blocks.append(batch.column(0).to_numpy(zero_copy_only=False))
        fps.append(batch.column(1).to_numpy(zero_copy_only=False))
        sets += [shingle_set(t) for t in raw_texts(batch.column(2))]
        held += batch.column(2).nbytes
        if held >= CHUNK:
            block, fp = np.concatenate(blocks), np.concatenate(fps)
            cut = int(np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))[-1])
            if cut:  # the last block may go on in the next batch
                yield done(block[:cut], fp[:cut], sets[:cut])
            blocks, fps, sets, held = [block[cut:]], [fp[cut:]], sets[cut:], 0
    if sets:
        yield done(np.concatenate(blocks), np.concatenate(fps), sets)


def links(docs: DataFrame, rows: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spanning links (a, b) between the classes of ``rows`` whose sets are alike."""
    near = candidates(rows)
    sizes = near.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    one = rows.groupBy("fp").agg(F.min(F.struct("doc_id", "row")).alias("one"))
    # as many as there are documents with a near copy: merged at every size rather than broadcast while they are few
    asked = written(near.join(sizes, "root").join(one, F.col("node") == F.col("fp")).select("fp", "root", "parts", F.col("one.doc_id").alias("__id"), F.col("one.row").alias("__row")), "candidates")
    texts = docs.select(F.col(doc_id).cast("long").alias("own"), F.xxhash64(text).alias("hash"), F.col(text).cast("string").alias("text"))
    met = texts.join(asked.hint("merge"), F.col("own").eqNullSafe(F.col("__id")) & (F.col("hash") == F.col("__row"))).withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
    zero = F.lit(0).cast("long")
    met = met.withColumn("other", F.explode(F.when(F.col("parts") == 1, F.array(zero)).otherwise(F.filter(F.sequence(zero, F.col("parts") - 1), lambda x: x != F.col("part")))))
    block = F.xxhash64("root", F.least("part", "other"), F.greatest("part", "other"))
    blocks = met.select(block.alias("block"), "fp", "text").repartition("block").sortWithinPartitions("block", "fp")
    return blocks.mapInArrow(_alike, "a long, b long").distinct()


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row, fp, root and component_id, the smallest doc_id of its component, for every document."""
    rows = written(sketches(docs, doc_id, text), "sketches")
    return grouped(rows.drop("near", "bits"), links(docs, rows, doc_id, text))
