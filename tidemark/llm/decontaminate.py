"""Operator 1, benchmark decontamination: a distributed positional inverted index of the training tokens.

``build_index`` turns blocks of documents into index shards: for each distinct term the sorted
token positions inside the block. The shards are stored as a table, one row a shard, so each is
searched where it lies and no posting is shuffled. ``search`` looks the test phrases up: the lists
of a phrase, shifted by each term's offset, are intersected from the rarest term on. The benchmark's terms are stored too; a task
holds a few shards and takes the whole benchmark past them, block by block, so one pass over the index serves a
benchmark of any size, and nothing of it goes through the driver.

Terms are the maximal runs of ASCII letters (A-Z lowered), digits and non-ASCII characters, known by
64-bit hashes. Null or empty texts have no terms and give rows without hits; a long document is a shard of its own, searched
whole; repeated rows give repeated rows; an empty table of documents gives no rows, an empty benchmark no hits; an item
without an id hits words but is not among the items found; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import new_path, rows_by_bytes, table, text_bytes, unused, written

#: Bytes of text in a shard; a longer document is a shard of its own.
SHARD_BYTES = 2 << 20
#: Words of test phrases that are searched at once.
BLOCK_WORDS = 1 << 20
#: Bytes of shards that a task holds while the benchmark goes past, and of a benchmark that it keeps rather than reads again.
HELD_BYTES, KEPT_BYTES = 12 << 20, 32 << 20
#: Candidate places held at once in the intersection.
CANDIDATES = 1 << 20
PHRASE = 10

_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x41:0x5B] = _IS_WORD[0x80:] = True
_CODE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODE[0x41:0x5B] = _CODE[0x61:0x7B]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        have = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, SHARD_BYTES + 1) - 1, base)]), dtype=np.uint64)
        if n <= SHARD_BYTES + 1:
            _powers[str(base)] = have
    return have[:n]


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The term hashes of some rows' texts in order, and the number of terms of each row."""
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    word = _IS_WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * _power(_BASE, n), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h, np.diff(np.searchsorted(starts, offsets))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        for i, j in rows_by_bytes(offsets, SHARD_BYTES):
            h, n = terms_of(data, offsets[i : j + 1])
            order = np.argsort(h, kind="stable").astype(np.uint32)
            terms, first = np.unique(h[order], return_index=True)
            counts = np.diff(np.append(first, len(h))).astype(np.uint32)
            steps = np.diff(order, prepend=np.uint32(0)).astype(np.uint32)  # wraps at the start of a list
            yield pa.record_batch(
                [*(pa.array([c.slice(i, j - i).to_pylist()], pa.list_(pa.int64())) for c in (batch.column(0), batch.column(2))), pa.array([n.tolist()], pa.list_(pa.int64())), *(pa.array([x.tobytes()], pa.binary()) for x in (terms, counts, steps))],
                ["doc_ids", "rows", "n_words", "terms", "counts", "steps"],
            )


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index: doc_ids, rows (hashes of the texts) and n_words (lists by document), terms, counts and steps of the positions."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.xxhash64(text).alias("row"))
    return written(rows.mapInArrow(_shards, "doc_ids array<long>, rows array<long>, n_words array<long>, terms binary, counts binary, steps binary"), "postings")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        out = [terms_of(data, offsets[i : i + 2])[0].tobytes() for i in range(batch.num_rows)]
        yield pa.record_batch([batch.column(0), pa.array(out, pa.binary())], ["item", "terms"])


def stored_items(bench: DataFrame, item_id: str = "item_id", text: str = "text") -> str:
    """The folder of the benchmark's items and their terms."""
    rows = bench.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    path = new_path(bench.sparkSession, "items")
    rows.mapInArrow(_item_terms, "item string, terms binary").write.parquet(path)
    return path


def read_items(path: str) -> Iterator[tuple[str | None, np.ndarray]]:
    """The items in ``path``, read a batch of rows at a time."""
    store, at = fs.FileSystem.from_uri(path)
    for name in sorted(f.path for f in store.get_file_info(fs.FileSelector(at)) if f.path.endswith(".parquet")):
        with store.open_input_file(name) as file:
            for batch in pq.ParquetFile(file).iter_batches(256):
                for item, terms in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    yield item, np.frombuffer(terms, np.uint64)


def phrase_blocks(items: Iterator[tuple[str | None, np.ndarray]], words: int, most: int) -> Iterator[dict]:
    """The windows of all items in blocks of at most ``most`` words."""
    held: list[tuple[str | None, np.ndarray]] = []
    size = 0
    for item, h in items:
        if not len(h):
            continue
        windows = h[None, :] if len(h) < words else np.lib.stride_tricks.sliding_window_view(h, words)
        step = max(1, most // windows.shape[1])
        for part in (windows[i : i + step] for i in range(0, len(windows), step)):
            if held and size + part.size > most:
                yield _block(held, words)
                held, size = [], 0
            held.append((item, part))
            size += part.size
    if held:
        yield _block(held, words)


def _block(held: list[tuple[str | None, np.ndarray]], words: int) -> dict:
    terms = np.unique(np.concatenate([w.ravel() for _, w in held]))
    rows = sum(len(w) for _, w in held)
    at, length, item, r = np.zeros((rows, words), np.int32), np.zeros(rows, np.int64), np.zeros(rows, np.int64), 0
    for k, (_, w) in enumerate(held):
        at[r : r + len(w), : w.shape[1]] = np.searchsorted(terms, w)
        length[r : r + len(w)], item[r : r + len(w)] = w.shape[1], k
        r += len(w)
    return {"terms": terms, "at": at, "length": length, "item": item, "names": [x for x, _ in held]}


def match_shard(terms: np.ndarray, counts: np.ndarray, steps: np.ndarray, n_words: np.ndarray, block: dict, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays (window, start, document ordinal) of the places where each term of a window stands within ``slop`` of its turn."""
    positions = np.cumsum(steps, dtype=np.uint32).astype(np.int64)
    size, last = len(positions), np.cumsum(n_words)
    if not size:
        return
    first = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    stride = size + 2 * slop + 2
    keys = np.repeat(np.arange(len(terms)), counts) * stride + positions
    found = np.minimum(np.searchsorted(terms, block["terms"]), len(terms) - 1)
    there = terms[found] == block["terms"]
    amount = np.where(there, first[found + 1] - first[found], 0)
    width = block["at"].shape[1]
    used = np.arange(width) < block["length"][:, None]
    often = np.where(used, amount[block["at"]], np.iinfo(np.int64).max)
    alive = np.flatnonzero((often > 0).all(axis=1))
    by_rarity = np.argsort(often[alive], axis=1, kind="stable")
    load = np.cumsum(often[alive, by_rarity[:, 0]] * (2 * slop + 1))
    for part in np.split(np.arange(len(alive)), np.unique(np.searchsorted(load, np.arange(CANDIDATES, int(load[-1]) if len(load) else 0, CANDIDATES)))):
        if not len(part):
            continue
        w, order = alive[part], by_rarity[part]
        term = found[block["at"][w, order[:, 0]]]
        n = first[term + 1] - first[term]
        which = np.repeat(np.arange(len(w)), n)
        anchor = positions[np.repeat(first[term] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
        doc = np.searchsorted(last, anchor, "right")
        start = anchor - order[which, 0]
        if slop:
            which, doc, start = np.repeat(which, 2 * slop + 1), np.repeat(doc, 2 * slop + 1), (start[:, None] + np.arange(-slop, slop + 1)).ravel()
            which, doc, start = np.unique(np.stack([which, doc, start]), axis=1)
        for k in range(width):
            ask = k < block["length"][w[which]]
            offset = order[which, k]
            low = np.maximum(start + offset - slop, last[doc] - n_words[doc])
            high = np.minimum(start + offset + slop, last[doc] - 1)
            base = found[block["at"][w[which], offset]] * stride
            i = np.minimum(np.searchsorted(keys, base + low), size - 1)
            ok = ~ask | ((low <= high) & (keys[i] >= base + low) & (keys[i] <= base + high))
            which, doc, start = which[ok], doc[ok], start[ok]
        yield w[which], start, doc


class _Shard:
    """A shard that waits for the benchmark's blocks, with what they have hit so far."""

    def __init__(self, row: dict) -> None:
        self.row, self.n = row, np.array(row["n_words"], np.int64)
        self.lists = [np.frombuffer(row[k], t) for k, t in (("terms", np.uint64), ("counts", np.uint32), ("steps", np.uint32))]
        self.bytes = sum(x.nbytes for x in self.lists)
        self.first = np.cumsum(self.n) - self.n
        self.change = np.zeros(int(self.n.sum()) + 1, np.int32)
        self.items: list[set[str]] = [set() for _ in self.n]

    def meet(self, block: dict, slop: int) -> None:
        names, n, first = block["names"], self.n, self.first
        for w, start, doc in match_shard(*self.lists, n, block, slop):
            np.add.at(self.change, np.clip(start, first[doc], first[doc] + n[doc]), 1)
            np.add.at(self.change, np.clip(start + block["length"][w], first[doc], first[doc] + n[doc]), -1)
            pairs = np.unique(doc * len(names) + block["item"][w])
            for d, k in zip((pairs // len(names)).tolist(), (pairs % len(names)).tolist(), strict=True):
                if names[k] is not None:
                    self.items[d].add(names[k])

    def found(self) -> pa.RecordBatch:
        n, first = self.n, self.first
        edges = np.diff(np.concatenate([[0], (np.cumsum(self.change[:-1]) > 0).astype(np.int8), [0]]))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        spans: list[list[dict]] = [[] for _ in n]
        for d, a, b in zip(np.searchsorted(np.cumsum(n), begins, "right").tolist(), begins.tolist(), ends.tolist(), strict=True):
            while a < b:  # a covered run may reach into the next documents
                stop = min(b, int(first[d] + n[d]))
                if stop > a:
                    spans[d].append({"start": a - int(first[d]), "end": stop - int(first[d])})
                a, d = stop, d + 1
        return pa.record_batch(
            [pa.array(self.row["doc_ids"], pa.int64()), pa.array(self.row["rows"], pa.int64()), pa.array(n), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array([sorted(x) for x in self.items], pa.list_(pa.string()))],
            ["doc_id", "row", "n_words", "spans", "items"],
        )


def _searcher(path: str, words: int, slop: int, block_words: int, held_bytes: int, kept_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[str | None, np.ndarray]] | None = None

        def items() -> Iterator[tuple[str | None, np.ndarray]]:
            """The benchmark, from memory if a first reading found it small enough."""
            nonlocal kept
            if kept is not None:
                yield from kept
                return
            have: list | None = []
            size = 0
            for item in read_items(path):
                size += item[1].nbytes + 64
                if have is not None and size <= kept_bytes:
                    have.append(item)
                else:
                    have = None
                yield item
            kept = have

        def searched(held: list[_Shard]) -> Iterator[pa.RecordBatch]:
            for block in phrase_blocks(items(), words, block_words):
                for shard in held:
                    shard.meet(block, slop)
            for shard in held:
                yield shard.found()

        held: list[_Shard] = []
        for batch in batches:
            for row in batch.to_pylist():
                held.append(_Shard(row))
                if sum(x.bytes for x in held) >= held_bytes:
                    yield from searched(held)
                    held = []
        yield from searched(held) if held else ()

    return run


def search(index: DataFrame, bench: DataFrame, item_id: str = "item_id", text: str = "text", words: int = PHRASE, slop: int = 0) -> DataFrame:
    """One row per indexed document: doc_id, row, n_words, spans (covered word ranges) and items (ids found, as strings).

    ``slop`` 0 finds exact phrases; above it, places where each term lies within ``slop`` words of its turn.
    """
    return index.mapInArrow(_searcher(stored_items(bench, item_id, text), words, slop, BLOCK_WORDS, HELD_BYTES, KEPT_BYTES), "doc_id long, row long, n_words long, spans array<struct<start:long,end:long>>, items array<string>")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 10-word matches of every benchmark item in every document."""
    found = search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without any occurrence of a benchmark window; all columns stay.

    Rows are known by id and text together, null-safely, so a hit takes no other text of the same id, or of none, along.
    """
    name, row = unused(docs, "hit"), unused(docs, "hash")
    found = search(build_index(docs, doc_id, text), bench).where(F.size("spans") > 0)
    hits = written(found.select(F.col("doc_id").alias(name), F.col("row").alias(row)).distinct(), "hits")
    return docs.join(hits, F.col(doc_id).cast("long").eqNullSafe(F.col(name)) & (F.xxhash64(text) == F.col(row)), "left_anti")


OP1_SQL = r"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM starts),
places AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM windows)),
hits AS (SELECT doc_id, i, p.n, item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM places) p JOIN windows USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
