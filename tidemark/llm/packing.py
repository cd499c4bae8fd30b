"""Operator 11, packing documents into windows by order-preserving dynamic programming.

The documents of a task are one stream of token ids, each document closed by ``END``. The stream is cut into sequences of
at most ``WIDTH`` ids. Cuts are free at the end of a document, cost ``SENTENCE`` at the end of a sentence and ``INSIDE`` every
``STEP`` ids inside a run of more than ``LONG`` ids without either; a sequence costs its padding, which is what it lacks
to ``WIDTH``, or nothing where its length is a power of two, and ``EACH``, so that no sequence is parted into short ones for the sake of a
few ids of padding. With

    best[j] = cost[j] + EACH + min(min over i of best[i] + WIDTH - (at[j] - at[i]), min over k of best[i] where at[i] = at[j] - 2^k)

the inner minimum over the places i within ``WIDTH`` ids before j is that of best[i] + at[i], which a monotone queue holds: each place
enters and leaves once. Ties go to the longer sequence.

The stream is solved in blocks of ``BLOCK`` ids; the last sequence of a block is given up and its ids open the next block, so only the
last sequence of a task ends where the input does. The operator reads a table once, in its own order, without a shuffle unless it has
fewer partitions than there are cores.

Null and empty texts are their closing id alone. Long texts are tokenized whole and run on over as many sequences as they need. Repeated
rows and ids are packed each for itself; a null id stays null. Equal costs are told above. An empty table gives no rows. Extra columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.scratch import spread

WIDTH = 1024
END = 0
#: Costs of a cut that is not at the end of a document, in ids of padding.
SENTENCE, INSIDE = 4, 32
#: Cost of a sequence besides its padding.
EACH = 32
#: Runs without the end of a sentence that may be cut, and how often.
LONG, STEP = 128, 16
BLOCK = 1 << 18
PAD = 50256

#: Fixed values of the vocabulary: how its words are split, and its one special token.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>": 50256}

PIECES = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"


def vocabulary() -> str:
    """The rank file of the byte-level vocabulary ``byte_bpe_50k``; it must lie at this path on each executor."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str) -> tuple[Callable[[str], list[int]], np.ndarray, np.ndarray]:
    """The encoder of a rank file, and of each id whether it ends a sentence and whether it begins with white space."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    codec = tiktoken.Encoding("vocabulary", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=SPECIAL)
    closes, opens = np.zeros((2, max(*ranks.values(), *SPECIAL.values()) + 1), bool)
    for word, i in ranks.items():
        bare = word.rstrip(b"\"')]")
        closes[i] = bare.endswith((b".", b"!", b"?"))
        opens[i] = word[:1].isspace()
    return (lambda text: codec.encode(text, allowed_special="all")), closes, opens


def choose(at: np.ndarray, cost: np.ndarray, width: int = WIDTH) -> list[int]:
    """Which places of ``at`` (rising from 0, at most ``width`` apart) part the sequences, the first and the last included.

    ``cost`` is that of a cut at each place.
    """
    n = len(at)
    power = 1 << np.arange(width.bit_length())
    power = power[power < width]
    # all (i, j) whose distance is a power of two, by j
    to = np.repeat(np.arange(n), len(power))
    back = (at[:, None] - power).ravel()
    frm = np.searchsorted(at, back)
    exact = at[frm] == back
    to, frm = to[exact], frm[exact].tolist()
    first = np.searchsorted(to, np.arange(n + 1)).tolist()
    at, cost = at.tolist(), cost.tolist()
    best, before = [0] * n, [0] * n
    queue, value, head = [0], [0], 0  # places by rising best + at, from head on
    for j in range(1, n):
        here = at[j]
        least = here - width
        while at[queue[head]] < least:
            head += 1
        total, source = value[head] + width - here, queue[head]
        for i in frm[first[j] : first[j + 1]]:
            if best[i] < total:
                total, source = best[i], i
        total += cost[j] + EACH
        best[j], before[j] = total, source
        total += here
        while len(queue) > head and value[-1] > total:
            queue.pop()
            value.pop()
        queue.append(j)
        value.append(total)
    path = [n - 1]
    while path[-1]:
        path.append(before[path[-1]])
    return path[::-1]


def places(ids: np.ndarray, ends: np.ndarray, closes: np.ndarray, opens: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream may be cut, and the cost of each cut; ``ends`` are the ends of its documents."""
    sentence = np.flatnonzero(closes[ids[:-1]] & opens[ids[1:]]) + 1
    at = np.union1d(sentence, np.append(ends, 0))
    gap = np.diff(at)
    far = np.flatnonzero(gap > min(LONG, width))
    step = min(STEP, width)
    inner = [np.arange(at[i] + step, at[i + 1], step) for i in far]
    if inner:
        inner = np.concatenate(inner)
        at = np.union1d(at, inner)
    cost = np.full(len(at), SENTENCE)
    cost[np.searchsorted(at, inner)] = INSIDE
    cost[np.searchsorted(at, ends)] = 0
    cost[0] = 0
    return at, cost


def packer(path: str, width: int, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, closes, opens = encoder(path)
        sequence = TaskContext.get().partitionId() << 32
        names, streams, taken, whole, held = [], [], [], [], 0

        def solved(last: bool) -> pa.RecordBatch:
            """The pieces of what is held; unless it is the last of the task, what its last sequence has stays held."""
            nonlocal names, streams, taken, whole, held, sequence
            ids = np.concatenate(streams)
            lengths = np.array([len(s) for s in streams])
            ends = np.cumsum(lengths)
            at, cost = places(ids, ends, closes, opens, width)
            cut = at[choose(at, cost, width)]
            if not last and len(cut) > 2:
                cut = cut[:-1]
            edge = np.union1d(cut, ends[ends < cut[-1]])
            a, b = edge[:-1], edge[1:]
            doc = np.searchsorted(ends, a, "right")
            place = np.searchsorted(cut, a, "right") - 1
            begun = np.array(taken)
            data = ids[: cut[-1]].astype("<u4")
            out = [
                pa.array([names[d] for d in doc.tolist()], pa.int64()),
                pa.array(a - (ends - lengths)[doc] + begun[doc]),
                pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer((edge * 4).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]),
                pa.array(np.array(whole)[doc]),
                pa.array(sequence + place),
                pa.array(a - cut[place]),
            ]
            sequence += len(cut) - 1
            k = int(np.searchsorted(ends, cut[-1], "right"))
            rest = int(cut[-1] - (ends[k - 1] if k else 0))  # ids of document k that are gone
            names, streams, taken, whole = names[k:], streams[k:], taken[k:], whole[k:]
            if streams:
                streams[0], taken[0] = streams[0][rest:], taken[0] + rest
            held = int(ends[-1] - cut[-1])
            return pa.RecordBatch.from_arrays(out, [c.split()[0] for c in PIECES.split(", ")])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), END], np.uint32)
                names.append(name)
                streams.append(ids)
                taken.append(0)
                whole.append(len(ids))
                held += len(ids)
                if held >= block:
                    yield solved(False)
        if streams:
            yield solved(True)

    return run


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """The pieces of all documents: doc_id, start, ids (little-endian unsigned 32-bit integers), doc_tokens, sequence_id and offset."""
    rows = spread(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    return rows.mapInArrow(packer(path or vocabulary(), width, block), PIECES)


def ids_array(ids: Column) -> Column:
    """The ids of a piece or sequence as an array."""
    turned = lambda at: F.conv(F.concat(*[F.substring(F.hex(ids), at * 8 + k, 2) for k in (7, 5, 3, 1)]), 16, 10).cast("long")
    return F.transform(F.sequence(F.lit(0), (F.octet_length(ids) / 4).cast("int") - 1), turned)


def sequences(pieces: DataFrame, width: int = WIDTH, pad: int = PAD) -> DataFrame:
    """sequence_id, n_tokens and ids of each sequence, padded to ``width`` unless its length is a power of two."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # of at most ``width`` pieces
    rows = pieces.groupBy("sequence_id").agg(parts.alias("parts"))
    rows = rows.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
    n = (F.octet_length("ids") / 4).cast("int")
    full = F.rpad("ids", width * 4, F.lit(pad.to_bytes(4, "little")))
    return rows.select("sequence_id", n.alias("n_tokens"), F.when(F.bit_count(n) == 1, F.col("ids")).otherwise(full).alias("ids"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with the checksum of each one's ids."""
    rows = packed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
