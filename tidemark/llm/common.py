"""Shared helpers of the corpus operators: tables, and text columns as bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidemark.scratch import new_path, shared_dir, written

__all__ = ["new_path", "plain_columns", "raw_texts", "rows_by_bytes", "shared_dir", "table", "text_bytes", "unused", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def plain_columns(df: DataFrame) -> list[str]:
    """The columns that can be hashed, quoted."""
    return [f"`{c.replace('`', '``')}`" for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    col = pc.fill_null(col, "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type)
    offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def rows_by_bytes(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def raw_texts(col: pa.Array) -> Iterator[bytes]:
    """Each row's UTF-8 bytes; null is empty."""
    data, offsets = text_bytes(col)
    view = memoryview(data)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield bytes(view[a:b])
