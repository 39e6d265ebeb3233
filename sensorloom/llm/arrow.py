"""Batches between Spark and numpy: bounded groups of texts in, typed batches out."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Characters of a group of texts that are worked on together, unless one text is longer.
GROUP_CHARS = 2_000_000


def text_groups(
    batches: Iterable[pa.RecordBatch], limit: int = GROUP_CHARS
) -> Iterator[tuple[list, list[str]]]:
    """Rows (key, text) in groups of about ``limit`` characters; a missing text is empty."""
    keys, texts, size = [], [], 0
    for batch in batches:
        column = batch.column(0).to_pylist()
        for i in range(batch.num_rows):
            text = batch.column(1)[i].as_py() or ""
            keys.append(column[i])
            texts.append(text)
            size += len(text) + 1
            if size >= limit:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def text_arrays(
    batches: Iterable[pa.RecordBatch], limit: int = GROUP_CHARS
) -> Iterator[tuple[list, pa.LargeBinaryArray]]:
    """Rows (key, text) in groups of about ``limit`` bytes of text, which stay in Arrow as bytes; a
    missing text is empty."""
    keys, texts, size = [], [], 0
    for batch in batches:
        column = batch.column(0).to_pylist()
        content = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
        ends = np.r_[0, np.cumsum(pc.binary_length(content).to_numpy() + 1)]
        begin = 0
        while begin < len(column):
            full = int(np.searchsorted(ends, ends[begin] + limit - size))
            upto = min(max(full, begin + 1), len(column))
            keys += column[begin:upto]
            texts.append(content.slice(begin, upto - begin))
            size += int(ends[upto] - ends[begin])
            begin = upto
            if size >= limit:
                yield keys, pa.concat_arrays(texts)
                keys, texts, size = [], [], 0
    if keys:
        yield keys, pa.concat_arrays(texts)


def text_slices(
    batch: pa.RecordBatch, column: int, limit: int = GROUP_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with their texts, of about ``limit`` characters each."""
    begin, texts, size = 0, [], 0
    for i in range(batch.num_rows):
        text = batch.column(column)[i].as_py() or ""
        texts.append(text)
        size += len(text) + 1
        if size >= limit or i + 1 == batch.num_rows:
            yield batch.slice(begin, i + 1 - begin), texts
            begin, texts, size = i + 1, [], 0


def batch_of(schema: T.StructType, *columns) -> pa.RecordBatch:
    kinds = to_arrow_schema(schema)
    arrays = [pa.array(c, f.type, from_pandas=False) for c, f in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, schema=kinds)


def schema_of(df: DataFrame, key: str, *columns: tuple[str, T.DataType]) -> T.StructType:
    """The key as it is in ``df``, then further columns."""
    field = df.schema[key]
    return T.StructType([T.StructField(key, field.dataType), *(T.StructField(n, t) for n, t in columns)])
