"""Row-wise annotation over Arrow batches, and whole-text helpers shared by the operators."""
from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text that one numpy step works on; bounds the temporaries of a task, not the texts.
CHUNK = 1 << 20


#: Most bytes of rows that go to a Python worker at once. Spark's default of 64 MB is held several times over on both sides.
BATCH = 8 << 20


def arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """mapInArrow with batches of at most about ``BATCH`` bytes, unless the session asks for smaller ones."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(re.sub("[^0-9]", "", conf.get(name) or "0") or 0)
    if not 0 < now <= BATCH:
        conf.set(name, str(BATCH))
    return df.mapInArrow(fn, schema)


def annotate(df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]], fields: list[T.StructField]) -> DataFrame:
    """Narrow: keeps the columns of ``df`` and appends ``fields``, computed by ``fn`` for each Arrow batch. A column that is named like an appended one is replaced by it."""
    new = {f.name.lower() for f in fields}
    kept = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in new]
    schema = T.StructType([*[df.schema.fields[i] for i in kept], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *fn(batch)], names=schema.names)

    return arrow(df, run, schema)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Whole texts of a batch; null reads as empty."""
    return [x or "" for x in column(batch, name).to_pylist()]


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array, and where each text begins and ends in them (one more than texts). Null reads as empty."""
    if array.null_count:
        array = array.fill_null("")
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(array: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, offsets) of runs of whole texts of about ``size`` bytes; a longer text is a run of its own."""
    data, offsets = utf8(array)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def portions(some: list[str], size: int = 4 * CHUNK) -> Iterator[list[str]]:
    """Runs of whole texts of about ``size`` characters."""
    i = 0
    while i < len(some):
        j, held = i, 0
        while j < len(some) and (j == i or held + len(some[j]) <= size):
            held += len(some[j])
            j += 1
        yield some[i:j]
        i = j
