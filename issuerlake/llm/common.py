"""Shared task-side helpers: texts as bytes, Arrow batches, one cache per Python worker.

The modules of this package are pickled by value: executors need numpy, pyarrow and the named text
libraries, but not this package.
"""

from __future__ import annotations

import math
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A-Z to a-z; every other byte stays.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# The same, and every ASCII character that is no letter or digit becomes a space.
WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in LOWER)


def white_words(text: str | None) -> list[bytes]:
    """Lower-cased words between white space (space and U+0009 to U+000D)."""
    return (text or "").encode().translate(LOWER).split()


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words of ASCII letters, digits and characters beyond ASCII."""
    return (text or "").encode().translate(WORDS).split()


def bucket(key: str, n: int) -> Column:
    """crc32 of the key's text modulo n; a null key counts as empty text."""
    return (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(n)).cast("int")


SHARES = 1 << 20
PIECE_BYTES = 1_000_000
# Rows of an Arrow batch, where the session has not set its own number: texts can be long.
BATCH_ROWS = 512


def share_of(hashed: Column, rows: int, known: int) -> Column:
    """Whether a hash falls into the share of hashes that leaves about ``rows`` of ``known`` distinct ones."""
    return F.pmod(hashed, F.lit(SHARES)) < math.ceil(min(1.0, rows / max(1, known)) * SHARES)


def sample_labels(labels: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """__key, __label: about ``rows`` distinct labelled keys, taken by hash of the key, and twice as many at most.

    Keys are chosen where they are scanned, so no task gathers more than the sample.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = known.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label")).distinct()
    return known.where(share_of(F.xxhash64(F.lit(7), "__key"), rows, known.count())).limit(2 * rows)


def worker_cache(name: str, make: Callable[[], Any]) -> Any:
    """An object that a Python worker keeps across tasks, until an operator asks for one of another name.

    Workers outlive the query they were started for, so only one object is held.
    """
    held = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache"))
    if getattr(held, "name", None) != name:
        held.name = held.object = None
        held.object = make()
        held.name = name
    return held.object


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about PIECE_BYTES, so that few of its texts are Python objects at a time."""
    rows = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def small_batches(df: DataFrame) -> DataFrame:
    """The table, in a session whose Arrow batches hold BATCH_ROWS rows unless it says otherwise."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":  # Spark's default
        conf.set(name, str(BATCH_ROWS))
    return df


def map_columns(
    df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable[..., list]]
) -> DataFrame:
    """Apply a row-block function to the named columns.

    ``make`` runs once per task and returns a function from Python lists (one per column) to lists
    (one per field of the schema). Only these columns reach Python.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in (p for b in batches for p in pieces(b)):
            if batch.num_rows:
                out = f(*(c.to_pylist() for c in batch.columns))
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(out, arrow)], schema=arrow)

    return small_batches(df.select(*columns)).mapInArrow(run, fields)


def filter_rows(df: DataFrame, column: str, make: Callable[[], Callable[[list], np.ndarray]]) -> DataFrame:
    """Keep the rows for which the block function of one column says so; all columns pass unchanged."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in (p for b in batches for p in pieces(b)):
            yield batch.filter(pa.array(np.asarray(f(batch.column(at).to_pylist()), dtype=bool)))

    return small_batches(df).mapInArrow(run, df.schema)
