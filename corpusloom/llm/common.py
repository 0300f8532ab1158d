"""Shared plumbing: written tables and size-checked joins of the library, Arrow batches in slices, column names."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import BROADCAST_ROWS, is_small, spread  # noqa: F401
from ..operators.joins import looked_up as lookup_join  # noqa: F401
from ..sources import shared
from ..sources.shared import clean, exists, forget, recorded, remove, scratch, shared_dir  # noqa: F401

#: Rows of an Arrow batch that Python works on at a time. Spark bounds a batch by its bytes (64 MB unless set otherwise);
#: tables written here are made of smaller batches, as two tasks' batches would fill much of an executor.
SLICE_ROWS = 1000


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts of at most ``rows`` rows, without empty ones."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


#: What empties the words that an operator has kept in this worker, by operator.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps_words(operator: str, empty: Callable[[], None]) -> None:
    """Tell how an operator's kept words are emptied, and empty those of all others: a worker serves many stages."""
    for name, other in list(_KEPT.items()):
        if name != operator:
            other()
            del _KEPT[name]
    _KEPT[operator] = empty


@contextmanager
def small_batches(spark: SparkSession, rows: int = SLICE_ROWS):
    """Arrow batches of at most ``rows`` rows for the jobs that run inside; the session's own setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows if int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """A written table in the shared folder, as :func:`shared.written`, made of small Arrow batches."""
    with small_batches(df.sparkSession):
        return shared.written(df, name, **options)


def kept_names(keep: list[str], own: list[str]) -> list[str]:
    """Names under which kept columns come out: as they are, or with ``kept_`` before those that the result has itself."""
    out: list[str] = []
    for name in keep:
        while name in own or name in out:
            name = f"kept_{name}"
        out.append(name)
    return out


def let(value: Column, use) -> Column:
    """Bind ``value`` once inside a higher-order expression, so that it isn't evaluated per element."""
    return F.transform(F.array(value), use)[0]


def tokenizer_path(name: str) -> str:
    """Default place of a public tokenizer file; ``CORPUSLOOM_TOKENIZERS`` names another folder."""
    folder = os.environ.get("CORPUSLOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
