"""Joins whose small side is counted before it is broadcast, and joins that spread heavy keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest number of rows of a side that may be broadcast; beyond it a join shuffles.
BROADCAST_ROWS = 50_000
#: Rows of a partition that a task sorts for a window.
PART_ROWS = 500_000


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df``, which should be cheap to compute, has at most ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows


def looked_up(big: DataFrame, small: DataFrame, on: Column | str | list[str], how: str = "left", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a small table to a large one: broadcast if ``small`` has at most ``rows`` rows, else shuffle.

    ``small`` should be cheap to count. Skew of the shuffled form is left to AQE.
    """
    return big.join(F.broadcast(small) if is_small(small, rows) else small.hint("merge"), on, how)


def dealt(df: DataFrame, *keys: str, rows: int = PART_ROWS) -> DataFrame:
    """``df`` dealt by keys over partitions of about ``rows`` rows, so that what a task sorts doesn't grow with the table.

    ``df`` is counted. A table of so many rows or fewer stays as it is. No key is cut, so one partition may hold more.
    """
    parts = -(-df.count() // rows)
    return df if parts <= 1 else df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), *keys)


def spread(big: DataFrame, small: DataFrame, key: str, of_key: str, weight: str, keys: int = 1000) -> DataFrame:
    """Inner join on ``big.key = small.of_key`` that never gathers a heavy key in one task.

    ``small`` has one row for each key and, in ``weight``, how many rows of ``big`` have it; both are cheap to read
    again. Keys with more than a ``keys``-th of all rows, of which there are fewer than ``keys``, are broadcast and
    their rows stay where they are; the rest is shuffled.
    """
    total = small.agg(F.sum(weight).alias("n")).first()["n"] or 0
    heavy = F.col(weight) > F.lit(total // keys)
    some, rest = F.broadcast(small.filter(heavy)), small.filter(~heavy)
    on = F.col(key) == F.col(of_key)
    light = big.join(some.select(F.col(of_key).alias("_heavy")), F.col(key) == F.col("_heavy"), "left_anti")
    return big.join(some, on).unionByName(light.join(rest.hint("merge"), on))
