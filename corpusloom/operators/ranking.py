"""Places and order statistics of a whole table without one task: ranges that are counted, histograms that are refined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import shared

#: Bins of a histogram.
BINS = 1024


def placed(rows: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """``rows`` with their place in ``order``, from 1, nulls first; of equal rows any comes first.

    The rows are dealt out into ordered ranges and written; each range's count gives the place where the next begins, so
    only these counts, one a range, pass the driver.
    """
    columns = [F.asc_nulls_first(c) if isinstance(c, str) else c for c in order]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = shared.written(rows.repartitionByRange(n, *columns).sortWithinPartitions(*columns).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_at", 33).cast("int")
    starts, total = [], 0
    for r in sorted(ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):  # one a range
        starts.append((r["part"], total))
        total += r["n"]
    before = F.broadcast(rows.sparkSession.createDataFrame(starts, "_part int, _before long"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(before, part == F.col("_part")).withColumn(name, F.col("_before") + inside + 1).drop("_at", "_part", "_before")


def nth(rows: DataFrame, value: str, place: int | None = None) -> DataFrame:
    """(value): the value at ``place``, from 0, of a numeric column in ascending order; the upper middle one unless given.

    Exact, for any number of different values: a histogram of ``BINS`` bins between the least and the largest value says
    which bin holds the place, and that bin is refined until it holds one value. Nulls are left out, NaN is largest; an
    empty table, or a place beyond its end, has no row. Each step is one pass with partial sums. Values are compared as
    they are; only bins are computed in floating point, and a range that can't be cut so loses its ends.
    """
    spark = rows.sparkSession
    kind = rows.schema[value].dataType
    v = F.col(value)
    some = rows.filter(v.isNotNull()).select(value)
    seen = some.agg(F.count("*").alias("n"), F.min(v).alias("low"), F.max(v).alias("high")).first()
    n, low, high = seen["n"], seen["low"], seen["high"]
    at = n // 2 if place is None else place
    if not 0 <= at < n:
        return spark.createDataFrame([], rows.select(value).schema)
    exact = lambda x: F.lit(x).cast(kind)
    while low != high and low == low:  # what begins with NaN is NaN alone
        here, wide = some.filter(v.between(exact(low), exact(high))), float(high) - float(low)
        if 0 < wide < float("inf"):
            bin_of = F.least(F.floor((v.cast("double") - F.lit(float(low))) / F.lit(wide) * BINS), F.lit(BINS - 1)).cast("int")
        else:
            bin_of = F.when(v == exact(low), 0).when(v == exact(high), 2).otherwise(1)
        found = sorted(here.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"), F.min(v).alias("low"), F.max(v).alias("high")).collect(), key=lambda r: r["bin"])  # BINS rows at most
        for r in found:
            if at < r["n"]:
                low, high = r["low"], r["high"]
                break
            at -= r["n"]
    return spark.createDataFrame([(low,)], rows.select(value).schema)
