"""Connected components of a link table, without collecting links or components anywhere."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, spread, written

_LINKS = "hi long, lo long"
#: Nodes that a worker holds while it reduces links to stars.
NODES = 500_000


def _stars(root: dict[int, int], find):
    nodes = [x for x in root if find(x) != x]
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([find(x) for x in part], pa.int64())], ["hi", "lo"])


def _forest(batches):
    """Replace the links of one partition by stars for the groups they connect (union-find), ``NODES`` nodes at a time."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while root.get(x, x) != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
                root.setdefault(min(a, b), min(a, b))
        if len(root) > NODES:
            yield from _stars(root, find)
            root.clear()
    yield from _stars(root, find)


def _toward_minimum(links: DataFrame, both: bool) -> tuple[DataFrame, DataFrame]:
    """Large-star (``both``) or small-star step on links (hi > lo), and the table of least neighbours it reads.

    A hub's links meet its least neighbour by :func:`spread`, so those of a giant component aren't gathered.
    """
    seen = links if not both else links.unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    least = seen.groupBy("hi").agg(F.min("lo").alias("least"), F.count("*").alias("degree")).select(F.col("hi").alias("node"), F.least("hi", "least").alias("least"), "degree")
    least = written(least, "least")
    joined = spread(seen, least, "hi", "node", "degree")
    if both:
        out = joined.filter(F.col("lo") > F.col("node")).select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    else:
        out = joined.select(F.when(F.col("lo") == F.col("least"), F.col("node")).otherwise(F.col("lo")).alias("hi"), F.col("least").alias("lo"))
    return out.filter(F.col("hi") != F.col("lo")).distinct(), least


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node long, component long) for every end of a link; component is the smallest node reachable.

    Links within a partition are first reduced to stars; large-star and small-star steps then alternate until the
    stars no longer change. Each step is a written table, so a lost executor costs one step at most; tables that
    nothing reads any more are deleted. Null ends and loops are ignored; an empty input gives an empty table.
    """
    now = links.select(F.greatest(a, b).cast("long").alias("hi"), F.least(a, b).cast("long").alias("lo")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo")))
    now = written(now.mapInArrow(_forest, _LINKS), "forest")
    mark = None
    while True:
        last, mark = mark, now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if mark == last or not mark["n"]:
            break
        large, first = _toward_minimum(now, True)
        large = written(large, "large-star")
        small, second = _toward_minimum(large, False)
        after = written(small, "small-star")
        forget(now, first, second, large)
        now = after
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
