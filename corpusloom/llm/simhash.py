"""SimHash near-duplicates with pigeonring candidate filtering.

A fingerprint is cut into a ring of four 16-bit segments. Two fingerprints that differ in at most three bits have
a segment from which every chain of consecutive segments stays within its proportional share of the budget: one
segment has floor(3/4) = 0 differing bits, two have at most floor(6/4) = 1, three at most floor(9/4) = 2, four at
most 3. The chain of two segments is the index key (32 bits, with one side spelling out the sixteen one-bit
neighbours), the longer chains filter the candidates, and the full Hamming distance is checked last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import similar
from .common import lookup_join, slices, spread, written
from .graph import components

SEGMENTS, WIDTH, MAX_BITS = 4, 16, 3
#: Shingles whose bits are counted at a time.
_CHUNK = 1 << 15


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of the lower-cased word shingles of a whole text; 0 without words."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    whole = b" ".join(tokens)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    end = np.cumsum(size + 1) - 1
    start = end - size
    k = min(words, len(tokens))
    first, last = start[: len(tokens) - k + 1].tolist(), end[k - 1 :].tolist()
    n = len(first)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        hashes = np.array([digest(whole[s:e], 42) for s, e in zip(first[i : i + _CHUNK], last[i : i + _CHUNK])], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id long, fp long) for every row; null texts count as empty."""

    def run(batches):
        for batch in slices(batches):
            fps = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, fp long")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def _key(i: int, first: Column, second: Column) -> Column:
    return first.bitwiseOR(F.shiftleft(second, WIDTH)).bitwiseOR(F.lit(i << 2 * WIDTH))


def links(classes: DataFrame) -> DataFrame:
    """(a, b): representatives of every two classes (rep, fp) whose fingerprints differ in 1 to 3 bits.

    Spark sizes exploded rows as if they were no more than before, so without a hint it would broadcast 68 rows a class.
    """
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    classes = classes.select("rep", "fp").repartition(n)  # few rows become many: spread before
    fp = F.col("fp")
    plain = F.array(*[F.struct(F.lit(i).alias("i"), _key(i, _segment(fp, i), _segment(fp, i + 1)).alias("key")) for i in range(SEGMENTS)])
    near = F.array(*[F.struct(_key(i, _segment(fp, i), _segment(fp, i + 1).bitwiseXOR(F.lit(flip).cast("long"))).alias("key")) for i in range(SEGMENTS) for flip in [0, *(1 << j for j in range(WIDTH))]])
    left = classes.select(F.col("rep").alias("a"), F.col("fp").alias("fa"), F.explode(plain).alias("k")).select("a", "fa", "k.i", "k.key")
    right = classes.select(F.col("rep").alias("b"), F.col("fp").alias("fb"), F.explode(near).alias("k")).select("b", "fb", F.col("k.key").alias("key_b"))
    apart = F.col("fa").bitwiseXOR(F.col("fb"))
    third = F.lit(None)
    for i in range(SEGMENTS):
        other = _segment(apart, i + 3)
        third = F.when(F.col("i") == i, F.bit_count(apart) - F.bit_count(other)).otherwise(third)
    found = left.join(right.hint("merge"), (F.col("key") == F.col("key_b")) & (F.col("fa") < F.col("fb")) & (third <= 2) & (F.bit_count(apart) <= MAX_BITS))
    return found.select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """One row per input row: id, fp (signed 64-bit), component (smallest id reachable over links, itself included).

    Equal fingerprints form one class first, so copies are never paired with each other. Rows with a null id get
    the component of their class; it is null if no row of the component has an id. Texts without words have
    fingerprint 0 and are linked like any other. An empty table gives an empty table; repeated rows stay.
    """
    rows = written(fingerprints(docs, id_col, text_col, words), "simhash")
    classes = written(rows.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "classes")
    parts = components(links(classes.filter(F.col("rep").isNotNull())), "a", "b")
    whole = classes.join(parts.hint("merge"), classes["rep"] == parts["node"], "left").select(F.col("fp").alias("class_fp"), F.coalesce("component", "rep").alias("component"), "n")
    return spread(rows, written(whole, "whole"), "fp", "class_fp", "n").select("id", "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = similar.WORDS) -> DataFrame:
    """The documents without near-duplicates: the one with the smallest id of each component stays.

    Near-duplicates are those that :func:`near_duplicates` links by fingerprint, and those of :mod:`similar`, on shingles
    of five words and similarity 0.8: fingerprints of such pairs differ in up to about 20 bits, which no chain of
    segments can index. A component goes over links of both. A repeated id stays once; rows without an id can't be
    referred to and stay.
    """
    found = near_duplicates(docs, id_col, text_col, words), similar.near_duplicates(docs, id_col, text_col, words)
    near, alike = (df.filter("id > component").select("id", "component") for df in found)
    parts = components(written(near.unionByName(alike).distinct(), "near"), "id", "component")
    gone = parts.filter("node > component").select(F.col("node").alias("_gone_id"))
    named = docs.filter(F.col(id_col).isNotNull())
    one = lookup_join(named, gone, named[id_col].cast("long") == F.col("_gone_id"), "left_anti").dropDuplicates([id_col])
    return one.unionByName(docs.filter(F.col(id_col).isNull()))
