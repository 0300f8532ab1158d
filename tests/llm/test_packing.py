"""Packing: the plan over counts against best-fit over single pieces, slots against the contract, sequences as wholes."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import packing, queries, tokenfile
from corpusloom.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"


def plain_bins(lengths, size):
    """Room left in each sequence after best-fit decreasing, a piece at a time."""
    room = []
    for n in sorted(lengths, reverse=True):
        fitting = [r for r in room if r >= n]
        if fitting:
            room.remove(min(fitting))
            room.append(min(fitting) - n)
        else:
            room.append(size - n)
    return sorted(room)


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    size = rng.choice([7, 40, 100])
    lengths = [min(size, 1 + int(rng.expovariate(1 / rng.choice([2, size / 3])))) for _ in range(rng.choice([1, 50, 600]))]
    counts = collections.Counter(lengths)
    filled, taken = collections.defaultdict(list), collections.Counter()
    for n, rank, many, first, each, offset in packing.plan(counts, size):
        assert rank == taken[n] and many % each == 0
        taken[n] += many
        for i in range(many):
            filled[first + i // each].append((offset + i % each * n, n))
    assert taken == counts
    for parts in filled.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size
    assert sorted(size - sum(n for _, n in p) for p in filled.values()) == plain_bins(lengths, size)


def test_plan_is_small_for_any_number_of_pieces():
    rng = random.Random(1)
    counts = {n: rng.randrange(1, 10**12) for n in range(1, 2049)}
    assert len(list(packing.plan(counts))) < 40 * 2048
    assert list(packing.plan({})) == []


def sound(rows, size=2048):
    """Slots are gapless and no sequence is too long."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size
    return by


def test_op13(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(tokenfile.VOCABULARY))
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            want[r["doc_id"], k // 2048] = (k, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    rows = queries.op13_best_fit_packing(spark, SF).collect()
    assert len(rows) == len(want) and {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    by = sound(rows)
    assert len(by) == len(plain_bins([n for _, n, _ in want.values()], 2048))


def test_null_empty_long_and_repeated_texts(spark):
    long = " ".join(random.Random(2).choices(["alpha", "beta", "gamma"], k=9000))
    rows = [(1, None, "x"), (2, "", "x"), (3, long, "x"), (3, long, "x"), (None, "one two", "x"), *((i, "same text", "y") for i in range(100, 900))]
    df = spark.createDataFrame(rows, "doc_id long, text string, task string").withColumn("length", F.lit("clash")).withColumn("id", F.lit(0)).repartition(5)
    packed = packing.pack(df)
    found = packed.collect()
    sound(found)
    assert sum(r["id"] == 3 for r in found) == 2 * 5 and sum(r["id"] is None for r in found) == 1
    assert [(r["length"], r["start"]) for r in found if r["id"] in (1, 2)] == [(1, 0)] * 2
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in found:
        s = whole[r["sequence_id"]]
        assert s["input_ids"][2 * r["offset"] : 2 * (r["offset"] + r["length"])] == r["ids"] and r["id"] == s["doc_ids"][s["starts"].index(r["offset"])]
    assert packing.pack(df.limit(0)).count() == 0
