"""Source mix: targets against iterated sharing, exact takes, disjoint shards, the distribution of the tree's draws."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, size long, row long, n_chars long"


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, got = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not full:
            return got | {s: level * weight[s] for s in open_}
        for s in full:
            got[s] = cap * sizes[s]
            left -= got[s]
        open_ -= full
    return got


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, -1, -1, len(t or "")) for i, t, s in rows], SCHEMA)


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(300):
        s = "hot" if i % 3 else rng.choice(["a", "b", "é", "🙂", None, "Z"])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 3, 50, 900, 2500])), s))
    return rows + [(1000, None, "a"), (1001, "x y", "tiny"), (7, rows[7][1], rows[7][2])]


def test_targets(spark):
    for sizes in [{"a": 10, "b": 1000, "c": 3, None: 50}, {"a": 5}, {"a": 0, "b": 0}, {"x": 1, "y": 0, "z": 9}, {f"s{i}": (i * 37) % 101 for i in range(40)}]:
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


@pytest.mark.parametrize("block", [7, 1024])
def test_takes_are_exact_and_bounded(spark, block):
    rows = corpus()
    mixed = mixing.mix(frame(spark, rows), block_words=block, depth=3)
    got = mixed.taken().collect()
    assert len(got) == len(rows)
    sizes, taken = collections.Counter(), collections.Counter()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    want = plain_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in want)
    assert {r["source"]: r["source_size"] for r in got} == dict(sizes)
    blocks = mixed.blocks.collect()
    drawn = [(b["row"], b["block"], b["pass"]) for b in blocks]
    assert len(set(drawn)) == len(drawn)
    per_shard = collections.Counter(b["shard"] for b in blocks)
    assert len(per_shard) == 8 and max(per_shard.values()) - min(per_shard.values()) <= 1
    again = mixing.mix(frame(spark, rows).repartition(5), block_words=block, depth=3).taken()
    assert sorted((r["id"], r["taken"]) for r in again.collect()) == sorted((r["id"], r["taken"]) for r in got)


def test_small_buckets_give_the_same_mix(spark, monkeypatch):
    rows = corpus()
    one = sorted((r["id"], r["taken"]) for r in mixing.mix(frame(spark, rows), block_words=5, depth=1).taken().collect())
    monkeypatch.setattr(mixing, "BUCKET_BLOCKS", 16)
    mixed = mixing.mix(frame(spark, rows), block_words=5, depth=1).taken().collect()
    sums = collections.Counter()
    for r in mixed:
        sums[r["source"]] += r["taken"]
    assert sum(sums.values()) == sum(t for _, t in one)


def test_tree_draws_are_hypergeometric(spark):
    quotas = spark.createDataFrame([(1, 30), (2, 50), (3, 20)], "source_no int, quota long")
    seen = collections.Counter()
    for seed in range(60):
        rows = {r["source_no"]: r["bounds"] for r in mixing.split_tree(quotas, 1, seed).collect()}
        assert [b[-1] for _, b in sorted(rows.items())] == [30, 50, 20]
        assert sum(b[0] for b in rows.values()) == 50
        seen[rows[1][0]] += 1
    mean = sum(k * v for k, v in seen.items()) / 60
    var = sum((k - 15) ** 2 * v for k, v in seen.items()) / 60
    assert abs(mean - 15) < 1.2 and 2.0 < var < 11.0  # 50 * .3 * .7 * 50 / 99 = 5.3


def test_mixed_documents(spark):
    rows = [(1, "a b\tc  d\ne f", "s"), (2, "", "s"), (3, None, None), (4, "x " * 40, "t"), (5, "one two three", "u")]
    out = mixing.mixed_documents(frame(spark, rows), block_words=2)
    got = out.collect()
    assert out.columns == frame(spark, rows).columns
    sizes = {"s": 6, "t": 40, "u": 3, None: 0}
    want = plain_targets(sizes)
    words = collections.Counter()
    for r in got:
        words[r["source"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert all(abs(words[s] - want[s]) <= 0.5 for s in sizes)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    mixed = mixing.mix(df)
    assert mixed.taken().collect() == [] and mixed.blocks.collect() == []
    assert mixing.mixed_documents(df).collect() == []


def test_parts_of_documents_are_not_broadcast(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 20).alias("text"), F.lit("s").alias("source"), F.lit(100).cast("long").alias("n_chars"))
    out = mixing.mixed_documents(docs)
    assert out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("SortMergeJoin") >= 2
