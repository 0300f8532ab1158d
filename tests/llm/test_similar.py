"""Near-duplicates by Jaccard similarity: planted near copies against brute force, and in the pipeline's stage."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import simhash, similar


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def planted():
    """Texts of several lengths with copies that have 0 to 12 words changed or cut, sharing one common passage."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    common = " ".join(rng.choices(vocabulary, k=30))
    rows = []
    for size in (3, 6, 20, 60, 150, 300, 900):
        for _ in range(6):
            base = rng.choices(vocabulary, k=size)
            for changes in (0, 0, 1, 2, 3, 4, 5, 6, 8, 12):
                t = list(base)
                for _ in range(changes):
                    t[rng.randrange(len(t))] = rng.choice(vocabulary)
                if rng.random() < 0.2:
                    t = t[: -max(1, size // 8)] or t
                rows.append(" ".join(t) + (" " + common if rng.random() < 0.3 else ""))
    rng.shuffle(rows)
    return rows


def brute(texts):
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    held = [shingles(t) for t in texts]
    for i, a in enumerate(held):
        for j in range(i):
            both = len(a & held[j])
            if 9 * both >= 4 * (len(a) + len(held[j])):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i in range(len(texts))}


def test_components_equal_brute_force(spark):
    texts = planted()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["id"]: r["component"] for r in similar.near_duplicates(df).collect()}
    assert got == brute(texts)


def test_stage_drops_copies_that_differ_in_many_bits(spark):
    texts = planted()
    want = brute(texts)
    fps = [simhash.fingerprint(t, 3) for t in texts]
    assert sum((fps[i] ^ fps[j]).bit_count() > 3 for i, j in want.items()) > 50
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.without_near_duplicates(spark, df, "")
    assert out.columns == corpus_pipeline.COLUMNS
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(want.values()))


def test_a_common_header_makes_no_pairs(spark, monkeypatch):
    """Texts that share a header longer than their own part, yet are no near-duplicates, with groups that are."""
    counted, links = [], similar._links

    def count(pairs, *rest):
        counted.append(pairs.count())
        return links(pairs, *rest)

    monkeypatch.setattr(similar, "_links", count)
    made = {}
    for n in (300, 3000):
        header = " ".join(f"h{i}" for i in range(60))
        texts = [f"{header} " + " ".join(f"t{n}x{i}x{k}" for k in range(9 + i % 12)) for i in range(n)]
        texts += [t + " end" for t in texts[:50]]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        counted.clear()
        got = {r["id"]: r["component"] for r in similar.near_duplicates(df).collect()}
        made[n] = sum(counted)
        assert got == {i: i - n if i >= n else i for i in range(n + 50)}
    assert made[3000] <= 12 * made[300]


def test_sides_that_grow_are_not_broadcast(spark):
    held = spark.range(100).select("id", F.encode(F.lit("x"), "UTF-8").alias("bits"))
    pairs = spark.range(99).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.lit(1).cast("long").alias("room"))
    found = similar._checked(pairs, held, "bits", lambda x, y, room: x == y)
    assert found.count() == 99
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
