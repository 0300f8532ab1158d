"""SimHash: fingerprints against a plain version, components against brute force, edge cases."""

import random
import re

import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import graph, simhash

SCHEMA = "doc_id long, text string, component long, fp string"


def plain(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(fps):
    """Smallest id reachable over links of at most three bits; fps: (id, fp)."""
    top = {i: i for i, _ in fps}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in fps:
        for j, b in fps:
            if i < j and (a ^ b).bit_count() <= 3:
                a_, b_ = find(i), find(j)
                top[max(a_, b_)] = min(a_, b_)
    return {i: find(i) for i, _ in fps}


def test_fingerprints_equal_the_plain_version():
    for text in [None, "", " \n\t", "one", "One  two", "ÀB c D e f g", "a " * 70000, "x\x0by\x0cz\x1cw q", "tab\tA\r\nb"]:
        for k in (3, 5):
            assert simhash.fingerprint(text, k) == plain(text, k)


def test_components_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(texts)]
    for _ in range(120):
        t = rng.choice(texts).split()
        for _ in range(rng.choice([0, 1, 1, 2])):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((len(rows), " ".join(t)))
    rows += [(1000, None), (1001, ""), (1002, "  ")]
    df = spark.createDataFrame([(i, t, 7, "clash") for i, t in rows], SCHEMA)
    got = {r["id"]: r["component"] for r in simhash.near_duplicates(df).collect()}
    assert got == brute([(i, plain(t, 3)) for i, t in rows])
    assert got[1001] == got[1002] == 1000


def test_links_cover_every_pair_within_three_bits(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(6))) for b in base for _ in range(12)})
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    classes = spark.createDataFrame(list(enumerate(signed)), "rep long, fp long")
    got = {tuple(sorted((r["a"], r["b"]))) for r in simhash.links(classes).collect()}
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if (fps[i] ^ fps[j]).bit_count() <= 3}
    assert got == want


def test_keep_one_with_copies_repeated_and_null_ids(spark):
    text = "the same words in every copy of it"
    df = spark.createDataFrame([(5, text, 1, "x"), (3, text, 2, "x"), (3, text, 2, "x"), (None, text, 3, "x"), (9, "another text that stands alone here", 4, "x")], SCHEMA)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or -1, r["component"]) for r in kept.collect()) == [(-1, 3), (3, 2), (9, 4)]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).collect() == [] and simhash.keep_one(df).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (200, 150)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r["node"]: r["component"] for r in graph.components(df, "a", "b").collect()}
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)} | {200: 150, 150: 150}
    assert got == want


def test_keep_one_goes_by_fingerprints_too(spark, monkeypatch):
    """Documents that only their fingerprints link, as the shingles link nothing here."""
    alone = lambda docs, id_col, text_col, words: docs.select(F.col(id_col).alias("id"), F.col(id_col).alias("component"))
    monkeypatch.setattr(simhash.similar, "near_duplicates", alone)
    text = "the same words in every copy of it"
    df = spark.createDataFrame([(5, text, 1, "x"), (3, text.upper(), 2, "x"), (9, "another text that stands alone here", 4, "x")], SCHEMA)
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == [3, 9]


def test_exploded_keys_are_not_broadcast(spark):
    classes = spark.range(2000).select(F.col("id").alias("rep"), F.xxhash64("id").alias("fp"))
    found = simhash.links(classes)
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
