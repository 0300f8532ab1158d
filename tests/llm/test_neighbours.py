"""Embeddings: links and components against brute force, recall, balance of codes, edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, code string, n long"


def brute(rows, threshold=0.98):
    good = [(i, np.array(v, np.float64), l) for i, v, l, *_ in rows if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: 0 for i, *_ in rows}
    top = {i: i for i, *_ in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for k, (i, a, l) in enumerate(good):
        for j, b, m in good[k + 1 :]:
            if l == m and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return links, {i: find(i) for i in top}


def clustered(n=500, d=64, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((60, d))
    rows = []
    for i in range(n):
        c = centres[rng.integers(60)]
        v = c + rng.standard_normal(d) * rng.choice([0.0, 0.05, 0.12, 0.3])
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(3)), "x", 1))
    return rows


def test_links_and_components(spark):
    rows = clustered()
    odd = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 64, 1), (1003, [float("nan")] + [1.0] * 63, 1), (1004, [None] + [1.0] * 63, 1), (1005, rows[0][1], None), (1006, [1.0, 2.0], 1), (1007, [2.0, 4.0], 1)]
    rows += [(*o, "x", 1) for o in odd] + [(1008, rows[3][1], rows[3][2], "x", 1), (1009, [2 * x for x in rows[3][1]], rows[3][2], "x", 1)]
    links, top = brute(rows)
    got = {r["id"]: r for r in neighbours.near_duplicates(spark.createDataFrame(rows, SCHEMA), block=16).collect()}
    assert len(got) == len(rows)
    found, want = sum(r["n_links"] for r in got.values()), sum(links.values())
    assert want > 200 and found >= 0.98 * want and all(got[i]["n_links"] <= n for i, n in links.items())
    same = sum(got[i]["component"] == top[i] for i in top)
    assert same >= 0.97 * len(top)
    assert all(got[i]["component"] <= i for i in top)


def test_codes_are_balanced():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 64)) * np.linspace(0.2, 2, 64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    how = neighbours.fit(x)
    bits = np.unpackbits(how.codes(x).view(np.uint8).reshape(-1, 8), axis=1)
    assert abs(bits.mean(axis=0) - 0.5).max() < 0.1


def test_a_large_group_of_copies_counts_without_pairs(spark):
    v = [float(i) for i in range(64)]
    rows = [(i, v, 1, "x", 1) for i in range(3000)]
    got = neighbours.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    r = got.selectExpr("min(n_links) a", "max(n_links) b", "max(component) c", "count(*) n").first()
    assert (r["a"], r["b"], r["c"], r["n"]) == (2999, 2999, 0, 3000)


def test_empty_and_null_ids(spark):
    assert neighbours.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    r = neighbours.near_duplicates(spark.createDataFrame([(None, [1.0, 2.0], 1, "x", 1)], SCHEMA)).first()
    assert r["n_links"] == 0 and r["component"] is None


@pytest.mark.parametrize("d", [3, 100])
def test_other_lengths(spark, d):
    rows = clustered(80, d, 5)
    links, _ = brute(rows)
    got = {r["id"]: r["n_links"] for r in neighbours.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(got.values()) >= 0.9 * sum(links.values())


def test_all_pairs_where_codes_cannot_tell(spark, monkeypatch):
    """A mean so large that six rotations still miss pairs: nothing is lost, as in exact mode."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((40, 32))
    rows = [(i, [float(x) for x in np.float32(centres[rng.integers(40)] * 0.2 + 6 + rng.standard_normal(32) * 1.1)], int(rng.integers(2)), "x", 1) for i in range(500)]
    x = np.array([v for _, v, *_ in rows])
    assert neighbours.rotations_of(x / np.linalg.norm(x, axis=1, keepdims=True), 0.98) is None
    links, top = brute(rows)
    assert sum(links.values()) > 200
    monkeypatch.setattr(neighbours, "FOLLOWERS", 2)
    df = spark.createDataFrame(rows, SCHEMA)
    for some in (neighbours.near_duplicates(df, block=64), neighbours.near_duplicates(df, block=64, exact=True)):
        got = {r["id"]: (r["n_links"], r["component"]) for r in some.collect()}
        assert got == {i: (links[i], top[i]) for i in links}


def test_exploded_keys_are_not_broadcast(spark):
    codes = spark.range(2000).select((F.col("id") % 3).alias("group"), F.xxhash64("id").alias("code"))
    found = neighbours.candidates(codes)
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
