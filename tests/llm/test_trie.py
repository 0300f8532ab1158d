"""The trie of rebuilt conversations against a plain one."""

import collections
import hashlib
import random
import zlib

from pyspark.sql import functions as F

from corpusloom.llm import queries, trie

SF = "/root/testdata/sf0.001"


def plain(rows):
    """All nodes of (conv_id, turn, role, text), by walking each rebuilt conversation."""
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    members, ends, children = collections.defaultdict(set), collections.defaultdict(list), collections.defaultdict(set)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        path = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
            if d:
                children[path[: d - 1]].add(path[:d])
        ends[path].append(c)

    def below(p):
        some = [below(x) for x in children[p]]
        saved = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        return sum(x[0] for x in some) or 1, saved + sum(x[1] for x in some)

    out = []
    for p in list(members):
        listed = ",".join(map(str, sorted(ends[p])))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), *below(p), hashlib.sha256(listed.encode()).hexdigest()))
    return collections.Counter(out)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    return collections.Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_op11(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert got(queries.op11_conversation_trie(spark, SF)) == plain(rows)


def test_planted(spark, monkeypatch):
    """Copies of whole conversations, shared beginnings, absent bases, turnless and long conversations, nulls."""
    rng = random.Random(4)
    some = [("user", "hi"), ("assistant", "Öhm, ja"), ("user", ""), (None, None), ("user", "x" * 3000)]
    rows = []
    for c in [*range(40, 160), 163, 164, 999]:
        if rng.random() < 0.2:
            continue
        k = rng.choice([1, 2, 6, 9, 12])
        turns = [some[i % 5] for i in range(k)] if rng.random() < 0.6 else [rng.choice(some) for _ in range(k)]
        rows += [(c, t, *x) for t, x in enumerate(turns)]
    rows += [(7, t, "user", f"line {t}") for t in range(70)] + [(c, t, "user", f"line {t}") for c in (5, 6) for t in range(70)]
    rows += [(-3, 0, "user", "below"), (0, 0, "user", "zero"), (3, None, "user", "no number"), (3, 0, "user", "numbered"), (None, 1, "user", "nobody's")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"node": F.lit(1), "base": F.lit("x")}).repartition(5)
    # in Spark and C -3 % 5 is -3, and the base of -3 is 0
    want = plain([(c, t, r, x) for c, t, r, x in rows if c != -3])
    whole = got(trie.prefix_trie(df.filter("conv_id IS NULL OR conv_id >= 0")))
    assert whole == want
    monkeypatch.setattr(trie, "CHUNK", 10)
    monkeypatch.setattr(trie, "NODES", 3)
    assert got(trie.prefix_trie(df.filter("conv_id IS NULL OR conv_id >= 0"))) == want
    assert trie.prefix_trie(df).filter("conv_id = -3 AND depth = 0").count() == 1
    for least in (5, 0):  # conversations beyond are split among tasks, long bases and short ones, of short and long families
        monkeypatch.setattr(trie, "LONG", least)
        assert got(trie.prefix_trie(df.filter("conv_id IS NULL OR conv_id >= 0"))) == want


def test_equal_turns_and_an_empty_table(spark):
    df = spark.createDataFrame([(5, 1, "user", "same")] * 3 + [(6, 1, "user", "same")] * 3, "conv_id long, turn long, role string, text string")
    assert got(trie.prefix_trie(df)) == plain([tuple(r) for r in df.collect()])
    assert trie.prefix_trie(df.limit(0)).count() == 0
