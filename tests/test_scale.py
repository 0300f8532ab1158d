"""What must hold for large tables: no nested loops, no single task, no pair of all with all."""

import random
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import geometry as G
from corpusloom.functions import text as T
from corpusloom.operators import audit, detectors, folds, joins, layout, linter, ranking, shape, statblock


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_places_come_from_ranges(spark):
    rows = [(i % 7, f"{i:03d}" if i % 11 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b string")
    got = ranking.placed(df, ["a", "b"], "place").orderBy("place").collect()
    assert [r["place"] for r in got] == list(range(1, 301)) and [(r["a"], r["b"] or "") for r in got] == sorted((a, b or "") for a, b in rows)
    assert ranking.placed(df.limit(0), ["a"], "place").count() == 0
    groups = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "sha256 string, size_bytes long")
    placed = audit.in_order(groups)
    assert [r["sha256"] for r in placed.orderBy("place").collect()] == ["c", "a", "b"] and "Window" not in plan(placed)


@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(20,3)"])
def test_nth_is_exact(spark, monkeypatch, kind):
    monkeypatch.setattr(ranking, "BINS", 4)
    rng = random.Random(3)
    values = [rng.choice([rng.randrange(-50, 50), rng.randrange(10**12), 7]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long").select(F.col("v").cast(kind).alias("v")).repartition(3)
    for place in (None, 0, 1, 250, 499):
        assert float(ranking.nth(df, "v", place).first()["v"]) == sorted(values)[len(values) // 2 if place is None else place]
    assert ranking.nth(df, "v", 500).count() == 0 and ranking.nth(df.limit(0), "v").count() == 0
    assert "Window" not in plan(shape.upper_medians(df, [], "v"))


def test_nth_with_infinite_values(spark):
    values = [float("inf"), float("-inf"), float("nan"), 1.0, 2.0, 3.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [ranking.nth(df, "v", i).first()["v"] for i in range(6)] == [float("-inf"), 1.0, 2.0, 3.0, float("inf"), float("inf")]
    assert ranking.nth(df, "v", 6).filter("isnan(v)").count() == 1


def test_a_page_of_many_boxes(spark):
    n, rng = 100_000, random.Random(5)
    boxes = [(1, i, *(v := (rng.uniform(0, 6000), rng.uniform(0, 6000))), v[0] + rng.uniform(1, 30), v[1] + rng.uniform(1, 20)) for i in range(n)]
    df = spark.createDataFrame(boxes, "page long, id long, a double, b double, c double, d double").select("page", "id", G.rect("a", "b", "c", "d").alias("box")).repartition(8)
    found = layout.overlaps(df, 1.0, 1.0).collect()
    at = {}
    for _, i, a, b, c, d in boxes:
        for x in range(int(a // 40), int(c // 40) + 1):
            for y in range(int(b // 40), int(d // 40) + 1):
                at.setdefault((x, y), []).append((i, a, b, c, d))
    want = set()
    for held in at.values():
        for i, a, b, c, d in held:
            want |= {(i, j) for j, e, f, g, h in held if i < j and min(c, g) - max(a, e) > 1 and min(d, h) - max(b, f) > 1}
    assert len(found) == len(want) and {(r["a"], r["b"]) for r in found} == want
    touching = layout.touching(df.select("page", "id", "box"), df.filter("id % 10 = 0").select("page", "id", "box"))
    assert touching.count() == touching.distinct().count() > n / 10
    cells = df.select(F.lit(1).alias("region"), "id", "box")
    centres = [(1, k, float(k * 37 % 6000)) for k in range(0, 3000)] + [(1, 5000, 37.0)]
    got = layout.nearest_column(cells, spark.createDataFrame(centres, "region int, column int, x double")).collect()
    assert len(got) == n
    place = {i: (a + c) / 2 for _, i, a, b, c, d in boxes}
    for r in rng.sample(got, 300):
        x = place[r["id"]]
        best = min((abs(x - cx), k) for _, k, cx in centres)[1]
        assert r["column"] == (-1 if x < min(cx for *_, cx in centres) - 15 else best)


@pytest.mark.parametrize("few", [True, False])
def test_terms_meet_texts_without_nested_loops(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(joins.is_small, "__defaults__", (0,))
    terms = ["(+1) sword", "¡alto!", "€", "Long Sword", "'s", "12 gold", "…", "magic"]
    texts = ["a (+1) sword here", "¡alto! dijo", "5 € or more", "The Long Sword's edge", "12 gold and …", "", "magical thing", "x" * 50 + "€"]
    pairs = spark.createDataFrame([(1, i, t, t) for i, t in enumerate(texts)], "page long, block long, en string, es string")
    glossary = spark.createDataFrame([(t, "t") for t in terms], "term string, target string")
    found = detectors.occurrences(pairs, glossary, "(?<![A-Za-z])", "(?![a-z])")
    assert sorted((r["block"], r["term"]) for r in found.collect()) == sorted([(0, "(+1) sword"), (1, "¡alto!"), (2, "€"), (3, "Long Sword"), (4, "12 gold"), (4, "…")])  # the others follow letters
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    pages = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "page long, text string")
    held = shape.page_terms(pages, spark.createDataFrame([(t, "t") for t in ["€", "ag", "magic", "long sword", "(+1) sword x"]], "en string, es string"))
    want = {(i, t) for i, x in enumerate(texts) for t in ("€", "ag", "magic", "long sword", "(+1) sword x") if (t[:-2] if len(t) >= 6 else t[:4] if len(t) == 5 else t) in x.lower()}
    assert {(r["page"], r["en"]) for r in held.collect()} == want and "NestedLoop" not in plan(held)


def test_contexts_of_many_matches(spark):
    text = " ".join(f"w{i} the" for i in range(20_000))
    got = spark.createDataFrame([(text,), ("",), (None,), ("none",)], "t string").select(T.context_snippets(F.col("t"), "the").alias("c")).collect()
    want, at = [], text.find("the")
    while at >= 0:
        want.append(text[max(0, at - 35) : at + 38])
        at = text.find("the", at + 3)
    assert got[0]["c"] == want and got[1]["c"] == [] and got[3]["c"] == []


def test_divergent_keeps_a_few_sites_of_countless_versions(spark):
    rows = [(i, 0, "a passage that stands everywhere", f"una versión número {i}") for i in range(3000)] + [(1, 1, "another passage, twice", "igual"), (2, 1, "another passage, twice", "igual")]
    found = detectors.divergent(spark.createDataFrame(rows, "page long, block long, en string, es string").repartition(4))
    got = found.collect()
    assert len(got) == 1 and got[0]["page"] == 0 and got[0]["detail"].count("versión") == 4
    assert "WindowGroupLimit" in plan(found)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_styled_text_joins_nothing(spark):
    rows = [(1, 0, "a", True, False, "Serif", 5, 10.0), (1, 1, "b", False, False, "Serif", None, 14.0), (1, 2, "c", False, False, "Serif", None, 10.0), (2, 0, " ", False, False, "Serif", 7, 9.0), (3, 0, "d", False, True, "X-SC", 9, 9.0)]
    spans = spark.createDataFrame(rows, "page long, place int, text string, bold boolean, italic boolean, font string, color int, size double")
    found = shape.styled_text(spans, ["page"])
    assert {r["page"]: r["text"] for r in found.collect()} == {1: "**a** ‹g›b‹/g› c", 3: "‹sc›*d*‹/sc›"}
    assert "Join" not in optimized(found)


def test_list_items_of_repeated_rows(spark):
    rows = [(1, y, 6 * (y % 2), "word") for y in range(4)] * 2
    got = folds.list_items(spark.createDataFrame(rows, "page long, y long, x0 long, text string"), ["page"])
    assert sorted((r["y"], r["item"]) for r in got.collect()) == [(0, 2), (0, 2), (1, 2), (1, 2), (2, 4), (2, 4), (3, 4), (3, 4)]


def test_long_texts_are_read_once(spark):
    """Each is linear in the length; reading the text again for every piece of it would take minutes."""
    n = 20_000
    colours = spark.range(1).select(F.repeat(F.lit("«c:00AAff»x"), n).alias("t"))
    began = time.monotonic()
    assert colours.select(T.normal_tokens(F.col("t")).alias("t")).first()["t"] == "‹c:00aaff›x" * n
    damage = spark.range(1).select(F.repeat(F.lit("fire damage "), n).alias("en"), F.repeat(F.lit("daño ígneo "), n).alias("es"))
    assert damage.select(T.align_damage(F.col("en"), F.col("es")).alias("t")).first()["t"] == "daño de fuego " * n
    parts = spark.range(1).select(F.repeat(F.lit("ACTIONS a text long enough "), n).alias("t"))
    assert parts.select(F.size(statblock.sections(F.col("t"))).alias("n")).first()["n"] == n
    echoes = " ".join(f"w{i} w{i} x{i} y{i}" for i in range(3000))
    assert folds.without_echo(echoes) == " ".join(f"w{i} x{i} y{i}" for i in range(3000))
    assert time.monotonic() - began < 60


def test_letters_are_the_same_with_any_brackets(spark):
    rows = [("‹sc›El  Ser‹/sc› ‹c:00aaff›x‹/c›", "« sc »el ser< / sc > <c : 00AAFF>X« / c »", True), ("‹g›a‹/g›b", "gagb", False)]
    got = spark.createDataFrame(rows, "a string, b string, same boolean").select(T.same_as_source(F.col("a"), F.col("b")).alias("got"), "same").collect()
    assert all(r["got"] == r["same"] for r in got)


def test_arrays_of_checks_are_computed_once(spark):
    pairs = spark.createDataFrame([(1, 0, "Erthing and a text that is long enough for it", "eventualmente va, un chequeo y eso hace sentido")], "page long, block long, en string, es string")
    names = spark.createDataFrame([("erthing",)], "name string")
    folders = spark.createDataFrame([("a/b", "---\nname: c\n---\n[x](references/y.md)")], "folder string, content string")
    found = {"style": (detectors.style_signals(pairs), 3), "names": (detectors.lost_names(pairs, names), 1), "lint": (linter.errors(folders, spark.createDataFrame([], "path string")), 3)}
    for name, (df, n) in found.items():
        assert df.count() == n, name
        assert not [line for line in optimized(df).splitlines() if "Filter" in line and "size(" in line], name
    versions = detectors.divergent(pairs)
    assert versions.count() == 0 and "Join" not in optimized(versions)
    two = detectors.divergent(pairs.unionByName(pairs.withColumn("es", F.lit("otro"))), sites=1)
    assert [r["detail"].count("p1:0=") for r in two.collect()] == [1]


def test_windows_are_dealt_by_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    assert joins.dealt(df, "k", rows=1000).rdd.getNumPartitions() == df.rdd.getNumPartitions()
    assert joins.dealt(df, "k", rows=50).rdd.getNumPartitions() == 20


def test_only_panels_as_they_came_go_through_the_window(spark):
    parts = "array<struct<h:string,t:string,table:array<struct<k:string,v:string>>>>"
    panels = spark.createDataFrame([(2, 0, "Jefe", None, []), (1, 0, "JEFE", "x", []), (3, 0, None, None, [])], f"page long, place int, title string, sub string, parts {parts}")
    found = statblock.actors(panels)
    assert [(r["page"], r["name"], r["kind"]) for r in found.collect()] == [(1, "Jefe", "x")]
    assert "<h3>" not in optimized(found).split("Window", 1)[1]


def test_wide_rectangles_cover_few_tiles(spark):
    rects = spark.createDataFrame([(1, "r")], "page long, id string").withColumn("box", G.rect(F.lit(10.0), F.lit(40.0), F.lit(310.0), F.lit(140.0)))
    cells = spark.range(30).select(F.lit(1).cast("long").alias("page"), G.rect(F.col("id") * 10.0, F.lit(50.0), F.col("id") * 10.0 + 5, F.lit(60.0)).alias("box"), F.when(F.col("id") % 2 == 0, "7").otherwise("w").alias("text"))
    found = layout.table_regions(rects, cells)
    assert [r["id"] for r in found.collect()] == ["r"]
    assert "/ 250.0" in optimized(found) and "/ 50.0" not in optimized(found)
