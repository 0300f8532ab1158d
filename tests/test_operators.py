"""Operators on small tables worked out by hand."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import audit, detectors, folds, gates, layout, linter, pairs, rules, shape, statblock, translate
from corpusloom.functions import geometry as G
from corpusloom.sources import readers, writers
from corpusloom.streaming import incremental


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def boxes(spark, data):
    data = [(p, i, *map(float, sides)) for p, i, *sides in data]
    df = spark.createDataFrame(data, "page long, id string, x0 double, y0 double, x1 double, y1 double")
    return df.select("page", "id", G.rect("x0", "y0", "x1", "y1").alias("box"))


def test_extensions_and_system_files(spark):
    names = ["a/.bashrc", "b.tar.gz", "x", "d.e/f", "g.PDF", "h.", ".DS_Store/x", "y/._z", "q/.DS_Storex"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = {r["p"]: (r["e"], r["s"]) for r in df.select("p", audit.extension_of(F.col("p")).alias("e"), audit.is_system_file(F.col("p")).alias("s")).collect()}
    assert [got[n][0] for n in names[:6]] == ["[no extension]", ".gz", "[no extension]", "[no extension]", ".pdf", "[no extension]"]
    assert [got[n][1] for n in names[6:]] == [True, True, False]


def test_files_are_found(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.txt").write_text("same")
    (tmp_path / "y.txt").write_text("same")
    (tmp_path / "z.txt").write_text("")
    (tmp_path / "link").symlink_to(tmp_path / "y.txt")
    found = readers.files(spark, f"file://{tmp_path}")
    assert {"a/x.txt", "y.txt", "z.txt"} <= {r["relative_path"] for r in found.collect()} and found.filter("size_bytes = 0").count() == 1
    assert [r["relative_path"] for r in readers.files(spark, str(tmp_path)).orderBy("relative_path").collect()] == ["a/x.txt", "y.txt", "z.txt"]
    groups = audit.duplicate_groups(readers.contents(spark, f"file://{tmp_path}/*.txt").unionByName(readers.contents(spark, f"file://{tmp_path}/a")))
    assert [(r["copies"], r["size_bytes"]) for r in groups.collect()] == [(2, 4)]


def test_linter(spark):
    good = "---\nname: my-skill\ndescription: x\n---\n[a](references/a.md)"
    folders = spark.createDataFrame([("s/my-skill", good), ("s/Other", "---\nname: Bad Name\n---\n[a](references/no.md)"), ("s/none", None)], "folder string, content string")
    paths = spark.createDataFrame([("s/my-skill/references/a.md",)], "path string")
    got = rows(linter.errors(folders, paths), "folder", "error")
    assert [f for f, _ in got] == ["s/Other"] * 4 + ["s/none"] and not any("my-skill" in f for f, _ in got)


def test_values_and_dispatch(spark):
    t = spark.createDataFrame([(1, "a", None), (1, "b", '"~"'), (1, "c", '"hola"'), (1, "d", '{"t": "x", "size": 8.0, "caja": [1, 2, 3, 4]}'), (1, "e", "null"), (1, "f", '""')], "page long, block string, value string")
    v = pairs.values(t)
    assert rows(v, "block", "kind") == [("a", "keep"), ("b", "erase"), ("c", "text"), ("d", "control"), ("e", "keep"), ("f", "text")]
    own = v.withColumn("box", F.array(F.lit(0.0))).withColumn("size", F.lit(9.0))
    got = {r["block"]: r for r in pairs.dispatch(own).collect()}
    assert [got[k]["action"] for k in "abcdef"] == ["keep", "erase", "replace", "replace with options", "keep", "keep"]
    assert got["d"]["size"] == 8.0 and got["d"]["box"] == [1.0, 2.0, 3.0, 4.0] and got["c"]["size"] == 9.0


def test_gate(spark):
    pages = spark.range(1, 6).withColumnRenamed("id", "page")
    led = lambda *x: spark.createDataFrame([(v,) for v in x], "line string")
    ok = gates.gate(pages, led("# cobertura: 1-3,5", "# Cobertura: 4,x-2,5-3", "p\tq")).first()
    assert ok["ok"] and ok["missing"] == 0 and ok["corrections"] == 1
    bad = gates.gate(pages, led("# cobertura: 1-3")).first()
    assert not bad["ok"] and bad["first_missing"] == [4, 5]
    assert not gates.gate(pages, led("nothing")).first()["ok"]
    assert rows(gates.gate_defect(gates.gate(pages, led("# cobertura: 1-3"))), "kind", "detail") == [("VALIDACION", "missing 2 pages: 4,5")]


def test_rules(spark):
    found, bad = rules.parse(["patrón\treemplazo", "# c", "", r"(a)b" + "\t" + r"\1$", "[x\ty", "alone"], spark)
    assert found == [("(a)b", r"\1$", "")] and bad == ["[x"]
    df = spark.createDataFrame([("abab",), ("q",), (None,)], "t string")
    got = rules.apply(df, "t", found).collect()
    assert [(r["t"], r["changed"]) for r in got] == [("a$a$", True), ("q", False), (None, False)]
    assert [(r["pattern"], r["rows"]) for r in rules.hits(df, "t", found).collect()] == [("(a)b", 1)]
    once = df.select(rules.apply_once(rules.apply_once(F.col("t"), "a", "xa"), "a", "xa").alias("t")).first()["t"]
    assert once == "xabxab"


def test_detectors_skip_what_is_not_translated(spark):
    p = spark.createDataFrame([(1, "a", "Take 3 apples and go to the market now please", None), (1, "b", "Take 3", "~"), (1, "c", "Take 3", "Toma 4"), (1, "d", "GM Binder ©", None)], "page long, block string, en string, es string")
    assert rows(detectors.untranslated(p), "block") == [("a",)]
    assert rows(detectors.numbers(p), "block") == [("c",)]


def test_page_numbers_are_bags(spark):
    p = spark.createDataFrame([(1, "2 2 3 d4", "2 3 3 1d4")], "page long, en string, es string")
    assert rows(detectors.page_numbers(p), "number", "only_en", "only_es") == [("2", 1, 0), ("3", 0, 1)]


def test_first_fit_is_not_transitive(spark):
    b = boxes(spark, [(1, "a", 0, 0, 10, 10), (1, "b", 100, 1, 110, 11), (1, "c", 50, 2, 60, 12), (2, "a", 0, 0, 1, 1)])
    got = rows(folds.proximity_clusters(b, 45.0).repartition(7), "page", "id", "cluster")
    assert got == [(1, "a", 0), (1, "b", 1), (1, "c", 0), (2, "a", 0)]


def test_blocks_from_lines(spark):
    line = lambda t, x, y, kind="cuerpo", col="L": (1, 1000.0, 1000.0, t, float(x), float(y), 300.0, 10.0, 1.0, kind, col)
    data = [line("T", 0, 200, "dropcap"), line("he mar-", 0, 212), line("ket opens", 0, 224), line("New par", 20, 236), line("far", 0, 400), line("7", 0, 990, "folio"), line("Title", 0, 50, "h_mayor", "R")]
    got = folds.blocks_from_lines(spark.createDataFrame(data, readers.LINES).repartition(3)).orderBy("id").collect()
    assert [(b["type"], b["col"], b["text"], b["dropcap"]) for b in got] == [("titulo", "F", "Title", None), ("cuerpo", "L", "he market opens\n\nNew par", "T"), ("cuerpo", "L", "far", None)]
    assert got[1]["leading_px"] == 12.0 and got[1]["size_pt"] == 2.4


def test_echo():
    assert folds.without_echo("**A** a b B") == "**A** b"
    assert folds.without_echo("one two one two three") == "one two three"
    assert folds.without_echo("1 1 2 2") == "1 1 2 2" and folds.without_echo(None) is None


def test_folds_as_expressions(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c.alias("v")).first()["v"]
    assert pick(folds.wrapped_lines(F.lit("aaa bbb ccc\n\nd"), F.lit(8.0))) == 3
    assert pick(folds.fill_columns(F.array(*[F.lit(x) for x in (4.0, 4.0, 4.0, 4.0)]), 2)) == [0, 0, 1, 1]
    seg = F.array(*[F.struct(F.lit(float(s)).alias("size"), F.lit(c).alias("chars")) for s, c in [(20, 10), (9, 30), (30, 1), (9, 30), (9, 30)]])
    assert pick(folds.size_segments(seg)) == [0, 1, 2, 2, 2]
    words = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(t).alias("text")) for x, t in [(0, "a"), (1, "a"), (2.5, "a"), (9, "b")]])
    assert [w["x"] for w in pick(folds.drop_echoed_words(words))] == [0.0, 2.5, 9.0]
    assert pick(folds.until_leader(F.array(F.lit("a"), F.lit("b"), F.lit("..."), F.lit("12")))) == ["a", "b"]
    claims = F.array(F.struct(F.lit("b1").alias("block"), F.array(F.lit("b2")).alias("list"), F.lit("L").alias("side")), F.struct(F.lit("b3").alias("block"), F.lit(None).cast("array<string>").alias("list"), F.lit("L").alias("side")))
    blocks = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(s).alias("side")) for i, s in [("b1", "L"), ("b2", "L"), ("b3", "L"), ("b4", "L"), ("b5", "R")]])
    assert [(r["block"], r["takes"]) for r in pick(folds.absorb_rest(claims, blocks))] == [("b1", ["b2"]), ("b3", ["b4"])]
    assert pick(folds.first_fitting(F.array(F.lit(9), F.lit(8), F.lit(7)), lambda s: s < 9)) == 8


def test_upper_median(spark):
    for values, want in (([5], 5), ([1, 2], 2), ([4, 1, 3, 2], 3)):
        assert spark.range(1).select(folds.upper_median(F.array(*[F.lit(v) for v in values])).alias("v")).first()["v"] == want


def test_clip_and_space(spark):
    b = boxes(spark, [(1, "a", 0, 0, 100, 20), (1, "p", 0, 18, 100, 40)])
    got = {r["id"]: r["box"]["y1"] for r in layout.clip(b.filter("id = 'a'"), b.filter("id = 'p'")).collect()}
    assert got == {"a": 17.75}
    assert rows(layout.space_below(b, 43.0), "id", "space") == [("a", 4.0), ("p", 0.0)]


def test_journal_names_its_first_page(spark):
    p = spark.createDataFrame([(1, 1, "h1", "A", "n"), (1, 2, None, "x", "n"), (1, 3, "h1", "B", "n"), (2, 1, None, "y", "m")], "doc long, pos long, level string, html string, name string")
    got = rows(shape.journal_pages(p, ["doc"], ["pos"]), "doc", "sort", "name", "content")
    assert got == [(1, 10, "A", "<h1>A</h1>x"), (1, 20, "B", "<h1>B</h1>"), (2, 10, "m", "y")]


PANEL = """GOBLIN BOSS
Small humanoid (goblinoid), neutral evil
Armor Class: 17 (natural armor)
Hit Points 21 (6d6)
Speed 30 ft., fly 60 ft.
STR DEX CON INT WIS CHA
10 (+0) 14 (+2) 10 (+0) 10 (+0) 8 (-1) 10 (+0)
Skills Stealth +6
Senses darkvision 60 ft.
Languages Common, Goblin
Challenge 1/4 (50 XP)
Nimble escape text long enough ACTIONS Scimitar. Melee attack with reach"""


def test_stat_block_fields(spark):
    df = spark.createDataFrame([(PANEL,)], "t string")
    flat = statblock.flat_text(F.col("t"))
    r = df.select(
        statblock.defence_lines(flat).alias("d"), statblock.abilities(flat).alias("a"), statblock.labelled_lines(flat).alias("l"),
        statblock.kind_line(flat).alias("k"), statblock.sections(statblock.remainder(flat, F.lit("GOBLIN BOSS"))).alias("s"),
    ).first()
    assert r["d"] == ["**Clase de Armadura** 17 (armadura natural)", "**Puntos de golpe** 21 (6d6)", "**Velocidad** 30 pies, volar 60 pies"]
    assert [(x["k"], x["v"]) for x in r["a"]][4] == ("SAB", "8 (−1)") and r["k"].startswith("Small humanoid")
    assert r["l"] == ["**Habilidades** Sigilo +6", "**Sentidos** visión en la oscuridad 60 pies", "**Idiomas** común, goblin", "**Desafío** 1/4 (50 PX)"]
    assert [(x["section"], x["text"]) for x in r["s"]] == [("traits", "Nimble escape text long enough"), ("actions", "Scimitar. Melee attack with reach")]


def test_actors_and_tables(spark):
    parts = "array<struct<h:string,t:string,table:array<struct<k:string,v:string>>>>"
    body = [(None, "**Clase de Armadura** 15\n\n**Puntos de golpe** 21 (6d6)\n\n**Velocidad** 30 pies, volar 60 pies\n\n**Desafío** 1/4 (50 PX)", None), (None, None, [("FUE", "10 (+0)")]), ("ACCIONES", "***Golpe.*** Pega *fuerte*.", None)]
    df = spark.createDataFrame([(1, 1, "JEFE GOBLIN", "*x*", body), (2, 1, "Jefe Goblin", "y", body), (2, 2, "", "z", body)], f"page long, place long, title string, sub string, parts {parts}")
    got = statblock.actors(df).collect()
    assert len(got) == 1
    a = got[0]
    assert (a["name"], a["ac"], a["hp"], a["formula"], a["cr"], a["movement"], a["abilities"], a["kind"], a["file"]) == ("Jefe Goblin", 15, 21, "6d6", 0.25, {"walk": 30, "fly": 60}, {"str": 10}, "x", "jefe-goblin.json")
    assert [(i["name"], i["html"]) for i in a["items"]] == [("Golpe", "<p><em>(acción)</em></p><p>Pega <em>fuerte</em>.</p>")]
    html = df.limit(1).select(statblock.panel_html(F.col("title"), F.col("sub"), F.slice("parts", 2, 1)).alias("h")).first()["h"]
    assert html == "<h3>JEFE GOBLIN</h3><p><em>x</em></p><table><tr><td style='text-align:center'><b>FUE</b><br>10 (+0)</td></tr></table>"
    t = spark.createDataFrame([(1, "b", "*tesoros*\n\n**d6 — x**\n\n**1-4** — *Oro*\n\n**5** — Nada"), (1, "c", "**d6 —**\n\n**1** — x")], "page long, block string, t string")
    assert [(r["name"], r["formula"], [tuple(x) for x in r["results"]]) for r in statblock.roll_tables(t).collect()] == [("Tesoros", "1d6", [("Oro", 1, 4, 4), ("Nada", 5, 5, 1)])]


def test_requests_are_tried_again_and_guarded(spark):
    class Moody:
        """Answers nothing at first, and numbers wrongly once."""

        def __init__(self):
            self.calls = 0

        def translate(self, batch):
            self.calls += 1
            if self.calls == 1:
                raise RuntimeError("down")
            return {k: v.upper() + (" 9" if self.calls == 2 else "") for k, v in batch.items()}

    df = spark.createDataFrame([(str(i), f"text {i}") for i in range(25)] + [("n", None)], "key string, text string").coalesce(1)
    got = {r["key"]: r["result"] for r in translate.request(df, Moody, size=10).collect()}
    assert got["3"] == "TEXT 3" and len(got) == 26 and got["n"] is None


def test_repair_keeps_numbers_and_ends(spark):
    blocks = spark.createDataFrame([(1, "a", "short", 9.5), (1, "b", "a long text 42 that ends", 9.5), (1, "c", "x" * 40, 9.5)], "page long, block string, t string, size double")
    fits = lambda df: df.withColumn("fits", F.length("t") * F.col("size") < 190)
    shorten = lambda df: df.withColumn("result", F.when(F.col("block") == "b", F.lit("text 42 ends")).otherwise(F.lit("no 7")))
    got = {r["block"]: (r["t"], r["size"], r["fits"]) for r in translate.repair(blocks, fits, shorten, ["text"], lambda df, _: df.cache()).collect()}
    assert got["a"] == ("short", 9.5, True) and got["b"] == ("text 42 ends", 9.5, True) and got["c"] == ("x" * 40, 8.2, False)


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "g.tsv").write_text('en\tes\tfuente\tnota\n"a"\t"b\tS\tn\nno tab\nc\td\tS\tn\n')
    assert rows(readers.glossary_raw(spark, f"file://{tmp_path}/g.tsv"), "en", "es") == [('"a"', '"b'), ("c", "d")]
    lines = spark.createDataFrame([("3\tb1, b2\tbecause",), ("x",)], "line string")
    assert rows(readers.overrides(lines), "page", "block") == [("3", "b1"), ("3", "b2")]
    df = spark.createDataFrame([("pag-007.json", "a/pag-012-3.jpg")], "a string, b string")
    assert tuple(df.select(readers.page_number(F.col("a")), readers.image_page(F.col("b"))).first()) == (7, 12)
    out = f"file://{tmp_path}/pages"
    writers.pages(spark.createDataFrame([(1, "a"), (2, "b")], "page int, t string"), out)
    writers.pages(spark.createDataFrame([(2, "c")], "page int, t string"), out)
    assert rows(spark.read.json(out), "page", "t") == [(1, "a"), (2, "c")]
    report = [r["line"] for r in writers.sectioned([("A", spark.createDataFrame([("x", 2), ("y", 10)], "w string, n long"))], "n", "w").collect()]
    assert report == ["== A ==", "  10 y", "   2 x"]
    assert readers.Project({"nombres_propios": ["Ana B"]}).names == {"ana", "b"}


def test_progress_and_overrides(spark):
    status = spark.createDataFrame([(1, "ok", None), (2, None, None)], "pdf_page int, ocr string, v4 string")
    got = gates.update_progress(status, spark.createDataFrame([(2, "ok"), (3, "ok")], "pdf_page int, v4 string"), "pdf_page", "v4")
    assert {tuple(r) for r in got.collect()} == {(1, "ok", None), (2, None, "ok"), (3, None, "ok")}
    fails = spark.createDataFrame([(1, "numbers"), (2, "numbers"), (2, "glossary")], "page long, kind string")
    old = spark.createDataFrame([(1, {"nota": "x"}), (3, {"a": "b"})], "page long, flags map<string,string>")
    assert {r["page"]: r["flags"] for r in gates.allow_numbers(fails, old).collect()} == {1: {"nota": "x", "numeros_ok": "true"}, 3: {"a": "b"}}


def test_only_new_files_run(spark, tmp_path):
    src, out, mark = (f"{tmp_path}/{n}" for n in ("in", "out", "ck"))
    (tmp_path / "in").mkdir()
    for n in (1, 2):
        (tmp_path / "in" / f"{n}.json").write_text(f'{{"n": {n}}}')
        incremental.run_new(spark, src, "n long", lambda df: df.withColumn("m", F.col("n") * 10), out, mark)
    assert rows(spark.read.parquet(out), "n", "m") == [(1, 10), (2, 20)]
