"""Queries that write files from a table and read them back, and of the settings that come from files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, gates, rules
from ..sources import named, readers, shared, writers
from . import relations as R
from .registry import query


def _folder(spark, name: str) -> str:
    return shared.scratch(spark, name)


def _single(rows, line):
    """All rows as the text of one file, a line each, in order."""
    return rows.agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))


@query("a1_files", "SELECT 'r' || n_regionkey || '/_f' || n_nationkey || '.txt' AS relative_path, CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE strlen(n_name) END AS size_bytes FROM nation")
def files(spark, sf_dir):
    n = R.table(spark, sf_dir, "nation")
    root = _folder(spark, "files")
    name = F.concat(F.lit("r"), "n_regionkey", F.lit("/_f"), "n_nationkey", F.lit(".txt"))
    writers.page_files(n.select(name.alias("name"), F.when(F.col("n_nationkey") % 5 > 0, F.col("n_name")).otherwise("").alias("text")), root)
    return readers.files(spark, root).select("relative_path", "size_bytes")


@query("a2_documented_folders", "SELECT 's' || n_nationkey AS folder, n_name AS name, 'region ' || n_regionkey AS description FROM nation")
def documented_folders(spark, sf_dir):
    n = R.table(spark, sf_dir, "nation")
    root = _folder(spark, "folders")
    text = F.concat(F.lit("---\nname: "), "n_name", F.lit("\ndescription: \"region "), "n_regionkey", F.lit("\"\n---\ntext"))
    writers.page_files(n.select(F.concat(F.lit("s"), "n_nationkey", F.lit("/SKILL.md")).alias("name"), text.alias("text")), root)
    writers.page_files(n.select(F.concat(F.lit("s"), "n_nationkey", F.lit("/other.md")).alias("name"), text.alias("text")), root)
    d = readers.documented_folders(spark, root)
    return d.select(F.element_at(F.split("folder", "/"), -1).alias("folder"), F.col("front_matter")["name"].alias("name"), F.col("front_matter")["description"].alias("description"))


@query("a4_pages_json", "SELECT n_nationkey AS file_page, n_name AS t, CAST(n_regionkey AS BIGINT) AS region FROM nation WHERE n_nationkey BETWEEN 5 AND 15")
def pages_json(spark, sf_dir):
    n = R.table(spark, sf_dir, "nation")
    root = _folder(spark, "pages")
    text = F.to_json(F.struct(F.col("n_name").alias("t"), F.col("n_regionkey").alias("region")), {"pretty": "true"})
    writers.page_files(n.select(F.concat(F.lit("pag-"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0"), F.lit(".json")).alias("name"), text.alias("text")), root)
    return readers.pages_json(spark, f"{root}/*.json", "t string, region long", 5, 15).select("file_page", "t", "region")


def _glossary(spark, sf_dir):
    n = R.table(spark, sf_dir, "nation")
    root = _folder(spark, "glossary")
    line = F.concat(F.lit('"'), "n_name", F.lit('"\t"es '), "n_nationkey", F.lit('"\tS'), "n_regionkey", F.lit("\tn"))
    body = _single(n, line)
    writers.page_files(body.select(F.lit("g.tsv").alias("name"), F.concat(F.lit("en\tes\tfuente\tnota\n"), "body", F.lit("\nno tab\n")).alias("text")), root)
    return f"{root}/g.tsv"


@query("a5_glossary_raw", "SELECT '\"' || n_name || '\"' AS en, '\"es ' || n_nationkey || '\"' AS es FROM nation")
def glossary_raw(spark, sf_dir):
    return readers.glossary_raw(spark, _glossary(spark, sf_dir))


@query("a6_glossary_quoted", "SELECT n_name AS en, 'es ' || n_nationkey AS es, 'S' || n_regionkey AS fuente FROM nation")
def glossary_quoted(spark, sf_dir):
    return readers.glossary_quoted(spark, _glossary(spark, sf_dir)).filter("es is not null").select("en", "es", "fuente")


@query("a7_rules", "SELECT * FROM (VALUES (0, '(a)b', '\\1$', 'why'), (1, 'c+', '', ''), (2, '[x', NULL, NULL)) AS r(place, pattern, replacement, reason)")
def parsed_rules(spark, sf_dir):
    lines = ["patrón\treemplazo\tmotivo", "# c", "", "(a)b\t\\1$\twhy", "[x\ty", "alone", "c+\t"]
    found, bad = rules.parse(lines, spark)
    rows = [(i, *r) for i, r in enumerate(found)] + [(len(found) + i, p, None, None) for i, p in enumerate(bad)]
    return spark.createDataFrame(rows, "place int, pattern string, replacement string, reason string")


#: Bytes that the audit of written documents hashes at a time: small, so that most of them have several chunks.
CHUNK = 1024


def _written_documents(spark, sf_dir):
    """Documents as files of a new folder, and the list of them."""
    root = _folder(spark, "documents")
    named.write(R.files(spark, sf_dir).select(F.col("path").alias("name"), F.col("content").alias("text")), root)
    return root, readers.files(spark, root)


@query(
    "i40_hash_cascade",
    f"WITH {R.FILES} SELECT sha256(content) AS sha256, size_bytes, count(*) AS copies, string_agg(path, ',' ORDER BY path) AS files FROM files WHERE size_bytes > 0 GROUP BY 1, 2 HAVING count(*) > 1",
)
def hash_cascade(spark, sf_dir):
    root, listed = _written_documents(spark, sf_dir)
    same = audit.copies(audit.cascade(listed, CHUNK))
    name = F.substring("path", F.lit(len(root.removeprefix("file://")) + 2), F.length("path"))
    return same.groupBy("sha256", "size_bytes", "copies").agg(F.array_join(F.array_sort(F.collect_list(name)), ",").alias("files"))


@query(
    "a1_unreadable",
    f"WITH {R.FILES}, s AS (SELECT size_bytes FROM files GROUP BY 1 HAVING count(*) > 1) SELECT doc_id % 7 = 0 AS lost, count(*) AS files FROM documents WHERE strlen(text) > 0 AND strlen(text) IN (SELECT size_bytes FROM s) GROUP BY 1",
)
def unreadable(spark, sf_dir):
    """Files that are gone when they are opened come out beside the others, with the reason."""
    root, listed = _written_documents(spark, sf_dir)
    gone = F.regexp_extract("path", r"(\d+)\.[^/]*$", 1).cast("long") % 7 == 0
    moved = listed.withColumn("path", F.when(gone, F.concat("path", F.lit(".gone"))).otherwise(F.col("path")))
    return audit.cascade(moved, CHUNK).groupBy((F.col("error") == "FileNotFoundError").alias("lost")).agg(F.count("*").alias("files")).withColumn("lost", F.coalesce("lost", F.lit(False)))


@query("a15_page_range", "SELECT doc_id::INTEGER AS page, sha256(coalesce(text, '')) AS sha256 FROM documents WHERE doc_id >= 100")
def page_range(spark, sf_dir):
    """Documents written as page files; a range of pages is read, the files before it aren't opened."""
    d = R.table(spark, sf_dir, "documents")
    root = _folder(spark, "pages")
    named.write(d.select(F.concat(F.lit("pag-"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".txt")).alias("name"), "text"), root)
    return named.read(spark, root, first=100).select("page", F.sha2("text", 256).alias("sha256"))


@query("b8_export", "SELECT source || '/' || lang || '/' || doc_id || '.json' AS name, doc_id, coalesce(text, '') AS text FROM documents")
def export(spark, sf_dir):
    """Every document as a named JSON file, published together, and read back."""
    d = R.table(spark, sf_dir, "documents")
    root = _folder(spark, "export")
    name = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".json")))
    named.write(d.select(name.alias("name"), F.to_json(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text"))).alias("text")), root)
    read = named.read(spark, root).select("name", F.from_json("text", "doc_id long, text string").alias("j"))
    return read.select("name", "j.doc_id", "j.text")


@query("a8_overrides", "SELECT CAST(s_suppkey AS VARCHAR) AS page, unnest(['b1', 'b' || s_nationkey]) AS block FROM supplier WHERE s_suppkey % 3 > 0")
def overrides(spark, sf_dir):
    s = R.table(spark, sf_dir, "supplier")
    return readers.overrides(s.select(F.when(F.col("s_suppkey") % 3 > 0, F.concat(F.lit(" "), "s_suppkey", F.lit("\tb1 , b"), "s_nationkey", F.lit("\twhy"))).otherwise("no tab").alias("line")))


@query("a12_ready_pages", "SELECT CAST(s_suppkey AS INTEGER) AS pdf_page FROM supplier WHERE s_suppkey % 2 = 0 AND s_suppkey % 3 = 0")
def ready_pages(spark, sf_dir):
    s = R.table(spark, sf_dir, "supplier")
    state = lambda n: F.when(F.col("s_suppkey") % n == 0, "ok")
    path = _folder(spark, "progress")
    writers.table(s.select(F.col("s_suppkey").alias("pdf_page"), F.lit("ok").alias("ocr"), F.lit("ok").alias("trad"), F.lit(None).cast("string").alias("fondo"), state(2).alias("comp"), state(3).alias("v4"), F.lit(None).cast("string").alias("v5")), path)
    return gates.ready_pages(readers.progress(spark, path))


@query(
    "a16_project",
    "SELECT * FROM (VALUES ('fixed', 'Contents=Índice'), ('h1', '20.0'), ('h2', '12.5'), ('kept', 'ana,b,de,of,pozo,the,tier,ana b') , ('pairs', 'a/b/c/d'), ('slug', 'libro-es'), ('title', 'Uno (ES)'), ('source', 'x.pdf')) AS s(setting, value)",
)
def project(spark, sf_dir):
    p = readers.Project({"titulo": "Uno", "nombres_propios": ["Ana B", "Pozo de"], "reglas_extra": ["Tier queda en inglés, siempre", "Otra Regla"], "indice_fijos": {"Contents": "Índice"}, "foundry": {"h1": 20.0}, "recursos_pares": [["a", "b", "c", "d"]], "pdf_origen": "/in/x.pdf"})
    kept = sorted(p.kept_words - {"and"}) + sorted(p.whole_names & {"ana b"})
    rows = [("slug", p.slug), ("title", p.title), ("source", p.source.name), ("kept", ",".join(kept)), ("fixed", ",".join(f"{a}={b}" for a, b in p.fixed_titles.items())), ("h1", str(p.heading_sizes["h1"])), ("h2", str(p.heading_sizes["h2"])), ("pairs", "/".join(p.resource_pairs[0]))]
    return spark.createDataFrame(rows, "setting string, value string")


@query("b1_json_report", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def json_report(spark, sf_dir):
    path = _folder(spark, "report")
    writers.json_report(R.table(spark, sf_dir, "nation"), path)
    return spark.read.schema("n_nationkey int, n_name string, n_regionkey int").json(path)


@query("b1_json_text", "SELECT '{' || chr(10) || '  \"n_name\" : \"' || n_name || '\",' || chr(10) || '  \"n_nationkey\" : ' || n_nationkey || ',' || chr(10) || '  \"n_regionkey\" : ' || n_regionkey || chr(10) || '}' AS value FROM nation")
def json_text(spark, sf_dir):
    return writers.json_text(R.table(spark, sf_dir, "nation"))


@query("b2_pages", "SELECT n_regionkey AS page, CASE WHEN n_regionkey = 1 THEN 'new ' || n_name ELSE n_name END AS t FROM nation")
def pages(spark, sf_dir):
    n = R.table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("page"), F.col("n_name").alias("t"))
    path = _folder(spark, "by-page")
    writers.pages(n, path)
    writers.pages(n.filter("page = 1").withColumn("t", F.concat(F.lit("new "), "t")), path)
    return spark.read.json(path).select(F.col("page").cast("int").alias("page"), "t")


@query("b3_table", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name || ', \"x\"' AS n_name FROM nation")
def table(spark, sf_dir):
    path = _folder(spark, "table")
    writers.table(R.table(spark, sf_dir, "nation").select("n_nationkey", F.concat("n_name", F.lit(', "x"')).alias("n_name")), path)
    return spark.read.option("header", "true").option("escape", "\\").csv(path)


_STATUS = "SELECT o_orderstatus AS w, count(*) AS n FROM orders GROUP BY 1"
_PRIORITY = "SELECT o_orderpriority AS w, count(*) AS n FROM orders GROUP BY 1"


@query("b4_report", f"SELECT line FROM (SELECT '== status ==' AS line UNION ALL SELECT lpad(n::VARCHAR, greatest(4, length(n::VARCHAR))::INTEGER, ' ') || ' ' || w FROM ({_STATUS}) UNION ALL SELECT '== priority ==' UNION ALL SELECT lpad(n::VARCHAR, greatest(4, length(n::VARCHAR))::INTEGER, ' ') || ' ' || w FROM ({_PRIORITY}))")
def report(spark, sf_dir):
    o = R.table(spark, sf_dir, "orders")
    counts = lambda c: o.groupBy(F.col(c).alias("w")).agg(F.count("*").alias("n"))
    return writers.sectioned([("status", counts("o_orderstatus")), ("priority", counts("o_orderpriority"))], "n", "w")


@query("b5_defect_table", "SELECT CAST(o_custkey AS VARCHAR) AS page, CAST(o_orderkey AS VARCHAR) AS block, o_orderstatus AS kind, 'd ' || o_orderpriority AS detail FROM orders")
def defect_table(spark, sf_dir):
    o = R.table(spark, sf_dir, "orders")
    path = _folder(spark, "defects")
    writers.defects(o.select(F.col("o_custkey").alias("page"), F.col("o_orderkey").alias("block"), F.col("o_orderstatus").alias("kind"), F.concat(F.lit("d "), "o_orderpriority").alias("detail")), path)
    return spark.read.option("header", "true").option("sep", "\t").csv(path)


@query("b8_manifest", "SELECT * FROM (VALUES ('diarios', 'Libro — Diarios', 'JournalEntry'), ('actores', 'Libro — Bestiario', 'Actor'), ('tablas', 'Libro — Tablas', 'RollTable'), ('escenas', 'Libro — Mapas', 'Scene')) AS p(name, label, type)")
def manifest(spark, sf_dir):
    packs = writers.module_manifest("libro", "Libro", system="s5")["packs"]
    return spark.createDataFrame([(p["name"], p["label"], p["type"]) for p in packs if p["system"] == "s5"], "name string, label string, type string")
