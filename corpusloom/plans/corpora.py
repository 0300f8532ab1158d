"""Queries of corpus shaping: catalogue, verdicts, samples, candidates, journals, statistics and the translation slot."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import geometry as G
from ..functions import text as T
from ..operators import detectors, gates, pairs, shape, statblock, translate
from ..sources import readers, shared, writers
from . import relations as R
from .registry import query


@query("c4_catalogue", r"SELECT pdf_page, CASE WHEN pdf_page > 1 AND pdf_page < last THEN pdf_page - 1 END AS book_page, words, CASE WHEN pdf_page = 1 THEN 'portada' WHEN pdf_page = last THEN 'contraportada' WHEN words < 40 THEN 'arte?' WHEN words < 150 THEN 'escasa?' ELSE 'texto' END AS clase, '' AS notas, coalesce(url, '') AS jpg FROM (SELECT doc_id + 1 AS pdf_page, len(regexp_extract_all(text, '\S+')) AS words, (SELECT max(doc_id) + 1 FROM documents) AS last FROM documents) LEFT JOIN pages ON page_id + 1 = pdf_page")
def catalogue(spark, sf_dir):
    pages = R.table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("page"), "text")
    images = R.table(spark, sf_dir, "pages").select((F.col("page_id") + 1).alias("page"), F.col("url").alias("name"))
    return shape.catalogue(pages, images)


# a verdict for every source, from its documents as sampled pages
_SIGNALS = "SELECT source, n_chars % 3 > 0 AS fonts, n_chars // 6 AS words, n_chars % 2 = 0 AS noisy, n_chars % 5 > 0 AS single FROM documents"


_ADVICE = ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, t in zip(("fonts >= k * 0.7 AND texts < k * 0.5", "fonts >= k * 0.7 AND images >= k * 0.7", "noisy >= k * 0.3"), fixed.TRIAGE_ADVICE))


@query(
    "c6_verdict",
    f"SELECT k, fonts, texts, images, noisy, median_words, verdict, array_to_string(list_filter([{_ADVICE}], lambda x: x IS NOT NULL), '|') AS advice FROM (SELECT count(*) AS k, count(*) FILTER (fonts) AS fonts, count(*) FILTER (words > 40) AS texts, count(*) FILTER (single) AS images, count(*) FILTER (noisy) AS noisy, list_sort(list(words))[count(*) // 2 + 1] AS median_words, CASE WHEN count(*) FILTER (fonts) >= count(*) * 0.7 THEN 'DIGITAL' WHEN count(*) FILTER (words > 40) >= count(*) * 0.5 THEN 'HIBRIDO' ELSE 'ESCANEO' END AS verdict FROM ({_SIGNALS}))",
)
def verdict(spark, sf_dir):
    n = F.col("n_chars")
    s = R.table(spark, sf_dir, "documents").select((n % 3 > 0).alias("fonts"), F.floor(n / 6).alias("words"), (n % 2 == 0).alias("noisy"), (n % 5 > 0).alias("single_image"))
    return shape.verdict(s).withColumn("advice", F.array_join("advice", "|"))


@query("c6_page_signals", "SELECT doc_id AS page, w AS words, w > 40 AND n > w * 0.02 AS noisy FROM (SELECT doc_id, len(regexp_extract_all(text, '\\S+')) AS w, len(regexp_extract_all(text, '[|¬~^`]|[a-z]\\d[a-z]')) + len(list_filter(regexp_split_to_array(text, '[^\\p{L}\\p{N}_]+'), lambda x: regexp_matches(x, '^[Il1]{2,}$'))) AS n FROM (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN repeat('~ ', 20) || text ELSE text END AS text FROM documents))")
def page_signals(spark, sf_dir):
    d = R.table(spark, sf_dir, "documents")
    return shape.page_signals(d.select(F.col("doc_id").alias("page"), F.when(F.col("doc_id") % 4 == 0, F.concat(F.repeat(F.lit("~ "), F.lit(20)), "text")).otherwise(F.col("text")).alias("text")))


@query("c7_headings", "SELECT heading, count(*) AS n FROM (SELECT 'T ' || array_to_string(list_transform(regexp_extract_all(lower(o_orderpriority), '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || lower(w[2:])), '') AS heading FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1")
def headings(spark, sf_dir):
    o = R.table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderstatus") == "O", "h1").when(F.col("o_orderstatus") == "F", "titulo").otherwise("cuerpo")
    return shape.headings(o.select(kind.alias("type"), F.concat(F.lit(" A1: t "), "o_orderpriority", F.lit(" ")).alias("t")))


@query("g4_sample_pages", "SELECT doc_id AS page FROM documents, (SELECT count(*) AS n FROM documents) WHERE doc_id >= least(4, n) AND (doc_id - least(4, n)) % greatest(1, (n - least(4, n)) // 8) = 0 AND (doc_id - least(4, n)) // greatest(1, (n - least(4, n)) // 8) < 8")
def sample_pages(spark, sf_dir):
    pages = R.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"))
    return shape.sample_pages(pages, pages.count())


@query("a10_form_feed_pages", "SELECT doc_id, CAST(unnest(generate_series(1, len(string_split(text, chr(10))))) AS BIGINT) AS page, unnest(string_split(text, chr(10))) AS text FROM documents")
def form_feed_pages(spark, sf_dir):
    d = R.table(spark, sf_dir, "documents").select("doc_id", F.translate("text", "\n", "\f").alias("text"))
    return readers.form_feed_pages(d).withColumn("page", F.col("page").cast("long"))


@query("e14_name_words")
def name_words(spark, sf_dir):
    d = R.table(spark, sf_dir, "documents")
    return shape.name_words(d, "text", shape.name_runs(d, "text"))


@query("e14_name_runs")
def name_runs(spark, sf_dir):
    return shape.name_runs(R.table(spark, sf_dir, "documents"), "text")


@query("e14_word_counts", "SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS word FROM documents) GROUP BY 1 HAVING count(*) >= 5")
def word_counts(spark, sf_dir):
    w = R.table(spark, sf_dir, "documents").select(F.explode(T.find_all(F.lower("text"), "[a-z]{4,}")).alias("word"))
    return w.groupBy("word").agg(F.count("*").alias("n")).filter("n >= 5")


@query("g3_top_words", "SELECT word, n FROM (SELECT word, count(*) AS n, min(doc_id) AS first FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS word FROM documents) GROUP BY 1) ORDER BY n DESC, first, word LIMIT 40")
def top_words(spark, sf_dir):
    w = R.table(spark, sf_dir, "documents").select("doc_id", F.explode(T.find_all(F.lower("text"), "[a-z]{4,}")).alias("word"))
    n = w.groupBy("word").agg(F.count("*").alias("n"), F.struct(F.min("doc_id"), F.first("word")).alias("first"))
    return shape.top(n, "n", "first", 40).select("word", "n")


@query("d5_page_terms", "SELECT DISTINCT doc_id AS page, item_id FROM documents d, benchmark b WHERE contains(lower(d.text), lower(b.text)) OR contains(lower(d.text), lower(b.text[:-2])) OR contains(lower(d.text), lower(b.text[:-3]))")
def page_terms(spark, sf_dir):
    d = R.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), "text")
    g = R.table(spark, sf_dir, "benchmark").select(F.col("text").alias("en"), F.col("item_id").alias("es"))
    return shape.page_terms(d, g).select("page", F.col("es").alias("item_id"))


@query("j25_duplicate_terms", "SELECT text AS en, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_terms(spark, sf_dir):
    return shape.duplicate_terms(R.table(spark, sf_dir, "documents").select(F.col("text").alias("en")))


@query("j25_terms_not_in", "SELECT n_name AS en, n_name AS es FROM nation WHERE NOT contains('the nation of nation_1 and nation_20', lower(n_name))")
def terms_not_in(spark, sf_dir):
    g = R.table(spark, sf_dir, "nation").select(F.col("n_name").alias("en"), F.col("n_name").alias("es"))
    return shape.terms_not_in(g, "the nation of NATION_1 and nation_20").select("en", "es")


@query("g5_spot_check", "SELECT doc_id FROM documents ORDER BY sha256(CAST(doc_id AS VARCHAR)), doc_id LIMIT 20")
def spot_check(spark, sf_dir):
    return shape.spot_check(R.table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("f10_journal_pages", "SELECT conv_id, (p + 1) * 10 AS sort, coalesce(max(CASE WHEN h THEN text END), any_value('c' || conv_id))[:120] AS name, string_agg(CASE WHEN h THEN '<h1>' || text || '</h1>' ELSE text END, '' ORDER BY turn) AS content FROM (SELECT *, sum(CASE WHEN h AND rn > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS p FROM (SELECT *, role = 'user' AS h, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations)) GROUP BY conv_id, p")
def journal_pages(spark, sf_dir):
    c = R.table(spark, sf_dir, "conversations")
    pieces = c.select("conv_id", "turn", F.when(F.col("role") == "user", "h1").alias("level"), F.col("text").alias("html"), F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("name"))
    return shape.journal_pages(pieces, ["conv_id"], ["turn"])


@query("e20_bookmark_titles", "SELECT conv_id AS page, string_agg(trim(regexp_replace(replace(text, '*', ''), '\\s+', ' ', 'g')), ' ' ORDER BY turn) AS title FROM conversations WHERE role = 'user' AND text NOT IN ('', '~') GROUP BY 1")
def bookmark_titles(spark, sf_dir):
    c = R.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("page"), F.col("turn").alias("place"), F.when(F.col("role") == "user", "titulo").alias("type"), F.col("text").alias("t"))
    return shape.bookmark_titles(c)


@query("e16_first_seen", "SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lower(text) ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def first_seen(spark, sf_dir):
    return shape.first_seen(R.table(spark, sf_dir, "documents"), F.sha2(F.lower("text"), 256), ["doc_id"]).select("doc_id", "lang")


@query("e6_upper_median", "SELECT source, list_sort(list(n_chars))[count(*) // 2 + 1] AS middle FROM documents GROUP BY 1")
def upper_median(spark, sf_dir):
    return shape.upper_medians(R.table(spark, sf_dir, "documents"), ["source"], "n_chars")


@query("e6_median_of_all", "SELECT list_sort(list(l_extendedprice))[count(*) // 2 + 1] AS middle FROM lineitem")
def median_of_all(spark, sf_dir):
    return shape.upper_medians(R.table(spark, sf_dir, "lineitem").select("l_extendedprice"), [], "l_extendedprice")


@query("g7_nearest_forms", "WITH f AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-ZÁÉÍÓÚÑ][a-záéíóúüñ]*(?:\\s+[a-záéíóúüñ]+){0,2}')) AS form FROM documents), g AS (SELECT * FROM (VALUES ('a', 'el thonst'), ('b', 'la with'), ('c', 'zzzzzz'), ('d', 'uno ing')) AS g(en, es)), m AS (SELECT en, es, form, row_number() OVER (PARTITION BY en, es ORDER BY form) AS n FROM g JOIN f ON contains(lower(form), string_split(es, ' ')[-1][:6])) SELECT g.en, g.es, coalesce(string_agg(form, '|' ORDER BY form), '') AS forms FROM g LEFT JOIN m ON m.en = g.en AND n <= 4 GROUP BY 1, 2")
def nearest_forms(spark, sf_dir):
    g = spark.createDataFrame([("a", "el thonst"), ("b", "la with"), ("c", "zzzzzz"), ("d", "uno ing")], "en string, es string")
    return shape.nearest_forms(g, R.table(spark, sf_dir, "documents")).withColumn("forms", F.array_join("forms", "|"))


@query("e8_mode", "SELECT source, lang FROM (SELECT source, lang, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS n FROM documents GROUP BY 1, 2) WHERE n = 1")
def mode(spark, sf_dir):
    return shape.weighted_mode(R.table(spark, sf_dir, "documents"), ["source"], "lang", F.lit(1))


@query("e9_weighted_mode", "SELECT source, lang FROM (SELECT source, lang, row_number() OVER (PARTITION BY source ORDER BY sum(n_chars) DESC, lang) AS n FROM documents GROUP BY 1, 2) WHERE n = 1")
def weighted_mode(spark, sf_dir):
    return shape.weighted_mode(R.table(spark, sf_dir, "documents"), ["source"], "lang", F.col("n_chars"))


@query("h1_blocks_and_phrases", "SELECT doc_id AS page, 'b' AS block, text AS source FROM documents UNION ALL SELECT item_id, 't', text FROM benchmark")
def blocks_and_phrases(spark, sf_dir):
    row = lambda t, key, block: R.table(spark, sf_dir, t).select(F.col(key).alias("page"), F.lit(block).alias("block"), F.col("text").alias("source"))
    return pairs.blocks_and_phrases(row("documents", "doc_id", "b"), row("benchmark", "item_id", "t"))


@query("h6_redo_list", "SELECT doc_id FROM labels WHERE quality = 0 UNION SELECT doc_id FROM labels WHERE toxic = 1 UNION SELECT doc_id FROM documents WHERE n_chars < 20")
def redo_list(spark, sf_dir):
    l, d = R.table(spark, sf_dir, "labels"), R.table(spark, sf_dir, "documents")
    return gates.any_of([l.filter("quality = 0").select("doc_id"), l.filter("toxic = 1").select("doc_id"), d.filter("n_chars < 20").select("doc_id")])


@query("e18_last_page", "SELECT coalesce(max(o_custkey), 0) AS last, 0 AS none FROM orders")
def last_page(spark, sf_dir):
    o = R.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"))
    return gates.last_page(o).crossJoin(gates.last_page(o.filter("page < 0")).select(F.col("last").cast("int").alias("none")))  # single rows


@query("k11_all_or_nothing", "SELECT p_size AS grp, bool_and(p_partkey % 7 > 0 AND p_partkey % 11 > 0) AS accepted FROM part GROUP BY 1")
def all_or_nothing(spark, sf_dir):
    n = F.col("p_partkey")
    p = R.table(spark, sf_dir, "part").select(F.col("p_size").alias("grp"), F.concat(F.lit("label "), n.cast("string")).alias("text"), F.when(n % 7 == 0, None).when(n % 11 == 0, "rótulo 0x").otherwise(F.concat(F.lit("rótulo "), n.cast("string"))).alias("result"))
    return translate.all_or_nothing(p, "grp")


_SHORT = "CASE WHEN {t} * {s} <= 500 THEN {t} ELSE greatest({t} - 10, 1) END"
_ROUNDS = "t0 AS (SELECT p_partkey, p_size * 3 AS t, 9.5 AS s FROM part), t1 AS (SELECT p_partkey, " + _SHORT.format(t="t", s="s") + " AS t, s FROM t0), t2 AS (SELECT p_partkey, " + _SHORT.format(t="t", s="s") + " AS t, s FROM t1)"
for _i, _size in enumerate((8.5, 8.3, 8.2)):
    _now = f"t{2 + _i}" if not _i else f"a{_i}"
    if _i:
        _ROUNDS += f", a{_i} AS (SELECT p_partkey, {_SHORT.format(t='t', s='s')} AS t, s FROM t{2 + _i})"
    _ROUNDS += f", t{3 + _i} AS (SELECT p_partkey, t, CASE WHEN t * s <= 500 THEN s ELSE least(s, {_size}) END AS s FROM {_now})"


@query("k3_repair", f"WITH {_ROUNDS} SELECT p_partkey AS page, t AS length, CAST(s AS DOUBLE) AS size, t * s <= 500 AS fits FROM t5")
def repair(spark, sf_dir):
    blocks = R.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page"), F.lit("b").alias("block"), F.repeat(F.lit("x"), F.col("p_size") * 3).alias("t"), F.lit(9.5).alias("size"))
    fits = lambda df: df.withColumn("fits", F.length("t") * F.col("size") <= 500)
    shorten = lambda df: df.withColumn("result", F.substring("t", F.lit(1), F.greatest(F.length("t") - 10, F.lit(1))))
    return translate.repair(blocks, fits, shorten, ["term"], shared.written).select("page", F.length("t").alias("length"), "size", "fits")


@query("k5_postprocess", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Capítulo ' || p_size || ' | pie' WHEN 1 THEN '***Desarrollo.*** La trama de 1,900' ELSE '‹sc›l cuarto fragmento de‹/sc› la vara tan larga' END AS es, CASE WHEN p_partkey % 3 = 2 THEN 'E' END AS letter FROM part")
def postprocess(spark, sf_dir):
    pick = lambda *t: F.element_at(F.array(*[x if not isinstance(x, str) else F.lit(x) for x in t]), (F.col("p_partkey") % 3 + 1).cast("int"))
    rows = R.table(spark, sf_dir, "part").select("p_partkey", pick("footer", "cuerpo", "h1").alias("type"), pick(F.concat(F.lit("CHAPTER "), F.col("p_size").cast("string")), "Development. The plot", "x").alias("en"), pick(" Capítulo | pie ", "Desarrollo. La trama de 1.900", "El cuarto fragmento de la vara tan larga").alias("es"), pick(F.lit(None).cast("string"), F.lit(None).cast("string"), "T").alias("drop_cap"))
    return translate.postprocess(rows).select("p_partkey", "es", "letter")


_CHANNEL = "(l_partkey * 65537 % 16777216 >> {s}) & 255"
_CHANNELS = ", ".join(_CHANNEL.format(s=s) for s in (16, 8, 0))


@query("c14_heading_level", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN q <= 7 THEN 'footer' WHEN q >= 18 AND l_linenumber <= 3 THEN 'h1' WHEN caps AND greatest({_CHANNELS}) - least({_CHANNELS}) > 40 AND greatest({_CHANNELS}) > 90 AND q >= 11.6 THEN 'h1' WHEN caps AND q >= 10.5 THEN 'h2' ELSE 'cuerpo' END AS level FROM (SELECT *, l_quantity * 0.6 AS q, l_linenumber <= 2 AND l_returnflag <> 'A' AS caps FROM lineitem)")
def heading_level(spark, sf_dir):
    li = R.table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_returnflag") != "A", "HEADING *X*").otherwise("Heading")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shape.heading_level(text, F.col("l_quantity") * 0.6, (F.col("l_partkey") * 65537 % 16777216).cast("int"), F.col("l_linenumber")).alias("level"))


@query("i34_fraction", "SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 0.25 ELSE p_size::DOUBLE END AS value FROM part")
def fraction(spark, sf_dir):
    return R.table(spark, sf_dir, "part").select("p_partkey", statblock.fraction(F.when(F.col("p_size") % 4 == 0, "1/4").otherwise(F.col("p_size").cast("string"))).alias("value"))


@query("i35_roll_tables", "SELECT conv_id AS page, 'T' || conv_id AS name, '1d' || count(*) AS formula, count(*) AS results, sum(2)::BIGINT AS weight FROM conversations GROUP BY 1 HAVING count(*) >= 2")
def roll_tables(spark, sf_dir):
    row = F.concat(F.lit("**"), (F.col("turn") * 2 + 1).cast("string"), F.lit("-"), (F.col("turn") * 2 + 2).cast("string"), F.lit("** — x"))
    c = R.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.concat_ws("\n\n", F.array_sort(F.collect_list(row))).alias("rows"), F.count("*").alias("n"))
    t = c.select(F.col("conv_id").alias("page"), F.lit("b").alias("block"), F.concat(F.lit("*t"), F.col("conv_id").cast("string"), F.lit("*\n\n**d"), F.col("n").cast("string"), F.lit(" — **\n\n"), "rows").alias("t"))
    total = F.aggregate("results", F.lit(0).cast("long"), lambda s, r: s + r.getField("weight"))
    return statblock.roll_tables(t).select("page", "name", "formula", F.size("results").alias("results"), total.alias("weight"))


_FOUND = f"SELECT 'NUM' AS kind FROM live WHERE {R.decimals_sql('en')} <> {R.decimals_sql('es')} UNION ALL SELECT 'TOKEN' FROM live_swept WHERE regexp_matches(es, '‹[^›]{{0,24}}$|^[^‹]{{0,24}}›|«/|/»')"


@query("b5_defect_summary", f"WITH {R.PAIRS} SELECT kind, count(*) AS n FROM ({_FOUND}) GROUP BY 1")
def defect_summary(spark, sf_dir):
    p = R.pairs(spark, sf_dir)
    return writers.defect_summary(detectors.union([detectors.numbers(p), detectors.stray_tokens(p)]))


@query(
    "b8_journal_documents",
    "WITH j AS (SELECT conv_id, (p + 1) * 10 AS sort, coalesce(max(CASE WHEN h THEN text END), any_value('c' || conv_id))[:120] AS name FROM (SELECT *, sum(CASE WHEN h AND rn > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS p FROM (SELECT *, role = 'user' AS h, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations)) GROUP BY conv_id, p) "
    "SELECT conv_id, substring(sha256(conv_id::VARCHAR), 1, 16) AS id, '!journal!' || substring(sha256(conv_id::VARCHAR), 1, 16) AS key, 'Libro — ' || conv_id AS name, arg_min(name, sort) AS first_page, '!journal.pages!' || substring(sha256(conv_id::VARCHAR), 1, 16) || '.' || substring(sha256(conv_id || chr(31) || min(sort)::BIGINT), 1, 16) AS page_key, '10' AS sort FROM j GROUP BY conv_id",
)
def journal_documents(spark, sf_dir):
    of = lambda path: F.get_json_object("document", f"$.{path}")
    d = statblock.journal_document(journal_pages(spark, sf_dir), "conv_id", "Libro")
    return d.select("conv_id", "id", of("_key").alias("key"), of("name").alias("name"), of("pages[0].name").alias("first_page"), of("pages[0]._key").alias("page_key"), of("pages[0].sort").alias("sort"))


@query("n2_translate", "SELECT CAST(item_id AS VARCHAR) AS key, regexp_replace(regexp_replace(text, '(?i)\\bthat\\b', 'eso', 'g'), '(?i)\\bthe\\b', 'la', 'g') AS result FROM benchmark")
def translated(spark, sf_dir):
    rows = R.table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("key"), "text")
    return translate.request(rows, lambda: translate.GlossaryTranslator({"the": "la", "that": "eso"}))


@query("k5_with_cache", "SELECT DISTINCT text, CASE WHEN item_id % 2 = 0 THEN 'known' ELSE text END AS result FROM benchmark")
def with_cache(spark, sf_dir):
    b = R.table(spark, sf_dir, "benchmark")
    cache = b.filter("item_id % 2 = 0").select("text", F.lit("known").alias("result"))
    return translate.with_cache(b, cache, lambda: translate.GlossaryTranslator({}))


_ASKED = "regexp_replace(regexp_replace(coalesce(text, ''), '(?i)\\bthat\\b', 'eso', 'g'), '(?i)\\bthe\\b', 'la', 'g')"


@query("k5_store", f"SELECT sha256(t) AS source, sha256(r) AS result, r = r2 AS same FROM (SELECT DISTINCT coalesce(text, '') AS t, trim({_ASKED}) AS r, trim({_ASKED}) AS r2 FROM conversations) WHERE r <> ''")
def durable_answers(spark, sf_dir):
    """Every text of the conversations answered once; the second run, whose model can't answer, asks for nothing."""
    rows = R.table(spark, sf_dir, "conversations").select("text")
    store = shared.scratch(spark, "answers")
    first = translate.with_store(rows, store, lambda: translate.GlossaryTranslator({"the": "la", "that": "eso"}))
    again = translate.with_store(rows, store, lambda: None).select(F.col("text").alias("t"), F.col("result").alias("r"))
    both = first.join(again, F.col("text") == F.col("t")).filter("result IS NOT NULL")
    return both.select(F.sha2("text", 256).alias("source"), F.sha2("result", 256).alias("result"), (F.col("result") == F.col("r")).alias("same"))


@query("c18_open_options", "SELECT doc_id AS block, CASE WHEN text IS NULL THEN 'keep' ELSE 'replace with options' END AS action, sha256(text) AS text, CASE WHEN text IS NULL THEN 9.0 ELSE n_chars / 2.0 END AS size, CASE WHEN text IS NOT NULL THEN lang END AS language, CASE WHEN text IS NOT NULL THEN n_chars::INTEGER END AS second FROM documents WHERE text IS NULL OR trim(text) <> ''")
def open_options(spark, sf_dir):
    """Whole documents as control records with an option that nothing knows, of which inner values are read."""
    d = R.table(spark, sf_dir, "documents").filter("text IS NULL OR trim(text) <> ''")
    new = F.struct(F.col("lang").alias("idioma"), F.array(F.lit(1).cast("long"), F.col("n_chars")).alias("partes"))
    value = F.when(F.col("text").isNotNull(), F.to_json(F.struct(F.col("text").alias("t"), (F.col("n_chars") / 2).alias("size"), new.alias("nuevo"))))
    values = pairs.values(d.select(F.lit(1).alias("page"), F.col("doc_id").alias("block"), value.alias("value")))
    done = pairs.dispatch(values.withColumn("box", F.array(F.lit(0.0))).withColumn("size", F.lit(9.0)))
    return done.select("block", "action", F.sha2("t", 256).alias("text"), "size", pairs.option(F.col("record"), "$.nuevo.idioma", "string").alias("language"), pairs.option(F.col("record"), "$.nuevo.partes[1]", "int").alias("second"))


@query("b6_update_in_place", "SELECT client_id, CASE WHEN n IS NOT NULL THEN n ELSE city END AS city FROM clients LEFT JOIN (SELECT client_id AS c, max(city) AS n FROM client_changes WHERE city IS NOT NULL AND client_id IN (SELECT client_id FROM clients) GROUP BY 1) ON client_id = c WHERE client_id IS NOT NULL")
def keyed_update(spark, sf_dir):
    """The clients' table with the cities that changes name, only the touched buckets written anew."""
    clients = R.table(spark, sf_dir, "clients").filter("client_id IS NOT NULL").select("client_id", "city")
    path = shared.scratch(spark, "clients")
    gates.write_keyed(clients, path, "client_id")
    changes = R.table(spark, sf_dir, "client_changes").filter("city IS NOT NULL").select("client_id", "city").join(clients.select(F.col("client_id").alias("c")).distinct(), F.col("client_id") == F.col("c"), "left_semi")
    return gates.update_in_place(spark, path, changes, "client_id", "city", "client_id long, city string")


@query("i43_box_measures", f"WITH {R.BOXES} SELECT page, id, (x1 - x0) * (y1 - y0) AS area, (x0 + x1) / 2 AS cx FROM boxes")
def box_measures(spark, sf_dir):
    return R.boxes(spark, sf_dir).select("page", "id", G.area(F.col("box")).alias("area"), G.centre(F.col("box"))[0].alias("cx"))
