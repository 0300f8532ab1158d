"""Queries of the defect detectors, over lines and their damaged copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..operators import detectors as D
from ..operators import gates
from ..operators import pairs as P
from ..operators import rules
from . import relations as R
from .registry import query
from .texts import BAG

_STOP = "|".join(fixed.SWEEP_STOPWORDS)
#: A whole word for DuckDB, whose engine has no lookaround: one consumed character on either side.
_EDGE = r"[^\p{L}\p{N}_]"


def _add(name, detector, sql, *more):
    @query(name, f"WITH {R.PAIRS} {sql}")
    def run(spark, sf_dir):
        return detector(R.pairs(spark, sf_dir), *(m(spark, sf_dir) for m in more))

    return run


_HITS = rf"regexp_extract_all(es, '(?i)\b({_STOP})\b')"
_add("j1_untranslated", D.untranslated, rf"SELECT page, block, 'SIN-TRAD' AS kind, substring(en, 1, 70) AS detail FROM swept WHERE (es IS NULL OR trim(es) = '') AND (length(en) > 24 OR regexp_matches(en, '(?i)\b({_STOP})\b'))")
_add(
    "j2_english_sweep",
    D.english_sweep,
    f"SELECT page, block, 'INGLES' AS kind, {R.shown_sql('list_sort(list_distinct(list_transform(h, lambda x: lower(x))))')} || ' → ' || substring(es, 1, 60) AS detail FROM (SELECT *, {_HITS} AS h FROM live_swept) WHERE len(h) >= 2",
)
_add("j3_numbers_sweep", D.numbers_sweep, f"SELECT page, block, 'NUMEROS' AS kind, {R.shown_sql('a')} || ' vs ' || {R.shown_sql('b')} AS detail FROM (SELECT *, {R.digits_sql('en')} AS a, {R.digits_sql('es')} AS b FROM live_swept) WHERE a <> b")
_add("j4_stray_tokens", D.stray_tokens, "SELECT page, block, 'TOKEN' AS kind, substring(es, 1, 60) AS detail FROM live_swept WHERE regexp_matches(es, '‹[^›]{0,24}$|^[^‹]{0,24}›|«/|/»')")
_add("j7_numbers", D.numbers, f"SELECT page, block, 'NUM' AS kind, 'EN' || {R.shown_sql('a')} || ' vs ES' || {R.shown_sql('b')} AS detail FROM (SELECT *, {R.decimals_sql('en')} AS a, {R.decimals_sql('es')} AS b FROM live) WHERE a <> b")
_BALANCE = "list_reduce(list_transform(regexp_extract_all(es, '[*]{1,3}'), lambda x: CASE length(x) WHEN 3 THEN 3 WHEN 2 THEN 1 ELSE 2 END), lambda a, b: xor(a, b), 0)"
_add(
    "j8_markup",
    D.markup,
    f"SELECT page, block, 'MARCADO' AS kind, 'stars: ' || substring(es, 1, 60) AS detail FROM live WHERE coalesce({_BALANCE}, 0) <> 0 UNION ALL SELECT page, block, 'MARCADO', 'tokens: ' || substring(es, 1, 60) FROM live WHERE length(regexp_replace(es, '[^‹]', '', 'g')) - len(regexp_extract_all(es, '‹/')) <> len(regexp_extract_all(es, '‹/'))",
)
_add(
    "j9_length_ratio",
    D.length_ratio,
    f"SELECT page, block, kind, b || '/' || a || ' chars: ' || substring(es, 1, 60) AS detail FROM (SELECT *, CASE WHEN b < a * 0.45 THEN 'CORTO' WHEN b > a * 2.0 THEN 'LARGO' END AS kind FROM (SELECT *, length({R.norm_sql('en')}) AS a, length({R.norm_sql('es')}) AS b FROM live) WHERE a >= 60) WHERE kind IS NOT NULL",
)
_WORDS = "[" + ", ".join(f"'{w}'" for w in sorted(set(fixed.CONSISTENCY_STOPWORDS) - set(fixed.KEPT_WORDS))) + "]"
_add("j10_english_words", D.english_words, f"SELECT page, block, 'INGLES' AS kind, {R.shown_sql('h')} || ' → ' || substring(es, 1, 60) AS detail FROM (SELECT *, list_sort(list_intersect(list_distinct(regexp_extract_all({R.norm_sql('es')}, '[a-z'']+')), {_WORDS})) AS h FROM live) WHERE len(h) > 0")
_add(
    "j12_divergent",
    D.divergent,
    f"""SELECT s[1].page AS page, s[1].block AS block, 'DIVERGE' AS kind, substring(source, 1, 40) || ' → ' || array_to_string(list_transform(s, lambda x: 'p' || x.page || ':' || x.block || '=' || substring(x.es, 1, 40)), ' | ') AS detail
    FROM (SELECT source, (list_sort(list(f)))[1:4] AS s FROM (SELECT source, target, min({{'page': page, 'block': block, 'es': es}}) AS f FROM (SELECT page, block, {R.norm_sql('en')} AS source, {R.norm_sql('es')} AS target, es FROM live) WHERE length(source) >= 12 GROUP BY 1, 2) GROUP BY 1 HAVING count(*) > 1)""",
)


def _false_friend_sql() -> str:
    # words of these lists are plain ASCII in texts without accents, so ASCII word borders are right
    case = ", ".join(f"CASE WHEN regexp_matches(a, '\\b{w}\\b') AND regexp_matches(b, '\\b{c}\\w*\\b') THEN '{w} → «{c}» (¿{g}?)' END" for w, c, g in fixed.FALSE_FRIENDS if c.isascii())
    return f"SELECT page, block, 'FALSO-AMIGO' AS kind, h AS detail FROM (SELECT page, block, unnest([{case}]) AS h FROM (SELECT page, block, {_sense('en')} AS a, {_sense('es')} AS b FROM live)) WHERE h IS NOT NULL"


def _sense(c: str) -> str:
    return f"lower(strip_accents(replace(regexp_replace({c}, '‹[^›]*›', '', 'g'), '*', '')))"


def _spiced(sql: str) -> str:
    """Pairs with words of the sense checks put in, by the number of the block."""
    return f"""WITH {R.PAIRS.replace("live AS (SELECT * FROM pairs", "spiced AS (SELECT page, block, " + _spice_sql("en", _SPICE_EN) + " AS en, " + _spice_sql("es", _SPICE_ES) + " AS es FROM pairs), live AS (SELECT * FROM spiced")} {sql}"""


_SPICE_EN = ("actually a large library", "unless you never", "restrained and hidden", "once per long rest", "hope hope fear")
_SPICE_ES = ("actualmente un largo edificio", "quiere", "ocultos", "siempre", "esperanza")


def _spice_sql(column: str, words) -> str:
    return f"{column} || CASE block % 5 " + " ".join(f"WHEN {i} THEN ' {w}'" for i, w in enumerate(words)) + " END"


def spiced(spark, sf_dir):
    p = R.pairs(spark, sf_dir)
    pick = lambda words: F.element_at(F.array(*[F.lit(" " + w) for w in words]), (F.col("block") % 5 + 1).cast("int"))
    return p.withColumn("en", F.concat("en", pick(_SPICE_EN))).withColumn("es", F.concat("es", pick(_SPICE_ES)))


def _sense_query(name, detector, sql):
    @query(name, _spiced(sql))
    def run(spark, sf_dir):
        return detector(spiced(spark, sf_dir))


_sense_query("j13_false_friends", D.false_friends, _false_friend_sql())
_sense_query(
    "j14_lost_negation",
    D.lost_negation,
    rf"SELECT page, block, 'NEGACION' AS kind, substring(en, 1, 55) || ' → ' || substring(es, 1, 55) AS detail FROM live WHERE regexp_matches(' ' || en || ' ', '(?i){_EDGE}(unless|can(?:no|'')t|cannot|never|no longer|without|neither|nor|doesn''t|don''t|won''t|isn''t|aren''t){_EDGE}') AND NOT regexp_matches(' ' || es || ' ', '(?i){_EDGE}(a menos que|no|nunca|jamás|sin|ni|salvo que|deja de|dejan de|ya no|tampoco|excepto){_EDGE}') AND length({_sense('es')}) > 30",
)


def _condition_sql() -> str:
    parts = []
    for name, own in fixed.CONDITIONS:
        others = "[" + ", ".join(f"CASE WHEN contains(b, '{t}') THEN '{t}' END" for n, t in fixed.CONDITIONS if n != name) + "]"
        first = f"list_filter({others}, lambda x: x IS NOT NULL)"
        parts.append(f"CASE WHEN regexp_matches(a, '\\b{name}\\b') AND NOT contains(b, '{own}') AND len({first}) > 0 THEN '«{name}» → «' || {first}[1] || '»' END")
    return f"SELECT page, block, 'CONDICION' AS kind, h AS detail FROM (SELECT page, block, unnest([{', '.join(parts)}]) AS h FROM (SELECT page, block, {_sense('en')} AS a, {_sense('es')} AS b FROM live)) WHERE h IS NOT NULL"


_sense_query("j15_wrong_condition", D.wrong_condition, _condition_sql())
_sense_query(
    "j16_lost_frequency",
    D.lost_frequency,
    "SELECT page, block, 'FRECUENCIA' AS kind, '«' || h || '» ausente' AS detail FROM (SELECT page, block, unnest(["
    + ", ".join(f"CASE WHEN regexp_matches(a, '{p}') AND NOT regexp_matches(b, '{w}') THEN '{name}' END" for p, name, w in fixed.FREQUENCIES)
    + f"]) AS h FROM (SELECT page, block, {_sense('en')} AS a, {_sense('es')} AS b FROM live)) WHERE h IS NOT NULL",
)
_count = lambda c, w: f"len(regexp_extract_all({c}, '{w}'))"
_sense_query(
    "j17_resource_counts",
    D.resource_counts,
    f"SELECT page, block, 'RECURSO' AS kind, 'EN ' || na || '/' || nb || ' vs ES ' || ma || '/' || mb AS detail FROM (SELECT page, block, {_count('a', 'hope')} AS na, {_count('a', 'fear')} AS nb, {_count('b', 'esperanza')} AS ma, {_count('b', 'miedo')} AS mb FROM (SELECT page, block, {_sense('en')} AS a, {_sense('es')} AS b FROM live)) WHERE na + nb > 0 AND abs(na - ma) + abs(nb - mb) >= 2",
)


def _pages(spark, sf_dir):
    """Documents of a source as the page, its neighbour in the conversation table as the translation: turns in pairs."""
    c = R.table(spark, sf_dir, "conversations")
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("page"), F.col("text").alias("en"), F.lead("text").over(w).alias("es")).filter("es is not null")


_PAGES = "pages_ AS (SELECT conv_id * 1000 + turn AS page, text AS en, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS es FROM conversations), two AS (SELECT * FROM pages_ WHERE es IS NOT NULL)"
_PAGE_WORDS = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(fixed.PAGE_STOPWORDS))) + "]"


@query("j18_page_english", f"WITH {_PAGES}, w AS (SELECT page, unnest(regexp_extract_all(lower(es), '[a-zA-Z'']{{3,}}')) AS word FROM two), k AS (SELECT page, word, count(*) AS n FROM w WHERE list_contains({_PAGE_WORDS}, word) AND word NOT IN ('with', 'there') GROUP BY 1, 2) SELECT page, word, n FROM k WHERE page IN (SELECT page FROM k GROUP BY 1 HAVING sum(n) > 1) AND page % 5 > 0")
def page_english(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    return D.page_english(pages, pages.filter("page % 5 = 0").select("page"), ("with", "there"))


@query(
    "j19_page_numbers",
    f"WITH {_PAGES}, s AS (SELECT page, unnest({BAG.replace('COLUMN', 'en')}) AS number, 1 AS a, 0 AS b FROM two UNION ALL SELECT page, unnest({BAG.replace('COLUMN', 'es')}), 0, 1 FROM two) SELECT page, number, greatest(sum(a) - sum(b), 0)::BIGINT AS only_en, greatest(sum(b) - sum(a), 0)::BIGINT AS only_es FROM s GROUP BY 1, 2 HAVING sum(a) <> sum(b)",
)
def page_numbers(spark, sf_dir):
    return D.page_numbers(_pages(spark, sf_dir))


@query("j22_page_signs", f"WITH {_PAGES} SELECT page, kind FROM (SELECT page, unnest([CASE WHEN length(es) - length(replace(es, '?', '')) > length(es) - length(replace(es, '¿', '')) + 1 THEN 'question marks' END, CASE WHEN regexp_matches(es, '[ÃÂ�]') THEN 'mojibake' END]) AS kind FROM two) WHERE kind IS NOT NULL")
def page_signs(spark, sf_dir):
    return D.page_signs(_pages(spark, sf_dir))


@query("j21_overflow", "SELECT l_orderkey AS page, array_to_string(list_sort(list(CAST(l_linenumber AS VARCHAR))), ',') AS blocks FROM lineitem WHERE l_quantity > 45 GROUP BY 1")
def overflow(spark, sf_dir):
    fit = R.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("string").alias("block"), (F.col("l_quantity") <= 45).alias("fits"))
    return D.overflow(fit).withColumn("blocks", F.array_join("blocks", ","))


_GLOSSARY = (("the", "la"), ("The Shre", "El Ser (mayor)"), ("La", "La casa"), ("Erthing", "Erthing"), ("and onesen", "y ones"), ("Thonst", "Tierra Santa"))


def _glossary(spark, sf_dir=None):
    return spark.createDataFrame(list(_GLOSSARY), "en string, es string")


#: The sweep also has terms of two common words, which lines do hold.
_SWEPT = (*_GLOSSARY, ("of the", "propio de"), ("by the", "junto a"), ("with the", "with tal"))
_GLOSSARY_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _SWEPT) + ") AS g(term, target)"


@query(
    "j5_glossary_sweep",
    f"""WITH {R.PAIRS} SELECT page, block, 'GLOSARIO' AS kind, term || ' → falta «' || core || '»' AS detail FROM (SELECT page, block, es, term, trim(string_split(target, '(')[1]) AS core FROM live_swept, {_GLOSSARY_SQL}
    WHERE term <> target AND length(term) > 3 AND (contains(term, ' ') OR regexp_matches(term, '^\\p{{Lu}}')) AND regexp_matches(en, '(^|[^A-Za-z])' || term || '($|[^a-z])'))
    WHERE NOT contains(lower(es), lower(term)) AND len(list_filter(regexp_split_to_array(lower(core), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: length(w) > 3 AND NOT contains(lower(es), w))) > 0""",
)
def glossary_sweep(spark, sf_dir):
    return D.glossary_sweep(R.pairs(spark, sf_dir), spark.createDataFrame(list(_SWEPT), "en string, es string"))


@query(
    "j11_lost_names",
    f"""WITH {R.PAIRS} SELECT page, block, 'PERDIDO' AS kind, '[' || string_agg(word, ',' ORDER BY word) || ']' AS detail FROM (SELECT DISTINCT page, block, es, unnest(regexp_extract_all(' ' || replace(regexp_replace(en, '‹[^›]*›', '', 'g'), ' ', '  ') || ' ', '[^\\p{{L}}\\p{{N}}_]([A-Z][a-z]{{3,}})[^\\p{{L}}\\p{{N}}_]', 1)) AS word FROM live WHERE length({R.norm_sql('en')}) >= 40)
    WHERE lower(word) IN ('erthing') AND NOT contains({R.norm_sql('es')}, lower(word)) GROUP BY 1, 2""",
)
def lost_names(spark, sf_dir):
    return D.lost_names(R.pairs(spark, sf_dir), D.kept_names(_glossary(spark)))


@query(
    "j20_page_glossary",
    f"""WITH {R.PAIRS} SELECT page, block, term, target FROM live, (VALUES ('and onesen', 'ones'), ('erthing', 'erthing'), ('the shre', 'ser'), ('thonst', 'santa')) AS g(term, target)
    WHERE regexp_matches(' ' || lower(en) || ' ', '{_EDGE}' || term || '{_EDGE}') AND NOT contains(strip_accents(lower(es)), target)""",
)
def page_glossary(spark, sf_dir):
    pages = D.translated(R.pairs(spark, sf_dir)).select(F.struct("page", "block").alias("page"), "en", "es")
    glossary = _glossary(spark).withColumn("es", F.when(F.col("en") == "The Shre", "El Ser").otherwise(F.col("es"))).filter("length(en) >= 5")
    return D.page_glossary(pages, glossary).select("page.page", "page.block", "term", "target")


#: A phrase for each style rule, and the rules that it breaks, by their place.
_PHRASES = (
    ("salpicándote a todos", (0, 1)), ("salpicándose a ustedes", (1,)), ("eso hace sentido", (2,)), ("aplica para eso", (3,)), ("eventualmente va", (4,)), ("actualmente va, no hoy", (5,)),
    ("realizan que va", (6,)), ("asumir eso", (7,)), ("soporta eso", (8,)), ("en orden de ir", (9,)), ("ser capaz de ir", (10,)), ("tú tienes eso", (11,)),
    ("cerca de el lago", (12,)), ("va a el lago", (13,)), ("a  b", (14,)), ("puntos de vida", (15,)), ("un chequeo", (16,)), ("tirada de salvado", (17,)),
    ("daño de golpeo", (18,)), ("Maestro de la mazmorra", (19,)), ("un hechizo", (20,)), ("acaba.Empieza", (21,)), ("qué?va", (22,)), ("el Reading", (23,)),
    ("soporta mucho peso", ()), ("a el llegó", ()),
)


@query("j23_style_signals", "SELECT p_partkey AS page, kind, 'x ' || phrase || ' y' AS detail FROM part JOIN (VALUES " + ", ".join(f"({i}, '{p}', '{fixed.STYLE_SIGNALS[k][1]}')" for i, (p, broken) in enumerate(_PHRASES) for k in broken) + f") AS s(i, phrase, kind) ON p_partkey % {len(_PHRASES)} = i")
def style_signals(spark, sf_dir):
    phrase = F.element_at(F.array(*[F.lit(p) for p, _ in _PHRASES]), (F.col("p_partkey") % len(_PHRASES) + 1).cast("int"))
    t = R.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page"), F.lit("b").alias("block"), F.concat(F.lit("x "), phrase, F.lit(" y")).alias("es"))
    return D.style_signals(t).select("page", "kind", "detail")


@query("j23_style_contexts")
def style_contexts(spark, sf_dir):
    return D.style_signals(R.pairs(spark, sf_dir))


@query("l3_range_words", f"SELECT p_partkey AS page, 'RANGO' AS kind, CASE p_partkey % 4 WHEN 1 THEN '[cuerpo a cuerpo,muy lejos] vs [cuerpo a cuerpo,lejos]' ELSE '[muy cerca] vs []' END AS detail FROM part WHERE p_partkey % 4 IN (1, 3)")
def range_words(spark, sf_dir):
    pick = lambda *t: F.element_at(F.array(*[F.lit(x) for x in t]), (F.col("p_partkey") % 4 + 1).cast("int"))
    p = R.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page"), F.lit("b").alias("block"), pick("Melee, then Very Far", "Melee, then Very Far", "no reach", "Very Close").alias("en"), pick("Cuerpo a cuerpo, luego muy lejos", "Cuerpo a cuerpo, luego lejos", "sin alcance cerca", "nada").alias("es"))
    return D.range_words(p).select("page", "kind", "detail")


@query("l1_orphans", f"WITH {R.LINES} SELECT page, block FROM lines WHERE block % 3 > 0 AND block % 5 > 0")
def orphans(spark, sf_dir):
    n = R.lines(spark, sf_dir).select("page", "block")
    return D.orphans(n, n.filter("block % 3 = 0"), n.filter("block % 5 = 0"))


@query("l4_canonical_versions", "SELECT l_partkey AS source, t AS target FROM (SELECT l_partkey, l_returnflag || l_linestatus AS t, row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_returnflag || l_linestatus) AS n FROM lineitem) WHERE n = 1")
def canonical_versions(spark, sf_dir):
    li = R.table(spark, sf_dir, "lineitem")
    return D.canonical_versions(li.select(F.col("l_partkey").alias("source"), F.concat("l_returnflag", "l_linestatus").alias("target"), F.col("l_linenumber").alias("priority")))


@query(
    "l6_repeated_neighbours",
    f"WITH {R.PAIRS}, o AS (SELECT page, block, en, CASE WHEN block % 4 = 1 THEN en || ' ' || lag(en) OVER w || ' ' || lead(en) OVER w ELSE en END AS es FROM lines WINDOW w AS (PARTITION BY page ORDER BY block)), n AS (SELECT *, lag(es) OVER w AS before, lead(es) OVER w AS after FROM o WINDOW w AS (PARTITION BY page ORDER BY block)) SELECT page, block FROM n WHERE es IS NOT NULL AND trim(es) <> '' AND es <> '~' AND length({R.norm_sql('en')}) >= 60 AND length({R.norm_sql('es')}) > length({R.norm_sql('en')}) * 2.0 AND ((length(before) > 0 AND contains(es, before)) OR (length(after) > 0 AND contains(es, after)))",
)
def repeated_neighbours(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("page").orderBy("block")
    n = R.lines(spark, sf_dir)
    doubled = F.concat(F.col("en"), F.lit(" "), F.lag("en").over(w), F.lit(" "), F.lead("en").over(w))
    return D.repeated_neighbours(n.withColumn("es", F.when(F.col("block") % 4 == 1, doubled).otherwise(F.col("en"))))


@query(
    "j6_gate_defect",
    "WITH n AS (SELECT n_nationkey + 1 AS page FROM nation) SELECT 0::BIGINT AS page, '-' AS block, 'VALIDACION' AS kind, 'missing ' || (SELECT count(*) FROM n WHERE page > 12) || ' pages: ' || (SELECT string_agg(page::VARCHAR, ',' ORDER BY page) FROM (SELECT page FROM n WHERE page > 12 ORDER BY page LIMIT 8)) AS detail",
)
def gate_defect(spark, sf_dir):
    pages = R.table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1).alias("page"))
    open_ = gates.gate(pages, spark.createDataFrame([("# cobertura: 1-12",)], "line string"))
    passed = gates.gate(pages, spark.createDataFrame([("# cobertura: 1-25",)], "line string"))
    return gates.gate_defect(open_).unionByName(gates.gate_defect(passed))


@query("k9_glossary_misses", "SELECT p_partkey, 't' || p_size AS term, CASE WHEN p_size % 2 = 0 THEN 'es ' || p_size ELSE 't' || p_size END AS wanted, 'r' || p_size AS target FROM part")
def glossary_misses(spark, sf_dir):
    p = R.table(spark, sf_dir, "part")
    z = F.col("p_size").cast("string")
    line = F.concat(F.lit("✗ glosario: «t"), z, F.lit("» sin «r"), z, F.lit("»; x"))
    glossary = p.filter("p_size % 2 = 0").select(F.concat(F.lit(" T"), z).alias("en"), F.concat(F.lit("es "), z, F.lit(" (nota)")).alias("es")).distinct()
    found = gates.shared_misses(p.select(line.alias("line")), glossary).groupBy("term", "wanted", "target").agg(F.count("*").alias("n"))
    return p.select("p_partkey", F.concat(F.lit("t"), z).alias("t")).join(found, F.col("t") == F.col("term")).select("p_partkey", "term", "wanted", "target")


@query("k6_apply_once", f"WITH {R.LINES} SELECT page, block, CASE WHEN contains(en, 'the!') THEN en ELSE replace(en, 'the', 'the!') END AS text FROM lines")
def apply_once(spark, sf_dir):
    once = rules.apply_once(F.col("en"), "the", "the!")
    return R.lines(spark, sf_dir).select("page", "block", rules.apply_once(once, "the", "the!").alias("text"))


@query("k7_allow_numbers", "WITH f AS (SELECT o_custkey, bool_and(o_orderstatus <> 'F') AS alone FROM orders GROUP BY 1) SELECT coalesce(c_custkey, o_custkey) AS page, array_to_string(list_filter([CASE WHEN c_custkey IS NOT NULL THEN 'nota=' || c_mktsegment END, CASE WHEN alone THEN 'numeros_ok=true' END], lambda x: x IS NOT NULL), ',') AS flags FROM (SELECT * FROM customer WHERE c_custkey % 3 = 0) FULL JOIN (SELECT * FROM f WHERE alone) ON c_custkey = o_custkey")
def allow_numbers(spark, sf_dir):
    fails = R.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"), F.when(F.col("o_orderstatus") != "F", "numbers").otherwise("glossary").alias("kind"))
    old = R.table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("page"), F.create_map(F.lit("nota"), F.col("c_mktsegment")).alias("flags"))
    return gates.allow_numbers(fails, old).select("page", F.array_join(F.transform(F.array_sort(F.map_entries("flags")), lambda e: F.concat_ws("=", e.getField("key"), e.getField("value"))), ",").alias("flags"))


@query("b7_merge_overrides", "SELECT c_custkey, 'a=1,b=' || CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || ',c=3' ELSE '2' END AS flags FROM customer")
def merge_overrides(spark, sf_dir):
    old = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))
    new = F.when(F.col("c_custkey") % 2 == 0, F.create_map(F.lit("b"), F.col("c_mktsegment"), F.lit("c"), F.lit("3"))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    merged = gates.merge_overrides(old, new)
    return R.table(spark, sf_dir, "customer").select("c_custkey", F.array_join(F.transform(F.array_sort(F.map_entries(merged)), lambda e: F.concat_ws("=", e.getField("key"), e.getField("value"))), ",").alias("flags"))


@query("d13_missing_keys", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)")
def missing_keys(spark, sf_dir):
    returned = R.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderkey") % 3 == 0, "x").when(F.col("o_orderkey") % 3 == 1, " ").alias("t"))
    return P.missing_keys(R.table(spark, sf_dir, "customer").select("c_custkey"), returned, "c_custkey")


@query(
    "j26_misaligned",
    f"""WITH {_PAGES}, t AS (SELECT page, page % 3 = 0 AS foot, CASE WHEN page % 3 = 0 THEN 'CHAPTER ' || page || ' ' || en ELSE en END AS en, CASE WHEN page % 6 = 0 THEN 'Capítulo ' || page || ' ' || es ELSE es END AS es FROM two)
    SELECT page, array_to_string(list_filter(r, lambda x: x IS NOT NULL), ',') AS reasons FROM (SELECT page, [CASE WHEN len(p) >= 2 AND len(list_filter(p, lambda x: contains(lower(strip_accents(es)), strip_accents(x)))) = 0 THEN 'names' END,
    CASE WHEN trim(es) = trim(en) OR (length(es) > 60 AND len(regexp_extract_all(es, '\\b(the|and|with|from|that|this|are|you|is|of|for)\\b')) >= 4) THEN 'english' END, CASE WHEN foot AND NOT contains(es, '' || page) THEN 'chapter' END] AS r
    FROM (SELECT *, list_distinct(list_transform(regexp_extract_all(' ' || en, '[^\\p{{L}}\\p{{N}}_]([A-Z][a-záéíóúñ]{{3}})', 1), lambda x: lower(x))) AS p FROM t)) WHERE len(list_filter(r, lambda x: x IS NOT NULL)) > 0""",
)
def misaligned(spark, sf_dir):
    foot, number = F.col("page") % 3 == 0, F.col("page").cast("string")
    p = _pages(spark, sf_dir).withColumn("block", F.lit("b")).withColumn("type", F.when(foot, "footer").otherwise("cuerpo"))
    p = p.withColumn("en", F.when(foot, F.concat(F.lit("CHAPTER "), number, F.lit(" "), "en")).otherwise(F.col("en"))).withColumn("es", F.when(F.col("page") % 6 == 0, F.concat(F.lit("Capítulo "), number, F.lit(" "), "es")).otherwise(F.col("es")))
    return D.misaligned(p).select("page", F.array_join("reasons", ",").alias("reasons"))


@query("j27_revision_guard", f"WITH {R.PAIRS} SELECT page, block, trim(es) <> '' AND {R.digits_sql('en')} = {R.digits_sql('es')} AND len(regexp_extract_all(en, '\\*\\*')) = len(regexp_extract_all(es, '\\*\\*')) AND len(regexp_extract_all(en, '‹sc›')) = len(regexp_extract_all(es, '‹sc›')) AND length(es) / greatest(1, length(en)) BETWEEN 0.75 AND 1.3 AS accepted FROM live")
def revision_guard(spark, sf_dir):
    return D.translated(R.pairs(spark, sf_dir)).select("page", "block", D.revision_accepted(F.col("en"), F.col("es")).alias("accepted"))


@query("j28_shortening_guard", f"WITH {R.PAIRS} SELECT page, block, trim(es) <> '' AND {R.digits_sql('en')} = {R.digits_sql('es')} AND len(list_filter(['thonst', 'erthing', 'that'], lambda t: contains(lower(en), t) AND NOT contains(lower(es), t))) = 0 AS accepted FROM live")
def shortening_guard(spark, sf_dir):
    terms = F.array(*[F.lit(t) for t in ("thonst", "erthing", "that")])
    return D.translated(R.pairs(spark, sf_dir)).select("page", "block", D.shortening_accepted(F.col("en"), F.col("es"), terms).alias("accepted"))


@query("j29_page_sizes", "SELECT c.o_orderkey AS page FROM orders c JOIN orders o ON c.o_custkey = o.o_orderkey WHERE abs(c.o_totalprice - o.o_totalprice) > 2")
def page_sizes(spark, sf_dir):
    o = R.table(spark, sf_dir, "orders")
    original = o.select(F.col("o_orderkey").alias("page"), F.col("o_custkey").alias("of"), F.col("o_totalprice").alias("width"), F.lit(1.0).alias("height"))
    other = o.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("w"))
    composed = original.join(other, F.col("of") == F.col("k")).select("page", F.col("w").alias("width"), F.lit(1.0).alias("height"))
    return D.page_sizes(composed, original.drop("of")).select("page")


_SEGMENT = "|".join(w for w in fixed.SEGMENT_STOPWORDS if w.isalpha())


@query("j31_segmentation_guard", rf"WITH {R.PAIRS}, n AS (SELECT page, block, regexp_extract_all(en, '\d+d\d+|\d+') AS w, regexp_extract_all(es, '\d+d\d+|\d+') AS h, len(regexp_extract_all(regexp_replace(' ' || es || ' ', '({_EDGE})', '\1\1', 'g'), '{_EDGE}({_SEGMENT}){_EDGE}')) AS e FROM live) SELECT page, block, len(list_filter(w, lambda x: NOT list_contains(h, x))) <= greatest(1, floor(len(w) / 12)) AND e < 3 AS accepted FROM n")
def segmentation_guard(spark, sf_dir):
    return D.translated(R.pairs(spark, sf_dir)).select("page", "block", D.segmentation_accepted(F.col("en"), F.col("es")).alias("accepted"))


@query("d14_overrides", f"WITH {R.PAIRS} SELECT page, block FROM live WHERE NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = page AND quality = block)")
def overrides(spark, sf_dir):
    o = R.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page"), F.col("quality").cast("long").alias("block"))
    return P.without(D.translated(R.pairs(spark, sf_dir)), o).select("page", "block")


@query("e4_defect_counts", f"WITH {R.PAIRS} SELECT kind, count(*) AS n FROM (SELECT 'NUM' AS kind FROM live WHERE {R.decimals_sql('en')} <> {R.decimals_sql('es')} UNION ALL SELECT 'MARCADO' FROM live WHERE coalesce({_BALANCE}, 0) <> 0) GROUP BY 1")
def defect_counts(spark, sf_dir):
    p = R.pairs(spark, sf_dir)
    return D.union([D.numbers(p), D.markup(p)]).groupBy("kind").agg(F.count("*").alias("n"))


_RULES = [(r"\bthe\b", "THE", ""), (r"THE (\w+)", r"\1 THE", ""), (r"  +", " ", ""), (r"zzzz", "y", "")]


@query("k1_rewrite", rf"WITH {R.LINES}, r AS (SELECT page, block, en, regexp_replace(regexp_replace(regexp_replace(en, '\bthe\b', 'THE', 'g'), 'THE ([\p{{L}}\p{{N}}_]+)', '\1 THE', 'g'), '  +', ' ', 'g') AS t FROM lines) SELECT page, block, t AS en, t <> en AS changed FROM r")
def rewrite(spark, sf_dir):
    return rules.apply(R.lines(spark, sf_dir), "en", _RULES).select("page", "block", "en", "changed")


@query("e13_rule_hits", rf"WITH {R.LINES}, a AS (SELECT en, regexp_replace(en, '\bthe\b', 'THE', 'g') AS a FROM lines), b AS (SELECT *, regexp_replace(a, 'THE ([\p{{L}}\p{{N}}_]+)', '\1 THE', 'g') AS b FROM a), c AS (SELECT *, regexp_replace(b, '  +', ' ', 'g') AS c FROM b) SELECT unnest(['\bthe\b', 'THE (\w+)', '  +', 'zzzz']) AS pattern, unnest([count(*) FILTER (a <> en), count(*) FILTER (b <> a), count(*) FILTER (c <> b), 0]) AS rows FROM c")
def rule_hits(spark, sf_dir):
    return rules.hits(R.lines(spark, sf_dir), "en", _RULES)


def _balance(c: str) -> str:
    return _BALANCE.replace("(es,", f"({c},")


_LEAD = r"^(\*{1,3})([^*]{2,60}?[.:])(\*{1,3})"
_PART = lambda c, i: f"regexp_extract({c}, '{_LEAD}', {i})"


@query(
    "k2_repair_markup",
    f"""WITH {R.PAIRS}, l AS (SELECT page, block, CASE WHEN block % 3 = 0 THEN '***Name.*** ' || en ELSE en END AS en, CASE WHEN block % 3 = 0 THEN '**Nombre.** ' || es ELSE es END AS es FROM live),
    a AS (SELECT page, block, es, CASE WHEN {_PART('en', 0)} <> '' AND {_PART('es', 0)} <> '' AND ({_PART('en', 1)} <> {_PART('es', 1)} OR {_PART('en', 3)} <> {_PART('es', 3)}) THEN {_PART('en', 1)} || {_PART('es', 2)} || {_PART('en', 3)} || substring(es, length({_PART('es', 0)}) + 1) ELSE es END AS m FROM l),
    r AS (SELECT page, block, es, m, coalesce({_BALANCE}, 0) AS s, coalesce({_balance('m')}, 0) AS t FROM a),
    c AS (SELECT page, block, es, s, CASE t WHEN 0 THEN m ELSE rtrim(m) || CASE t WHEN 3 THEN '***' WHEN 1 THEN '**' ELSE '*' END END AS f FROM r)
    SELECT page, block, CASE WHEN s = 0 OR coalesce({_balance('f')}, 0) <> 0 THEN es ELSE f END AS es FROM c""",
)
def repair_markup(spark, sf_dir):
    led = F.col("block") % 3 == 0
    p = D.translated(R.pairs(spark, sf_dir))
    p = p.withColumn("en", F.when(led, F.concat(F.lit("***Name.*** "), "en")).otherwise(F.col("en"))).withColumn("es", F.when(led, F.concat(F.lit("**Nombre.** "), "es")).otherwise(F.col("es")))
    return p.select("page", "block", F.coalesce(T.repair_markup(F.col("en"), F.col("es")), F.col("es")).alias("es"))
