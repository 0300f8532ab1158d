"""Queries of functions on texts that are made so that the right result is known.

By the number of a part, a row gets one of some source and target texts, in SQL that Spark and DuckDB read alike; the
oracle has the result that each case must give.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as T
from ..operators import detectors as D
from ..operators import folds, pairs, shape, statblock
from ..sources import readers
from . import relations as R
from .registry import query


def choice(parts: list[str], key: str = "p_partkey") -> str:
    """One of some SQL expressions, by the remainder of a key."""
    return f"CASE {key} % {len(parts)} " + " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(parts)) + " END"


def cases(name: str, make, *found: tuple[str, ...]) -> None:
    """Register a query: ``make`` takes the inputs of each case, of which the last part is the result."""

    @query(name, f"SELECT p_partkey, {choice([c[-1] for c in found])} AS value FROM part")
    def run(spark, sf_dir):
        inputs = [F.expr(choice([c[i] for c in found])) for i in range(len(found[0]) - 1)]
        rows = R.dealt_table(spark, sf_dir, "part").select("p_partkey", *[c.alias(f"c{i}") for i, c in enumerate(inputs)])
        return rows.select("p_partkey", make(*[F.col(f"c{i}") for i in range(len(inputs))]).alias("value"))


_BREAK = "chr(10) || chr(10)"

# markup and tokens
cases(
    "i11_normal_tokens",
    T.normal_tokens,
    ("'«sc»A' || p_size || '«/sc» <c:FF00aa>b</c>'", "'‹sc›A' || p_size || '‹/sc› ‹c:ff00aa›b‹/c›'"),
    ("'« c : FF00AA »b' || p_size", "'‹c:ff00aa›b' || p_size"),
    ("'plain ' || p_name", "'plain ' || p_name"),
)
cases(
    "i13_small_caps_heading",
    T.small_caps_heading,
    ("'‹sc›Believer ' || p_size || '‹/sc›'", "'«creyente ' || p_size || '»'", "'‹sc›Creyente ' || p_size || '‹/sc›'"),
    ("'Believer'", "'creyente ' || p_size", "'creyente ' || p_size"),
    ("'‹sc›low‹/sc›'", "'Bajo ' || p_size", "'‹sc›Bajo ' || p_size || '‹/sc›'"),
)
_STORM = "'‹sc›Storm‹/sc› ‹sc›Strike.‹/sc› When you hit someone'"
cases(
    "i13_small_caps_run_in",
    T.small_caps_run_in,
    (_STORM, "'Golpe de la tormenta. Cuando golpeas ' || p_size", "'‹sc›Golpe de la tormenta.‹/sc› Cuando golpeas ' || p_size"),
    (_STORM, "'‹sc›Golpe‹/sc› de la tormenta ' || p_size", "'‹sc›Golpe‹/sc› de la tormenta ' || p_size"),
    ("'Storm strike'", "'Golpe ' || p_size", "'Golpe ' || p_size"),
)
cases("j30_small_caps_kept", T.small_caps_kept, ("'‹sc›A'", "'b'", "false"), ("'‹sc›A'", "'‹sc›b'", "true"), ("'A'", "'b'", "true"))
cases(
    "k2_align_run_in",
    T.align_run_in,
    ("'***Name.*** text'", "'**Nombre.** texto ' || p_size", "'***Nombre.*** texto ' || p_size"),
    ("'**Name:** text'", "'*Nombre:* texto ' || p_size", "'**Nombre:** texto ' || p_size"),
    ("'Name. text'", "'**Nombre.** texto ' || p_size", "'**Nombre.** texto ' || p_size"),
)
cases(
    "i17_break_lists",
    T.break_lists,
    ("'**Clase** ' || p_size || ' **Puntos** 30'", f"'**Clase** ' || p_size || {_BREAK} || '**Puntos** 30'"),
    ("'[ ] Uno [] Dos [ ]Tres ' || p_size", f"{_BREAK} || '[ ] Uno' || {_BREAK} || '[ ] Dos' || {_BREAK} || '[ ] Tres ' || p_size"),
    ("'**Clase** ' || p_size", "'**Clase** ' || p_size"),
)
cases(
    "i9_html_page",
    T.html_page,
    (f"'• x' || p_size || {_BREAK} || '***y***'", "'<p class=\"bullet\">• x' || p_size || '</p><p><b><i>y</i></b></p>'"),
    ("'a & **b** *c* &nbsp; ' || p_size", "'<p>a &amp; <b>b</b> <i>c</i> &nbsp; ' || p_size || '</p>'"),
    ("'‹sc›k‹/sc> <' || p_size", "'<p><span class=\"sc\">k‹/sc&gt; &lt;' || p_size || '</p>'"),
)
cases(
    "i9_html_digital",
    T.html_digital,
    ("'‹c:ff0000›a' || p_size || '‹/c› ‹sc rest'", "'<p><span style=\"color:#ff0000\">a' || p_size || '</span></p>'"),
    ("'**b** *i* ‹g›' || p_size || '‹/g›'", "'<p><b>b</b> <i>i</i> <span style=\"font-size:1.35em\">' || p_size || '</span></p>'"),
    ("'**Uno.** a. **Dos:** b' || p_size", "'<p><b>Uno.</b> a.</p><p><b>Dos:</b> b' || p_size || '</p>'"),
    ("'Fuerza +1 Destreza +2 Saber +' || p_size || ' Fin'", "'<p>Fuerza +1</p><p>Destreza +2</p><p>Saber +' || p_size || '</p><p>Fin</p>'"),
)
cases(
    "i14_unwrap_longest",
    T.unwrap_answer,
    ("'{\"a\": \"short\", \"b\": \"a longer text here ' || p_size || '\"}'", "'a longer text here ' || p_size"),
    ("'{\"traduccion\": \"hola ' || p_size || '\"}'", "'hola ' || p_size"),
    ("'{plain}' || p_size", "'{plain}' || p_size"),
)

# repairs of translations
cases(
    "d15_align_damage",
    T.align_damage,
    ("p_size || ' fire damage and ' || p_size || ' cold damage'", "p_size || ' de daño por fuego y ' || p_size || ' de daño frío'", "p_size || ' de daño de fuego y ' || p_size || ' de daño de frío'"),
    ("p_size || ' poison damage'", "'daño x1 y daño que ' || p_size", "'daño x1 y daño que ' || p_size"),
    ("'no types ' || p_size", "'daño raro ' || p_size", "'daño raro ' || p_size"),
)
cases(
    "d16_mark_run_ins",
    T.mark_run_ins,
    ("'Development. The plot'", "'Desarrollo. La trama ' || p_size", "'***Desarrollo.*** La trama ' || p_size"),
    (f"'Treasure. The chest.' || {_BREAK} || 'plain text'", f"'Tesoro. El cofre.' || {_BREAK} || 'Texto. Llano ' || p_size", f"'***Tesoro.*** El cofre.' || {_BREAK} || 'Texto. Llano ' || p_size"),
    ("'Alpha. The A'", f"'Alfa. La A' || {_BREAK} || 'Beta. La B ' || p_size", f"'***Alfa.*** La A' || {_BREAK} || 'Beta. La B ' || p_size"),
)
cases(
    "i7_drop_cap",
    lambda c: T.let(T.drop_cap(c), lambda d: F.concat_ws("|", d.getField("letter"), d.getField("text"))),
    ("'El cuarto fragmento de la vara ' || p_size", "'E|‹sc›l cuarto fragmento de‹/sc› la vara ' || p_size"),
    ("'Una *vara* ' || p_size", "'U|‹sc›na‹/sc› *vara* ' || p_size"),
)
cases(
    "i51_restore_chapter",
    T.restore_chapter,
    ("'CHAPTER ' || p_size || ' | x'", "'Capítulo | pie'", "'Capítulo ' || p_size || ' | pie'"),
    ("'CHAPTER ' || p_size", "'Capítulo ' || p_size", "'Capítulo ' || p_size"),
    ("'chapter ' || p_size", "'pie'", "'Capítulo ' || p_size"),
    ("'none'", "'pie'", "'pie'"),
)
cases(
    "i15_same_as_source",
    T.same_as_source,
    ("'A b! ' || p_name", "'a, B ' || p_name", "true"),
    ("'«sc»Uno«/sc» ' || p_size", "'‹sc›uno‹/sc›'", "true"),
    ("'uno ' || p_size", "'dos ' || p_size", "false"),
)
cases("l5_stem_present", D.stem_present, ("'la Torméntica ' || p_size", "'tormenta'", "true"), ("'exito'", "'Éxito ' || p_size", "true"), ("'palo ' || p_size", "'Vara'", "false"))
cases(
    "j31_segmentation_cases",
    D.segmentation_accepted,
    ("'1 2d6 ' || p_size", "p_size || ' 2d6 1'", "true"),
    ("'101 102 103 104'", "'x' || p_size", "false"),
    ("'' || p_size", "'the and with ' || p_size", "false"),
    ("'101 ' || p_size", "'' || p_size", "true"),
)
cases(
    "k9_overflow_ids",
    lambda c: F.array_join(T.overflow_ids(c), ","),
    ("'✗ overflow: [' || chr(39) || 'b01' || chr(39) || ', ' || chr(39) || 'b' || p_size || chr(39) || '] x'", "'b01,b' || p_size"),
    ("'✓ p' || p_size", "''"),
)

# stat blocks
_PANEL = (
    "'GOBLIN BOSS' || chr(10) || 'Small humanoid (goblinoid), neutral evil' || chr(10) || 'Armor Class: ' || p_size || ' (natural armor)' || chr(10) || 'Hit Points ' || p_partkey || ' (6d6 + 3)' || chr(10)"
    " || 'Speed 30 ft., fly ' || p_size || ' ft.' || chr(10) || 'STR DEX CON INT WIS CHA' || chr(10) || '10 (+0) 14 (+2) 10 (+0) 10 (+0) 8 (-1) ' || p_size || ' (+0)' || chr(10) || 'Skills Stealth +' || p_size || chr(10)"
    " || 'Senses darkvision 60 ft.' || chr(10) || 'Languages Common, Goblin' || chr(10) || 'Challenge 1/4 (50 XP)' || chr(10) || 'Nimble escape text long enough ACTIONS Scimitar. Melee attack with reach ' || p_size || ' REACTIONS Parry. The boss adds two'"
)
_NO_PANEL = "'plain text number ' || p_size"
cases("i30_kind_line", statblock.kind_line, (_PANEL, "'Small humanoid (goblinoid), neutral evil'"), (_NO_PANEL, "''"))
cases("i30_defence_lines", lambda c: F.array_join(statblock.defence_lines(c), "|"), (_PANEL, "'**Clase de Armadura** ' || p_size || ' (armadura natural)|**Puntos de golpe** ' || p_partkey || ' (6d6+3)|**Velocidad** 30 pies, volar ' || p_size || ' pies'"), (_NO_PANEL, "''"))
cases(
    "i30_abilities",
    lambda c: F.array_join(F.transform(statblock.abilities(c), lambda a: F.concat_ws("=", a.getField("k"), a.getField("v"))), ","),
    (_PANEL, "'FUE=10 (+0),DES=14 (+2),CON=10 (+0),INT=10 (+0),SAB=8 (−1),CAR=' || p_size || ' (+0)'"),
    (_NO_PANEL, "CAST(NULL AS STRING)"),
)
cases("i30_labelled_lines", lambda c: F.array_join(statblock.labelled_lines(c), "|"), (_PANEL, "'**Habilidades** Sigilo +' || p_size || '|**Sentidos** visión en la oscuridad 60 pies|**Idiomas** común, goblin|**Desafío** 1/4 (50 PX)'"), (_NO_PANEL, "''"))
cases("i31_remainder", lambda c: statblock.remainder(c, F.lit("GOBLIN BOSS")), (_PANEL, "'Nimble escape text long enough ACTIONS Scimitar. Melee attack with reach ' || p_size || ' REACTIONS Parry. The boss adds two'"), (_NO_PANEL, _NO_PANEL))
cases(
    "i32_sections",
    lambda c: F.array_join(F.transform(statblock.sections(statblock.remainder(c, F.lit("GOBLIN BOSS"))), lambda s: F.concat_ws(":", s.getField("section"), s.getField("text"))), "|"),
    (_PANEL, "'traits:Nimble escape text long enough|actions:Scimitar. Melee attack with reach ' || p_size || '|reactions:Parry. The boss adds two'"),
    (_NO_PANEL, "'traits:plain text number ' || p_size"),
)
cases(
    "i33_subline",
    statblock.subline,
    ("'Constructo mediano, Malvado legal ' || p_size", "'Autómata Mediano, legal malvado ' || p_size"),
    ("'Leyal Bueno ' || p_size", "'legal bueno ' || p_size"),
    ("'Humanoide ' || p_size || ' Típicamente Neutral.'", "'Humanoide ' || p_size || ' típicamente neutral'"),
)
_PARTS = "array<struct<h:string,t:string,table:array<struct<k:string,v:string>>>>"


def _panels(spark, sf_dir):
    """A panel for each part; every fifth has the name of the one before, every seventh none."""
    p = R.table(spark, sf_dir, "part").select("p_partkey", "p_size")
    number = (F.col("p_partkey") - F.when(F.col("p_partkey") % 5 == 0, 1).otherwise(0)).cast("string")
    fields = F.concat(F.lit("**Clase de Armadura** "), "p_size", F.lit("\n\n**Puntos de golpe** "), "p_partkey", F.lit(" (6d6)\n\n**Velocidad** 30 pies, volar "), "p_size", F.lit(" pies\n\n**Desafío** 1/4 (50 PX)"))
    none = F.lit(None).cast("string")
    table = F.array(F.struct(F.lit("FUE").alias("k"), F.concat(F.col("p_size").cast("string"), F.lit(" (+0)")).alias("v")))
    parts = F.array(F.struct(none.alias("h"), fields.alias("t"), F.lit(None).cast("array<struct<k:string,v:string>>").alias("table")), F.struct(none.alias("h"), none.alias("t"), table.alias("table")), F.struct(F.lit("ACCIONES").alias("h"), F.concat(F.lit("***Golpe.*** Pega *"), "p_size", F.lit("*.")).alias("t"), F.lit(None).cast("array<struct<k:string,v:string>>").alias("table")))
    title = F.when(F.col("p_partkey") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("JEFE "), number))
    return p.select(F.col("p_partkey").alias("page"), F.lit(0).cast("long").alias("place"), title.alias("title"), F.concat(F.lit("*tipo "), "p_size", F.lit("*")).alias("sub"), parts.cast(_PARTS).alias("parts"))


_NAMED = "SELECT *, p_partkey - CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS number FROM part WHERE p_partkey % 7 <> 0"
_ACTORS = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY number ORDER BY p_partkey) AS n FROM ({_NAMED})) WHERE n = 1"


@query(
    "i34_actors",
    f"SELECT p_partkey AS page, 'Jefe ' || number AS name, p_size AS ac, p_partkey AS hp, '6d6' AS formula, CAST(0.25 AS DOUBLE) AS cr, 'fly=' || p_size || ',walk=30' AS movement, 'str=' || p_size AS abilities, 'Golpe: <p><em>(acción)</em></p><p>Pega <em>' || p_size || '</em>.</p>' AS items, 'tipo ' || p_size AS kind, 'jefe-' || number || '.json' AS file, substring(sha256('jefe ' || number), 1, 16) AS id FROM ({_ACTORS})",
)
def actors(spark, sf_dir):
    shown = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws("=", e.getField("key"), e.getField("value"))), ",")
    items = F.array_join(F.transform("items", lambda i: F.concat_ws(": ", i.getField("name"), i.getField("html"))), ",")
    return statblock.actors(_panels(spark, sf_dir)).select("page", "name", "ac", F.col("hp").cast("long").alias("hp"), "formula", "cr", shown(F.col("movement")).alias("movement"), shown(F.col("abilities")).alias("abilities"), items.alias("items"), "kind", "file", "id")


@query("i10_panel_html", "SELECT p_partkey AS page, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE '<h3>JEFE ' || (p_partkey - CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END) || '</h3>' END || '<p><em>tipo ' || p_size || '</em></p><table><tr><td style=''text-align:center''><b>FUE</b><br>' || p_size || ' (+0)</td></tr></table><h4>ACCIONES</h4><p><strong><em>Golpe.</em></strong> Pega <em>' || p_size || '</em>.</p>' AS html FROM part")
def panel_html(spark, sf_dir):
    return _panels(spark, sf_dir).select("page", statblock.panel_html(F.col("title"), F.col("sub"), F.slice("parts", 2, 2)).alias("html"))


@query(
    "b8_actor_documents",
    f"SELECT 'jefe-' || number || '.json' AS file, substring(sha256('jefe ' || number), 1, 16) AS id, 'npc' AS type, CAST(p_partkey AS VARCHAR) AS hp, '30' AS walk, CAST(p_size AS VARCHAR) AS strength, 'Golpe' AS item, 'tipo ' || p_size AS kind, 'Jefe ' || number AS token, '0' AS owner FROM ({_ACTORS})",
)
def actor_documents(spark, sf_dir):
    d = statblock.actor_document(statblock.actors(_panels(spark, sf_dir)))
    of = lambda path: F.get_json_object("document", f"$.{path}")
    return d.select("file", of("_id").alias("id"), of("type").alias("type"), of("system.attributes.hp.max").alias("hp"), of("system.attributes.movement.walk").alias("walk"), of("system.abilities.str.value").alias("strength"), of("items[0].name").alias("item"), of("system.details.type.custom").alias("kind"), of("prototypeToken.name").alias("token"), of("ownership.default").alias("owner"))


@query("b8_table_documents", "SELECT p_partkey AS page, 'Libro — Tesoros ' || p_size AS name, '1d6' AS formula, '[1,4]' AS first_range, '4' AS weight, 'Nada' AS last_text, 'false' AS drawn FROM part WHERE p_partkey % 3 > 0")
def table_documents(spark, sf_dir):
    p = R.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page"), F.lit("b").alias("block"), F.concat(F.lit("*tesoros "), "p_size", F.lit("*\n\n**d6 — x**\n\n**1-4** — *Oro*"), F.when(F.col("p_partkey") % 3 > 0, "\n\n**5** — Nada").otherwise("")).alias("t"))
    of = lambda path: F.get_json_object("document", f"$.{path}")
    return statblock.table_document(statblock.roll_tables(p), "Libro").select("page", of("name").alias("name"), of("formula").alias("formula"), of("results[0].range").alias("first_range"), of("results[0].weight").alias("weight"), of("results[1].text").alias("last_text"), of("results[0].drawn").alias("drawn"))


@query("b8_scene_documents", "SELECT n_nationkey AS page, 'Libro — ' || n_name AS name, 'modules/libro/assets/mapa-' || n_nationkey || '.webp' AS src, CAST(n_regionkey * 100 AS VARCHAR) AS width, '5' AS distance FROM nation")
def scene_documents(spark, sf_dir):
    n = R.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("page"), F.col("n_name").alias("name"), (F.col("n_regionkey") * 100).alias("width"), F.lit(50).alias("height"))
    of = lambda path: F.get_json_object("document", f"$.{path}")
    return statblock.scene_document(n, "Libro", "libro").select("page", of("name").alias("name"), of("background.src").alias("src"), of("width").alias("width"), of("grid.distance").alias("distance"))


@query("b8_handouts", "SELECT 'Libro — Láminas y handouts' AS name, '900' AS sort, to_json(list('Lámina p' || n_nationkey ORDER BY n_nationkey))::VARCHAR AS pages FROM nation")
def handouts(spark, sf_dir):
    n = R.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("page"))
    of = lambda path: F.get_json_object("document", f"$.{path}")
    return statblock.handout_document(n, "Libro", "libro").select(of("name").alias("name"), of("sort").alias("sort"), of("pages[*].name").alias("pages"))


@query("glossary_html", "SELECT '<table><tr><th>EN</th><th>ES</th></tr>' || string_agg('<tr><td>' || p_name || ' &amp; ' || p_size || '</td><td>' || p_type || '</td></tr>', '' ORDER BY p_name || ' & ' || p_size, p_type) || '</table>' AS html FROM part")
def glossary_html(spark, sf_dir):
    p = R.table(spark, sf_dir, "part")
    return statblock.glossary_html(p.select(F.concat("p_name", F.lit(" & "), F.col("p_size").cast("string")).alias("en"), F.col("p_type").alias("es")))


@query("i37_entries", f"SELECT p_partkey, '***Golpe.*** pega ' || p_size || CASE WHEN p_partkey % 2 = 0 THEN {_BREAK} || '***Mordisco.*** muerde' ELSE '' END AS value FROM part")
def entries(spark, sf_dir):
    none = F.lit(None).cast("string")
    e = lambda n, t: F.struct(F.lit(n).alias("n"), t.alias("t"))
    listed = F.array(e("Golpe..", F.concat(F.lit("pega "), F.col("p_size").cast("string"))), e("Nada", none), e("Vacío", F.lit("")), e("Mordisco", F.when(F.col("p_partkey") % 2 == 0, "muerde")))
    return R.table(spark, sf_dir, "part").select("p_partkey", statblock.entries_text(listed).alias("value"))


@query("i39_styled_text", "SELECT p_partkey, '**a' || p_size || '** *b* ‹sc›***c***‹/sc› ‹c:0000ff›d‹/c› ' || CASE WHEN p_partkey % 2 = 0 THEN '‹g›e‹/g›' ELSE 'e' END AS text FROM part")
def styled_text(spark, sf_dir):
    def span(place, text, bold=False, italic=False, font="Serif", color=0, size=F.lit(10.0)):
        return F.struct(F.lit(place).alias("place"), text.alias("text"), F.lit(bold).alias("bold"), F.lit(italic).alias("italic"), F.lit(font).alias("font"), F.lit(color).alias("color"), size.alias("size"))

    spans = F.array(
        span(0, F.concat(F.lit(" a"), F.col("p_size").cast("string")), bold=True),
        span(1, F.lit("b"), italic=True),
        span(2, F.lit("c "), True, True, "Serif-SC"),
        span(3, F.lit("d"), color=255),
        span(4, F.lit("e"), size=F.when(F.col("p_partkey") % 2 == 0, F.lit(14.0)).otherwise(F.lit(13.0))),
        span(5, F.lit("  "), color=99),
    )
    each = R.dealt_table(spark, sf_dir, "part").select("p_partkey", F.explode(spans).alias("s")).select("p_partkey", "s.*")
    return shape.styled_text(each, ["p_partkey"])


# values of translations

_VALUE = ["NULL", "'\"~\"'", "'\"hola ' || p_size || '\"'", "'{\"t\": \"x\", \"size\": 8.0, \"caja\": [1, 2, 3, ' || p_size || ']}'", "'null'", "'\"\"'"]


@query(
    "c18_dispatch",
    "SELECT p_size AS page, CAST(p_partkey AS VARCHAR) AS block, "
    + "CASE WHEN p_partkey % 7 = 6 THEN 'keep' ELSE CASE p_partkey % 6 WHEN 1 THEN 'erase' WHEN 2 THEN 'replace' WHEN 3 THEN 'replace with options' ELSE 'keep' END END AS action, "
    + "CAST(CASE WHEN p_partkey % 7 < 6 AND p_partkey % 6 = 3 THEN 8.0 ELSE 9.0 END AS DOUBLE) AS size, CASE WHEN p_partkey % 7 < 6 AND p_partkey % 6 = 3 THEN '1.0,2.0,3.0,' || p_size || '.0' ELSE '0.0' END AS box, p_name AS source FROM part",
)
def dispatch(spark, sf_dir):
    p = R.table(spark, sf_dir, "part").withColumn("page", F.col("p_size")).withColumn("block", F.col("p_partkey").cast("string"))
    values = pairs.values(p.filter("p_partkey % 7 <> 6").select("page", "block", F.expr(choice(_VALUE)).alias("value")))
    both = pairs.joined(p.select("page", "block", F.col("p_name").alias("source")), values, how="left")
    done = pairs.dispatch(both.withColumn("box", F.array(F.lit(0.0))).withColumn("size", F.lit(9.0)))
    return done.select("page", "block", "action", "size", F.array_join(F.transform("box", lambda x: x.cast("string")), ",").alias("box"), "source")


@query("d1_pairs", "SELECT p_size AS page, CAST(p_partkey AS VARCHAR) AS block, p_name AS source, CASE p_partkey % 6 WHEN 0 THEN 'keep' WHEN 1 THEN 'erase' WHEN 3 THEN 'control' WHEN 4 THEN 'keep' ELSE 'text' END AS kind, CASE p_partkey % 6 WHEN 1 THEN '~' WHEN 2 THEN 'hola ' || p_size WHEN 3 THEN 'x' WHEN 5 THEN '' END AS t FROM part WHERE p_partkey % 7 <> 6 AND p_partkey % 11 <> 0")
def translated_pairs(spark, sf_dir):
    p = R.table(spark, sf_dir, "part").withColumn("page", F.col("p_size")).withColumn("block", F.col("p_partkey").cast("string"))
    values = pairs.values(p.filter("p_partkey % 7 <> 6").select("page", "block", F.expr(choice(_VALUE)).alias("value")))
    left_out = p.filter("p_partkey % 11 = 0").select(F.col("page").cast("string").alias("page"), "block")
    return pairs.joined(p.select("page", "block", F.col("p_name").alias("source")), values, left_out).select("page", "block", "source", "kind", "t")


@query("d2_absent_blocks", "SELECT p_size AS page, CAST(p_partkey AS VARCHAR) AS block FROM part WHERE p_partkey % 7 = 6")
def absent(spark, sf_dir):
    p = R.table(spark, sf_dir, "part").withColumn("page", F.col("p_size")).withColumn("block", F.col("p_partkey").cast("string"))
    values = pairs.values(p.filter("p_partkey % 7 <> 6").select("page", "block", F.expr(choice(_VALUE)).alias("value")))
    return pairs.joined(p.select("page", "block", F.col("p_name").alias("source")), values, how="left").filter("kind is null").select("page", "block")


@query("k8_cap_size", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size AS DOUBLE) WHEN p_partkey % 4 = 1 THEN 8.5 WHEN p_size < 8.5 THEN p_size ELSE 8.5 END AS size FROM part")
def cap_size(spark, sf_dir):
    p = R.table(spark, sf_dir, "part")
    size = F.when(F.col("p_partkey") % 4 != 1, F.col("p_size").cast("double"))
    return p.select("p_partkey", F.struct(size.alias("size")).alias("opts"), F.when(F.col("p_partkey") % 4 == 0, F.lit("~")).otherwise(F.lit("x")).alias("t")).select("p_partkey", pairs.cap_size(F.col("opts"), F.col("t"), 8.5).alias("size"))


@query("g8_first_fitting", "SELECT p_partkey, CASE WHEN 9 * p_size <= 200 THEN 9 WHEN 8 * p_size <= 200 THEN 8 ELSE 7 END AS size FROM part")
def first_fitting(spark, sf_dir):
    return R.table(spark, sf_dir, "part").select("p_partkey", folds.first_fitting(F.array(F.lit(9), F.lit(8), F.lit(7)), lambda s: s * F.col("p_size") <= 200).alias("size"))


@query("i41_points", "SELECT p_partkey, p_retailprice / 300 * 72 AS points, round_even(p_retailprice / 3, 1) AS rounded FROM part")
def points(spark, sf_dir):
    return R.table(spark, sf_dir, "part").select("p_partkey", G.points(F.col("p_retailprice")).alias("points"), G.half_even(F.col("p_retailprice") / 3, 1).alias("rounded"))


@query("a11_image_page", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS page FROM part")
def image_page(spark, sf_dir):
    path = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("x/pag-"), F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit("-7.jpg"))).otherwise(F.concat(F.lit("pag-"), "p_size", F.lit(".jpg")))
    return R.table(spark, sf_dir, "part").select("p_partkey", readers.image_page(path).alias("page"))


_KIND = ["'footer'", "'kicker'", "'h1'", "'h2'", "'readaloud'", "'caption'", "'cuerpo'", "'titulo'"]
_SMALL = "'<p>T <span style=\"font-variant:small-caps\">b' || p_size || '</span></p>'"


@query(
    "c15_journal_piece",
    "SELECT p_partkey, " + choice(["NULL", "NULL", "'h1'", "'h2'", "NULL", "NULL", "NULL", "'h1'"]) + " AS level, "
    + choice(["NULL", "NULL", "'T  b' || p_size", "'T ‹sc›b' || p_size || '‹/sc›'", f"'<blockquote>' || {_SMALL} || '</blockquote>'", f"'<p><em>' || {_SMALL} || '</em></p>'", _SMALL, "'T  b' || p_size"])
    + " AS html FROM part",
)
def journal_piece(spark, sf_dir):
    p = R.table(spark, sf_dir, "part").select("p_partkey", F.expr(choice(_KIND)).alias("kind"), F.concat(F.lit("T ‹sc›b"), F.col("p_size").cast("string"), F.lit("‹/sc›")).alias("text"))
    return p.select("p_partkey", shape.journal_piece(F.col("text"), F.col("kind")).alias("p")).select("p_partkey", "p.level", "p.html")


@query("d19_absorb_rest", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'b1:b2|b3:b4,b6' WHEN 1 THEN 'b1:b2,b3,b4,b6|b5:' ELSE 'b5:|b1:b2,b3,b4,b6|b3:' END AS takes FROM part")
def absorb_rest(spark, sf_dir):
    listed = lambda c: F.array(*[F.struct(F.lit(b).alias("block"), (F.array(*[F.lit(x) for x in of]) if of else F.lit(None).cast("array<string>")).alias("list"), F.lit(side).alias("side")) for b, of, side in c])
    claims = [listed(c) for c in ([("b1", ["b2"], "L"), ("b3", None, "L")], [("b1", None, "L"), ("b5", None, "R")], [("b5", None, "R"), ("b1", None, "L"), ("b3", None, "L")])]
    chosen = F.when(F.col("p_partkey") % 3 == 0, claims[0]).when(F.col("p_partkey") % 3 == 1, claims[1]).otherwise(claims[2])
    blocks = F.array(*[F.struct(F.lit(i).alias("id"), F.lit("R" if i == "b5" else "L").alias("side")) for i in ("b1", "b2", "b3", "b4", "b5", "b6")])
    takes = F.array_join(F.transform(folds.absorb_rest(F.col("claims"), blocks), lambda c: F.concat(c.getField("block"), F.lit(":"), F.array_join(c.getField("takes"), ","))), "|")
    return R.table(spark, sf_dir, "part").select("p_partkey", chosen.alias("claims")).select("p_partkey", takes.alias("takes"))
