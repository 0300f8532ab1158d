"""Field extraction from stat blocks and roll tables, and their export documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..functions.text import let, rx
from . import joins
from .shape import first_seen, stable_id

_ARMOUR, _HITS, _SPEED, _CHALLENGE = rx(fixed.ARMOUR), rx(fixed.HIT_POINTS), rx(fixed.SPEED + fixed.FIELD_END), rx(fixed.CHALLENGE)
_BONUS, _ABILITY, _KIND = rx(fixed.PROFICIENCY), rx(fixed.ABILITY_SCORE), fixed.KIND_LINE


def _labelled(start: str) -> str:
    return rx(start + r"[:\s]+(.+?)" + fixed.FIELD_END)


def _some(text: Column, pattern: str, make) -> Column:
    """``make`` applied where the pattern occurs, else null."""
    return F.when(text.rlike(pattern), make(lambda i: F.regexp_extract(text, pattern, i)))


def flat_text(text: Column) -> Column:
    """A block's text with broken words joined and paragraphs as lines."""
    return F.replace(F.replace(text, F.lit("-\n\n"), F.lit("")), F.lit("\n\n"), F.lit("\n"))


def kind_line(flat: Column) -> Column:
    return F.trim(F.regexp_extract(flat, _KIND, 0))


def defence_lines(flat: Column) -> Column:
    """Armour, hit points and speed as labelled lines."""
    armour = _some(flat, _ARMOUR, lambda g: F.concat(F.lit("**Clase de Armadura** "), g(1), F.when(g(2) != "", F.concat(F.lit(" ("), T.map_terms(g(2), fixed.ARMOUR_WORDS), F.lit(")"))).otherwise("")))
    hits = _some(flat, _HITS, lambda g: F.concat(F.lit("**Puntos de golpe** "), g(1), F.lit(" ("), F.replace(g(2), F.lit(" "), F.lit("")), F.lit(")")))
    speed = _some(flat, _SPEED, lambda g: F.concat(F.lit("**Velocidad** "), T.map_terms(g(1), fixed.MOVES)))
    return F.array_compact(F.array(armour, hits, speed))


def abilities(flat: Column) -> Column:
    """The six ability scores as structs k, v; null if fewer are found."""
    scores, bonuses = T.find_all(flat, _ABILITY, 1), T.find_all(flat, _ABILITY, 2)
    table = F.array(*[F.struct(F.lit(k).alias("k"), F.concat(F.get(scores, F.lit(i)), F.lit(" ("), F.replace(F.get(bonuses, F.lit(i)), F.lit("-"), F.lit("−")), F.lit(")")).alias("v")) for i, k in enumerate(fixed.ABILITIES)])
    return F.when(F.size(scores) >= 6, table)


def labelled_lines(flat: Column) -> Column:
    """Saves, skills, resistances, senses, languages and challenge as labelled lines, their values translated."""
    lines = [_some(flat, _labelled(start), lambda g, label=label, table=table: F.concat(F.lit(f"**{label}** "), T.map_terms(T.map_terms(g(1), table), fixed.EXTRA_WORDS))) for start, label, table in fixed.LABELLED]
    bonus = F.when(flat.rlike(_BONUS), F.concat(F.lit("&nbsp;&nbsp;&nbsp;&nbsp;**Bonificador por competencia** +"), F.regexp_extract(flat, _BONUS, 1))).otherwise("")
    lines.append(_some(flat, _CHALLENGE, lambda g: F.concat(F.lit("**Desafío** "), g(1), F.lit(" ("), g(2), F.lit(" PX)"), bonus)))
    return F.array_compact(F.array(*lines))


def remainder(flat: Column, title: Column) -> Column:
    """The prose left when fields, kind line, title and ability scores are taken out, on one line."""
    consumed = [F.regexp_extract(flat, p, 0) for p in (_ARMOUR, _HITS, _SPEED, *(_labelled(s) for s, _, _ in fixed.LABELLED), _CHALLENGE)]
    consumed += [F.when(flat.rlike(_CHALLENGE), F.regexp_extract(flat, _BONUS, 0)).otherwise(""), kind_line(flat), title]
    rest = F.aggregate(F.filter(F.array(*consumed), lambda c: c != ""), flat, lambda t, c: F.replace(t, c, F.lit(" ")))
    # only the first six scores go: what splitting leaves after the sixth is joined again with the scores in between
    scores = T.find_all(flat, _ABILITY, 0)
    rest = F.aggregate(F.slice(scores, 1, 6), rest, lambda t, s: let(F.position(s, t), lambda at: F.when(at > 0, F.concat(F.substring(t, F.lit(1), at - 1), F.lit(" "), F.substring(t, at + F.length(s), F.length(t)))).otherwise(t)))
    rest = F.regexp_replace(rest, rx(r"\b(STR|DEX|CON|INT|WIS|CHA)\b"), " ")
    return F.trim(F.regexp_replace(F.replace(rest, F.lit("\n"), F.lit(" ")), rx(r"\s{2,}"), " "))


def sections(rest: Column, least: int = 12) -> Column:
    """Structs section, text: prose cut at the capital headings; what comes first are traits."""
    mark = rx(r"\b(BONUS ACTIONS|LEGENDARY ACTIONS|REACTIONS|ACTIONS)\b")
    names = F.create_map(*[F.lit(x) for pair in fixed.SECTION_MARKS.items() for x in pair])

    def cut(t: Column) -> Column:
        heads = F.concat(F.array(F.lit("traits")), F.transform(T.find_all(t, mark, 1), lambda h: names[h]))
        each = lambda f: F.transform(f.getField("parts"), lambda p, i: F.struct(F.get(f.getField("heads"), i).alias("section"), F.trim(p).alias("text")))
        return let(F.struct(heads.alias("heads"), F.split(t, mark, -1).alias("parts")), each)

    return F.filter(let(rest, cut), lambda p: F.length(p.getField("text")) >= least)


def fix_alignment(text: Column) -> Column:
    """Alignment words in Spanish order and, inside the line, in small letters."""
    swapped = F.regexp_replace(text, rx(fixed.ALIGNMENT_ORDER, "i"), "$2 $1")
    for word in fixed.ALIGNMENT_WORDS:
        swapped = F.regexp_replace(swapped, rx(rf"(?<=. ){word}\b"), word.lower())
    return swapped


def subline(text: Column) -> Column:
    """The translated kind line under a panel's title: its own words put right, then alignment."""
    return fix_alignment(T.map_terms(text, fixed.SUBLINE_WORDS))


def entries_text(entries: Column) -> Column:
    """Entries (structs n, t) as one text: bold name, then its text; entries without text are left out."""
    kept = F.filter(entries, lambda e: F.coalesce(e.getField("t"), F.lit("")) != "")
    return F.array_join(F.transform(kept, lambda e: F.concat(F.lit("***"), F.regexp_replace(e.getField("n"), r"\.+$", ""), F.lit(".*** "), e.getField("t"))), "\n\n")


def panel_html(title: Column, sub: Column, parts: Column) -> Column:
    """HTML of a panel; ``parts``: structs h, t, table (array of structs k, v)."""
    cell = lambda c: F.concat(F.lit("<td style='text-align:center'><b>"), c.getField("k"), F.lit("</b><br>"), c.getField("v"), F.lit("</td>"))
    table = lambda p: F.concat(F.lit("<table><tr>"), F.array_join(F.transform(p.getField("table"), cell), ""), F.lit("</tr></table>"))
    prose = lambda p: F.concat(F.when(F.coalesce(p.getField("h"), F.lit("")) != "", F.concat(F.lit("<h4>"), T.escape_html(p.getField("h")), F.lit("</h4>"))).otherwise(""), T.html_journal(F.coalesce(p.getField("t"), F.lit(""))))
    head = F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit("<h3>"), T.escape_html(title), F.lit("</h3>"))).otherwise("")
    under = F.when(F.coalesce(sub, F.lit("")) != "", T.html_journal(sub)).otherwise("")
    return F.concat(head, under, F.array_join(F.transform(parts, lambda p: F.when(p.getField("table").isNotNull(), table(p)).otherwise(prose(p))), ""))


def fraction(c: Column) -> Column:
    """A number such as ``1/4`` or ``1,000``; null for what is none or divides by nothing."""
    plain = F.replace(c, F.lit(","), F.lit(""))
    top, low = F.split(plain, "/"), F.get(F.split(plain, "/"), F.lit(1))
    return F.when(low.isNull(), plain.try_cast("double")).otherwise(F.try_divide(top[0].try_cast("double"), low.try_cast("double")))


def actors(panels: DataFrame) -> DataFrame:
    """Actor fields of panels (page, place, title, sub, parts), the first of each name.

    ``parts`` as for :func:`panel_html`. Without a title a panel is no actor.
    """
    fields = F.array_join(F.transform(F.filter("parts", lambda p: p.getField("t").isNotNull()), lambda p: p.getField("t")), " ")
    whole = lambda p, d: F.coalesce(F.nullif(F.regexp_extract(F.col("fields"), rx(p), 1), F.lit("")).cast("int"), F.lit(d))
    speed = F.regexp_extract("fields", rx(fixed.PANEL_SPEED), 1)
    moves = [F.struct(F.lit("walk").alias("k"), F.nullif(F.regexp_extract(speed, rx(r"^\s*(\d+)"), 1), F.lit("")).cast("int").alias("v"))]
    moves += [F.struct(F.lit(k).alias("k"), F.nullif(F.regexp_extract(speed, rx(rf"{w}\s+(\d+)"), 1), F.lit("")).cast("int").alias("v")) for w, k in fixed.MOVE_KEYS.items()]
    tables = F.flatten(F.transform(F.filter("parts", lambda p: p.getField("table").isNotNull()), lambda p: p.getField("table")))
    ability_of = F.create_map(*[F.lit(x) for pair in fixed.ABILITY_KEYS.items() for x in pair])
    scores = F.filter(F.transform(tables, lambda c: F.struct(ability_of[c.getField("k")].alias("k"), F.nullif(F.regexp_extract(c.getField("v"), r"^\s*(\d+)", 1), F.lit("")).cast("int").alias("v"))), lambda c: c.getField("k").isNotNull() & c.getField("v").isNotNull())
    kinds = F.create_map(*[F.lit(x) for pair in fixed.ITEM_KINDS.items() for x in pair])

    def items(p: Column) -> Column:
        kind = F.coalesce(kinds[p.getField("h")], F.when(p.getField("h").isNull() & p.getField("t").contains("***"), F.lit("rasgo")))
        item = rx(fixed.PANEL_ITEM, "s")
        names, texts = T.find_all(p.getField("t"), item, 1), T.find_all(p.getField("t"), item, 2)
        each = F.transform(names, lambda n, i: F.struct(F.substring(F.trim(n), 1, 60).alias("name"), F.concat(F.lit("<p><em>("), kind, F.lit(")</em></p>"), T.html_journal(F.trim(texts[i]))).alias("html")))
        return F.when(kind.isNotNull(), each).otherwise(F.array().cast("array<struct<name:string,html:string>>"))

    name = F.substring(T.title_case(F.col("title")), 1, 80)
    # the first of a name is chosen on panels as they came: fields and the biography, which are long, don't go through the window
    titled = joins.dealt(panels.filter(F.coalesce("title", F.lit("")) != "").withColumn("_name", F.lower(name)), "_name")
    a = first_seen(titled, F.col("_name"), ["page", "place"]).withColumn("fields", fields)
    out = a.select(
        "page",
        "place",
        name.alias("name"),
        F.map_from_entries(scores).alias("abilities"),
        whole(fixed.PANEL_ARMOUR, 10).alias("ac"),
        whole(fixed.PANEL_HIT_POINTS, 10).alias("hp"),
        F.regexp_extract("fields", rx(fixed.PANEL_FORMULA), 1).alias("formula"),
        F.coalesce(fraction(F.nullif(F.regexp_extract("fields", rx(fixed.PANEL_CHALLENGE), 1), F.lit(""))), F.lit(0.0)).alias("cr"),
        F.map_from_entries(F.filter(F.array(*moves), lambda m: m.getField("v").isNotNull())).alias("movement"),
        F.flatten(F.transform(F.filter("parts", lambda p: p.getField("t").isNotNull()), items)).alias("items"),
        F.regexp_replace(F.coalesce("sub", F.lit("")), r"\*", "").alias("kind"),
        panel_html(F.col("title"), F.col("sub"), F.col("parts")).alias("biography"),
    )
    return out.withColumn("id", stable_id(F.lower("name"))).withColumn("file", F.concat(T.slug(F.col("name")), F.lit(".json")))


def roll_tables(texts: DataFrame) -> DataFrame:
    """(page, block, name, formula, results): tables of numbered rows with two results or more, from control texts."""
    t = F.col("t")
    lines = F.split(t, "\n\n", -1)
    row = rx(fixed.ROLL_ROW, "s")
    first = lambda x: F.regexp_extract(x, row, 1).cast("int")
    last = lambda x: F.coalesce(F.nullif(F.regexp_extract(x, row, 2), F.lit("")), F.regexp_extract(x, row, 1)).cast("int")
    result = lambda x: F.struct(F.trim(F.regexp_replace(F.regexp_extract(x, row, 3), r"\*", "")).alias("text"), first(x).alias("first"), last(x).alias("last"), (last(x) - first(x) + 1).alias("weight"))
    found = texts.filter(t.rlike(rx(fixed.ROLL_TABLE))).withColumn("results", F.transform(F.filter(lines, lambda x: x.rlike(row)), result))
    name = F.substring(T.title_case(F.trim(F.regexp_replace(lines[0], r"\*", ""))), 1, 70)
    return found.filter(F.size("results") >= 2).select("page", "block", name.alias("name"), F.concat(F.lit("1d"), F.regexp_extract(t, rx(fixed.ROLL_DIE), 1)).alias("formula"), "results")


# export documents: JSON texts with ids that are the same at every run

def _document(**parts: Column) -> Column:
    """A JSON object; null values are written, as importers look for them."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in parts.items()]), {"ignoreNullFields": "false"})


def _nothing() -> Column:
    """An empty JSON object or list has no struct form of its own; an empty map is written as {}."""
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))


def _owned() -> dict[str, Column]:
    return {"folder": F.lit(None).cast("string"), "flags": _nothing(), "ownership": F.struct(F.lit(0).alias("default"))}


def journal_document(pages: DataFrame, by: str, title: str = "") -> DataFrame:
    """(by, id, document): journal pages (by, sort, name, content) as one JSON document each, with keyed pages.

    The journal is named after its key, with ``title`` before it where there is one.
    """
    doc = stable_id(F.col(by).cast("string"))
    page_id = stable_id(F.col(by).cast("string"), F.col("sort").cast("string"))
    page = F.struct(page_id.alias("_id"), F.concat(F.lit("!journal.pages!"), doc, F.lit("."), page_id).alias("_key"), "name", F.lit("text").alias("type"), F.struct(F.lit(False).alias("show"), F.lit(1).alias("level")).alias("title"), "sort", F.struct(F.lit(1).alias("format"), F.col("content").alias("content")).alias("text"))
    grouped = pages.select(by, doc.alias("id"), "sort", page.alias("page")).groupBy(by, "id").agg(F.array_sort(F.collect_list(F.struct("sort", "page"))).alias("pages"))
    name = F.concat(F.lit(f"{title} — " if title else ""), F.col(by).cast("string"))
    return grouped.select(by, "id", _document(_id=F.col("id"), _key=F.concat(F.lit("!journal!"), "id"), name=name, pages=F.transform("pages", lambda p: p.getField("page")), sort=F.lit(0), **_owned()).alias("document"))


def actor_document(found: DataFrame) -> DataFrame:
    """(file, document): rows of :func:`actors` as one JSON document each, with their items."""
    feature = lambda i, n: F.struct(
        stable_id(F.col("id"), n.cast("string")).alias("_id"),
        i.getField("name").alias("name"),
        F.lit("feat").alias("type"),
        F.struct(F.struct(i.getField("html").alias("value")).alias("description"), F.struct(F.lit("").alias("value")).alias("type")).alias("system"),
        F.lit("icons/svg/item-bag.svg").alias("img"),
        F.array().cast("array<string>").alias("effects"),
        _nothing().alias("flags"),
    )
    points = F.struct(F.col("hp").alias("value"), F.col("hp").alias("max"), "formula")
    system = F.struct(
        F.transform_values("abilities", lambda _, v: F.struct(v.alias("value"))).alias("abilities"),
        F.struct(F.struct(F.lit("flat").alias("calc"), F.col("ac").alias("flat")).alias("ac"), points.alias("hp"), "movement").alias("attributes"),
        F.struct("cr", F.struct(F.lit("").alias("value"), F.col("kind").alias("custom")).alias("type"), F.struct(F.col("biography").alias("value")).alias("biography")).alias("details"),
        _nothing().alias("traits"),
    )
    return found.select(
        "file",
        _document(
            _id=F.col("id"), name=F.col("name"), type=F.lit("npc"), img=F.lit("icons/svg/mystery-man.svg"), system=system, items=F.transform("items", feature),
            effects=F.array().cast("array<string>"), sort=F.lit(0), prototypeToken=F.struct("name"), **_owned(),
        ).alias("document"),
    )


def table_document(tables: DataFrame, title: str) -> DataFrame:
    """(page, block, document): rows of :func:`roll_tables` as one JSON document each."""
    key = F.concat_ws(":", F.col("page").cast("string"), F.col("block"))
    result = lambda r, n: F.struct(
        stable_id(key, n.cast("string")).alias("_id"),
        F.lit(0).alias("type"),
        r.getField("text").alias("text"),
        F.array(r.getField("first"), r.getField("last")).alias("range"),
        r.getField("weight").alias("weight"),
        F.lit(False).alias("drawn"),
        _nothing().alias("flags"),
    )
    name = F.concat(F.lit(f"{title} — "), "name")
    return tables.select("page", "block", _document(_id=stable_id(key), name=name, formula=F.col("formula"), results=F.transform("results", result), replacement=F.lit(True), displayRoll=F.lit(True), sort=F.lit(0), **_owned()).alias("document"))


def scene_document(maps: DataFrame, title: str, slug: str) -> DataFrame:
    """(page, document): maps (page, name, width, height) as one scene each, a square of five feet a hundred pixels."""
    grid = F.struct(F.lit(1).alias("type"), F.lit(100).alias("size"), F.lit(5).alias("distance"), F.lit("pies").alias("units"))
    image = F.concat(F.lit(f"modules/{slug}/assets/mapa-"), F.col("page").cast("string"), F.lit(".webp"))
    name = F.concat(F.lit(f"{title} — "), "name")
    parts = {"_id": stable_id(F.lit("scene"), F.col("page").cast("string")), "name": name, "background": F.struct(image.alias("src")), "width": F.col("width"), "height": F.col("height"), "padding": F.lit(0), "grid": grid, "tokenVision": F.lit(False), "fog": F.struct(F.lit(False).alias("exploration")), "sort": F.lit(0)}
    return maps.select("page", _document(**parts, **_owned()).alias("document"))


def handout_document(art: DataFrame, title: str, slug: str) -> DataFrame:
    """One row (document): a journal with an image page for each page of art (page), in order."""
    page = F.col("page").cast("string")
    nth = F.row_number().over(Window.orderBy("page")) - 1  # a book's art pages
    image = F.concat(F.lit(f"modules/{slug}/assets/arte-"), page, F.lit(".webp"))
    each = art.select(nth.alias("n"), "page").select("n", F.struct(stable_id(F.lit("art"), page).alias("_id"), F.concat(F.lit("Lámina p"), page).alias("name"), F.lit("image").alias("type"), (F.col("n") * 10).alias("sort"), F.struct(F.lit(True).alias("show"), F.lit(1).alias("level")).alias("title"), image.alias("src"), _nothing().alias("image"), _nothing().alias("flags")).alias("page"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("n", "page")), lambda a, b: a.getField("n") - b.getField("n")), lambda p: p.getField("page"))
    whole = each.agg(listed.alias("pages"))
    return whole.select(_document(_id=stable_id(F.lit("handouts"), F.lit(slug)), name=F.lit(f"{title} — Láminas y handouts"), pages=F.col("pages"), sort=F.lit(900), **_owned()).alias("document"))


def glossary_html(glossary: DataFrame) -> DataFrame:
    """One row (html): the glossary as a table, in order of term."""
    row = F.concat(F.lit("<tr><td>"), T.escape_html(F.col("en")), F.lit("</td><td>"), T.escape_html(F.col("es")), F.lit("</td></tr>"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("en", "es", row.alias("row")))), lambda r: r.getField("row")), "")
    return glossary.agg(F.concat(F.lit("<table><tr><th>EN</th><th>ES</th></tr>"), rows, F.lit("</table>")).alias("html"))
