"""Corpus shaping: catalogue, line types, verdicts, samples, name candidates, glossary checks, sections and journals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..functions.text import rx
from . import joins, ranking


def page_class(page: Column, last: Column, words: Column) -> Column:
    """Cover, back cover, art, scarce or text, by place and number of words."""
    return F.when(page == 1, "portada").when(page == last, "contraportada").when(words < 40, "arte?").when(words < 150, "escasa?").otherwise("texto")


def catalogue(pages: DataFrame, images: DataFrame) -> DataFrame:
    """(pdf_page, book_page, words, clase, notas, jpg) from (page, text) and image files (page, name)."""
    last = pages.agg(F.max("page").alias("_last"))
    i = images.groupBy(F.col("page").alias("_p")).agg(F.max("name").alias("jpg"))
    out = pages.withColumn("words", T.words(F.coalesce("text", F.lit("")))).crossJoin(F.broadcast(last)).join(i, F.col("page") == F.col("_p"), "left")  # one row
    inner = (F.col("page") > 1) & (F.col("page") < F.col("_last"))
    return out.select(F.col("page").alias("pdf_page"), F.when(inner, F.col("page") - 1).alias("book_page"), "words", page_class(F.col("page"), F.col("_last"), F.col("words")).alias("clase"), F.lit("").alias("notas"), F.coalesce("jpg", F.lit("")).alias("jpg"))


def line_type(width: Column, height: Column, line: dict[str, Column]) -> Column:
    """Type of a line from its box and precomputed ink features.

    ``line``: x, y, w, h, text, red, caption, ochre, lilac. Position comes first, then panels, then ink.
    """
    x, y, w, h, t = (line[k] for k in ("x", "y", "w", "h", "text"))
    t = F.trim(t)
    caps = (F.upper(t) == t) & t.rlike(r"\p{L}")
    points = h / 300 * 72
    return (
        F.when(line["red"].isNull(), "otro")  # no ink was seen
        .when(y > height * 0.952, F.when(w < width * 0.06, "folio").otherwise("footer"))
        .when((h > width * 0.004) & (w < width * 0.035) & (h > w * 3), "credito")
        .when((y < height * 0.055) & (w < width * 0.35) & (F.abs(x + w / 2 - width / 2) < width * 0.22), "kicker")
        .when(line["ochre"], F.when(line["red"] & caps & (points >= 11), "stat_h").otherwise("stat"))
        .when(line["lilac"], "readaloud")
        .when(line["red"] & (points >= 20) & (F.length(t) <= 2), "dropcap")
        .when(line["red"] & caps, F.when(points >= 20, "titulo").when(points >= 16.5, "h_mayor").when(points >= 12, "h1").otherwise("h2"))
        .when(line["caption"], "caption")
        .otherwise("cuerpo")
    )


def sample_pages(pages: DataFrame, n: Column | int, k: int = 8) -> DataFrame:
    """Pages of a systematic sample of ``k``, after the first few."""
    first = F.least(F.lit(4), F.lit(n))
    step = F.greatest(F.lit(1), F.floor((F.lit(n) - first) / k))
    nth = (F.col("page") - first) / step
    return pages.filter((F.col("page") >= first) & (nth == F.floor(nth)) & (nth < k))


def page_signals(pages: DataFrame) -> DataFrame:
    """(page, words, noisy) of page texts: noise counts where there are more than forty words."""
    t = F.coalesce(F.col("text"), F.lit(""))
    return pages.select("page", T.words(t).alias("words"), ((T.words(t) > 40) & (T.ocr_noise(t) > T.words(t) * 0.02)).alias("noisy"))


def verdict(signals: DataFrame) -> DataFrame:
    """One row: route of a document, median words, counts and advice, from sampled pages.

    ``signals``: fonts, words, noisy, single_image. The median is the upper one.
    """
    s = signals.agg(F.count("*").alias("k"), F.count_if("fonts").alias("fonts"), F.count_if(F.col("words") > 40).alias("texts"), F.count_if("single_image").alias("images"), F.count_if("noisy").alias("noisy"))
    middle = upper_medians(signals.select("words"), [], "words").select(F.col("middle").alias("median_words"))
    digital, text = F.col("fonts") >= F.col("k") * 0.7, F.col("texts") >= F.col("k") * 0.5
    without_text, art, noise = fixed.TRIAGE_ADVICE
    advice = F.array_compact(F.array(F.when(digital & ~text, F.lit(without_text)), F.when(digital & (F.col("images") >= F.col("k") * 0.7), F.lit(art)), F.when(F.col("noisy") >= F.col("k") * 0.3, F.lit(noise))))
    both = s.join(F.broadcast(middle))  # single rows
    return both.select("k", "fonts", "texts", "images", "noisy", "median_words", F.when(digital, "DIGITAL").when(text, "HIBRIDO").otherwise("ESCANEO").alias("verdict"), advice.alias("advice"))


def upper_medians(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, middle): the middle value of each group, the upper of two, from counts of equal values; nulls are left out.

    Equal values are counted before they are moved, so a group costs as many rows as it has different values. Without
    groups the one median is found by refining a histogram, so no task holds all different values.
    """
    if not by:
        return ranking.nth(rows, value).withColumnRenamed(value, "middle")
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*by)
    upto = F.sum("_n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("_upto", upto).withColumn("_all", F.sum("_n").over(group))
    return placed.filter(F.col("_upto") > F.floor(F.col("_all") / 2)).groupBy(*by).agg(F.min(value).alias("middle"))


# name candidates

_NAME_RUN = r"(?<![.!?:•—]\s)(?<!^)\b([A-Z][a-zA-Z'’\-]+(?:\s+(?:of|the|and|de|del)\s+[A-Z][a-zA-Z'’\-]+|\s+[A-Z][a-zA-Z'’\-]+)+)\b"
_NAME_WORD = r"(?<=[a-z,;]\s)([A-Z][a-z'’\-]{3,})\b"


def name_runs(texts: DataFrame, text_col: str, least: int = 2) -> DataFrame:
    """(name, n): runs of capitalised words, small words between them, that don't begin a sentence."""
    found = texts.select(F.explode(T.find_all(F.col(text_col), rx(_NAME_RUN), 1)).alias("name"))
    return found.groupBy("name").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def name_words(texts: DataFrame, text_col: str, runs: DataFrame, least: int = 4) -> DataFrame:
    """(name, n): capitalised words inside sentences that are no common word and in no run of names."""
    n = texts.select(F.explode(T.find_all(F.col(text_col), rx(_NAME_WORD), 1)).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    parts = runs.select(F.explode(T.find_all(F.col("name"), r"[^\s]+")).alias("_w")).distinct()
    return n.filter((F.col("n") >= least) & ~F.col("name").isin(*fixed.CANDIDATE_STOPWORDS)).join(parts, F.col("name") == F.col("_w"), "left_anti")


def headings(lines: DataFrame) -> DataFrame:
    """(heading, n) of heading lines without their codes, in title case."""
    t = F.regexp_replace(F.trim("t"), r"^[A-Z]\d+:\s*", "")
    return lines.filter(F.col("type").isin("h1", "h2", "h_mayor", "titulo")).select(t.alias("t")).filter(F.length("t") > 2).groupBy(T.title_case(F.col("t")).alias("heading")).agg(F.count("*").alias("n"))


def top(counts: DataFrame, n_col: str, first_col: str, k: int) -> DataFrame:
    """The ``k`` most frequent, earlier ones first among equals."""
    return counts.orderBy(F.desc(n_col), first_col).limit(k)


# glossary checks


def duplicate_terms(glossary: DataFrame) -> DataFrame:
    return glossary.groupBy("en").agg(F.count("*").alias("n")).filter("n > 1")


def terms_not_in(glossary: DataFrame, text: str) -> DataFrame:
    """(en, es, looked_for) of terms whose longest alternative a reference text lacks."""
    looked = T.longest_alternative(F.col("es"))
    return glossary.select("en", "es", looked.alias("looked_for")).filter(~F.contains(F.lit(text.lower()), F.lower("looked_for")))


def spot_check(rows: DataFrame, key: str, k: int = 20) -> DataFrame:
    """A sample of ``k`` rows by the hash of a key: the same at every run, all rows if there are fewer."""
    return rows.orderBy(F.sha2(F.col(key).cast("string"), 256), key).limit(k)


#: Characters by which terms without a word between spaces meet words.
GRAM = 4


def page_terms(pages: DataFrame, glossary: DataFrame) -> DataFrame:
    """(page, en, es): glossary rows whose term, or the term less one or two characters, occurs in the page.

    A text that holds any variant of a term holds the shortest, so only that one is looked for. Texts and terms meet by
    equality of one word: the longest that has white space on both sides within the term. Terms of one or two words
    have none; they are first looked for within the distinct words of all texts, which then stand for them.
    """
    t = F.lower(F.col("text"))
    words = lambda c: T.find_all(c, r"\S+")
    longest = lambda found: F.array_max(F.transform(found, lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))).getField("w")
    g = glossary.select("en", "es", T.term_core(F.col("en")).alias("core")).filter("core <> ''").distinct()
    g = g.withColumn("key", longest(T.find_all(F.col("core"), r"(?<=\s)\S+(?=\s)")))
    keys = g.filter("key is not null")
    rest = g.filter("key is null").drop("key").withColumn("piece", longest(words(F.col("core"))))
    if not rest.isEmpty():  # a word holds a piece if a run of the word's characters is the piece, or its beginning
        vocabulary = pages.select(F.explode(words(t)).alias("key")).distinct()
        short = [r["n"] for r in rest.select(F.least(F.length("piece"), F.lit(GRAM)).alias("n")).distinct().collect()]  # lengths up to GRAM
        gram = F.explode(F.concat(*[T.grams(F.col("key"), n) for n in sorted(short)]))
        near = vocabulary.withColumn("gram", gram).join(rest, F.col("gram") == F.substring("piece", 1, GRAM))
        keys = keys.unionByName(near.filter(F.col("key").contains(F.col("piece"))).select("en", "es", "core", "key").distinct())
    keys = keys.withColumnRenamed("key", "_key")
    if joins.is_small(keys):  # nothing is moved: words are met where the text is
        met = pages.select("page", t.alias("_t")).withColumn("_word", F.explode(F.array_distinct(words(F.col("_t"))))).join(F.broadcast(keys), F.col("_word") == F.col("_key"))
        return met.filter(F.col("_t").contains(F.col("core"))).select("page", "en", "es").distinct()
    met = pages.select("page", F.explode(F.array_distinct(words(t))).alias("_word")).join(keys, F.col("_word") == F.col("_key"))
    found = met.groupBy(F.col("page").alias("_page")).agg(F.collect_set(F.struct("en", "es", "core")).alias("_found"))
    hits = pages.join(found, F.col("page") == F.col("_page")).select("page", F.explode(F.filter("_found", lambda v: t.contains(v.getField("core")))).alias("v"))
    return hits.select("page", "v.en", "v.es").distinct()


def nearest_forms(glossary: DataFrame, texts: DataFrame, text_col: str = "text", k: int = 4) -> DataFrame:
    """(en, es, forms): up to ``k`` phrases of reference texts, in order, that hold the beginning of a term's last word.

    A phrase is a capitalised word with up to two small ones after it. Phrases are made distinct first; phrases and
    terms then meet by equality of the key with a piece of the phrase of the key's length.
    """
    phrases = texts.select(F.explode(T.find_all(F.col(text_col), r"[A-ZÁÉÍÓÚÑ][a-záéíóúüñ]*(?:\s+[a-záéíóúüñ]+){0,2}")).alias("form")).distinct()
    g = glossary.select("en", "es", T.search_key(F.col("es")).alias("key")).distinct()
    lengths = [r["n"] for r in g.select(F.length("key").alias("n")).filter("n > 0").distinct().collect()]  # at most six
    if not lengths:
        return g.select("en", "es").distinct().withColumn("forms", F.array().cast("array<string>"))
    pieces = phrases.select("form", F.explode(F.concat(*[T.grams(F.lower("form"), n) for n in sorted(lengths)])).alias("piece"))
    met = joins.looked_up(pieces, g, F.col("piece") == F.col("key"), "inner").select("en", "es", "form").distinct()
    first = met.withColumn("_n", F.row_number().over(Window.partitionBy("en", "es").orderBy("form"))).filter(F.col("_n") <= k)
    forms = first.groupBy(F.col("en").alias("_en"), F.col("es").alias("_es")).agg(F.array_sort(F.collect_list("form")).alias("forms"))
    return g.select("en", "es").distinct().join(forms, (F.col("en") == F.col("_en")) & (F.col("es") == F.col("_es")), "left").select("en", "es", F.coalesce("forms", F.array().cast("array<string>")).alias("forms"))


# sections and journals


def section_ranges(sections: DataFrame, last: Column | None = None, by: list[str] | None = None) -> DataFrame:
    """(start, end, name): each section ends before the next begins; the last at ``last``, or where it begins."""
    w = Window.partitionBy(*(by or [])).orderBy("start")
    end = F.coalesce(F.lead("start").over(w) - 1, last if last is not None else F.col("start"), F.col("start"))
    return sections.withColumn("end", end)


def heading_level(text: Column, size: Column, colour: Column, lines: Column, h1: float = 18.0, h2: float = 12.5, footer: float = 7.0, accent: float = 11.6) -> Column:
    """Type of a digital block from its font size, capitals and colour."""
    plain = F.trim(F.regexp_replace(text, rx(r"\*+|\s+"), " "))
    capitals = (F.upper(plain) == plain) & plain.rlike(r"\p{L}") & (lines <= 2)
    return (
        F.when(size <= footer, "footer")
        .when((size >= h1) & (lines <= 3), "h1")
        .when(capitals & T.accent_colour(colour) & (size >= accent), "h1")
        .when(capitals & (size >= h2 - 2) & (F.length(plain) <= 70), "h2")
        .otherwise("cuerpo")
    )


def journal_piece(text: Column, kind: Column) -> Column:
    """(level, html) of a block; null for footers and kickers, which journals leave out."""
    piece = lambda level, html: F.struct(F.lit(level).cast("string").alias("level"), html.alias("html"))
    body = T.html_journal(text)
    return (
        F.when(kind.isin("footer", "kicker"), F.lit(None))
        .when(kind.isin("titulo", "h_mayor", "h1"), piece("h1", T.heading_text(text)))
        .when(kind == "h2", piece("h2", T.escape_html(F.trim(F.regexp_replace(text, r"\*+", "")))))
        .when(kind == "readaloud", piece(None, F.concat(F.lit("<blockquote>"), body, F.lit("</blockquote>"))))
        .when(kind == "caption", piece(None, F.concat(F.lit("<p><em>"), body, F.lit("</em></p>"))))
        .otherwise(piece(None, body))
    )


def journal_pages(pieces: DataFrame, by: list[str], order: list[str], start_name: str = "name") -> DataFrame:
    """(by, sort, name, content): pieces (level, html) cut into journal pages at each top heading.

    A heading that comes first of all names the page instead of ending an empty one.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    top_heading = F.coalesce(F.col("level") == "h1", F.lit(False))
    cut = top_heading & (F.row_number().over(w) > 1)
    p = pieces.withColumn("_h", top_heading).withColumn("_cut", cut.cast("int"))
    p = p.withColumn("_page", F.sum("_cut").over(upto))
    shown = F.when(F.col("_h"), F.concat(F.lit("<h1>"), "html", F.lit("</h1>"))).when(F.col("level") == "h2", F.concat(F.lit("<h2>"), "html", F.lit("</h2>"))).otherwise(F.col("html"))
    p = p.withColumn("_shown", shown)
    grouped = p.groupBy(*by, "_page").agg(F.array_sort(F.collect_list(F.struct(*order, "_shown"))).alias("_all"), F.max(F.when(F.col("_h"), F.col("html"))).alias("_name"), F.first(start_name).alias("_start"))
    return grouped.select(*by, ((F.col("_page") + 1) * 10).alias("sort"), F.substring(F.coalesce("_name", "_start"), 1, 120).alias("name"), F.array_join(F.transform("_all", lambda x: x.getField("_shown")), "").alias("content"))


def bookmark_titles(blocks: DataFrame) -> DataFrame:
    """(page, title): title blocks of a page in order, without markup; no row for pages without."""
    t = T.strip_markup_line(F.col("t"))
    live = blocks.filter((F.col("type") == "titulo") & F.col("t").isNotNull() & ~F.col("t").isin("", "~"))
    return live.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", t.alias("t")))), lambda s: s.getField("t")), " ").alias("title")).filter("title <> ''")


def first_seen(rows: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of each key in order."""
    w = Window.partitionBy("_key").orderBy(*order)
    return rows.withColumn("_key", key).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_key", "_n")


def stable_id(*parts: Column) -> Column:
    """Sixteen hexadecimal digits from a key, the same at every run."""
    return F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 16)


def weighted_mode(rows: DataFrame, by: list[str], value: str, weight: Column) -> DataFrame:
    """(by, value): the value of most weight, the smaller of equals."""
    w = rows.groupBy(*by, value).agg(F.sum(weight).alias("_w"))
    return w.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("_w"), F.col(value))).alias(value))


def styled_text(spans: DataFrame, by: list[str]) -> DataFrame:
    """(by, text): spans (place, text, bold, italic, font, color, size) as marked-up text.

    Bold, italic and small capitals come from the font; what departs from the group's usual colour or size is wrapped.
    Spans and both usual values of a group come from one aggregate, so no table of groups is joined or broadcast.
    """
    small = F.col("font").rlike(r"(?i)smallcaps|_sc\b|-sc\b")
    star = F.concat(F.when(F.col("bold"), "**").otherwise(""), F.when(F.col("italic"), "*").otherwise(""))
    body = F.concat(F.when(small, "‹sc›").otherwise(""), star, F.trim("text"), F.reverse(star), F.when(small, "‹/sc›").otherwise(""))
    usual = lambda c: F.mode(F.struct(c.alias("v")), True).getField("v")  # noqa: E731  the smaller of equals; nulls count
    rounded = F.bround("size")
    span = F.struct("place", body.alias("body"), "color", rounded.alias("size"))
    groups = spans.filter(F.trim("text") != "").groupBy(*by).agg(usual(F.col("color")).alias("_color"), usual(rounded).alias("_size"), F.array_sort(F.collect_list(span)).alias("_all"))

    def wrapped(s: Column) -> Column:
        own, colour = s.getField("body"), s.getField("color")
        coloured = F.concat(F.lit("‹c:"), F.lower(F.lpad(F.hex(colour), 6, "0")), F.lit("›"), own, F.lit("‹/c›"))
        return F.when(colour != F.col("_color"), coloured).when(s.getField("size") >= F.col("_size") * 1.35, F.concat(F.lit("‹g›"), own, F.lit("‹/g›"))).otherwise(own)

    return groups.select(*by, F.array_join(F.transform("_all", wrapped), " ").alias("text"))
