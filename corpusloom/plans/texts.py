"""Queries of the text functions, over lines and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..operators import audit, folds, linter, shape
from . import relations as R
from .registry import query


def _bag_sql() -> str:
    """A bag of dice and numbers, of a column named COLUMN."""
    t = "regexp_replace(COLUMN, '[’'']', '', 'g')"
    t = f"regexp_replace({t}, '(^|[^\\p{{L}}\\p{{N}}_])[lI](d\\d)', '\\1' || '1' || '\\2', 'g')"
    t = f"regexp_replace({t}, '(^|[^\\p{{L}}\\p{{N}}_])d(\\d+)\\b', '\\1' || '1d' || '\\2', 'g')"
    return f"list_concat(regexp_extract_all({t}, '\\d+d\\d+'), regexp_extract_all(replace(regexp_replace({t}, '\\d+d\\d+', ' ', 'g'), ',', ''), '\\d[\\d,]*'))"


BAG = _bag_sql()


def _line_query(name, column, sql, alias="value"):
    @query(name, f"WITH {R.LINES} SELECT page, block, {sql} AS {alias} FROM lines")
    def run(spark, sf_dir):
        return R.lines(spark, sf_dir).select("page", "block", column(F.col("en")).alias(alias))

    return run


def _list(c):
    return F.array_join(c, ",")


_line_query("i1_norm", T.norm, R.norm_sql("en"))
_line_query("i2_strip_accents", T.strip_accents, "strip_accents(en)")
_line_query("n1_digits_sorted", lambda c: _list(T.digits_sorted(c)), f"coalesce(array_to_string({R.digits_sql('en')}, ','), '')")
_line_query("n2_digits_sorted_any", lambda c: _list(T.digits_sorted_any(c)), f"coalesce(array_to_string({R.digits_sql('en')}, ','), '')")
_line_query("n3_dice_and_digits", lambda c: _list(T.dice_and_digits(c)), r"coalesce(array_to_string(list_sort(regexp_extract_all(en, '\d+d\d+|\d+')), ','), '')")
_line_query("n4_decimals_sorted", lambda c: _list(T.decimals_sorted(c)), f"coalesce(array_to_string({R.decimals_sql('en')}, ','), '')")
_line_query("i4_thousands", T.thousands, r"regexp_replace(en, '(\d)\.(\d{3})\b', '\1,\2', 'g')")
_line_query("i8_strip_markup", T.strip_markup, r"regexp_replace(en, '\*\*|\*|‹sc›|‹/sc›', '', 'g')")
_line_query("i8_strip_markup_line", T.strip_markup_line, r"trim(regexp_replace(replace(regexp_replace(en, '‹sc›|‹/sc›|\*', '', 'g'), '⏎', ' '), '\s+', ' ', 'g'))")
_line_query("i18_comparable_token", T.comparable_token, r"lower(regexp_replace(replace(regexp_replace(en, '‹[^›]*›', '', 'g'), '*', ''), '^[ .,;:]+|[ .,;:]+$', '', 'g'))")
_line_query("i22_slug", T.slug, "regexp_replace(lower(en), '[^a-z0-9]+', '-', 'g')")
_line_query("i21_title_case", lambda c: T.title_case(F.replace(c, F.lit("ß"), F.lit("s"))), r"array_to_string(list_transform(regexp_extract_all(replace(en, 'ß', 's'), '\p{L}+|\P{L}+'), lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), '')")
_line_query("i25_words", T.words, r"len(regexp_extract_all(en, '\S+'))")
_line_query("i27_tokens_balanced", T.tokens_balanced, "len(regexp_extract_all(en, '‹')) - len(regexp_extract_all(en, '‹/')) = len(regexp_extract_all(en, '‹/'))")
_line_query("c8_legal_request", T.is_legal_request, r"regexp_matches(en, '(?i)WIZARDS OF THE COAST|©\s*\d{4}|TM &|All rights reserved|Hasbro|GM Binder|gmbinder\.com|^\d{2}/\d{2}/\d{4}')")
_line_query("c8_legal_sweep", T.is_legal_sweep, "regexp_matches(en, '(?i)GM Binder|gmbinder|WIZARDS|©')")
_line_query("c9_numeric_cell", T.is_numeric_cell, "regexp_matches(en, '^[\\d+\\-—–−/.,()×x*''✦●✓✔♦]+$') OR regexp_matches(en, '^(\\d{1,2})(st|nd|rd|th)[.,]?$')")
_line_query("i36_name_prefixes", lambda c: _list(F.array_sort(T.name_prefixes(c))), r"coalesce(array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(' ' || en, '[^\p{L}\p{N}_]([A-Z][a-záéíóúñ]{3})', 1), lambda x: lower(x)))), ','), '')")
_line_query("i38_definition_list", T.is_definition_list, r"len(regexp_extract_all(en, '\*{2,3}[^*]{2,40}?[.:]\*{2,3}')) >= 3")
_line_query("i9_html_journal", T.html_journal, r"CASE WHEN trim(en, ' ') = '' THEN '' ELSE '<p>' || trim(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(en, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '" + '"' + r"', '&quot;'), '''', '&#x27;'), '\*\*\*(.+?)\*\*\*', '<strong><em>\1</em></strong>', 'g'), '\*\*(.+?)\*\*', '<strong>\1</strong>', 'g'), '\*(.+?)\*', '<em>\1</em>', 'g'), ' ') || '</p>' END")
_line_query("i14_unwrap_answer", lambda c: T.unwrap_answer(F.concat(F.lit("{'text': '"), c, F.lit("'}"))), "trim(en)")
_line_query("i16_keep_capitals", lambda c: T.keep_capitals(F.upper(F.replace(c, F.lit("ß"), F.lit("s"))), F.replace(c, F.lit("ß"), F.lit("s"))), "CASE WHEN length(regexp_replace(upper(replace(en, 'ß', 's')), '[^A-Za-zÁÉÍÓÚÑÜáéíóúñü]', '', 'g')) >= 3 THEN upper(replace(en, 'ß', 's')) ELSE replace(en, 'ß', 's') END")
_line_query("i19_glossary_root", lambda c: T.glossary_root(F.concat(F.lit("la "), c)), r"(SELECT CASE WHEN length(w) > 6 AND regexp_matches(w, '[aeoáéís]$') THEN w[:-2] ELSE w END FROM (SELECT list_extract(regexp_extract_all(lower(trim(string_split('la ' || en, '(')[1])), '\S+'), -1) AS w))")
_line_query("i12_repair_extraction", lambda c: T.repair_extraction(c), r"regexp_replace(en, '(ffi|ffl|fi|fl) ([a-z])', '\1\2', 'g')")
_line_query("c14_accent_colour", lambda c: T.accent_colour(F.least(F.length(c), F.lit(255)) * 65536 + 8224), "greatest(least(length(en), 255), 32) - least(length(en), 32) > 40 AND greatest(least(length(en), 255), 32) > 90")
_line_query("f19_balanced", T.balanced, "coalesce(list_reduce(list_transform(regexp_extract_all(en, '[*]{1,3}'), lambda x: CASE length(x) WHEN 3 THEN 3 WHEN 2 THEN 1 ELSE 2 END), lambda a, b: xor(a, b), 0), 0) = 0")
_line_query("i28_close_markup", lambda c: T.close_markup(F.concat(F.lit("**"), c, F.lit(" "))), "CASE coalesce(list_reduce(list_transform(regexp_extract_all('**' || en, '[*]{1,3}'), lambda x: CASE length(x) WHEN 3 THEN 3 WHEN 2 THEN 1 ELSE 2 END), lambda a, b: xor(a, b), 0), 0) WHEN 0 THEN '**' || en || ' ' WHEN 1 THEN rtrim('**' || en) || '**' WHEN 2 THEN rtrim('**' || en) || '*' ELSE rtrim('**' || en) || '***' END")


_line_query("i20_longest_alternative", T.longest_alternative, r"regexp_replace(regexp_replace(list_sort(list_transform(regexp_split_to_array(en, '\s*/\s*|\s*\(\s*'), lambda p, i: {'n': -length(p), 'i': i, 'p': p}))[1].p, '^[ )]+|[ )]+$', '', 'g'), '(?i)^(el|la|los|las|un|una)\s+', '')")
_line_query("i49_stable_id", lambda c: shape.stable_id(c, F.lit("k")), "substring(sha256(en || chr(31) || 'k'), 1, 16)")
_line_query("i24_links", lambda c: _list(linter.links(F.concat(F.lit("see [a](x/"), F.substring(c, 1, 3), F.lit(") and [b](y) "), c))), r"array_to_string(regexp_extract_all('see [a](x/' || substring(en, 1, 3) || ') and [b](y) ' || en, '\]\(([^)]+)\)', 1), ',')")


@query("i40_hashes", "SELECT sha256(text) AS sha256, strlen(text) AS size_bytes, '' || doc_id AS path FROM documents WHERE strlen(text) IN (SELECT strlen(text) FROM documents WHERE text <> '' GROUP BY 1 HAVING count(*) > 1)")
def hashes(spark, sf_dir):
    d = R.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.octet_length("text").cast("long").alias("size_bytes"), F.col("text").alias("content"))
    return audit.duplicate_members(d)


_WRAPPED = f"""WITH RECURSIVE {R.LINES}, w AS (SELECT page, block, i, len(ws) AS n, length(ws[i]) + 1 AS size FROM (SELECT page, block, ws, unnest(generate_series(1, len(ws))) AS i FROM (SELECT page, block, regexp_extract_all(regexp_replace(en, '\\*', '', 'g'), '\\S+') AS ws FROM lines))),
  r AS (SELECT page, block, i, n, size AS reach, 1 AS lines FROM w WHERE i = 1 UNION ALL SELECT w.page, w.block, w.i, w.n, CASE WHEN r.reach + w.size > 40 THEN w.size ELSE r.reach + w.size END, r.lines + CASE WHEN r.reach + w.size > 40 THEN 1 ELSE 0 END FROM r JOIN w ON w.page = r.page AND w.block = r.block AND w.i = r.i + 1)
  SELECT page, block, lines AS value FROM r WHERE i = n"""


@query("f21_wrapped_lines", _WRAPPED)
def wrapped_lines(spark, sf_dir):
    return R.lines(spark, sf_dir).select("page", "block", folds.wrapped_lines(F.col("en"), F.lit(40.0)).alias("value")).filter("value > 0")


@query("n5_dice_and_numbers", f"WITH {R.LINES} SELECT page, block, coalesce(array_to_string(list_sort({BAG.replace('COLUMN', 'en')}), ','), '') AS value FROM (SELECT page, block, en || CASE block % 3 WHEN 0 THEN ' ld4 d8 2,500' WHEN 1 THEN ' 3d6 Id10 12’000' ELSE '' END AS en FROM lines)")
def dice_and_numbers(spark, sf_dir):
    k = F.col("block") % 3
    more = F.when(k == 0, " ld4 d8 2,500").when(k == 1, " 3d6 Id10 12’000").otherwise("")
    return R.lines(spark, sf_dir).select("page", "block", _list(T.dice_and_numbers(F.concat("en", more))).alias("value"))


@query("i26_ocr_noise", f"WITH {R.LINES} SELECT page, block, len(regexp_extract_all(en, '[|¬~^`]|[a-z]\\d[a-z]')) + len(list_filter(regexp_split_to_array(en, '[^\\p{{L}}\\p{{N}}_]+'), lambda x: regexp_matches(x, '^[Il1]{{2,}}$'))) AS noise FROM (SELECT page, block, en || CASE WHEN block % 2 = 0 THEN ' ~ a1b II Il1' ELSE '' END AS en FROM lines)")
def ocr_noise(spark, sf_dir):
    more = F.when(F.col("block") % 2 == 0, " ~ a1b II Il1").otherwise("")
    return R.lines(spark, sf_dir).select("page", "block", T.ocr_noise(F.concat("en", more)).alias("noise"))


@query("i29_contexts", f"WITH {R.LINES}, g AS (SELECT page, block, en, string_split(en, 'the') AS g FROM lines WHERE contains(en, 'the')), m AS (SELECT page, block, en, i, length(array_to_string(g[1:i], 'the')) AS s FROM (SELECT *, unnest(generate_series(1, len(g) - 1)) AS i FROM g)) SELECT page, block, i::INTEGER - 1 AS place, substring(en, greatest(0, s - 35) + 1, s + 38 - greatest(0, s - 35)) AS snippet FROM m")
def contexts(spark, sf_dir):
    return R.lines(spark, sf_dir).select("page", "block", F.posexplode(T.context_snippets(F.col("en"), "the")).alias("place", "snippet"))


@query("f18_remove_echo")
def remove_echo(spark, sf_dir):
    return R.lines(spark, sf_dir).select("page", "block", folds.remove_echo(F.concat_ws(" ", "en", "en", F.when(F.col("block") % 2 == 0, F.substring("en", 1, 15)))).alias("text"))


@query("i3_nfc", f"WITH {R.LINES} SELECT page, block, nfc_normalize(en) AS text FROM lines")
def nfc(spark, sf_dir):
    return R.lines(spark, sf_dir).select("page", "block", folds.nfc(F.col("en")).alias("text"))


@query("d17_map_terms", f"WITH {R.LINES} SELECT page, block, regexp_replace(trim(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(en, '(?i)\\bthat\\b', 'eso', 'g'), '(?i)\\bthe\\b', 'la', 'g'), 'ft.', 'pies'), 'ft', 'pies'), ' pies.', ' pies'), 'Str', 'Fue'), 'Dex', 'Des'), 'Wis', 'Sab'), 'Cha', 'Car')), '\\.+$', '') AS text FROM lines")
def map_terms(spark, sf_dir):
    # plain words: Spark's word border knows all letters, so lines are limited to what both engines split alike
    return R.lines(spark, sf_dir).select("page", "block", T.map_terms(F.col("en"), {"the": "la", "that": "eso"}).alias("text"))


@query("k10_replace_in_order", f"WITH {R.LINES} SELECT page, block, replace(replace(en, 'the', 'an'), 'an', 'on') AS text FROM lines")
def replace_in_order(spark, sf_dir):
    return R.lines(spark, sf_dir).select("page", "block", T.replace_in_order(F.col("en"), [("the", "an"), ("an", "on")]).alias("text"))


@query("i5_join_broken", "SELECT doc_id, regexp_replace(replace(text, chr(10), chr(10) || chr(10)), '([a-záéíóúñ,;])\\n\\n([a-záéíóúñ])', '\\1 \\2', 'g') AS text FROM documents")
def join_broken(spark, sf_dir):
    return R.table(spark, sf_dir, "documents").select("doc_id", T.join_broken(F.replace("text", F.lit("\n"), F.lit("\n\n"))).alias("text"))


@query("stopword_counts", "SELECT doc_id, len(regexp_extract_all(replace(' ' || text || ' ', ' ', '  '), '(?i)[^\\p{L}\\p{N}_](" + "|".join(fixed.ALIGN_STOPWORDS) + ")[^\\p{L}\\p{N}_]')) AS n FROM (SELECT doc_id, regexp_replace(text, '([^\\p{L}\\p{N}_])', '\\1\\1', 'g') AS text FROM documents)")
def stopword_counts(spark, sf_dir):
    return R.table(spark, sf_dir, "documents").select("doc_id", F.size(T.stopwords_found(F.col("text"), fixed.ALIGN_STOPWORDS)).alias("n"))
