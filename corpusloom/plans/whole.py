"""Queries of text functions over whole texts of documents, and of rules and settings read from files that steer them."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import detectors, rules, shape
from ..sources import named, readers, shared
from . import relations as R
from .defects import _PAGE_WORDS, _PAGES, _pages
from .registry import query


def _documents(spark, sf_dir):
    return R.table(spark, sf_dir, "documents").filter("text IS NOT NULL")


@query("i7_drop_cap_whole")
def drop_cap(spark, sf_dir):
    cut = T.drop_cap(F.col("text"))
    return _documents(spark, sf_dir).select("doc_id", cut.alias("c")).select("doc_id", "c.letter", F.sha2("c.text", 256).alias("text"))


@query("i11_normal_tokens_whole")
def normal_tokens(spark, sf_dir):
    """Documents with style tokens in every third kind of bracket."""
    odd = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", r"\. ", ". « C : 00AAff »".replace("C", "c")), ", ", ", < sc >"), " de ", " ‹ / c› de «/g» ")
    return _documents(spark, sf_dir).select("doc_id", F.sha2(T.normal_tokens(odd), 256).alias("text"))


@query("i15_same_as_source_whole")
def same_as_source(spark, sf_dir):
    """Lines against a copy in capitals with other marks, of which every fifth lacks its end."""
    line = R.lines(spark, sf_dir)
    copy = F.concat(F.lit("«sc»"), F.upper(F.when(F.col("block") % 5 == 0, F.expr("substring(en, 1, length(en) - 3)")).otherwise(F.regexp_replace("en", " ", " - "))), F.lit("«/sc»!"))
    return line.select("page", "block", T.same_as_source(F.concat(F.lit("‹sc›"), "en", F.lit("‹/sc›")), copy).alias("same"))


@query("i17_break_lists_whole")
def break_lists(spark, sf_dir):
    """Documents with check boxes for stops, or with labels before figures."""
    boxes = F.regexp_replace("text", r"\. ", " [ ]  ")
    labels = F.regexp_replace("text", r"\. ", " **Puntos** 3 ")
    return _documents(spark, sf_dir).select("doc_id", F.sha2(T.break_lists(F.when(F.col("doc_id") % 2 == 0, boxes).otherwise(labels)), 256).alias("text"))


@query("d15_align_damage_whole")
def align_damage(spark, sf_dir):
    """Documents with damage for stops: as many kinds as phrases in every second one."""
    en = F.regexp_replace(F.regexp_replace("text", r"\. ", " 3 Fire damage, "), "; ", " 2 cold  damage; ")
    es = F.regexp_replace(F.regexp_replace(F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit(" daño raro"))).otherwise(F.col("text")), r"\. ", " 3 de daño por ígneo, "), "; ", " 2 daño gélido; ")
    return _documents(spark, sf_dir).select("doc_id", F.sha2(T.align_damage(en, es), 256).alias("text"))


#: The regions' names give five rules: their first two letters in words become capitals.
_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
_REWRITTEN = "text"
for _name in _REGIONS:
    _REWRITTEN = f"regexp_replace({_REWRITTEN}, '({_name[:2].lower()})([a-z])', '{_name[:2]}\\2', 'g')"


@query("a7_rules_of_a_file", f"SELECT doc_id, t <> text AS changed, sha256(t) AS text FROM (SELECT doc_id, text, {_REWRITTEN} AS t FROM documents WHERE text IS NOT NULL)")
def rules_of_a_file(spark, sf_dir):
    """A rule file written from the regions, with a heading, a comment and a broken rule, read and applied to all texts."""
    path = shared.scratch(spark, "rules")
    start = F.substring("r_name", 1, 2)
    line = F.concat(F.lit("("), F.lower(start), F.lit(")([a-z])\t"), start, F.lit("\\2\tregion"))
    listed = R.table(spark, sf_dir, "region").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))
    named.write(listed.select(F.lit("rules.tsv").alias("name"), F.concat(F.lit("patrón\treemplazo\n# all\n\n([a\tx\n"), "body").alias("text")), path)
    found, bad = rules.parse(named.read(spark, path).first()["text"].split("\n"), spark)
    if len(bad) != 1:
        raise ValueError(f"rules that don't compile: {bad}")
    return rules.apply(_documents(spark, sf_dir).select("doc_id", "text"), "text", found).select("doc_id", "changed", F.sha2("text", 256).alias("text"))


def _settings(spark, values: dict):
    """A project read from its file in the shared folder."""
    path = shared.scratch(spark, "project")
    named.write(spark.createDataFrame([("project.json", json.dumps(values))], "name string, text string"), path)
    return readers.Project.load(f"{path}/project.json")


@query("a16_names_of_a_project", f"WITH {_PAGES}, w AS (SELECT page, unnest(regexp_extract_all(lower(es), '[a-zA-Z'']{{3,}}')) AS word FROM two), k AS (SELECT page, word, count(*) AS n FROM w WHERE list_contains({_PAGE_WORDS}, word) AND word NOT IN ('with', 'and') GROUP BY 1, 2) SELECT page, word, n FROM k WHERE page IN (SELECT page FROM k GROUP BY 1 HAVING sum(n) > 1)")
def project_names(spark, sf_dir):
    """Names of a project's file are left alone by the check of all pages."""
    p = _settings(spark, {"nombres_propios": ["With", "And"]})
    return detectors.page_english(_pages(spark, sf_dir), names=p.whole_names)


@query("a16_heading_sizes_of_a_project", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN q <= 5 THEN 'footer' WHEN q >= 40 AND l_linenumber <= 3 THEN 'h1' WHEN l_returnflag <> 'A' AND l_linenumber <= 2 AND q >= 28 THEN 'h2' ELSE 'cuerpo' END AS level FROM (SELECT *, l_quantity AS q FROM lineitem)")
def project_sizes(spark, sf_dir):
    """Font sizes of a project's file decide on the headings of all lines."""
    sizes = _settings(spark, {"foundry": {"h1": 40.0, "h2": 30.0, "footer_max": 5.0, "h1_acento": 99.0}}).heading_sizes
    li = R.table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_returnflag") != "A", "HEADING").otherwise("Heading")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shape.heading_level(text, F.col("l_quantity"), F.lit(0), F.col("l_linenumber"), **sizes).alias("level"))
