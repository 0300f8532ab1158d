"""Relations that the queries work on, derived from the driver's tables alike in Spark and in DuckDB.

The tables hold no page blocks, so lines of documents stand for blocks, with a damaged copy as their translation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import joins


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of short rows dealt over all cores: its file may be one split, and functions of a row cost more than its move."""
    return table(spark, sf_dir, name).repartition(spark.sparkContext.defaultParallelism)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source is the root, language the extension."""
    d = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", F.concat(F.col("doc_id").cast("string"), F.lit("."), "lang"))
    return d.select(F.col("source").alias("root"), path.alias("path"), path.alias("relative_path"), F.octet_length("text").cast("long").alias("size_bytes"), F.concat(F.lit("."), "lang").alias("extension"), F.col("text").alias("content"))


FILES = "files AS (SELECT source AS root, source || '/' || doc_id || '.' || lang AS path, strlen(text) AS size_bytes, '.' || lang AS extension, text AS content FROM documents)"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, block, en): lines of documents, numbered from 0."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), F.posexplode(F.split("text", "\n", -1)).alias("n", "en")).select("page", F.col("n").cast("long").alias("block"), "en")


LINES = "lines AS (SELECT doc_id AS page, CAST(unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS BIGINT) AS block, unnest(string_split(text, chr(10))) AS en FROM documents)"


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, block, en, es): lines with a copy that has one of seven defects, by the number of the line."""
    k, en = F.col("block") % 7, F.col("en")
    es = (
        F.when(k == 0, F.regexp_replace(en, "[0-9]", ""))
        .when(k == 1, F.concat(en, F.lit("**")))
        .when(k == 2, F.substring(en, F.lit(1), F.floor(F.length(en) * 0.4).cast("int")))
        .when(k == 3, F.concat_ws(" ", en, en, en))
        .when(k == 4, F.concat(en, F.lit(" the and with")))
        .when(k == 6, en)
    )
    return lines(spark, sf_dir).withColumn("es", es)


PAIRS = (
    LINES
    + """, pairs AS (SELECT page, block, en, CASE block % 7 WHEN 0 THEN regexp_replace(en, '[0-9]', '', 'g') WHEN 1 THEN en || '**'
    WHEN 2 THEN substring(en, 1, CAST(floor(length(en) * 0.4) AS BIGINT)) WHEN 3 THEN en || ' ' || en || ' ' || en
    WHEN 4 THEN en || ' the and with' WHEN 6 THEN en END AS es FROM lines),
  live AS (SELECT * FROM pairs WHERE es IS NOT NULL AND trim(es) <> '' AND es <> '~'),
  swept AS (SELECT * FROM pairs WHERE NOT regexp_matches(en, '(?i)GM Binder|gmbinder|WIZARDS|©')
    AND length(regexp_replace(en, '[^A-Za-z]', '', 'g')) >= 3 AND length(en) > 2),
  live_swept AS (SELECT * FROM swept WHERE es IS NOT NULL AND trim(es) <> '' AND es <> '~')"""
)


def norm_sql(c: str) -> str:
    """DuckDB's form of the comparable text."""
    return f"lower(trim(regexp_replace(strip_accents(replace(regexp_replace({c}, '‹[^›]*›', '', 'g'), '*', '')), '\\s+', ' ', 'g'), ' '))"


def digits_sql(c: str) -> str:
    return f"list_sort(regexp_extract_all(regexp_replace({c}, '(\\d),(\\d)', '\\1\\2', 'g'), '\\d+'))"


def decimals_sql(c: str) -> str:
    return f"list_sort(regexp_extract_all(regexp_replace({c}, '‹[^›]*›', '', 'g'), '\\d+(?:[.,]\\d+)?'))"


def shown_sql(c: str) -> str:
    return f"'[' || coalesce(array_to_string({c}, ','), '') || ']'"


_BOX_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag")


def boxes(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """(page, id, box, kind, lines): line items as boxes of their order, numbered within it; the return flag stands for a type.

    Without numbers there is no id, and nothing is moved.
    """
    li = table(spark, sf_dir, "lineitem")
    if numbered:
        li = joins.dealt(li, "l_orderkey")
    x, y = F.col("l_quantity"), F.col("l_linenumber") * 10.0
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_BOX_ORDER))
    box = G.rect(x, y, x + F.col("l_discount") * 100 + 1, y + F.col("l_tax") * 100 + 1)
    own = [F.lpad(n.cast("string"), 4, "0").alias("id")] if numbered else []
    return li.select(F.col("l_orderkey").alias("page"), *own, box.alias("box"), F.col("l_returnflag").alias("kind"), F.col("l_linenumber").alias("lines"))


BOXES = f"boxes AS (SELECT l_orderkey AS page, lpad(CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_BOX_ORDER)}) AS VARCHAR), 4, '0') AS id, CAST(l_quantity AS DOUBLE) AS x0, l_linenumber * 10.0::DOUBLE AS y0, l_quantity + l_discount * 100 + 1 AS x1, l_linenumber * 10.0::DOUBLE + l_tax * 100 + 1 AS y1, l_returnflag AS kind, l_linenumber AS lines FROM lineitem)"
