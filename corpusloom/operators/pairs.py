"""Source and target blocks joined by page and block, with the meaning of missing and null values kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Options of a control record that have a meaning here, with their types.
OPTIONS = (("t", "string"), ("type", "string"), ("dropcap", "string"), ("extiende", "string"), ("size", "double"), ("caja", "array<double>"), ("lineas", "int"), ("centrado", "boolean"), ("alin", "string"))


def option(record: Column, path: str, kind: str) -> Column:
    """A value inside an open record (VARIANT) by its path; null where it is missing or of another kind."""
    return F.try_variant_get(record, path, kind)


def values(translations: DataFrame, json_col: str = "value") -> DataFrame:
    """Normalise (page, block, value JSON text) to (page, block, kind, t, opts, record).

    kind: ``keep`` for null, ``erase`` for "~", ``text`` for a string, ``control`` for an object with its text and
    options. ``opts`` holds the known options, ``record`` (VARIANT) the whole object, whatever keys it has, at any depth.
    An option of another type than its own is null; text that is no JSON is taken as it stands. A block without a row is
    absent: joins leave its kind null.
    """
    v = F.col(json_col)
    is_object, is_null = F.trim(v).startswith("{"), v.isNull() | (F.trim(v) == "null")
    plain = F.when(F.trim(v).startswith('"'), F.get_json_object(F.concat(F.lit('{"x":'), v, F.lit("}")), "$.x")).otherwise(v)
    record = F.when(is_object, F.try_parse_json(v))
    read = translations.select("page", "block", v.alias("_v"), is_object.alias("_object"), is_null.alias("_null"), plain.alias("_plain"), record.alias("record"))
    opts = F.struct(*[option(F.col("record"), f"$.{name}", kind).alias(name) for name, kind in OPTIONS])
    kind = F.when(F.col("_null"), "keep").when(F.col("_object"), "control").when(F.col("_plain") == "~", "erase").otherwise("text")
    t = F.when(F.col("_object"), option(F.col("record"), "$.t", "string")).when(F.col("_null"), None).otherwise(F.col("_plain"))
    return read.select("page", "block", kind.alias("kind"), t.alias("t"), F.when(F.col("_object"), opts).alias("opts"), "record")


def blocks_and_phrases(blocks: DataFrame, phrases: DataFrame) -> DataFrame:
    """(page, block, source) of text blocks and table phrases together."""
    return blocks.select("page", "block", "source").unionByName(phrases.select("page", "block", "source"))


def joined(source: DataFrame, target: DataFrame, overrides: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """(page, block, source, kind, t, opts, and record where there is one); ``overrides`` (page, block) are left out. ``left`` keeps absent blocks."""
    t = target.select(F.col("page").alias("_p"), F.col("block").alias("_b"), "kind", "t", "opts", *[c for c in ("record",) if c in target.columns])
    out = source.join(t, (F.col("page") == F.col("_p")) & (F.col("block") == F.col("_b")), how).drop("_p", "_b")
    return without(out, overrides) if overrides is not None else out


def without(rows: DataFrame, overrides: DataFrame) -> DataFrame:
    """Rows whose (page, block) no override names."""
    o = overrides.select(F.col("page").alias("_op"), F.col("block").alias("_ob"))
    return rows.join(o, (F.col("page").cast("string") == F.col("_op").cast("string")) & (F.col("block") == F.col("_ob")), "left_anti")


def dispatch(pairs: DataFrame) -> DataFrame:
    """What composing does with each block: keep, erase, replace or replace with options, and the box it uses.

    ``pairs`` has kind, t, opts and the block's own box and size; options override them.
    """
    action = F.when(F.col("kind").isNull() | (F.col("kind") == "keep"), "keep").when(F.col("kind") == "erase", "erase").when(F.coalesce(F.trim("t"), F.lit("")) == "", "keep").when(F.col("kind") == "control", "replace with options").otherwise("replace")
    return pairs.withColumn("action", action).withColumn("box", F.coalesce(F.col("opts.caja"), F.col("box"))).withColumn("size", F.coalesce(F.col("opts.size"), F.col("size")))


def missing_keys(wanted: DataFrame, returned: DataFrame, key: str) -> DataFrame:
    """Keys that were asked for and not returned, or returned empty."""
    good = returned.filter(F.trim(F.coalesce("t", F.lit(""))) != "").select(F.col(key).alias("_k"))
    return wanted.join(good, F.col(key) == F.col("_k"), "left_anti")


def cap_size(opts: Column, t: Column, limit: float) -> Column:
    """The size a failing block gets: ``limit`` where it has none or a larger one, else its own."""
    return F.when(t.isNull() | (t == "~"), opts.getField("size")).otherwise(F.least(F.coalesce(opts.getField("size"), F.lit(99.0)), F.lit(float(limit))))
