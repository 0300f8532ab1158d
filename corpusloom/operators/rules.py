"""Ordered rewriting rules with counts, and ledgers of what they changed."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import rx


def to_java(replacement: str) -> str:
    """A replacement text with ``\\1`` groups, as Java writes it."""
    out = replacement.replace("$", r"\$")
    return re.sub(r"\\(\d)", r"$\1", out.replace("\\\\", "\\\\\\\\")) if "\\" in out.replace(r"\$", "") else out


def compiles(spark: SparkSession, pattern: str) -> bool:
    """Whether the JVM can compile a user's pattern."""
    try:
        spark._jvm.java.util.regex.Pattern.compile(rx(pattern))
    except Exception:  # noqa: BLE001  py4j wraps PatternSyntaxException
        return False
    return True


def parse(lines: list[str], spark: SparkSession) -> tuple[list[tuple[str, str, str]], list[str]]:
    """Rules (pattern, replacement, reason) from tab-separated lines, and the patterns that don't compile.

    Blank lines, comments and the heading are skipped.
    """
    rules, bad = [], []
    for line in lines:
        if not line.strip() or line.startswith("#") or line.startswith("patrón"):
            continue
        cells = line.split("\t")
        if len(cells) >= 2:
            if compiles(spark, cells[0]):
                rules.append((cells[0], cells[1], cells[2] if len(cells) > 2 else ""))
            else:
                bad.append(cells[0])
    return rules, bad


def rewrite(text: Column, rules) -> Column:
    """All rules in order, each on what the one before left."""
    for pattern, replacement, *_ in rules:
        text = F.regexp_replace(text, rx(pattern), to_java(replacement))
    return text


def steps(text: Column, rules) -> Column:
    """Array of the text before the first rule and after each rule."""
    start = F.array(text)
    literal = [F.struct(F.lit(rx(p)).alias("p"), F.lit(to_java(r)).alias("r")) for p, r, *_ in rules]
    return F.aggregate(F.array(*literal), start, lambda done, rule: F.concat(done, F.array(F.regexp_replace(F.element_at(done, -1), rule.getField("p"), rule.getField("r"))))) if literal else start


def apply(rows: DataFrame, text_col: str, rules) -> DataFrame:
    """Rows with the rewritten text and ``changed``."""
    new = rewrite(F.col(text_col), rules)
    return rows.withColumn("changed", F.coalesce(new != F.col(text_col), F.lit(False))).withColumn(text_col, new)


def hits(rows: DataFrame, text_col: str, rules) -> DataFrame:
    """(pattern, rows): how many rows each rule changes, after the rules before it."""
    done = rows.select(steps(F.col(text_col), rules).alias("s"))
    sums = [F.sum((F.col("s")[i + 1] != F.col("s")[i]).cast("long")).alias(f"r{i}") for i in range(len(rules))]
    flat = done.agg(*sums).select(F.explode(F.array(*[F.struct(F.lit(p).alias("pattern"), F.coalesce(F.col(f"r{i}"), F.lit(0)).alias("rows")) for i, (p, *_) in enumerate(rules)])).alias("x"))
    return flat.select("x.pattern", "x.rows").groupBy("pattern").agg(F.sum("rows").alias("rows"))


def apply_once(text: Column, old: str, new: str) -> Column:
    """A literal correction that isn't applied where its result already stands."""
    return F.when(text.contains(new), text).otherwise(F.replace(text, F.lit(old), F.lit(new)))
