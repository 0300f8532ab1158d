"""Coverage of pages by validated ranges, set arithmetic on pages, and progress tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import rx
from ..sources import shared
from . import joins


def ranges(ledger: DataFrame, line_col: str = "line") -> DataFrame:
    """(first, last) of every readable range in coverage comments; unreadable ones are skipped."""
    body = F.regexp_extract(F.col(line_col), rx(r"^#\s*cobertura\s*:\s*(.+)", "i"), 1)
    piece = ledger.select(F.explode(F.split(body, ",", -1)).alias("p")).select(F.trim("p").alias("p"))
    first = F.expr("try_cast(trim(substring_index(p, '-', 1)) as int)")
    tail = F.when(F.col("p").contains("-"), F.trim(F.regexp_replace("p", "^[^-]*-", ""))).otherwise(F.lit(""))
    last = F.when(tail == "", first).otherwise(tail.try_cast("int"))
    return piece.select(first.alias("first"), last.alias("last")).filter("first is not null and last is not null")


def covered(found: DataFrame) -> DataFrame:
    """(page) of all pages in ranges, once each. A range that ends before it begins has none."""
    return found.filter("first <= last").select(F.explode(F.sequence("first", "last")).alias("page")).distinct()


#: Pages that are compared with ranges together.
BUCKET_PAGES = 1024


def uncovered(pages: DataFrame, found: DataFrame) -> DataFrame:
    """Pages that no range covers.

    Ranges are cut at buckets of pages and joined within each, so pages meet ranges by equality of the bucket and a
    bucket has few of them, however many ranges there are and however wide they are.
    """
    bucket = lambda c: F.floor(c / BUCKET_PAGES).cast("long")
    r = found.filter("first <= last").select(F.col("first").cast("long").alias("_a"), F.col("last").cast("long").alias("_b")).distinct()
    parts = r.select("_a", "_b", F.explode(F.sequence(bucket(F.col("_a")), bucket(F.col("_b")))).alias("_bucket"))
    parts = parts.select("_bucket", F.greatest("_a", F.col("_bucket") * BUCKET_PAGES).alias("_a"), F.least("_b", (F.col("_bucket") + 1) * BUCKET_PAGES - 1).alias("_b")).distinct()
    within = merge(parts, "_a", "_b", ["_bucket"])
    return pages.join(within, (bucket(F.col("page")) == F.col("_bucket")) & F.col("page").between(F.col("start"), F.col("end")), "left_anti")


def merge(intervals: DataFrame, start: str, end: str, by: list[str] | None = None) -> DataFrame:
    """(by, start, end) of joined overlapping or touching ranges of each group."""
    by = by or []
    w = Window.partitionBy(*by).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.withColumn("_new", F.coalesce((F.col(start) > reach + 1).cast("int"), F.lit(1)))
    return marked.withColumn("_group", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*by, "_group").agg(F.min(start).alias("start"), F.max(end).alias("end")).drop("_group")


def gate(pages: DataFrame, ledger: DataFrame, line_col: str = "line", shown: int = 8) -> DataFrame:
    """One row (ok, missing, first_missing, corrections): whether validation covers all pages.

    Corrections count the ledger's rows with a tab that are no comments, a heading included.
    """
    found = ranges(ledger, line_col)
    gone = uncovered(pages.select("page").distinct(), found)
    line = F.col(line_col)
    fixes = ledger.agg(F.count_if((F.trim(line) != "") & ~line.startswith("#") & line.contains("\t")).alias("corrections"))
    few = gone.orderBy("page").limit(shown).agg(F.array_sort(F.collect_list("page")).alias("first_missing"))
    return gone.agg(F.count("*").alias("missing")).crossJoin(few).crossJoin(fixes).crossJoin(found.agg((F.count("*") > 0).alias("declared"))).select((F.col("declared") & (F.col("missing") == 0)).alias("ok"), "missing", "first_missing", "corrections")  # single rows


def gate_defect(verdict: DataFrame) -> DataFrame:
    """The gate's verdict as a defect of page 0; no row if it is passed."""
    return verdict.filter("not ok").select(F.lit(0).cast("long").alias("page"), F.lit("-").alias("block"), F.lit("VALIDACION").alias("kind"), F.concat(F.lit("missing "), "missing", F.lit(" pages: "), F.array_join("first_missing", ",")).alias("detail"))


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that ``right`` lacks, counting repetitions."""
    return left.exceptAll(right)


def remaining(pages: DataFrame, done: DataFrame) -> DataFrame:
    """One row (total, ready, remaining)."""
    d = done.select(F.col("page").alias("_p")).distinct()
    return pages.select("page").distinct().join(d, F.col("page") == F.col("_p"), "left").agg(F.count("*").alias("total"), F.count("_p").alias("ready"), F.count_if(F.col("_p").isNull()).alias("remaining"))


def not_done(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys aren't among those done: what a restarted run still has to do."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def any_of(lists: list[DataFrame]) -> DataFrame:
    """Keys that any of several lists names, once each: what is to be done again."""
    out = lists[0]
    for more in lists[1:]:
        out = out.unionByName(more)
    return out.distinct()


def last_page(pages: DataFrame) -> DataFrame:
    """One row (last): the largest page, 0 without any."""
    return pages.agg(F.coalesce(F.max("page"), F.lit(0)).alias("last"))


def ready_pages(progress: DataFrame) -> DataFrame:
    """Pages that are composed and checked."""
    return progress.filter("comp = 'ok' and v4 = 'ok'").select("pdf_page")


def update_progress(progress: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """The status table with new values of one column; pages it lacks are added."""
    c = changes.groupBy(F.col(key).alias("_k")).agg(F.max(column).alias("_v"))
    out = progress.join(c, F.col(key) == F.col("_k"), "full_outer")
    return out.select(*[F.coalesce(F.col(key), F.col("_k")).alias(key) if n == key else F.coalesce(F.col("_v"), F.col(column)).alias(column) if n == column else F.col(n) for n in progress.columns])


def write_keyed(rows: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """A table that :func:`update_in_place` can change: a folder for each bucket of keys."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    rows.select("*", bucket).repartition(buckets, "bucket").write.partitionBy("bucket").parquet(path)


def update_in_place(spark: SparkSession, path: str, changes: DataFrame, key: str, column: str, schema: str, buckets: int = 64) -> DataFrame:
    """Set ``column`` of the rows of a keyed table that ``changes`` (key, column) names, adding those it lacks.

    Only the buckets of changed keys are read and written anew; Spark swaps them in when all of them are written. The
    same changes again give the same table, so a run that was broken off is begun again. Of several changes of a key the
    largest holds; null keys are left out. Returns the table.
    """
    table = lambda: spark.read.schema(f"{schema}, bucket int").parquet(path)
    own = changes.filter(F.col(key).isNotNull()).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    touched = sorted(r["_bucket"] for r in own.select("_bucket").distinct().collect())  # at most ``buckets``
    if touched:
        new = update_progress(table().filter(F.col("bucket").isin(touched)).drop("bucket"), own.drop("_bucket"), key, column)
        new = shared.written(new, "updated")  # what is read is about to be replaced
        dealt = new.select("*", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")).repartition(len(touched), "bucket")
        dealt.write.partitionBy("bucket").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    return table().drop("bucket")


def shared_misses(lines: DataFrame, glossary: DataFrame, line_col: str = "line") -> DataFrame:
    """(term, wanted, target) of glossary terms that lines of page checks name as missing.

    ``wanted`` is the glossary's own translation without what stands in brackets, or the term where it has none.
    """
    named = lines.select(F.explode(T.glossary_misses(F.col(line_col))).alias("m")).select("m.term", "m.target")
    own = glossary.select(F.lower(F.trim("en")).alias("_en"), F.trim(F.regexp_replace("es", rx(r"\s*\([^)]*\)"), "")).alias("_es")).groupBy("_en").agg(F.max("_es").alias("_es"))
    return joins.looked_up(named, own, F.lower("term") == F.col("_en")).select("term", F.coalesce("_es", "term").alias("wanted"), "target")


def merge_overrides(old: Column, new: Column) -> Column:
    """Maps of overrides together: later values hold, other keys stay."""
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    return F.map_concat(kept, new)


def allow_numbers(failures: DataFrame, overrides: DataFrame) -> DataFrame:
    """(page, flags): pages whose only failures are numbers get ``numeros_ok``, beside the flags they have."""
    only = failures.groupBy("page").agg(F.bool_and(F.col("kind") == "numbers").alias("only")).filter("only").select(F.col("page").alias("_p"))
    flag = F.create_map(F.lit("numeros_ok"), F.lit("true"))
    out = overrides.join(only, F.col("page") == F.col("_p"), "full_outer")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    flags = F.coalesce("flags", empty)
    return out.select(F.coalesce("page", "_p").alias("page"), F.when(F.col("_p").isNotNull(), merge_overrides(flags, flag)).otherwise(flags).alias("flags"))


def cached(wanted: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the cached result, rows that still need one), by source text."""
    c = cache.select(F.col(key).alias("_k"), "result").dropDuplicates(["_k"])
    return wanted.join(c, F.col(key) == F.col("_k")).drop("_k"), wanted.join(c, F.col(key) == F.col("_k"), "left_anti")
