"""File audit: inventory columns, exact duplicates, root summaries, system files, ownership routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..sources import opened
from ..sources import shared as shared_tables
from . import joins, ranking

#: Shared sizes that may be broadcast; bytes of a file that are hashed at a time.
SIZES, CHUNK = 1_000_000, 1 << 20


def extension_of(path: Column) -> Column:
    """Lower-cased last suffix; a name whose only dot is its first character, or its last, has none."""
    suffix = F.lower(F.regexp_extract(path, r"[^/.][^/]*(\.[^./]+)$", 1))
    return F.coalesce(F.nullif(suffix, F.lit("")), F.lit("[no extension]"))


def is_system_file(path: Column) -> Column:
    """True where any part of the path is a desktop-metadata name."""
    return F.exists(F.split(path, "/"), lambda part: (part == ".DS_Store") | part.startswith("._"))


def inventory(files: DataFrame, include_system: bool = False) -> DataFrame:
    """(root, relative_path, path, size_bytes, extension) of files with root, relative_path, path and size_bytes."""
    kept = files if include_system else files.filter(~is_system_file(F.col("relative_path")))
    return kept.select("root", "relative_path", "path", F.col("size_bytes").cast("long"), extension_of(F.col("relative_path")).alias("extension"))


def duplicate_members(files: DataFrame) -> DataFrame:
    """(sha256, size_bytes, path) of every non-zero file whose size another file shares.

    ``files`` has path, size_bytes and content. Sizes are counted first, without contents. Where few are shared they are
    broadcast and only files of these are read and hashed; where too many are, every file is hashed in place, and the
    hashes meet the shared sizes in a shuffle. The rows are the same, and contents are moved in neither case.
    """
    some = files.filter("size_bytes > 0")
    shared = some.groupBy(F.col("size_bytes").alias("_size")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_size")
    hashed = lambda df: df.select(F.sha2(F.col("content").cast("binary"), 256).alias("sha256"), "size_bytes", "path")
    on = F.col("size_bytes") == F.col("_size")
    if joins.is_small(shared, SIZES):
        return hashed(some.join(F.broadcast(shared), on, "left_semi"))
    return hashed(some).join(shared.hint("merge"), on, "left_semi")


def cascade(files: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(path, size_bytes, sha256, bytes_read, error) of files that may have copies, a written table.

    ``files`` has path and size_bytes; contents are read by the tasks, a chunk at a time, so a file may be of any size.
    Files of a size of their own aren't opened. Of the others the first chunk is hashed, and only those that share it
    with a file of their size are read to the end; the rest has no ``sha256``. A file that can't be read has an ``error``.
    """
    some = files.select("path", F.col("size_bytes").cast("long")).filter("size_bytes > 0")
    sizes = some.groupBy(F.col("size_bytes").alias("_size")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_size")
    shared = joins.looked_up(some, sizes, F.col("size_bytes") == F.col("_size"), "left_semi", SIZES)
    first = shared_tables.written(opened.digests(shared, chunk, chunk), "heads")
    heads = first.filter("error IS NULL").groupBy(F.col("size_bytes").alias("_size"), F.col("digest").alias("_head")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_size", "_head")
    both = joins.looked_up(first, heads.withColumn("_again", F.lit(True)), (F.col("size_bytes") == F.col("_size")) & (F.col("digest") == F.col("_head"))).drop("_size", "_head")
    again = F.coalesce("_again", F.lit(False))
    out = lambda df, sha, read: df.select("path", "size_bytes", sha.alias("sha256"), read.alias("bytes_read"), "error")
    done = out(both.filter(~again | (F.col("size_bytes") <= chunk)), F.when(again, F.col("digest")), F.col("bytes_read"))
    longer = both.filter(again & (F.col("size_bytes") > chunk)).select("path", "size_bytes", F.col("bytes_read").alias("_read"))
    whole = opened.digests(longer, chunk)
    return shared_tables.written(done.unionByName(out(whole, F.col("digest"), F.col("bytes_read") + F.col("_read"))), "hashed")


def copies(members: DataFrame) -> DataFrame:
    """(sha256, size_bytes, copies, path) of every file with a hash that another has: a group's members as rows."""
    same = members.filter("sha256 IS NOT NULL").groupBy(F.col("size_bytes").alias("_size"), F.col("sha256").alias("_sha")).agg(F.count("*").alias("copies")).filter("copies > 1")
    return joins.looked_up(members, same, (F.col("size_bytes") == F.col("_size")) & (F.col("sha256") == F.col("_sha")), "inner").select("sha256", "size_bytes", "copies", "path")


def duplicate_groups(files: DataFrame) -> DataFrame:
    """(sha256, size_bytes, copies, files): files of the same non-zero size and content, paths in order.

    A group's paths are one list here; :func:`duplicate_members` has them as rows, for copies without number.
    """
    groups = duplicate_members(files).groupBy("size_bytes", "sha256").agg(F.count("*").alias("copies"), F.sort_array(F.collect_list("path")).alias("files"))
    return groups.filter("copies > 1").select("sha256", "size_bytes", "copies", "files")


def in_order(groups: DataFrame) -> DataFrame:
    """Groups of identical files with their place in order of size, then of hash."""
    return ranking.placed(groups, ["size_bytes", "sha256"], "place")


def extension_counts(files: DataFrame) -> DataFrame:
    """(root, extension, file_count)."""
    return files.groupBy("root", "extension").agg(F.count("*").alias("file_count"))


def root_summary(files: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """(root, file_count, total_bytes, extensions[, system_files_excluded]); extensions is an ordered map."""
    by_extension = files.groupBy("root", "extension").agg(F.count("*").alias("n"), F.sum("size_bytes").alias("bytes"))
    out = by_extension.groupBy("root").agg(F.sum("n").alias("file_count"), F.sum("bytes").alias("total_bytes"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("extension", "n")))).alias("extensions"))
    if excluded is None:
        return out
    counted = excluded.groupBy(F.col("root").alias("r")).agg(F.count("*").alias("system_files_excluded"))
    return out.join(counted, F.col("root") == F.col("r"), "left").select("root", "file_count", "total_bytes", F.coalesce("system_files_excluded", F.lit(0)).alias("system_files_excluded"), "extensions")


def totals(files: DataFrame) -> DataFrame:
    """Counts and bytes of every root and, with a null root, of all."""
    return files.rollup("root").agg(F.count("*").alias("file_count"), F.sum("size_bytes").alias("total_bytes"))


def ownership(spark: SparkSession) -> DataFrame:
    """(content, home): where each kind of content belongs."""
    return spark.createDataFrame(list(fixed.OWNERSHIP), "content string, home string")


def route(items: DataFrame, content_col: str = "content") -> DataFrame:
    """Items with their home; a kind that the table lacks has none and needs review."""
    homes = F.broadcast(ownership(items.sparkSession).select(F.col("content").alias("_kind"), "home"))  # ten rows
    return items.join(homes, F.col(content_col) == F.col("_kind"), "left").drop("_kind").withColumn("action", F.when(F.col("home").isNull(), "needs review").otherwise("move"))


def manifest(items: DataFrame) -> DataFrame:
    """(source, destination, action, confidence, reason, hash): what is to be done with every item, before anything is.

    ``items``: path, content (its kind or null), confirmed (whether it belongs to the library; null: unknown), library
    (its owner or null), canonical (the path of which it is a byte-identical copy, or null), sha256. What doesn't
    belong stays where it is; a copy goes once its original is named; sources go to their owner's archive; what
    belongs and has a known home moves there; the rest waits in the inbox.
    """
    r = route(items)
    action = (
        F.when(F.col("confirmed") == F.lit(False), "leave in source")
        .when(F.col("confirmed").isNull(), "needs review")
        .when(F.col("canonical").isNotNull(), "trash exact duplicate")
        .when((F.col("content") == fixed.SOURCE_KIND) & F.col("library").isNotNull(), "archive")
        .when(F.col("home").isNotNull() & (~_owned() | F.col("library").isNotNull()), "move")
        .otherwise("needs review")
    )
    planned = r.withColumn("action", action)
    inside = F.when(_owned(), F.concat_ws("/", "library", F.element_at(F.filter(F.split("home", "`"), lambda p: F.length(p) > 0), -1))).otherwise(F.col("home"))
    inside = F.when(F.col("home").isin("Owning game or setting", "Same adventure package"), F.col("library")).otherwise(inside)
    review = F.when(F.col("confirmed"), F.lit(fixed.INBOX_UNASSIGNED)).otherwise(F.lit(fixed.INBOX_REVIEW))
    destination = F.when(F.col("action").isin("move", "archive"), inside).when(F.col("action") == "trash exact duplicate", F.col("canonical")).when(F.col("action") == "needs review", review)
    confidence = F.when(F.col("action") == "trash exact duplicate", "exact").when(F.col("action") == "needs review", "uncertain").otherwise("clear")
    reason = F.coalesce(F.when(F.col("action") == "trash exact duplicate", F.lit("same SHA-256")), F.when(F.col("action") == "leave in source", F.lit("out of scope")), F.col("content"), F.lit("unknown content"))
    return planned.select(F.col("path").alias("source"), destination.alias("destination"), "action", confidence.alias("confidence"), reason.alias("reason"), F.col("sha256").alias("hash"))


def _owned() -> Column:
    """Homes within a library that must be known."""
    return F.col("home").rlike("^(Owning|Same adventure)")
