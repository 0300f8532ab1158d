"""Constraints on front matter and links of documented folders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

NAME = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"
LINK = r"\]\(([^)]+)\)"


def links(c):
    """Targets of Markdown links."""
    return T.find_all(c, LINK, 1)


def errors(folders: DataFrame, paths: DataFrame) -> DataFrame:
    """(folder, error) of folders (folder, content; null content: the file is missing), checked against ``paths`` (path)."""
    f = folders.select("folder", "content", T.front_matter(F.coalesce("content", F.lit(""))).alias("fm"))
    name, description = (F.coalesce(F.col("fm")[k], F.lit("")) for k in ("name", "description"))
    base = F.element_at(F.split("folder", "/"), -1)
    present = F.col("content").isNotNull()
    checks = F.array_compact(
        F.array(
            F.when(~present, F.lit("missing file")),
            F.when(present & (name == ""), F.lit("front matter missing 'name'")),
            F.when(present & (description == ""), F.lit("front matter missing 'description'")),
            F.when((name != "") & (name != base), F.concat(F.lit("name '"), name, F.lit("' does not match folder '"), base, F.lit("'"))),
            F.when((name != "") & ~name.rlike(NAME), F.concat(F.lit("name '"), name, F.lit("' must be lowercase hyphen-case"))),
        )
    )
    # outer, as Spark otherwise computes the array again, twice, to leave out rows without an element
    found = f.select("folder", F.explode_outer(checks).alias("error")).filter("error IS NOT NULL")
    wanted = f.filter(present).select("folder", F.explode_outer(links(F.col("content"))).alias("link")).filter(F.col("link").startswith("references/"))
    missing = wanted.withColumn("target", F.concat_ws("/", "folder", "link")).join(paths.select(F.col("path").alias("_path")), F.col("target") == F.col("_path"), "left_anti")
    return found.unionByName(missing.select("folder", F.concat(F.lit("referenced file does not exist: "), F.col("link")).alias("error")))
