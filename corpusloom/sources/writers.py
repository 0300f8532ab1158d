"""Writers of reports and page documents. Spark's committers write to a temporary place and move whole files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import named


def json_report(df: DataFrame, path: str) -> None:
    """One JSON value per row, keys in order."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def json_text(df: DataFrame) -> DataFrame:
    """(value): rows as JSON text with sorted keys and two spaces of indentation."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"pretty": "true"}).alias("value"))


def pages(df: DataFrame, path: str, key: str = "page") -> None:
    """Replace the pages that ``df`` holds and leave the others."""
    df.repartition(key).write.partitionBy(key).mode("overwrite").option("partitionOverwriteMode", "dynamic").json(path)


def page_files(df: DataFrame, path: str, name: str = "name", text: str = "text") -> None:
    """One file per row under ``path``, named by ``name``; they appear together, or none does (:mod:`named`)."""
    named.write(df, path, name, text)


def table(df: DataFrame, path: str, sep: str = ",") -> None:
    """Rows with a heading."""
    df.write.mode("overwrite").option("header", "true").option("sep", sep).csv(path)


def sectioned(parts: list[tuple[str, DataFrame]], n_col: str, name_col: str) -> DataFrame:
    """(line): sections with headings, each section's rows by falling count, as aligned text, in order."""
    out = None
    for i, (title, rows) in enumerate(parts):
        head = rows.sparkSession.createDataFrame([(i, None, f"== {title} ==")], "section int, n long, line string")
        n = F.col(n_col).cast("string")
        body = rows.select(F.lit(i).alias("section"), F.col(n_col).cast("long").alias("n"), F.concat(F.lpad(n, F.greatest(F.lit(4), F.length(n)), F.lit(" ")), F.lit(" "), F.col(name_col)).alias("line"))
        part = head.unionByName(body)
        out = part if out is None else out.unionByName(part)
    return out.orderBy("section", F.desc_nulls_first("n"), "line").select("line")


def defect_summary(defects: DataFrame) -> DataFrame:
    """(kind, n), the most frequent first."""
    return defects.groupBy("kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind")


def defects(df: DataFrame, path: str) -> None:
    """Defects in order of page and block, separated by tabs."""
    table(df.orderBy("page", "block"), path, "\t")


#: Packs of an export: (name, label, type).
PACKS = (("diarios", "Diarios", "JournalEntry"), ("actores", "Bestiario", "Actor"), ("tablas", "Tablas", "RollTable"), ("escenas", "Mapas", "Scene"))


def module_manifest(name: str, title: str, author: str = "traduccion-personal", system: str | None = None, packs=PACKS, version: str = "0.2.0") -> dict:
    """Manifest of an export with its packs; ``system`` is left out of packs where it is unknown."""
    listed = [{"name": n, "label": f"{title} — {label}", "path": f"packs/{n}", "type": kind} | ({"system": system} if system else {}) for n, label, kind in packs]
    return {
        "id": name,
        "title": f"{title} — Companion (uso personal)",
        "description": "Diarios en español generados del pipeline de traducción personal.",
        "version": version,
        "compatibility": {"minimum": "12", "verified": "14"},
        "authors": [{"name": author}],
        "packs": listed,
    }
