"""Readers of the files that the operators work on."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from .opened import located

LINES = "page long, page_w double, page_h double, t string, x double, y double, w double, h double, c double, type string, col string"


def _local(root: str) -> str | None:
    """The folder of a path on this machine's own file system, null for other schemes."""
    path = root.removeprefix("file://").removeprefix("file:")
    return None if "://" in path else path


def _walk(root: str) -> Iterator[tuple[str, int]]:
    """Files below a local folder with their sizes; links to files and folders are left out, and what can't be read."""
    waiting = [root]
    while waiting:
        try:
            found = list(os.scandir(waiting.pop()))
        except OSError:
            continue
        for e in found:
            try:
                if e.is_dir(follow_symlinks=False):
                    waiting.append(e.path)
                elif e.is_file(follow_symlinks=False):
                    yield e.path, e.stat(follow_symlinks=False).st_size
            except OSError:
                continue


def _listed(fs, base: str, recursive: bool) -> tuple[list[tuple[str, int]], list[str]]:
    """Files with sizes, and folders, that a file system of Arrow finds."""
    from pyarrow.fs import FileSelector, FileType

    found = fs.get_file_info(FileSelector(base, recursive=recursive))
    return [(f.path, f.size) for f in found if f.type == FileType.File], [f.path for f in found if f.type == FileType.Directory]


def files(spark: SparkSession, root: str, spread: int = 64) -> DataFrame:
    """(root, relative_path, path, size_bytes) of all files below a folder; contents aren't read.

    A local folder is walked here, without symbolic links. In a store that Arrow knows, folders are listed here until
    there are ``spread`` of them, which tasks then list in parallel. Other stores are listed by Hadoop, on the driver.
    Spark's own reader would leave out empty files and names with a leading dot or underscore.
    """
    schema = "path string, size_bytes long"
    if (folder := _local(root)) is not None:
        base = os.path.normpath(folder)
        found = spark.createDataFrame(list(_walk(base)), schema)
    else:
        from pyarrow.fs import FileSystem

        try:
            fs, base = FileSystem.from_uri(root)
        except Exception:  # noqa: BLE001  a scheme or library that Arrow lacks
            return _hadoop_files(spark, root)
        here, level = [], [base]
        while level and len(level) < spread:
            parts = [_listed(fs, folder, False) for folder in level]
            here += [f for found, _ in parts for f in found]
            level = [d for _, below in parts for d in below]

        def run(batches):
            own, _ = FileSystem.from_uri(root)
            for batch in batches:
                for folder in batch.column(0).to_pylist():
                    found, _ = _listed(own, folder, True)
                    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], ["path", "size_bytes"])

        found = spark.createDataFrame(here, schema)
        if level:
            found = found.unionByName(spark.createDataFrame([(d,) for d in level], "folder string").repartition(len(level)).mapInArrow(run, schema))
    return found.select(F.lit(root.rstrip("/")).alias("root"), F.substring("path", F.lit(len(base) + 2), F.length("path")).alias("relative_path"), "path", "size_bytes")


def _hadoop_files(spark: SparkSession, root: str) -> DataFrame:
    base = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    top = fs.resolvePath(base).toString().rstrip("/")
    listed, found = fs.listFiles(base, True), []
    while listed.hasNext():
        status = listed.next()
        path = status.getPath().toString()
        found.append((root.rstrip("/"), path.removeprefix(top).lstrip("/"), path, status.getLen()))
    return spark.createDataFrame(found, "root string, relative_path string, path string, size_bytes long")


def contents(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, size_bytes, content binary)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", F.col("length").alias("size_bytes"), "content")


def whole_texts(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, text): one row per file."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def documented_folders(spark: SparkSession, root: str, name: str = "SKILL.md") -> DataFrame:
    """(folder, content, front_matter) of every folder with a file of that name."""
    t = whole_texts(spark, root, name)
    return t.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.col("text").alias("content"), T.front_matter(F.col("text")).alias("front_matter"))


def page_number(path, digits: int = 3):
    """The page of a file named ``pag-NNN``; null for other names."""
    return F.nullif(F.regexp_extract(path, rf"pag-(\d{{{digits}}})", 1), F.lit("")).cast("int")


def image_page(path):
    """The page of an image named ``pag-NNN-<number>.jpg``; null for other names."""
    return F.nullif(F.regexp_extract(path, r"(?:^|/)pag-(\d{3})-\d+\.jpg$", 1), F.lit("")).cast("int")


def pages_json(spark: SparkSession, path: str, schema: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Page documents (one JSON value per file) with their page; a range of pages may be given."""
    out = spark.read.schema(schema).option("multiLine", "true").json(path).withColumn("_page", page_number(F.col("_metadata.file_name")))
    if first is not None:
        out = out.filter(F.col("_page") >= first)
    if last is not None:
        out = out.filter(F.col("_page") <= last)
    return out.withColumnRenamed("_page", "file_page")


def glossary_raw(spark: SparkSession, path: str) -> DataFrame:
    """(en, es): first two cells of tab-separated rows after the heading; quotes are ordinary, rows without a tab go."""
    rows = spark.read.option("sep", "\t").option("header", "true").option("quote", "").schema("en string, es string").csv(path)
    return rows.filter("es is not null")


def glossary_quoted(spark: SparkSession, path: str) -> DataFrame:
    """(en, es, fuente, nota) of a tab-separated file in which quotes enclose cells."""
    return spark.read.option("sep", "\t").option("header", "true").schema("en string, es string, fuente string, nota string").csv(path)


def overrides(rows: DataFrame, line_col: str = "line") -> DataFrame:
    """(page, block) from lines ``page<TAB>block,block<TAB>reason``."""
    cells = F.split(F.col(line_col), "\t", -1)
    return rows.filter(F.size(cells) >= 2).select(F.trim(cells[0]).alias("page"), F.explode(F.split(cells[1], ",", -1)).alias("block")).select("page", F.trim("block").alias("block"))


def form_feed_pages(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(page, text): pages of extracted texts, from 1, by form feeds; other columns stay."""
    rest = [c for c in texts.columns if c != text_col]
    return texts.select(*rest, F.posexplode(F.split(text_col, "\f", -1)).alias("_n", "text")).select(*rest, (F.col("_n") + 1).alias("page"), "text")


def progress(spark: SparkSession, path: str) -> DataFrame:
    """The progress table of pages."""
    return spark.read.option("header", "true").schema("pdf_page int, ocr string, trad string, fondo string, comp string, v4 string, v5 string").csv(path)


@dataclass
class Project:
    """Settings of a project: a dictionary with defaults, and the folder that it was read from."""

    values: dict[str, Any] = field(default_factory=dict)
    folder: str = "."

    @classmethod
    def load(cls, path: str) -> Project:
        """The settings of a file, on this machine or in a store that Arrow knows; none if it isn't there."""
        if "://" in path:
            from pyarrow.fs import FileType

            fs, at = located(path)
            if fs.get_file_info(at).type != FileType.File:
                return cls({}, path.rpartition("/")[0])
            with fs.open_input_stream(at) as f:
                return cls(json.loads(f.read()), path.rpartition("/")[0])
        p = Path(path)
        return cls(json.loads(p.read_text()) if p.exists() else {}, str(p.parent))

    def get(self, key: str, default: Any = None) -> Any:
        return self.values.get(key, default)

    @property
    def slug(self) -> str:
        return self.get("slug") or "libro-es"

    @property
    def title(self) -> str:
        return self.get("titulo_es") or self.get("titulo", "Libro") + " (ES)"

    @property
    def source(self) -> Path:
        """The document to work on: as configured, or the first one found above the folder, then in it."""
        base, named = Path(self.folder), self.get("pdf_origen")
        if named:
            return Path(named) if Path(named).is_absolute() else (base / named).resolve()
        found = sorted(base.resolve().parent.glob("*.pdf")) + sorted(base.glob("*.pdf"))
        if not found:
            raise FileNotFoundError("no 'pdf_origen' and no document nearby")
        return found[0]

    @property
    def names(self) -> set[str]:
        """Words of proper names, in lower case: what the consistency checks leave alone."""
        return {w.lower() for n in self.get("nombres_propios", []) for w in n.split()}

    @property
    def whole_names(self) -> set[str]:
        """Proper names, in lower case: what the page checks leave alone."""
        return {n.lower() for n in self.get("nombres_propios", [])}

    @property
    def kept_words(self) -> set[str]:
        """Words that may stay in the source's language: connectors, names, and those that extra rules name."""
        rules = [r.replace(",", " ").split() for r in self.get("reglas_extra", []) if "inglés" in r or "ingles" in r]
        return {*fixed.KEPT_WORDS, *self.names, *(w.lower() for words in rules for w in words if w.isalpha() and w[0].isupper())}

    @property
    def fixed_titles(self) -> dict[str, str]:
        """Index titles whose translation is given."""
        return dict(self.get("indice_fijos", {}))

    @property
    def heading_sizes(self) -> dict[str, float]:
        """Font sizes from which headings count, as :func:`shape.heading_level` takes them."""
        f = self.get("foundry", {})
        return {"h1": f.get("h1", 18.0), "h2": f.get("h2", 12.5), "footer": f.get("footer_max", 7.0), "accent": f.get("h1_acento", 11.6)}

    @property
    def sections(self) -> list[tuple[int, str]]:
        return [tuple(s) for s in self.get("secciones", [])]

    @property
    def resource_pairs(self) -> list[tuple[str, str, str, str]]:
        return [tuple(p) for p in self.get("recursos_pares", [["hope", "fear", "esperanza", "miedo"]])]
