"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where it is unset a temporary folder takes its place, on a single machine only: executors elsewhere wouldn't see it.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir") or spark.conf.get("corpusloom.shared.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("corpusloom.shared.dir", path)
    return path.rstrip("/")


def session_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/corpusloom/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path through Hadoop's file system, whatever its scheme."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Lists of the blocks that record written tables, innermost last; each thread has its own.
_RECORDS: ContextVar[tuple[list[str], ...]] = ContextVar("corpusloom_records", default=())


@contextmanager
def recorded():
    """The paths of the tables that this thread writes inside."""
    paths: list[str] = []
    before = _RECORDS.set((*_RECORDS.get(), paths))
    try:
        yield paths
    finally:
        _RECORDS.reset(before)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, through Hadoop's file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage durably.

    :func:`forget` deletes such a table once nothing reads it any more, :func:`clean` all of them.
    """
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    for paths in _RECORDS.get():
        paths.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._corpusloom_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete the files of written tables that nothing reads any more."""
    for t in tables:
        if path := t.__dict__.get("_corpusloom_path"):
            remove(t.sparkSession, path)


def clean(spark: SparkSession) -> None:
    """Delete all that this application has written to the shared folder; results that still read it are lost."""
    remove(spark, session_dir(spark))
