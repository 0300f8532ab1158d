"""A table cut into files by day, and the overwriting of those days that late rows change.

A layout keeps the latest-arrived row of each key and cuts each day, in order, into Parquet files of an equal number of
rows. A record index, hash-partitioned by key, says in which day and file each key stands. Late rows reduced to one a key
probe it: one that is newer is tagged with the place of the row it replaces. The days of the tagged rows, old and new,
are dirty: only their files are read again, merged and cut anew, and Spark's dynamic partition overwrite puts them in
place. A key or a day with a third of all rows is no single task's: latest rows are found by partial aggregates, and
rows are numbered within a day by range partitions and running counts of these.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lookup_join, remove, scratch, written

#: Rows that a writing task takes at most, unless a file has more; a task writes whole files.
TASK_ROWS = 500_000


@dataclass
class Columns:
    """Names of the key, of the time that a row is filed under and of that of its arrival."""

    key: str = "sale_id"
    filed: str = "sold_at"
    arrived: str = "arrived_at"


def day_of(df: DataFrame, column: str) -> Column:
    """Whole days since 1970, in UTC; -1 for null."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        day = F.floor(F.unix_micros(column) / F.lit(86_400_000_000)).cast("long")
    else:
        day = F.unix_date(F.col(column).cast("date")).cast("long")
    return F.coalesce(day, F.lit(-1).cast("long"))


def _own(name: str, columns: list[str]) -> str:
    """A column name of our own that none of the table's columns has."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return _orderable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def _order(df: DataFrame, first: list[str]) -> list[str]:
    """``first``, and then all other columns that have an order, so that ties are broken alike in every run."""
    return first + [f.name for f in df.schema.fields if f.name not in first and _orderable(f.dataType)]


def latest(rows: DataFrame, names: Columns) -> DataFrame:
    """The latest-arrived row of each key; of several that arrived at once the one filed latest, then by the other columns.

    Null arrival is the earliest. Rows without a key replace nothing and all stay.
    """
    order = _order(rows, [names.arrived, names.filed])
    one = rows.filter(F.col(names.key).isNotNull()).groupBy(F.col(names.key).alias("_of")).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("_row"))
    return one.select(*[F.col("_row").getField(c).alias(c) for c in rows.columns]).unionByName(rows.filter(F.col(names.key).isNull()))


@dataclass
class Layout:
    """A written layout: its folder, the rows of a file, the schema of its rows and the name of the day in its folders."""

    path: str
    file_rows: int
    schema: T.StructType
    day: str
    names: Columns

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows, with their day."""
        return spark.read.schema(T.StructType([*self.schema.fields, T.StructField(self.day, T.LongType())])).parquet(self.path)

    def files(self, spark: SparkSession) -> DataFrame:
        """(path, day, file_no) of every file, numbered from 0 within its day.

        The list passes the driver. A file has ``file_rows`` rows, so where these follow the number of rows there are no
        more files than that ratio and one a day.
        """
        found = []
        for path in self.read(spark).inputFiles():
            day, task, count = re.search(rf"/{re.escape(self.day)}=(-?\d+)/part-(\d+)-.*\.c(\d+)\.", path).groups()
            found.append((int(day), int(task), int(count), path))
        rows, last = [], None
        for day, _, _, path in sorted(found):
            number = number + 1 if day == last else 0  # noqa: F821
            last = day
            rows.append((path, day, number))
        return spark.createDataFrame(rows, "path string, day long, file_no long")


def _cut(rows: DataFrame, layout: Layout, mode: str) -> None:
    """Write ``rows`` into the days' folders, each day in the order of its time and key, ``file_rows`` rows a file.

    Every task writes whole files that follow each other, so the order of tasks and of a task's files is that of the day.
    """
    spark, day, columns = rows.sparkSession, layout.day, layout.schema.names
    place, part, position, file = (_own(n, [*columns, day]) for n in ("place_", "part_", "position_", "file_"))
    order = [F.asc_nulls_first(c) for c in (day, *_order(rows.select(*columns), [layout.names.filed, layout.names.key]))]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dated = rows.select(*columns, day_of(rows, layout.names.filed).alias(day))
    ranged = written(dated.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn(part, F.shiftright(place, 33)).withColumn(position, F.col(place).bitwiseAND(F.lit((1 << 33) - 1)))
    # rows of each range and day; there are as many of these as ranges and days
    counts = written(ranged.groupBy(F.col(part).alias("p"), F.col(day).alias("d")).agg(F.count("*").alias("rows"), F.min(position).alias("least")), "counts")
    days = counts.groupBy("d").agg(F.ceil(F.sum("rows") / layout.file_rows).cast("long").alias("files"))
    days = written(days.select(F.col("d").alias("of_d"), "files", F.coalesce(F.sum("files").over(Window.orderBy("d").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("files_before")), "days")  # one row a day
    n_files = days.agg(F.sum("files").alias("n")).first()["n"] or 0
    before = F.coalesce(F.sum("rows").over(Window.partitionBy("d").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = written(counts.join(days, F.col("d") == F.col("of_d")).select("p", "d", (before - F.col("least")).alias("shift"), "files_before"), "starts")
    numbered = lookup_join(ranged, starts, (F.col(part) == F.col("p")) & (F.col(day) == F.col("d")), "inner")
    numbered = numbered.withColumn(file, F.col("files_before") + F.expr(f"(`{position}` + shift) div {layout.file_rows}"))
    each = max(1, min(-(-n_files // n), TASK_ROWS // layout.file_rows))
    dealt = numbered.repartitionById(max(1, -(-n_files // each)), F.expr(f"cast(`{file}` div {each} as int)")).sortWithinPartitions(day, file, place)
    out = dealt.select(*columns, day).write.partitionBy(day).option("maxRecordsPerFile", layout.file_rows)
    out.option("partitionOverwriteMode", "dynamic").mode(mode).parquet(layout.path)


def write(rows: DataFrame, file_rows: int, path: str | None = None, names: Columns = Columns()) -> Layout:
    """The layout of ``rows`` under ``path``, a new folder in the shared one unless given. An empty table has no files."""
    layout = Layout(path or scratch(rows.sparkSession, "layout"), file_rows, rows.schema, _own("day", rows.columns), names)
    _cut(latest(rows, names), layout, "append")
    return layout


def index(spark: SparkSession, layout: Layout) -> DataFrame:
    """(key, day, file, arrived) of every row that has a key, from the files, written hash-partitioned by key.

    It is a bucketed table, so what probes it is dealt out in the same way and the index isn't moved again.
    """
    rows = layout.read(spark).select(F.col(layout.names.key).alias("key"), F.col(layout.day).alias("day"), F.col("_metadata.file_name").alias("file"), F.col(layout.names.arrived).alias("arrived"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch(spark, "index")
    name = "corpusloom_" + re.sub(r"\W", "_", path.rpartition("/")[2])
    keyed = rows.filter("key IS NOT NULL").repartition(n, "key")
    keyed.write.bucketBy(n, "key").sortBy("key").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def tag(late: DataFrame, layout: Layout, records: DataFrame) -> DataFrame:
    """The late rows that hold against the layout, a written table, with ``old_day`` and ``old_file``: where the row stands
    that each replaces, null for a new key. One holds unless the indexed row of its key arrived later; null is earliest.
    A key that stands twice, as a run that was broken off may leave it, gives two rows.
    """
    names = layout.names
    old = records.select(F.col("key").alias("_key"), F.col("day").alias("old_day"), F.col("file").alias("old_file"), F.col("arrived").alias("_arrived"))
    won = latest(late.select(*layout.schema.names), names)
    named = won.filter(F.col(names.key).isNotNull()).join(old.hint("merge"), F.col(names.key) == F.col("_key"), "left")
    holds = F.col("_key").isNull() | F.col("_arrived").isNull() | F.coalesce(F.col(names.arrived) >= F.col("_arrived"), F.lit(False))
    others = won.filter(F.col(names.key).isNull()).withColumns({"old_day": F.lit(None).cast("long"), "old_file": F.lit(None).cast("string")})
    return written(named.filter(holds).drop("_key", "_arrived").unionByName(others), "tagged")


def overwrite(spark: SparkSession, layout: Layout, late: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Make the layout that of its own rows and the late ones; returns its files (path, day, file_no, rewritten).

    All files of the days where a tagged row stands, or stood before, are replaced, no others are touched; a day that
    has lost all its rows goes. The changed days' names, at most one a day, pass the driver. A run that was broken off
    is begun again with the same rows: they hold against themselves and against what they had not yet replaced.
    """
    records = index(spark, layout) if records is None else records
    tagged = tag(late, layout, records)
    names, columns = layout.names, layout.schema.names
    began = layout.files(spark).select(F.col("path").alias("old_path"))
    changed = tagged.select(day_of(tagged, names.filed).alias("d")).unionByName(tagged.filter("old_day IS NOT NULL").select(F.col("old_day").alias("d"))).distinct()
    dirty = sorted(r["d"] for r in changed.collect())  # one a day
    if dirty:
        stands = layout.read(spark).filter(F.col(layout.day).isin(dirty)).select(*columns)
        replaced = tagged.filter("old_day IS NOT NULL").select(F.col(names.key).alias("_replaced"))
        kept = stands.filter(F.col(names.key).isNotNull()).join(replaced, F.col(names.key) == F.col("_replaced"), "left_anti")
        merged = kept.unionByName(stands.filter(F.col(names.key).isNull())).unionByName(tagged.filter(F.col(names.key).isNull()).select(*columns))
        merged = merged.unionByName(tagged.filter(F.col(names.key).isNotNull()).dropDuplicates([names.key]).select(*columns))
        merged = written(merged, "merged")
        _cut(merged, layout, "overwrite")
        left = {r["d"] for r in merged.select(day_of(merged, names.filed).alias("d")).distinct().collect()}
        for day in dirty:
            if day not in left:
                remove(spark, f"{layout.path}/{layout.day}={day}")
    return layout.files(spark).join(F.broadcast(began), F.col("path") == F.col("old_path"), "left").select("path", "day", "file_no", F.col("old_path").isNull().alias("rewritten"))


_DIGESTS = "n_rows long, cents long, rows_crc long, columns string, ids_sha256 string"


def digests(files: DataFrame, names: Columns = Columns(), amount: str = "total") -> DataFrame:
    """The columns of ``files`` with what each file holds, read from it batch by batch by one task.

    ``n_rows``; ``cents``, the sum of ``amount`` in hundredths (null and what isn't finite: 0); ``rows_crc``, the sum of
    the checksums of ``key:filed:arrived``; ``columns`` as the file names them; ``ids_sha256`` of the keys in their order.
    """
    own = [(f.name, f.dataType.simpleString()) for f in files.schema.fields]
    text = lambda column: ["" if x is None else str(x) for x in column.to_pylist()]
    micros = lambda column: text(column.cast(pa.timestamp("us", column.type.tz)).cast(pa.int64()))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = pa.fs.FileSystem.from_uri(row["path"])
                n = cents = crc = 0
                ids = hashlib.sha256()
                with fs.open_input_file(path) as f:
                    file = pq.ParquetFile(f)
                    for part in file.iter_batches(10_000, columns=[names.key, names.filed, names.arrived, amount]):
                        keys = text(part.column(names.key))
                        ids.update((("," if n and keys else "") + ",".join(keys)).encode())
                        hundredths = np.floor(100 * part.column(amount).cast(pa.float64()).fill_null(0.0).to_numpy() + 0.5)
                        cents += sum(map(int, hundredths[np.isfinite(hundredths)].tolist()))
                        crc += sum(zlib.crc32(":".join(x).encode()) for x in zip(keys, micros(part.column(names.filed)), micros(part.column(names.arrived))))
                        n += part.num_rows
                    columns = ",".join(file.schema_arrow.names)
                values = [*(row[c] for c, _ in own), n, cents, crc, columns, ids.hexdigest()]
                yield pa.RecordBatch.from_pylist([dict(zip([c for c, _ in own] + [x.split()[0] for x in _DIGESTS.split(", ")], values))], schema=None)

    n = max(1, min(files.count(), int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return files.repartition(n, "path").mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in own) + ", " + _DIGESTS)
