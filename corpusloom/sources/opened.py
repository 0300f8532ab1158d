"""Files as tasks open them, through Arrow's file systems: by range, in chunks, and what can't be read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def located(path: str):
    """File system and plain path of a path with or without a scheme."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (LocalFileSystem(), path) if path.startswith("/") else FileSystem.from_uri(path)


def _digest(fs, path: str, chunk: int, most: int | None) -> tuple[str, int]:
    """SHA-256 and length of a file, or of its first ``most`` bytes, a chunk at a time."""
    sha, n = hashlib.sha256(), 0
    with fs.open_input_stream(path) as f:
        while part := f.read(chunk if most is None else min(chunk, most - n)):
            sha.update(part)
            n += len(part)
            if n == most:
                break
    return sha.hexdigest(), n


def digests(files: DataFrame, chunk: int, most: int | None = None) -> DataFrame:
    """The columns of ``files``, which has path, with ``digest``, ``bytes_read`` and ``error``.

    No more than a chunk of a file is held at a time. A file that can't be read has the reason instead of a digest.
    """
    own = files.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                try:
                    fs, at = located(path)
                    found.append((*_digest(fs, at, chunk, most), None))
                except (OSError, pa.ArrowException) as e:
                    found.append((None, 0, type(e).__name__))
            new = [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.int64(), pa.string()))] if found else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*own, "digest", "bytes_read", "error"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(n, F.xxhash64("path")).mapInArrow(run, f"{fields}, digest string, bytes_read long, error string")
