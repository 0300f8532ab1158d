"""Packing of token sequences by a length histogram.

Documents are encoded and those longer than a sequence cut into pieces. How many pieces there are of each length is all
that the plan needs: best-fit decreasing places runs of equal lengths on runs of equally filled sequences, so its size
follows the number of lengths, not of pieces. Each piece has a rank among the pieces of its length (its place in its
task, after those of the tasks before) and takes the slot that the plan has for that rank.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, tokenizer_path, written
from .tokenfile import VOCABULARY, _encoder, id_type

#: Tokens of a sequence, and the id that ends a document.
LENGTH, END_ID = 2048, 0
_PIECES = "id long, piece int, start long, length int, ids binary, ids_crc32 long, task int, place long"


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """Pieces of at most ``length`` tokens, a written table: id, piece, start (tokens before it), length, ids (little-endian
    unsigned integers of the vocabulary's width), ids_crc32 (of the ids as 32-bit integers), and task and place, which
    number the pieces of each length.

    Every document ends with ``end_id``; null and empty texts are that id alone. Null and repeated ids keep all their
    rows; other columns don't matter; an empty table has no pieces.
    """
    path = vocabulary or tokenizer_path(VOCABULARY)
    kind = id_type(path)
    end = np.array([end_id], kind).tobytes()

    def run(batches):
        words, task = _encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(length + 1, np.int64)
        width = np.dtype(kind).itemsize
        for batch in slices(batches):
            rows = []
            for i, ids in zip(batch.column(0).to_pylist(), words.encode(batch.column(1).fill_null(""))):
                ids += end
                for piece, at in enumerate(range(0, len(ids), length * width)):
                    part = ids[at : at + length * width]
                    n = len(part) // width
                    rows.append((i, piece, at // width, n, part, zlib.crc32(np.frombuffer(part, kind).astype("<u4").tobytes()), task, int(seen[n])))
                    seen[n] += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _NAMES)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(run, _PIECES), "pieces")


_NAMES = [c.split()[0] for c in _PIECES.split(", ")]


def plan(counts: dict[int, int], length: int = LENGTH) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over the number of pieces of each length.

    Yields runs (length, first rank, pieces, first sequence, pieces in a sequence, offset of the first of them): the
    piece of rank r lies in sequence ``first + (r - first rank) // each``. Of the sequences that still have room the
    fullest ones come first; one that takes a piece is then the fullest, so it takes equal ones while they fit.
    Sequences are held as runs that are filled alike. What a run has left more than halves whenever it takes pieces,
    and each length begins at most three runs, so there are fewer than ``40 * length`` of them for any input.
    """
    room: list[tuple[int, int, int]] = []  # (room left, first sequence, sequences), ascending
    used = 0
    for n in sorted((n for n, k in counts.items() if k), reverse=True):
        left, rank = counts[n], 0
        while left:
            at = bisect.bisect_left(room, (n, -1, 0))
            if at < len(room):
                free, first, many = room.pop(at)
            else:
                free, first, many = length, used, -(-left // (length // n))
                used += many
            each = free // n
            whole = min(many, left // each)
            rest = left - whole * each if whole < many else 0
            for sequences, k in ((whole, each), (min(rest, 1), rest)):
                if sequences:
                    yield n, rank, sequences * k, first, k, length - free
                    rank, left = rank + sequences * k, left - sequences * k
                    if free - k * n:
                        bisect.insort(room, (free - k * n, first, sequences))
                    first, many = first + sequences, many - sequences
            if many:
                bisect.insort(room, (free, first, many))


def slots(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """The columns of :func:`pieces` with ``sequence_id`` and ``offset``: the slot of each piece.

    The driver gets the histogram (at most ``length`` numbers), the tasks the plan, whose size it bounds. The ranks come
    from counts by task and length, so a length that most pieces have is ranked without being gathered. All columns of
    ``cut`` are moved: leave out ``ids`` where only the slots are wanted.
    """
    spark = cut.sparkSession
    each = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    counted = written(each, "lengths")
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row a length
    runs = np.array(list(plan(histogram, length)), np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(runs[np.lexsort((runs[:, 1], runs[:, 0]))])
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counted.select(F.col("task").alias("of_task"), F.col("length").alias("of_length"), F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("first"))
    ranked = cut.join(firsts.hint("merge"), (F.col("task") == F.col("of_task")) & (F.col("length") == F.col("of_length")))
    names = [c for c in cut.columns if c not in ("task", "place")]

    def run(batches):
        table = shared.value
        keys = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            n, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            own = table[np.searchsorted(keys, n << 48 | rank, side="right") - 1]
            many, k = np.divmod(rank - own[:, 1], own[:, 4])
            slot = [pa.array(own[:, 3] + many), pa.array(own[:, 5] + k * n)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *slot], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields if f.name in names)
    return ranked.select(*names, (F.col("first") + F.col("place")).alias("rank")).mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """Every piece of every document with its slot; see :func:`pieces` and :func:`slots`."""
    return slots(pieces(docs, id_col, text_col, vocabulary, end_id, length), length)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, input_ids, doc_ids, starts) of every sequence: the ids of its pieces one after the other, packed as
    they are, and where each document's piece begins. A sequence has one slot a token at most, so its group is bounded."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "id", "ids")))
    rows = packed.groupBy("sequence_id").agg(inside.alias("p"))
    ids = F.aggregate("p", F.unhex(F.lit("")), lambda all, p: F.concat(all, p.getField("ids")))
    return rows.select("sequence_id", ids.alias("input_ids"), F.transform("p", lambda p: p.getField("id")).alias("doc_ids"), F.transform("p", lambda p: p.getField("offset")).alias("starts"))
