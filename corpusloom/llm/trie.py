"""The prefix trie of conversations that are rebuilt within families.

A conversation c belongs to the family of its base, c - c % 5, and is rebuilt from the first h turns of the base and its
own turns after the first h (h from a checksum of c, at most 8). Turns are reduced to digests, and a family's meet by its
base id with the base's turns first, so a task needs the base's first 8 turns and the family's small trie and nothing
else. Only these tries' nodes are shuffled, and merged to those of the whole. A conversation of more than ``LONG`` turns
is split into sorted ranges. A node is named by its depth and the sum of
the digests of its turns, each mixed with its place.

Of a subtree whose top only one conversation passes everything is known: it is a chain. So only shared nodes are summed
over: each sends its sum to its ancestor at distance 1, 2, 4, ..., which takes as many rounds as the depth has binary
digits, whatever the number of nodes.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, lookup_join, spread, written

#: Conversations of a family, and the number of turns that a checksum picks: 0 to PREFIX - 1.
FAMILY, PREFIX = 5, 9
#: Turns from which a conversation is split among tasks.
LONG = 1 << 20
#: Nodes that a task holds of one family; a larger trie is given out in parts.
NODES = 200_000
#: Bytes of a list of ids that are put together before they are hashed.
CHUNK = 1 << 16
_NODES = "node binary, parent binary, depth long, bytes long, conv long, n long, ends array<long>"
_MASK = (1 << 128) - 1


def taken_over(conv_id: int) -> int:
    """How many turns a conversation takes from its family's base."""
    return zlib.crc32(str(conv_id).encode()) % PREFIX


def _node(depth: int, total: int) -> bytes:
    return depth.to_bytes(8, "big") + total.to_bytes(16, "big")


def _mixed(turn: bytes, place: int) -> int:
    return int.from_bytes(hashlib.md5(turn + place.to_bytes(8, "big")).digest(), "big")


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(base, conv, turn, digest, bytes) of every turn that has a conversation: what its role and text are, not they."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    conv = F.col(conv_col).cast("long")
    return conversations.filter(conv.isNotNull()).select((conv - conv % FAMILY).alias("base"), conv.alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [x.split()[0] for x in _NODES.split(", ")])


class _Family:
    """The trie of one family, and the conversation that is being rebuilt."""

    def __init__(self):
        self.nodes: dict[bytes, list] = {}
        self.base = self.conv = None
        self.head: list[tuple[bytes, int]] = []

    def begin(self, conv: int) -> None:
        self.conv, self.rank, self.depth, self.total, self.last = conv, 0, 0, 0, None
        self.skip = 0 if conv == self.base else taken_over(conv)
        self._pass(_node(0, 0), 0)
        for turn, size in self.head[: self.skip]:
            self._add(turn, size)

    def _pass(self, node: bytes, size: int, n: int = 1) -> list:
        found = self.nodes.get(node)
        if found is None:
            found = self.nodes[node] = [self.last, self.depth, size, self.conv, 0, []]
        found[4] += n
        found[3] = min(found[3], self.conv)
        self.node, self.size, self.parent = node, size, self.last
        return found

    def _add(self, turn: bytes, size: int) -> None:
        self.last, self.depth, self.total = self.node, self.depth + 1, (self.total + _mixed(turn, self.depth)) & _MASK
        self._pass(_node(self.depth, self.total), size)

    def begins_with(self, turn: bytes, size: int) -> None:
        """A turn of the base, where the base itself is built elsewhere."""
        self.head.append((turn, size))

    def turn(self, turn: bytes, size: int) -> None:
        if self.conv == self.base and self.rank < PREFIX - 1:
            self.head.append((turn, size))
        if self.rank >= self.skip:
            self._add(turn, size)
        self.rank += 1

    def end(self) -> None:
        self.last = self.parent
        self._pass(self.node, self.size, 0)[5].append(self.conv)

    def rows(self) -> list[tuple]:
        out = [(node, *values) for node, values in self.nodes.items()]
        self.nodes = {}
        return out


def family_nodes(found: DataFrame) -> DataFrame:
    """The nodes of each family's trie: node, parent, depth, bytes of the last text, smallest member, members, and those
    that end there. Turns are ordered by number, null first, and those of one number by their digests. Rows with ``head``
    are a long base's first turns: the family's conversations begin with them, they are no conversation here."""

    def run(batches):
        family, out = _Family(), []
        for batch in batches:
            for base, conv, turn, size, head in zip(*(batch.column(c).to_pylist() for c in ("base", "conv", "digest", "bytes", "head"))):
                if conv != family.conv and family.conv is not None:
                    family.end()
                    family.conv = None
                if base != family.base:
                    out += family.rows()
                    family.base, family.head = base, []
                if head:
                    family.begins_with(turn, size)
                    continue
                if conv != family.conv:
                    family.begin(conv)
                family.turn(turn, size)
                if len(family.nodes) > NODES:
                    out += family.rows()
                if len(out) > 10_000:
                    yield _batch(out)
                    out = []
        if family.conv is not None:
            family.end()
            out += family.rows()
        if out:
            yield _batch(out)

    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = found.repartition(n, "base").sortWithinPartitions("base", F.col("conv") != F.col("base"), "conv", F.asc_nulls_first("turn"), "digest")
    return ordered.mapInArrow(run, _NODES)


def _order(found: DataFrame) -> DataFrame:
    """Turns with ``rank``, from 0, within their conversation, and ``part``: the sorted range that holds them.

    The ranges are counted, so no conversation is ordered by one task; a conversation has a few numbers a range.
    """
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = written(found.withColumn("salt", F.monotonically_increasing_id()), "long")  # equal turns are dealt apart
    columns = ["conv", F.asc_nulls_first("turn"), "digest", "salt"]
    ranged = written(apart.repartitionByRange(n, *columns).sortWithinPartitions(*columns).withColumn("at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("part", F.shiftright("at", 33).cast("int"))
    counts = ranged.groupBy(F.col("part").alias("p"), F.col("conv").alias("c")).agg(F.count("*").alias("n"), F.min("at").alias("least"))
    before = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(counts.select("p", "c", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("least")).alias("shift")), "starts")
    return lookup_join(ranged, starts, (F.col("part") == F.col("p")) & (F.col("conv") == F.col("c")), "inner").withColumn("rank", F.col("at") + F.col("shift")).drop("p", "c", "shift", "salt")


def _first_turns(ordered: DataFrame) -> DataFrame:
    """(of_base, head): the first turns of each conversation of (conv, rank, digest, bytes), in order."""
    some = ordered.filter(F.col("rank") < PREFIX - 1)
    return some.groupBy(F.col("conv").alias("of_base")).agg(F.array_sort(F.collect_list(F.struct("rank", "digest", "bytes"))).alias("head"))


def long_nodes(found: DataFrame, long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the conversations in ``long`` (long_conv), each split among tasks; and first turns of those that are bases.

    A node's name is a sum, so sums of the ranges' turns, added up in order, say where each range begins.
    """
    own = lookup_join(found, long, F.col("conv") == F.col("long_conv"), "left_semi")
    ordered = written(_order(own), "ordered")
    bases = own.select(F.col("base").alias("b")).distinct()
    others = lookup_join(lookup_join(found.filter("conv = base"), bases, F.col("conv") == F.col("b"), "left_semi"), long, F.col("conv") == F.col("long_conv"), "left_anti")
    number = F.row_number().over(Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "digest")) - 1  # fewer than LONG
    heads = written(_first_turns(ordered.filter("conv = base")).unionByName(_first_turns(others.withColumn("rank", number))), "heads")
    info = own.select("base", "conv").distinct().join(heads, F.col("base") == F.col("of_base"), "left")
    skip = F.when(F.col("conv") == F.col("base"), 0).otherwise(F.crc32(F.col("conv").cast("string").cast("binary")) % PREFIX).cast("int")
    none = F.array().cast(heads.schema["head"].dataType)
    info = info.select(F.col("conv").alias("i_conv"), skip.alias("skip"), F.when(skip > 0, F.slice(F.coalesce("head", none), F.lit(1), skip)).otherwise(none).alias("head"))
    last = ordered.groupBy(F.col("conv").alias("l_conv")).agg(F.max("rank").alias("last"))
    info = written(info.join(last, F.col("i_conv") == F.col("l_conv")).drop("l_conv"), "info")
    taken = lookup_join(ordered, info, F.col("conv") == F.col("i_conv"), "inner").filter("rank >= skip").withColumn("place", F.size("head") + F.col("rank") - F.col("skip"))
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = taken.select("conv", "part", "place", "digest", "bytes", (F.col("rank") == F.col("last")).alias("end")).repartition(n, "conv", "part").sortWithinPartitions("conv", "part", "place")
    dealt = written(dealt, "dealt")

    def beginnings(batches):
        """Nodes from the root to the end of the turns that a long conversation takes over; those of a turnless rest end there."""
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                total, node, depth = 0, _node(0, 0), 0
                walked = [(node, None, 0, 0)]
                for h in r["head"]:
                    total, depth = (total + _mixed(h["digest"], depth)) & _MASK, depth + 1
                    walked.append((_node(depth, total), node, depth, h["bytes"]))
                    node = walked[-1][0]
                ends = r["last"] < r["skip"]
                rows += [(*w, r["i_conv"], 1, [r["i_conv"]] if ends and w[0] == node else []) for w in walked]
            if rows:
                yield _batch(rows)

    def sums(batches):
        key, total = None, 0
        for batch in batches:
            for conv, part, place, digest in zip(*(batch.column(c).to_pylist() for c in ("conv", "part", "place", "digest"))):
                if (conv, part) != key:
                    if key:
                        yield pa.RecordBatch.from_pydict({"s_conv": [key[0]], "s_part": pa.array([key[1]], pa.int32()), "total": [total.to_bytes(16, "big")]})
                    key, total = (conv, part), 0
                total = (total + _mixed(digest, place)) & _MASK
        if key:
            yield pa.RecordBatch.from_pydict({"s_conv": [key[0]], "s_part": pa.array([key[1]], pa.int32()), "total": [total.to_bytes(16, "big")]})

    def running(batches):
        """Where each range of a conversation begins: the sum of its head and of all ranges before it."""
        conv, total = None, 0
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["s_conv"] != conv:
                    conv, total = r["s_conv"], 0
                    for place, h in enumerate(r["head"]):
                        total = (total + _mixed(h["digest"], place)) & _MASK
                out.append((r["s_conv"], r["s_part"], total.to_bytes(16, "big")))
                total = (total + int.from_bytes(r["total"], "big")) & _MASK
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.binary()))], ["s_conv", "s_part", "start"])

    def walked(batches):
        key = node = None
        for batch in batches:
            rows = []
            for conv, part, place, digest, size, end, start in zip(*(batch.column(c).to_pylist() for c in ("conv", "part", "place", "digest", "bytes", "end", "start"))):
                if (conv, part) != key:
                    key, total = (conv, part), int.from_bytes(start, "big")
                    node = _node(place, total)
                total = (total + _mixed(digest, place)) & _MASK
                before, node = node, _node(place + 1, total)
                rows.append((node, before, place + 1, size, conv, 1, [conv] if end else []))
            if rows:
                yield _batch(rows)

    ranges = dealt.select("conv", "part", "place", "digest").mapInArrow(sums, "s_conv long, s_part int, total binary")
    ranges = ranges.join(info.select("i_conv", "head"), F.col("s_conv") == F.col("i_conv")).select("s_conv", "s_part", "total", "head")
    starts = written(ranges.repartition(n, "s_conv").sortWithinPartitions("s_conv", "s_part").mapInArrow(running, "s_conv long, s_part int, start binary"), "sums")
    begun = lookup_join(dealt, starts, (F.col("conv") == F.col("s_conv")) & (F.col("part") == F.col("s_part")), "inner")
    begun = begun.repartition(n, "conv", "part").sortWithinPartitions("conv", "part", "place")
    nodes = begun.mapInArrow(walked, _NODES).unionByName(info.select("i_conv", "skip", "head", "last").mapInArrow(beginnings, _NODES))
    first = heads.select(F.col("of_base").alias("base"), F.explode("head").alias("h")).select("base", F.col("base").alias("conv"), F.col("h.rank").alias("turn"), "h.digest", "h.bytes")
    return written(nodes, "long-nodes"), lookup_join(first, long, F.col("conv") == F.col("long_conv"), "left_semi")


def _family_tries(found: DataFrame) -> DataFrame:
    """Nodes of all families, a written table; conversations of more than ``LONG`` turns are split, the others are not."""
    whole = F.lit(False).alias("head")
    long = written(found.groupBy("conv").agg(F.count("*").alias("n")).filter(F.col("n") > LONG).select(F.col("conv").alias("long_conv")), "long")
    if long.isEmpty():
        return written(family_nodes(found.select("*", whole)), "families")
    nodes, first = long_nodes(found, long)
    short = lookup_join(found, long, F.col("conv") == F.col("long_conv"), "left_anti")
    kind = found.schema["turn"].dataType
    rows = short.select("*", whole).unionByName(first.withColumn("turn", F.col("turn").cast(kind)).select(*found.columns, F.lit(True).alias("head")))
    return written(family_nodes(rows).unionByName(nodes), "families")


def _lists(ends: DataFrame) -> DataFrame:
    """(of, ends_sha256): the hash of each node's ascending, comma-joined ids, from (node, conv).

    Sorted ranges of all ids become chunks of text, and a node's chunks go through its hash one after the other.
    """

    def chunks(batches):
        node, first, parts, size = None, None, [], 0
        for batch in batches:
            for x, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node is not None and (x != node or size > CHUNK):
                    yield pa.RecordBatch.from_pydict({"node": [node], "first": [first], "part": [",".join(parts)]})
                    parts, size = [], 0
                if not parts:
                    node, first = x, conv
                parts.append(str(conv))
                size += len(parts[-1]) + 1
        if parts:
            yield pa.RecordBatch.from_pydict({"node": [node], "first": [first], "part": [",".join(parts)]})

    def hashes(batches):
        node, sha, out = None, None, []
        for batch in batches:
            for x, part in zip(batch.column("node").to_pylist(), batch.column("part").to_pylist()):
                if x != node:
                    if node is not None:
                        out.append((node, sha.hexdigest()))
                    node, sha = x, hashlib.sha256(part.encode())
                else:
                    sha.update(b"," + part.encode())
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["of", "ends_sha256"])
                out = []
        if node is not None:
            out.append((node, sha.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["of", "ends_sha256"])

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = ends.repartitionByRange(n, "node", "conv").sortWithinPartitions("node", "conv").mapInArrow(chunks, "node binary, first long, part string")
    return pieces.repartition(n, "node").sortWithinPartitions("node", "first").mapInArrow(hashes, "of binary, ends_sha256 string")


def _subtrees(shared: DataFrame) -> DataFrame:
    """(of, n_leaves, saved_tokens) of every node of (node, parent, n_leaves, saved_tokens): sums over its subtree.

    After round k a node has the sums of its descendants nearer than 2 ** k, and the ancestor at that distance.
    """
    now = written(shared.select("node", F.col("parent").alias("up"), "n_leaves", "saved_tokens"), "subtrees")
    while now.filter("up IS NOT NULL").limit(1).count():
        sums = now.filter("up IS NOT NULL").groupBy(F.col("up").alias("of")).agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.count("*").alias("below"))
        with_sums = written(now.join(sums, F.col("node") == F.col("of"), "left").drop("of"), "sums")
        tops = with_sums.filter("below IS NOT NULL").select(F.col("node").alias("of"), F.col("up").alias("next"), "below")
        sent = now.filter("up IS NOT NULL").select(F.col("node").alias("from"), "up")
        jumped = spread(sent, tops, "up", "of", "below").filter("next IS NOT NULL").select("from", "next")
        total = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).cast("long").alias(a)
        after = with_sums.join(jumped, F.col("node") == F.col("from"), "left").select("node", F.col("next").alias("up"), total("n_leaves", "leaves"), total("saved_tokens", "saved"))
        after = written(after, "subtrees")
        forget(now, with_sums)
        now = after
    return now.select(F.col("node").alias("of"), "n_leaves", "saved_tokens")


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Every node of the trie over all rebuilt conversations, one row each.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens
    (summed over the subtree: members but one times the bytes of the node's last text), ends_sha256 (of the members that
    end there). Rows without a conversation are left out; null roles and texts count as empty; repeated rows are turns
    of their own; other columns don't matter; an empty table has no node, not even the root.
    """
    family = _family_tries(turns(conversations, conv_col, turn_col, role_col, text_col))
    merged = family.groupBy("node", "parent", "depth", "bytes").agg(F.min("conv").alias("conv_id"), F.sum("n").alias("n_convs"))
    merged = written(merged, "nodes")
    below = merged.filter("depth > 0").groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single"))
    nodes = merged.join(below, F.col("node") == F.col("of"), "left").drop("of").withColumns({"n_children": F.coalesce("n_children", F.lit(0).cast("long")), "single": F.coalesce("single", F.lit(0).cast("long"))})
    nodes = written(nodes, "nodes")
    own = F.when(F.col("n_children") == 0, 1).otherwise(F.col("single")).cast("long")
    shared = nodes.filter("n_convs > 1").select("node", "parent", own.alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    sums = _subtrees(shared)
    lists = _lists(family.select("node", F.explode("ends").alias("conv")))
    # the parent's smallest member: a hot parent's children stay where they are
    tops = nodes.filter("n_children > 0").select(F.col("node").alias("top"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    above = spread(nodes.filter("depth > 0").select("node", "parent"), tops, "parent", "top", "n_children").select(F.col("node").alias("child"), "parent_conv_id")
    out = nodes.join(above, F.col("node") == F.col("child"), "left").join(sums, F.col("node") == F.col("of"), "left").drop("of").join(lists, F.col("node") == F.col("of"), "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
