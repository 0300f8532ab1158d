"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

A rotation is learned that turns centred unit vectors into balanced binary codes. Vectors of equal label and code form
a cell; cells are looked up in four tables of 16-bit segments, each with its one-bit neighbours, and those within
``radius`` bits are candidates. Candidate cells are reranked with the original vectors, block against block, in double
precision.

A pair just at cosine 0.98 is 11.5 degrees apart, about 4 of 64 bits, and escapes all four tables with a probability
of about half a percent; closer pairs with less. Where vectors have a large mean in common, pairs are farther apart
once that is taken away; invented pairs at the threshold show how many the tables would miss, and as long as that is
more than ``MISS``, codes of one more rotation are added. Where ``ROTATIONS`` don't suffice, all pairs are compared.

In a cell of more than one block, the vectors within half the threshold's angle of its first one are the cell's core:
they all link with each other, so no pair of them is ever formed, however many they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, lookup_join, slices, spread, written
from .graph import components

BITS, TABLES, WIDTH = 64, 4, 16
#: Vectors that the rotation is fitted on, steps of fitting, bits that candidates may differ in, vectors in a block.
SAMPLE, STEPS, RADIUS, BLOCK = 20_000, 50, 18, 512
#: Share of invented pairs at the threshold that may be missed before a rotation is added, and most rotations.
MISS, ROTATIONS = 0.01, 6
#: Blocks that a block is compared with in one task.
FOLLOWERS = 256


class Rotation:
    """Centre and projection to 64 code bits."""

    def __init__(self, mean: np.ndarray, matrix: np.ndarray):
        self.mean, self.matrix = mean, matrix

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Signed 64-bit codes of unit vectors."""
        bits = (vectors - self.mean) @ self.matrix > 0
        return np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()


def fit(sample: np.ndarray, seed: int = 0, steps: int = STEPS) -> Rotation:
    """Alternate between the nearest code of each rotated vector and the rotation nearest to the codes.

    Vectors are first projected on their principal directions, scaled to equal variance where that is balanced.
    Fewer dimensions than bits are filled up with random rotations of the same directions.
    """
    rng = np.random.default_rng(seed)
    d = sample.shape[1]
    mean = sample.mean(axis=0) if len(sample) else np.zeros(d)
    x = sample - mean
    _, vectors = np.linalg.eigh(x.T @ x / max(1, len(x)))
    parts = []
    left = BITS
    while left > 0:
        k = min(d, left)
        project = vectors[:, ::-1][:, :k]
        rotate, _ = np.linalg.qr(rng.standard_normal((k, k)))
        v = x @ project
        for _ in range(steps if len(x) else 0):
            code = np.where(v @ rotate > 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(v.T @ code)
            rotate = u @ w
        parts.append(project @ rotate)
        left -= k
    return Rotation(mean, np.concatenate(parts, axis=1))


def meet(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Whether codes share a segment up to one bit and differ in ``radius`` bits or fewer."""
    apart = a.view(np.uint64) ^ b.view(np.uint64)
    segments = [np.bitwise_count((apart >> np.uint64(WIDTH * i)) & np.uint64((1 << WIDTH) - 1)) for i in range(TABLES)]
    return (np.minimum.reduce(segments) <= 1) & (np.bitwise_count(apart) <= radius)


def missed(rotations: list[Rotation], sample: np.ndarray, threshold: float, radius: int = RADIUS, seed: int = 0, pairs: int = 4000) -> float:
    """Share of invented pairs at exactly ``threshold`` that no rotation's tables bring together."""
    rng = np.random.default_rng(seed)
    u = sample[rng.integers(len(sample), size=pairs)]
    w = rng.standard_normal(u.shape)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    v = threshold * u + np.sqrt(1 - threshold**2) * w / np.linalg.norm(w, axis=1, keepdims=True)
    met = np.zeros(pairs, bool)
    for r in rotations:
        met |= meet(r.codes(u), r.codes(v), radius)
    return 1.0 - float(met.mean())


def rotations_of(sample: np.ndarray, threshold: float, radius: int = RADIUS, seed: int = 0, most: int = ROTATIONS) -> list[Rotation] | None:
    """One rotation, and more while invented pairs at the threshold are missed too often; none if ``most`` don't suffice."""
    out = [fit(sample, seed)]
    while sample.shape[1] > 1 and len(sample) and missed(out, sample, threshold, radius, seed) > MISS:
        if len(out) == most:
            return None
        out.append(fit(sample, seed + len(out)))
    return out


def _unit(raw: list[bytes]) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _segment(code: Column, i: int) -> Column:
    return F.shiftrightunsigned(code, WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1))


def candidates(codes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(group, code_a, code_b) with code_a < code_b, from distinct (group, code): codes of one group (a long) that
    share a segment up to one bit and differ in ``radius`` bits or fewer; each pair once.

    Spark sizes exploded rows as if they were no more than before, so without a hint it would broadcast 68 rows a code.
    """
    n = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = codes.select("group", "code").repartition(n)  # few rows become many: spread before
    code = F.col("code")
    plain = F.array(*[F.xxhash64("group", F.lit(i), _segment(code, i)) for i in range(TABLES)])
    near = F.array(*[F.xxhash64("group", F.lit(i), _segment(code, i).bitwiseXOR(F.lit(flip).cast("long"))) for i in range(TABLES) for flip in [0, *(1 << j for j in range(WIDTH))]])
    left = dealt.select("group", F.col("code").alias("code_a"), F.explode(plain).alias("key"))
    right = dealt.select(F.col("group").alias("group_b"), F.col("code").alias("code_b"), F.explode(near).alias("key_b"))
    met = left.join(right.hint("merge"), (F.col("key") == F.col("key_b")) & (F.col("group") == F.col("group_b")) & (F.col("code_a") < F.col("code_b")) & (F.bit_count(F.col("code_a").bitwiseXOR(F.col("code_b"))) <= radius))
    return met.select("group", "code_a", "code_b").distinct()


def _forest(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Links that connect what the given links connect, one fewer than the vectors of each group."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a, b):
        rx, ry = find(x), find(y)
        if rx != ry:
            root[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def _members(cell) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, multiplicities, unit vectors and codes of a block (a list of structs)."""
    rows = cell.values
    codes = rows.field("codes").to_pylist()
    return rows.field("row").to_numpy(zero_copy_only=False), rows.field("copies").to_numpy(zero_copy_only=False), _unit(rows.field("vector").to_pylist()), np.array(codes, np.int64).reshape(len(codes), -1)


def _rerank(threshold: float, rotation: int, radius: int):
    """For each left block and those that follow it: the multiplicity of the links of each vector (b null), and a forest
    of the links.

    A left block comes first (``turn`` 0) and is held while the blocks that it is compared with pass; one that is null
    is the left block itself. Pairs that an earlier rotation has brought together were counted there.
    """

    def run(batches):
        left = None
        for batch in slices(batches, 1):
            if batch.column("turn")[0].as_py() == 0:
                left = _members(batch.column("members")[0])
                continue
            rows_a, many_a, x, codes_a = left
            same = not batch.column("members")[0].is_valid
            rows_b, many_b, y, codes_b = left if same else _members(batch.column("members")[0])
            i, j = np.nonzero(x @ y.T >= threshold)
            if same:
                i, j = i[i < j], j[i < j]
            for r in range(rotation):
                new = ~meet(codes_a[i, r], codes_b[j, r], radius)
                i, j = i[new], j[new]
            if not len(i):
                continue
            counts = [(rows_a, np.bincount(i, many_b[j], len(rows_a))), (rows_b, np.bincount(j, many_a[i], len(rows_b)))]
            links = _forest(rows_a[i].tolist(), rows_b[j].tolist())
            a = [*(v for who, n in counts for v in who[n > 0].tolist()), *(p for p, _ in links)]
            n = [*(int(v) for _, n in counts for v in n[n > 0].tolist()), *([0] * len(links))]
            b = [*([None] * (len(a) - len(links))), *(q for _, q in links)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], schema=_FOUND)

    return run


def _compared(blocks: DataFrame, met: DataFrame, threshold: float, rotation: int, radius: int) -> DataFrame:
    """What :func:`_rerank` finds among pairs of blocks (label_a, code_a, core_a, no_a, code_b, core_b, no_b, same).

    Only the second block of a pair is sent for each pair. The first one is sent once for every ``FOLLOWERS`` pairs, so
    that one which is compared with very many isn't a single task's.
    """
    key = ["label_a", "code_a", "core_a", "no_a"]
    many = met.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.ceil(F.count("*") / FOLLOWERS).cast("int").alias("shares"))
    at = lambda s: (F.col("label_a") == F.col(f"l_{s}")) & (F.col(f"code_{s}") == F.col(f"d_{s}")) & (F.col(f"core_{s}") == F.col(f"k_{s}")) & (F.col(f"no_{s}") == F.col(f"n_{s}"))
    full = lambda s: blocks.select(F.col("label").alias(f"l_{s}"), F.col("code").alias(f"d_{s}"), F.col("core").alias(f"k_{s}"), F.col("no").alias(f"n_{s}"), F.col("members").alias(f"m_{s}"))
    own = [F.col(c) == F.col(f"_{c}") for c in key]
    share = F.pmod(F.xxhash64("code_b", "core_b", "no_b"), F.col("shares")).cast("int").alias("share")
    pairs = met.join(many.hint("merge"), own).select(*key, "code_b", "core_b", "no_b", "same", share)
    lead = many.select(*[F.col(f"_{c}").alias(c) for c in key], F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share")).join(full("a").hint("merge"), at("a")).select(*key, "share", F.lit(0).alias("turn"), F.col("m_a").alias("members"))
    alone = pairs.filter("same").select(*key, "share", F.lit(1).alias("turn"), F.lit(None).cast(blocks.schema["members"].dataType).alias("members"))
    others = pairs.filter("NOT same").join(full("b").hint("merge"), at("b")).select(*key, "share", F.lit(1).alias("turn"), F.col("m_b").alias("members"))
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*key, "share"]
    return lead.unionByName(alone).unionByName(others).repartition(n, *order).sortWithinPartitions(*order, "turn").select("turn", "members").mapInArrow(_rerank(threshold, rotation, radius), "a long, b long, n long")


def _exact(coded: DataFrame, threshold: float, block: int) -> DataFrame:
    """As :func:`_linked`, of all pairs of vectors of a label, block against block: for where codes can't tell."""
    sized = coded.groupBy(F.col("label").alias("l")).agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    dealt = lookup_join(coded, sized, F.col("label") == F.col("l"), "inner").withColumn("no", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    member = F.struct("row", "copies", "vector", F.slice("codes", 1, 0).alias("codes"))
    blocks = written(dealt.groupBy("label", "no").agg(F.collect_list(member).alias("members")).withColumns({"code": F.lit(0).cast("long"), "core": F.lit(False)}), "blocks")
    numbers = blocks.select("label", "no")
    pairs = numbers.select(F.col("label").alias("label_a"), F.col("no").alias("no_a")).join(numbers.select("label", F.col("no").alias("no_b")), (F.col("label_a") == F.col("label")) & (F.col("no_a") <= F.col("no_b")))
    zero, no = F.lit(0).cast("long"), F.lit(False)
    met = pairs.select("label_a", zero.alias("code_a"), no.alias("core_a"), "no_a", zero.alias("code_b"), no.alias("core_b"), "no_b", (F.col("no_a") == F.col("no_b")).alias("same"))
    return written(_compared(blocks, met, threshold, 0, 0), "links")


def _encoder(fitted: dict[int, list[Rotation]], seed: int):
    """Kind (length and label), codes and bytes of vectors, those of one length together."""

    def run(batches):
        for batch in slices(batches, 4096):
            lists = batch.column("v")
            at = lists.offsets.to_numpy()
            values, sizes = lists.values.to_numpy(zero_copy_only=False), np.diff(at)
            codes: list = [None] * batch.num_rows
            raw: list = [None] * batch.num_rows
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                x = values[at[own][:, None] + np.arange(size)].astype("<f8")
                if size not in fitted:
                    fitted[size] = [fit(np.zeros((0, size)), seed)]
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                found = np.stack([r.codes(unit) for r in fitted[size]], axis=1).tolist()
                for k, i in enumerate(own.tolist()):
                    codes[i], raw[i] = found[k], x[k].tobytes()
            kind = [f"{size}:{label}" for size, label in zip(sizes.tolist(), batch.column("label").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), batch.column("row"), batch.column("copies"), pa.array(codes, pa.list_(pa.int64())), pa.array(raw, pa.binary())], ["label", "row", "copies", "codes", "vector"])

    return run


def _core(threshold: float):
    """The angle of each vector to its cell's first one, where that is given and at most half the threshold's angle."""
    half = np.arccos(threshold) / 2 - 1e-6

    def run(batches):
        for batch in slices(batches, 4096):
            angle: list = [None] * batch.num_rows
            for i, (v, p) in enumerate(zip(batch.column("vector").to_pylist(), batch.column("pivot").to_pylist())):
                if p is not None:
                    x, y = _unit([v, p])
                    turn = float(np.arccos(np.clip(x @ y, -1.0, 1.0)))
                    angle[i] = turn if turn <= half else None
            names = [n for n in batch.schema.names if n != "pivot"]  # in the order of the table
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(angle, pa.float64())], [*names, "angle"])

    return run


def _linked(coded: DataFrame, rotation: int, threshold: float, radius: int, block: int) -> list[DataFrame]:
    """Written tables (a, b, n) of what one rotation finds: n more links of row a (b null), or a link of rows a and b."""
    mine = coded.filter(F.size("codes") > rotation).withColumn("code", F.col("codes")[rotation])
    counted = written(mine.groupBy("label", "code").agg(F.count("*").alias("n"), F.min("row").alias("first")), "cells")
    large = counted.filter(F.col("n") > block)
    here = (F.col("label") == F.col("l")) & (F.col("code") == F.col("c"))
    sized = lookup_join(mine, large.select(F.col("label").alias("l"), F.col("code").alias("c"), "n"), here).drop("l", "c").withColumn("angle", F.lit(None).cast("double"))
    cored = rotation == 0 and not large.isEmpty()  # later rotations must tell apart pair by pair what was met before
    if cored:
        pivots = lookup_join(mine.select("row", "vector"), large.select(F.col("label").alias("l"), F.col("code").alias("c"), "first"), F.col("row") == F.col("first"), "inner")
        pivots = written(pivots.select("l", "c", F.col("vector").alias("pivot")), "pivots")
        sized = lookup_join(sized.drop("angle"), pivots, here).drop("l", "c").mapInArrow(_core(threshold), "label string, row long, copies long, codes array<long>, vector binary, code long, n long, angle double")
    core = F.col("angle").isNotNull()
    salt = F.pmod(F.xxhash64("row"), F.coalesce(F.ceil(F.col("n") / block), F.lit(1))).cast("int")
    sized = sized.select("label", "code", core.alias("core"), salt.alias("no"), "angle", "row", "copies", "codes", "vector")
    member = F.struct("row", "copies", "vector", F.slice("codes", 1, rotation).alias("codes"))
    blocks = written(sized.groupBy("label", "code", "core", "no").agg(F.collect_list(member).alias("members"), F.sum("copies").alias("total"), F.min("row").alias("least"), F.max("angle").alias("angle")), "blocks")

    group = F.xxhash64("label")
    own = counted.filter("n > 1").select(group.alias("group"), F.col("code").alias("code_a"), F.col("code").alias("code_b"))
    pairs = written(own.unionByName(candidates(counted.select(group.alias("group"), "code"), radius)), "pairs")
    side = lambda s: blocks.select(F.col("label").alias(f"label_{s}"), F.xxhash64("label").alias(f"g_{s}"), F.col("code").alias(f"c_{s}"), F.col("core").alias(f"core_{s}"), F.col("no").alias(f"no_{s}"))
    on = lambda s: (F.col("group") == F.col(f"g_{s}")) & (F.col(f"code_{s}") == F.col(f"c_{s}"))
    met = pairs.join(side("a").hint("merge"), on("a")).join(side("b").hint("merge"), on("b")).filter("label_a = label_b")
    within = F.col("code_a") == F.col("code_b")
    order = lambda s: F.struct(f"core_{s}", f"no_{s}")
    met = met.filter(~within | ((order("a") <= order("b")) & ~(F.col("core_a") & F.col("core_b"))))
    met = met.select("label_a", "code_a", "core_a", "no_a", "code_b", "core_b", "no_b", (within & (order("a") == order("b"))).alias("same"))

    out = []
    if cored:
        # cores as a whole: what their members have in common, and pairs of cores that all link, or not at all
        cores = blocks.filter("core").groupBy("label", "code").agg(F.sum("total").alias("total"), F.min("least").alias("least"), F.max("angle").alias("angle"))
        cores = written(cores.join(pivots, here).drop("l", "c"), "cores")
        two = lambda s: cores.select(F.xxhash64("label").alias(f"g_{s}"), F.col("label").alias(f"label_{s}"), F.col("code").alias(f"c_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("total", "least", "angle", "pivot")])
        near = lookup_join(lookup_join(pairs.filter(~within), two("a"), on("a"), "inner"), two("b"), on("b"), "inner").filter("label_a = label_b")
        near = written(near.mapInArrow(_decided(float(np.arccos(threshold))), "label_a string, code_a long, code_b long, joined boolean, total_a long, total_b long, least_a long, least_b long"), "decided")
        done = near.select(F.col("label_a").alias("d_label"), F.col("code_a").alias("d_a"), F.col("code_b").alias("d_b"))
        both = F.col("core_a") & F.col("core_b") & (F.col("label_a") == F.col("d_label")) & (F.col("code_a") == F.col("d_a")) & (F.col("code_b") == F.col("d_b"))
        met = lookup_join(met, done, both, "left_anti")
        linked = near.filter("joined")
        more = linked.select(F.col("label_a").alias("l"), F.col("code_a").alias("c"), F.col("total_b").alias("more")).unionByName(linked.select(F.col("label_a").alias("l"), F.col("code_b").alias("c"), F.col("total_a").alias("more")))
        more = more.groupBy("l", "c").agg(F.sum("more").alias("more"))
        whole = lookup_join(cores, more, here).select(F.col("label").alias("k_label"), F.col("code").alias("k_code"), (F.col("total") + F.coalesce("more", F.lit(0))).alias("others"), F.col("least").alias("k_least"))
        inside = lookup_join(sized.filter("core").select("label", "code", "row", "copies"), written(whole, "core-counts"), (F.col("label") == F.col("k_label")) & (F.col("code") == F.col("k_code")), "inner")
        inside = written(inside.select("row", "k_least", (F.col("others") - F.col("copies")).alias("n")), "core-links")
        null, zero = F.lit(None).cast("long").alias("b"), F.lit(0).cast("long").alias("n")
        out += [inside.select(F.col("row").alias("a"), null, "n"), inside.filter("row <> k_least").select(F.col("row").alias("a"), F.col("k_least").alias("b"), zero), linked.select(F.col("least_a").alias("a"), F.col("least_b").alias("b"), zero)]

    out.append(written(_compared(blocks, met, threshold, rotation, radius), "links"))
    forget(counted)
    return out


def _decided(angle: float):
    """Pairs of cores whose members all link, or none of them: by the angle of their first vectors and their radii."""

    def run(batches):
        for batch in slices(batches):
            rows = []
            for r in batch.to_pylist():
                x, y = _unit([r["pivot_a"], r["pivot_b"]])
                between, reach = float(np.arccos(np.clip(x @ y, -1.0, 1.0))), r["angle_a"] + r["angle_b"]
                if between + reach <= angle - 1e-6 or between - reach > angle + 1e-6:
                    rows.append((r["label_a"], r["code_a"], r["code_b"], between + reach <= angle, r["total_a"], r["total_b"], r["least_a"], r["least_b"]))
            if rows:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["label_a", "code_a", "code_b", "joined", "total_a", "total_b", "least_a", "least_b"])

    return run


def _sampled(single: DataFrame, most: int) -> dict[int, np.ndarray]:
    """Unit vectors by length, ``most`` of them at most, first by hash; they come as Arrow, not as Python's numbers."""
    out: dict[int, list[np.ndarray]] = {}
    lists = single.orderBy("digest").limit(most).select("v").toArrow().column("v")
    for chunk in lists.chunks:
        at, values = chunk.offsets.to_numpy(), chunk.values.to_numpy(zero_copy_only=False)
        for size in np.unique(np.diff(at)).tolist():
            own = np.flatnonzero(np.diff(at) == size)
            out.setdefault(size, []).append(values[at[own][:, None] + np.arange(size)])
    whole = {size: np.concatenate(found).astype(np.float64) for size, found in out.items()}
    return {size: x / np.linalg.norm(x, axis=1, keepdims=True) for size, x in whole.items()}


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98, radius: int = RADIUS, sample: int = SAMPLE, block: int = BLOCK, seed: int = 0, exact: bool = False) -> DataFrame:
    """One row per input row: id, n_links (other vectors linked directly), component (smallest id reachable).

    Vectors link if their labels are equal and not null and their cosine in double precision is ``threshold`` or
    more. A vector that is null, empty, zero or has null or non-finite components, and one without id or label, links
    with nothing. Copies are counted as one vector with a multiplicity and so never paired; vectors of different
    length never link. Repeated ids are vectors of their own, other columns don't matter, and an empty table gives an
    empty table. The rotation is fitted on ``sample`` vectors, first by hash; every vector is indexed.

    With ``exact``, and for vectors of a length for which ``ROTATIONS`` rotations still miss more than ``MISS`` of the
    invented pairs, all pairs of a label are compared, block against block: no link is lost, at a quadratic cost.
    """
    v = F.col(vector_col).cast("array<double>")
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.size("v") > 0, F.lit(False)) & ~F.coalesce(bad, F.lit(True))
    good = good & (F.coalesce(length, F.lit(0.0)) > 0)
    rows = rows.select("id", "label", F.when(good, F.col("v")).alias("v")).withColumn("row", F.monotonically_increasing_id())
    digest = F.when(F.col("v").isNotNull(), F.concat(F.hex(F.xxhash64("label", "v")), F.lit("-"), F.hex(F.xxhash64(F.lit(1), "v", "label"))))
    rows = written(rows.withColumn("digest", digest), "vectors")
    usable = rows.filter(F.col("v").isNotNull())

    # copies: one vector each, that of the smallest id
    classes = written(usable.groupBy("digest").agg(F.min(F.struct("id", "row")).alias("first"), F.count("*").alias("copies")), "classes")
    single = usable.join(classes.select(F.col("first.row").alias("first_row"), "copies").hint("merge"), F.col("row") == F.col("first_row")).select("label", "row", "copies", "v", "digest")
    single = written(single, "single")
    fitted, unfit = {}, []
    for size, vectors in _sampled(single, 0 if exact else sample).items():
        some = rotations_of(vectors, threshold, radius, seed)
        if some is None:
            unfit.append(size)
        else:
            fitted[size] = some
    coded = written(single.select("label", "row", "copies", "v").mapInArrow(_encoder(fitted, seed), "label string, row long, copies long, codes array<long>, vector binary"), "codes")
    forget(single)

    plain = F.lit(True) if exact else F.substring_index("label", ":", 1).cast("int").isin(unfit) if unfit else F.lit(False)
    found = [] if exact else [t for r in range(max([1, *map(len, fitted.values())])) for t in _linked(coded.filter(~plain) if unfit else coded, r, threshold, radius, block)]
    if exact or unfit:
        found.append(_exact(coded.filter(plain), threshold, block))
    both = found[0]
    for t in found[1:]:
        both = both.unionByName(t)
    counts = both.filter("b is null").groupBy(F.col("a").alias("of")).agg(F.sum("n").alias("others"))
    parts = written(components(both.filter("b is not null"), "a", "b"), "parts")
    least = parts.join(classes.select(F.col("first.row").alias("r"), F.col("first.id").alias("i")).hint("merge"), F.col("node") == F.col("r")).groupBy(F.col("component").alias("of_part")).agg(F.min("i").alias("top"), F.count("*").alias("size"))
    tops = spread(parts, written(least, "tops"), "component", "of_part", "size").select("node", "top")
    known = classes.select("digest", "first", "copies").join(counts.hint("merge"), F.col("first.row") == F.col("of"), "left").join(tops.hint("merge"), F.col("first.row") == F.col("node"), "left")
    known = known.select(F.col("digest").alias("of_digest"), "copies", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"), F.coalesce("top", F.col("first.id")).alias("top"))
    linked = spread(usable.select("id", "digest"), written(known, "known"), "digest", "of_digest", "copies").select("id", F.col("links").cast("long").alias("n_links"), F.col("top").alias("component"))
    return linked.unionByName(rows.filter(F.col("v").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")))
