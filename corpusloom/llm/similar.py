"""Near-duplicates by exact Jaccard similarity of word shingles, found through prefix filtering.

Two texts are near-duplicates if the sets of their five-word shingles have a Jaccard similarity of 0.8 or more. Such
sets share one of the first n - ceil(0.8 n) + 1 shingles of each in any common order, so these are the index keys and
no pair is lost. The order puts shingles that a sample shows to be frequent last. Candidates pass two checks that never
reject a near-duplicate (sizes, parity bitmaps: they differ in no more bits than the sets in shingles) before the sets
themselves are compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, keeps_words, lookup_join, slices, spread, written
from .graph import components

#: Words of a shingle; near-duplicates have similarity 4/5 or more.
WORDS = 5
#: Documents whose shingles are counted for the order, and most shingles kept as frequent. Neither affects the result.
SAMPLE, FREQUENT = 32_768, 200_000
_KEYED = "id long, sig binary, n long, keys array<long>, bits binary"


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased word shingles of a whole text; a shorter text is one shingle."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    whole, size = b" ".join(tokens), np.fromiter(map(len, tokens), np.int64, len(tokens))
    end = np.cumsum(size + 1) - 1
    k = min(words, len(tokens))
    spans = zip((end - size)[: len(tokens) - k + 1].tolist(), end[k - 1 :].tolist())
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(whole[s:e], 42) for s, e in spans), np.uint64, len(tokens) - k + 1))


def bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the hashes that fall on each bit; the number of bits is a power of two of at least 2 n."""
    width = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    return np.packbits(np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1, bitorder="little").tobytes()


def _apart(a: bytes, b: bytes) -> int:
    """Differing bits of two bitmaps, the longer one folded to the length of the other."""
    a, b = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum())


def _similar(a: bytes, b: bytes) -> bool:
    both = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
    return 9 * both >= 4 * (len(a) + len(b)) // 8


def _frequent(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of shingles that several documents of a sample hold."""
    step = max(1, texts.count() // SAMPLE)

    def run(batches):
        keeps_words("shingles", lambda: None)
        for batch in slices(batches):
            for t in batch.column(1).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t, words).view(np.int64))], ["h"])

    some = texts.filter(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).mapInArrow(run, "h long")
    rows = some.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()  # a bounded list
    hashes, counts = rows.column("h").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def keyed(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """Digest of the set, its size, index keys and bitmap for every row of (id, text)."""
    often, count = _frequent(texts, words)

    def run(batches):
        for batch in slices(batches):
            out, size = [], 0
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = shingle_set(t, words)
                rank = np.zeros(len(s), np.int64)
                if len(often):
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    rank = np.where(often[at] == s, count[at], 0)
                keys = s[np.lexsort((s, rank))[: len(s) - (4 * len(s) + 4) // 5 + 1]].view(np.int64)
                out.append((i, hashlib.sha1(s.tobytes()).digest(), len(s), keys, bitmap(s)))
                size += 8 * len(keys)
                if size > 8 << 20:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)

    return texts.mapInArrow(run, _KEYED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["id", "sig", "n", "keys", "bits"])


def _whole_sets(texts: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of every row of (id, text)."""

    def run(batches):
        for part in slices(batches, 50):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingle_set(t, words).tobytes() for t in part.column(1).to_pylist()], pa.binary())], ["id", "shingles"])

    return texts.mapInArrow(run, "id long, shingles binary")


def _checked(pairs: DataFrame, held: DataFrame, column: str, good) -> DataFrame:
    """The pairs (a, b, room) for which ``good`` holds on both ends' ``column`` and room."""

    def run(batches):
        for batch in slices(batches):
            a, b, room, x, y = (c.to_pylist() for c in batch.columns)
            keep = pa.array([good(*v) for v in zip(x, y, room)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in range(3)], ["a", "b", "room"])

    ends = pairs.join(held.select(F.col("id").alias("a"), F.col(column).alias("x")).hint("merge"), "a").join(held.select(F.col("id").alias("b"), F.col(column).alias("y")).hint("merge"), "b")
    return ends.select("a", "b", "room", "x", "y").mapInArrow(run, "a long, b long, room long")


def _links(pairs: DataFrame, held: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Near-duplicates among candidates (a, b, na, nb): sizes, then bitmaps, then the sets themselves."""
    total = F.col("na") + F.col("nb")
    fit = pairs.filter(5 * F.least("na", "nb") >= 4 * F.greatest("na", "nb"))
    fit = fit.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (total - 2 * F.ceil(4 * total / 9)).alias("room")).distinct()
    close = written(_checked(fit, held, "bits", lambda x, y, room: _apart(x, y) <= room), "close")
    ends = close.select(F.col("a").alias("id")).unionByName(close.select(F.col("b").alias("id"))).distinct()
    needed = written(_whole_sets(lookup_join(texts, written(ends, "ends"), "id", "left_semi"), words), "shingles")
    return written(_checked(close, needed, "shingles", lambda x, y, room: _similar(x, y)).select("a", "b"), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(id, component) of every row: the smallest id reachable over near-duplicates, itself included.

    Equal sets form one class first. Every row is compared with the first one of its largest group of a common key,
    then with the first ones of its other groups as far as they are in other components, and then pairs of a key that are
    still in different components with each other: a large group of near copies costs one comparison a row, and what lies
    in no common component has been compared. Such a pair meets in a key of the longer set's prefix and of the shorter
    one's first n - ceil(8 n / 9) + 1 shingles, as their overlap is at least 8/9 of the shorter. Texts without words are copies of each other. Rows with a
    null id get the component of their class, null if no row of the class has an id.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = written(keyed(texts, words), "keyed")
    classes = written(rows.groupBy("sig").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    copies = written(rows.select("id", "sig").join(classes.hint("merge"), "sig").filter("id > rep").select("id", "sig").distinct(), "copies")
    held = lookup_join(rows.filter("id IS NOT NULL AND n > 0"), copies, ["id", "sig"], "left_anti")
    one = held.select("id", "n", F.posexplode("keys").alias("pos", "key"))
    least = one.groupBy(F.col("key").alias("of_key")).agg(F.min(F.struct("id", "n")).alias("c"), F.count("*").alias("rows")).filter("rows > 1")
    least = written(least, "keys")
    shared = written(spread(one, least, "key", "of_key", "rows").filter(F.col("id") != F.col("c.id")).select("key", "id", "n", "pos", F.col("c.id").alias("c"), F.col("c.n").alias("cn"), "rows"), "shared")

    def placed(part: DataFrame) -> DataFrame:
        """Rows of keys with the component of the row (p) and of the key's first row (q)."""
        of = lambda name, to: part.select(F.col("node").alias(name), F.col("component").alias(to))
        both = lookup_join(lookup_join(shared, of("id", "p"), "id"), of("c", "q"), "c")
        return written(both.select("key", "id", "n", "pos", "c", "cn", F.coalesce("p", "id").alias("p"), F.coalesce("q", "c").alias("q")), "placed")

    pair = lambda df: df.select(F.col("id").alias("a"), F.col("c").alias("b"), F.col("n").alias("na"), F.col("cn").alias("nb"))
    # a row and the first of its largest group; then the firsts of all its groups in other components
    largest = shared.groupBy("id").agg(F.max_by(F.struct("c", "cn", "n"), F.struct("rows", "key")).alias("m")).select("id", "m.c", "m.cn", "m.n")
    near = _links(pair(largest), held, texts, words)
    part = written(components(near, "a", "b"), "parts")
    second = placed(part)
    near = near.unionByName(_links(pair(second.filter("p <> q")), held, texts, words))
    part = written(components(near, "a", "b"), "parts")
    third = placed(part)
    # then all pairs in different components: a text with those not longer of which the key is in a shorter prefix. Of
    # texts that have only a frequent passage in common, the passage's keys stand behind all of their own, so they come
    # into that prefix only where the passage alone makes the texts near-duplicates.
    side = lambda df, *names: df.select(*[F.col(c).alias(n) for c, n in zip(("key", "id", "n", "pos", "p", "apart"), names)])
    marked = third.withColumn("apart", F.col("p") != F.col("q"))
    longer, shorter = side(marked, "key", "a", "na", "i", "pa", "apart_a"), side(marked.filter("9 * pos <= n"), "key_b", "b", "nb", "j", "pb", "apart_b")
    total = F.col("na") + F.col("nb")
    able = (F.col("pa") != F.col("pb")) & (F.col("na") >= F.col("nb")) & (5 * F.col("nb") >= 4 * F.col("na")) & (9 * F.least(F.col("na") - F.col("i"), F.col("nb") - F.col("j")) >= 4 * total)
    met = lambda x, y: x.join(y.hint("merge"), (F.col("key") == F.col("key_b")) & able).select("a", "b", "na", "nb")
    pairs = met(longer.filter("apart_a"), shorter).unionByName(met(longer.filter("NOT apart_a"), shorter.filter("apart_b")))
    rest = _links(pairs, held, texts, words)
    part = written(components(near.unionByName(rest), "a", "b"), "parts")
    whole = classes.join(part.hint("merge"), F.col("rep") == F.col("node"), "left").select(F.col("sig").alias("of_sig"), F.coalesce("component", "rep").alias("component"), "copies")
    whole = written(whole, "whole")
    forget(shared, least, second, third)
    return spread(rows.select("id", "sig"), whole, "sig", "of_sig", "copies").select("id", "component")
