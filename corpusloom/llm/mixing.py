"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

Sources get word targets by weight, capped at a multiple of what they hold. Documents are cut into blocks of at most
``block_words`` words; each source's blocks stand in a pseudorandom permutation, and the source gives the blocks whose
words come before its target (the last one in part; what exceeds one pass comes from more passes). The drawn blocks
of all sources form an urn whose colours are the sources: a binary tree splits the urn's exact counts among the output
shards, a hypergeometric draw for each source at each node. A shard takes its own interval of each source's
permutation, so shards are disjoint, and orders its blocks locally by ``shuffle_key``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, let, lookup_join, written

WORD = r"[^\x20\x09-\x0D]+"
#: Blocks of one source in a bucket of its permutation, about; a bucket is the largest group ordered in one task.
BUCKET_BLOCKS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text.cast("string"), F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, weigh ``weights``, repeating. All targets sum to ``share`` of all sizes; one
    that would exceed ``cap`` times its source's size stops there and the excess is shared again by weight, until
    none is above. Sorted by the level at which they fill, the full sources come first: the level is what is left
    divided by the weights left, at the first source that it does not fill. There is one row per source here, so the
    two orderings are over the catalogue of sources, not over the documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        weight = F.when(rank % len(weights) == i, F.lit(float(w))).otherwise(weight)
    s = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    s = s.withColumn("fills", F.col("most") / F.col("weight"))
    everything = Window.partitionBy()
    upto = Window.orderBy("fills", F.col("source").isNull(), "source")
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(upto.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("cut", F.min(F.when(F.col("level") <= F.col("fills"), F.struct("fills", "level"))).over(everything))
    target = F.when(F.col("cut").isNull() | (F.col("fills") < F.col("cut.fills")), F.col("most")).otherwise(F.least(F.col("most"), F.col("cut.level") * F.col("weight")))
    return s.select("source", "source_size", target.alias("target"))


#: One hypergeometric draw: of {need} taken from {pop} blocks, how many are among {k}. Inverse distribution function
#: over ten standard deviations around the mode, by the ratio of neighbouring probabilities; {u} is uniform.
_RATIO = "((({k}) - x) * (({need}) - x)) / ((x + 1D) * (({pop}) - ({k}) - ({need}) + x + 1D))"
_DRAW = """
transform(array(named_struct(
  'a', cast(greatest(0D, {need} + {k} - {pop}, floor(({need} + 1D) * ({k} + 1D) / ({pop} + 2D)) - ceil(10D * {sd}) - 10D) as bigint),
  'b', cast(least(cast({need} as double), cast({k} as double), floor(({need} + 1D) * ({k} + 1D) / ({pop} + 2D)) + ceil(10D * {sd}) + 10D) as bigint))), w ->
 transform(array(aggregate(sequence(w.a, w.b), named_struct('p', 1D, 'z', 0D), (t, x) -> named_struct('p', t.p * {ratio}, 'z', t.z + t.p), t -> t.z)), z ->
  aggregate(sequence(w.a, w.b), named_struct('p', 1D, 'c', 0D, 'x', w.a), (t, x) -> named_struct('p', t.p * {ratio}, 'c', t.c + t.p, 'x', if(t.c + t.p < {u} * z, x + 1L, t.x)), t -> least(t.x, w.b)))[0])[0]
"""


def _draw(pop: str, k: str, need: str, u: str) -> str:
    names = {"pop": f"cast({pop} as double)", "k": f"cast({k} as double)", "need": f"cast({need} as double)", "u": u}
    sd = "sqrt({need} * {k} * ({pop} - {k}) * greatest(0D, {pop} - {need})) / ({pop} * sqrt(greatest(1D, {pop} - 1D)))".format(**names)
    return _DRAW.format(sd=sd, ratio=_RATIO.format(**names), **names)


def split_tree(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """(source_no, bounds): for each source the running ends of its quota in each of 2**depth shards, in order.

    ``quotas`` has (source_no, quota). Counts are exact: a source's shares sum to its quota, and shards differ by
    one block at most. One row per node holds one number per source.
    """
    node = quotas.agg(F.array_sort(F.collect_list(F.struct("source_no", F.col("quota").alias("k")))).alias("counts")).select(F.lit(0).cast("long").alias("node"), "counts")
    node = node.withColumn("total", F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c.getField("k")))
    for level in range(depth):
        uniform = f"((xxhash64({int(seed)}L, {level}, node, c.source_no) & 4503599627370495L) + 0.5D) / 4503599627370496D"
        left = f"""
        aggregate(counts, named_struct('pop', total, 'need', total - total div 2L, 'out', cast(array() as array<bigint>)),
          (s, c) -> transform(array(if(s.pop = 0 or c.k = 0, 0L, {_draw("s.pop", "c.k", "s.need", uniform)})), d ->
            named_struct('pop', s.pop - c.k, 'need', s.need - d, 'out', concat(s.out, array(d))))[0],
          s -> s.out)
        """
        node = node.withColumn("left", F.expr(left))
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.transform("counts", lambda c, i: F.struct(c.getField("source_no").alias("source_no"), F.col("left")[i].alias("k"))).alias("counts")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.transform("counts", lambda c, i: F.struct(c.getField("source_no").alias("source_no"), (c.getField("k") - F.col("left")[i]).alias("k"))).alias("counts")),
        )
        above, node = node, written(node.select(F.explode(halves).alias("h")).select("h.node", "h.counts").withColumn("total", F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c.getField("k"))), "split")
        forget(above)
    each = node.select("node", F.explode("counts").alias("c")).groupBy("c.source_no").agg(F.array_sort(F.collect_list(F.struct("node", "c.k"))).alias("by"))
    return each.select("source_no", F.transform("by", lambda _, i: F.aggregate(F.slice("by", F.lit(1), i + 1), F.lit(0).cast("long"), lambda s, b: s + b.getField("k"))).alias("bounds"))


class Mix:
    """Written tables of one mix.

    ``documents``: row, id, source, size, source_size, target.
    ``blocks``: one row per drawn block and pass: row, id, source, block, first_word, words, pass, shard, shuffle_key.
    """

    def __init__(self, documents: DataFrame, blocks: DataFrame):
        self.documents, self.blocks = documents, blocks

    def taken(self) -> DataFrame:
        """(id, source, size, source_size, target, taken): the words that the mix takes of each document, repeats counted."""
        took = self.blocks.groupBy(F.col("row").alias("of")).agg(F.sum("words").alias("taken"))
        return self.documents.join(took, F.col("row") == F.col("of"), "left").select("id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0, block_words: int = 1024, depth: int = 6, seed: int = 0) -> Mix:
    """Draw the mix of all ``docs`` into 2**depth shards; see the module's head.

    Words are runs of anything but ASCII white space; null texts have none. Each source's taken words equal its
    target, rounded. Null is a source of its own. Documents without words are in ``documents`` with nothing taken;
    an empty table gives empty tables; repeated rows are documents of their own. The order of blocks follows hashes
    of source, id and block number, so reruns agree; rows equal in all of these are told apart by their size.
    """
    return mix_sizes(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")), weights, share, cap, block_words, depth, seed)


def mix_sizes(sizes: DataFrame, weights: tuple, share: float, cap: float, block_words: int, depth: int, seed: int) -> Mix:
    """As :func:`mix`, from (id, source, size); a column ``row`` that tells rows apart may be given."""
    sized = written(sizes if "row" in sizes.columns else sizes.withColumn("row", F.monotonically_increasing_id()), "sized")
    n_blocks = F.ceil(F.col("size") / block_words).cast("long")
    source = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.sum(n_blocks).alias("n_blocks"))
    source = written(source, "sources")
    bits = F.least(F.lit(24), F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.col("n_blocks"), F.lit(1)) / F.lit(float(BUCKET_BLOCKS)))).cast("int")))
    plan = targets(source.select("source", "source_size"), weights, share, cap).withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")))
    plan = plan.join(source.select(F.col("source").alias("s2"), bits.alias("bits")), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    plan = written(plan.withColumn("words", F.round("target").cast("long")), "plan")
    planned = plan.select(F.col("source").alias("plan_source"), "source_no", "source_size", "target", "words", "bits")
    n_passes = max(1, math.ceil(cap))  # a pass takes what its source holds at most, and no target is above cap times that
    documents = lookup_join(sized, planned, F.col("source").eqNullSafe(F.col("plan_source")), "inner").drop("plan_source")

    # blocks in the order of their source's permutation, bucket by bucket
    block = documents.filter("size > 0").select("row", "id", "source_no", "bits", "size", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)).alias("block"))
    block = block.withColumn("part", F.least(F.lit(block_words).cast("long"), F.col("size") - F.col("block") * block_words))
    block = block.withColumn("order", F.xxhash64(F.lit(seed), "source_no", F.col("id").cast("string"), "block", "size"))
    block = block.withColumn("bucket", F.when(F.col("bits") > 0, F.expr("shiftrightunsigned(`order`, 64 - bits)")).otherwise(F.lit(0).cast("long")))
    # the permutation's order within a bucket; signed hashes sort alike in every bucket
    bucket = block.groupBy("source_no", "bucket").agg(F.sum("part").alias("part"), F.count("*").alias("n"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucket = bucket.select(F.col("source_no").alias("b_source"), F.col("bucket").alias("b_bucket"), F.coalesce(F.sum("part").over(before), F.lit(0)).alias("words_before"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("order", "id", "block", "row")
    ranked = (
        block.withColumn("words_in", F.coalesce(F.sum("part").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("n_in", F.row_number().over(inside) - 1)
        .join(bucket, (F.col("source_no") == F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
        .select("row", "id", "source_no", "block", "part", "order", (F.col("words_before") + F.col("words_in")).alias("at"), (F.col("n_before") + F.col("n_in")).alias("rank"))
    )
    by_no = planned.select(F.col("source_no").alias("no"), F.col("plan_source").alias("source"), F.col("source_size").alias("whole"), F.col("words").alias("wanted"))
    drawn = lookup_join(ranked, by_no, F.col("source_no") == F.col("no"), "inner")
    takes = lambda p: F.greatest(F.lit(0), F.least(F.col("part"), F.least(F.col("wanted") - p * F.col("whole"), F.col("whole")) - F.col("at"))).cast("long")
    passes = F.array(*[F.struct(F.lit(p + 1).alias("pass"), takes(p).alias("words")) for p in range(n_passes)])
    drawn = drawn.select("row", "id", "source", "source_no", "block", (F.col("block") * block_words).alias("first_word"), "order", "rank", F.explode(passes).alias("p"))
    drawn = written(drawn.filter("p.words > 0").select("row", "id", "source", "source_no", "block", "first_word", "order", "rank", F.col("p.words").alias("words"), F.col("p.pass").alias("pass")), "drawn")

    # exact quotas, split among the shards; a source's passes follow each other in its sequence of draws
    before_pass = F.array(*[F.count_if(F.col("pass") <= p) for p in range(n_passes)])
    quotas = written(drawn.groupBy("source_no").agg(F.count("*").alias("quota"), before_pass.alias("before")), "quotas")
    bounds = split_tree(quotas.select("source_no", "quota"), depth, seed)
    bounds = written(bounds.join(quotas.select(F.col("source_no").alias("q"), "before"), F.col("source_no") == F.col("q")).select(F.col("source_no").alias("no"), "before", "bounds"), "bounds")
    placed = lookup_join(drawn, bounds, F.col("source_no") == F.col("no"), "inner")
    number = F.col("rank") + F.get("before", F.col("pass") - 1)
    placed = placed.withColumn("number", number).withColumn("shard", F.size(F.filter("bounds", lambda b: b <= F.col("number"))))
    blocks = placed.select("row", "id", "source", "block", "first_word", "words", "pass", "shard", F.xxhash64(F.lit(seed + 1), "shard", "order", "pass").alias("shuffle_key"))
    return Mix(documents.select("row", "id", "source", "size", "source_size", "target"), written(blocks, "blocks"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", chars_col: str = "n_chars", weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0, block_words: int = 1024, depth: int = 6, seed: int = 0) -> DataFrame:
    """The mix as documents: one row, with all columns of ``docs``, for each document and pass that takes words of it.

    A text that a pass takes whole stays as it is; otherwise it is the taken blocks in their order, each word with the
    white space before it. ``chars_col`` is counted anew where ``docs`` has it. Documents without words aren't taken; an
    empty table gives an empty table.
    """
    whole = written(docs.select(F.struct(*docs.columns).alias("doc")).withColumn("row", F.monotonically_increasing_id()), "mixable")
    text = F.col(f"doc.{text_col}")
    mixed = mix_sizes(whole.select("row", F.col(f"doc.{id_col}").alias("id"), F.col(f"doc.{source_col}").cast("string").alias("source"), word_count(text).alias("size")), weights, share, cap, block_words, depth, seed)
    parts = mixed.blocks.groupBy(F.col("row").alias("of"), "pass").agg(F.array_sort(F.collect_list(F.struct(F.col("first_word").cast("int").alias("first"), F.col("words").cast("int").alias("n")))).alias("parts"), F.sum("words").alias("took"))
    parts = parts.join(mixed.documents.select(F.col("row").alias("r"), "size").hint("merge"), F.col("of") == F.col("r"))
    cut = let(_pieces(text), lambda p: F.array_join(F.transform("parts", lambda b: F.array_join(F.slice(p, b.getField("first") + 1, b.getField("n")), "")), ""))
    taken = F.when(F.col("took") == F.col("size"), text).otherwise(cut)
    out = whole.join(parts.hint("merge"), F.col("row") == F.col("of")).select("doc", taken.alias("taken"))
    names = [F.col("taken").alias(c) if c == text_col else F.length("taken").cast(docs.schema[c].dataType).alias(c) if c == chars_col else F.col(f"doc.{c}").alias(c) for c in docs.columns]
    return out.select(*names)


def write_shards(mixed: Mix, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the drawn blocks' texts as one folder per shard, in the shard's local random order."""
    texts = block_texts(docs, mixed, id_col, text_col)
    texts.repartition("shard").sortWithinPartitions("shard", "shuffle_key").write.partitionBy("shard").parquet(path)


def _pieces(text: Column) -> Column:
    """Words, each with the white space before it."""
    return F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))


def block_texts(docs: DataFrame, mixed: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, shard, shuffle_key, pass, text) of every drawn block; ids must be unique and not null."""
    b = mixed.blocks.select(F.col("id").alias("b_id"), "shard", "shuffle_key", "pass", "first_word", "words")
    joined = docs.select(F.col(id_col).alias("id"), _pieces(F.col(text_col)).alias("pieces")).join(b, F.col("id") == F.col("b_id"))
    return joined.select("id", "shard", "shuffle_key", "pass", F.array_join(F.slice("pieces", F.col("first_word").cast("int") + 1, F.col("words").cast("int")), "").alias("text"))
