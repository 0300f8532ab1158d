"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Every text is searched for assignments, access keys and long hexadecimal runs (the base kinds) and for mixed-case
tokens (kind ``mixed``). Each found value is hashed and its hash counted over the whole corpus by the distinct
owners and repositories that hold it. A value that more than ``max_owners`` owners or ``max_repos`` repositories
hold is a widely copied example; the rest are owner-specific and look live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, spread, written

# The base patterns, in the order in which kinds with equal starts are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIXED = r"[A-Za-z0-9+/_-]{20,}"

#: (kind, pattern, group that holds the value, least length of the value, a match that can't be missing from a text with spans)
KINDS = (
    ("assign", ASSIGN, 2, 6, ASSIGN),
    ("access", ACCESS, 0, 20, r"AKIA[A-Z0-9]{16}"),
    ("hex", HEX, 0, 24, r"[0-9a-f]{24}"),
    ("mixed", MIXED, 0, 20, MIXED),
)
BASE = ("assign", "access", "hex")
#: Owners and repositories up to which a value is taken for leaked, not for an example, where texts are redacted.
REDACT_OWNERS, REDACT_REPOS = 5, 10
_SPAN = "array<struct<start:bigint,ord:int,kind:string,end:bigint,hash:string>>"


def _running(lengths: Column) -> Column:
    """Sums of all earlier elements, in blocks of about the square root of the number of elements."""
    zero = F.lit(0).cast("long")
    total = lambda a: F.aggregate(a, zero, lambda s, x: s + x)

    def blocks(d: Column) -> Column:
        n = F.size(d)
        step = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
        count = F.ceil(n / step).cast("int")

        def inner(b: Column) -> Column:
            sums = F.transform(F.sequence(F.lit(0), b.getField("count") - 1), lambda i: total(F.slice(d, i * b.getField("step") + 1, b.getField("step"))))
            return let(
                sums,
                lambda s: let(
                    F.transform(s, lambda _, i: total(F.slice(s, F.lit(1), i))),
                    lambda base: F.transform(d, lambda _, k: base[F.floor(k / b.getField("step")).cast("int")] + total(F.slice(d, (F.floor(k / b.getField("step")).cast("int") * b.getField("step")) + 1, k % b.getField("step")))),
                ),
            )

        return let(F.struct(step.alias("step"), count.alias("count")), inner)

    return let(lengths, blocks)


def _spans(text: Column, order: int, kind: str, pattern: str, group: int, least: int, must: str) -> Column:
    """Spans of one kind: matches lie between the pieces that splitting at the same pattern leaves."""

    def located(found: Column) -> Column:
        steps = F.transform(found.getField("match"), lambda m, i: (F.length(found.getField("gap")[i]) + F.length(m)).cast("long"))
        spans = let(
            _running(steps),
            lambda before: F.transform(
                found.getField("match"),
                lambda m, i: F.struct(
                    (before[i] + F.length(found.getField("gap")[i])).alias("start"),
                    F.lit(order).alias("ord"),
                    F.lit(kind).alias("kind"),
                    (before[i] + F.length(found.getField("gap")[i]) + F.length(m)).alias("end"),
                    found.getField("value")[i].alias("value"),
                ),
            ),
        )
        good = lambda s: F.length(s.getField("value")) >= least
        if kind == "mixed":
            good = lambda s: s.getField("value").rlike("[0-9]") & s.getField("value").rlike("[a-z]") & s.getField("value").rlike("[A-Z]")
        return F.transform(F.filter(spans, good), lambda s: F.struct(s.getField("start"), s.getField("ord"), s.getField("kind"), s.getField("end"), F.sha2(s.getField("value"), 256).alias("hash")))

    found = F.struct(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    return F.when(text.rlike(must), let(found, located).cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def all_spans(text: Column) -> Column:
    """Every candidate span of a whole text, unordered; offsets are code points, ends exclusive."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.concat(*[_spans(text, i, *k) for i, k in enumerate(KINDS)])


def _counted(places: DataFrame, once: bool = False) -> DataFrame:
    """(value, owners, repos) of each value's hash, from places (owner, repo, spans; ``copy``, a digest of the text).

    Counting goes through distinct (hash, owner, repository) rows, so a value that fills the corpus is summed before
    it is moved. With ``once`` equal texts count for one owner and repository, wherever their copies lie.
    """
    if once:
        homes = _one_place(places).select("value", F.col("home.owner").alias("owner"), F.col("home.repo").alias("repo")).distinct()
    else:
        homes = places.select(F.explode("spans.hash").alias("value"), "owner", "repo").distinct()
    held = homes.groupBy("value", "owner").agg(F.count("*").alias("repos"))
    return held.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))


def _judged(hits: DataFrame, counts: DataFrame, max_owners: int, max_repos: int) -> DataFrame:
    """(row, judged): the spans of each row of ``hits`` with owners, repos and live of their value's hash.

    ``hits`` is a written table with row and spans. A value that the counted places lack has one owner. The spans of a
    value that fills the corpus stay where they are: it is broadcast, with the other heavy ones.
    """
    each = hits.select("row", F.explode("spans").alias("s")).withColumn("hash", F.col("s.hash"))
    weight = each.groupBy(F.col("hash").alias("h")).agg(F.count("*").alias("n"))
    known = weight.join(counts, F.col("h") == F.col("value"), "left").select("h", "n", F.coalesce("owners", F.lit(1)).alias("owners"), F.coalesce("repos", F.lit(1)).alias("repos"))
    out = spread(each, written(known, "values"), "hash", "h", "n")
    live = (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
    span = F.struct(*[F.col(f"s.{c}").alias(c) for c in ("start", "ord", "kind", "end", "hash")], F.col("owners"), F.col("repos"), live.alias("live"))
    return out.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("judged"))


def _one_place(hits: DataFrame) -> DataFrame:
    """(value, copy, home): the (owner, repo) that a value's text counts for.

    Of all places that hold the text it is the one of the owner, then the repository, with most texts of the value.
    """
    each = hits.select("copy", "owner", "repo", F.explode("spans.hash").alias("value")).distinct()
    in_repo = each.groupBy("value", "owner", "repo").agg(F.count("*").alias("of_repo"))
    in_owner = each.select("value", "owner", "copy").distinct().groupBy("value", "owner").agg(F.count("*").alias("of_owner"))
    ranked = each.join(in_repo, ["value", "owner", "repo"]).join(in_owner, ["value", "owner"])
    order = F.struct(-F.col("of_owner"), F.col("owner"), -F.col("of_repo"), F.col("repo"))
    return ranked.groupBy("value", "copy").agg(F.min_by(F.struct("owner", "repo"), order).alias("home"))


def _columns(owner: str, repo: str) -> list[Column]:
    return [F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.coalesce(F.col(repo).cast("string"), F.lit("")).alias("repo")]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "lang", max_owners: int = 1, max_repos: int = 2) -> DataFrame:
    """One row per input row: id and spans, sorted by start and kind.

    A span has start, ord, kind, end, hash (SHA-256 of the value), owners, repos and live. Base kinds are all
    reported; spans of kind ``mixed`` only where their value is owner-specific. A repository is a pair of owner
    and repository name; nulls are one more name. Null texts are empty, repeated rows are scanned each, other columns
    don't matter, and an empty table gives an empty table.
    """
    found = written(docs.select(F.col(id_col).alias("id"), *_columns(owner_col, repo_col), all_spans(F.col(text_col)).alias("spans")).withColumn("row", F.monotonically_increasing_id()), "spans")
    some = found.filter(F.size("spans") > 0)
    judged = _judged(some, _counted(some), max_owners, max_repos).select(F.col("row").alias("of"), F.filter("judged", lambda s: s.getField("kind").isin(*BASE) | s.getField("live")).alias("spans"))
    with_spans = some.select("id", "row").join(judged, F.col("row") == F.col("of")).select("id", "spans")
    none = found.filter(F.size("spans") == 0).select("id", F.array().cast(with_spans.schema["spans"].dataType).alias("spans"))
    return with_spans.unionByName(none)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and the list of all spans, from the result of :func:`scan`."""
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.getField("kind"), s.getField("start"), s.getField("end"))), ",")
    count = lambda want: F.size(F.filter("spans", want)).cast("long")
    of_kind = lambda kind: count(lambda s: s.getField("kind") == kind)
    return scanned.select(
        "id",
        *[of_kind(k).alias(f"n_{k}") for k in BASE],
        F.sha2(told(F.filter("spans", lambda s: s.getField("kind").isin(*BASE))), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
        count(lambda s: s.getField("live")).alias("n_live"),
        count(lambda s: ~s.getField("live")).alias("n_example"),
    )


def redact(docs: DataFrame, text_col: str = "text", owner_col: str = "source", repo_col: str = "lang", mark: str = "[SECRET]", max_owners: int = REDACT_OWNERS, max_repos: int = REDACT_REPOS, corpus: DataFrame | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with every owner-specific value's span replaced by ``mark``.

    Owners are counted over ``corpus``, a table with the same columns, or over ``docs``: a corpus from before its copies
    were dropped shows who else held a value. A key may have leaked to some owners, so a value is left in as an example
    only beyond ``max_owners`` or ``max_repos``, well above the bounds of :func:`scan`. Equal texts count for one owner and repository there (:func:`scan` counts
    every row's), so copies of one text don't make a value a widely copied example. Spans that overlap are replaced
    together; null and empty texts stay, repeated rows are kept, an empty table gives an empty table. The number of
    characters isn't updated here. Each text is searched once; only those with spans are judged and joined.
    """
    text = F.col(f"doc.{text_col}")
    names = docs.columns
    places = lambda df: [*_columns(owner_col, repo_col), F.sha2(F.col(text_col).cast("string"), 256).alias("copy"), all_spans(F.col(text_col)).alias("spans")]
    found = written(docs.select(F.struct(*names).alias("doc"), *places(docs)).withColumn("row", F.monotonically_increasing_id()), "searched", compression="zstd")
    hits = found.filter(F.size("spans") > 0)
    held = hits if corpus is None else written(corpus.select(*places(corpus)).filter(F.size("spans") > 0), "places")
    judged = _judged(hits, _counted(held, once=True), max_owners, max_repos).select(F.col("row").alias("of"), F.filter("judged", lambda s: s.getField("live")).alias("live"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        inside = s.getField("start") < acc.getField("at")
        gap = F.when(inside, F.lit("")).otherwise(F.concat(F.substring(text, acc.getField("at").cast("int") + 1, (s.getField("start") - acc.getField("at")).cast("int")), F.lit(mark)))
        return F.struct(F.greatest(acc.getField("at"), s.getField("end")).alias("at"), F.concat(acc.getField("out"), gap).alias("out"))

    clear = F.aggregate("live", start, step, lambda a: F.concat(a.getField("out"), F.substring(text, a.getField("at").cast("int") + 1, F.length(text))))
    done = hits.join(judged, F.col("row") == F.col("of"), "left").select(*[(F.when(F.size("live") > 0, clear).otherwise(text).alias(c) if c == text_col else F.col(f"doc.{c}").alias(c)) for c in names])
    return found.filter(F.size("spans") == 0).select("doc.*").unionByName(done)
