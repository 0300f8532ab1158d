"""The slot for a translation model: batched requests with retries and guards, repair rounds, answers kept by source.

A translator is any object with ``translate(batch: dict[str, str]) -> dict[str, str]``; it runs in the executors.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import shared
from . import detectors, gates, joins


class Translator(Protocol):
    def translate(self, batch: dict[str, str]) -> dict[str, str]: ...


class GlossaryTranslator:
    """A deterministic stand-in: whole glossary terms are replaced, longest first; the rest stays."""

    def __init__(self, terms: dict[str, str]):
        self.terms = terms

    def translate(self, batch: dict[str, str]) -> dict[str, str]:
        out = {}
        for key, text in batch.items():
            for term in sorted(self.terms, key=len, reverse=True):
                text = re.sub(rf"\b{re.escape(term)}\b", lambda _, t=term: self.terms[t], text, flags=re.I)
            out[key] = text
        return out


def digits(text: str) -> list[str]:
    return sorted(re.findall(r"\d+", re.sub(r"(\d),(\d)", r"\1\2", text)))


def same_digits(source: str, target: str) -> bool:
    return digits(source) == digits(target)


def _answers(make: Callable[[], Translator], batch: dict[str, str], tries: int, guard: Callable[[str, str], bool]) -> dict[str, str]:
    """Accepted answers for a batch: tried together, then each missing one alone."""
    model, done = make(), {}

    def ask(part: dict[str, str], times: int) -> None:
        for _ in range(times):
            wanted = {k: v for k, v in part.items() if k not in done}
            if not wanted:
                return
            try:
                got = model.translate(wanted)
            except Exception:  # noqa: BLE001  a failing request is a missing answer
                continue
            done.update({k: str(got[k]).strip() for k in wanted if str(got.get(k, "")).strip() and guard(wanted[k], str(got[k]))})

    ask(batch, tries)
    for key in [k for k in batch if k not in done]:
        ask({key: batch[key]}, 2)
    return done


def request(rows: DataFrame, make: Callable[[], Translator], key: str = "key", text: str = "text", size: int = 10, tries: int = 3, guard: Callable[[str, str], bool] = same_digits) -> DataFrame:
    """(key, result): model answers in batches of ``size``; result is null where no try passed the guard.

    ``make`` builds the translator once per task. Keys are text; a lost task asks again for its own rows only.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for frame in frames:
            keys, texts = frame[key].tolist(), frame[text].fillna("").tolist()
            results: list[str | None] = []
            for i in range(0, len(keys), size):
                batch = {str(n): t for n, t in enumerate(texts[i : i + size])}
                done = _answers(lambda: model, batch, tries, guard)
                results += [done.get(k) for k in batch]
            yield pd.DataFrame({key: keys, "result": results})

    return rows.select(F.col(key).cast("string").alias(key), text).mapInPandas(run, f"{key} string, result string")


def with_cache(rows: DataFrame, cache: DataFrame, make: Callable[[], Translator], text: str = "text", **how) -> DataFrame:
    """(text, result): known answers from ``cache`` (text, result), the others from the model, each source once."""
    wanted = rows.select(text).distinct()
    known, missing = gates.cached(wanted, cache, text)
    asked = missing.select(F.col(text).alias("key"), F.col(text).alias("_source"))
    return known.select(text, "result").unionByName(request(asked, make, "key", "_source", **how).select(F.col("key").alias(text), "result"))


def with_store(rows: DataFrame, store: str, make: Callable[[], Translator], text: str = "text", rounds: int = 8, **how) -> DataFrame:
    """(text, result): answers from the folder ``store``, to which those that it lacks are first added.

    Sources are asked for once each, in ``rounds`` parts by their digest, and each part's answers are appended as soon as
    they are there: a run that is broken off, or a later one, asks only for what the store lacks. A null text counts as
    empty. Unanswered sources aren't stored and have a null result. Of answers to one source that two runs have stored
    the first by time and name of its run holds.
    """
    spark = rows.sparkSession
    schema = "digest string, result string, run string"
    stored = lambda: spark.read.schema(schema).parquet(store) if shared.exists(spark, store) else spark.createDataFrame([], schema)
    source = F.coalesce(F.col(text).cast("string"), F.lit(""))
    wanted = rows.select(source.alias("_source")).distinct().select("_source", F.sha2("_source", 256).alias("digest"))
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    known = lambda: stored().select(F.col("digest").alias("_d"))
    missing = shared.written(joins.looked_up(wanted, known().distinct(), F.col("digest") == F.col("_d"), "left_anti"), "asked")
    part = F.pmod(F.xxhash64("digest"), F.lit(rounds))
    for r in range(rounds):
        here = missing.filter(part == r)
        if here.isEmpty():
            continue
        got = request(here.select("digest", "_source"), make, "digest", "_source", **how).filter("result IS NOT NULL")
        got.select("digest", "result", F.lit(run).alias("run")).write.mode("append").parquet(store)
    answers = stored().groupBy(F.col("digest").alias("_d")).agg(F.min_by("result", "run").alias("result"))
    return wanted.join(answers, F.col("digest") == F.col("_d"), "left").select(F.col("_source").alias(text), "result")


def all_or_nothing(answers: DataFrame, group: str, source: str = "text", target: str = "result") -> DataFrame:
    """(group, accepted): groups of which every answer is there and keeps its numbers."""
    good = F.col(target).isNotNull() & (F.trim(target) != "") & (T.digits_sorted(F.col(source)) == T.digits_sorted(F.col(target)))
    return answers.groupBy(group).agg(F.bool_and(F.coalesce(good, F.lit(False))).alias("accepted"))


def postprocess(rows: DataFrame) -> DataFrame:
    """Rows (type, en, es, drop_cap) with ``es`` put right: thousands, broken sentences, damage types, chapters, lead-ins.

    ``letter`` and ``es`` hold a drop cap and the text after it where the block has one and is long enough.
    """
    t = T.align_damage(F.col("en"), T.join_broken(T.thousands(F.trim("es"))))
    rows = rows.withColumn("es", t)
    rows = rows.withColumn("es", F.when(F.col("type") == "footer", T.restore_chapter(F.col("en"), F.col("es"))).when(F.col("type") == "cuerpo", T.mark_run_ins(F.col("en"), F.col("es"))).otherwise(F.col("es")))
    large = F.col("drop_cap").isNotNull() & (F.length("es") > 30)
    cut = T.drop_cap(F.col("es"))
    return rows.withColumn("_cut", F.when(large, cut)).withColumn("letter", F.col("_cut.letter")).withColumn("es", F.coalesce("_cut.text", "es")).drop("_cut")


#: Font sizes that a block that doesn't fit is tried at.
LADDER = (8.5, 8.3, 8.2)


def repair(blocks: DataFrame, fits: Callable[[DataFrame], DataFrame], shorten: Callable[[DataFrame], DataFrame], terms: list[str], write: Callable[[DataFrame, str], DataFrame], rounds: int = 2, ladder=LADDER) -> DataFrame:
    """Blocks (page, block, t, size) made to fit: ``rounds`` of shortening, then smaller sizes, shortened in between.

    ``fits`` adds a column ``fits``; ``shorten`` returns (page, block, result) for failing blocks. A shortened text must
    keep numbers and glossary terms. Each round works on failing rows only and is a written table (``write``), so a
    lost executor costs one round at most.
    """

    def shortened(now: DataFrame) -> DataFrame:
        new = shorten(now.filter("not fits").select("page", "block", "t")).select(F.col("page").alias("_p"), F.col("block").alias("_b"), "result")
        kept = F.array(*[F.lit(x) for x in terms]) if terms else F.array().cast("array<string>")
        good = F.coalesce(detectors.shortening_accepted(F.col("t"), F.col("result"), kept), F.lit(False))
        out = now.join(new, (F.col("page") == F.col("_p")) & (F.col("block") == F.col("_b")), "left")
        return out.withColumn("t", F.when(good, F.col("result")).otherwise(F.col("t"))).select("page", "block", "t", "size")

    now = write(fits(blocks), "start")
    for i in range(rounds):
        if now.filter("not fits").isEmpty():
            return now
        now = write(fits(shortened(now)), f"short{i}")
    for i, size in enumerate(ladder):
        if now.filter("not fits").isEmpty():
            break
        if i:
            now = write(fits(shortened(now)), f"again{i}")
        capped = now.withColumn("size", F.when(~F.col("fits"), F.least("size", F.lit(float(size)))).otherwise(F.col("size")))
        now = write(fits(capped.select("page", "block", "t", "size")), f"size{i}")
    return now
