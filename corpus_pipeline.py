"""The corpus pipeline: five stages over the documents, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import mixing, pieces, quality, secrets, simhash
from corpusloom.llm.common import forget, recorded, remove, written

#: For each thread and application: the stage that was called last, and the tables that it wrote for itself.
_LAST: ContextVar[dict[str, tuple[int, list[str]]]] = ContextVar("corpus_pipeline_last")


def stage(place: int):
    """A stage, called after those before it in the same thread.

    Its result is written before the next one begins, so that one deletes what it wrote for itself. The first stage
    begins anew: it deletes nothing, and nothing deletes what the last one wrote, which its result may be read from.
    """

    def of(work):
        @functools.wraps(work)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            last = dict(_LAST.get({}))
            before, own = last.pop(spark.sparkContext.applicationId, (None, []))
            if before == place - 1:
                for path in own:
                    remove(spark, path)
            with recorded() as paths:
                out = work(spark, docs, sf_dir)
            _LAST.set(last | {spark.sparkContext.applicationId: (place, paths)})
            return out

        return run_stage

    return of


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@stage(0)
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier doesn't reject.

    Each text's features are computed once, into a table that the classifier is trained and applied on. Null and empty
    texts say little and stay; repeated rows are judged alike; without labels of both classes, and from an empty table,
    every document stays. Other columns than those of documents are left out.
    """
    table = quality.features(docs.select(*COLUMNS), keep=True)
    return quality.keep_good(table, quality.train(table, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@stage(1)
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id.

    Near-duplicates have a Jaccard similarity of 0.8 or more on five-word shingles, which fingerprints can't bound.
    Texts without words, null or empty, are copies of each other; a repeated doc_id stays once, rows without one stay.
    """
    return simhash.keep_one(docs.select(*COLUMNS))


@stage(2)
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, owner-specific credentials replaced in their texts.

    Who owns a value is counted over all documents of ``sf_dir``, equal texts once, so that an example that many share
    is known as one though its copies have gone. Null texts stay null, repeated rows are treated alike.
    """
    clear = secrets.redact(docs.select(*COLUMNS), corpus=spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS))
    return clear.withColumn("n_chars", F.length("text").cast("long"))


@stage(3)
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, a row for each pass over it.

    Documents without words, null or empty, aren't taken; a null source is a source; repeated rows are documents of
    their own.
    """
    return mixing.mixed_documents(docs.select(*COLUMNS))


@stage(4)
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row's text, with a check that they decode to it. Null and empty texts have no ids."""
    return written(pieces.round_trip(docs, ["doc_id", "lang", "source"]), "encoded")


STAGES = [
    ("quality classifier", good_quality),
    ("near-dedup by shingles", without_near_duplicates),
    ("secret scan", without_secrets),
    ("source mix", mixed),
    ("sentencepiece", encoded),
]

#: SQL has neither the classifier nor fingerprints, so the pipeline is tested against a plain version of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the result stays readable. Empty tables give an empty result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, work) in enumerate(STAGES):
        before, docs = docs, work(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage{i}")
            forget(before)
    return docs
