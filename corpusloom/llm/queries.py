"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import late, licenses, media, mixing, neighbours, oracles, packing, pieces, quality, secrets, simhash, tokenfile, trie, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload and record type of every page, read back from the written archives."""
    return warc.resolve(warc.read(spark, warc.write(table(spark, sf_dir, "pages"))))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest doc_id reachable over links of at most 3 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op1_itq_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct links and component of every vector."""
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings")).select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's ids, read back from the written files."""
    manifest, path = tokenfile.save(table(spark, sf_dir, "documents"))
    return tokenfile.read(manifest, path)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether decoding gives its text back."""
    return pieces.round_trip(table(spark, sf_dir, "documents"), ["doc_id"])


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own and inherited licence of every document, filed as source/lang/doc_id; every notice speaks for its directory."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licenses.scan(table(spark, sf_dir, "documents"), path=path, declares=F.lit(True)).withColumnRenamed("id", "doc_id")


def op7_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by the two co-trained views and together."""
    found = quality.features(table(spark, sf_dir, "documents"))
    return quality.score(found, quality.train(found, table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")


def op8_wav_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a WAV file and read back, with its spectral fingerprint, whole and in short."""
    stored = media.to_media(table(spark, sf_dir, "documents"))
    stored = stored.select("id", "n_bytes", "media", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"))
    read = media.analyse(stored, ["id", "n_bytes", "media_bytes", "media_sha256"])
    feature = F.concat_ws(":", F.size("prints"), F.lower(F.lpad(F.hex(F.xxhash64("prints")), 16, "0")))
    return read.select(F.col("id").alias("doc_id"), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"), "prints")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every document, and the owner-specific tokens that corpus-wide counting adds."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, with its source's size and target."""
    return mixing.mix(table(spark, sf_dir, "documents")).taken().select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie over all rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_late_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the layout of all sales, of which only the days that late rows change were written twice."""
    sales = table(spark, sf_dir, "sales")
    h = F.crc32(F.col("sale_id").cast("string").cast("binary"))
    again = sales.filter((h % 3 == 0) & (late.day_of(sales, "sold_at") % 7 == 0))
    days = lambda n: F.make_dt_interval(days=n.cast("int"))
    again = again.withColumns({"total": F.col("total") + 1, "sold_at": F.col("sold_at") + days(h % 2), "arrived_at": F.col("arrived_at") + days(1 + h % 97)})
    rows = sales.unionByName(again)
    early = F.coalesce(F.col("arrived_at") < F.lit("2024-04-10 00:00:00").cast(sales.schema["arrived_at"].dataType), F.lit(False))
    layout = late.write(rows.filter(early), 1 + sales.count() // 700)
    return late.digests(late.overwrite(spark, layout, rows.filter(~early)))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence and offset of every piece of every document."""
    return packing.slots(packing.pieces(table(spark, sf_dir, "documents")).drop("ids")).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_itq_neighbours": op1_itq_neighbours,
    "op2_token_files": op2_token_files,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_warc_archives": op4_warc_archives,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_quality_cotraining": op7_quality_cotraining,
    "op8_wav_fingerprints": op8_wav_fingerprints,
    "op9_secret_scan": op9_secret_scan,
    "op10_mix_sources": op10_mix_sources,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_late_overwrite": op12_late_overwrite,
    "op13_best_fit_packing": op13_best_fit_packing,
}

#: DuckDB SQL for the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op4_warc_archives": oracles.WARC,
    "op6_license_scan": oracles.LICENSES,
    "op9_secret_scan": oracles.SECRETS,
}
