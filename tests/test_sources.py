"""Files: the hash cascade, files that rows name, page ranges that are pushed down, what can't be read."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import audit
from corpusloom.sources import named, readers


def folder(tmp_path, contents):
    for name, content in contents.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    return str(tmp_path)


def test_cascade_reads_no_further_than_it_must(spark, tmp_path):
    chunk = 100
    same, other = b"s" * 950, b"s" * 949 + b"x"
    contents = {"a/one": same, "a/two": same, "b/near": other, "b/unlike": b"u" * 950, "alone": b"q" * 951, "empty": b"", "empty2": b"", "short": b"k" * 40, "short2": b"k" * 40, "short3": b"l" * 40}
    listed = readers.files(spark, folder(tmp_path, contents))
    gone = spark.createDataFrame([("r", "lost", f"{tmp_path}/lost", 950)], listed.schema)
    found = {os.path.relpath(r["path"], tmp_path): r for r in audit.cascade(listed.unionByName(gone), chunk).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert {k: (r["sha256"], r["bytes_read"]) for k, r in found.items()} == {
        "a/one": (sha(same), 1050), "a/two": (sha(same), 1050), "b/near": (sha(other), 1050), "b/unlike": (None, 100), "lost": (None, 0),
        "short": (sha(b"k" * 40), 40), "short2": (sha(b"k" * 40), 40), "short3": (None, 40),
    }
    assert found["lost"]["error"] == "FileNotFoundError" and sum(r["error"] is not None for r in found.values()) == 1
    copies = {os.path.relpath(r["path"], tmp_path): r["copies"] for r in audit.copies(audit.cascade(listed, chunk)).collect()}
    assert copies == {"a/one": 2, "a/two": 2, "short": 2, "short2": 2}


def test_duplicates_are_the_same_for_any_bound_on_sizes(spark, monkeypatch):
    rows = [(f"p{i}", len(c), c) for i, c in enumerate([b"aa", b"aa", b"ab", b"b", b"ccc", b"ccc", b"dddd", b"", b""])]
    df = spark.createDataFrame(rows, "path string, size_bytes long, content binary")
    want = sorted(map(str, audit.duplicate_members(df).collect()))
    assert len(want) == 5
    monkeypatch.setattr(audit, "SIZES", 1)
    assert sorted(map(str, audit.duplicate_members(df).collect())) == want
    assert {r["copies"] for r in audit.duplicate_groups(df).collect()} == {2}


def files_below(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names)


def test_named_files_appear_together_or_not_at_all(spark, tmp_path):
    df = spark.range(0, 40, 1, 4).select(F.format_string("d%d/pag-%03d.txt", F.col("id") % 3, "id").alias("name"), F.col("id").cast("string").alias("text"))
    named.write(df, str(tmp_path))
    assert len(files_below(tmp_path)) == 40 and (tmp_path / "d1/pag-007.txt").read_text() == "7"
    failing = df.select(F.concat(F.lit("new/"), "name").alias("name"), F.when(F.col("text") == "35", F.raise_error(F.lit("no"))).otherwise(F.col("text")).alias("text"))
    with pytest.raises(Exception, match="no"):
        named.write(failing, str(tmp_path))
    assert len(files_below(tmp_path)) == 40 and not [d for d in os.listdir(tmp_path) if d.startswith(named.STAGING) or d == "new"]
    named.write(df.limit(1).withColumn("text", F.lit(None).cast("string")), str(tmp_path))
    assert len(files_below(tmp_path)) == 40 and (tmp_path / "d0/pag-000.txt").read_text() == ""
    named.write(df.limit(3), str(tmp_path), overwrite=True)
    assert len(files_below(tmp_path)) == 3


def test_a_range_of_pages_is_pushed_down(spark, tmp_path):
    df = spark.range(0, 60).select(F.concat(F.lit("pag-"), F.lpad(F.col("id").cast("string"), 3, "0"), F.lit(".txt")).alias("name"), F.repeat(F.lit("x"), F.col("id").cast("int")).alias("text"))
    named.write(df.unionByName(spark.createDataFrame([("cover.txt", "c")], df.schema)), str(tmp_path))
    whole, some = (named.read(spark, str(tmp_path), *bounds, task_bytes=10 * named.FILE_BYTES) for bounds in ((), (20, 34)))
    assert whole.rdd.getNumPartitions() == 7 and some.rdd.getNumPartitions() == 2
    assert sorted((r["page"], len(r["text"])) for r in some.collect()) == [(i, i) for i in range(20, 35)]
    assert whole.count() == 61 and whole.filter("page IS NULL").first()["name"] == "cover.txt" and whole.filter("page = 7").count() == 1
    assert whole.count() == 61 and named.read(spark, str(tmp_path), first=100).count() == 0
