"""WARC: exact round trips of framing, segments and archives; revisits against a plain version; broken archives fail."""

import gzip
import hashlib
import io
import random

import pytest

from corpusloom.llm import warc

SCHEMA = "page_id long, url string, html string, type string, block long"


def test_chunk_framing():
    for n in (0, 1, 7, 8, 9, 100):
        payload = random.Random(n).randbytes(n)
        assert warc.dechunked(warc.chunked(payload, 8)) == payload
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc")


def test_records_parse_whatever_the_payload():
    payload = b"x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9
    out = b"".join(r + b"\r\n\r\n" for r in warc.records(7, "http://a/\r\nb", payload, None, 50))
    found = list(warc.parse(io.BytesIO(out)))
    assert [f.get("warc-segment-number") for f, _ in found] == [str(i + 1) for i in range(len(found))] and len(found) > 2
    block = b"".join(b for _, b in found)
    assert len(block) == int(found[-1][0]["warc-segment-total-length"]) and warc.payload_of(block) == payload


def pages():
    rng = random.Random(1)
    big = ["".join(rng.choices("abc\r\n é🙂", k=k)) for k in (999, 1000, 1001, 5000, 200_000)]
    rows = [(i, f"http://h/{i}", rng.choice([*big, "short", "", None])) for i in range(60)]
    return [(*r, "clash", 1) for r in rows] + [(100, None, big[3], "c", 1), (None, "http://n", big[3], "c", 1), (None, "http://n", None, "c", 1)]


@pytest.mark.parametrize("segment", [300, 64 << 10])
def test_archives(spark, segment):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA)
    path = warc.write(df, segment_bytes=segment, file_records=25)
    got = warc.resolve(warc.read(spark, path)).collect()
    assert len(got) == len(rows)
    top = {}
    for i, _, html, *_ in rows:
        if i is not None:
            top[html or ""] = max(top.get(html or "", -1), i)
    want = []
    for i, _, html, *_ in rows:
        b = (html or "").encode()
        again = i is not None and len(b) >= 1000 and top[html] != i
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top[html] if again else None))
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    stored = {r["page_id"]: r["payload"] for r in warc.read(spark, path).filter("type = 'response' and page_id is not null").collect()}
    assert all((html or "").encode() == stored[i] for i, _, html, *_ in rows if i in stored)


@pytest.mark.parametrize("segment", [300, 64 << 10])
def test_repeated_ids_keep_every_row(spark, segment):
    a, b, c = "a" * 1500, "b" * 1500, "c" * 200_000
    rows = [(5, "u", a), (5, "u", b), (9, "u", a), (9, "v", a), (6, "u", c), (6, "u", c), (7, "u", c + "1"), (7, "u", c + "2"), (1, "u", c), (None, "n", c), (None, "n", c), (8, "u", "x"), (8, "u", "x"), (8, "u", "y")]
    path = warc.write(spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3), segment_bytes=segment, file_records=25)
    found = warc.read(spark, path)
    sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
    want = [(i, len(t), sha(t), *(("revisit", 9) if (i, t) == (5, a) else ("revisit", 6) if (i, t) == (1, c) else ("response", None))) for i, _, t in rows]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r) for r in warc.resolve(found).collect()), key=key) == sorted(want, key=key)
    kept = sorted(r["payload"].decode() for r in found.filter("type = 'response'").collect())
    assert kept == sorted(t for i, _, t in rows if (i, t) not in ((5, a), (1, c)))
    assert found.select("record_id").distinct().count() == len(rows)


def test_missing_segment_fails(spark, tmp_path):
    records = warc.records(1, "u", b"y" * 500, None, 100)
    for name, kept in (("whole", records[::-1]), ("broken", records[:1] + records[2:])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.gz").write_bytes(gzip.compress(b"".join(r + b"\r\n\r\n" for r in kept)))
    assert warc.read(spark, f"file://{tmp_path}/whole").first()["payload"] == b"y" * 500
    with pytest.raises(Exception, match="segments missing"):
        warc.read(spark, f"file://{tmp_path}/broken").collect()


def test_empty_table(spark):
    path = warc.write(spark.createDataFrame([], SCHEMA))
    assert warc.resolve(warc.read(spark, path)).collect() == []
