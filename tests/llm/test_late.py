"""The layout of sales and its overwriting against plain ones; the files themselves."""

import collections
import datetime as dt
import hashlib
import math
import pathlib
import re
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import late, queries

SF = "/root/testdata/sf0.001"
EPOCH, CUT = dt.datetime(1970, 1, 1), dt.datetime(2024, 4, 10)


def day(t):
    return -1 if t is None else (t - EPOCH).days


def plain_layout(rows):
    """Latest-arrived rows by day, in order; rows are dicts."""
    best = {}
    for r in rows:
        rank = lambda r: (r["arrived_at"] is not None, r["arrived_at"] or EPOCH, r["sold_at"] is not None, r["sold_at"] or EPOCH)
        if r["sale_id"] not in best or rank(best[r["sale_id"]]) < rank(r):
            best[r["sale_id"]] = r
    days = collections.defaultdict(list)
    for r in best.values():
        days[day(r["sold_at"])].append(r)
    return best, {d: sorted(v, key=lambda r: (r["sold_at"] or EPOCH, r["sale_id"])) for d, v in days.items()}


def plain_files(rows):
    """Contract's rows, without the path."""
    more = []
    for r in rows:
        h = zlib.crc32(str(r["sale_id"]).encode())
        if h % 3 == 0 and day(r["sold_at"]) % 7 == 0:
            more.append(r | {"total": None if r["total"] is None else r["total"] + 1, "sold_at": r["sold_at"] + dt.timedelta(h % 2), "arrived_at": r["arrived_at"] and r["arrived_at"] + dt.timedelta(1 + h % 97)})
    size, every = 1 + len(rows) // 700, rows + more
    early = [r for r in every if r["arrived_at"] is not None and r["arrived_at"] < CUT]
    before, began = plain_layout(early)
    after, days = plain_layout(every)
    dirty = set()
    for r in every:
        if (r["arrived_at"] is None or r["arrived_at"] >= CUT) and after[r["sale_id"]] is r:
            dirty |= {day(r["sold_at"])} | ({day(before[r["sale_id"]]["sold_at"])} if r["sale_id"] in before else set())
    micros = lambda t: "" if t is None else str((t - EPOCH) // dt.timedelta(microseconds=1))
    out = {}
    for d, all_rows in days.items():
        for k in range(0, len(all_rows), size):
            part = all_rows[k : k + size]
            cents = sum(math.floor(100 * r["total"] + 0.5) for r in part if r["total"] is not None)
            crc = sum(zlib.crc32(f"{r['sale_id']}:{micros(r['sold_at'])}:{micros(r['arrived_at'])}".encode()) for r in part)
            out[d, k // size] = (len(part), cents, crc, hashlib.sha256(",".join(str(r["sale_id"]) for r in part).encode()).hexdigest(), d in dirty or d not in began)
    return out


def table(rows, spark, path):
    kinds = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int"
    spark.createDataFrame([tuple(r.values()) for r in rows], kinds).repartition(3).write.parquet(f"{path}/sales.parquet")
    return str(path)


def planted():
    """Late rows on few days, moved sales, a day that loses all its sales, nulls."""
    at = lambda *x: dt.datetime(2024, *x)
    row = lambda i, sold, arrived, total=10.25: {"sale_id": i, "client_id": 1, "status": "done", "total": total, "sold_at": sold, "arrived_at": arrived, "priority": 1}
    rows = [row(i, at(1, 1 + i % 20, i % 24, 5), at(2, 1, 0, i % 60)) for i in range(1500)]
    rows += [row(i, at(1, 3, 7), at(4, 11 + i % 3)) for i in range(0, 400, 40)]  # move to the third of January
    rows += [row(5000, at(3, 1), at(3, 2)), row(5000, at(1, 3), at(5, 1), None), row(5001, None, at(3, 1)), row(5002, at(2, 2), None), row(5003, at(1, 4), at(1, 5), float("nan"))]
    return rows


@pytest.mark.parametrize("rows", ["sales", "planted"])
def test_op12(spark, tmp_path, rows):
    path = SF
    if rows == "planted":
        path = table([r for r in planted() if r["total"] is None or r["total"] == r["total"]], spark, tmp_path)
    want = plain_files([r.asDict() for r in spark.read.parquet(f"{path}/sales.parquet").collect()])
    found = queries.op12_late_overwrite(spark, path).collect()
    assert {(r["day"], r["file_no"]): (r["n_rows"], r["cents"], r["rows_crc"], r["ids_sha256"], r["rewritten"]) for r in found} == want and len(found) == len(want)
    assert len({r["rewritten"] for r in found}) == 2
    assert {r["columns"] for r in found} == {"sale_id,client_id,status,total,sold_at,arrived_at,priority"}
    folder = found[0]["path"].split("/day=")[0].removeprefix("file://")
    there = {f"file://{p}" for p in map(str, pathlib.Path(folder).rglob("*")) if re.search(r"part-", p) and not p.endswith(".crc")}
    assert there == {r["path"] for r in found}


def test_untouched_files_stay_and_lost_days_go(spark, tmp_path):
    rows = spark.createDataFrame([tuple(r.values()) for r in planted()], "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int").withColumn("day", F.lit("mine"))
    early = F.coalesce(F.col("arrived_at") < F.lit(CUT), F.lit(False))
    layout = late.write(rows.filter(early), 10, f"file://{tmp_path}/layout")
    read = lambda: {f: open(f.removeprefix("file://"), "rb").read() for f in (r["path"] for r in layout.files(spark).collect())}
    before = read()
    assert any("day_=19783" in f for f in before)  # the first of March
    found = late.overwrite(spark, layout, rows.filter(~early)).collect()
    after = read()
    same = {r["path"] for r in found if not r["rewritten"]}
    assert same and all(before[f] == after[f] for f in same) and not {r["path"] for r in found if r["rewritten"]} & set(before)
    assert not any("day_=19783" in f for f in after) and sorted(r["path"] for r in found) == sorted(after)
    assert pq.read_schema(next(iter(after)).removeprefix("file://")).names == rows.columns
    # a run that was broken off before the lost day went is begun again
    held = lambda: [tuple(r)[1:] for r in late.digests(layout.files(spark)).orderBy("day", "file_no").collect()]
    want = held()
    lost = next(f for f in before if "day_=19783" in f).removeprefix("file://")
    pathlib.Path(lost).parent.mkdir()
    pathlib.Path(lost).write_bytes(before[f"file://{lost}"])
    late.overwrite(spark, layout, rows.filter(~early)).collect()
    assert held() == want


def test_rows_without_a_key_and_empty_tables(spark):
    t = dt.datetime(2024, 1, 5, 10)
    kinds = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int, props map<string,string>"
    rows = spark.createDataFrame([(None, 1, "a", 1.0, t, t, 1, {"a": "b"})] * 5 + [(4, 1, "a", float("inf"), t, t, 1, None)] * 5, kinds)
    layout = late.write(rows, 4)
    assert [(r["file_no"], r["n_rows"]) for r in late.digests(layout.files(spark)).orderBy("file_no").collect()] == [(0, 4), (1, 2)]
    assert late.overwrite(spark, layout, rows.limit(0)).filter("rewritten").count() == 0
    assert late.overwrite(spark, layout, rows.filter("sale_id IS NULL").limit(1)).filter("rewritten").count() == 2
    empty = late.write(rows.limit(0), 4)
    assert late.digests(late.overwrite(spark, empty, rows.limit(0))).count() == 0
    assert late.digests(late.overwrite(spark, empty, rows)).count() == 2
