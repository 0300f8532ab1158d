"""Every query of the library against its DuckDB oracle on the smallest tables."""

import collections
import math
import os

import duckdb
import pytest

from corpusloom.plans import registry

SF = "/root/testdata/sf0.001"
#: Queries without SQL; test_plain.py compares them with plain versions.
PLAIN = {"e14_name_words", "e14_name_runs", "f18_remove_echo", "j23_style_contexts", "i7_drop_cap_whole", "i11_normal_tokens_whole", "i15_same_as_source_whole", "i17_break_lists_whole", "d15_align_damage_whole"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return round(float(v), 6)
    return v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    if name not in registry.ORACLES:
        assert name in PLAIN
        return
    found = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = [tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()]
    assert collections.Counter(map(str, got)) == collections.Counter(map(str, want))


def test_list_items_of_marked_lines_and_of_no_page(spark, tmp_path):
    marked = "\n".join(["**" + "x" * 28 + "**", "‹c:00aaff›word‹/c› and some more words", "*one* " * 6])
    docs = [(1, marked), (1, "twice\nunder one id"), (2, "short\nlines\n\nof one page"), (3, ""), (4, None), (None, "of\nno\npage"), (5, "𝔸" * 31 + "\n" + "𝔸" * 30 + "\nb")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = collections.Counter(con.execute(registry.ORACLES["f9_list_items"]).fetchall())
    assert collections.Counter(tuple(r) for r in registry.QUERIES["f9_list_items"](spark, str(tmp_path)).collect()) == want and want.total() == 13
