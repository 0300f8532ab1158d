"""The pipeline's stages one after the other against plain versions of what each must do."""

import collections

import corpus_pipeline
from corpusloom.llm import queries, quality, secrets
from corpusloom.llm.common import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test")
        out[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
    good = {r["doc_id"]: r for r in out["quality classifier"]}
    assert all(good[i]["text"] == before[i]["text"] for i in good)
    assert sum(labels[i] == 1 and i not in good for i in labels) <= 0.02 * len(labels)
    rejected = [i for i in before if i not in good]
    assert rejected and sum(labels.get(i, 0) == 0 for i in rejected) >= 0.9 * len(rejected)
    single = {r["doc_id"]: r for r in out["near-dedup by shingles"]}
    assert len({r["text"] for r in single.values()}) == len({r["text"] for r in good.values()} & {r["text"] for r in single.values()})
    first = {}
    for i in sorted(good):
        first.setdefault(good[i]["text"], i)
    assert set(single) <= set(first.values())
    clean = {r["doc_id"]: r for r in out["secret scan"]}
    assert set(clean) == set(single) and all(r["n_chars"] == len(r["text"]) for r in clean.values())
    changed = [i for i in clean if clean[i]["text"] != single[i]["text"]]
    assert all(secrets.all_spans is not None and "[SECRET]" in clean[i]["text"] for i in changed)
    words = collections.Counter()
    for r in out["source mix"]:
        words[r["doc_id"]] += len(r["text"].encode().split())
        assert r["n_chars"] == len(r["text"])
    size = {i: len(r["text"].encode().split()) for i, r in clean.items()}
    assert all(words[i] <= 2 * size[i] for i in words)
    assert abs(sum(words.values()) - 1.5 * sum(size.values())) <= len({r["source"] for r in clean.values()})
    assert all(r["same"] for r in out["sentencepiece"]) and len(out["sentencepiece"]) == len(out["source mix"])


def test_run_and_queries_are_registered(spark):
    import __spark_entry__

    found = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in queries.QUERIES}
    assert found["pipeline"] is corpus_pipeline.run and set(queries.QUERIES) <= set(found)
    assert quality.LABELLED == 20_000


def test_runs_leave_each_others_results(spark, tmp_path):
    """Two runs one after the other, and two in threads of their own."""
    import threading

    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").filter("doc_id < 40").write.parquet(f"{tmp_path}/{t}.parquet")
    first = corpus_pipeline.run(spark, str(tmp_path))
    second = corpus_pipeline.run(spark, str(tmp_path))
    results = []
    threads = [threading.Thread(target=lambda: results.append(corpus_pipeline.run(spark, str(tmp_path)))) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    rows = [sorted(map(str, df.collect())) for df in (first, second, *results)]
    assert len(rows) == 4 and rows[0] and all(r == rows[0] for r in rows)
