"""Quality: held-out accuracy on invented documents, what co-training adds, batches against single rows, edge cases."""

import random

from corpusloom.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string, score double, keep long"


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(400)]
    rows, truth = [], {}
    for i in range(n):
        good = rng.random() < 0.7
        body = [" ".join(rng.choices(words, k=rng.randrange(8, 20))) + "." for _ in range(rng.randrange(2, 12))]
        if not good:
            body = rng.choice([[b.upper().replace(" ", "!! ") for b in body], [b.replace(" ", "%%% ") for b in body], [" ".join([words[i % 400]] * 40)] * 5])
        rows.append((i, "\n".join(body), rng.choice(["en", "fr"]), f"s{rng.randrange(5)}", 0.0, 1))
        truth[i] = int(good)
    return rows, truth


def test_held_out_accuracy_and_filter(spark):
    rows, truth = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, truth[i]) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, quality int")
    table = quality.features(docs)
    model = quality.train(table, labels)
    got = {r["id"]: r for r in quality.score(table, model).collect()}
    unseen = [i for i in truth if i >= 200]
    assert sum(got[i]["keep"] == bool(truth[i]) for i in unseen) >= 0.97 * len(unseen)
    assert all(got[i]["keep"] for i in unseen if truth[i])
    kept = quality.keep_good(quality.features(docs, keep=True), model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["keep"]}


def test_the_bound_on_labelled_rows_holds(spark):
    rows, truth = corpus(200)
    table = quality.features(spark.createDataFrame(rows, SCHEMA))
    labels = spark.createDataFrame(list(truth.items()), "doc_id long, quality int")
    assert quality.train(table, labels, labelled=60, rounds=1) is not None
    assert quality.train(table, labels, labelled=1) is None


def test_batches_equal_single_rows():
    rows, _ = corpus(30)
    whole = quality.Batch.of_rows([(r[1], r[2], r[3]) for r in rows])
    sums = [quality.TextView.sums(whole, whole.lang % 2 == c) for c in (0, 1)]
    view = quality.TextView(__import__("numpy").array(sums))
    scores = view.score(whole)
    for i, r in enumerate(rows):
        assert abs(view.score(quality.Batch.of_rows([(r[1], r[2], r[3])]))[0] - scores[i]) < 1e-9


def test_without_labels_everything_stays(spark):
    docs = spark.createDataFrame([(1, None, None, None, 0.0, 1), (1, None, None, None, 0.0, 1), (2, "", "en", "s", 0.0, 1), (None, "a " * 50000, "en", "s", 0.0, 1)], SCHEMA)
    table = quality.features(docs)
    assert quality.train(table, spark.createDataFrame([(1, 1)], "doc_id long, quality int")) is None
    assert [r["keep"] for r in quality.score(table, None).collect()] == [True] * 4
    assert quality.keep_good(quality.features(docs, keep=True), None).count() == 4
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.score(quality.features(empty), None).collect() == [] and quality.keep_good(quality.features(empty, keep=True), None).collect() == []


def test_texts_without_words_score_like_the_prior(spark):
    rows, truth = corpus()
    odd = [(1000, None, None, None, 0.0, 1), (1001, "", "en", "s1", 0.0, 1), (1002, "ok", "en", "s1", 0.0, 1)]
    table = quality.features(spark.createDataFrame(rows + odd, SCHEMA))
    model = quality.train(table, spark.createDataFrame(list(truth.items()), "doc_id long, quality int"))
    got = {r["id"]: r["keep"] for r in quality.score(table, model).collect()}
    assert got[1000] and got[1001] and got[1002]
