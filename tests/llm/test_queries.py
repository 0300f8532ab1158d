"""The registered queries themselves: their SQL, and planted tables against brute force."""

import collections
import hashlib
import math
import os
import random
import zlib

import duckdb
import numpy as np
import pytest
from test_mixing import plain_targets
from test_neighbours import brute as linked
from test_simhash import brute as reachable
from test_simhash import plain as simhash

from corpusloom.llm import media, pieces, quality, queries, tokenfile
from corpusloom.llm.common import tokenizer_path, written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = con.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = collections.Counter(str([r[names.index(c)] for c in columns]) for r in found.fetchall())
    assert collections.Counter(str([r[c] for c in columns]) for r in df.collect()) == want


def vectors(mean, rng):
    """Clusters of several widths, copies, and a large group of near copies, with a common mean."""
    rows, centres = [], rng.standard_normal((40, 64))
    for _ in range(400):
        rows.append((centres[rng.integers(40)] + rng.standard_normal(64) * rng.choice([0.0, 0.05, 0.13]), int(rng.integers(3))))
    hot = rng.standard_normal(64)
    rows += [(hot + rng.standard_normal(64) * 0.01, 1) for _ in range(1400)]
    return [(i, [float(x) for x in np.float32(v + mean)], label) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("mean", [0.0, 2.0])
def test_op1(spark, tmp_path, mean):
    rows = vectors(mean, np.random.default_rng(3))
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    got = {r["vec_id"]: r for r in queries.op1_itq_neighbours(spark, str(tmp_path)).collect()}
    assert spark.conf.get(key) == before
    x = np.array([v for _, v, _ in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([k for *_, k in rows])
    hit = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    links = hit.sum(axis=1) - 1
    found = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert len(got) == len(rows) and (found <= links).all() and found.sum() >= 0.98 * links.sum() and links.max() >= 1399
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)
    if not mean:
        _, top = linked([r for r in rows if r[0] < 400])
        assert sum(got[i]["component_id"] == top[i] for i in top) >= 0.97 * len(top)
    assert len({got[i]["component_id"] for i in range(400, 1800)}) == 1


def test_op2(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(tokenfile.VOCABULARY))
    got = {r["doc_id"]: r for r in queries.op2_token_files(spark, SF).collect()}
    at = 0
    for i in sorted(documents):
        ids = tokenizer.encode(documents[i]["text"] or "", add_special_tokens=False).ids + [1]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_op3_and_a_unigram_model(spark, documents, tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))
    for r in queries.op3_sentencepiece(spark, SF).collect():
        assert r["ids"] == library.encode(documents[r["doc_id"]]["text"] or "") and r["same"]
    rng = random.Random(5)
    model = sentencepiece_model_pb2.ModelProto()
    names = ["a", "b", "c", "▁", "ab", "bc", "▁a", "abc", "a▁b", "c▁", "b▁a", "ca", "bb", "aab", "▁c▁"]
    for name, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3), *((n, 1) for n in names)):
        model.pieces.add(piece=name, score=rng.uniform(-9, -1) if kind == 1 else 0.0, type=kind)
    model.trainer_spec.model_type, model.trainer_spec.unk_id = 1, 0
    model.normalizer_spec.name, model.normalizer_spec.remove_extra_whitespaces = "identity", False
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["".join(rng.choices("abc ", k=rng.randrange(1, 300))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "ids long, text string").repartition(3)
    rows = pieces.round_trip(df, ["ids"], model=str(path)).collect()
    total = lambda ids: sum(model.pieces[i].score for i in ids)  # noqa: E731  several paths may be the best
    assert len(rows) == 80 and all(r["same"] for r in rows)
    assert all(total(r["ids"]) == pytest.approx(total(library.encode(texts[r["kept_ids"]]))) for r in rows)


def test_op5(spark, documents):
    fps = {i: simhash(r["text"], 3) for i, r in documents.items()}
    got = {r["doc_id"]: r for r in queries.op5_simhash_dedup(spark, SF).collect()}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{fp:016x}" for i, fp in fps.items()}
    assert {i: r["component_id"] for i, r in got.items()} == reachable(list(fps.items()))


def peak_pairs(payload):
    """Peak pairs by plain sums over each window, without a fast transform."""
    x = (np.frombuffer(payload, np.uint8).astype(np.float64) - 128) / 128
    n = max(0, math.ceil((len(x) - media.WINDOW) / media.HOP)) + 1
    taper, wave = np.hanning(media.WINDOW), np.exp(-2j * np.pi * np.outer(np.arange(media.WINDOW), np.arange(media.WINDOW // 2 + 1)) / media.WINDOW)
    tops = []
    for f in range(n):
        own = np.zeros(media.WINDOW)
        part = x[f * media.HOP : f * media.HOP + media.WINDOW]
        own[: len(part)] = part
        power = np.log1p(np.abs((own * taper) @ wave) ** 2)
        tops.append([(a + int(power[a:b].argmax()), power[a:b].max()) for a, b in media.BANDS])
    loud = lambda f, a: tops[f][a][1] >= np.mean([tops[g][a][1] for g in range(max(0, f - media.AROUND), min(n, f + media.AROUND + 1))])
    return sorted(f << 32 | tops[f][a][0] << 20 | tops[f + d][(a + d) % 4][0] << 8 | d for d in range(1, media.AHEAD + 1) for f in range(n - d) for a in range(4) if loud(f, a) and loud(f + d, (a + d) % 4))


def test_op8(spark, documents):
    got = {r["doc_id"]: r for r in queries.op8_wav_fingerprints(spark, SF).collect()}
    assert len(got) == len(documents)
    same = total = 0
    by_length = sorted(documents, key=lambda i: len(documents[i]["text"] or ""))
    for i in by_length[:60] + by_length[-3:]:
        want, have = peak_pairs(media.padded((documents[i]["text"] or "").encode())), got[i]["prints"]
        same += len(set(want) & set(have))
        total += len(want)
        assert abs(len(want) - len(have)) <= 2 + 0.02 * len(want) and have == sorted(have)
    assert total > 200 and same >= 0.98 * total  # the query's samples have single precision
    ends = [b"word " * 51 + b"x" + last for last in (b"x" * 64, b"\x00\xff" * 32, b"\x00" * 32 + b"\xff" * 32)]  # only in the last, filled-up window
    assert len({tuple(peak_pairs(p)) for p in ends}) > 1 and all(media.fingerprint(p).tolist() == peak_pairs(p) for p in ends)


def test_op10(spark, documents):
    size = {i: len((r["text"] or "").encode().split()) for i, r in documents.items()}
    sums = collections.Counter()
    for i, r in documents.items():
        sums[r["source"]] += size[i]
    want, taken = plain_targets(sums), collections.Counter()
    for r in queries.op10_mix_sources(spark, SF).collect():
        source = documents[r["doc_id"]]["source"]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sums[source] and r["target"] == pytest.approx(want[source]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in want)


def bucket(text, n):
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little") % n


def plain_shape(word):
    """Runs of letters as a, Aa or A; runs of digits as 0; repeated characters once."""
    out, run = "", ""
    for c in [*word[:64], ""]:
        if c and c.isalpha():
            run += c
            continue
        if run:
            out += "A" if len(run) > 1 and run[0].isupper() and run.isupper() else "Aa" if run[0].isupper() else "a"
            run = ""
        out += "0" if c.isdigit() else c
    return "".join(c for k, c in enumerate(out) if not k or c != out[k - 1])


def plain_document(r):
    """Words as pairs of buckets, ten figures, and the buckets of language and source."""
    text, words, last = r["text"] or "", [], None
    for w in text.split():
        core = "".join(c for c in w.lower() if c.isalpha()) or w
        pair = bucket(core, 1 << 14), 1 + bucket(plain_shape(w), (1 << 10) - 1)
        words.append((pair[0], 0) if pair == last else pair)
        last = pair
    lines, raw, n = text.split("\n"), text.encode(), len(words)
    marks = set(range(33, 127)) - {ord(c) for c in ".,;:'\"()-"}
    share = lambda good: math.sqrt(sum(map(good, raw)) / max(1, len(raw)))
    sizes, full = [len(x) for x in lines], [x for x in lines if x]
    mean = sum(sizes) / len(sizes)
    figures = [math.log1p(len(text)), math.log1p(len(lines)), math.log1p(mean), math.log1p(math.sqrt(sum((x - mean) ** 2 for x in sizes) / len(sizes))), len(text) / max(1, n)]
    figures += [share(lambda b: 65 <= b <= 90), share(lambda b: 48 <= b <= 57), share(lambda b: b in marks and not chr(b).isalnum())]
    figures += [1 - len(set(full)) / len(full) if full else 0.0, math.sqrt(sum(s == 0 for _, s in words) / max(1, n))]
    return words, figures, bucket(f"lang {r['lang']}", 1 << 10), bucket(f"source {r['source']}", 1 << 10)


def plain_odds(counts):
    """Log odds of each key from {class: {key: count}}, drawn to the common share with a strength of ten."""
    total = {c: sum(counts[c].values()) for c in (0, 1)}
    both = sum(total.values())
    rate = lambda c, k: (counts[c].get(k, 0.0) + 10 * (counts[0].get(k, 0.0) + counts[1].get(k, 0.0)) / max(1.0, both)) / (total[c] + 10)
    return {k: math.log(rate(1, k)) - math.log(rate(0, k)) for k in {*counts[0], *counts[1]} if counts[0].get(k, 0.0) + counts[1].get(k, 0.0) > 0}


def plain_curve(columns, labels):
    """Slopes, none below 0, and offset of the logistic curve with a penalty of 0.05, on columns of unit spread."""
    scale = [max(1e-6, float(np.std(c))) for c in columns]
    x, y = np.column_stack([*(np.array(c) / s for c, s in zip(columns, scale)), np.ones(len(labels))]), np.array(labels, float)
    w = np.zeros(x.shape[1])
    loss = lambda w: float(np.logaddexp(0, -(2 * y - 1) * (x @ w)).sum() + 0.025 * w @ w)
    for _ in range(400):
        p = 1 / (1 + np.exp(-(x @ w)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.05 * np.eye(len(w)), x.T @ (y - p) - 0.05 * w)
        size = 1.0
        while loss(w + size * step) > loss(w) + 1e-12 and size > 1e-6:
            size /= 2
        w = w + size * step
        if np.abs(step).max() < 1e-10:
            break
    return [max(0.0, float(a / s)) for a, s in zip(w, scale)], float(w[-1])


class PlainViews:
    """Both views from weights of documents for each class, with plain sums."""

    def __init__(self, docs, weights):
        text = {v: {0: collections.Counter(), 1: collections.Counter()} for v in "ws"}
        names = {v: {0: collections.Counter(), 1: collections.Counter()} for v in "ls"}
        n, first, second = ({c: np.zeros(k) for c in (0, 1)} for k in (1, 10, 10))
        for view, i, c, by in weights:
            words, figures, lang, source = docs[i]
            if view == "text":
                for a, b in words:
                    text["w"][c][a] += by / len(words)
                    text["s"][c][b] += by / len(words)
            else:
                x = np.minimum(figures, 1024)
                names["l"][c][lang] += by
                names["s"][c][source] += by
                n[c], first[c], second[c] = n[c] + by, first[c] + by * x, second[c] + by * x * x
        self.words, self.shapes = plain_odds(text["w"]), plain_odds(text["s"])
        self.lang, self.source = plain_odds(names["l"]), plain_odds(names["s"])
        self.mean = {c: first[c] / max(1.0, n[c][0]) for c in (0, 1)}
        spread = {c: second[c] / max(1.0, n[c][0]) - self.mean[c] ** 2 for c in (0, 1)}
        self.variance = {c: 0.8 * np.maximum(spread[c], 0) + 0.2 * ((spread[0] + spread[1]) / 2 + 1e-4) for c in (0, 1)}

    def raw(self, doc):
        words, figures, lang, source = doc
        by_text = sum(self.words.get(a, 0.0) + self.shapes.get(b, 0.0) for a, b in words) / (len(words) + 20)
        normal = lambda c: -((np.array(figures) - self.mean[c]) ** 2) / (2 * self.variance[c]) - np.log(self.variance[c]) / 2
        by_meta = float(np.clip(normal(1) - normal(0), -8, 8).sum()) + self.lang.get(lang, 0.0) + self.source.get(source, 0.0)
        return by_text, by_meta * len(words) / (len(words) + 20)


def test_op7(spark, documents):
    """Features, views, calibration and co-training written anew, document by document, without the library's code."""
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r["quality"] in (0, 1)}
    order = {r["i"]: r["h"] for r in spark.createDataFrame([(i,) for i in labels], "i long").selectExpr("i", "xxhash64(i, 7) h").collect()}
    held = {i for c in (0, 1) for n, i in enumerate(sorted((i for i in labels if labels[i] == c), key=lambda i: (order[i], i)), 1) if n % 10 in (2, 5, 8)}
    docs = {i: plain_document(r) for i, r in documents.items()}
    own = [(v, i, c, 1.0) for v in ("text", "meta") for i, c in labels.items() if i not in held]
    clip = lambda x: max(-12.0, min(12.0, x))

    def fitted(weights):
        views = PlainViews(docs, weights)
        raw = {i: views.raw(d) for i, d in docs.items()}
        y = [labels[i] for i in sorted(held)]
        curves = [plain_curve([[raw[i][k] for i in sorted(held)]], y) for k in (0, 1)]
        odds = {i: [clip(slope[0] * raw[i][k] + offset) for k, (slope, offset) in enumerate(curves)] for i in docs}
        return odds, plain_curve([[odds[i][k] for i in sorted(held)] for k in (0, 1)], y)

    odds, joint = fitted(own)
    limit = math.log(quality.CONFIDENT / (1 - quality.CONFIDENT))
    for _ in range(quality.ROUNDS):
        more = []
        for view, other in (("text", 1), ("meta", 0)):
            sure = {c: [i for i, o in odds.items() if (o[other] if c else -o[other]) >= limit] for c in (0, 1)}
            for c in (0, 1):
                by = min(1.0, sum(v == view and k == c for v, _, k, _ in own) / max(1, len(sure[c])))
                more += [(view, i, c, by) for i in sure[c]]
        odds, joint = fitted(own + more)
    chance = lambda x: 1 / (1 + math.exp(-x))
    got = queries.op7_quality_cotraining(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        a, b = odds[r["doc_id"]]
        want = [chance(a), chance(b), chance(max(-30.0, min(30.0, joint[0][0] * a + joint[0][1] * b + joint[1])))]
        assert [r["text_score"], r["meta_score"], r["score"]] == pytest.approx(want, abs=2e-4)
        assert r["keep"] == (r["score"] >= quality.KEEP)


def test_queries_leave_nothing_on_the_driver():
    assert not [f for f in os.listdir(".") if f.endswith(".part")]


def test_empty_tables(spark, tmp_path):
    """Every registered query, and the pipeline stage by stage, over tables without rows."""
    import corpus_pipeline

    for t in ("documents", "embeddings", "pages", "labels", "conversations", "sales", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, query in queries.QUERIES.items():
        assert query(spark, str(tmp_path)).collect() == [], name
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)), "test")  # as the pipeline does: a stage deletes the tables of the one before
        assert docs.count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
