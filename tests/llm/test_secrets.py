"""Secret scan: spans against Python's regular expressions, ownership, redaction, edge cases."""

import hashlib
import random
import re

from corpusloom.llm import secrets

SCHEMA = "doc_id long, text string, source string, lang string, spans string, row long"
ASSIGN = re.compile(secrets.ASSIGN[4:], re.I | re.A)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(found)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def test_base_spans_equal_the_plain_version(spark):
    rng = random.Random(2)
    bits = ["token", "PassWord", "api_key", "apikey", "secret", '"', "'", " ", "  ", ":", "=", "abc", "abcdef12", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", "é", "🙂", "\n", ".", "==", "passwd=token:abcdefgh", "Xy9"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 40))) for _ in range(400)] + [None, "", "f" * 24, "f" * 23, "token=" + "a" * 5, "token=" + "a" * 6]
    df = frame(spark, [(i, t, "s", "en") for i, t in enumerate(texts)])
    got = {r["id"]: r for r in secrets.digest(secrets.scan(df)).collect()}
    for i, t in enumerate(texts):
        want = base_spans(t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert [s for s in got[i]["spans"].split(",") if s and not s.startswith("mixed")] == want
        assert (got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"]) == tuple(sum(s.startswith(k) for s in want) for k in secrets.BASE)


def test_widely_copied_values_are_examples(spark):
    mine, copied = "token = Zq8" + "w" * 30 + "7K", "token = Ab1" + "x" * 30 + "2D"
    rows = [(i, copied, f"owner{i}", "en") for i in range(5)] + [(10, mine, "owner1", "en"), (11, mine, "owner1", "fr"), (12, "no secret", None, None)]
    got = {r["id"]: r for r in secrets.digest(secrets.scan(frame(spark, rows))).collect()}
    assert got[10]["n_live"] == 2 and got[10]["n_example"] == 0 and "mixed:" in got[10]["spans"]
    assert got[0]["n_live"] == 0 and got[0]["n_example"] == 1 and "mixed:" not in got[0]["spans"]
    assert got[12]["spans"] == ""


def test_many_matches_in_a_long_text(spark):
    text = "é " + " ".join("deadbeef" * 3 + "g" for _ in range(20000))
    got = secrets.digest(secrets.scan(frame(spark, [(1, text, "s", "en")]))).first()
    assert got["n_hex"] == 20000 and got["base_sha256"] == hashlib.sha256(",".join(base_spans(text)).encode()).hexdigest()


def test_redact_keeps_rows_and_columns(spark):
    key = "AKIA" + "Q" * 16
    rows = [(1, f"a {key} b token='{'z' * 9}' c", "s", "en"), (2, "plain", "s", "en"), (2, "plain", "s", "en"), (None, None, None, None), (4, f"é token={key}", "t", "en")]
    df = frame(spark, rows)
    out = secrets.redact(df, max_owners=1, max_repos=2)
    assert out.columns == df.columns and out.count() == 5
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (2, "plain") in texts and (None, None) in texts
    assert (1, f"a {key} b [SECRET]' c") in texts  # the key has two owners
    assert (4, f"é token={key}") in texts
    alone = secrets.redact(frame(spark, rows[:1]))
    assert alone.first()["text"] == "a [SECRET] b [SECRET]' c"


def test_redact_counts_a_copied_text_once(spark):
    leaked, example = "AKIA" + "L" * 16, "AKIA" + "E" * 16
    rows = [(i, f"leak {leaked} here", f"owner{i}", lang) for i in range(4) for lang in ("en", "fr")]
    rows += [(10, f"{leaked} again", "owner3", "en"), (11, f"{leaked} again", "owner2", "de"), (12, f"{leaked} more", "owner3", "en")]
    rows += [(20 + i, f"text {i} shows {example}", f"owner{i}", "en") for i in range(6)]
    out = secrets.redact(frame(spark, rows)).collect()
    assert len(out) == len(rows) and not any(leaked in r["text"] for r in out)
    assert sum(example in r["text"] for r in out) == 6


def test_redact_takes_a_key_of_several_owners_for_leaked(spark):
    leaked, repos = "AKIA" + "K" * 16, "AKIA" + "R" * 16
    rows = [(i, f"text {i} has {leaked}", f"owner{i}", "en") for i in range(secrets.REDACT_OWNERS)]
    rows += [(100 + i, f"text {i} has {repos}", "owner", f"lang{i}") for i in range(secrets.REDACT_REPOS + 1)]
    out = secrets.redact(frame(spark, rows)).collect()
    assert not any(leaked in r["text"] for r in out) and sum(repos in r["text"] for r in out) == secrets.REDACT_REPOS + 1
    scanned = secrets.digest(secrets.scan(frame(spark, rows))).collect()  # the query's own bounds are narrower
    assert all(r["n_live"] == 0 and r["n_access"] == 1 for r in scanned)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert secrets.scan(df).collect() == [] and secrets.redact(df).collect() == []
