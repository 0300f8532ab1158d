"""Token files: ids equal the library's on whole texts, places and sequences read back, edge cases."""

import random
import zlib

import numpy as np
import pytest

from corpusloom.llm import tokenfile
from corpusloom.llm.common import scratch, tokenizer_path

SCHEMA = "doc_id long, text string, ids string, shard long"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(tokenfile.VOCABULARY))


def texts():
    rng = random.Random(1)
    parts = ["the", "Don't", "İΣΑΣ", "é", "é", "́", "日本", "<|endoftext|>", "x<|startoftext|>y", "a1b22", " ", "  ", "\n", "\t", " ", "!!", "ﬁ", "🙂", "'s"]
    return ["", " ", "\n\n", "a\nb"] + ["".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(300)]


def test_parts_give_the_ids_of_whole_texts(tokenizer):
    words = tokenfile._encoder(tokenizer_path(tokenfile.VOCABULARY))
    odd = ["क़ख़ word", "ﬀ", "Ångström, ÅNGSTRÖM!!", "don't DON'T", "a-b c_d", "<|STARTOFTEXT|>", "x²", "ẞß", "word,, word.", "≠"]
    for several in ([t] for t in texts() + odd), [texts() + odd], [texts()[::-1]]:
        for batch in several:
            for t, ids in zip(batch, words.encode(batch)):
                assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("shard_docs", [7, 1000])
def test_places_and_checksums(spark, tokenizer, shard_docs):
    rows = [(i * 3, t, "x", 1) for i, t in enumerate(texts())] + [(5, None, "x", 1), (4, "word " * 3000, "x", 1)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    manifest, path = tokenfile.save(df, shard_docs=shard_docs, length=16, batch_rows=4)
    got = {r["doc_id"]: r for r in tokenfile.read(manifest, path).collect()}
    at, stream = 0, []
    for i, t, *_ in sorted(rows):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        r = got[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
        stream += ids
    assert len(got) == len(rows) and sum(r["n_ids"] for r in manifest.collect()) == at
    if shard_docs == 1000:
        shard = tokenfile.Shard(path, 0)
        for k in (0, 5, len(stream) // 16):
            ids, mask = shard.sequence(k)
            want = stream[k * 16 : k * 16 + 16]
            assert ids[: len(want)].tolist() == want and mask.tolist() == [1] * len(want) + [0] * (16 - len(want))
            assert not ids.flags.owndata and not mask.flags.owndata


def test_repeated_and_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a", "x", 1), (1, "b", "x", 1), (1, "b", "x", 1), (1, "a", "x", 1)], SCHEMA)
    manifest, path = tokenfile.save(df)
    got = tokenfile.read(manifest, path).collect()
    assert sorted((r["start"], r["n_tokens"]) for r in got) == [(0, 2), (2, 2), (4, 2), (6, 2)] and [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == [None, 1, 1, 1]
    manifest, path = tokenfile.save(spark.createDataFrame([], SCHEMA), scratch(spark, "none"))
    assert tokenfile.read(manifest, path).collect() == []
