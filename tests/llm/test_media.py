"""Media: payloads come back byte for byte, fingerprints depend on the samples alone and find shifted copies."""

import hashlib
import random
import wave
import zlib
import io

import numpy as np

from corpusloom.llm import media

SCHEMA = "doc_id long, text string, media string, n_bytes long"


def test_wav_and_padding():
    for n in (0, 1, 63, 64, 65, 1000):
        payload = media.padded(bytes(range(256)) * 5)[: max(64, -(-n // 64) * 64)]
        stored = media.to_wav(payload)
        with wave.open(io.BytesIO(stored)) as f:
            assert (f.getnchannels(), f.getsampwidth(), f.getframerate(), f.getnframes()) == (1, 1, media.RATE, len(payload))
        assert media.from_wav(stored) == payload
    assert media.padded(b"") == bytes(64) and len(media.padded(b"x" * 64)) == 64 and len(media.padded(b"x" * 65)) == 128


def test_fingerprints_in_parts_and_shifted(monkeypatch):
    t = np.arange(40_000)
    tone = (128 + 60 * np.sin(t * t / 9e4) + 40 * np.sin(t / 3)).astype(np.uint8).tobytes()
    whole = media.fingerprint(tone)
    monkeypatch.setattr(media, "FRAMES", 7)
    assert (media.fingerprint(tone) == whole).all() and len(whole) > 100 and (np.diff(whole) >= 0).all()
    later = media.fingerprint(tone[media.HOP * 10 :])
    codes = lambda p: {(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in p}
    moved = {(a - 10, c) for a, c in codes(whole)}
    assert len(moved & codes(later)) > 0.8 * len(later)
    assert len(media.fingerprint(bytes(64))) == 0


def test_tables(spark):
    rng = random.Random(1)
    texts = [None, "", "é🙂", "x" * 64, "".join(rng.choices("abc def\n", k=150_000)), "same text " * 40, "same text " * 40]
    df = spark.createDataFrame([(i if i else None, t, "clash", 3) for i, t in enumerate(texts)], SCHEMA)
    stored = media.to_media(df)
    rows = {r["id"]: r for r in media.analyse(stored, ["id", "n_bytes"]).collect()}
    for i, t in enumerate(texts):
        p = media.padded((t or "").encode())
        r = rows[i if i else None]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    assert rows[5]["prints"] == rows[6]["prints"]
    assert media.analyse(media.to_media(spark.createDataFrame([], SCHEMA)), ["id"]).collect() == []
    null = spark.createDataFrame([(1, None)], "id long, media binary")
    assert media.analyse(null, ["id"]).first()["payload_bytes"] is None
