"""SentencePiece: ids equal the library's, unigram paths equal brute force, exact round trips, edge cases."""

import itertools
import random
import re

import pytest

from corpusloom.llm import pieces
from corpusloom.llm.common import tokenizer_path

SCHEMA = "doc_id long, text string, ids string, same long"


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.pieces(tokenizer_path(pieces.MODEL))


def samples():
    rng = random.Random(1)
    letters = "aaabbtheron   \n\t.é日xX01<>🙂̀\x00"
    return ["", " ", "a", "  lead", "trail  ", "<s>hi</s>", "<0x0A>", " " * 40 + "x", "ß" * 50] + ["".join(rng.choices(letters, k=rng.randrange(80))) for _ in range(400)]


def test_ids_equal_the_library(library, vocabulary):
    for t in samples() + ["▁a ▁", "x" * 5000, "".join(random.Random(2).choices("abcdef0123==/+", k=20000))]:
        assert vocabulary.encode(t).tolist() == library.encode(t)
        if t:
            assert vocabulary._ids(vocabulary.stream("▁" + t.replace(" ", "▁"))) == library.encode(t)
        assert vocabulary.decode(vocabulary.encode(t).tolist()) == library.decode(library.encode(t))


def test_pair_test_equals_plain_merging(vocabulary):
    rng = random.Random(3)
    names = sorted(vocabulary._standing)
    for _ in range(3000):
        a, b = rng.choice(names), rng.choice(names)
        assert vocabulary._follows(a, b) == (vocabulary.merged(a + b) == [a, b])


def test_stream_gives_pieces_before_the_end(vocabulary):
    text = "▁" + "the▁quick▁brown▁fox▁" * 50
    seen = []
    for p in vocabulary.stream(text):
        seen.append(p)
        if len(seen) == 1:
            break
    assert seen and len("".join(seen)) < len(text)


def test_commits_come_from_convergence(vocabulary, library):
    """Every word ends with a commit of the lattice, and only long words have others; looked-up words change nothing."""
    rng = random.Random(6)
    letters = "aaabbtheron   \n.é日xX01🙂"
    for text in ["".join(rng.choices(letters, k=rng.randrange(1, 400))) for _ in range(200)] + ["the quick  brown " + "f0x/" * 100 + " jumps", " ", "  ", "end   "]:
        escaped = "▁" + text.replace(" ", "▁")
        words = [m.end() for m in re.finditer("▁*[^▁]+|▁+", escaped)]
        ends, at, pieces_of = [], 0, []
        while at < len(escaped):
            for at, final in vocabulary.committed(escaped, at):
                ends.append(at)
                pieces_of += final
        assert set(words) <= set(ends) and len(ends) == len(set(ends))
        if max(b - a for a, b in zip([0, *words], words)) < 2 * vocabulary.longest:
            assert ends == words
        assert "".join(pieces_of) == escaped and vocabulary._ids(pieces_of) == library.encode(text)
        vocabulary._words.clear()
        assert [x for _ in range(2) for x in [b"".join(vocabulary.commits(escaped))]] == [vocabulary.encode(text).tobytes()] * 2


def test_words_part_where_no_piece_crosses(vocabulary, library):
    """Stretches of a word are encoded apart just where the whole word's path has a boundary; what was met is looked up."""
    for text in ["quick,", "end.\nNext", "(a)***", "çç..ñó", "é日🙂x,", "x" * 300 + ",y", "a,b" * 100, ",", "quick,quick"]:
        word = "▁" + text
        vocabulary._words.clear()
        found = vocabulary._passed(word)
        whole = [p for _, final in vocabulary.committed(word) for p in final]
        assert vocabulary._packed(whole) == found == vocabulary._passed(word) and vocabulary._ids(whole) == library.encode(text)
        ends = set(itertools.accumulate(map(len, whole)))
        assert {i for i in range(1, len(word)) if not any(word[i - 1 : i + 1] in p for p in vocabulary.scores)} <= ends
    vocabulary._words.clear()
    vocabulary._passed("▁quick,")
    assert "▁quick" in vocabulary._words and "," in vocabulary._words


def test_unigram_takes_the_best_path():
    rng = random.Random(4)
    scores = {p: (i, rng.uniform(-8, -1)) for i, p in enumerate(["a", "b", "c", "ab", "bc", "abc", "ca", "aa", "cab", "bb"])}
    v = pieces.Pieces(scores, None, 99, False, [p.encode() for p in scores], prefix=False)

    def best(t):
        paths = []
        for cuts in itertools.product([0, 1], repeat=len(t) - 1):
            parts, start = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(t[start:i])
                    start = i
            parts.append(t[start:])
            if all(p in scores for p in parts):
                paths.append(sum(scores[p][1] for p in parts))
        return max(paths)

    for _ in range(60):
        t = "".join(rng.choices("abc", k=rng.randrange(1, 13)))
        assert sum(scores[p][1] for p in v.stream(t)) == pytest.approx(best(t))


def test_tables(spark):
    rows = [(1, "a  b\nc", "x", 0), (2, None, "x", 0), (2, "", "x", 0), (None, "日本 é", "x", 0), (5, "w " * 30000, "x", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    coded = pieces.encode(df)
    assert {r["id"]: r["text"] for r in pieces.decode(coded).collect() if r["id"] in (1, 5)} == {1: "a  b\nc", 5: "w " * 30000}
    trip = pieces.round_trip(df, ["doc_id"]).collect()
    assert len(trip) == 5 and all(r["same"] for r in trip)
    assert sorted(r["n_ids"] for r in trip if r["doc_id"] == 2) == [0, 0]
    assert pieces.round_trip(spark.createDataFrame([], SCHEMA), ["doc_id"]).collect() == []
