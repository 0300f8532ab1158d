"""SentencePiece encoding and decoding by a streaming lattice.

Text is read position by position. At each position the best way to reach it is kept as one backpointer; only the
positions within the longest piece can still be extended, so they are the window. Whenever the backpointer paths of
all positions in the window meet in one boundary, the ids before it are final: they are given out and forgotten.

A whole text goes through one stream. Where no piece of a model goes on after white space, no piece that goes on beyond
the beginning of a word begins before it, so one path survives there: the stream commits the word, and the lattice goes
on with the next, holding nothing. What it commits between two such boundaries depends on the word alone, so words that
it has passed are looked up the next time.

Unigram models take the path with the largest sum of scores (Viterbi). For BPE models the sum of scores would give
other ids than the library's merges; there a piece may follow another only if merging the two pieces' joint text
gives just these two pieces, which leaves exactly one path to each position: the library's own ids.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import accumulate
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keeps_words, kept_names, slices, tokenizer_path

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: Bounds of what a worker remembers: words, their length, and pairs of pieces.
MAX_WORDS, MAX_WORD, MAX_PAIRS = 600_000, 64, 300_000


class Pieces:
    """A vocabulary: pieces with scores, byte pieces for what it lacks, and how paths are scored."""

    def __init__(self, scores: dict[str, tuple[int, float]], byte_ids: list[int] | None, unknown: int, merges: bool, text_of: list[bytes], prefix: bool = True):
        self.scores, self.byte_ids, self.unknown, self.merges, self.text_of, self.prefix = scores, byte_ids, unknown, merges, text_of, prefix
        self.longest = max(map(len, scores), default=1)
        self.check = 2 * self.longest  # positions after which the window's paths are looked at again
        self.words_part = not any(SPACE in p.lstrip(SPACE) for p in scores)
        self._id_of = {p: i for p, (i, _) in scores.items()}.get
        self._lowest = min((s for _, s in scores.values()), default=0.0) - 10.0
        self._held = {p[i : i + 2] for p in scores for i in range(len(p) - 1)}  # pairs of characters within pieces
        self._words: dict[str, bytes] = {}
        self._parts = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self._crossed = re.compile(f"[^{SPACE}]{SPACE}").search
        self._rows: dict[str, dict[str, bool | str]] = {}  # of each piece, which pieces may follow; "" is the piece
        self._pairs = 0
        self._lefts: dict[str, list] = {}
        self._rights: dict[str, list] = {}
        self._standing = {p for p in scores if self.merged(p) == [p]} if merges else set()
        self._tails = {t: t in self._standing for p in self._standing for t in (p[i:] for i in range(len(p)))}

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kind = model.SentencePiece.Type
        scores, bytes_at, text_of = {}, {}, []
        for i, p in enumerate(model.pieces):
            if p.type == kind.BYTE:
                bytes_at[int(p.piece[3:5], 16)] = i
                text_of.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type in (kind.NORMAL, kind.USER_DEFINED, kind.UNUSED):
                scores[p.piece] = (i, p.score)
                text_of.append(p.piece.replace(SPACE, " ").encode())
            else:
                text_of.append(" ⁇ ".encode() if p.type == kind.UNKNOWN else b"")
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models without text normalisation are supported")
        bytes_of = [bytes_at[b] for b in range(256)] if len(bytes_at) == 256 else None
        return cls(scores, bytes_of, model.trainer_spec.unk_id, model.trainer_spec.model_type == 2, text_of, spec.add_dummy_prefix)

    # the merges of a short string, as BPE defines them: best score first, leftmost among equals
    def merged(self, text: str, steps: list | None = None) -> list[str]:
        parts = list(text)
        scores = self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = scores.get(parts[i] + parts[i + 1])
                if found and (best is None or found[1] > best):
                    best, at = found[1], i
            if at < 0:
                break
            if steps is not None:
                steps.append((at, len(parts), best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, piece: str, right: bool) -> list[tuple[str, float, float, float]]:
        """The symbols that stand at one edge of a piece while it is merged, from its outer character up to itself.

        Each with the level at which it came about, and the level and score of the merge that takes it in. The level
        is the least score merged so far: with that score merged, everything better has been.
        """
        steps: list[tuple[int, int, float]] = []
        self.merged(piece, steps)
        parts, level, out = list(piece), float("inf"), []
        symbol, since = parts[-1 if right else 0], level
        for at, n, score in steps:
            level = min(level, score)
            taken = at == n - 2 if right else at == 0
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if taken:
                out.append((symbol, since, level, score))
                symbol, since = parts[-1 if right else 0], level
        out.append((symbol, since, float("-inf"), float("-inf")))
        return out

    def _follows(self, before: str, piece: str) -> bool:
        """Whether merging the joint text of two pieces gives these two pieces.

        It does if no merge across the boundary comes first: the symbols on either side change step by step, and a
        joint symbol wins if its level, then its score, beats the merge that takes in its left part, or equals or
        beats the one that takes in its right part (the leftmost of equal merges comes first).
        """
        lefts = self._lefts.get(before)
        if lefts is None:
            lefts = self._lefts[before] = self._edge(before, True)
        rights = self._rights.get(piece)
        if rights is None:
            rights = self._rights[piece] = self._edge(piece, False)
        i = j = 0
        while True:
            a, came_a, end_a, score_a = lefts[i]
            b, came_b, end_b, score_b = rights[j]
            found = self.scores.get(a + b)
            if found:
                score = found[1]
                level = min(score, came_a, came_b)
                if (level, score) > (end_a, score_a) and (level, score) >= (end_b, score_b):
                    return False
            if i == len(lefts) - 1 and j == len(rights) - 1:
                return True
            if (end_a, score_a) >= (end_b, score_b) and i < len(lefts) - 1:
                i += 1
            else:
                j += 1

    def _row(self, piece: str) -> dict[str, bool | str]:
        row = self._rows.get(piece)
        if row is None:
            if self._pairs >= MAX_PAIRS:
                self._rows, self._pairs = {}, 0
            row = self._rows[piece] = {"": piece}
        return row

    def stream(self, text: str) -> Iterator[str]:
        """The pieces of a whole escaped text, given out as soon as they are final."""
        at = 0
        while at < len(text):
            for at, final in self.committed(text, at):  # noqa: B020
                yield from final

    def commits(self, text: str) -> Iterator[bytes]:
        """The ids of a whole escaped text, as packed 32-bit integers, in the order in which the stream commits them.

        Where a word begins, the lattice holds nothing, so what it commits up to the next such place depends on the
        word alone: words that it has passed before are looked up. One that it passes must end where the word does.
        """
        words, parts = self._words, self._parts(text) if self.words_part else [text]
        known = list(map(words.get, parts))
        missing = known.count(None)
        if missing:
            ends, done, k = list(accumulate(map(len, parts))), 0, -1
            for _ in range(missing):
                k = known.index(None, k + 1)
                word = parts[k]
                if (ids := words.get(word)) is None:
                    at = ends[k] - len(word)
                    if self._alone(text, at) != ends[k]:
                        raise AssertionError("paths met elsewhere than where a word begins")
                    ids = self._passed(word)
                    self._remember(word, ids)
                yield from known[done:k]
                yield ids
                done = k + 1
            known = known[done:]
        yield from known

    def _passed(self, word: str) -> bytes:
        """The packed ids of a word that isn't known, one stretch after the other.

        Stretches part between two characters that no piece holds side by side. No path crosses such a place, so all
        paths meet there, and a stretch that the lattice has passed in another word is looked up as well.
        """
        words, held, out, begin = self._words, self._held, [], 0
        cuts = [i for i, pair in enumerate(map(add, word, word[1:]), 1) if pair not in held]
        for end in (*cuts, len(word)):
            stretch = word[begin:end]
            ids = words.get(stretch)
            if ids is None:
                ids = self._packed([p for _, final in self.committed(word, begin, end) for p in final])
                if cuts:
                    self._remember(stretch, ids)
            out.append(ids)
            begin = end
        return b"".join(out)

    def _remember(self, word: str, ids: bytes) -> None:
        if len(word) <= MAX_WORD:
            if len(self._words) >= MAX_WORDS:
                self._words.clear()
            self._words[word] = ids

    def _alone(self, text: str, start: int) -> int:
        """The first place after ``start`` where one path survives: before the next word, or the end."""
        ends = self._crossed(text, start) if self.words_part else None
        return ends.start() + 1 if ends else len(text)

    def committed(self, text: str, start: int = 0, stop: int | None = None) -> Iterator[tuple[int, list[str]]]:
        """Boundaries in which all surviving paths meet, each with the pieces that are final there, from ``start``, where
        the text or a word begins, up to the first boundary that no piece crosses: the end or the next word (``stop``,
        where it is known).

        A path survives while a later piece can begin where it ends. These places are the window: as many as the longest
        piece has characters, or, before the beginning of a word, this place alone.
        """
        if stop is None:
            stop = self._alone(text, start)
        reach = self._reach_merged if self.merges else self._reach_best
        back = [0]  # for each position since the last final boundary, where its last piece begins
        state: list = [None if self.merges else 0.0]  # what may follow the path to it, or the path's sum of scores
        at = start
        while at < stop:
            before, at = at, min(stop, at + self.check)
            reach(text, start, before, at, back, state)
            cut = at - start if at == stop else self._meeting(back, max(0, at - start + 1 - self.longest))
            if cut:
                yield start + cut, self._path(text, start, back, cut)
                start += cut
                back = [0] + [b - cut for b in back[cut + 1 :]]
                state = state[cut:]

    def _reach_merged(self, text: str, start: int, at: int, stop: int, back: list, state: list) -> None:
        """For each position after ``at``: the one piece ending there that may follow the last piece of the path to its
        beginning."""
        tails, rows = self._tails, self._rows
        for j in range(at + 1, stop + 1):
            i = j - 1
            piece, stands = text[i], True
            while True:
                if stands:
                    before = state[i - start]
                    if before is None:
                        break
                    known = before.get(piece)
                    if known is None:
                        known = before[piece] = self._follows(before[""], piece)
                        self._pairs += 1
                    if known:
                        break
                i -= 1
                piece = text[i:j]
                stands = tails.get(piece)
                if i < start or stands is None:
                    raise AssertionError("every prefix has a path")
            back.append(i - start)
            row = rows.get(piece)
            if row is None:
                row = self._row(piece)
                rows = self._rows
            state.append(row)

    def _reach_best(self, text: str, start: int, at: int, stop: int, back: list, state: list) -> None:
        for j in range(at + 1, stop + 1):
            best = None
            for i in range(j - 1, max(start, j - self.longest) - 1, -1):
                found = self.scores.get(text[i:j])
                score = found[1] if found else self._lowest if i == j - 1 else None
                if score is not None and (best is None or state[i - start] + score >= best[1]):  # the longest of equal ones
                    best = i, state[i - start] + score
            back.append(best[0] - start)
            state.append(best[1])

    @staticmethod
    def _meeting(back: list[int], first: int) -> int:
        """The boundary in which the paths of all positions from ``first`` on meet; 0 if only at the start."""
        live = set(range(first, len(back)))
        while len(live) > 1:
            top = max(live)
            live.discard(top)
            live.add(back[top])
        return live.pop()

    @staticmethod
    def _path(text: str, start: int, back: list[int], end: int) -> list[str]:
        out = []
        while end > 0:
            out.append(text[start + back[end] : start + end])
            end = back[end]
        return out[::-1]

    def _ids(self, pieces) -> list[int]:
        out: list[int] = []
        for p in pieces:
            found = self.scores.get(p)
            if found:
                out.append(found[0])
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in p.encode("utf-8", "surrogatepass"))
            else:
                out.append(self.unknown)
        return out

    def _packed(self, pieces: list[str]) -> bytes:
        """Ids of pieces as packed 32-bit integers."""
        ids = list(map(self._id_of, pieces))
        return array("i", self._ids(pieces) if None in ids else ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; none for an empty one."""
        if not text:
            return np.zeros(0, np.int32)
        return np.frombuffer(b"".join(self.commits((SPACE if self.prefix else "") + text.replace(" ", SPACE))), np.int32)

    def decode(self, ids) -> str:
        """The text of ids: pieces' bytes, without the one space that encoding puts in front."""
        text = b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The vocabulary at ``path``, loaded once in each worker."""
    keeps_words("pieces", _LOADED.clear)
    if path not in _LOADED:
        _LOADED[path] = Pieces.load(path)
    return _LOADED[path]


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32)))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None) -> DataFrame:
    """(id, ids array<int>) for every row. Null and empty texts have no ids; ids of rows may repeat or be null.

    An empty table gives an empty table.
    """
    path = model or tokenizer_path(MODEL)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        vocabulary = pieces(path)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists([vocabulary.encode(t or "") for t in batch.column(1).to_pylist()])], ["id", "ids"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, id_col: str = "id", ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """(id, text) from rows with ids. Null ids give an empty text; bytes that aren't UTF-8 become U+FFFD.

    An empty table gives an empty table.
    """
    path = model or tokenizer_path(MODEL)
    rows = rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        vocabulary = pieces(path)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([vocabulary.decode(ids or ()) for ids in batch.column(1).to_pylist()], pa.string())], ["id", "text"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text string")


_OWN = ["ids", "n_ids", "decoded_sha256", "same"]


def round_trip(docs: DataFrame, keep: list[str], text_col: str = "text", model: str | None = None) -> DataFrame:
    """The columns ``keep``, ids, n_ids, decoded_sha256 and same: each text encoded and decoded again in one pass.

    ``same`` is false only for texts with U+2581, which the format can't tell from a space; null is taken as empty.
    Repeated rows stay, an empty table gives an empty table, and a kept column with one of the new names comes out with
    ``kept_`` before it.
    """
    import hashlib

    path = model or tokenizer_path(MODEL)
    docs = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    names = kept_names(keep, _OWN)
    types = "".join(f"`{n}` {f.dataType.simpleString()}, " for n, f in zip(names, docs.schema[: len(keep)]))

    def run(batches):
        vocabulary = pieces(path)
        for batch in slices(batches):
            ids, digests, same = [], [], []
            for t in batch.column(len(keep)).to_pylist():
                found = vocabulary.encode(t)
                back = vocabulary.decode(found.tolist())
                ids.append(found)
                digests.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                same.append(back == t)
            arrays = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*arrays, _lists(ids), pa.array([len(x) for x in ids], pa.int64()), pa.array(digests, pa.string()), pa.array(same, pa.bool_())], [*names, *_OWN])

    return docs.mapInArrow(run, f"{types}ids array<int>, n_ids long, decoded_sha256 string, same boolean")
