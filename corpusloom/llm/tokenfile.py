"""Token ids as Arrow files of fixed-size-list batches.

Documents are encoded, dealt out by ranges of their id that hold about as much text each, and written in ascending id
order. A range is a shard, or several if it is long: a data file whose rows are sequences of equal length (``input_ids``
and ``attention_mask`` as fixed-size lists of whole bytes, the last row padded), in record batches of an equal number of
rows, and an index file with each document's place. Arrow's file format is not compressed, so that ids and mask of a
sequence of any number are slices of the mapped file, without a copy.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keeps_words, scratch, slices, tokenizer_path, written

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Ids in a sequence, and sequences in a record batch.
LENGTH, BATCH_ROWS = 2048, 512
#: Documents and bytes of text in a range, about; ranges at most; ids after which a range goes on in another shard.
SHARD_DOCS, SHARD_BYTES, RANGES, SHARD_IDS = 16_384, 64 << 20, 16_384, 1 << 28
#: Shards that a range may have: shard numbers are range * SHARDS + place.
SHARDS = 10_000
#: Words that a worker remembers, and the longest of them.
MAX_WORDS, MAX_WORD = 800_000, 64

#: Punctuation that, after letters only, is a word of its own in the vocabulary's pattern.
_MARKS = b".,;:!?%&$#*()[]{}|\"/+=_-"

_LOADED: dict[str, Words] = {}


#: Steps of a tokenizer under which the parts of a text can be encoded apart: it ignores case, drops white space, and
#: neither its normaliser nor its pattern looks across a space or a line break; each word ends with a closing token.
_PARTED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "model": {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "byte_fallback": False},
}


def _parted(path: str) -> bool:
    """Whether a tokenizer works in the steps of ``_PARTED``; others get whole texts."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = steps[0].get("pattern", {}).get("Regex"), steps[0].get("behavior"), steps[0].get("invert")
    rest = [(s.get("type"), s.get("add_prefix_space"), s.get("use_regex")) for s in steps[1:]]
    added = all(t["content"].startswith("<|") and not t.get("normalized") for t in spec.get("added_tokens", []))
    model = {k: spec["model"].get(k) for k in _PARTED["model"]}
    return spec.get("normalizer") == _PARTED["normalizer"] and split == (_PARTED["pattern"], "Removed", True) and rest == [("ByteLevel", False, False)] and model == _PARTED["model"] and added


class Words:
    """A tokenizer, and the packed ids of parts of texts that it has seen.

    Where the vocabulary lets parts of a text be encoded apart (:func:`_parted`), the ids of a text are those of its
    parts in small ASCII letters. Only letters with marks after them fall into two words, which are kept apart. New
    letter words are encoded together, as one text: each ends with the one token that closes a word. Texts with
    something like a special token, and all texts of other vocabularies, go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.parted = _parted(path)
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer, self.letters.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.CharDelimiterSplit(" ")
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, words: list[str], plain: bool) -> list[bytes]:
        """Packed ids of words of letters; plain ones, of small ASCII letters, need neither normal form nor pattern."""
        tokenizer = self.letters if plain else self.tokenizer
        ids = np.array(tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self.kind)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words):  # a letter that its normal form takes apart
            return [self.whole(w) for w in words]
        packed, ends = ids.tobytes(), (ends * ids.itemsize).tolist()
        return [packed[i:j] for i, j in zip([0, *ends], ends)]

    def _learn(self, parts) -> dict[bytes, bytes]:
        """Packed ids of parts that aren't known."""
        known, found = self.known, {}
        stems = [p.rstrip(_MARKS) for p in parts]
        plain = {s for s in stems if s.isalpha()}
        wide = {s for s in stems if s and not s.isascii() and s.decode("utf-8", "surrogatepass").isalpha()}
        ends = {p[len(s) :] for p, s in zip(parts, stems) if len(s) < len(p) and (s in plain or s in wide)}
        others = [p for p, s in zip(parts, stems) if s not in plain and s not in wide] + [e for e in ends if e not in known]
        for words, ascii_only in ((plain, True), (wide, False)):
            new = [s for s in words if s not in known]
            if new:
                found |= zip(new, self._letters([s.decode("utf-8", "surrogatepass") for s in new], ascii_only))
        if others:
            found |= zip(others, (self._pack(e.ids) for e in self.tokenizer.encode_batch_fast([p.decode("utf-8", "surrogatepass") for p in others], add_special_tokens=False)))
        piece = lambda x: found[x] if x in found else known[x]
        found |= {p: piece(s) + piece(p[len(s) :]) for p, s in zip(parts, stems) if len(s) < len(p) and (s in plain or s in wide)}
        return found

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Packed ids of whole texts.

        Texts are cut into parts and these made distinct by Arrow, so that only distinct parts become Python's; the ids
        of all parts are then gathered from theirs.
        """
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.parted:
            return [self._pack(e.ids) for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        special = pc.match_substring(texts, "<|")
        plain = pc.replace_substring(pc.ascii_lower(pc.if_else(special, "", texts)), "\n", " ")
        parts = pc.split_pattern(plain, " ")
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        known = self.known
        missing = [w for w in words if w not in known]
        if len(known) + len(missing) > MAX_WORDS:
            known.clear()
            missing = words
        if missing:
            known.update(self._learn(missing))
        packed = [known[w] for w in words]
        for w in missing:
            if len(w) > MAX_WORD:
                del known[w]
        width = np.dtype(self.kind).itemsize
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // width
        places = np.cumsum(sizes) - sizes
        word = coded.indices.to_numpy()
        n = sizes[word]
        after = np.concatenate([[0], np.cumsum(n)])
        ids = np.frombuffer(b"".join(packed), self.kind)[np.repeat(places[word] - after[:-1], n) + np.arange(after[-1])]
        edges = after[np.concatenate([[0], np.cumsum(parts.value_lengths().to_numpy())])].tolist()
        found = [ids[i:j].tobytes() for i, j in zip(edges, edges[1:])]
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            found[i] = self.whole(texts[i].as_py())
        return found


def _encoder(path: str) -> Words:
    """The tokenizer at ``path``, loaded once in each worker."""
    keeps_words("tokens", _LOADED.clear)
    if path not in _LOADED:
        _LOADED[path] = Words(path)
    return _LOADED[path]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID, bounds: list[int] | None = None) -> DataFrame:
    """(id, ids binary): each whole text's ids and the end id, as little-endian unsigned integers of the file's width.

    With ``bounds``, the ascending first ids of all ranges but the first, also ``part``, the id's range; null ids are in
    the first.
    """
    path = vocabulary or tokenizer_path(VOCABULARY)
    kind = id_type(path)
    end = np.array([end_id], kind).tobytes()
    firsts = None if bounds is None else np.array(bounds, np.int64)

    def run(batches):
        words = _encoder(path)
        for batch in slices(batches):
            ids = [x + end for x in words.encode(batch.column(1).fill_null(""))]
            out = [batch.column(0), pa.array(ids, pa.binary())]
            if firsts is not None:
                first = np.iinfo(np.int64).min
                numbers = np.array([first if i is None else i for i in batch.column(0).to_pylist()], np.int64)
                out.append(pa.array(np.searchsorted(firsts, numbers, side="right").astype(np.int32)))
            yield pa.RecordBatch.from_arrays(out, ["id", "ids", "part"][: len(out)])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, ids binary" + (", part int" if bounds is not None else ""))


def id_type(path: str) -> str:
    """NumPy type of an id in the file: two bytes where the vocabulary allows it."""
    return _encoder(path).kind


def _open(uri: str):
    """File system and path of a folder that driver and executors share."""
    return pa.fs.FileSystem.from_uri(uri)


def _schema(kind: str, length: int) -> pa.Schema:
    ids = pa.uint16() if kind == "<u2" else pa.uint32()
    return pa.schema([("input_ids", pa.list_(ids, length)), ("attention_mask", pa.list_(pa.uint8(), length))])


_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _Writer:
    """One shard: its files appear under their final names only when they are whole."""

    def __init__(self, uri: str, shard: int, kind: str, length: int, batch_rows: int):
        self.fs, base = _open(uri)
        self.fs.create_dir(base, recursive=True)
        self.shard, self.names = shard, [f"{base}/{_name(shard)}.arrow", f"{base}/{_name(shard)}.index.arrow"]
        self.parts = [f"{x}.{uuid.uuid4().hex}.part" for x in self.names]
        self.kind, self.length, self.batch_rows, self.schema = kind, length, batch_rows, _schema(kind, length)
        self.files = [self.fs.open_output_stream(x) for x in self.parts]
        self.data, self.index = pa.ipc.new_file(self.files[0], self.schema), pa.ipc.new_file(self.files[1], _INDEX)
        self.waiting: list[bytes] = []
        self.pending, self.total, self.docs = 0, 0, 0

    def add(self, doc_ids: pa.Array, ids: list[bytes]) -> None:
        width = np.dtype(self.kind).itemsize
        sizes = np.array([len(x) // width for x in ids], np.int64)
        starts = self.total + np.cumsum(sizes) - sizes
        self.index.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(sizes)], schema=_INDEX))
        self.total += int(sizes.sum())
        self.docs += len(ids)
        for x in ids:
            self.waiting.append(x)
            self.pending += len(x) // width
            if self.pending >= self.length * self.batch_rows:
                self._flush(False)

    def _flush(self, last: bool) -> None:
        stream = np.frombuffer(b"".join(self.waiting), self.kind)
        step = self.length * self.batch_rows
        at = 0
        while len(stream) - at >= step or (last and at < len(stream)):
            piece = stream[at : at + step]
            rows = -(-len(piece) // self.length)
            ids, mask = np.zeros(rows * self.length, self.kind), np.zeros(rows * self.length, np.uint8)
            ids[: len(piece)], mask[: len(piece)] = piece, 1
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in (ids, mask)]
            self.data.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
            at += len(piece)
        self.waiting, self.pending = [stream[at:].tobytes()], len(stream) - at

    def close(self) -> None:
        self._flush(True)
        self.data.close()
        self.index.close()
        for f in self.files:
            f.close()
        for part, name in zip(self.parts, self.names):
            self.fs.move(part, name)


def _name(shard: int) -> str:
    return f"shard-{shard // SHARDS:06d}-{shard % SHARDS:04d}"


_MANIFEST = "shard long, n_docs long, n_ids long"


def write(encoded: DataFrame, path: str, ranges: int, kind: str = "<u2", length: int = LENGTH, batch_rows: int = BATCH_ROWS, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write (id, ids, part) under ``path``; returns the manifest (shard, n_docs, n_ids), a written table.

    Each of the ``ranges`` parts is one task, which begins another shard after a document that fills ``shard_ids``.
    Null ids come first; equal ids follow each other in the order of their ids' bytes. A shard that a lost executor
    leaves unfinished is written anew under another temporary name; a finished one is replaced by the same bytes.
    Temporary files that are left over are deleted at the end.
    """
    dealt = encoded.repartitionById(ranges, F.col("part")).sortWithinPartitions(F.asc_nulls_first("id"), "ids")

    def run(batches):
        out, done, number = None, [], None
        for batch in slices(batches):
            if number is None:
                number = batch.column(2)[0].as_py() * SHARDS
            at = 0
            while at < batch.num_rows:
                if out is None:
                    out = _Writer(path, number, kind, length, batch_rows)
                ids = batch.column(1).slice(at).to_pylist()
                sizes = np.cumsum([len(x) for x in ids]) // np.dtype(kind).itemsize
                n = min(len(ids), int(np.searchsorted(sizes, shard_ids - out.total)) + 1)
                out.add(batch.column(0).slice(at, n), ids[:n])
                at += n
                if out.total >= shard_ids:
                    out.close()
                    done.append(out)
                    out, number = None, number + 1
        if out is not None:
            out.close()
            done.append(out)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([getattr(w, c) for w in done], pa.int64()) for c in ("shard", "docs", "total")], ["shard", "n_docs", "n_ids"])

    manifest = written(dealt.select("id", "ids", "part").mapInArrow(run, _MANIFEST), "manifest")
    fs, base = _open(path)
    for f in fs.get_file_info(pa.fs.FileSelector(base, allow_not_found=True)):
        if f.base_name.endswith(".part"):
            fs.delete_file(f.path)
    return manifest


class Shard:
    """A written shard, mapped where the file system is local: sequences by number, documents by place."""

    def __init__(self, uri: str, shard: int):
        self.fs, base = _open(uri)
        data, index = f"{base}/{_name(shard)}.arrow", f"{base}/{_name(shard)}.index.arrow"
        local = isinstance(self.fs, pa.fs.LocalFileSystem)
        take = pa.memory_map if local else self.fs.open_input_file
        self.data, self.index = pa.ipc.open_file(take(data)), pa.ipc.open_file(take(index))
        self.length = self.data.schema.field(0).type.list_size
        self.rows = self.data.get_batch(0).num_rows if self.data.num_record_batches else 0

    def _values(self, batch: int, column: int) -> pa.Array:
        return self.data.get_batch(batch).column(column).values

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask (1 and 0) of the ``i``-th sequence; both are views of the file."""
        b, r = divmod(i, self.rows)
        at = slice(r * self.length, (r + 1) * self.length)
        return self._values(b, 0).to_numpy()[at], self._values(b, 1).to_numpy()[at]

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from the ``start``-th on, over the borders of sequences and batches."""
        step = self.rows * self.length
        out = []
        while n > 0:
            b, at = divmod(start, step)
            piece = self._values(b, 0).to_numpy()[at : at + n]
            out.append(piece)
            start, n = start + len(piece), n - len(piece)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, "<u2")


def read(manifest: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files of a manifest.

    ``start`` counts the ids of all documents before it, in all shards; the checksum is over 32-bit ids. A manifest
    without shards, as an empty table leaves it, gives an empty table.
    """
    first = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    shards = manifest.select("shard", first.alias("first"))
    n = max(1, manifest.count())

    def run(batches):
        for batch in batches:
            for number, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(path, number)
                for b in range(shard.index.num_record_batches):
                    place = shard.index.get_batch(b)
                    starts, sizes = place.column(1).to_pylist(), place.column(2).to_pylist()
                    sums = [zlib.crc32(shard.ids(s, k).astype("<u4").tobytes()) for s, k in zip(starts, sizes)]
                    yield pa.RecordBatch.from_arrays([place.column(0), pa.array([s + offset for s in starts], pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    place = (F.row_number().over(Window.orderBy("shard")) - 1).alias("place")  # one row per shard
    return shards.select("shard", "first", place).repartitionById(n, F.col("place")).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def range_bounds(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES) -> list[int]:
    """First ids of all ranges but the first, so that ranges hold about as many documents and bytes of text together.

    A document counts once, and once more for every ``shard_bytes / shard_docs`` bytes; the bounds are quantiles of the
    ids so weighted. At most ``RANGES`` ranges, so the bounds are bounded too.
    """
    unit = max(1, shard_bytes // shard_docs)
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0))
    weighted = docs.select(F.col(id_col).cast("long").alias("id"), (1 + F.floor(size / unit)).cast("int").alias("w"))
    n = min(RANGES, -(-(weighted.agg(F.sum("w").alias("w")).first()["w"] or 0) // shard_docs))
    if n < 2:
        return []
    each = weighted.select(F.explode(F.array_repeat("id", F.col("w"))).alias("id"))
    at = each.agg(F.percentile_approx("id", [i / n for i in range(1, n)], max(10_000, 20 * n))).first()[0]
    return sorted(set(at or []))


def save(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end_id: int = END_ID, length: int = LENGTH, batch_rows: int = BATCH_ROWS, shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES, shard_ids: int = SHARD_IDS) -> tuple[DataFrame, str]:
    """Encode all of ``docs`` and write the files; returns the manifest and the folder.

    Null and empty texts hold the end id alone. An empty table writes no shard. Repeated ids keep all their rows; other
    columns don't matter.
    """
    path = path or scratch(docs.sparkSession, "tokens")
    kind = id_type(vocabulary or tokenizer_path(VOCABULARY))
    bounds = range_bounds(docs, id_col, text_col, shard_docs, shard_bytes)
    return write(encode(docs, id_col, text_col, vocabulary, end_id, bounds), path, len(bounds) + 1, kind, length, batch_rows, shard_ids), path
