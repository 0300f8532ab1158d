"""Quality classifier by co-training.

Two views of a document are judged apart. The text view is naive Bayes over hashed words and word shapes, its log
odds averaged over the words (with some empty ones, so a few words say little). The metadata view has Gaussian log odds of length and layout figures and the log odds
of language and source. Both start from the labelled sample and are calibrated on a part of it that they are not
fitted on. In each round every document that one view is confident of is a pseudo-labelled example for the other;
these statistics are sums over the whole corpus. The two calibrated views together give the score.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, keeps_words, slices, written

#: Labelled rows that are fitted on, first by hash; rounds; probability from which a view is confident.
LABELLED, ROUNDS, CONFIDENT = 20_000, 2, 0.97
#: Share of the labelled rows for calibration, in percent; weight of all pseudo-labels against the labelled rows.
HELD_OUT, PSEUDO_WEIGHT = 30, 1.0
WORD_BUCKETS, SHAPE_BUCKETS, NAME_BUCKETS = 1 << 14, 1 << 10, 1 << 10
#: Layout figures of the metadata view.
FIGURES = ("log_chars", "log_lines", "line_mean", "line_spread", "word_mean", "upper", "digits", "marks", "repeated", "stutter")
#: Empty words that every text is taken to hold besides its own.
EMPTY_WORDS = 20
#: Figures above MOST count as MOST in sums; documents after which a task gives out its sums.
MOST, FLUSH = 1 << 10, 1 << 16
TEXT_SIZE, META_SIZE = WORD_BUCKETS + SHAPE_BUCKETS + 1, 2 * NAME_BUCKETS + 2 * len(FIGURES) + 1
_WORDS: dict[str, int] = {}
_MAX_WORDS = 400_000
_KINDS = np.full(256, 3, np.uint8)  # of bytes: upper, digit, mark, other
_KINDS[65:91], _KINDS[48:58] = 0, 1
_KINDS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-"]] = 2


def _hash(text: str, buckets: int) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") % buckets


def _shape(word: str) -> str:
    out = re.sub(r"[^\W\d_]+", lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a", word[:64])
    return re.sub(r"(.)\1+", r"\1", re.sub(r"\d+", "0", out))


def _code(word: str) -> int:
    """Bucket of a word and of its shape, in one number."""
    core = re.sub(r"[\W\d_]+", "", word.lower()) or word
    return _hash(core, WORD_BUCKETS) * SHAPE_BUCKETS + 1 + _hash(_shape(word), SHAPE_BUCKETS - 1)


def text_features(text: str) -> np.ndarray:
    """The numbers of all words of a whole text, in order."""
    words = text.split()
    codes = list(map(_WORDS.get, words))
    if None in codes:
        for i, w in enumerate(words):
            if codes[i] is None:
                c = _WORDS.get(w)
                if c is None:
                    c = _code(w)
                    if len(w) <= 64:
                        if len(_WORDS) >= _MAX_WORDS:
                            _WORDS.clear()
                        _WORDS[w] = c
                codes[i] = c
    codes = np.array(codes, np.int64)
    again = np.flatnonzero(codes[1:] == codes[:-1]) + 1  # a word that repeats the one before has a shape of its own
    codes[again] -= codes[again] % SHAPE_BUCKETS
    return codes


def meta_features(text: str, codes: np.ndarray) -> np.ndarray:
    """Length and layout figures of a whole text."""
    n_words = len(codes)
    raw = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(_KINDS[np.frombuffer(raw, np.uint8)], minlength=4) / max(1, len(raw))
    lines = text.split("\n")
    sizes = np.array([len(x) for x in lines], np.float64)
    long_lines = [x for x in lines if x]
    repeated = 1 - len(set(long_lines)) / len(long_lines) if long_lines else 0.0
    return np.array([math.log1p(len(text)), math.log1p(len(lines)), math.log1p(sizes.mean()), math.log1p(sizes.std()), len(text) / max(1, n_words), *np.sqrt(kinds[:3]), repeated, math.sqrt(np.count_nonzero(codes % SHAPE_BUCKETS == 0) / max(1, n_words))])


class Batch:
    """Features of some documents: words of all one after the other, and one row of figures each."""

    def __init__(self, lang: np.ndarray, source: np.ndarray, figures: np.ndarray, codes: np.ndarray, sizes: np.ndarray):
        self.lang, self.source, self.figures, self.codes, self.sizes = lang, source, figures, codes, sizes
        self.doc = np.repeat(np.arange(len(sizes)), sizes)

    @classmethod
    def of_rows(cls, rows) -> Batch:
        """From (text, lang, source) rows."""
        lang, source, figures, codes = [], [], [], []
        for text, l, s in rows:
            text = text or ""
            c = text_features(text)
            lang.append(_hash(f"lang {l}", NAME_BUCKETS))
            source.append(_hash(f"source {s}", NAME_BUCKETS))
            figures.append(meta_features(text, c))
            codes.append(c)
        sizes = np.array([len(c) for c in codes], np.int64)
        return cls(np.array(lang, np.int64), np.array(source, np.int64), np.array(figures).reshape(-1, len(FIGURES)), np.concatenate([np.zeros(0, np.int64), *codes]), sizes)

    @classmethod
    def of_arrow(cls, batch: pa.RecordBatch) -> Batch:
        """From rows of the features table."""
        lang, source, figures, codes = (batch.column(batch.schema.get_field_index(n)) for n in ("lang", "source", "figures", "codes"))
        return cls(lang.to_numpy().astype(np.int64), source.to_numpy().astype(np.int64), figures.flatten().to_numpy().reshape(-1, len(FIGURES)), codes.flatten().to_numpy().astype(np.int64), np.diff(codes.offsets.to_numpy()).astype(np.int64))

    def arrow(self) -> list[pa.Array]:
        ends = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
        k = np.full(len(self.sizes), len(FIGURES))
        return [pa.array(self.lang.astype(np.int32)), pa.array(self.source.astype(np.int32)), pa.ListArray.from_arrays(ends(k), pa.array(self.figures.ravel())), pa.ListArray.from_arrays(ends(self.sizes), pa.array(self.codes.astype(np.int32)))]


_FEATURES = "lang int, source int, figures array<double>, codes array<int>"


def _log_odds(counts: np.ndarray, strength: float = 10.0) -> np.ndarray:
    """Log odds of hashed features, drawn towards what both classes have in common; 0 for those never seen."""
    whole = counts.sum(axis=0)
    common = whole / max(1.0, whole.sum())
    rate = (counts + strength * common) / (counts.sum(axis=1, keepdims=True) + strength)
    with np.errstate(divide="ignore", invalid="ignore"):
        odds = np.log(rate[1]) - np.log(rate[0])
    return np.where(whole > 0, np.nan_to_num(odds, posinf=0.0, neginf=0.0), 0.0)


class TextView:
    """Log odds of hashed words and word shapes, from the sums of both classes (in whole 1 / UNIT)."""

    UNIT = 1 << 36

    def __init__(self, sums: np.ndarray):
        self.words = _log_odds(sums[:, :WORD_BUCKETS])
        self.shapes = _log_odds(sums[:, WORD_BUCKETS : WORD_BUCKETS + SHAPE_BUCKETS])

    def score(self, b: Batch) -> np.ndarray:
        odds = self.words[b.codes // SHAPE_BUCKETS] + self.shapes[b.codes % SHAPE_BUCKETS]
        return np.bincount(b.doc, odds, len(b.sizes)) / (b.sizes + EMPTY_WORDS)

    @staticmethod
    def sums(b: Batch, chosen: np.ndarray) -> np.ndarray:
        """Sums over the chosen documents: the words of each weigh one in all, so long documents don't dominate.

        Whole numbers, so that the sums don't depend on the order of documents.
        """
        unit, word = TextView.UNIT, chosen[b.doc]
        weight = np.rint(unit / np.maximum(b.sizes, 1))[b.doc[word]]
        codes = b.codes[word]
        return np.concatenate([np.bincount(codes // SHAPE_BUCKETS, weight, WORD_BUCKETS), np.bincount(codes % SHAPE_BUCKETS, weight, SHAPE_BUCKETS), [chosen.sum() * unit]]).astype(np.int64)


class MetaView:
    """Gaussian log odds of the figures, and log odds of language and source, from sums in whole 1 / UNIT."""

    UNIT = 1 << 20

    def __init__(self, sums: np.ndarray):
        n_names, k = NAME_BUCKETS, len(FIGURES)
        self.names = [_log_odds(sums[:, :n_names]), _log_odds(sums[:, n_names : 2 * n_names])]
        n = np.maximum(sums[:, -1:], 1.0)
        self.mean = sums[:, 2 * n_names : 2 * n_names + k] / n
        spread = sums[:, 2 * n_names + k : 2 * n_names + 2 * k] / n - self.mean**2
        self.variance = 0.8 * np.maximum(spread, 0) + 0.2 * (spread.mean(axis=0) + 1e-4)

    def score(self, b: Batch) -> np.ndarray:
        gauss = [-((b.figures - self.mean[c]) ** 2) / (2 * self.variance[c]) - np.log(self.variance[c]) / 2 for c in (0, 1)]
        odds = np.clip(gauss[1] - gauss[0], -8, 8).sum(axis=1) + self.names[0][b.lang] + self.names[1][b.source]
        return odds * b.sizes / (b.sizes + EMPTY_WORDS)

    @staticmethod
    def sums(b: Batch, chosen: np.ndarray) -> np.ndarray:
        """Sums over the chosen documents; figures count up to ``MOST``."""
        unit, x = MetaView.UNIT, np.minimum(b.figures[chosen], MOST)
        whole = lambda v: np.rint(v * unit).astype(np.int64).sum(axis=0)
        names = [np.bincount(n[chosen], minlength=NAME_BUCKETS) * unit for n in (b.lang, b.source)]
        return np.concatenate([*names, whole(x), whole(x * x), [chosen.sum() * unit]]).astype(np.int64)


def _calibrate(scores: np.ndarray, labels: np.ndarray) -> list[float]:
    """Slopes and offset of the logistic curve through columns of scores, lightly penalised; no slope is negative."""
    scale = np.maximum(scores.std(axis=0), 1e-6)
    x = np.concatenate([scores / scale, np.ones((len(scores), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w)), x.T @ (labels - p) - 0.05 * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return [*np.maximum(w[:-1] / scale, 0.0).tolist(), float(w[-1])]


class CoTrained:
    """Both views with their calibration, and the curve through both calibrated log odds."""

    def __init__(self, text: TextView, meta: MetaView):
        self.text, self.meta = text, meta
        self.curves, self.joint = [[1.0, 0.0], [1.0, 0.0]], [0.5, 0.5, 0.0]

    def odds(self, b: Batch) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log odds of the two views."""
        return tuple(np.clip(slope * view.score(b) + offset, -12, 12) for view, (slope, offset) in zip((self.text, self.meta), self.curves))

    def probabilities(self, b: Batch) -> list[np.ndarray]:
        """Probability of being good by text, by metadata, and by both."""
        first, second = self.odds(b)
        return [1 / (1 + np.exp(-x)) for x in (first, second, np.clip(self.joint[0] * first + self.joint[1] * second + self.joint[2], -30, 30))]


def _judged(model: CoTrained | None, b: Batch) -> list[np.ndarray]:
    return [np.full(len(b.sizes), 0.5)] * 3 if model is None else model.probabilities(b)


def _collected(features: DataFrame, labels_of) -> list[np.ndarray]:
    """Sums of both classes for the text and the metadata view.

    ``labels_of(batch, features)`` gives each document's label for either view, -1 for none. Tasks sum their rows
    first; one row per class and feature comes to the driver, whatever the number of documents. Sums are of whole
    numbers, so that they don't depend on how rows are dealt to tasks.
    """
    sizes = (TEXT_SIZE, META_SIZE)

    def told(sums):
        for view, s in enumerate(sums):
            label, at = np.nonzero(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), view, np.int32)), pa.array(label.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(s[label, at])], ["view", "label", "at", "value"])

    def run(batches):
        sums, seen = [np.zeros((2, n), np.int64) for n in sizes], 0
        for batch in slices(batches, 4096):
            b = Batch.of_arrow(batch)
            for view, label, s in zip((TextView, MetaView), labels_of(batch, b), sums):
                for c in (0, 1):
                    s[c] += view.sums(b, label == c)
            seen += batch.num_rows
            if seen >= FLUSH:
                yield from told(sums)
                sums, seen = [np.zeros((2, n), np.int64) for n in sizes], 0
        yield from told(sums)

    out = [np.zeros((2, n)) for n in sizes]
    total = F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    for r in features.mapInArrow(run, "view int, label int, at int, value long").groupBy("view", "label", "at").agg(total).collect():
        out[r["view"]][r["label"], r["at"]] = float(r["value"]) / (TextView, MetaView)[r["view"]].UNIT
    return out


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep: bool = False) -> DataFrame:
    """A written table (row, id, lang, source, figures, codes) of every document's features: texts are read once.

    Null texts count as empty, null names as one more name; ids may repeat or be null, and an empty table gives an
    empty table. With ``keep`` also ``doc``, all columns of the document, for :func:`keep_good`.
    """
    read = [text_col, lang_col, source_col]
    inside = keep and all(dict(docs.dtypes).get(c) == "string" for c in read)  # then they are read out of doc, not sent twice
    columns = [] if inside else [F.col(c).cast("string").alias(n) for c, n in zip(read, "tls")]
    doc = [F.struct(*docs.columns).alias("doc")] if keep else []
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), *doc, *columns)
    kind = f", doc {rows.schema['doc'].dataType.simpleString()}" if keep else ""

    def run(batches):
        keeps_words("quality", _WORDS.clear)
        for batch in slices(batches, 500):
            texts = [batch.column(2).field(c) for c in read] if inside else batch.columns[-3:]
            b = Batch.of_rows(zip(*(c.to_pylist() for c in texts)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *b.arrow(), *([batch.column(2)] if keep else [])], ["row", "id", "lang", "source", "figures", "codes", *(["doc"] if keep else [])])

    return written(rows.mapInArrow(run, f"row long, id long, {_FEATURES}{kind}"), "features", compression="zstd")


_NAMES = [c.split()[0] for c in _FEATURES.split(", ")]


def _sample(table: DataFrame, labels: DataFrame, id_col: str, label_col: str, labelled: int) -> DataFrame | None:
    """A written table of at most ``labelled`` rows: features, _label, and _held for three in ten of each class.

    A class of which a single row is labelled has it in both parts; None if a class has none. An id of several rows
    counts with the first of them.
    """
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label")).filter("_id is not null and _label in (0, 1)")
    known = known.groupBy("_id").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(labelled)
    known = written(known, "labels")  # bounded by ``labelled``, so it may be broadcast
    first = table.select("id", "row").join(F.broadcast(known), F.col("id") == F.col("_id")).groupBy("_id", "_label").agg(F.min("row").alias("_row"))
    order = Window.partitionBy("_label").orderBy(F.xxhash64("_id", F.lit(7)), "_id")  # at most ``labelled`` rows
    first = written(first.withColumn("_n", F.row_number().over(order)), "first")
    counts = {r["_label"]: r["n"] for r in first.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if any(not counts.get(c) for c in (0, 1)):
        return None
    held = (F.col("_n") % 10).isin(2, 5, 8)
    single = F.array(*[F.lit(c) for c, n in counts.items() if n == 1]).cast("array<int>")
    parts = F.when(F.array_contains(single, F.col("_label")), F.array(F.lit(True), F.lit(False))).otherwise(F.array(held))
    dealt = first.select("_row", "_label", F.explode(parts).alias("_held"))
    seen = table.join(F.broadcast(dealt), F.col("row") == F.col("_row"))
    return written(seen.select(*_NAMES, "_label", "_held"), "labelled")


def train(table: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", labelled: int = LABELLED, rounds: int = ROUNDS, confident: float = CONFIDENT) -> CoTrained | None:
    """Fit on at most ``labelled`` labelled rows of a features table, then exchange pseudo-labels over all of it.

    None only if a class has no labelled document. Ids labelled more than once take the largest label; null ids and
    labels are left out.
    """
    seen = _sample(table, labels, id_col, label_col, labelled)
    if seen is None:
        return None

    def own(batch, b):
        label = batch.column(len(_NAMES)).to_numpy()
        return label, label

    base = _collected(seen.filter("not _held").select(*_NAMES, "_label"), own)

    def fitted(sums) -> CoTrained:
        model = CoTrained(TextView(sums[0]), MetaView(sums[1]))

        def raw(batches):
            for batch in slices(batches, 4096):
                b = Batch.of_arrow(batch)
                yield pa.RecordBatch.from_arrays([pa.array(model.text.score(b)), pa.array(model.meta.score(b)), batch.column(len(_NAMES))], ["a", "b", "label"])

        rows = seen.filter("_held").select(*_NAMES, "_label").mapInArrow(raw, "a double, b double, label int").orderBy("a", "b", "label").collect()  # at most ``labelled`` rows
        y = np.array([r["label"] for r in rows], np.float64)
        raws = np.array([[r["a"], r["b"]] for r in rows])
        model.curves = [_calibrate(raws[:, i : i + 1], y) for i in (0, 1)]
        model.joint = _calibrate(np.clip(raws * [c[0] for c in model.curves] + [c[1] for c in model.curves], -12, 12), y)
        return model

    model = fitted(base)
    limit = math.log(confident / (1 - confident))
    sure = lambda odds: np.where(odds >= limit, 1, np.where(odds <= -limit, 0, -1))
    for _ in range(rounds):

        def pseudo(batch, b, model=model):
            by_text, by_meta = model.odds(b)
            return sure(by_meta), sure(by_text)  # what one view is sure of is an example for the other

        sums = []
        for ours, theirs in zip(base, _collected(table.select(*_NAMES), pseudo)):
            # the last cell counts documents: all pseudo-labels of a class weigh as much as its labelled rows
            weight = PSEUDO_WEIGHT * ours[:, -1:] / np.maximum(theirs[:, -1:], 1.0)
            sums.append(ours + np.minimum(weight, 1.0) * theirs)
        model = fitted(sums)
    forget(seen)
    return model


#: Documents with a lower probability of being good are rejected.
KEEP = 0.3


def _kept(found: list[np.ndarray], keep: float) -> np.ndarray:
    """Whether the score, rounded as it is told, reaches ``keep``."""
    return np.round(found[2], 6) >= keep


def score(table: DataFrame, model: CoTrained | None, keep: float = KEEP) -> DataFrame:
    """(id, text_score, meta_score, score, keep) of every row of a features table.

    Without a model everything scores one half and is kept.
    """

    def run(batches):
        for batch in slices(batches, 4096):
            found = _judged(model, Batch.of_arrow(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.round(x, 6)) for x in found), pa.array(_kept(found, keep))], ["id", "text_score", "meta_score", "score", "keep"])

    return table.select("id", *_NAMES).mapInArrow(run, "id long, text_score double, meta_score double, score double, keep boolean")


def keep_good(table: DataFrame, model: CoTrained | None, keep: float = KEEP) -> DataFrame:
    """The documents, all columns, that the model does not reject, from a features table with ``doc``."""

    def run(batches):
        for batch in slices(batches, 4096):
            good = pa.array(_kept(_judged(model, Batch.of_arrow(batch)), keep))
            yield pa.RecordBatch.from_arrays([batch.column(batch.num_columns - 1).filter(good)], ["doc"])

    return table.select(*_NAMES, "doc").mapInArrow(run, f"doc {table.schema['doc'].dataType.simpleString()}").select("doc.*")
