"""Quality classifier: a support vector machine over n-gram indicators scaled by naive Bayes log-count ratios.

1. Features are indicators of n-grams, hashed into 2^`bits` places: of one and two lower-cased words, and of one to three word shapes. A
   shape keeps one character per run of a class (capitals, other letters, digits, each kind of sign), and tells whether the word repeats the one before
   it; so shouting, sign litter, tables and stuttering have n-grams of their own in any language.
2. On a bounded sample of labelled rows (`sample_per_class` per class, those with the smallest hash of their id) each place gets the ratio
   log((p + a) / |p + a|) - log((q + a) / |q + a|) of its document counts in the two classes, and indicators are multiplied by it.
3. A linear model with hinge loss is fitted by dual coordinate descent; both classes have the same total cost. Rows have length one, so that long
   and short texts have the same say.
4. Margins of rows that a second fit has not seen give a sigmoid, which maps the margin to a score. The sigmoid's rows are weighed to the labelled
   rows' class shares, counted over all of them.

The sample is the only bound; every text is scored, whole. Scores need only the words of the text: never labels, ids, languages or sources. The model is
one float per place and travels with the task; memory of a task grows with its longest text.

Defined results: null and empty texts have no features and get the score of the intercept. Without training rows of both classes every text gets
the smoothed share of rows of class 1 (0.5 without any rows). Null labels are ignored; of several labels of one id the largest counts. Repeated rows are scored each for
itself; ties of the sample's hash are broken by id; an empty table gives an empty result. Other columns are carried along; columns named as the output's are
replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.llm.text import Hasher, lowered, mix, pieces, text_bytes, word_bounds

CHUNK = 1 << 20
_KINDS = np.zeros(256, np.uint8)  # signs stand for themselves
_KINDS[:] = np.arange(256)
_KINDS[65:91] = ord("X")
_KINDS[97:123] = ord("x")
_KINDS[48:58] = ord("9")
_KINDS[128:] = ord("x")
_STEP = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash per word of its characters' classes, runs taken together."""
    kinds = _KINDS[data]
    new = np.ones(len(data), bool)
    new[1:] = kinds[1:] != kinds[:-1]
    new[starts] = True
    place = np.concatenate([[0], np.cumsum(new)])
    return Hasher(kinds[new])(place[starts], place[ends])


def features(data: np.ndarray, rows: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places of the texts' n-grams, sorted by text and place: (text, place) of each."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none
    starts, ends = word_bounds(data, rows)
    if not len(starts):
        return none, none
    text = np.searchsorted(rows, starts, "right") - 1
    words = Hasher(lowered(data))(starts, ends)
    shapes = _shapes(data, starts, ends)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    shapes[again] ^= np.uint64(0x5851F42D4C957F2D)
    keys = []
    for stream, most, salt in ((words, 2, np.uint64(0)), (shapes, 3, np.uint64(1))):
        h = np.zeros(len(stream), np.uint64)
        for k in range(most):
            m = len(stream) - k
            if m <= 0:
                break
            h = h[:m] + (stream[k:] ^ salt) * _STEP[k]
            inside = text[k:] == text[:m]
            place = mix(h + np.uint64(k)) >> np.uint64(64 - bits)
            keys.append((text[:m][inside].astype(np.uint64) << np.uint64(bits)) | place[inside])
    key = np.unique(np.concatenate(keys))
    return (key >> np.uint64(bits)).astype(np.int64), (key & np.uint64((1 << bits) - 1)).astype(np.int64)


@dataclass
class Model:
    """Weights per place (log-count ratio times the machine's weight), squared ratios, intercept, and the sigmoid's slope and offset."""

    bits: int
    weights: np.ndarray | None
    squares: np.ndarray | None
    intercept: float
    slope: float
    offset: float

    def margins(self, text: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
        if self.weights is None:
            return np.zeros(n)
        length = np.sqrt(np.bincount(text, self.squares[place], n))
        return np.bincount(text, self.weights[place], n) / np.where(length > 0, length, 1) + self.intercept

    def scores(self, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Scores of the texts that lie in `data` from rows[i] to rows[i + 1]."""
        text, place = features(data, rows, self.bits)
        return sigmoid(self.slope * self.margins(text, place, len(rows) - 1) + self.offset)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, size: int, smooth: float = 1.0) -> np.ndarray:
    p, q = (smooth + sum_of(rows, y == v, size) for v in (1, 0))
    return np.log(p / p.sum()) - np.log(q / q.sum())


def sum_of(rows: list[np.ndarray], chosen: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size)
    for row, c in zip(rows, chosen, strict=True):
        if c:
            out[row] += 1
    return out


def machine(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float, rounds: int, tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """Hinge loss with an L2 penalty, by dual coordinate descent over rows of unit length; the intercept is one more feature of value 1."""
    sign = np.where(y == 1, 1.0, -1.0)
    upper = cost * len(y) / (2 * np.where(y == 1, (y == 1).sum(), (y != 1).sum()))
    values = []
    for row in rows:
        v = ratio[row]
        values.append(v / (math.sqrt(float(v @ v)) or 1.0))
    square = np.array([float(v @ v) + 1 for v in values])
    alpha, w, b = np.zeros(len(y)), np.zeros(len(ratio)), 0.0
    random = np.random.RandomState(7)
    for _ in range(rounds):
        worst = 0.0
        for i in random.permutation(len(y)):
            row, v = rows[i], values[i]
            gradient = sign[i] * (float(w[row] @ v) + b) - 1
            to = min(max(alpha[i] - gradient / square[i], 0.0), upper[i])
            step = to - alpha[i]
            if step:
                worst = max(worst, abs(step))
                alpha[i] = to
                w[row] += step * sign[i] * v
                b += step * sign[i]
        if worst < tolerance * cost:
            break
    return w * ratio, b


def calibrated(margin: np.ndarray, y: np.ndarray, share: float, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of a sigmoid, by Newton steps on the smoothed log loss; `share` is the weight of class 1."""
    n1, n0 = (y == 1).sum(), (y != 1).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, share / n1, (1 - share) / n0) * len(y)
    x = np.stack([margin, np.ones(len(margin))], 1)
    at = np.array([1.0, math.log(share / (1 - share))])
    loss = lambda v: float((weight * (np.logaddexp(0, x @ v) - target * (x @ v))).sum()) + 1e-3 * float(v[0] ** 2)
    now = loss(at)
    for _ in range(steps):
        p = sigmoid(x @ at)
        g = x.T @ (weight * (p - target)) + np.array([2e-3 * at[0], 0])
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([2e-3, 1e-9])
        move, scale = np.linalg.solve(h, g), 1.0
        while scale > 1e-6 and loss(at - scale * move) > now:
            scale /= 2
        if scale <= 1e-6 or now - loss(at - scale * move) < 1e-10:
            break
        at = at - scale * move
        now = loss(at)
    return float(at[0]), float(at[1])


def fit(rows: list[np.ndarray], y: np.ndarray, totals: tuple[int, int], bits: int, cost: float = 4.0, rounds: int = 40, folds: int = 4) -> Model:
    """rows: distinct places of each sampled text; totals: labelled training rows of class 0 and 1, sampled or not."""
    n0, n1 = totals
    share = (n1 + 0.5) / (n0 + n1 + 1)
    if not (y == 1).any() or not (y == 0).any():
        return Model(bits, None, None, 0.0, 0.0, math.log(share / (1 - share)))
    size = 1 << bits

    def solved(chosen: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        part = [r for r, c in zip(rows, chosen, strict=True) if c]
        ratio = log_count_ratios(part, y[chosen], size)
        return *machine(part, y[chosen], ratio, cost, rounds), ratio * ratio

    # rows are dealt to folds class by class, so that a fold has both where there are enough
    fold = np.zeros(len(y), np.int64)
    for v in (0, 1):
        fold[y == v] = np.arange((y == v).sum()) % folds
    margin, seen = np.zeros(len(y)), np.zeros(len(y), bool)
    for k in range(folds):
        out = fold == k
        if len(np.unique(y[~out])) < 2 or not out.any():
            continue
        w, b, squares = solved(~out)
        held = [r for r, o in zip(rows, out, strict=True) if o]
        text = np.repeat(np.arange(len(held)), [len(r) for r in held])
        margin[out] = Model(bits, w, squares, b, 1.0, 0.0).margins(text, np.concatenate([np.zeros(0, np.int64), *held]), len(held))
        seen |= out
    w, b, squares = solved(np.ones(len(y), bool))
    if len(np.unique(y[seen])) < 2:  # too few rows to hold any out
        return Model(bits, w, squares, b, 1.0, math.log(share / (1 - share)))
    slope, offset = calibrated(margin[seen], y[seen], share)
    return Model(bits, w, squares, b, slope, offset)


def training_fold(doc_id: Column, folds: int = 4, held: int = 2) -> Column:
    """Whether a row's label may be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds != held, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", id: str = "doc_id", sample_per_class: int = 3000, bits: int = 17, **options) -> Model:
    """Fits the model; the driver gets the sampled rows' places, at most 2^bits / 8 bytes a row."""
    usable = labels.where(training_fold(labels[id]) & labels[label].isNotNull()).groupBy(labels[id].alias("__id")).agg(F.max(labels[label]).alias("__label"))
    usable = usable.select("__id", F.when(F.col("__label") == 1, 1).otherwise(0).alias("__label"))
    totals = {r["__label"]: r["count"] for r in usable.groupBy("__label").count().collect()}  # two rows
    parts = [usable.where(F.col("__label") == v).orderBy(F.xxhash64("__id"), "__id").limit(sample_per_class) for v in (0, 1)]
    # at most 2 * sample_per_class ids: a bounded broadcast
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select(docs[id].alias("__doc"), docs[text].alias("__text")).join(chosen, F.col("__doc") == F.col("__id"))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "__text", CHUNK):
            data, rows = text_bytes(b.column("__text"))
            of, place = features(data, rows, bits)
            cuts = np.searchsorted(of, np.arange(b.num_rows + 1))
            packed = [_packed(place[cuts[i] : cuts[i + 1]], bits) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__label"), pa.array(packed, pa.binary())], ["id", "label", "places"])

    id_type = texts.schema["__id"].dataType.simpleString()
    found = texts.select("__id", "__label", "__text").mapInArrow(places, f"id {id_type}, label INT, places BINARY").collect()
    # several rows may have one id: all are learnt from; the order is that of the content, whatever the plan
    found = sorted((r.label, bytes(r.places)) for r in found)
    return fit([_unpacked(p, bits) for _, p in found], np.array([v for v, _ in found], np.int64), (totals.get(0, 0), totals.get(1, 0)), bits, **options)


def _packed(place: np.ndarray, bits: int) -> bytes:
    """Sorted places as numbers, or as a bitmap where that is shorter."""
    if 4 * len(place) < (1 << bits) // 8:
        return b"n" + place.astype("<u4").tobytes()
    mark = np.zeros(1 << bits, np.uint8)
    mark[place] = 1
    return b"b" + np.packbits(mark).tobytes()


def _unpacked(packed: bytes, bits: int) -> np.ndarray:
    if packed[:1] == b"n":
        return np.frombuffer(packed[1:], "<u4").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed[1:], np.uint8), count=1 << bits))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs without `text`, with `score` and `predicted`."""
    rest = [c for c in docs.columns if c not in (text, "score", "predicted")]
    given = docs.select(*[docs[c] for c in rest], docs[text].alias("__text"))
    schema = docs.select(*[docs[c] for c in rest], F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "__text", CHUNK):
            s = model.scores(*text_bytes(b.column("__text")))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*rest, "score", "predicted"])

    return given.mapInArrow(run, schema)
