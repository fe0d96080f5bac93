"""Toxicity classifier with counterfactual regularisation.

A logistic regression over the presence of words and word beginnings is fitted on a bounded sample of labelled rows. For every sampled text that names a
group of people two counterfactual twins are made, in which each identity term is swapped for another of its group of terms, or for
nothing; the loss adds `fairness * (logit(text) - logit(twin))^2`, so that naming a group, or which one, moves the score as little as possible and neutral
mentions are not taken for insults. Scores need only the words of the text, never labels, ids, languages or sources.

Sampling: at most `sample_per_class` labelled training rows per class, those with the smallest hash of their id. This bound is the only
one; every text is scored, whole. Selected words: at most `max_words`, by the strength of their association in the sample.

Defined results: null and empty texts have no words and get the score of the intercept. Without training rows of both classes, or where no word speaks
for either class strongly enough, the model has no weights and every score is the smoothed share of toxic rows (0.5 without any rows). Labels that are null are ignored; of several labels of one id the largest
counts. Repeated rows are scored each for itself; an empty table gives an empty result. Other columns are carried along; columns
named as the output's are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.llm.text import pieces

CHUNK = 1 << 20
# fixed values: groups of identity terms that may stand for one another
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "african", "european", "latino"), ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrant", "citizen", "refugee"), ("immigrants", "citizens", "refugees"), ("old", "young"), ("deaf", "blind", "disabled"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def word_set(text: bytes) -> set[bytes]:
    """Distinct words of letters and digits, A-Z in lower case."""
    return set(text.translate(_TABLE).split())


def features(words: set[bytes]) -> set[bytes]:
    """The words, and their first 4, 5 and 6 bytes (marked by a caret), so that inflected and compound forms share weight."""
    return words | {b"^" + w[:n] for w in words for n in (4, 5, 6) if len(w) > n}


def unpacked(words: bytes) -> set[bytes]:
    """The features of words joined by spaces."""
    return features(set(words.split()))


@dataclass
class Model:
    """Intercept and word weights; at most `max_words` of them."""

    intercept: float
    weights: dict[bytes, float] = field(default_factory=dict)

    def score(self, text: bytes | None) -> float:
        z = self.intercept + math.fsum(self.weights[w] for w in features(word_set(text or b"")) & self.weights.keys())
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def swapped(words: set[bytes], groups=IDENTITY_TERMS) -> set[bytes] | None:
    """The words with each identity term replaced by the next one of its group that the text has not; None without such terms."""
    out, changed = set(words), False
    for group in groups:
        terms = [t.encode() for t in group]
        others = [t for t in terms if t not in words]
        for k, t in enumerate(x for x in terms if x in words and others):
            out.discard(t)
            out.add(others[k % len(others)])
            changed = True
    return out if changed else None


def training_fold(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row's label may be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds != 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, sample_per_class: int, groups=IDENTITY_TERMS) -> list[tuple[int, list[bytes]]]:
    """(label, [words, words of the twin]) of the sampled rows, words joined by spaces; its size is bounded by the parameter."""
    usable = labels.where(training_fold(F.col("doc_id")) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = [usable.where(test).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_per_class) for test in ("toxic = 1", "toxic <> 1")]
    # at most 2 * sample_per_class ids: a bounded broadcast
    chosen = F.broadcast(parts[0].unionByName(parts[1]).select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic")))
    texts = docs.select(docs["doc_id"].alias("__doc"), docs["text"].alias("__text")).join(chosen, F.col("__doc") == F.col("__id"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [word_set((t or "").encode()) for t in b.column("__text").to_pylist()]
            twins = [swapped(s, groups) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column("__toxic").cast(pa.int32()), pa.array([b" ".join(sorted(s)) for s in sets], pa.binary()),
                 pa.array([None if s is None else b" ".join(sorted(s)) for s in twins], pa.binary())], ["toxic", "words", "twin"])

    rows = texts.select("__toxic", "__text").mapInArrow(words, "toxic INT, words BINARY, twin BINARY").collect()
    return [(int(r.toxic == 1), [bytes(x) for x in (r.words, r.twin) if x is not None]) for r in rows]


def fit(rows: list[tuple[int, list[bytes]]], max_words: int = 4096, strength: float = 3.0, ridge: float = 1e-5,
        fairness: float = 1.0, steps: int = 800) -> Model:
    """Fits the model on sampled rows: word selection by association, then gradient descent (Adam) on the regularised loss.

    Feature sets are made one at a time; only the packed words and the chosen entries are held.
    """
    n1 = sum(y for y, _ in rows)
    n0 = len(rows) - n1
    share = (n1 + 0.5) / (len(rows) + 1)
    blind = Model(math.log(share / (1 - share)))
    if not n1 or not n0:
        return blind
    counts: dict[bytes, list[int]] = {}
    for y, sets in rows:
        for w in unpacked(sets[0]):
            counts.setdefault(w, [0, 0])[y] += 1
    ranked = []
    for w, (c0, c1) in counts.items():
        p1, p0 = (c1 + 0.5) / (n1 + 1), (c0 + 0.5) / (n0 + 1)
        z = (math.log(p1 / (1 - p1)) - math.log(p0 / (1 - p0))) / math.sqrt(1 / (c1 + 0.5) + 1 / (n1 - c1 + 0.5) + 1 / (c0 + 0.5) + 1 / (n0 - c0 + 0.5))
        if z >= strength and p1 > 4 * p0:
            ranked.append((-z, w))
    chosen = [w for _, w in sorted(ranked)[:max_words]]
    if not chosen:  # both classes weigh the same below: without words all scores would be 0.5, and all texts toxic
        return blind
    named = sorted({w for _, sets in rows for s in sets[1:] for w in unpacked(s) ^ unpacked(sets[0])} - set(chosen))  # identity terms in use
    index = {w: i for i, w in enumerate([*chosen, *named])}

    def matrix(sets: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        entries = [np.array([index[w] for w in unpacked(s) if w in index], np.int64) for s in sets]
        return np.repeat(np.arange(len(sets)), [len(e) for e in entries]), np.concatenate([np.zeros(0, np.int64), *entries])

    y = np.array([y for y, _ in rows], float)
    balance = np.where(y == 1, 0.5 / n1, 0.5 / n0)  # both classes weigh the same
    r, c = matrix([s[0] for _, s in rows])
    # each against its twin and against itself without the swapped terms: with the twin alone all terms of a group may rise together
    twins = [(s[0], t) for _, s in rows if len(s) > 1 for t in (s[1], b" ".join(set(s[0].split()) & set(s[1].split())))]
    (ra, ca), (rb, cb) = matrix([a for a, _ in twins]), matrix([b for _, b in twins])
    w, m, v = (np.zeros(len(index) + 1) for _ in range(3))
    for step in range(1, steps + 1):
        z = w[-1] + np.bincount(r, w[c], len(rows))
        e = balance * (1 / (1 + np.exp(-z)) - y)
        g = np.append(np.bincount(c, e[r], len(index)), e.sum())
        g[:-1] += ridge * w[:-1]
        if twins:
            d = np.bincount(ra, w[ca], len(twins)) - np.bincount(rb, w[cb], len(twins))
            k = 2 * fairness / len(twins)
            g[:-1] += k * (np.bincount(ca, d[ra], len(index)) - np.bincount(cb, d[rb], len(index)))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model(float(w[-1]), {word: float(w[i]) for word, i in index.items()})


def train(docs: DataFrame, labels: DataFrame, sample_per_class: int = 4000, **options) -> Model:
    return fit(sample(docs, labels, sample_per_class), **options)


def score(docs: DataFrame, model: Model, text: str = "text", keep: bool = False) -> DataFrame:
    """docs with `score` and `predicted`; the text itself only with keep=True. The model travels with the task: at most max_words words."""
    rest = [c for c in docs.columns if c not in ("score", "predicted") and (keep or c != text)]
    given = docs.select(*[docs[c] for c in rest], *([] if keep else [docs[text].alias("__text")]))
    source = text if keep else "__text"
    schema = docs.select(*[docs[c] for c in rest], F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, source, CHUNK):
            s = np.array([model.score(None if t is None else t.encode()) for t in b.column(source).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*rest, "score", "predicted"])

    return given.mapInArrow(run, schema)
