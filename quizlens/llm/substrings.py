"""Exact removal of repeated substrings: every byte covered by a string of `length` bytes that starts anywhere else too.

The suffixes that matter are the starts of such strings, and only their first `length` bytes. They are sorted block by block, with a sample
of suffixes sorted beforehand whose ranks decide long ties:

1. The sample is a cover: of every `length`-byte string it holds one suffix at a place that depends on the string alone (the smallest hash of
   `gram` bytes among the first `window` places), so two equal strings meet in it at equal distances, which is what a difference cover gives
   for a fixed residue pattern. Choosing by content needs 2 / (window + 1) of the places; a residue cover of 273 needs 6 % of them.
2. Sample suffixes are ranked by the `length - window + 1` bytes that any string of theirs must share. A suffix with a rank of its own settles all
   places before it: none starts a repeated string. Where the whole surroundings of a sample suffix (all its strings) stand elsewhere too, all
   its places are repeated.
3. Only what is left, at the ends of repeated passages, is compared place by place: a place is its distance to the sample suffix and that
   suffix's rank, with the string's hash as the tie-break, one block of ranks at a time.

Equality is decided by 64-bit hashes with random byte values. Texts that hold no sample suffix with a shared rank are never moved; the others
are fetched once.

Defined results: null texts are empty; texts shorter than `length` keep everything; overlapping occurrences count, within a document
too. Repeated rows repeat each other and lose everything (from `length` bytes on). A removed run may end within a UTF-8 character; the rest
is bytes. An empty table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.llm.text import Hasher, mix, pieces, text_bytes
from quizlens.sinks.stage import stage

CHUNK = 1 << 20
GRAM, WINDOW = 16, 160
_SALT = np.uint64(0x6A09E667F3BCC909)


class Cover:
    """Sample suffixes of the texts that lie in `data` from rows[i] to rows[i + 1].

    at: the sample suffixes; low, high: first and last place of theirs; text: the row they are in. Places are starts of whole
    strings of `length` bytes within one text.
    """

    def __init__(self, data: np.ndarray, rows: np.ndarray, length: int, window: int = WINDOW, gram: int = GRAM):
        self.length, self.window = length, window
        self.hash = Hasher(data)
        n = len(data)
        room = np.maximum(np.diff(rows) - length + 1, 0)
        empty = np.zeros(0, np.int64)
        self.at = self.low = self.high = self.text = empty
        if not room.any():
            return
        start = np.arange(n - gram + 1)
        best, place, done = self.hash(start, start + gram), start, 1
        while done < window:  # smallest of the next `window` grams, by doubling; of equal ones the last
            step = min(done, window - done)
            later = best[step:] <= best[:-step]
            best, place = np.where(later, best[step:], best[:-step]), np.where(later, place[step:], place[:-step])
            done += step
        text = np.repeat(np.arange(len(room)), room)
        places = np.arange(len(text)) - np.repeat(np.cumsum(room) - room, room) + rows[:-1][text]
        chosen = place[places]
        new = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])]))
        self.at, self.text = chosen[new], text[new]
        self.low = places[new]
        self.high = places[np.append(new[1:], len(places)) - 1]

    def ranks(self) -> np.ndarray:
        """Hash of the bytes after a sample suffix that all its strings share."""
        return self.hash(self.at, self.at + self.length - self.window + 1).view(np.int64)

    def surroundings(self) -> np.ndarray:
        """Hash of all strings of a sample suffix at once, with their distances."""
        h = self.hash(self.low, self.high + self.length)
        h += (self.at - self.low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (self.high - self.low).astype(np.uint64) * _SALT
        return mix(h).view(np.int64)


def _cover(b: pa.RecordBatch, length: int) -> tuple[Cover, np.ndarray, np.ndarray]:
    data, rows = text_bytes(b.column("__text"))
    return Cover(data, rows, length), data, rows


def removed_runs(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of [start, end) spans that are sorted by start; touching ones are one."""
    if not len(spans):
        return spans.reshape(0, 2)
    end = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > end[:-1]]))
    return np.stack([spans[first, 0], end[np.append(first[1:], len(spans)) - 1]], axis=1)


def repeated(docs: DataFrame, text: str = "text", id: str = "doc_id", length: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, runs) per document; runs are the removed [start, end) in bytes."""
    if length < GRAM + WINDOW:
        raise ValueError(f"length must be at least {GRAM + WINDOW}")
    given = docs.select(docs[id].alias("id"), docs[text].alias("__text"), F.xxhash64(docs[text]).alias("key"))
    id_type = given.schema["id"].dataType.simpleString()
    # what is returned for texts that keep everything
    base = stage(given.select("id", "key", F.coalesce(F.octet_length("__text"), F.lit(0)).cast("bigint").alias("n_bytes"), F.sha2(F.coalesce("__text", F.lit("")).cast("binary"), 256).alias("kept_sha256")), "suffix-texts")

    # 1. sample suffixes, one row each
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "__text", CHUNK):
            c, _, rows = _cover(b, length)
            if len(c.at):
                keys = b.column("key").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(c.ranks()), pa.array(c.surroundings()), pa.array(keys[c.text]), pa.array((c.low - rows[c.text]).astype(np.int32))], ["rank", "around", "key", "low"])

    suffixes = stage(given.where(F.octet_length("__text") >= length).select("key", "__text").mapInArrow(sample, "rank BIGINT, around BIGINT, key BIGINT, low INT"), "suffix-sample")

    # 2. shared ranks; of these, surroundings that stand more than once, and those that must be compared place by place
    ranks = suffixes.groupBy("rank").agg(F.count(F.lit(1)).alias("n"), F.min("around").alias("a0"), F.max("around").alias("a1")).where("n > 1")
    tied = suffixes.join(ranks.select("rank", (F.col("a0") != F.col("a1")).alias("differ")), "rank")
    tied = stage(tied, "suffix-ties")
    whole = tied.where("differ").groupBy("rank", "around").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "low")).alias("one"))
    # one of equal surroundings stands for them; the places of the others are repeated without a comparison
    compare = whole.select(F.col("one.key").alias("key"), F.col("one.low").alias("low"), F.when(F.col("n") == 1, 2).otherwise(3).alias("code"))
    sure = tied.join(whole.where("n > 1").select("rank", "around"), ["rank", "around"], "left_semi").select("key", "low", F.lit(1).alias("code"))
    same = tied.where("NOT differ").select("key", "low", F.lit(1).alias("code"))
    codes = same.unionByName(sure).unionByName(compare).groupBy("key", "low").agg(F.max("code").alias("code"))
    marks = stage(codes.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("low", "code"))).alias("marks")), "suffix-marks")

    # texts with marks, one of each, fetched once: the marks are the built side, texts are streamed past them
    hit = given.join(marks.hint("shuffle_hash"), "key")
    texts = stage(hit.select("id", "key", "__text", "marks"), "suffix-texts")

    # 3. strings at the ends of repeated passages
    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "__text", CHUNK):
            data, rows = text_bytes(b.column("__text"))
            c = Cover(data, rows, length)
            code = _codes(b, c, rows)
            at = np.flatnonzero(code >= 2)
            if len(at):
                n = c.high[at] - c.low[at] + 1
                s = np.repeat(at, n)
                place = np.arange(len(s)) - np.repeat(np.cumsum(n) - n, n) + c.low[s]
                keys = b.column("key").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(c.hash(place, place + length).view(np.int64)), pa.array(keys[c.text[s]]), pa.array((place - rows[c.text[s]]).astype(np.int32)), pa.array(code[s] == 2)], ["string", "key", "place", "ask"])

    one_each = texts.select("key", "__text", "marks").dropDuplicates(["key"])
    placed = stage(one_each.mapInArrow(strings, "string BIGINT, key BIGINT, place INT, ask BOOLEAN"), "suffix-strings")
    twice = placed.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
    # a place whose surroundings stand once, and whose string stands elsewhere
    answers = placed.where("ask").join(twice, "string").groupBy("key").agg(F.sort_array(F.collect_list("place")).alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "__text", CHUNK):
            data, rows = text_bytes(b.column("__text"))
            c = Cover(data, rows, length)
            code = _codes(b, c, rows)
            out = [], [], [], [], []
            for i, places in enumerate(b.column("places").to_pylist()):
                size = int(rows[i + 1] - rows[i])
                mine = np.flatnonzero((c.text == i) & ((code == 1) | (code == 3)))
                spans = np.stack([c.low[mine] - rows[i], c.high[mine] - rows[i] + length], axis=1)
                if places:
                    p = np.array(places, np.int64)
                    spans = np.concatenate([spans, np.stack([p, p + length], axis=1)])
                runs = removed_runs(spans[np.argsort(spans[:, 0], kind="stable")])
                keep = np.ones(size, bool)
                for s, e in runs:
                    keep[s:e] = False
                text_of = data[rows[i] : rows[i + 1]]
                for o, x in zip(out, (size, int(size - keep.sum()), len(runs), hashlib.sha256(text_of[keep].tobytes()).hexdigest(), runs.tolist()), strict=True):
                    o.append(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string()),
                 pa.array(out[4], pa.list_(pa.list_(pa.int64())))], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "runs"])

    schema = f"id {id_type}, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING, runs ARRAY<ARRAY<BIGINT>>"
    changed = texts.join(answers.hint("shuffle_hash"), "key", "left").select("id", "__text", "marks", "places").mapInArrow(cut, schema)
    untouched = base.join(marks.select("key"), "key", "left_anti")
    clean = untouched.select("id", "n_bytes", F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"), "kept_sha256", F.array().cast("array<array<bigint>>").alias("runs"))
    return changed.unionByName(clean).withColumnRenamed("id", id)


def _codes(b: pa.RecordBatch, c: Cover, rows: np.ndarray) -> np.ndarray:
    """The mark of each sample suffix, 0 for none."""
    marks = b.column("marks").to_pylist()
    owner = np.repeat(np.arange(len(marks)), [len(m) for m in marks])
    low = np.array([x["low"] for m in marks for x in m], np.int64)
    code = np.array([x["code"] for m in marks for x in m], np.int64)
    at = np.searchsorted(c.low, low + rows[owner])
    ok = (at < len(c.low)) & (c.low[np.minimum(at, max(len(c.low) - 1, 0))] == low + rows[owner]) if len(c.low) else np.zeros(len(low), bool)
    out = np.zeros(len(c.at), np.int64)
    out[at[ok]] = code[ok]
    return out
