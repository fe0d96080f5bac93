"""Language-model scoring with n-gram tries in Elias-Fano form.

The model is a bigram model with Dirichlet smoothing towards the additive unigram model: for a token w after v
    p(w | v) = (c(v, w) + mass * p1(w)) / (c(v) + mass),    p1(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)),
a text starts after a begin mark and ends with an end token. The logarithm splits into a part that needs only the counts of w and of what
stands before it, and a part that needs only the count of v, so everything about a word is known in one place.

1. Unigram counts of the training texts, folded per piece and task. N, V and the words that make up 1 / 4096 of all tokens or more (at most
   4096 words, a bounded broadcast) come from them.
2. Every text is dealt to shards by word, packed: per piece and shard the words, the words before them (40 bits of their hash) and the texts
   they stand in. A frequent word is spread over the shards by the word before it.
3. Each shard builds the trie of its words: level 1 holds the words and, as an Elias-Fano sequence, the pointers to their contexts in level
   2; level 2 holds the contexts, monotone by adding the word's place, as another Elias-Fano sequence, and their smoothed probabilities,
   quantised to 16 bits. Both are memory-mapped. A token is looked up by successor search among its word's contexts; one without a
   context in the trie gets the smoothed unigram probability.
4. Sums per text go back packed, a row per piece and task, as the tokens came. A piece's sums meet in one place and are added up there; a row per
   text leaves it.

The tries grow with the corpus and stay where their words are; none is sent to the driver or to another task.

Defined results: a null text is empty and has the end token alone. A null id belongs to the held-out part, like an id that the training condition
leaves out. Repeated rows count as often as they stand there and get one score each. An empty table gives an empty result; without
training tokens every token has the same base probability, one. Other columns are left out.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.llm.text import Hasher, lowered, mix, pieces, text_bytes, word_bounds
from quizlens.sinks.stage import stage

CHUNK = (2 << 20) - 64  # the hasher's tables hold a power of two of places
ADDED = 0.1  # fixed value: added to every count of the unigram model
FREQUENT = 4096
END, BEGIN = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949D7C7509E6557)
CONTEXT_BITS = 40
QUANTUM = 1 / 4096  # step of a quantised log10 probability, in 16 bits down to -16


def training_fold(doc_id: Column, folds: int = 10) -> Column:
    """Whether the model may learn from a row."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds != 0, F.lit(False))


class EliasFano:
    """A rising sequence: low bits plain, high bits in unary, with the ones counted up per 64 bits."""

    def __init__(self, values: np.ndarray, universe: int):
        m = len(values)
        self.m = m
        self.shift = max(0, (universe // max(m, 1)).bit_length() - 1)
        v = values.astype(np.uint64)
        low = v & np.uint64((1 << self.shift) - 1)
        width = (self.shift + 7) // 8
        self.low = low.view(np.uint8).reshape(m, 8)[:, :width].copy()
        high = (v >> np.uint64(self.shift)).astype(np.int64)
        self.buckets = (universe >> self.shift) + 1
        bits = np.zeros(-(-(m + self.buckets + 1) // 64) * 64, np.uint8)
        bits[high + np.arange(m)] = 1
        self.bits = np.packbits(bits)
        self.ones = np.concatenate([[0], np.cumsum(bits.reshape(-1, 64).sum(1, dtype=np.int64))])

    def arrays(self) -> list[str]:
        return ["low", "bits", "ones"]

    def lows(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), 8), np.uint8)
        out[:, : self.low.shape[1]] = self.low[at]
        return out.view(np.uint64).ravel()

    def _in_word(self, word: np.ndarray, nth: np.ndarray, bit: int) -> np.ndarray:
        """Place of the nth (from 0) one or zero in each 64-bit word."""
        b = np.unpackbits(self.bits.reshape(-1, 8)[word], axis=1)
        if not bit:
            b ^= 1
        return (np.cumsum(b, axis=1, dtype=np.uint8) > nth.astype(np.uint8)[:, None]).argmax(1)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th one."""
        word = np.searchsorted(self.ones, k, "right") - 1
        return word * 64 + self._in_word(word, k - self.ones[word], 1)

    def get(self, k: np.ndarray) -> np.ndarray:
        """Values by rank."""
        return ((self.select(k) - k).astype(np.uint64) << np.uint64(self.shift)) | self.lows(k)

    def first_of(self, bucket: np.ndarray) -> np.ndarray:
        """Rank of the first value whose high part is `bucket` or more: the ones before the bucket's start."""
        zeros = np.arange(len(self.ones)) * 64 - self.ones
        out = np.zeros(len(bucket), np.int64)
        some = bucket > 0
        k = bucket[some] - 1
        word = np.searchsorted(zeros, k, "right") - 1
        out[some] = word * 64 + self._in_word(word, k - zeros[word], 0) - k
        return out

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the first value that is not below x, and whether it is x."""
        bucket, low = (x >> np.uint64(self.shift)).astype(np.int64), x & np.uint64((1 << self.shift) - 1)
        at, end = self.first_of(bucket), self.first_of(bucket + 1)
        equal = np.zeros(len(x), bool)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            v = self.lows(at[open_])
            equal[open_] = v == low[open_]
            open_ = open_[v < low[open_]]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        return at, equal


class Trie:
    """Two levels over the words of a shard; see the module's text."""

    def __init__(self, words: np.ndarray, backoff: np.ndarray, word_of: np.ndarray, context: np.ndarray, log10p: np.ndarray):
        self.words, self.backoff = words, backoff
        self.pointers = EliasFano(np.searchsorted(word_of, np.arange(len(words) + 1)), len(word_of) + 1)
        keys = (word_of.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | context
        self.contexts = EliasFano(keys, (len(words) + 1) << CONTEXT_BITS)
        self.codes = np.clip(np.rint(-log10p / QUANTUM), 0, 65535).astype(np.uint16)

    def mapped(self, folder: str) -> Trie:
        """Writes the levels to a file in `folder` and maps them."""
        with tempfile.TemporaryFile(dir=folder) as f:
            places = []
            for owner, name in [(self, "codes"), *((x, n) for x in (self.pointers, self.contexts) for n in x.arrays())]:
                array = np.ascontiguousarray(getattr(owner, name))
                f.write(b"\0" * (-f.tell() % 8))
                places.append((owner, name, array.dtype, array.shape, f.tell()))
                f.write(array.tobytes())
            f.write(b"\0" * 8)
            f.flush()
            view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        for owner, name, dtype, shape, at in places:
            setattr(owner, name, np.frombuffer(view, dtype, int(np.prod(shape)), at).reshape(shape))
        return self

    def log10p(self, word_at: np.ndarray, context: np.ndarray, batch: int = 1 << 16) -> np.ndarray:
        """log10(c(v, w) + mass * p1(w)) by the word's place in level 1 and its context's hash."""
        out = self.backoff[word_at].copy()
        if not self.contexts.m:
            return out
        for s in range(0, len(word_at), batch):
            w, c = word_at[s : s + batch], context[s : s + batch]
            at, found = self.contexts.successor((w.astype(np.uint64) << np.uint64(CONTEXT_BITS)) | c)
            found &= (at >= self.pointers.get(w).astype(np.int64)) & (at < self.pointers.get(w + 1).astype(np.int64))
            out[s : s + batch][found] = -self.codes[at[found]].astype(float) * QUANTUM
        return out


def tokens(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each token, of the token before it, and its text's place in the batch; the end token closes each text."""
    data, rows = text_bytes(b.column("__text"))
    starts, ends = word_bounds(data, rows)
    words = Hasher(lowered(data))(starts, ends) if len(data) else np.zeros(0, np.uint64)
    first = np.searchsorted(starts, rows)
    n = np.diff(first) + 1
    text = np.repeat(np.arange(len(n)), n)
    stop = np.cumsum(n) - 1
    out = np.empty(len(text), np.uint64)
    inner = np.ones(len(text), bool)
    inner[stop] = False
    out[inner], out[stop] = words, END
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[stop - n + 1] = BEGIN
    return out, before, text


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, "__text", 2 * CHUNK):
        u, n = np.unique(tokens(b)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], ["w", "n"])


def score(docs: DataFrame, training: Column, text: str = "text", id: str = "doc_id", mass: float = 10.0) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) per document; `training` tells which rows to learn from."""
    spark = docs.sparkSession
    given = docs.select(docs[id].alias("id"), docs[text].alias("__text"), F.coalesce(training, F.lit(False)).alias("train"),
                        F.xxhash64(docs[id], docs[text]).alias("row"))
    vocabulary = stage(given.where("train").select("__text").mapInArrow(_vocabulary, "w BIGINT, n BIGINT").groupBy("w").agg(F.sum("n").alias("n")), "lm-words")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # each of these has a share of 1 / FREQUENT or more, so there are at most FREQUENT
    often = vocabulary.where(F.col("n") * FREQUENT >= max(total, 1)).orderBy("w").toPandas()
    begins = given.where("train").count()
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    shards = 4 * tasks  # a task holds one shard at a time
    known = (often["w"].to_numpy(np.int64).view(np.uint64), often["n"].to_numpy(np.int64))
    order = np.argsort(known[0])
    frequent = spark.sparkContext.broadcast((known[0][order], known[1][order]))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = frequent.value[0]
        for b in pieces(batches, "__text", CHUNK):
            for lo in range(0, b.num_rows, 1 << 14):
                yield _dealt(b.slice(lo, 1 << 14), hot, shards)

    packed = "shard INT, piece BIGINT, rows BINARY, word BINARY, pairs BINARY, low BINARY, high BINARY, texts BINARY, text BINARY, times BINARY"
    dealt = given.select("__text", "train", "row").mapInArrow(deal, packed).repartition(tasks, "shard").sortWithinPartitions("shard")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, sums = None, [], []
        for b in batches:
            for r in range(b.num_rows):
                values = [b.column(c)[r].as_py() for c in range(b.num_columns)]
                if values[0] != shard and held:
                    sums.append(_solved(held, frequent.value, total, distinct, mass))
                    if sum(len(x[0]) for x in sums) > TEXTS:
                        yield _packed(_added(sums))
                shard = values[0]
                held.append(values[1:])
        if held:
            sums.append(_solved(held, frequent.value, total, distinct, mass))
        if sums:
            yield _packed(_added(sums))

    # pieces are only a place to meet: sums per row are added once more, so it does not matter which piece a row was in
    back = dealt.mapInArrow(solve, "piece BIGINT, row BINARY, n BINARY, known BINARY, base BINARY, score BINARY")
    back = back.repartition(2 * tasks, "piece").sortWithinPartitions("piece")
    summed = back.mapInArrow(_gathered, "row BIGINT, n BIGINT, known BIGINT, base DOUBLE, score DOUBLE")
    sums = summed.groupBy("row").agg(*[F.sum(c).alias(c) for c in ("n", "known", "base", "score")])
    # a row that stands several times has been added up as often
    copies = given.select("id", "row")
    times = copies.groupBy("row").agg(F.count(F.lit(1)).alias("copies"))
    start = float(np.log10(begins + mass))
    out = copies.join(sums.join(times, "row"), "row")
    whole = lambda c: F.round(F.col(c) / F.col("copies")).cast("bigint")
    return out.select(F.col("id").alias(id), whole("n").alias("n_tokens"), whole("known").alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
                      (F.col("base") / F.col("copies")).alias("base_score"), (F.col("score") / F.col("copies") - F.lit(start)).alias("score"))


def _dealt(b: pa.RecordBatch, hot: np.ndarray, shards: int) -> pa.RecordBatch:
    """The tokens of a piece by shard: words, per word its contexts, per context the texts and how often."""
    word, before, text = tokens(b)
    rows = b.column("row").to_numpy()
    piece = int(mix(rows.astype(np.uint64)).sum().view(np.int64))
    train = b.column("train").to_numpy(zero_copy_only=False).astype(np.uint16)
    context = before & np.uint64((1 << CONTEXT_BITS) - 1)
    at = np.minimum(np.searchsorted(hot, word), max(len(hot) - 1, 0))
    spread = (hot[at] == word) if len(hot) else np.zeros(len(word), bool)
    shard = (np.where(spread, word ^ (context * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)), word) % np.uint64(shards)).astype(np.int64)
    o = np.lexsort((text, context, word, shard))
    word, context, text, shard = word[o], context[o], text[o], shard[o]
    differ = lambda x: np.concatenate([[True], x[1:] != x[:-1]])
    new_shard = differ(shard)
    new_word = new_shard | differ(word)
    new_pair = new_word | differ(context)
    entry = np.flatnonzero(new_pair | differ(text))
    times = np.diff(np.append(entry, len(word))).astype(np.uint32)
    code = (text[entry].astype(np.uint16) << np.uint16(1)) | train[text[entry]]
    pair, first = np.flatnonzero(new_pair), np.flatnonzero(new_word)
    texts = np.diff(np.append(np.searchsorted(entry, pair), len(entry))).astype(np.uint16)
    pairs = np.diff(np.append(np.searchsorted(pair, first), len(pair))).astype(np.uint32)
    low, high = (context[pair] & np.uint64(0xFFFFFFFF)).astype(np.uint32), (context[pair] >> np.uint64(32)).astype(np.uint8)
    cuts = np.append(np.flatnonzero(new_shard), len(word))
    out = [[] for _ in range(10)]
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        w, p, t = (slice(*np.searchsorted(x, (s, e))) for x in (first, pair, entry))
        used = np.unique(code[t] >> np.uint16(1))  # the texts that have a token here
        local = (np.searchsorted(used, code[t] >> np.uint16(1)).astype(np.uint16) << np.uint16(1)) | (code[t] & np.uint16(1))
        for x, v in zip(out, (int(shard[s]), piece, rows[used], word[first[w]], pairs[w], low[p], high[p], texts[p], local, times[t]), strict=True):
            x.append(v if isinstance(v, int) else v.tobytes())
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), *(pa.array(x, pa.binary()) for x in out[2:])],
                                      ["shard", "piece", "rows", "word", "pairs", "low", "high", "texts", "text", "times"])


def _added(sums: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """One entry per piece and text, in this order, of (piece, row, n, known, base, score); empties the list."""
    columns = [np.concatenate([x[k] for x in sums]) for k in range(6)]
    sums.clear()
    o = np.lexsort((columns[1], columns[0]))
    piece, row = columns[0][o], columns[1][o]
    at = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (row[1:] != row[:-1])]))
    return piece[at], row[at], *(np.add.reduceat(c[o], at) for c in columns[2:])


def _packed(sums: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    piece, *columns = sums
    cuts = np.append(np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]])), len(piece))
    out = [[np.ascontiguousarray(c[s:e], kind).tobytes() for s, e in zip(cuts[:-1], cuts[1:], strict=True)] for c, kind in zip(columns, SUMS, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(piece[cuts[:-1]]), *(pa.array(x, pa.binary()) for x in out)], ["piece", "row", "n", "known", "base", "score"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text of packed sums; batches come sorted by piece, one piece is held at a time."""
    def texts(sums):
        _, row, n, known, base, score = _added(sums)
        return pa.RecordBatch.from_arrays([pa.array(row), *(pa.array(c.astype(np.int64)) for c in (n, known)), pa.array(base), pa.array(score)], ["row", "n", "known", "base", "score"])

    last, held = None, []
    for b in batches:
        for piece, *packed in zip(*(b.column(c).to_pylist() for c in range(b.num_columns)), strict=True):
            if piece != last and held:
                yield texts(held)
            last = piece
            columns = [np.frombuffer(x, kind) for x, kind in zip(packed, SUMS, strict=True)]
            held.append((np.full(len(columns[0]), piece), *columns))
    if held:
        yield texts(held)


def _solved(held: list[list[bytes]], frequent, total: int, distinct: int, mass: float) -> tuple[np.ndarray, ...]:
    """Builds a shard's trie and scores its tokens: pieces, texts, and their sums of tokens, known tokens, base and score. Empties `held`."""
    kinds = (np.int64, np.uint64, np.uint32, np.uint32, np.uint8, np.uint16, np.uint16, np.uint32)
    count_of = [len(h[1]) // 8 for h in held]
    piece = np.repeat([h[0] for h in held], count_of)
    first_text = np.concatenate([[0], np.cumsum(count_of)])[:-1].astype(np.int32)
    entries = [len(h[7]) // 2 for h in held]
    rows, word, pairs, low, high, texts, text, times = (np.frombuffer(b"".join(h[k] for h in held), kind) for k, kind in enumerate(kinds, 1))
    held.clear()
    code = (text >> np.uint16(1)).astype(np.int32) + np.repeat(first_text, entries)
    starts = np.concatenate([[0], np.cumsum(texts, dtype=np.int64)])[:-1]
    learnt = np.add.reduceat(np.where(text & np.uint16(1), times, np.uint32(0)), starts, dtype=np.int64)
    del text, starts
    words, place = np.unique(word, return_inverse=True)
    mask = np.uint64((1 << CONTEXT_BITS) - 1)
    key = (np.repeat(place, pairs).astype(np.uint64) << np.uint64(CONTEXT_BITS)) | low | (high.astype(np.uint64) << np.uint64(32))
    del low, high, word, place
    unique, pair_of = np.unique(key, return_inverse=True)
    pair_of = pair_of.astype(np.int32)
    del key
    count = np.bincount(pair_of, learnt, len(unique)).astype(np.int64)
    owner = (unique >> np.uint64(CONTEXT_BITS)).astype(np.int64)
    of_word = np.bincount(owner, count, len(words)).astype(np.int64)
    hot, how_often = frequent
    if len(hot):  # their occurrences are spread over shards
        at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        of_word = np.where(hot[at] == words, how_often[at], of_word)
    unigram = np.log10((of_word + ADDED) / (total + ADDED * (distinct + 1)))
    in_trie = count > 0
    prior = mass * 10.0**unigram
    trie = Trie(words, np.log10(prior), owner[in_trie], unique[in_trie] & mask, np.log10(count[in_trie] + prior[owner[in_trie]]) - SCALE)
    del count
    with tempfile.TemporaryDirectory() as folder:
        value = trie.mapped(folder).log10p(owner, unique & mask)
    del unique
    value[in_trie] += SCALE
    value += np.where(words == END, 0.0, -np.log10(of_word + mass))[owner]  # what the word adds as the context of the next token
    entry = np.repeat(pair_of, texts)
    add = lambda per_pair: np.bincount(code, per_pair[entry] * times, len(rows))
    return piece, rows, add(np.ones(len(owner))), add((of_word > 0).astype(float)[owner]), add(unigram[owner]), add(value)


TEXTS = 1 << 20  # sums of so many texts are held before they leave a task
SUMS = (np.int64, np.uint32, np.uint32, np.float64, np.float64)  # packed sums: row, n, known, base, score
SCALE = 12.0  # log10 of counts is shifted by this to be negative before it is quantised
