"""N-gram Jaccard join: all pairs of documents whose shingle sets have a Jaccard similarity of 0.75 or more, as components.

The join is a sparse product of the document by n-gram incidence with its transpose, done in blocks of n-grams and cut by bounds that
follow from the sizes. For sets of n and m elements a link needs an overlap of at least 3 (n + m) / 7, and 3/4 of the larger set.

1. Sets with equal elements are one class; all later steps work on classes. The whole incidence is dealt to blocks by n-gram, packed, four
   bytes an entry; a block tells per class how many of its n-grams other classes have too. A class with fewer than three quarters of them can have no
   link and is done; that is nearly all of an ordinary corpus. The texts of the others are fetched once.
2. Among these the documents of each n-gram are counted. The most frequent n-grams (`max_frequent`, a bounded broadcast) come last in the order of
   n-grams, by frequency; the others come first, by hash. Any order gives the same result, this one gives few candidates. Of each class the first
   n - ceil(3n/4) + 1 n-grams in that order are kept: two linked classes have one of them in common. The columns of these n-grams that have
   up to `short` documents are multiplied: overlaps are added up per pair, and leaves out pairs of which the positions show that the
   overlap cannot be reached. Longer columns are not multiplied out: each document is paired with the column's smallest only.
3. Pairs are cut by a second bound, the number of bits in which the sets' parity bitmaps differ (at most the size of the symmetric difference).
4. In each of a few rounds every component (at first, every class) verifies its pair with the largest partial overlap to another one on whole texts,
   and links join components; long columns offer one pair between each of their components and their largest one, another one each round. The rounds end
   early when the last step has few pairs to look at, or a round left it more than half of them. What is left are pairs
   between different components; those of long columns are made now, between the documents outside a column's largest component and
   all others. Places, sizes and signatures (bitmaps folded to 1024 bits) cut them inside the join; the rest is verified. No link between different texts is lost, and a group of copies is never
   multiplied out.

Classes are named by a 64-bit hash of their sets, n-grams by 64-bit hashes. Links are decided on overlaps counted exactly over these.

Defined results: null texts and texts without words have an empty set, are linked with nothing, and are their own component. A text of
fewer than five words has one element, its whole word sequence. Rows with one id but different texts are judged each for itself; repeated rows
share a class. The component of rows with a null id is the smallest id of their class's component, null if there is none. An empty table gives
an empty result. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.llm.components import components
from quizlens.llm.shingles import shingle_sets
from quizlens.llm.text import mix, pieces, text_bytes
from quizlens.sinks.stage import stage

CHUNK = 1 << 20
ENTRIES = 1 << 20  # entries of a block, and pairs held before they are added up
CLASSES = 1 << 18  # classes of a shard
PAIRS_EACH = 32  # pairs for each entry of a long column that the last step may look at without another round
SIGNS = [f"s{k}" for k in range(16)]  # columns of a signature


def class_of(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash per set; 0 for the empty set."""
    n = np.diff(bounds)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ np.uint64(0x51AFD7ED558CCD6D)))])
    out = mix((sums[bounds[1:]] - sums[bounds[:-1]]) + n.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    out[n == 0] = 0
    return out.view(np.int64)


def parity_bitmap(values: np.ndarray) -> bytes:
    """One bit per place: whether an odd number of elements falls there; four to eight bits an element, so that few meet."""
    bits = 64 * len(SIGNS) << max(0, int(len(values) - 1).bit_length() - 8)
    odd = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def signature(bitmap: bytes) -> np.ndarray:
    """A parity bitmap folded to 1024 bits, as integers; the bits in which two of them differ bound the difference of the sets too."""
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, np.int64).reshape(-1, len(SIGNS)), axis=0)


def differing_bits(a: bytes, b: bytes) -> int:
    """A lower bound of the size of the symmetric difference."""
    x, y = (np.unpackbits(np.frombuffer(v, np.uint8)) for v in (a, b))
    while len(x) != len(y):  # the longer one is folded: bit i and bit i + half fall on one place
        if len(x) < len(y):
            x, y = y, x
        half = len(x) // 2
        x = x[:half] ^ x[half:]
    return int((x ^ y).sum())


def _sets(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw, rows = text_bytes(b.column("__text"))
    return shingle_sets(raw, rows)


def _document_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, "__text", CHUNK):
        values, bounds = _sets(b)
        yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__key"), pa.array(class_of(values, bounds)), pa.array(np.diff(bounds))], ["id", "key", "cls", "n"])


def _ngram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches, "__text", CHUNK):
        u, n = np.unique(_sets(b)[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], ["g", "n"])


def _shared_entries(shards: int):
    """Per block and shard of classes one packed row: the classes that share entries of the block, and how many.

    Batches come sorted by block, one block is held at a time. Entries are compared by 32 bits of their hash beside the block's number; a chance match
    can only keep a class that a later step drops.
    """
    def solve(held):
        cls = np.concatenate([np.frombuffer(c, np.int64) for c, _, _ in held])
        k = np.concatenate([np.frombuffer(x, np.uint32) for _, x, _ in held])
        h = np.concatenate([np.frombuffer(x, np.uint32) for _, _, x in held])
        names, cls = np.unique(cls, return_inverse=True)
        entry = np.unique((h.astype(np.uint64) << np.uint64(32)) | np.repeat(cls, k).astype(np.uint64))  # a class counts once, whatever its number of copies
        h = entry >> np.uint64(32)
        twice = np.zeros(len(h), bool)
        twice[1:] = h[1:] == h[:-1]
        twice[:-1] |= twice[1:]
        n = np.bincount((entry[twice] & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=len(names))
        at = np.flatnonzero(n)
        shard = (names[at].view(np.uint64) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        at, cuts = at[order], np.searchsorted(shard[order], np.arange(shards + 1))
        here = np.flatnonzero(np.diff(cuts))
        packed = [[x[at[cuts[s] : cuts[s + 1]]].tobytes() for s in here] for x in (names, n.astype(np.int64))]
        return pa.RecordBatch.from_arrays([pa.array(here, pa.int64()), *(pa.array(x, pa.binary()) for x in packed)], ["shard", "cls", "shared"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for b in batches:
            for k, *row in zip(*(b.column(c).to_pylist() for c in ("block", "cls", "k", "h")), strict=True):
                if k != block and held:
                    yield solve(held)
                    held = []
                block = k
                held.append(row)
        if held:
            yield solve(held)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums packed rows (shard, cls, shared) per class; rows come sorted by shard, one shard's classes are held at a time."""
    shard, cls, shared, new = None, np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def fold():
        c = np.concatenate([cls, *(x for x, _ in new)])
        n = np.concatenate([shared, *(x for _, x in new)])
        names, at = np.unique(c, return_inverse=True)
        out = np.zeros(len(names), np.int64)
        np.add.at(out, at, n)
        return names, out

    for b in batches:
        for s, c, n in zip(*(b.column(k).to_pylist() for k in ("shard", "cls", "shared")), strict=True):
            if s != shard:
                if shard is not None:
                    cls, shared = fold()
                    yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(shared)], ["cls", "shared"])
                shard, cls, shared, new = s, np.zeros(0, np.int64), np.zeros(0, np.int64), []
            new.append((np.frombuffer(c, np.int64), np.frombuffer(n, np.int64)))
            if sum(len(x) for x, _ in new) > CLASSES:
                cls, shared = fold()
                new = []
    if shard is not None:
        cls, shared = fold()
        yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(shared)], ["cls", "shared"])


def _overlap_bound(n, m):
    """Least overlap of linked sets of n and m elements."""
    return -(-3 * (n + m) // 7)


def block_pairs(g: np.ndarray, cls: np.ndarray, n: np.ndarray, place: np.ndarray, short: int):
    """Product of a block of n-gram columns: (a, b, overlap in the block) for columns of up to `short` documents, and the entries of longer ones."""
    o = np.lexsort((cls, g))
    g, cls, n, place = g[o], cls[o], n[o], place[o]
    fresh = np.ones(len(g), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (cls[1:] != cls[:-1])  # a class counts once however many documents it has
    g, cls, n, place = g[fresh], cls[fresh], n[fresh], place[fresh]
    start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(g)))
    long = np.repeat(size > short, size)
    rest = (g[long], cls[long], n[long], place[long])
    single = np.repeat(size == 1, size)
    keep = ~long & ~single
    g, cls, n, place = g[keep], cls[keep], n[keep], place[keep]
    found = []
    for k in range(1, short):
        at = np.flatnonzero(g[k:] == g[:-k]) if len(g) > k else np.zeros(0, np.int64)
        if not len(at):
            break
        to = at + k
        possible = np.minimum(n[at] - place[at], n[to] - place[to]) >= _overlap_bound(n[at], n[to])
        found.append(np.stack([cls[at[possible]], cls[to[possible]]]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), rest
    a, b = np.concatenate(found, axis=1)
    o = np.lexsort((b, a))
    a, b = a[o], b[o]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
    return a[new], b[new], np.diff(np.append(new, len(a))), rest


def _multiply(short: int):
    """Products of columns that come sorted by n-gram: pairs with their overlaps (n-gram 0), and the entries of long columns as they are.

    A column is held up to `short` entries; pairs are added up in pieces of ENTRIES.
    """
    names = ("g", "cls", "n", "place")

    def rows(*columns):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["g", "a", "b", "c"])

    def folded(found):
        a, b, c = (np.concatenate(x) for x in zip(*found, strict=True))
        o = np.lexsort((b, a))
        a, b, c = a[o], b[o], c[o]
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        return rows(np.zeros(len(new), np.int64), a[new], b[new], np.add.reduceat(c, new))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = [np.zeros(0, np.int64)] * 4
        carry, long, found, held = none, None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.concatenate([x, batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)]) for x, c in zip(carry, names, strict=True)]
            more = 0 if long is None else int(np.searchsorted(columns[0], long, "right"))  # a long column goes on
            if more:
                yield rows(*(x[:more] for x in columns))
                columns = [x[more:] for x in columns]
            if not len(columns[0]):
                carry = none
                continue
            last = int(np.searchsorted(columns[0], columns[0][-1], "left"))
            carry, columns, long = [x[last:] for x in columns], [x[:last] for x in columns], None
            if len(carry[0]) > short and len(np.unique(carry[1])) > short:
                long = carry[0][-1]
                yield rows(*carry)
                carry = none
            a, b, overlap, rest = block_pairs(*columns, short)
            if len(rest[0]):
                yield rows(*rest)
            if len(a):
                found.append((a, b, overlap))
                held += len(a)
            if held > ENTRIES:
                yield folded(found)
                found, held = [], 0
        a, b, overlap, rest = block_pairs(*carry, short)
        if len(rest[0]):
            yield rows(*rest)
        if len(a):
            found.append((a, b, overlap))
        if found:
            yield folded(found)

    return run


def join(docs: DataFrame, text: str = "text", id: str = "doc_id", max_frequent: int = 1 << 17, short: int = 4, rounds: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_key) per document; text_key is a hash of the text, which tells rows of one id apart."""
    spark = docs.sparkSession
    given = docs.select(docs[id].cast("bigint").alias("__id"), docs[text].alias("__text"), F.xxhash64(docs[text]).alias("__key"))

    # 1. one row per document, and the classes that share enough of their n-grams with others
    rows = stage(given.mapInArrow(_document_rows, "id BIGINT, key BIGINT, cls BIGINT, n BIGINT"), "ngram-documents")
    by_class = rows.where("n > 0").groupBy("cls").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("rep"), F.first("n").alias("n"))
    size = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    blocks, shards = -(-size[0] // ENTRIES) or 1, -(-size[1] // CLASSES) or 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "__text", CHUNK):
            values, bounds = _sets(b)
            n, cls = np.diff(bounds), class_of(values, bounds)
            owner = np.repeat(np.arange(len(n)), n)
            block = (values % np.uint64(blocks)).astype(np.int64)
            order = np.lexsort((owner, block))
            cuts = np.searchsorted(block[order], np.arange(blocks + 1))
            high = (values[order] >> np.uint64(32)).astype(np.uint32)
            who = owner[order]
            packed = [], [], [], []
            for k in np.flatnonzero(np.diff(cuts)):
                here = who[cuts[k] : cuts[k + 1]]
                at = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
                for out, x in zip(packed, (k, cls[here[at]].tobytes(), np.diff(np.append(at, len(here))).astype(np.uint32).tobytes(), high[cuts[k] : cuts[k + 1]].tobytes()), strict=True):
                    out.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(packed[0], pa.int64()), *(pa.array(x, pa.binary()) for x in packed[1:])], ["block", "cls", "k", "h"])

    dealt = given.select("__text").mapInArrow(deal, "block BIGINT, cls BINARY, k BINARY, h BINARY").repartition("block").sortWithinPartitions("block")
    packed = dealt.mapInArrow(_shared_entries(shards), "shard BIGINT, cls BINARY, shared BINARY")
    shared_count = packed.repartition("shard").sortWithinPartitions("shard").mapInArrow(_summed, "cls BIGINT, shared BIGINT")
    live = by_class.join(shared_count, "cls").where("4 * shared >= 3 * n").select("cls", "n", "rep.id", "rep.key").hint("shuffle_hash")
    fetched = given.join(live, given["__id"].eqNullSafe(live["id"]) & (given["__key"] == live["key"])).select("cls", F.col("__text").alias("text"))
    texts = stage(fetched.dropDuplicates(["cls"]), "ngram-texts")

    # 2. documents per n-gram among these, folded per piece, per task and then over all
    counts = stage(texts.select(F.col("text").alias("__text")).mapInArrow(_ngram_counts, "g BIGINT, n BIGINT").groupBy("g").agg(F.sum("n").alias("n")).where("n > 8"), "ngram-counts")
    total, least = counts.count(), 9
    while total > max_frequent:  # raise the frequency until the list fits its bound
        least *= 2
        total = counts.where(F.col("n") >= least).count()
    frequent = counts.where(F.col("n") >= least).orderBy("g").toArrow()
    shared = spark.sparkContext.broadcast(tuple(frequent[c].to_numpy() for c in ("g", "n")))
    del frequent

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, how_often = shared.value
        for b in pieces(batches, "__text", CHUNK):
            values, bounds = _sets(b)
            n = np.diff(bounds)
            signed = values.view(np.int64)
            where = np.minimum(np.searchsorted(known, signed), max(len(known) - 1, 0))
            often = np.where(known[where] == signed, how_often[where], 0) if len(known) else np.zeros(len(signed), np.int64)
            owner = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((signed, often, owner))
            place = np.arange(len(order)) - bounds[owner]
            inside = place < (n - -(-3 * n // 4) + 1)[owner]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[inside], minlength=len(n)))]).astype(np.int32)), pa.array(signed[order][inside]))
            maps = [parity_bitmap(values[bounds[i] : bounds[i + 1]]) for i in range(len(n))]
            signs = np.array([signature(m) for m in maps], np.int64).reshape(-1, len(SIGNS))
            yield pa.RecordBatch.from_arrays([b.column("cls"), pa.array(n), pa.array(maps, pa.binary()), lists, *(pa.array(x) for x in signs.T.copy())], ["cls", "n", "bitmap", "g", *SIGNS])

    members = stage(texts.select("cls", F.col("text").alias("__text")).mapInArrow(first, "cls BIGINT, n BIGINT, bitmap BINARY, g ARRAY<BIGINT>, " + ", ".join(f"{x} BIGINT" for x in SIGNS)), "ngram-first")
    maps = members.select("cls", "n", "bitmap")
    entries = members.select("cls", "n", F.posexplode("g").alias("place", "g"))

    product = stage(entries.repartition("g").sortWithinPartitions("g").mapInArrow(_multiply(short), "g BIGINT, a BIGINT, b BIGINT, c BIGINT"), "ngram-product")
    shared.unpersist()
    pairs = product.where("g = 0").groupBy("a", "b").agg(F.sum("c").alias("c"))
    long = product.where("g <> 0").select("g", F.col("a").alias("cls"), F.col("b").alias("n"), F.col("c").alias("place"))
    hubs = long.groupBy("g").agg(F.min("cls").alias("hub"))
    stars = long.join(hubs, "g").where("cls <> hub").groupBy(F.col("hub").alias("a"), F.col("cls").alias("b")).agg(F.count(F.lit(1)).alias("c"))

    # 3. and 4. in each round every component verifies its strongest pair to another one; then all that still lies between components
    near = stage(_near(pairs.unionByName(stars), maps), "ngram-pairs")
    done = near.select("a", "b").limit(0)
    roots = near.select(F.col("a").alias("id"), F.col("b").alias("root")).limit(0)
    open_columns = stage(_open_columns(long, roots), "ngram-open")
    ahead = None  # pairs of long columns that the last step has to look at
    for turn in range(rounds):
        crossing = _apart(near.unionByName(_near(_list_pairs(open_columns, turn), maps)).join(done, ["a", "b"], "left_anti"), roots)
        ends = crossing.select(F.explode(F.array("ra", "rb")).alias("root"), "c", "a", "b")
        best = stage(ends.groupBy("root").agg(F.max(F.struct("c", "a", "b")).alias("m")).select("m.a", "m.b").distinct(), "ngram-best")
        if best.isEmpty():  # every pair has been decided
            break
        done = stage(done.unionByName(best), "ngram-done")
        # a component's ids hang on its root, so the links of earlier rounds are not needed again
        roots = components(_hung(roots).unionByName(stage(_verified(best, texts), "ngram-links")))
        open_columns = stage(_open_columns(long, roots), "ngram-open")
        held, before = open_columns.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("root") != F.col("most"), F.col("size"))), F.lit(0))).first(), ahead
        ahead = held[1]
        if ahead <= PAIRS_EACH * held[0] or (before is not None and 2 * ahead > before):
            break

    # a pair leaves the join only if its places in the column, its sizes and its signatures allow a link
    signed = stage(open_columns.join(members.select("cls", *SIGNS), "cls"), "ngram-open")
    x, y = signed.where("root <> most").alias("x"), signed.alias("y")
    differ = " + ".join(f"bit_count(x.{s} ^ y.{s})" for s in SIGNS)
    across = x.join(y, F.col("x.g") == F.col("y.g")).where(
        "x.root <> y.root AND (y.root = y.most OR x.cls < y.cls) AND 4 * least(x.n, y.n) >= 3 * greatest(x.n, y.n)"
        " AND 7 * least(x.n - x.place, y.n - y.place) >= 3 * (x.n + y.n)"
        f" AND 7 * ({differ}) <= x.n + y.n")
    late = across.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b"), F.lit(1).cast("bigint").alias("c")).distinct()
    left = _apart(near, roots).select("a", "b").unionByName(_near(late, maps).select("a", "b")).distinct()
    more = stage(_verified(left.join(done, ["a", "b"], "left_anti"), texts), "ngram-links")
    roots = components(_hung(roots).unionByName(more))

    named = _with_root(rows.where("n > 0").groupBy("cls").agg(F.min("id").alias("least")), "cls", roots, "root")
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    of_class = named.join(smallest, "root").select("cls", "component")
    out = rows.join(of_class, "cls", "left")
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component_id"), F.col("key").alias("text_key"))


def one_of_each(docs: DataFrame, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """docs with one document of each component, the one with the smallest id (of several texts with that id, one of them).

    Documents without words, and those with a null id, are in no group and stay.
    """
    found = join(docs, text, id, **options)
    free = (F.col("n_shingles") == 0) | F.col(id).isNull()
    first = found.where(~free).groupBy("component_id").agg(F.min(F.struct(id, "text_key")).alias("r")).select(F.col("r." + id).alias("__id"), F.col("r.text_key").alias("__key"), F.lit(False).alias("__free"))
    keep = first.unionByName(found.where(free).select(F.col(id).alias("__id"), F.col("text_key").alias("__key"), F.lit(True).alias("__free")).distinct())
    kept = docs.join(keep.hint("shuffle_hash"), docs[id].eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text]) == F.col("__key")))
    # a repeated row is a copy too; rows that are free are told apart
    kept = kept.withColumn("__row", F.when(F.col("__free"), F.monotonically_increasing_id()).otherwise(-1))
    return kept.dropDuplicates(["__id", "__key", "__row"]).select(*docs.columns)


def _near(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """The pairs whose sizes and bitmaps allow a link."""
    left = maps.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("ma"))
    right = maps.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("mb"))
    both = pairs.join(left, "a").join(right, "b").where("4 * least(na, nb) >= 3 * greatest(na, nb)")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            na, nb = b.column("na").to_numpy(), b.column("nb").to_numpy()
            far = np.array([differing_bits(x, y) for x, y in zip(b.column("ma").to_pylist(), b.column("mb").to_pylist(), strict=True)], np.int64)
            keep = far <= na + nb - 2 * _overlap_bound(na, nb)
            yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(keep)) for c in ("a", "b", "c")], ["a", "b", "c"])

    return both.mapInArrow(check, "a BIGINT, b BIGINT, c BIGINT")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces([whole], "ta", CHUNK):
                sets = []
                for c in ("ta", "tb"):
                    values, bounds = shingle_sets(*text_bytes(b.column(c)))
                    sets.append([values[bounds[i] : bounds[i + 1]] for i in range(b.num_rows)])
                keep = []
                for x, y in zip(*sets, strict=True):
                    o = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(o > 0 and 100 * o >= 75 * (len(x) + len(y) - o))
                yield pa.RecordBatch.from_arrays([b.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    return both.select("a", "b", "ta", "tb").mapInArrow(check, "a BIGINT, b BIGINT")


def _hung(roots: DataFrame) -> DataFrame:
    """The components as links of each id to its root."""
    return roots.select(F.col("id").alias("a"), F.col("root").alias("b"))


def _open_columns(long: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries of the long columns that hold several components, with their component, the column's largest one and the column's size."""
    entries = _with_root(long, "cls", roots, "root")
    parts = entries.groupBy("g", "root").count()
    columns = parts.groupBy("g").agg(F.max(F.struct("count", "root")).alias("m"), F.sum("count").alias("size"), F.count(F.lit(1)).alias("parts"))
    return entries.join(columns.where("parts > 1").select("g", F.col("m.root").alias("most"), "size"), "g")


def _list_pairs(open_columns: DataFrame, turn: int) -> DataFrame:
    """One document of each component of a column with one of its largest component; others each turn."""
    first = open_columns.groupBy("g", "root", "most").agg(F.min(F.struct(F.xxhash64("cls", F.lit(turn)).alias("h"), "cls")).alias("m")).select("g", "root", "most", F.col("m.cls").alias("cls"))
    hub = first.where("root = most").select("g", F.col("cls").alias("hub"))
    both = first.where("root <> most").join(hub, "g")
    return both.groupBy(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).agg(F.count(F.lit(1)).alias("c"))


def _with_root(df: DataFrame, key: str, roots: DataFrame, name: str) -> DataFrame:
    found = df.join(roots.select(F.col("id").alias(key), F.col("root").alias("__root")), key, "left")
    return found.withColumn(name, F.coalesce("__root", key)).drop("__root")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    return _with_root(_with_root(pairs, "a", roots, "ra"), "b", roots, "rb").where("ra <> rb")
