"""Source divergence audit: how the word shares of the sources of a language differ, pair by pair and term by term, in exact integers.

1. Duplicate-text collapse: identical texts of a language become one row with the number of rows per source, first within each task's pieces of
   the table, then over all. A text is cut into terms once, however many copies it has; its counts and document frequencies are added
   with the multiplicities as weights.
2. A language keeps the terms that stand in at least `min_docs` of its rows. The counts of a kept term are one packed row (source, count).
3. Pairs are evaluated sparsely. A term's share in a source depends on its count alone, so all terms that only one source of a pair has are summed from a
   histogram of shares per source, and terms that neither has by one product; the packed rows add, for the terms that both have, what these
   sums are off by. All four parts are integers, the total is the plain sum over all kept terms.

Shares: p = 1 + floor(SCALE * (count + 1) / (N + V)), with N the source's occurrences of kept terms and V the kept terms of the language; divergence of
p from q: floor((p - q)^2 / q).

Defined results: null texts, languages and sources are empty strings. Every source that occurs is reported, also without terms; a language without kept terms
gives pairs of value 0. A repeated row counts as often as it stands there. An empty table gives an empty result. Other columns are left out. Values that
exceed 64 bits raise an error. Texts are held one at a time beside a table of at most `HELD` counts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quizlens.llm.text import pieces
from quizlens.sinks.stage import stage

SCALE = 1_000_000_000
CHUNK = 8 << 20
HELD = 400_000
PAIRS = 1 << 20
SALTS = 16
# bytes of terms: A-Z become a-z, other letters of ASCII and all bytes of longer sequences stay, everything else separates
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SOURCES = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per language and text of each piece, with the rows per source."""
    for b in pieces(batches, "text", CHUNK):
        found: dict[tuple[str, bytes], tuple[int, Counter]] = {}
        texts = b.column("text").cast(pa.binary())
        for i, (lang, source) in enumerate(zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), strict=True)):
            digest = hashlib.blake2b(texts[i].as_buffer(), digest_size=16).digest()
            found.setdefault((lang, digest), (i, Counter()))[1][source] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.binary()), b.column("text").take(pa.array([i for i, _ in found.values()], pa.int64())),
             pa.array([[{"source": s, "n": n} for s, n in c.items()] for _, c in found.values()], _SOURCES)], ["lang", "digest", "text", "sources"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and document frequencies per language, source and term; rows come sorted by text, copies one after the other.

    The empty term marks that a source occurs.
    """
    tables: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def add(lang: str, text: bytes, sources: Counter) -> None:
        words = terms(text)
        once = set(words)
        weighted = None
        for source, n in sources.items():
            count, docs = tables.setdefault((lang, source), (Counter(), Counter()))
            if n == 1:
                count.update(words)
                docs.update(once)
            else:
                weighted = weighted or Counter(words)
                for w, c in weighted.items():
                    count[w] += n * c
                    docs[w] += n

    def flush() -> pa.RecordBatch:
        out = [], [], [], [], []
        for (lang, source), (count, docs) in tables.items():
            size = len(count) + 1
            for column, values in zip(out, ([lang] * size, [source] * size, [b"", *count], [0, *count.values()], [0, *(docs[w] for w in count)]), strict=True):
                column.extend(values)
        tables.clear()
        lang, source, term, n, df = out
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(df, pa.int64())],
                                          ["lang", "source", "term", "n", "df"])

    key, text, sources = None, b"", Counter()
    for b in batches:
        texts = b.column("text").cast(pa.binary())
        for i, (lang, digest, some) in enumerate(zip(b.column("lang").to_pylist(), b.column("digest").to_pylist(), b.column("sources").to_pylist(), strict=True)):
            if (lang, digest) != key:
                if key is not None:
                    add(key[0], text, sources)
                    if sum(len(c) for c, _ in tables.values()) > HELD:
                        yield flush()
                key, text, sources = (lang, digest), texts[i].as_py(), Counter()
            for s in some:
                sources[s["source"]] += s["n"]
    if key is not None:
        add(key[0], text, sources)
        yield flush()


def share(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + 1) / total), in 64 bits where they hold it."""
    large = f"1 + (cast({SCALE} AS DECIMAL(10, 0)) * cast({count} + 1 AS DECIMAL(20, 0))) div cast({total} AS DECIMAL(20, 0))"
    return F.expr(f"CASE WHEN {total} = 0 THEN NULL WHEN {count} < {2**63 // SCALE - 1} THEN 1 + ({SCALE} * ({count} + 1)) div {total} ELSE {large} END")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of sources that share terms of a batch: what the shared terms add to the sums over terms of one source alone."""
    f = lambda p, q: (p - q) * (p - q) // q
    for b in batches:
        if not b.num_rows:
            continue
        lists = b.column("sources")
        entry = lists.flatten()
        size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(size)])
        p, p0 = (entry.field(k).to_numpy(zero_copy_only=False) for k in ("p", "p0"))
        source, lang = entry.field("source").dictionary_encode(), b.column("lang").dictionary_encode()
        names = len(source.dictionary)
        of_term = np.repeat(np.arange(len(size)), size)
        group = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[of_term] * names + source.indices.to_numpy(zero_copy_only=False)
        groups, local = np.unique(group, return_inverse=True)
        partners = size[of_term]
        ends = np.cumsum(partners)
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = 0
        while at < len(p):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
            n = partners[at:to]
            left = np.repeat(np.arange(at, to), n)
            right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + begin[of_term[left]]
            other = left != right
            left, right = left[other], right[other]
            value = f(p[left], p[right]) - f(p[left], p0[right]) - f(p0[left], p[right]) + f(p0[left], p0[right])
            keys = np.concatenate([keys, local[left] * len(groups) + local[right]])
            sums = np.concatenate([sums, value])
            order = np.argsort(keys, kind="stable")
            keys, sums = keys[order], sums[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            keys, sums = keys[first], np.add.reduceat(sums, first) if len(first) else sums
            at = to
        one, two = groups[keys // len(groups)], groups[keys % len(groups)]
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(one // names)), source.dictionary.take(pa.array(one % names)), source.dictionary.take(pa.array(two % names)), pa.array(sums)], ["lang", "source", "item", "value"])


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 3, most_terms: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` has each other source of the language, part `term` the terms that the source overuses."""
    given = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    collapsed = given.mapInArrow(_collapse, "lang STRING, digest BINARY, text STRING, sources ARRAY<STRUCT<source: STRING, n: BIGINT>>")
    sorted_texts = collapsed.repartition("lang", "digest").sortWithinPartitions("lang", "digest")
    counts = sorted_texts.mapInArrow(_count, "lang STRING, source STRING, term STRING, n BIGINT, df BIGINT").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    by_term = counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("sources"))
    kept = stage(by_term.where((F.col("df") >= min_docs) | (F.col("term") == "")), "divergence-terms")

    spread = kept.select("lang", "term", F.col("n").alias("all_n"), F.explode("sources").alias("s")).select("lang", "term", "all_n", "s.source", "s.n")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if(F.col("term") != "").alias("v"))
    groups = spread.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count_if(F.col("term") != "").alias("own")).join(langs, "lang")
    groups = groups.select("lang", "source", "own", "v", (F.col("total") + F.col("v")).alias("d"), (F.col("lang_total") + F.col("v")).alias("lang_d"))
    groups = stage(groups.withColumn("p0", share("0", "d")), "divergence-groups")
    entries = spread.where("term <> ''").join(groups, ["lang", "source"]).withColumn("p", share("n", "d"))

    # pairs: one side of each pair meets the other by language, dealt to SALTS parts
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mine = [F.col(f"a.{c}").alias(f"a_{c}") for c in ("source", "own", "p0")]
    part = lambda df: df.withColumn("salt", F.pmod(F.xxhash64("source"), F.lit(SALTS)).cast("int")).alias("a").join(salted.alias("b"), ["lang", "salt"]).where("a.source <> b.source")
    theirs = [F.col(f"b.{c}").alias(f"b_{c}") for c in ("source", "own", "p0", "v")]
    absent = part(groups).select("lang", *mine, *theirs).select(
        "lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), F.when(F.col("b_v") == 0, 0).otherwise((F.col("b_v") - F.col("a_own") - F.col("b_own")) * divergence("a_p0", "b_p0")).alias("value"))
    shares = entries.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("k"))
    single = part(shares).select("lang", F.col("a.source").alias("a_source"), F.col("b.source").alias("b_source"), F.col("a.p").alias("p"), F.col("a.k").alias("k"), F.col("b.p0").alias("q0"))
    single = single.groupBy("lang", "a_source", "b_source").agg(F.sum(F.col("k") * divergence("p", "q0")).alias("here"), F.sum(F.col("k") * divergence("q0", "p")).alias("there"))
    single = single.select("lang", F.explode(F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item"), F.col("here").alias("value")),
                                                     F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item"), F.col("there").alias("value")))).alias("r")).select("lang", "r.*")
    packed = entries.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("sources")).where(F.size("sources") > 1)
    both = packed.select("lang", "sources").mapInArrow(overlaps, "lang STRING, source STRING, item STRING, value BIGINT")
    pairs = absent.unionByName(single).unionByName(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    over = entries.withColumn("q", share("all_n", "lang_d")).where("n > 0 AND p > q").select("lang", "source", F.col("term").alias("item"), divergence("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    out = ranked(pairs).withColumn("part", F.lit("pair")).unionByName(ranked(over).where(F.col("rank") <= most_terms).withColumn("part", F.lit("term")))
    return out.select("lang", "source", "part", "item", F.col("value").cast("bigint").alias("value"), F.col("rank").cast("int").alias("rank"))
