"""Top-k search, n-gram join, language model and components against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quizlens.llm import components as graph
from quizlens.llm import jaccard, ngram_lm, topk
from quizlens.llm.components import components
from quizlens.llm.shingles import shingle_sets
from quizlens.llm.text import text_bytes
from quizlens.sinks.stage import stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles_of(text):
    w = words_of(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_components(rows):
    sets = [(i, shingles_of(t)) for i, t in rows]
    label = list(range(len(sets)))
    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                label[find(a)] = find(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        if s and i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), i if not s else least.get(find(k))) for k, (i, s) in enumerate(sets)), key=repr)


def near_copies():
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(5)) for _ in range(300)]
    base = [[rnd.choice(vocabulary) for _ in range(n)] for n in (3, 5, 6, 40, 80, 200)]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    out = []
    for k, words in enumerate(base):
        for _ in range(14):
            w = list(words)
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            out.append(" ".join(w) if rnd.random() < 0.8 else "\n".join(w).upper())
    out += [" ".join([rnd.choice(vocabulary) for _ in range(15)] + passage + [rnd.choice(vocabulary) for _ in range(15)]) for _ in range(30)]
    # a chain: neighbours are similar, the ends are not
    chain = [rnd.choice(vocabulary) for _ in range(120)]
    for step in range(25):
        out.append(" ".join(chain[step * 2 : step * 2 + 60]))
    out += [None, "", " \n", "one", "ONE", out[0], out[40]]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("options", [{}, {"short": 4, "max_frequent": 20}, {"rounds": 0, "short": 2}])  # without rounds all long columns go through the late join
def test_join_equals_all_pairs(docs_of, options):
    rows = [(i * 3, t) for i, t in enumerate(near_copies())]
    rows += [rows[5], (None, "null id text of six words"), (6, "another text under a used id")]
    got = jaccard.join(docs_of(rows).withColumn("n_shingles", F.lit(1)), **options).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain_components(rows)


def test_one_of_each(docs_of):
    rows = [(i, t) for i, t in enumerate(near_copies())]
    got = jaccard.one_of_each(docs_of([*rows, rows[3], (None, "free"), (None, "free"), (900, None), (900, None)])).collect()
    want = {i for i, n, c in plain_components(rows) if n == 0 or i == c}
    assert Counter(r.doc_id for r in got if r.doc_id is not None and r.doc_id != 900) == Counter(want)
    assert sum(r.doc_id is None for r in got) == 2 and sum(r.doc_id == 900 for r in got) == 2
    assert jaccard.join(docs_of([])).count() == 0


def test_bitmaps_bound_the_difference():
    rnd = np.random.RandomState(0)
    for n, m, same in ((10, 900, 5), (300, 320, 280), (5000, 5000, 4000), (1, 1, 0)):
        shared = rnd.randint(0, 2**63 - 1, same).astype(np.uint64)
        a = np.unique(np.concatenate([shared, rnd.randint(0, 2**63 - 1, n - same).astype(np.uint64)]))
        b = np.unique(np.concatenate([shared, rnd.randint(0, 2**63 - 1, m - same).astype(np.uint64)]))
        x, y = jaccard.parity_bitmap(a), jaccard.parity_bitmap(b)
        bound = jaccard.differing_bits(x, y)
        folded = int(np.unpackbits((jaccard.signature(x) ^ jaccard.signature(y)).view(np.uint8)).sum())
        assert folded <= bound <= len(np.setxor1d(a, b))


def test_shingle_sets_equal_plain_sets():
    import pyarrow as pa

    texts = near_copies()
    values, bounds = shingle_sets(*text_bytes(pa.array(texts, pa.string()).slice(3)))
    assert list(np.diff(bounds)) == [len(shingles_of(t)) for t in texts[3:]]


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2050)] + [(5, 5)]
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert got == {x: m for x, m in label.items() if x != m}
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_components_stop_at_stars(spark, monkeypatch):
    """Links that already hang on the smallest id of their component are returned as they are; before, each call went through a whole round more."""
    staged = []
    monkeypatch.setattr(graph, "stage", lambda df, name: staged.append(name) or stage(df, name))
    edges = [(1, i) for i in range(2, 30)] + [(40, 41), (42, 40)]
    assert {r.id: r.root for r in components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()} == {i: 1 for i in range(2, 30)} | {41: 40, 42: 40}
    assert len(staged) == 1
    staged.clear()
    edges.append((41, 5))  # a leaf of one star on a leaf of the other
    assert {r.id: r.root for r in components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()} == {i: 1 for i in [*range(2, 30), 40, 41, 42]}
    assert len(staged) > 1


@pytest.mark.parametrize("few", [jaccard.PAIRS_EACH, 0])
def test_rounds_end_when_little_is_left(docs_of, monkeypatch, few):
    """A chain takes several rounds to grow together; the last step finds the same links when it has few pairs to look at."""
    calls = []
    whole = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda *a: calls.append(1) or whole(*a))
    monkeypatch.setattr(jaccard, "PAIRS_EACH", few)
    chain = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(chain[k : k + 60])) for k in range(100)]
    got = jaccard.join(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain_components(rows)
    if few:
        assert len(calls) == 2  # one round and the last step


def test_top_k_equals_all_scores(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.choice([0.0, 0.25, -0.5, 1.0, rnd.uniform(-1, 1)]) for _ in range(6)], 1) for i in range(400)]
    rows += [(500, None, 1), (501, [1.0, None], 1), (502, [float("nan")] * 6, 1), (503, [float("inf")] + [0.0] * 5, 1), (600, [], 1), (601, [1.0], 1), (None, [1.0] * 6, 1), rows[0]]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, score INT")
    got = topk.top_k(df, F.col("id") % 100 == 0, k=10, block_rows=16, shard_rows=100, group_rows=2).collect()
    clean = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            clean[i] = [math.floor(1024 * float(np.float32(x))) for x in v]
    want = set()
    for q in (i for i in clean if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(clean[q], c)), i) for i, c in clean.items() if i != q)
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:10])}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want and len(got) == len(want)
    few = topk.top_k(df.where("vec_id < 3"), F.col("id") == 0).collect()
    assert len(few) == 2
    assert topk.top_k(df.limit(0), F.col("id") == 0).count() == 0


def test_top_k_skips_blocks():
    rnd = np.random.RandomState(1)
    blocks = [(np.arange(b * 50, b * 50 + 50), rnd.randint(0, 10, (50, 8)) + (1000 if b == 3 else 0)) for b in range(10)]
    ids, scores, scored = topk.search_blocks(np.ones((4, 8), np.int64), np.full(4, -1), blocks, 5)
    assert (ids // 50 == 3).all() and scored == 4  # one block for each query


def test_big_products_are_exact():
    a = np.array([[2**40, -(2**40), 3]], np.int64)
    b = np.array([[2**22, 5, -7], [2**30, 2**30, 1]], np.int64)
    assert topk.products(a, b).tolist() == [[2**62 - 5 * 2**40 - 21, 3]]


def test_elias_fano_round_trip():
    rnd = np.random.RandomState(4)
    for m, universe in ((0, 10), (1, 1 << 50), (1000, 1 << 40), (3000, 3001), (5000, 1 << 20)):
        v = np.sort(rnd.randint(0, universe, m)) if m else np.zeros(0, np.int64)
        ef = ngram_lm.EliasFano(v, universe)
        if m:
            assert (ef.get(np.arange(m)).astype(np.int64) == v).all()
            x = np.concatenate([v[: m // 2], rnd.randint(0, universe, 500)])
            at, equal = ef.successor(x.astype(np.uint64))
            assert (equal == np.isin(x, v)).all()
            assert (at[equal] == np.searchsorted(v, x[equal])).all()


def test_language_model_equals_plain_model(docs_of):
    rnd = random.Random(8)
    vocabulary = [w for w in ("the", "of", "Ünï", "a.b", "x|y", "Zed") for _ in range(3)] + ["".join(rnd.choice("abc") for _ in range(4)) for _ in range(40)]
    rows = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 80)))) for i in range(200)] + [(300, None), (301, ""), (302, "the " * 3000)]
    docs = docs_of([*rows, rows[4], (None, "the of")])
    got = ngram_lm.score(docs.withColumn("score", F.lit(1)), ngram_lm.training_fold(F.col("doc_id")), mass=2.0).collect()
    import zlib

    learn = [t for i, t in [*rows, rows[4]] if zlib.crc32(str(i).encode()) % 10]
    counts, pairs, before = Counter(), Counter(), Counter()
    for t in learn:
        v = 0
        for w in [*words_of(t), None]:
            counts[w] += 1
            pairs[v, w] += 1
            before[v] += 1
            v = w
    n, distinct = sum(counts.values()), len(counts)
    texts = dict(rows) | {None: "the of"}
    assert len(got) == len(rows) + 2
    for r in got:
        w = [*words_of(texts[r.doc_id]), None]
        p1 = [(counts[x] + 0.1) / (n + 0.1 * (distinct + 1)) for x in w]
        full = sum(math.log10((pairs[v, x] + 2.0 * p) / (before[v] + 2.0)) for v, x, p in zip([0, *w[:-1]], w, p1))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(map(math.log10, p1)), rel=1e-9)
        assert abs(r.score - full) <= len(w) * ngram_lm.QUANTUM
    assert ngram_lm.score(docs_of([]), F.lit(True)).count() == 0


def test_pipeline_equals_plain_version(spark, docs_of):
    """Stages on a small corpus: toxic documents go, one of each group stays, secrets are cut, every document is packed once."""
    import corpus_pipeline

    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(near_copies())]
    rows += [(1000 + i, f"{'you idiot ' if i % 2 else ''}text number {i} with words of its own {i * i} {i * 7} {i ** 3}", "en", "s9", 50) for i in range(40)]
    rows += [(2000, 'config token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2" here', "en", None, 60)]
    docs = docs_of(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard", "secrets", "mixing", "packing"]
    import os
    import tempfile

    folder = tempfile.mkdtemp()
    docs_of([(1000 + i, i % 2) for i in range(40)], "doc_id BIGINT, toxic INT").write.parquet(os.path.join(folder, "labels.parquet"))
    clean = [r for r in rows if "idiot" not in (r[1] or "")]
    one = {i for i, n, c in plain_components([r[:2] for r in clean]) if n == 0 or i == c}
    at = docs
    for name, step in corpus_pipeline.STAGES:
        at = step(spark, at, folder)
        if name != "packing":
            assert at.columns == docs.columns
        at = at.cache()
        if name == "toxicity":
            assert {r.doc_id for r in at.collect()} == {r[0] for r in clean}
        elif name != "packing":
            assert Counter(r.doc_id for r in at.collect()) == Counter(one)
    assert {r.doc_id for r in at.collect()} == one
