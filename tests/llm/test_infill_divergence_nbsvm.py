"""Fill-in-middle, source divergence and the support vector classifier against plain versions, and their odd inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quizlens.llm import divergence, infill, nbsvm, queries

SMALL = "/root/testdata/sf0.001"


# fill-in-middle

def plain_infill(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(text)
    if n == 0 or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return text, "plain", None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return f"<S>{suf}<P>{pre}<M>{mid}", "spm", a, b - a
    return f"<P>{pre}<S>{suf}<M>{mid}", "psm", a, b - a


ODD_TEXTS = ["", None, "a", "é", "日本語 text", "x <P> y", "<S>", "half <", "S> <M", "<<P", "P>>", " \n\t ", "word " * 60_000, "\U0001f600" * 5000]


def test_infill_odd_texts_and_round_trip(docs_of):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS * 12)] + [(None, "no id"), (7, "again"), (7, "again")]
    docs = docs_of(rows)
    got = infill.transform(docs)
    want = Counter((i, *plain_infill(i, t)) for i, t in rows)
    assert Counter((r.doc_id, r.output, r.form, r.prefix_chars, r.middle_chars) for r in got.collect()) == want
    back = infill.restore(got).select("doc_id", "text", "n")
    assert Counter((r.doc_id, r.text, r.n) for r in back.collect()) == Counter((i, t or "", len(t or "")) for i, t in rows)
    hashed = Counter((r.doc_id, r.output_sha256, r.restored_sha256) for r in infill.digests(docs).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert hashed == Counter((i, sha(plain_infill(i, t)[0]), sha(t or "")) for i, t in rows)


def test_infill_pieces_point_into_the_text(docs_of):
    text = "0123456789" * 30
    for r in infill.transform(docs_of([(i, text) for i in range(40)])).collect():
        assert "".join((text, infill.BUFFER)[p.buffer][p.start : p.end] for p in r.pieces) == r.output
        kept = sorted((p.start, p.end) for p in r.pieces if p.buffer == infill.TEXT)
        assert kept[0][0] == 0 and kept[-1][1] == len(text) and all(a[1] == b[0] for a, b in zip(kept, kept[1:]))


@pytest.mark.parametrize("at", range(8))
def test_infill_cut_splits_descriptors(at):
    pieces, text = [(infill.TEXT, 2, 4), (infill.MARKS, 0, 3), (infill.TEXT, 7, 9)], "abcdefghij"
    before, after = infill.cut(pieces, at)
    whole = infill.written(pieces, text)
    assert (infill.written(before, text), infill.written(after, text)) == (whole[:at], whole[at:])


def test_infill_empty_table_and_clashing_columns(spark, docs_of):
    assert infill.digests(docs_of([])).collect() == [] and infill.transform(docs_of([])).count() == 0
    docs = spark.createDataFrame([(1, "some text", "mine", 5, "kept")], "doc_id BIGINT, text STRING, form STRING, n INT, __x STRING")
    row = infill.transform(docs).first()
    assert row["__x"] == "kept" and row["n"] == 9 and row["form"] in ("plain", "psm", "spm") and "text" not in row


def test_infill_keeps_the_shares_of_forms(docs_of):
    forms = Counter(r.form for r in infill.digests(docs_of([(i, "a text") for i in range(4000)]), rate=50, spm_rate=30).collect())
    assert abs(forms["plain"] - 2000) < 200 and abs(forms["spm"] - 600) < 120


# source divergence

def plain_audit(rows, min_docs=3, most=200):
    """rows: (text, lang, source)."""
    df, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
        groups[lang].add(source)
        count[lang, source].update(words)
        df[lang].update(set(words))
    out = []
    f = lambda p, q: (p - q) ** 2 // q
    for lang, sources in groups.items():
        kept = sorted(t for t, n in df[lang].items() if n >= min_docs)
        p = {}
        for s in sources:
            total = sum(count[lang, s][t] for t in kept)
            p[s] = {t: 1 + 10**9 * (count[lang, s][t] + 1) // (total + len(kept)) for t in kept}
        all_n = {t: sum(count[lang, s][t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (all_n[t] + 1) // (sum(all_n.values()) + len(kept)) for t in kept}
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            over = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", over, most)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def audited(docs, **options):
    return sorted(tuple(r) for r in divergence.audit(docs, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def table_of(spark, rows):
    return spark.createDataFrame(rows, "text STRING, lang STRING, source STRING")


def test_divergence_odd_rows(spark):
    rows = [("a b c", "en", "x"), ("a b c", "en", "x"), ("A B c", "en", "y"), ("a é É", "en", "y"), ("é", "en", None), ("", "en", "empty"), (None, "en", "empty"), (None, None, None),
            ("a a a a", "de", "x"), ("a", "de", "x"), ("lone", "fr", "x"), ("lone", "fr", "y"), ("a-b_c1d", "en", "z"), ("日本 日本\x00日本", "ja", "x"), ("日本", "ja", "y"), ("日本", "ja", "")] + [("a b", "de", "y")] * 5
    assert audited(table_of(spark, rows)) == plain_audit(rows)


def test_divergence_copies_in_many_sources_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS", 7)
    random = np.random.RandomState(3)
    words = ["w" + "abcdefghijklmnopqrstuvwxyz"[i % 26] * (1 + i // 26) for i in range(60)]
    rows = []
    for i in range(150):
        text = " ".join(words[int(k)] for k in random.zipf(1.3, random.randint(1, 60)) % 60)
        rows += [(text, "l" + str(i % 2), f"s{random.randint(9)}") for _ in range(random.randint(1, 6))]
    rows.append((" ".join(words) * 3000, "l0", "s1"))
    got = audited(table_of(spark, rows).repartition(5), most_terms=4)
    assert got == plain_audit(rows, most=4)


def test_divergence_empty_table_and_clashing_columns(spark):
    assert audited(table_of(spark, [])) == []
    docs = spark.createDataFrame([("a", "en", "x", 1, "q")] * 3 + [("a", "en", "y", 1, "q")], "text STRING, lang STRING, source STRING, digest INT, term STRING")
    assert audited(docs) == plain_audit([("a", "en", "x")] * 3 + [("a", "en", "y")])


def test_divergence_share_is_exact_beyond_64_bits(spark):
    rows = [(0, 1), (5, 7), (2**40, 2**41), (9_223_372_034, 10**12), (2**62, 2**62 + 5)]
    got = spark.createDataFrame(rows, "n BIGINT, d BIGINT").select("n", "d", divergence.share("n", "d").alias("p")).collect()
    assert [r.p for r in got] == [1 + 10**9 * (n + 1) // d for n, d in rows]


# quality classifier

def plain_features(text, bits):
    """Feature places by the definition, one text at a time."""
    data = (text or "").encode()
    _, places = nbsvm.features(np.frombuffer(data, np.uint8), np.array([0, len(data)]), bits)
    return set(places.tolist())


def test_features_do_not_depend_on_the_neighbours():
    texts = ["Some words here", "", "SHOUT!! SHOUT!!", " ", "a a a", "x", "é È ß 1 22"]
    data = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    of, place = nbsvm.features(np.frombuffer(b"".join(data), np.uint8), bounds, 17)
    for i, t in enumerate(texts):
        assert set(place[of == i].tolist()) == plain_features(t, 17)
    assert plain_features("a a", 17) != plain_features("a b", 17) and plain_features("Ab", 17) != plain_features("ab", 17)


def test_packed_places_come_back():
    for n in (0, 1, 50, 3000):
        place = np.sort(np.random.RandomState(n).permutation(1 << 12)[:n])
        assert np.array_equal(nbsvm._unpacked(nbsvm._packed(place, 12), 12), place)


def test_coordinate_descent_meets_the_optimality_conditions():
    random = np.random.RandomState(1)
    rows = [np.sort(random.permutation(40)[: random.randint(1, 12)]) for _ in range(80)]
    y = np.array([int(random.rand() < (0.9 if 3 in r else 0.2)) for r in rows])
    ratio = nbsvm.log_count_ratios(rows, y, 64)
    w, b = nbsvm.machine(rows, y, ratio, 1.0, 2000, 1e-9)
    w = np.divide(w, ratio, out=np.zeros_like(w), where=ratio != 0)
    x = np.zeros((len(rows), 64))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / (np.sqrt((ratio[r] ** 2).sum()) or 1)
    sign = np.where(y == 1, 1, -1)
    upper = len(y) / (2 * np.where(y == 1, (y == 1).sum(), (y == 0).sum()))
    loss = lambda v, c: 0.5 * (v @ v + c * c) + (upper * np.maximum(0, 1 - sign * (x @ v + c))).sum()
    best = loss(w, b)
    for _ in range(300):
        assert loss(w + random.normal(0, 0.02, 64), b + random.normal(0, 0.02)) >= best - 1e-6


def labelled(spark, n=400):
    random = np.random.RandomState(5)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(random.choice(list("abcdefgh"), 4)) for _ in range(random.randint(3, 30))]
        good = i % 3 > 0
        rows.append((i, " ".join(words if good else [w.upper() + "!!" for w in words])))
        labels.append((i, int(good)))
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), spark.createDataFrame(labels, "doc_id BIGINT, quality INT")


def test_quality_model_on_rows_it_has_not_seen(spark):
    docs, labels = labelled(spark)
    held = {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    # held-out labels are wrong: they must not matter
    spoilt = labels.withColumn("quality", F.when(nbsvm.training_fold(F.col("doc_id")), F.col("quality")).otherwise(1 - F.col("quality")))
    model = nbsvm.train(docs, spoilt)
    got = {r.doc_id: r for r in nbsvm.score(docs, model).collect()}
    assert all(got[i].predicted == truth[i] for i in held) and held
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())


def test_quality_model_gives_the_same_scores_under_another_partitioning(spark):
    docs, labels = labelled(spark, 200)
    scores = [sorted((r.doc_id, r.score) for r in nbsvm.score(d, nbsvm.train(d, labels)).collect()) for d in (docs.repartition(1), docs.repartition(7))]
    assert scores[0] == scores[1]


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(1, None)], 0.5), ([(1, 1), (3, 1), (4, 1)], 3.5 / 4), ([(1, 0)], 0.25)])
def test_quality_model_without_both_classes(spark, docs_of, labels, score):
    assert all(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in labels)
    docs = docs_of([(1, "a"), (3, None), (4, "")])
    model = nbsvm.train(docs, spark.createDataFrame(labels, "doc_id BIGINT, quality INT"))
    assert {round(r.score, 12) for r in nbsvm.score(docs, model).collect()} == {round(score, 12)}


def test_quality_model_odd_rows(spark):
    docs, labels = labelled(spark, 120)
    model = nbsvm.train(docs, labels.unionByName(labels))
    odd = spark.createDataFrame([(1, None, 3.0, "a"), (None, "", 3.0, "b"), (1, "word " * 200_000, 3.0, "c"), (1, " \n", 3.0, "d"), (1, None, 3.0, "a")], "doc_id BIGINT, text STRING, score DOUBLE, __text2 STRING")
    got = {(r["__text2"], r.score) for r in nbsvm.score(odd, model).collect()}
    empty = {s for t, s in got if t != "c"}
    assert len(empty) == 1 and len(got) == 4 and all(0 <= s <= 1 for _, s in got)
    assert nbsvm.score(odd.limit(0), model).collect() == []


def test_quality_query_scores_by_the_definition(spark):
    """Every score of the smallest table, worked out from the model text by text."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = nbsvm.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    got = {r.doc_id: r for r in queries.QUERIES["op13_quality_model"](spark, SMALL).collect()}
    for r in docs.collect():
        places = np.array(sorted(plain_features(r.text, model.bits)), np.int64)
        length = np.sqrt(model.squares[places].sum()) or 1.0
        margin = model.weights[places].sum() / length + model.intercept
        assert abs(got[r.doc_id].score - 1 / (1 + np.exp(-(model.slope * margin + model.offset)))) < 1e-9
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
