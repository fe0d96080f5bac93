"""Long texts, few labels and texts without words."""

import random
import time

from quizlens.llm import packing, queries, secrets, toxicity


def slow_candidates(text, found):
    """By the definition: from each sensitive word on, every long run that begins within reach."""
    out, seen = [], 0
    for m in secrets.SENSITIVE.finditer(text):
        at = m.end()
        while (r := secrets._RUN.search(text, max(at, seen))) and r.start() <= m.end() + secrets.REACH:
            at = seen = r.end()
            v = r.group()
            if any(c.isdigit() for c in v) and any(c.isalpha() for c in v) and not any(s <= r.start() and r.end() <= e for s, _, e, _ in found):
                out.append((r.start(), r.end()))
    return out


def test_secret_candidates_equal_the_plain_search():
    pick = random.Random(1)
    parts = ["token", "secret ", "bearer: ", "api key ", " ", "\n", "x y ", "AKIA" + "A1" * 9, "deadbeef" * 4, "abcDEF123456789012", "a" * 20, "=", "1234567890123456", "password='abc123def'", "filler words " * 6, "é"]
    for _ in range(3000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(1, 25)))
        found = secrets.base_spans(text)
        assert secrets.candidates(text, found) == slow_candidates(text, found)


def test_secret_scan_of_long_texts_is_linear():
    for part in ("token ", "secret abcDEF123456789012 ", "password=abc123def456ghi789 "):
        text = part * (10_000_000 // len(part))
        start = time.time()
        secrets.candidates(text, secrets.base_spans(text))
        assert time.time() - start < 60


def test_texts_without_words_share_bins(spark, docs_of):
    rows = [(i, [None, "", " \n"][i % 3], f"s{i % 50}") for i in range(200)]
    docs = docs_of(rows, "doc_id BIGINT, text STRING, source STRING")
    packed = packing.pack(docs, packing.word_count(docs["text"]), packing.copies(docs["text"]))
    assert packed.count() == 200 and packed.select("bin_id").distinct().count() == 2


def test_few_labels_reject_nothing(spark, docs_of):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    got = queries.QUERIES["op10_toxicity"](spark, sf_dir).collect()
    assert sum(r.predicted for r in got) < len(got) / 2
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, sf_dir)
    assert docs.count() * 0.8 < kept.count()


def test_model_without_words_scores_the_share_of_toxic_rows():
    model = toxicity.fit([(int(i < 10), [b"w%d" % i]) for i in range(68)])
    assert not model.weights and abs(model.score(b"anything") - 10.5 / 69) < 1e-9


def test_streamed_products_equal_the_whole_product():
    import numpy as np
    import pyarrow as pa

    from quizlens.llm import jaccard

    pick = np.random.RandomState(2)
    for _ in range(20):
        entries = sorted({(int(g), int(c)) for g, c in zip(pick.zipf(1.5, 400) % 60 - 20, pick.randint(1, 30, 400))})
        g, cls = (np.array(x, np.int64) for x in zip(*entries))
        n, place = np.full(len(g), 9, np.int64), pick.randint(0, 3, len(g)).astype(np.int64)
        a, b, c, rest = jaccard.block_pairs(g, cls, n, place, 4)
        cuts = sorted({0, len(g), *pick.randint(0, len(g), 25).tolist()})
        batches = [pa.RecordBatch.from_arrays([pa.array(x[s:e]) for x in (g, cls, n, place)], ["g", "cls", "n", "place"]) for s, e in zip(cuts, cuts[1:])]
        rows = [tuple(r.values()) for batch in jaccard._multiply(4)(iter(batches)) for r in batch.to_pylist()]
        # n-gram 0 marks pairs, so columns of that name are told apart by their place
        assert sorted(r for r in rows if r[0] != 0) == sorted(r for r in zip(*(x.tolist() for x in rest)) if r[0] != 0)
        if 0 not in g:
            assert sorted(r[1:] for r in rows if r[0] == 0) == sorted(zip(a.tolist(), b.tolist(), c.tolist()))
