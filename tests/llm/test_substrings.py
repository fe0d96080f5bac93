"""Repeated substrings against a brute-force removal."""

import hashlib
import random
from collections import Counter

import pytest

from quizlens.llm import substrings


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def sentences(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghéß") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def corpus():
    rnd = random.Random(7)
    passage = sentences(rnd, 150)
    texts = [sentences(rnd, rnd.randint(50, 300)) for _ in range(20)]
    texts += [sentences(rnd, 60) + passage[rnd.randint(0, 80) : 900 - rnd.randint(0, 200)] + sentences(rnd, 60) for _ in range(12)]
    texts += [passage[:400], passage[:399], passage[100:500], "x" * 1500, "ab" * 700, "x" * 400, None, "", " ", texts[3], texts[3]]
    whole = texts[5]
    texts += [whole[:300] + "!" + whole[301:], whole[:800] + "?" + whole[800:], "y" + whole, whole * 2]
    return texts


def test_equals_brute_force(spark, docs_of):
    texts = corpus()
    got = substrings.repeated(docs_of(list(enumerate(texts)))).orderBy("doc_id").collect()
    want = brute(texts, 400)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == want


def test_null_ids_and_empty(spark, docs_of):
    assert substrings.repeated(docs_of([])).count() == 0
    long = "word " * 200
    got = substrings.repeated(docs_of([(None, long), (None, long), (1, None)])).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, 0), (True, 1000), (True, 1000)]


def test_length_is_checked(docs_of):
    with pytest.raises(ValueError):
        substrings.repeated(docs_of([]), length=100)
