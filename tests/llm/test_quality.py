"""Rule ledger against a plain Python version, and the ablation against recounting."""

import random
import re

from quizlens.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    letters = [c for c in text if c.isascii() and c.isalpha()]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered),
            len(letters), sum(c.isupper() for c in letters))


def texts():
    rnd = random.Random(3)
    line = "one two three four five six"
    out = [None, "", "   \n\t ", "word", "a b c d e a b c d e", "x " * 50, "\n".join([line] * 5), "é ü ß \x0b\x0c end", line + "\n" + line + " \n" + line,
           "ALL CAPS HERE " * 8, "a|b # * $ " * 10, "nbsp\u00a0stays one word", "\u2028 counts as a word"]
    out += [" ".join(rnd.choice("ab cd ef gh".split()) for _ in range(rnd.randint(1, 60))) for _ in range(40)]
    return out


def test_measurements_equal_plain_version(docs_of):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in quality.ledger(docs_of(rows)).collect()}
    for i, t in rows:
        assert tuple(got[i][m] for m in quality.MEASURES) == plain(t), (i, t)


def test_failures_and_policies(docs_of):
    got = quality.ledger(docs_of([(1, None), (2, "plain words that make a clean text of more than ten words in all")]))
    by_id = {r.doc_id: r.failures for r in got.collect()}
    assert by_id[1] & quality.BASE and by_id[2] == 0
    assert {r.doc_id for r in got.where(quality.passes("strict/2")).collect()} == {2}


def test_ablation_equals_recounting(docs_of):
    led = quality.ledger(docs_of(list(enumerate(texts())))).cache()
    failures = [r.failures for r in led.collect()]
    mask = quality.mask_of("strict/2")
    for r in quality.ablation(led, "strict/2").collect():
        bit = quality.BITS[r.rule]
        assert r.n_failed == sum(1 for f in failures if f & bit)
        assert r.n_only == sum(1 for f in failures if f & mask == bit)
        assert r.n_kept_without == sum(1 for f in failures if f & mask & ~bit == 0)


def test_clashing_columns_and_empty(docs_of):
    df = docs_of([(1, "some text", 5, 7)], "doc_id BIGINT, text STRING, n_words INT, failures INT")
    assert quality.ledger(df).first().n_words == 2
    assert quality.ledger(docs_of([])).count() == 0
