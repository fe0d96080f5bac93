"""Quality rules as a bitmask ledger: every rule is evaluated once, policies and ablations are bit operations on the result.

`ledger` adds, per document, the measurements and one BIGINT whose bit r is set when rule r fails. A policy is a named,
versioned set of rules, that is a mask: a document passes when `failures & mask` is 0. `ablation` counts, for a policy, what
each rule rejects, what it alone rejects and what would pass without it, from a count per distinct failure mask; the texts are
not read again. Only SQL functions are used.

Defined results: a null text counts as empty: all measurements are 0 and the rules on too few words fail. Repeated rows are judged each for
itself. Other columns are carried along; measurement columns replace columns of the same name, the texts' own column is dropped
unless it is listed in `keep`. An empty table gives an empty ledger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

# bit, name, failure condition over the measurements; integers only, so that every engine decides alike
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("many_symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "n_dup_lines > 2 AND 10 * n_dup_lines > 3 * n_lines"),
    ("long_words", "word_chars > 20 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("shouting", "10 * n_upper > 6 * n_letters"),
]
BITS = {name: 1 << bit for bit, (name, _) in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_windows"]

# policy and version -> rules; a version is never changed, a new one is added
POLICIES: dict[str, tuple[str, ...]] = {
    "base/1": ("few_words", "repeated_windows"),
    "strict/1": ("few_words", "repeated_windows", "many_symbols", "duplicate_lines", "long_words", "short_words"),
    "strict/2": ("few_words", "repeated_windows", "many_symbols", "duplicate_lines", "long_words", "short_words", "shouting"),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")


def mask_of(policy: str) -> int:
    """The bits of a policy's rules."""
    return sum(BITS[rule] for rule in POLICIES[policy])


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once per row however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text as an array; a text without words gives an empty array."""
    trimmed = F.regexp_replace(F.regexp_replace(text, "^" + SPACE, ""), SPACE + r"\z", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def repeat_words(tokens: Column, window: int = 5) -> Column:
    """Words of the text that lie in a window of words found twice or more in it.

    Windows are compared by a 64-bit hash. Equal ones are found by sorting (hash, place), in n log n for any text, and only
    where a text has equal windows at all.
    """
    def from_tokens(w: Column) -> Column:
        windows = F.when(F.size(w) < window, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - window, F.lit(0))), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)])))
        return _let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h, window)))

    return _let(tokens, from_tokens)


def _covered(hashes: Column, window: int) -> Column:
    def from_sorted(z: Column) -> Column:
        same = lambda x, i, k: F.coalesce(F.get(z, i + k)["h"] == x["h"], F.lit(False))
        twice = F.filter(z, lambda x, i: same(x, i, 1) | F.when(i > 0, same(x, i, -1)).otherwise(F.lit(False)))
        return _let(F.sort_array(F.transform(twice, lambda x: x["i"])), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(window)), F.lit(window))), F.lit(0), lambda a, x: a + x))

    return _let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), from_sorted)


def measurements(text: Column) -> Column:
    """All measurements of a text in one struct."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.regexp_replace(line, SPACE, "")) > 0)
    def count(pattern: str) -> Column:
        return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    tokens = words(text)
    return F.struct(
        _let(tokens, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), repeat_words(w).cast("bigint").alias("n_repeat_words"))).alias("w"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("bigint").alias("word_chars"),
        count(SYMBOLS + "+").cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"))).alias("l"),
        count("[A-Z]+").cast("bigint").alias("n_upper"),
        count("[A-Za-z]+").cast("bigint").alias("n_letters"),
    )


def ledger(docs: DataFrame, text: str = "text", keep: bool = False) -> DataFrame:
    """docs with the measurements and `failures`; the text itself only with keep=True."""
    rest = [c for c in docs.columns if c not in MEASURES and c not in ("failures", text)]
    m = measurements(docs[text])
    measured = docs.select(*[docs[c] for c in rest], *([docs[text]] if keep else []), m.alias("__m"))
    flat = measured.select(*[c for c in measured.columns if c != "__m"], "__m.w.*", "__m.l.*", "__m.word_chars", "__m.n_symbols", "__m.n_upper", "__m.n_letters")
    bits = [F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0)) for name, condition in RULES]
    total = bits[0].cast("bigint")
    for b in bits[1:]:
        total = total.bitwiseOR(b.cast("bigint"))
    return flat.withColumn("failures", total)


def passes(policy: str) -> Column:
    """Whether a row of a ledger passes a policy."""
    return F.col("failures").bitwiseAND(F.lit(mask_of(policy)).cast("bigint")) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents it fails, documents that only it fails, and documents kept by the policy without it.

    The ledger is folded to a count per failure mask first, at most 2^rules rows whatever the number of documents.
    """
    mask = F.lit(mask_of(policy)).cast("bigint")
    folded = rows.groupBy(F.col("failures").bitwiseAND(mask).alias("f")).agg(F.count(F.lit(1)).alias("n"))
    bits = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("bigint").alias("bit")) for r in POLICIES[policy]])
    each = folded.select("f", "n", F.explode(bits).alias("r")).select("f", "n", "r.rule", "r.bit")
    hit = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")
    return each.groupBy("rule").agg(
        hit(F.col("f").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        hit(F.col("f") == F.col("bit")).alias("n_only"),
        hit((F.col("f") == F.col("bit")) | (F.col("f") == 0)).alias("n_kept_without"),
    )
