"""The corpus operators as queries over whole tables: each query is thin, the work is in the operators' modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlens.llm import divergence, infill, jaccard, mixing, nbsvm, ngram_lm, packing, quality, secrets, substrings, topk, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

POLICY = "strict/2"


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quality_sql() -> str:
    conditions = dict(quality.RULES)
    failed = " OR ".join(f"({conditions[r]})" for r in quality.POLICIES[POLICY])
    base = " OR ".join(f"({conditions[r]})" for r in quality.POLICIES["base/1"])
    return rf"""
WITH t AS (SELECT doc_id, coalesce("text", '') AS x FROM documents),
w AS (SELECT doc_id, x, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda v: v <> '') AS ws,
             list_filter(string_split(x, chr(10)), lambda v: regexp_matches(v, '[^\x20\x09-\x0D]')) AS lines FROM t),
win AS (SELECT doc_id, i, list_slice(ws, i, i + 4) AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)),
dup AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS p FROM dup) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(length(x) - length(regexp_replace(x, '[A-Za-z]', '', 'g')) AS BIGINT) AS n_letters,
             CAST(length(x) - length(regexp_replace(x, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper
      FROM w LEFT JOIN cov USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) AS base_failed, NOT ({failed}) AS kept FROM m
"""


@query("op9_quality_rules", _quality_sql())
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of the quality rules over `documents`, judged by the production policy."""
    rows = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes("base/1")).alias("base_failed"), quality.passes(POLICY).alias("kept"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, from labels of the training fold only."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model).select("doc_id", (~toxicity.training_fold(F.col("doc_id"))).alias("held_out"), "score", "predicted")


URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def _urls_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return rf"""
WITH r(rh, rp, rv) AS (VALUES {rules}),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, host, path, rh || rp AS "rule", coalesce(rv, 'allow') AS verdict
FROM u LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
QUALIFY row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rh || rp) DESC) = 1
"""


@query("op6_url_filter", _urls_sql())
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the allow and block entries on every page's url."""
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


@query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of all documents when sources are mixed by the square root of their size, in blocks of 65536 characters."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs.select("doc_id", "source", F.length("text").alias("chars")), F.col("chars")).drop("chars")


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in bins of 2048 words; exact copies are kept apart, and at most two pieces of a source share a bin."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return packing.pack(docs, packing.word_count(docs["text"]), packing.copies(docs["text"]))


@query("op1_secrets")
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of the secret scan in every document."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), F.sha2(secrets.as_text(base), 256).alias("base_sha256"),
                        secrets.as_text(F.col("spans")).alias("spans"), of(3).alias("n_novel"))


_TOPK_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS c FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, unnest(c) AS x, generate_subscripts(c, 1) AS d FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score FROM e q JOIN e c ON q.d = c.d AND q.vec_id <> c.vec_id
      WHERE q.vec_id % 100 = 0 GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS "rank", vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""


@query("op3_topk", _TOPK_SQL)
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best other vectors for each vector whose id is divisible by 100."""
    return topk.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 100 == 0)


_JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda v: v <> '') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, hash(x) AS h FROM (
        SELECT doc_id, CASE WHEN len(ws) < 5 THEN [ws] ELSE [list_slice(ws, i, i + 4) FOR i IN generate_series(1, len(ws) - 4)] END AS xs FROM w WHERE len(ws) > 0), unnest(xs) AS u(x)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""


@query("op4_ngram_jaccard", _JACCARD_SQL)
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


@query("op8_repeated_substrings")
def op8_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in a 400-byte string which starts anywhere else too, removed."""
    return substrings.repeated(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("runs")


@query("op7_ngram_lm")
def op7_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document under the model of the training fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learn = ngram_lm.training_fold(F.col("doc_id"))
    scored = ngram_lm.score(docs, learn)
    return scored.select("doc_id", (~learn).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _infill_sql() -> str:
    h = [f"list_sum([CAST(strpos('0123456789abcdef', substr(d, {8 * k} + i, 1)) - 1 AS BIGINT) * CAST(pow(16, 8 - i) AS BIGINT) FOR i IN range(1, 9)])" for k in range(4)]
    return f"""
WITH t AS (SELECT doc_id, coalesce("text", '') AS x, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
h AS (SELECT doc_id, x, CAST(length(x) AS BIGINT) AS n, {", ".join(f"CAST({e} AS BIGINT) AS h{k + 1}" for k, e in enumerate(h))} FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(x, 1, a) AS pre, substr(x, a + 1, b - a) AS mid, substr(x, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM p
"""


@query("op11_infill", _infill_sql())
def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document, with the hashes of its output and of the text restored from it."""
    return infill.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


_DIVERGENCE_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce("source", '') AS source,
             translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
o AS MATERIALIZED (SELECT id, lang, source, unnest(regexp_extract_all(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT id) >= 3),
gt AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
g AS MATERIALIZED (SELECT lang, source, coalesce(any_value(l.v), 0) AS v, coalesce(sum(gt.n), 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN gt USING (lang, source) LEFT JOIN l USING (lang) GROUP BY lang, source),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(gt.n, 0) AS n, 1 + CAST(1000000000 * CAST(coalesce(gt.n, 0) + 1 AS HUGEINT) // (g.n + g.v) AS HUGEINT) AS p
      FROM g JOIN kept k USING (lang) LEFT JOIN gt ON gt.lang = g.lang AND gt.source = g.source AND gt.term = k.term),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.f, 0) AS f
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) s
      ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS f
      FROM (SELECT p.lang, p.source, p.term, p.p, 1 + CAST(1000000000 * CAST(k.n + 1 AS HUGEINT) // (l.n + l.v) AS HUGEINT) AS q
            FROM p JOIN kept k USING (lang, term) JOIN l USING (lang) WHERE p.n > 0) WHERE p > q),
r AS (SELECT lang, source, part, item, f, row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, item) AS rk FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(f AS BIGINT) AS "value", CAST(rk AS INTEGER) AS "rank" FROM r WHERE part = 'pair' OR rk <= 200
"""


@query("op12_divergence", _DIVERGENCE_SQL)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source of a language from each other one, and the terms that it overuses."""
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


@query("op13_quality_model")
def op13_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, from labels of the training fold only."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = nbsvm.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return nbsvm.score(docs, model).select("doc_id", (~nbsvm.training_fold(F.col("doc_id"))).alias("held_out"), "score", "predicted")
