"""Data-quality checks."""

from pyspark.sql import functions as F

from quizlens.operators import quality as Q
from quizlens.sinks.stage import stage
from suite.registry import query, role

# linked tables with gaps: customers without debt, orders above a price, all regions
role("q_customer", "SELECT c_custkey AS customer_id, c_nationkey AS nation_id FROM {customer} WHERE c_acctbal > 0")
role("q_order_link", "SELECT o_custkey AS customer_id, o_custkey % 40 AS nation_id FROM {orders} WHERE o_totalprice > 450000")
role("q_nation", "SELECT n_nationkey AS nation_id FROM {nation}")
role("q_supplier_link", "SELECT s_nationkey AS nation_id FROM {supplier}")
RULES = [Q.ReferenceRule("q_customer", "customer_id", "q_order_link"),
         Q.ReferenceRule("q_customer", "nation_id", "q_order_link"),
         Q.ReferenceRule("q_nation", "nation_id", "q_supplier_link")]
# one branch per rule, ids as numbers
GAPS = "\nUNION ALL\n".join(
    f"SELECT '{r.base}' AS name, '{r.field}' AS field, '{r.linked}' AS foreign_table, {r.field} AS missed "
    f"FROM {{{r.linked}}} WHERE {r.field} NOT IN (SELECT {r.field} FROM {{{r.base}}})" for r in RULES)
role("q_gaps", GAPS)


def linked(t):
    return {n: t[n] for n in ("q_customer", "q_order_link", "q_nation", "q_supplier_link")}


@query("quality_missing_rows", "SELECT name, field, foreign_table, CAST(missed AS VARCHAR) AS missed_id FROM {q_gaps}")
def quality_missing_rows(t):
    """Q1, one row per gap."""
    return Q.missing_rows(linked(t), RULES)


HEADS = " UNION ALL ".join(f"SELECT '{r.base}' AS name, '{r.field}' AS field, '{r.linked}' AS foreign_table" for r in RULES)


@query("quality_missing_references", f"""
WITH rules AS ({HEADS})
SELECT name, field, foreign_table, coalesce(string_agg(CAST(missed AS VARCHAR), ',' ORDER BY missed), '') AS missed_rows
FROM rules LEFT JOIN {{q_gaps}} USING (name, field, foreign_table) GROUP BY name, field, foreign_table
""")
def quality_missing_references(t):
    """The list per rule."""
    return Q.missing_references(linked(t), RULES)


@query("quality_duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def quality_duplicate_keys(t):
    """Uniqueness."""
    return Q.duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query("quality_null_counts", """
SELECT count(*) FILTER (WHERE question_ext_id IS NULL) AS question_ext_id,
  count(*) FILTER (WHERE user_ext_id IS NULL) AS user_ext_id FROM {p_caq}
""")
def quality_null_counts(t):
    """Q6: not null."""
    return Q.null_counts(t["p_caq"], ["question_ext_id", "user_ext_id"])


@query("quality_total_check", """
SELECT user_id, supp_id, attempt_id, score, round(sum(score) OVER (PARTITION BY supp_id, user_id), 6) AS sumfraction,
  sum(score) OVER (PARTITION BY supp_id, user_id) = stored AS agrees
FROM (SELECT *, CAST(question_id % 2 AS DOUBLE) AS stored FROM {answers}) a
""")
def quality_total_check(t):
    """Q2."""
    rows = t["answers"].withColumn("stored", (F.col("question_id") % 2).cast("double"))
    return Q.total_check(rows, ["supp_id", "user_id"], "stored", "score").select(
        "user_id", "supp_id", "attempt_id", "score", F.round("sumfraction", 6).alias("sumfraction"), "agrees")


@query("quality_distinct_questions", """
SELECT l_orderkey, count(DISTINCT l_linenumber) AS n_questions FROM lineitem GROUP BY l_orderkey
""")
def quality_distinct_questions(t):
    """Q7."""
    return Q.distinct_questions(t["lineitem"], ["l_orderkey"], "l_linenumber")


role("q_steps", """
SELECT l_orderkey AS qa_id, l_orderkey * 10 + l_linenumber AS qas_id, l_linenumber AS qas_sequencenumber,
  CASE WHEN l_returnflag = 'A' THEN 'answer' WHEN l_returnflag = 'R' THEN '_order' ELSE NULL END AS qasd_name
FROM {lineitem}
""")


@query("quality_answer_pairs", "SELECT DISTINCT qa_id, qas_id FROM {q_steps} WHERE qasd_name = 'answer'")
def quality_answer_pairs(t):
    """Q9."""
    return Q.answer_pairs(t["q_steps"], F.col("qasd_name") == "answer")


SIGNATURES = """
SELECT steps, sgnt, count(*) AS cnt, max(qa_id) AS max_id, min(qa_id) AS min_id FROM (
  SELECT qa_id, count(DISTINCT qas_id) AS steps,
    list_sort(list(qas_sequencenumber || ':' || coalesce(qasd_name, ''))) AS sgnt
  FROM {steps} GROUP BY qa_id) x GROUP BY steps, sgnt
"""


@query("quality_step_signatures", SIGNATURES.replace("{steps}", "{q_steps}"))
def quality_step_signatures(t):
    """Q8, A17, F5."""
    return Q.step_signatures(t["q_steps"])


role("q_kept_steps", """
SELECT s.* FROM {q_steps} s
WHERE qa_id IN (SELECT qa_id FROM {q_steps} WHERE qasd_name = 'answer')
  AND qa_id IN (SELECT qa_id FROM {q_steps} WHERE qasd_name = '_order')
""")


@query("quality_step_signatures_filtered", SIGNATURES.replace("{steps}", "{q_kept_steps}"))
def quality_step_signatures_filtered(t):
    """Q8 on attempts that hold an answer and an order, J9."""
    steps = t["q_steps"]
    kept = (steps.join(steps.where(F.col("qasd_name") == "answer"), "qa_id", "left_semi")
            .join(steps.where(F.col("qasd_name") == "_order"), "qa_id", "left_semi"))
    # staged, so that the sorts of the semi joins and the maps of the signatures are not held by one task
    return Q.step_signatures(stage(kept, "kept-steps"))
