"""Role tables: what the learning platforms deliver, derived from the whole test tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quizlens.sinks.stage import stage
from suite.registry import ROLES, built, role

# --- flat answer log: the smallest shape the ranking and reliability operators need ---------------------------------
role("answers", """
SELECT o_custkey AS user_id, l_suppkey % 5 AS item_id, l_linenumber AS question_id,
       CASE WHEN l_returnflag = 'A' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS score,
       o_orderdate AS start_ts, l_shipdate AS action_ts, l_linestatus AS option_id,
       year(o_orderdate) AS load_id, l_orderkey AS attempt_id, l_suppkey AS supp_id
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
""")

# Tests have one to three questions: each line of an order answers question line % (1 + supplier % 3).
# --- provider platform ----------------------------------------------------------------------------------------------
role("p_course", """
SELECT r_regionkey + 1 AS id, concat('C', r_regionkey) AS ext_id, lower(r_name) AS slug, r_name AS name,
       100 + r_regionkey AS load_id FROM {region}
""")
role("p_branch", """
SELECT n_nationkey AS id, n_regionkey + 1 AS course_id, concat('B', n_nationkey) AS ext_id,
       CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_name END AS name, 100 + n_regionkey AS load_id FROM {nation}
""")
role("p_module", """
SELECT n_nationkey AS id, n_nationkey AS branch_id, concat('M', n_nationkey) AS ext_id, n_nationkey % 3 AS ord,
       concat('module ', n_nationkey) AS name FROM {nation}
""")
role("p_lesson", """
SELECT s_suppkey AS id, s_nationkey AS module_id, concat('L', s_suppkey) AS ext_id, s_suppkey % 7 AS ord,
       s_name AS name FROM {supplier}
""")
role("p_item", """
SELECT s_suppkey AS id, s_suppkey AS lesson_id, concat('I', s_suppkey) AS ext_id, s_suppkey % 4 AS type_id,
       s_suppkey % 3 AS ord, concat('item ', s_suppkey) AS name FROM {supplier}
""")
role("p_item_type", """
SELECT r_regionkey AS id, concat('type ', r_name) AS descr, r_regionkey % 4 <> 0 AS graded FROM {region}
""")
role("p_assessment", """
SELECT s_suppkey AS id, concat('A', s_suppkey) AS ext_id, CASE WHEN s_suppkey % 9 = 8 THEN 6 ELSE 7 END AS type_id,
       101 + n_regionkey - 1 AS load_id FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey
""")
role("p_assessment_type", """
SELECT r_regionkey + 5 AS id, r_name AS descr FROM {region}
""")
# every tenth item holds the assessment of the next one too
role("p_item_assessment", """
SELECT s_suppkey AS item_id, s_suppkey AS assessment_id FROM {supplier} WHERE s_suppkey % 11 <> 10
UNION ALL
SELECT s_suppkey AS item_id, s_suppkey + 1 AS assessment_id FROM {supplier} WHERE s_suppkey % 10 = 5
""")
role("p_question", """
SELECT DISTINCT l_suppkey * 10 + l_linenumber % (1 + l_suppkey % 3) AS id, concat('Q', l_suppkey, '_', l_linenumber % (1 + l_suppkey % 3)) AS ext_id,
       concat('prompt ', l_linenumber % (1 + l_suppkey % 3)) AS prompt, 101 + n_regionkey - 1 AS load_id,
       CAST(NULL AS TIMESTAMP) AS update_ts
FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey JOIN {nation} ON n_nationkey = s_nationkey
""", stored=True)
role("p_assessment_question", """
SELECT DISTINCT l_suppkey AS assessment_id, l_suppkey * 10 + l_linenumber % (1 + l_suppkey % 3) AS question_id,
       concat('n', l_linenumber % (1 + l_suppkey % 3)) AS internal_id, l_linenumber % (1 + l_suppkey % 3) AS ord FROM {lineitem}
""", stored=True)
role("p_option", """
SELECT id AS question_id, concat('O', id, '_F') AS ext_id, 0 AS index, true AS correct, 'option F' AS display
FROM {p_question}
UNION ALL
SELECT id AS question_id, concat('O', id, '_O') AS ext_id, 1 AS index, false AS correct, 'option O' AS display
FROM {p_question}
""")
role("p_csess", """
SELECT concat('B', c_nationkey) AS branch_ext_id, o_orderdate AS start_ts, l_shipdate AS end_ts
FROM {orders} JOIN {customer} ON c_custkey = o_custkey LEFT JOIN {lineitem} ON l_orderkey = o_orderkey
""")
role("p_caq", """
SELECT n_regionkey + 1 AS course_id, concat('U', o_custkey) AS user_ext_id, concat('A', l_suppkey) AS assessment_ext_id,
       concat('X', l_orderkey) AS action_ext_id, l_shipdate AS action_ts, o_orderdate AS action_start_ts,
       CASE WHEN l_quantity > 49 THEN NULL ELSE concat('Q', l_suppkey, '_', l_linenumber % (1 + l_suppkey % 3)) END AS question_ext_id,
       CASE WHEN l_returnflag = 'A' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS response_score,
       concat('R', l_orderkey, '_', l_suppkey, '_', l_linenumber) AS response_ext_id
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey JOIN {supplier} ON s_suppkey = l_suppkey
JOIN {nation} ON n_nationkey = s_nationkey
""")
# the option a learner took stands as selected, the other one as not selected in a part of the rows only
role("p_cqo", """
SELECT DISTINCT response_ext_id, option_ext_id, correct, selected, course_id FROM (
  SELECT concat('R', l_orderkey, '_', l_suppkey, '_', l_linenumber) AS response_ext_id,
         concat('O', l_suppkey * 10 + l_linenumber % (1 + l_suppkey % 3), '_', l_linestatus) AS option_ext_id,
         l_returnflag = 'A' AS correct, l_returnflag <> 'N' AS selected, n_regionkey + 1 AS course_id
  FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey JOIN {nation} ON n_nationkey = s_nationkey
  UNION ALL
  SELECT concat('R', l_orderkey, '_', l_suppkey, '_', l_linenumber) AS response_ext_id,
         concat('O', l_suppkey * 10 + l_linenumber % (1 + l_suppkey % 3), '_', CASE WHEN l_linestatus = 'F' THEN 'O' ELSE 'F' END)
             AS option_ext_id,
         l_returnflag = 'A' AS correct, false AS selected, n_regionkey + 1 AS course_id
  FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey JOIN {nation} ON n_nationkey = s_nationkey
  WHERE l_tax > 0.04
) both_options
""")

PROVIDER = {
    "course": "p_course", "branch": "p_branch", "module": "p_module", "lesson": "p_lesson", "item": "p_item",
    "item_type": "p_item_type", "assessment": "p_assessment", "assessment_type": "p_assessment_type",
    "item_assessment": "p_item_assessment", "question": "p_question",
    "assessment_question": "p_assessment_question", "q_option": "p_option", "csess_event": "p_csess",
    "caq_event": "p_caq", "cqo_event": "p_cqo",
}

# --- tracking-log platform ------------------------------------------------------------------------------------------
# one row per shown option; the option columns fall away where answers are read
role("t_answer", """
SELECT concat('block-v1:org+C', n_regionkey, '+run+type@problem+block@p', l_suppkey) AS problem_id,
       concat('p', l_suppkey, '_', l_linenumber % (1 + l_suppkey % 3) + 2, '_1') AS question_id,
       concat('question ', l_linenumber % (1 + l_suppkey % 3)) AS question_txt,
       CASE WHEN l_linenumber % 2 = 0 THEN 'choicegroup' ELSE 'optioninput' END AS input_type,
       CASE WHEN l_tax > 0.05 THEN 2 ELSE 1 END AS attempts, CAST(3 AS DOUBLE) AS max_grade,
       CAST(o_orderkey % 4 AS DOUBLE) AS grade, CASE WHEN o_orderkey % 4 = 3 THEN 'correct' ELSE 'incorrect' END AS success,
       o_custkey AS user_id, concat('u', o_custkey) AS username, l_returnflag = 'A' AS resp_correct
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey JOIN {supplier} ON s_suppkey = l_suppkey
JOIN {nation} ON n_nationkey = s_nationkey
""")
role("t_sheet", """
SELECT *, 'choice_0' AS choice_id FROM {t_answer} UNION ALL SELECT *, 'choice_1' AS choice_id FROM {t_answer}
""")
role("t_structure", """
SELECT s_suppkey AS line_no,
       concat('block-v1:org+C', n_regionkey, '+run+type@chapter+block@ch', n_nationkey) AS c1,
       concat('block-v1:org+C', n_regionkey, '+run+type@sequential+block@sq', n_nationkey * 10 + s_suppkey % 3) AS c2,
       concat('block-v1:org+C', n_regionkey, '+run+type@vertical+block@vt', n_nationkey * 100 + s_suppkey % 7) AS c3,
       concat('block-v1:org+C', n_regionkey, '+run+type@', CASE WHEN s_suppkey % 8 = 7 THEN 'html' ELSE 'problem' END,
              '+block@p', s_suppkey) AS c4,
       n_name AS c5, concat('sequential ', s_suppkey % 3) AS c6, concat('vertical ', s_suppkey) AS c7,
       CASE WHEN s_suppkey % 6 = 5 THEN NULL ELSE s_name END AS c8
FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey
""")
# the last region's course is not in the catalogue
role("t_course", """
SELECT r_regionkey AS id, concat('org+C', r_regionkey, '+run') AS ext_id, r_name AS name FROM {region} WHERE r_regionkey < 4
""")

# --- progress log ---------------------------------------------------------------------------------------------------
role("f_progress", """
SELECT concat('U', user_id) AS user_ext_id, CAST(1 + user_id % 5 AS INTEGER) AS course_id,
       concat('I', CAST(floor(value) AS BIGINT) % 100) AS item_ext_id,
       CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END AS state
FROM {events}
""")
role("f_session", """
SELECT concat('S', n_nationkey) AS session_id, concat('B', n_nationkey) AS branch_ext_id FROM {nation}
""")
role("f_membership", """
SELECT concat('U', c_custkey) AS user_ext_id, concat('S', c_nationkey) AS session_id FROM {customer}
UNION ALL
SELECT concat('U', o_custkey) AS user_ext_id, concat('S', CAST(floor(o_totalprice) AS BIGINT) % 25) AS session_id FROM {orders}
""")

# --- quiz platform: base tables -------------------------------------------------------------------------------------
role("m_course", "SELECT r_regionkey + 1 AS id, lower(r_name) AS shortname, r_name AS fullname FROM {region}")
role("m_sections", "SELECT n_nationkey AS id, n_nationkey % 4 AS section, n_name AS name FROM {nation}")
role("m_modules", """
SELECT s_suppkey AS id, n_regionkey + 1 AS course, CASE WHEN s_suppkey % 10 > 6 THEN 25 ELSE 14 END AS module,
       s_suppkey AS instance, s_nationkey AS section FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey
""", stored=True)
role("m_quiz", "SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_suppkey % 13 = 12 THEN 0 ELSE 1 END AS attempts FROM {supplier}")
# one question attempt per (order, quiz, question)
role("m_flat", """
SELECT l_orderkey * 100000 + l_suppkey AS qza_id, l_suppkey AS quiz, o_custkey AS userid,
       l_linenumber % (1 + l_suppkey % 3) AS qn, l_suppkey * 10 + l_linenumber % (1 + l_suppkey % 3) AS qid, l_orderkey,
       max(l_returnflag) AS flag, max(l_partkey) AS pick
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
GROUP BY l_orderkey, l_suppkey, o_custkey, l_linenumber % (1 + l_suppkey % 3)
""", stored=True)
role("m_slots", "SELECT DISTINCT quiz AS quizid, qn + 1 AS slot, qid AS questionid FROM {m_flat}", stored=True)
role("m_question", "SELECT DISTINCT qid AS id, concat('text of question ', qid) AS questiontext FROM {m_flat}", stored=True)
# kinds by id % 4: 0 checkbox, 1 radio, 2 true/false, 3 typed text
role("m_answers", """
SELECT id * 10 + 1 AS id, id AS question, CASE WHEN id % 4 = 2 THEN 'Верно' WHEN id % 4 = 3 THEN 'alpha' ELSE 'first' END
         AS answer, CAST(1 AS DOUBLE) AS fraction FROM {m_question}
UNION ALL
SELECT id * 10 + 2 AS id, id AS question, CASE WHEN id % 4 = 2 THEN 'Неверно' WHEN id % 4 = 3 THEN 'beta' ELSE 'second' END
         AS answer, CAST(0 AS DOUBLE) AS fraction FROM {m_question}
UNION ALL
SELECT id * 10 + 3 AS id, id AS question, 'third' AS answer, CAST(0 AS DOUBLE) AS fraction FROM {m_question}
WHERE id % 4 < 2
""")
role("m_qattempts", """
SELECT qza_id AS id, quiz, userid, CASE WHEN l_orderkey % 3 = 0 THEN 2 ELSE 1 END AS attempt, qza_id + 7 AS uniqueid,
       'finished' AS state, CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE
         sum(CASE WHEN flag = 'A' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) END AS sumgrades
FROM {m_flat} GROUP BY qza_id, quiz, userid, l_orderkey
""")


@built("m_flat_marked")
def flat_marked(t):
    """m_flat with the sum of each quiz attempt and a mark on one of its rows: found while the lines are dealt by order, so they are not shuffled again."""
    flat = t.spark.sql(ROLES["m_flat"], lineitem=t["lineitem"], orders=t["orders"])
    attempt = Window.partitionBy("l_orderkey", "qza_id", "quiz", "userid")
    return stage(flat.withColumns({
        "points": F.sum(F.when(F.col("flag") == "A", F.lit(1.0)).otherwise(F.lit(0.0))).over(attempt),
        "first": F.row_number().over(attempt.orderBy("qn", "qid")) == 1}), "m_flat", "zstd")


@built("m_flat")
def flat(t):
    return t["m_flat_marked"].drop("points", "first")


@built("m_qattempts")
def quiz_attempts(t):
    return t["m_flat_marked"].where("first").selectExpr(
        "qza_id AS id", "quiz", "userid", "CASE WHEN l_orderkey % 3 = 0 THEN 2 ELSE 1 END AS attempt", "qza_id + 7 AS uniqueid", "'finished' AS state",
        "CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE points END AS sumgrades")


role("m_usages", "SELECT DISTINCT qza_id + 7 AS id, 'deferredfeedback' AS preferredbehaviour FROM {m_flat}")
role("m_qa", """
SELECT qza_id * 10 + qn AS id, qza_id + 7 AS questionusageid, qn + 1 AS slot, 'deferredfeedback' AS behaviour,
       qid AS questionid, 1 AS variant, CAST(1 AS DOUBLE) AS maxmark, CAST(0 AS DOUBLE) AS minfraction, false AS flagged,
       concat('summary ', qid) AS questionsummary, 'right' AS rightanswer, flag AS responsesummary FROM {m_flat}
""")
role("m_steps", """
SELECT (qza_id * 10 + qn) * 10 AS id, qza_id * 10 + qn AS questionattemptid, 0 AS sequencenumber, 'todo' AS state,
       CAST(NULL AS DOUBLE) AS fraction, 1500000000 + l_orderkey AS timecreated, userid FROM {m_flat}
UNION ALL
SELECT (qza_id * 10 + qn) * 10 + 1 AS id, qza_id * 10 + qn AS questionattemptid, 1 AS sequencenumber, 'complete' AS state,
       CAST(NULL AS DOUBLE) AS fraction, 1500000060 + l_orderkey AS timecreated, userid FROM {m_flat} WHERE pick % 5 <> 4
UNION ALL
SELECT (qza_id * 10 + qn) * 10 + 2 AS id, qza_id * 10 + qn AS questionattemptid, 2 AS sequencenumber,
       CASE WHEN pick % 5 = 4 THEN 'gaveup' WHEN flag = 'A' THEN 'gradedright' ELSE 'gradedwrong' END AS state,
       CASE WHEN pick % 5 = 4 THEN NULL WHEN flag = 'A' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS fraction,
       1500000120 + l_orderkey AS timecreated, userid FROM {m_flat}
""")
role("m_data", """
SELECT ((qza_id * 10 + qn) * 10) * 10 AS id, (qza_id * 10 + qn) * 10 AS attemptstepid, '_order' AS name,
       CASE WHEN pick % 2 = 0 THEN concat(qid * 10 + 3, ',', qid * 10 + 1, ',', qid * 10 + 2)
            ELSE concat(qid * 10 + 1, ',', qid * 10 + 2, ',', qid * 10 + 3) END AS value
FROM {m_flat} WHERE qid % 4 < 2
UNION ALL
SELECT ((qza_id * 10 + qn) * 10 + 1) * 10 AS id, (qza_id * 10 + qn) * 10 + 1 AS attemptstepid, 'choice0' AS name,
       CASE WHEN pick % 3 = 0 THEN '1' ELSE '0' END AS value FROM {m_flat} WHERE qid % 4 = 0 AND pick % 5 <> 4
UNION ALL
SELECT ((qza_id * 10 + qn) * 10 + 1) * 10 + 1 AS id, (qza_id * 10 + qn) * 10 + 1 AS attemptstepid, 'choice1' AS name,
       CASE WHEN pick % 3 = 1 THEN '1' ELSE '0' END AS value FROM {m_flat} WHERE qid % 4 = 0 AND pick % 5 <> 4
UNION ALL
SELECT ((qza_id * 10 + qn) * 10 + 1) * 10 + 2 AS id, (qza_id * 10 + qn) * 10 + 1 AS attemptstepid, 'answer' AS name,
       CASE WHEN qid % 4 = 1 THEN CASE WHEN pick % 3 = 0 THEN '0' WHEN pick % 3 = 1 THEN '1' ELSE '2' END
            WHEN qid % 4 = 2 THEN CASE WHEN pick % 3 = 0 THEN '1' ELSE '0' END
            ELSE CASE WHEN pick % 3 = 0 THEN 'alpha' WHEN pick % 3 = 1 THEN 'beta' ELSE 'gamma' END END AS value
FROM {m_flat} WHERE qid % 4 > 0 AND pick % 5 <> 4
UNION ALL
SELECT ((qza_id * 10 + qn) * 10 + 2) * 10 AS id, (qza_id * 10 + qn) * 10 + 2 AS attemptstepid, '-finish' AS name,
       '1' AS value FROM {m_flat}
""")
role("m_manager", "SELECT r_regionkey AS id, r_regionkey % 2 AS partnerid, r_regionkey AS userid FROM {region}")
role("m_partner", "SELECT DISTINCT r_regionkey % 2 AS id FROM {region}")
role("m_user", "SELECT c_custkey AS id FROM {customer}")
role("m_cassign", "SELECT r_regionkey AS managerid, r_regionkey + 50 AS contractid FROM {region}")
role("m_contract", "SELECT r_regionkey + 50 AS id FROM {region}")
role("m_pgroup", """
SELECT r_regionkey + 50 AS contractid, (r_regionkey + 1) * 10 AS groupid, r_regionkey + 1 AS courseid FROM {region}
UNION ALL
SELECT r_regionkey + 50 AS contractid, (r_regionkey + 1) * 10 + 1 AS groupid, r_regionkey + 1 AS courseid FROM {region}
""")
role("m_groups", "SELECT groupid AS id, courseid FROM {m_pgroup} WHERE groupid <> 31")
# every learner is in one group of each course taken, some in the other group too
role("m_members", """
SELECT DISTINCT course * 10 + userid % 2 AS groupid, userid FROM {m_qattempts} JOIN {m_modules} ON instance = quiz
UNION ALL
SELECT DISTINCT course * 10 + 1 - userid % 2 AS groupid, userid FROM {m_qattempts} JOIN {m_modules} ON instance = quiz
WHERE userid % 20 = 3
""", stored=True)

QUIZ = {
    "course": "m_course", "course_sections": "m_sections", "course_modules": "m_modules", "quiz": "m_quiz",
    "quiz_slots": "m_slots", "question": "m_question", "question_answers": "m_answers", "quiz_attempts": "m_qattempts",
    "question_usages": "m_usages", "question_attempts": "m_qa", "question_attempt_steps": "m_steps",
    "question_attempt_step_data": "m_data", "manager": "m_manager", "partner": "m_partner", "user": "m_user",
    "cassign": "m_cassign", "contract": "m_contract", "partner_group": "m_pgroup", "groups": "m_groups",
    "groups_members": "m_members",
}
