"""Course-progress funnel."""

from collections import ChainMap

from pyspark.sql import functions as F

from quizlens.operators.quality import control_sum
from quizlens.plans import funnel as N
from suite.provider import stamp, tables
from suite.registry import query, role

role("f_csess", """
SELECT s.branch_ext_id, b.course_id, s.start_ts, s.end_ts FROM {p_csess} s JOIN {p_branch} b ON b.ext_id = s.branch_ext_id
""")
role("f_struc", """
SELECT c.id AS course_id, c.name AS cname, b.ext_id AS bid, coalesce(b.name, 'Original') AS bname, m.ext_id AS mid,
  m.ord AS m_ord, m.name AS m_name, l.ext_id AS lid, l.ord AS l_ord, l.name AS l_name, i.ext_id AS iid, i.ord AS i_ord,
  i.name AS i_name, i.type_id, max(it.descr) AS descr, max(CAST(it.graded AS INTEGER)) AS graded, c.load_id,
  min(s.start_ts) AS strt, max(s.end_ts) AS fin
FROM {p_course} c LEFT JOIN {p_branch} b ON b.course_id = c.id LEFT JOIN {p_module} m ON m.branch_id = b.id
LEFT JOIN {p_lesson} l ON l.module_id = m.id LEFT JOIN {p_item} i ON i.lesson_id = l.id
LEFT JOIN {f_csess} s ON s.branch_ext_id = b.ext_id AND s.course_id = c.id LEFT JOIN {p_item_type} it ON it.id = i.type_id
GROUP BY c.id, c.name, b.ext_id, b.name, m.ext_id, m.ord, m.name, l.ext_id, l.ord, l.name, i.ext_id, i.ord, i.name,
  i.type_id, c.load_id
""")
role("f_done", """
SELECT cp.user_ext_id, cp.course_id, s.branch_ext_id, cp.item_ext_id, count(*) AS cnt, min(state) AS course_progress_min,
  max(state) AS course_progress_max
FROM {f_progress} cp JOIN {f_membership} sm ON sm.user_ext_id = cp.user_ext_id
JOIN {f_session} s ON s.session_id = sm.session_id
GROUP BY cp.user_ext_id, cp.course_id, s.branch_ext_id, cp.item_ext_id
""")


def inputs(t):
    return ChainMap({"csess_event": t["f_csess"]}, tables(t))


def prog(t):
    return N.progress(t["f_progress"], t["f_membership"], t["f_session"])


@query("funnel_structure", """
SELECT course_id, cname, bid, bname, mid, lid, iid, type_id, descr, graded, load_id,
  strftime(strt, '%Y-%m-%d %H:%M:%S') AS strt, strftime(fin, '%Y-%m-%d %H:%M:%S') AS fin FROM {f_struc}
""")
def funnel_structure(t):
    """M16, F13."""
    return N.funnel_structure(inputs(t)).select("course_id", "cname", "bid", "bname", "mid", "lid", "iid", "type_id",
                                                "descr", "graded", "load_id", stamp("strt"), stamp("fin"))


@query("funnel_progress", "SELECT * FROM {f_done}")
def funnel_progress(t):
    """M17, J11."""
    return prog(t)


@query("funnel_report", """
SELECT st.course_id, cname, bid, bname, m_ord, l_ord, i_ord, i_name, strftime(min(strt), '%Y-%m-%d %H:%M:%S') AS strt_session,
  max(type_id) AS type_id, max(descr) AS type_descr, max(graded) AS graded,
  CAST(sum(2 - course_progress_max) AS BIGINT) AS started, CAST(sum(course_progress_max - 1) AS BIGINT) AS completed,
  count(DISTINCT user_ext_id) AS total, CAST(sum(cnt) AS BIGINT) AS interact_cnt,
  coalesce(CAST(sum(1) FILTER (WHERE user_ext_id IS NOT NULL) AS BIGINT), 0) = count(DISTINCT user_ext_id) AS balanced
FROM {f_struc} st LEFT JOIN {f_done} p ON p.item_ext_id = st.iid AND p.branch_ext_id = st.bid
GROUP BY st.course_id, cname, bid, bname, m_ord, l_ord, i_ord, i_name
""")
def funnel_report(t):
    """M18, Q3, A2."""
    report = control_sum(N.progress_funnel(N.funnel_structure(inputs(t)), prog(t)))
    return report.withColumn("strt_session", F.date_format("strt_session", "yyyy-MM-dd HH:mm:ss"))
