"""Course-progress funnel: who started and who completed each item."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.operators.frames import join_on_keys
from quizlens.plans.provider import content_tree, session_span

ROW = ["course_id", "cname", "bid", "bname", "m_ord", "l_ord", "i_ord", "i_name"]


def funnel_structure(t: Mapping[str, DataFrame], session_courses: bool = True) -> DataFrame:
    """All items of all courses with branch name ('Original' when it has none), type and session span.

    csess_event carries course_id when session_courses is set, and sessions count for their own course only.
    """
    keys = ["branch_ext_id"] + (["course_id"] if session_courses else [])
    span = session_span(t["csess_event"], keys).withColumnRenamed("branch_ext_id", "bid")
    types = t["item_type"].select(F.col("id").alias("type_id"), "descr", F.col("graded").cast("int").alias("graded"))
    on = ["bid"] + (["course_id"] if session_courses else [])
    tree = content_tree(t).withColumn("bname", F.coalesce("bname", F.lit("Original")))
    joined = tree.join(span, on, "left").join(types, "type_id", "left")
    return joined.groupBy("course_id", "cname", "bid", "bname", "mid", "m_ord", "m_name", "lid", "l_ord", "l_name",
                          "iid", "i_ord", "i_name", "type_id", "load_id").agg(
        F.max("descr").alias("descr"), F.max("graded").alias("graded"), F.min("strt").alias("strt"),
        F.max("fin").alias("fin"))


def progress(log: DataFrame, memberships: DataFrame, sessions: DataFrame) -> DataFrame:
    """Per learner, course, branch and item: interactions, least and greatest state.

    A learner in several sessions of a branch counts each interaction once per session, in whatever course, as the
    source does. Both sides are folded before they meet: interactions per item, sessions per branch; the product of
    the two counts is the number of pairs, so the pairs are never built.
    """
    done = log.groupBy("user_ext_id", "course_id", "item_ext_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("state").alias("course_progress_min"),
        F.max("state").alias("course_progress_max"))
    belongs = memberships.join(sessions, "session_id").groupBy("user_ext_id", "branch_ext_id").agg(
        F.count(F.lit(1)).alias("times"))
    return done.join(belongs, "user_ext_id").select(
        "user_ext_id", "course_id", "branch_ext_id", "item_ext_id", (F.col("n") * F.col("times")).alias("cnt"),
        "course_progress_min", "course_progress_max")


def progress_funnel(struc: DataFrame, prog: DataFrame) -> DataFrame:
    """Started, completed, distinct learners and interactions per item of a branch.

    The control sum started + completed = total holds where a learner stands once per row. Progress is aggregated on
    the keys of the report before the tree's rows without progress are added.
    """
    places = struc.select(*ROW, F.col("iid").alias("item_ext_id"), F.col("bid").alias("branch_ext_id"))
    counts = prog.drop("course_id").join(places, ["item_ext_id", "branch_ext_id"]).groupBy(*ROW).agg(
        F.sum(2 - F.col("course_progress_max")).alias("started"),
        F.sum(F.col("course_progress_max") - 1).alias("completed"),
        F.countDistinct("user_ext_id").alias("total"), F.sum("cnt").alias("interact_cnt"))
    heads = struc.groupBy(*ROW).agg(
        F.min("strt").alias("strt_session"), F.max("type_id").alias("type_id"), F.max("descr").alias("type_descr"),
        F.max("graded").alias("graded"))
    return join_on_keys(heads, counts, ROW, "left").withColumn("total", F.coalesce("total", F.lit(0)))
