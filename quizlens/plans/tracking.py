"""Tracking-log platform: answers of the first attempt, problem summary and question heat on the content tree."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizlens.functions import course_of_problem, problem_of_question, question_number, score_of
from quizlens.operators.marts import quartile_pairs
from quizlens.operators.ranking import learner_ranks
from quizlens.operators.reliability import user_fold, with_question_variance
from quizlens.sinks.stage import stage

PROBLEM = ["course", "problem"]
FIELDS = ["max_grade", "grade", "success", "input_type", "question_id", "question_txt", "user_id", "username"]


def first_answers(sheet: DataFrame) -> DataFrame:
    """One row per question answered at the first attempt; the option rows of the sheet collapse."""
    return sheet.where(F.col("attempts") == 1).select(
        course_of_problem(F.col("problem_id")).alias("course"), problem_of_question(F.col("question_id")).alias("problem"),
        *FIELDS, score_of(F.col("resp_correct")).alias("response_score")).distinct()


def answers_table(sheet: DataFrame) -> DataFrame:
    return stage(first_answers(sheet), "first-answers")


def ranked_answers(answers: DataFrame) -> DataFrame:
    """k (answers of the learner in the problem), rank and rank share by (grade, learner). `answers` is staged."""
    return learner_ranks(answers, PROBLEM, "user_id", "grade", count_as="k")


def user_problems(answers: DataFrame) -> DataFrame:
    """One row per learner and problem with the variance terms."""
    rows = with_question_variance(answers, [*PROBLEM, "question_id"])
    return user_fold(rows, [*PROBLEM, "user_id"], PROBLEM, formula=None, count_as="k",
                     max_grade=F.max("max_grade"), minmax=F.min("max_grade"), grade=F.max("grade"),
                     min_grade=F.min("grade"), success=F.max("success"))


def problem_summary(users: DataFrame) -> DataFrame:
    return users.groupBy(*PROBLEM).agg(
        F.count(F.lit(1)).alias("cnt"), F.countDistinct("user_id").alias("cnt_user"),
        F.max("max_grade").alias("max_grade"), F.min("minmax").alias("minmax"), F.min("k").alias("k_min"),
        F.max("k").alias("k_max"), F.min("ssi2").alias("ssi2"), F.min("sx2").alias("sx2"))


def problem_places(tree: Mapping[str, DataFrame]) -> DataFrame:
    """Course, chapter, sequential and vertical of each problem."""
    c, ch, s, v, i = (tree[n].alias(n) for n in ("course", "chapter", "sequential", "vertical", "item"))
    return (
        i.where(F.col("item_type") == "problem")
        .join(v, F.col("item.vertical_id") == F.col("vertical.id"))
        .join(s, F.col("vertical.sequential_id") == F.col("sequential.id"))
        .join(ch, F.col("sequential.chapter_id") == F.col("chapter.id"))
        .join(c, F.col("chapter.course_id") == F.col("course.id"))
        .select(F.col("course.name").alias("cname"), F.col("course.ext_id").alias("cid"),
                F.col("chapter.name").alias("chapter"), F.col("sequential.name").alias("sequential"),
                F.col("vertical.name").alias("vertical"), F.col("item.name").alias("problem_name"),
                F.col("item.ext_id").alias("problem"))
    )


def problem_summary_on_tree(users: DataFrame, tree: Mapping[str, DataFrame]) -> DataFrame:
    return problem_places(tree).join(problem_summary(users).drop("course"), "problem")


def question_heat(ranked: DataFrame) -> DataFrame:
    """One row per question: totals and the strong and weak pairs."""
    return ranked.groupBy(*PROBLEM, "question_id").agg(
        F.max("question_txt").alias("question_txt"), F.count(F.lit(1)).alias("cnt"),
        F.countDistinct("user_id").alias("cnt_user"), F.max("max_grade").alias("max_grade"),
        F.min("max_grade").alias("minmax"), F.min("k").alias("k_min"), F.max("k").alias("k_max"),
        F.sum("response_score").alias("tot_num"), *quartile_pairs("response_score"),
    ).withColumns({"q_num": question_number(F.col("question_id")), "tot_denom": F.col("cnt_user")})


def question_heat_on_tree(ranked: DataFrame, tree: Mapping[str, DataFrame]) -> DataFrame:
    return problem_places(tree).join(question_heat(ranked).drop("course"), "problem")


def user_rows(sheet: DataFrame, question_prefix: str, user_id: int) -> DataFrame:
    """Drill-down: one learner's rows of the questions whose id starts with a prefix."""
    return sheet.where(F.col("question_id").startswith(question_prefix) & (F.col("user_id") == user_id)).orderBy(
        "problem_id", "question_id", "user_id")
