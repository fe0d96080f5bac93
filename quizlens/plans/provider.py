"""Provider platform: content tree, first attempts, and the marts str, heat and aud.

Tables are passed as a mapping of name to DataFrame (see quizlens.schemas for the columns). All functions work on all
courses at once; restrict the tables to one course to get what a run for one load gives.

The structure and the first-attempt rows are read several times by what follows; `structure_table` and
`attempts_table` write them once to the shared folder. Answer rows carry only keys and numbers; names, prompts and
session dates are joined to the finished counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quizlens.operators.attempts import complete_only, first_attempts_of_learners
from quizlens.operators.frames import join_on_keys
from quizlens.operators.marts import mart_heat, mart_str, quartile_pairs
from quizlens.operators.ranking import latest_only, rank_share, strong, sum_where, weak
from quizlens.operators.reliability import user_fold, with_question_variance
from quizlens.sinks.stage import stage

Tables = Mapping[str, DataFrame]

SUMMATIVE = 7  # fixed value: type id of a summative assessment

NODE = ["bid", "mid", "m_ord", "m_name", "lid", "l_ord", "l_name", "iid", "i_ord", "i_name"]
# item_id fixes the path from course to item, so answer rows carry it alone and get the path at the end
ITEM = ["course_id", "item_id"]
TEST = [*ITEM, "assessment_ext_id"]


def content_tree(t: Tables) -> DataFrame:
    """Course → branch → module → lesson → item by left joins, one row per path."""
    c, b, m, l, i = (t[n].alias(n) for n in ("course", "branch", "module", "lesson", "item"))
    return (
        c.join(b, F.col("branch.course_id") == F.col("course.id"), "left")
        .join(m, F.col("module.branch_id") == F.col("branch.id"), "left")
        .join(l, F.col("lesson.module_id") == F.col("module.id"), "left")
        .join(i, F.col("item.lesson_id") == F.col("lesson.id"), "left")
        .select(
            F.col("course.id").alias("course_id"), F.col("course.name").alias("cname"),
            F.col("course.load_id").alias("load_id"),
            F.col("branch.ext_id").alias("bid"), F.col("branch.name").alias("bname"),
            F.col("module.ext_id").alias("mid"), F.col("module.ord").alias("m_ord"),
            F.col("module.name").alias("m_name"),
            F.col("lesson.ext_id").alias("lid"), F.col("lesson.ord").alias("l_ord"),
            F.col("lesson.name").alias("l_name"),
            F.col("item.ext_id").alias("iid"), F.col("item.ord").alias("i_ord"), F.col("item.name").alias("i_name"),
            F.col("item.type_id").alias("type_id"), F.col("item.id").alias("node_item_id"),
        )
    )


def session_span(sessions: DataFrame, keys: list[str]) -> DataFrame:
    """First start and last end of the sessions of a branch; folding first keeps sessions from multiplying the tree."""
    return sessions.groupBy(*keys).agg(F.min("start_ts").alias("strt"), F.max("end_ts").alias("fin"))


def _questions_of_items(t: Tables) -> DataFrame:
    ia, a, aq, q = (t[n].alias(n) for n in ("item_assessment", "assessment", "assessment_question", "question"))
    return (
        ia.join(a, F.col("assessment.id") == F.col("item_assessment.assessment_id"), "left")
        .join(aq, F.col("assessment_question.assessment_id") == F.col("assessment.id"), "left")
        .join(q, F.col("question.id") == F.col("assessment_question.question_id"), "left")
        .select(
            F.col("item_assessment.item_id").alias("item_id"), F.col("assessment_question.ord").alias("aq_ord"),
            F.col("assessment_question.internal_id").alias("internal_id"), F.col("assessment.id").alias("ass_id"),
            F.col("assessment.ext_id").alias("assessment_ext_id"),
            F.col("assessment_question.question_id").alias("qid"), F.col("question.ext_id").alias("question_ext_id"),
            F.col("question.prompt").alias("prompt"), F.col("question.update_ts").alias("q_update_ts"),
        )
    )


def question_structure(t: Tables, graded_only: bool = True, per_assessment: bool = True,
                       assessments_only: bool = False) -> DataFrame:
    """Tree down to the question, with session span and the greatest question order of the test.

    graded_only keeps items of graded types; assessments_only drops items without an assessment; per_assessment makes
    the greatest order one of the assessment and not of the item.
    """
    span = session_span(t["csess_event"], ["branch_ext_id"]).withColumnRenamed("branch_ext_id", "bid")
    types = t["item_type"].select(F.col("id").alias("type_id"), "descr", F.col("graded").cast("int").alias("graded"))
    if graded_only:
        types = types.where(F.col("graded") == 1)
    below = _questions_of_items(t)
    how = "inner" if assessments_only else "left"
    if assessments_only:
        below = below.where(F.col("ass_id").isNotNull())
    joined = (
        content_tree(t).join(types, "type_id", "inner" if graded_only else "left")
        .join(below, F.col("item_id") == F.col("node_item_id"), how)
        .join(span, "bid", "left")
    )
    folded = joined.groupBy(
        "course_id", "cname", *NODE, "type_id", "load_id", "item_id", "aq_ord", "internal_id", "ass_id",
        "assessment_ext_id", "qid", "question_ext_id",
    ).agg(
        F.max("descr").alias("descr"), F.max("graded").alias("graded"), F.max("prompt").alias("prompt"),
        F.min("q_update_ts").alias("q_update_ts"), F.min("strt").alias("strt"), F.max("fin").alias("fin"),
    )
    test = ["course_id", "bid", "m_ord", "l_ord", "i_ord"] + (["ass_id"] if per_assessment else [])
    return folded.withColumn("max_aqord", F.max("aq_ord").over(Window.partitionBy(*test)))


def graded_structure(t: Tables) -> DataFrame:
    return question_structure(t)


def latest_load_questions(t: Tables) -> DataFrame:
    """Questions of graded items in the newest load of each (course name, branch)."""
    every = question_structure(t, graded_only=False, assessments_only=True)
    return latest_only(every, ["cname", "bid"], "load_id").where(F.col("graded") == 1)


def summative_places(t: Tables, summative: int = SUMMATIVE) -> DataFrame:
    """Items of the summative assessments of a course, within its load."""
    return (
        t["assessment"].where(F.col("type_id") == summative).alias("a")
        .join(t["course"].alias("c"), F.col("a.load_id") == F.col("c.load_id"))
        .join(t["assessment_type"].alias("at"), F.col("at.id") == F.col("a.type_id"), "left_semi")
        .join(t["item_assessment"].alias("ia"), F.col("ia.assessment_id") == F.col("a.id"))
        .select(F.col("c.id").alias("course_id"), F.col("a.ext_id").alias("assessment_ext_id"), "ia.item_id")
    )


def placed_answers(t: Tables, summative: int = SUMMATIVE) -> DataFrame:
    """Answers to questions of summative assessments with the item they belong to."""
    return answered(t).join(summative_places(t, summative), ["course_id", "assessment_ext_id"])


def answered(t: Tables) -> DataFrame:
    return t["caq_event"].where(F.col("question_ext_id").isNotNull())


def first_attempt_rows(t: Tables, rule: str = "both_minima") -> DataFrame:
    """Answers of the first attempt."""
    return first_attempts_of_learners(answered(t), summative_places(t), rule=rule).select(
        "course_id", "item_id", "assessment_ext_id", "question_ext_id", "response_score", "user_ext_id",
        "response_ext_id")


def learner_totals(attempts: DataFrame) -> DataFrame:
    """resp_sum: the learner's total in the test."""
    return attempts.groupBy(*TEST, "user_ext_id").agg(F.sum("response_score").alias("resp_sum"))


def structure_table(t: Tables) -> DataFrame:
    return stage(graded_structure(t), "structure")


def attempts_table(t: Tables, rule: str = "both_minima") -> DataFrame:
    return stage(first_attempt_rows(t, rule), "attempts", "zstd")


def with_item_variance(attempts: DataFrame, estimator: str = "sample") -> DataFrame:
    """question_var: variance of the score over all first attempts at a question. `attempts` is a staged table."""
    return with_question_variance(attempts, ["course_id", "item_id", "assessment_ext_id", "question_ext_id"],
                                  estimator=estimator, staged=True)


def answers_on_structure(struc: DataFrame, attempts: DataFrame) -> DataFrame:
    """First-attempt rows at their place in the tree."""
    places = struc.select(*TEST, "question_ext_id", "qid", "aq_ord", "max_aqord")
    return places.join(attempts, ["course_id", "item_id", "assessment_ext_id", "question_ext_id"])


def user_range_q(struc: DataFrame, attempts: DataFrame) -> DataFrame:
    """Answers with completeness markers k_q and max_aqord and the learner's rank and rank share in the item.

    Answers are dealt by learner of the test for total, number and greatest order, then by item for the ranks; the rows between are staged.
    """
    learner = Window.partitionBy(*TEST, "user_ext_id")
    summed = attempts.where(F.col("user_ext_id").isNotNull()).withColumn("resp_sum", F.sum("response_score").over(learner))
    rows = answers_on_structure(struc, summed).withColumns(
        {"k_q": F.count(F.lit(1)).over(learner), "max_aqord": F.max("max_aqord").over(learner)})
    return rank_share(stage(rows, "ranged", "zstd"), ["item_id"], ["resp_sum", "user_ext_id"])


def user_range_a(struc: DataFrame, attempts: DataFrame, formula: str = "smoothed",
                 estimator: str = "sample") -> DataFrame:
    """One row per learner and test with the reliability; sx2 is over the assessment, across branches."""
    joined = answers_on_structure(struc, with_item_variance(attempts, estimator))
    return user_fold(joined, [*TEST, "user_ext_id"], ["course_id", "assessment_ext_id"], formula=formula,
                     estimator=estimator, max_aqord=F.max("max_aqord"))


def _with_path(mart: DataFrame, struc: DataFrame) -> DataFrame:
    """Adds course name and the path of the item to finished rows."""
    paths = struc.where(F.col("item_id").isNotNull()).groupBy(*ITEM).agg(
        *[F.max(c).alias(c) for c in ("cname", *NODE)])
    return mart.join(paths, ITEM)


def _with_sub_item(mart: DataFrame) -> DataFrame:
    mart = mart.drop("item_id")
    return mart.withColumns({"platform_id": F.lit(1), "subiid": F.col("iid"), "subi_ord": F.col("i_ord"),
                             "subi_name": F.col("i_name")})


def mart_str_provider(ranged: DataFrame, struc: DataFrame) -> DataFrame:
    mart = mart_str(ranged, TEST, "user_ext_id", F.max("max_aqord") + 1)
    return _with_sub_item(_with_path(mart, struc))


def mart_heat_provider(ranged: DataFrame, struc: DataFrame) -> DataFrame:
    keys = [*TEST, "aq_ord", "question_ext_id"]
    mart = mart_heat(ranged, keys, "user_ext_id", k_min=F.min("k_q"), k_max=F.max("k_q"),
                     max_aqord1=F.max("max_aqord") + 1)
    return _with_sub_item(_with_path(join_on_keys(mart, _question_texts(struc, keys), keys), struc))


def _question_texts(struc: DataFrame, keys: list[str]) -> DataFrame:
    return struc.groupBy(*keys).agg(F.max("strt").alias("strt"), F.max("fin").alias("fin"),
                                    F.min("q_update_ts").alias("q_update_ts"), F.max("prompt").alias("prompt"))


AUD_ROW = [*ITEM, "question_ext_id", "k_q", "max_aqord1", "aq_ord"]


def options_of_questions(t: Tables) -> DataFrame:
    """Answer options by course and question id, within the load of the course."""
    return (
        t["question"].alias("q")
        .join(t["course"].alias("c"), F.col("q.load_id") == F.col("c.load_id"))
        .join(t["q_option"].alias("o"), F.col("o.question_id") == F.col("q.id"))
        .select(F.col("c.id").alias("course_id"), F.col("q.ext_id").alias("question_ext_id"),
                F.col("o.ext_id").alias("q_o_ext_id"), F.col("o.index").alias("q_o_index"),
                F.col("o.correct").alias("q_o_correct"), F.col("o.display").alias("display"))
    )


def user_range_q_o(ranged: DataFrame, t: Tables) -> DataFrame:
    """Each ranked answer × all options of its question, with the learner's selection. The long form of the option
    mart; the mart itself is computed without it."""
    chosen = t["cqo_event"].select("course_id", "response_ext_id", F.col("option_ext_id").alias("q_o_ext_id"),
                                   "selected")
    return (
        ranged.withColumn("max_aqord1", F.col("max_aqord") + 1)
        .join(options_of_questions(t), ["course_id", "question_ext_id"])
        .join(chosen, ["course_id", "response_ext_id", "q_o_ext_id"], "left")
    )


def mart_aud_provider(ranged: DataFrame, struc: DataFrame, t: Tables) -> DataFrame:
    """One row per option: how often strong and weak learners chose it. `ranged` is read twice.

    Same counts as grouping the long form, without building answers × options: what does not depend on the option is
    counted per question; only selections that are true, or stand more than once in the log, are joined to answers.
    A pair of answer and option with m > 1 log rows counts m times, as in the left join of the long form.
    """
    rows = ranged.withColumn("max_aqord1", F.col("max_aqord") + 1)
    per_question = rows.groupBy(*AUD_ROW).agg(
        F.count(F.lit(1)).alias("cnt"), F.countDistinct("user_ext_id").alias("user_cnt"),
        sum_where(weak()).alias("weak_denom"), sum_where(strong()).alias("strong_denom"),
    )
    options = options_of_questions(t)
    log = (
        t["cqo_event"].groupBy("course_id", "response_ext_id", F.col("option_ext_id").alias("q_o_ext_id"))
        .agg((F.count(F.lit(1)) - 1).alias("extra"), F.count_if("selected").alias("times"))
        .where((F.col("times") > 0) | (F.col("extra") > 0))
    )
    chosen = (
        rows.select(*AUD_ROW, "response_ext_id", "cd").join(log, ["course_id", "response_ext_id"])
        .groupBy(*AUD_ROW, "q_o_ext_id").agg(
            F.sum("extra").alias("extra"),
            sum_where(weak(), F.col("times")).alias("weak_num"),
            sum_where(weak(), F.col("extra")).alias("weak_extra"),
            sum_where(strong(), F.col("times")).alias("strong_num"),
            sum_where(strong(), F.col("extra")).alias("strong_extra"),
        )
    )
    listed = per_question.join(options, ["course_id", "question_ext_id"])
    merged = join_on_keys(listed, chosen, [*AUD_ROW, "q_o_ext_id"], "left")

    def or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0))

    mart = merged.groupBy(*AUD_ROW, "q_o_ext_id", "q_o_index", "q_o_correct").agg(
        F.max("display").alias("display"),
        F.sum(F.col("cnt") + or_zero("extra")).alias("cnt"),
        F.max("user_cnt").alias("user_cnt"),
        F.sum(or_zero("weak_num")).alias("weak_num"),
        F.sum(F.col("weak_denom") + or_zero("weak_extra")).alias("weak_denom"),
        F.sum(or_zero("strong_num")).alias("strong_num"),
        F.sum(F.col("strong_denom") + or_zero("strong_extra")).alias("strong_denom"),
    )
    return _with_sub_item(_with_path(mart, struc)).drop("cname", "mid", "lid")


# Reports over the same tables with older rules

def time_ranking(t: Tables) -> DataFrame:
    """Learners of an item by (score, longer time first, id), for the attempt with the earliest start."""
    placed = placed_answers_any_load(t)
    firsts = placed.groupBy("course_id", "item_id", "assessment_ext_id", "user_ext_id").agg(
        F.min("action_start_ts").alias("action_start_ts"), F.sum("response_score").alias("resp_sum"))
    rows = (
        answered(t).join(firsts, ["course_id", "user_ext_id", "assessment_ext_id", "action_start_ts"])
        .withColumn("time_dlt", F.col("action_ts") - F.col("action_start_ts"))
        .withColumn("__longer", -F.col("time_dlt"))
    )
    # a missing duration comes first: the default of a descending sort in the source dialect
    rows = stage(rows.withColumn("__has", F.col("time_dlt").isNotNull()), "timed")
    ranked = rank_share(rows, ["item_id"], ["resp_sum", "__has", "__longer", "user_ext_id"])
    return ranked.select("course_id", "item_id", "assessment_ext_id", "user_ext_id", "resp_sum", "time_dlt", "rnk",
                         "cd", "question_ext_id", "response_score")


def placed_answers_any_load(t: Tables, summative: int = SUMMATIVE) -> DataFrame:
    places = (
        t["assessment"].where(F.col("type_id") == summative).alias("a")
        .join(t["assessment_type"].alias("at"), F.col("at.id") == F.col("a.type_id"), "left_semi")
        .join(t["item_assessment"].alias("ia"), F.col("ia.assessment_id") == F.col("a.id"))
        .select(F.col("a.ext_id").alias("assessment_ext_id"), "ia.item_id")
    )
    return answered(t).join(places, ["assessment_ext_id"])


def user_structure_report(t: Tables) -> DataFrame:
    """Question structure with every learner's reliability (legacy form), rank and rank share by item."""
    rows = first_attempts_of_learners(answered(t), summative_places(t), ["course_id", "user_ext_id", "assessment_ext_id"], rule="start_only")
    rows = stage(rows.select("course_id", "item_id", "assessment_ext_id", "question_ext_id", "user_ext_id",
                             "response_score", (F.col("action_ts") - F.col("action_start_ts")).alias("time_dlt")),
                 "timed", "zstd")
    rows = with_question_variance(rows, ["course_id", "assessment_ext_id", "question_ext_id"], staged=True)
    folded = user_fold(rows, ["course_id", "item_id", "assessment_ext_id", "user_ext_id", "time_dlt"],
                       ["course_id", "assessment_ext_id"], formula="legacy", count_as="k")
    folded = folded.withColumns({"__has": F.col("time_dlt").isNotNull(), "__longer": -F.col("time_dlt")})
    ranked = rank_share(folded, ["item_id"], ["resp_sum", "__has", "__longer", "user_ext_id"])
    struc = question_structure(t, per_assessment=False, assessments_only=True)
    return struc.join(ranked.drop("__has", "__longer"), ["course_id", "item_id", "assessment_ext_id"])


def _complete_attempts(t: Tables) -> tuple[DataFrame, DataFrame]:
    struc = stage(question_structure(t, per_assessment=False, assessments_only=True), "structure")
    return struc, attempts_table(t, rule="start_only")


def item_reliability_report(t: Tables) -> DataFrame:
    """Per item: learners and reliability (legacy form) over complete attempts only."""
    struc, attempts = _complete_attempts(t)
    whole = complete_only(user_range_a(struc, attempts, formula="legacy"), "k_a")
    report = whole.groupBy(*ITEM).agg(
        F.count(F.lit(1)).alias("cnt"), F.countDistinct("user_ext_id").alias("user_cnt"),
        F.max("max_aqord").alias("max_aqord"), F.min("reliab").alias("mn_reliab"),
        F.max("reliab").alias("mx_reliab"), F.avg("ssi2").alias("ssi2"), F.avg("sx2").alias("sx2"),
    )
    return _with_path(report, struc).drop("item_id")


def question_difficulty_report(t: Tables) -> DataFrame:
    """Per question: share of points p and the strong and weak sums over complete attempts only."""
    struc, attempts = _complete_attempts(t)
    whole = complete_only(user_range_q(struc, attempts))
    keys = [*ITEM, "aq_ord", "question_ext_id"]
    report = whole.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cnt"), F.countDistinct("user_ext_id").alias("user_cnt"),
        (F.sum("response_score") / F.count(F.lit(1))).alias("p"), *quartile_pairs("response_score"),
    )
    texts = _question_texts(struc, keys).drop("q_update_ts")
    return _with_path(join_on_keys(report, texts, keys), struc).drop("item_id")


def rows_per_course(t: Tables) -> DataFrame:
    """Answers counted for the course of each load; 0 when the load has no answers."""
    counts = t["caq_event"].groupBy("course_id").agg(F.count(F.lit(1)).alias("n"))
    return (t["course"].select("load_id", F.col("id").alias("course_id"))
            .join(counts, "course_id", "left").withColumn("n", F.coalesce("n", F.lit(0))))
