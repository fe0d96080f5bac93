"""Passes over the quiz log: what hangs on a question attempt comes from one pass over its rows, whatever number of lists and scores it has."""

from helpers import rows
from pyspark.sql import functions as F
from test_quiz_decoding import CUBE, datum

from quizlens.plans import quiz as Z


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def views(spark, data):
    make = spark.createDataFrame
    return {
        "quiz_attempts": make([(1, 3, 7, 1, 2.0, 8)], "id LONG, quiz LONG, userid LONG, attempt INT, sumgrades DOUBLE, uniqueid LONG"),
        "question_usages": make([(8, "x")], "id LONG, preferredbehaviour STRING"),
        "question_attempts": make([(5, 8, 50)], "id LONG, questionusageid LONG, questionid LONG"),
        "question_attempt_steps": make([(10, 5, 0, "todo", None), (11, 5, 1, "complete", None), (12, None, 0, "todo", None)],
                                       "id LONG, questionattemptid LONG, sequencenumber INT, state STRING, fraction DOUBLE"),
        "question_attempt_step_data": make(data, "attemptstepid LONG, name STRING, value STRING"),
        "question_answers": make([(72, 50, "b", 1.0), (73, 50, "c", 0.0)], "id LONG, question LONG, answer STRING, fraction DOUBLE"),
    }


TWO_LISTS = [(10, "_stemorder", "71,72"), (10, "_order", "73,74"), (10, "_choiceorder", "p,q"), (11, "sub1", "2"), (12, "_order", "1,2")]


def test_step_view_has_a_row_per_datum_and_list_and_reads_the_data_once(spark):
    out = Z.step_detail(views(spark, TWO_LISTS))
    assert optimized(out).count("Join ") == 4  # steps with data, usages, question attempts, and these with the steps
    assert rows(out.where("name = 'sub1'"), "stem_str", "choice_str", "stem", "choice") == [("71,72", "p,q", "72", "q"), ("73,74", "p,q", "74", "q")]
    assert out.count() == 2 * 4


def test_choice_list_of_another_step_is_not_met(spark):
    out = Z.step_detail(views(spark, [(10, "_order", "71,72"), (11, "_choiceorder", "p,q"), (11, "sub0", "1")]))
    assert rows(out.where("name = 'sub0'"), "stem_str", "choice_str", "stem", "choice") == [("71,72", None, "71", None)]


def test_answers_of_step_views(spark):
    told = Z.step_detail_with_answers(views(spark, TWO_LISTS)).where("name = 'sub1'")
    assert rows(told, "stem_str", "option_val", "option_txt") == [("71,72", 1.0, "b"), ("73,74", None, None)]
    many = Z.step_detail_multiple_choice(views(spark, [(10, "_order", "72,73"), (11, "choice1", "1")]))
    assert optimized(many).count("Join ") == 5
    assert rows(many, "name", "stem", "option_txt", "stem_str") == [("_order", "0", None, "72,73"), ("choice1", "73", "c", "72,73")]


LOG = [datum(1, 10, "todo", 0, None, 100, "_order", "31,29", 5), datum(1, 10, "todo", 0, None, 103, "_order", None, 5),
       datum(1, 11, "complete", 1, None, 101, "choice1", "1", 5), datum(1, 12, "gradedright", 2, 1.0, 102, "-finish", "1", 5),
       datum(1, 12, "gradedright", 2, None, 104, "-finish", "1", 5), datum(None, 13, "complete", 1, None, 105, "choice0", "1", 5)]


def test_last_steps_meet_every_list_and_score_without_a_join(spark):
    out = Z.last_step_rows(spark.createDataFrame(LOG, CUBE))
    assert "Join" not in optimized(out) and "Repartition" not in optimized(out)
    assert rows(out, "qas_id", "qasd_order", "finish_score") == sorted(
        [(11, o, s) for o in ("31,29", None) for s in (1.0, None)], key=repr)


def test_questions_need_no_join_and_no_values(spark):
    cube = spark.createDataFrame(LOG, CUBE)
    out = Z.first_attempt_questions(cube)
    assert "Join" not in optimized(out) and "Repartition" not in optimized(out)
    marked = Z.first_attempt_questions(cube.withColumn("qasd_value", F.when(F.col("qasd_value").isNotNull(), F.lit(""))))
    assert rows(out) == rows(marked)
    assert rows(out, "qa_id", "qtype", "response_score") == [(1, "checkbox", 1.0), (1, "checkbox", None)]


def test_options_of_the_last_step_meet_every_list_and_read_the_data_once(spark):
    out = Z.last_step_options(views(spark, [(10, "_order", "72,73"), (10, "_order", "73"), (10, "choice0", "0"), (11, "choice1", "1"), (12, "answer", "0")]))
    assert optimized(out).count("Join ") == 4  # steps with data, question attempts, listed answers, options
    assert rows(out, "questionattemptid", "attemptstepid", "stem", "choice", "option_txt") == sorted([(5, 11, 73, 1, "c"), (5, 11, None, 1, None)], key=repr)
