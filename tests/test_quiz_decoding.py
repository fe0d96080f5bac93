"""Option decoding of the quiz platform on a small invented attempt log."""

from helpers import rows
from pyspark.sql import functions as F

from quizlens.plans import quiz as Z

CUBE = ("partnerid int, course_id int, groupid int, mid int, qz_id int, aq_ord int, qid bigint, qza_id int, userid int, "
        "attempt int, sumgrades double, qa_id int, qas_id int, qas_state string, qas_sequencenumber int, "
        "response_score double, qas_attm_time string, qasd_id int, qasd_name string, qasd_value string")


def datum(qa, qas, state, seq, score, qasd, name, value, qid):
    return (1, 1, 1, 1, 1, 1, qid, qa, 7, 1, 2.0, qa, qas, state, seq, score, "2020-01-01 00:00:00", qasd, name, value)


def decoded(spark, data, answers):
    cube = spark.createDataFrame(data, CUBE)
    options = spark.createDataFrame(answers, "id bigint, question bigint, answer string, fraction double")
    return Z.user_range_qo(cube, options)


LISTED = [(29, 5, "a", 0.0), (30, 5, "b", 1.0), (31, 5, "c", 0.0)]


def test_choice_decoding(spark):
    out = decoded(spark, [datum(1, 10, "todo", 0, None, 100, "_order", "31,29,30", 5),
                          datum(1, 11, "complete", 1, None, 101, "choice1", "1", 5),
                          datum(1, 12, "gradedright", 2, 1.0, 102, "-finish", "1", 5)], LISTED)
    assert rows(out, "stem", "choice", "display", "option_val", "finish_score", "qas_indicator") == [(29, 1, "a", 0.0, 1.0, 1)]


def test_answer_decoding_meets_all_listed_answers(spark):
    out = decoded(spark, [datum(1, 10, "todo", 0, None, 100, "_order", "31,29,30", 5),
                          datum(1, 11, "complete", 1, None, 101, "answer", "2", 5)], LISTED)
    assert rows(out, "stem", "choice", "qas_indicator") == [(29, 0, 0), (30, 1, 0), (31, 0, 1)]
    assert {r.qtype for r in out.select(Z.question_kind(True).alias("qtype")).collect()} == {"radio"}


def test_typed_answer(spark):
    listed = [(1, 6, "a", 1.0), (2, 6, "b", 0.0)]
    miss = decoded(spark, [datum(1, 11, "complete", 1, None, 101, "answer", "x", 6)], listed)
    assert rows(miss, "stem", "choice", "input_answer") == [(1, 0, "x"), (2, 0, "x")]
    hit = decoded(spark, [datum(1, 11, "complete", 1, None, 101, "answer", "a", 6)], listed)
    assert rows(hit, "stem", "choice", "input_answer") == [(1, 1, None), (2, 0, None)]


def test_true_false_answer(spark):
    listed = [(1, 6, Z.TRUE, 1.0), (2, 6, Z.FALSE, 0.0)]
    out = decoded(spark, [datum(1, 11, "complete", 1, None, 101, "answer", "0", 6)], listed)
    assert rows(out, "stem", "choice", "input_answer") == [(1, 0, None), (2, 1, None)]
    assert {r.k for r in out.select(Z.question_kind(True).alias("k")).collect()} == {"option"}


def test_answer_without_listed_options_stays_null(spark):
    out = decoded(spark, [datum(1, 11, "complete", 1, None, 101, "answer", "x", 9)], LISTED)
    assert rows(out, "stem", "choice", "input_answer") == [(None, None, None)]


def test_ten_or_more_choices(spark):
    ids = ",".join(str(i) for i in range(40, 52))
    listed = [(i, 5, f"o{i}", 0.0) for i in range(40, 52)]
    out = decoded(spark, [datum(1, 10, "todo", 0, None, 100, "_order", ids, 5),
                          datum(1, 11, "complete", 1, None, 101, "choice10", "1", 5)], listed)
    assert rows(out, "stem", "choice") == [(50, 1)]


def test_given_up_attempt_is_its_last_step(spark):
    out = decoded(spark, [datum(1, 11, "complete", 1, None, 101, "answer", "x", 6),
                          datum(1, 12, "gaveup", 2, None, 102, "-finish", "1", 6)], LISTED)
    assert rows(out, "qas_id", "qasd_name", "stem", "choice") == [(12, "-finish", 0, None)]


def test_broken_places_do_not_fail(spark):
    out = decoded(spark, [datum(1, 10, "todo", 0, None, 100, "_order", "31,29", 5),
                          datum(1, 11, "complete", 1, None, 101, "choice7", "1", 5),
                          datum(1, 11, "complete", 1, None, 103, "choiceX", "1", 5)], LISTED)
    assert rows(out, "stem", "choice") == [(None, 1), (None, 1)]


def test_scope_needs_every_link(spark):
    t = {
        "manager": spark.createDataFrame([(1, 5, 9)], "id int, partnerid int, userid int"),
        "partner": spark.createDataFrame([(5,)], "id int"), "user": spark.createDataFrame([(9,)], "id int"),
        "cassign": spark.createDataFrame([(1, 3)], "managerid int, contractid int"),
        "contract": spark.createDataFrame([(3,)], "id int"),
        "partner_group": spark.createDataFrame([(3, 70, 1), (3, 71, 2)], "contractid int, groupid int, courseid int"),
        "groups": spark.createDataFrame([(70, 1), (71, 8)], "id int, courseid int"),
        "course": spark.createDataFrame([(1,), (2,)], "id int"),
    }
    assert rows(Z.partner_scope(t, ["course_id", "groupid", "partnerid", "managerid"])) == [(1, 70, 5, 1)]
    t["user"] = t["user"].where(F.lit(False))
    assert Z.partner_scope(t).count() == 0
