"""Matrix questions, decoded by hand."""

from helpers import rows

from quizlens.plans import quiz as Z

STEMS, CHOICES = ",".join(str(100 + n) for n in range(12)), ",".join("abcdefghijk")


def tables(spark, data):
    steps = [(10, 1, 0, "todo", None), (11, 1, 1, "complete", None), (20, 2, 0, "todo", None), (21, 2, 1, "complete", None)]
    return {
        "question_attempt_steps": spark.createDataFrame(steps, "id LONG, questionattemptid LONG, sequencenumber INT, state STRING, fraction DOUBLE"),
        "question_attempt_step_data": spark.createDataFrame(data, "attemptstepid LONG, name STRING, value STRING"),
    }


def test_numbers_above_nine_and_places_outside(spark):
    t = tables(spark, [(10, "_stemorder", STEMS), (10, "_choiceorder", CHOICES), (11, "sub0", "1"), (11, "sub11", "11"), (11, "sub12", "2"),
                       (11, "sub1", "12"), (11, "sub2", "0"), (11, "sub3", "x"), (11, "sub4", None), (11, "answer", "1")])
    assert rows(Z.matrix_answers(t), "stem_place", "choice_place", "stem", "choice") == sorted([
        (1, 1, "100", "a"), (12, 11, "111", "k"), (13, 2, None, "b"), (2, 12, "101", None), (3, 0, "102", None), (4, None, "103", None),
        (5, None, "104", None)], key=repr)


def test_lists_belong_to_their_attempt_and_to_its_first_step(spark):
    t = tables(spark, [(10, "_stemorder", "7,8"), (10, "_choiceorder", "p,q"), (11, "_stemorder", "0,0"), (11, "sub1", "2"), (21, "sub1", "2")])
    assert rows(Z.matrix_answers(t)) == [(1, 11, 2, 2, "8", "q"), (2, 21, 2, 2, None, None)]


def test_no_cells(spark):
    assert rows(Z.matrix_answers(tables(spark, [(10, "_order", "1,2"), (11, "choice0", "1")]))) == []
