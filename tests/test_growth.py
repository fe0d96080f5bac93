"""Steps that shuffle rows once: ranks of small groups, first attempts, last steps of the quiz log, entries of constraints, built input tables."""

import os

import pytest
from helpers import rows
from pyspark.sql import functions as F
from test_quiz_decoding import CUBE, datum

from quizlens.operators import constraints as C
from quizlens.operators import ranking
from quizlens.operators.attempts import first_attempts, first_attempts_of_learners
from quizlens.operators.frames import with_group_stats
from quizlens.plans import quiz as Z
from quizlens.sinks.stage import stage
from suite import load_all
from suite.registry import ROLES, Tables

load_all()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


ANSWERS = [("t", u, q, s) for u, s in ((1, 2.0), (2, 1.0), (3, None), (None, 1.0)) for q in (0, 1, 2)] + [
    ("t", 1, 0, 2.0), ("t", 2, 3, 5.0), (None, 4, 0, 1.0), (None, 4, 1, 1.0), ("w", 5, 0, 0.0)]


def answers(spark):
    return spark.createDataFrame(ANSWERS, "test STRING, u LONG, q INT, s DOUBLE")


@pytest.mark.parametrize("nulls", ["last", "first"])
@pytest.mark.parametrize("dense", [True, False])
def test_learners_of_large_and_small_tests_get_the_same_marks(spark, monkeypatch, nulls, dense):
    def ranked():
        return ranking.learner_ranks(answers(spark), ["test"], "u", "s", "q", dense=dense, nulls=nulls)

    small = ranked()
    assert "Join" not in optimized(small)  # the answers of small tests are shuffled by test alone
    want = rows(small)
    assert len(want) == len(ANSWERS)
    for most in (1, 2, 5):
        monkeypatch.setattr(ranking, "BUCKET_ROWS", most)
        assert rows(ranked()) == want


def test_ranks_of_small_groups_need_no_join(spark):
    for more in ({}, {"weight": "q"}, {"dense": True}):
        df = answers(spark).where("q > 0")
        once = ranking.rank_share(df, ["test"], ["s", "u"], **more)
        assert "Join" not in optimized(once)
        assert rows(once) == rows(ranking.rank_share(df, ["test"], ["s", "u"], bucket_rows=1, **more))


LEARNERS = "course_id INT, user_ext_id STRING, assessment_ext_id STRING, action_start_ts INT, action_ts INT, n INT"
TRIES = [(1, "a", "x", 1, 5, 1), (1, "a", "x", 1, 6, 2), (1, "a", "x", 2, 5, 3), (1, "a", "y", 1, 5, 4), (1, "a", "free", 1, 5, 5),
         (1, "b", "x", 2, 5, 6), (1, "b", "x", 1, 9, 7), (1, None, "x", 1, 5, 8), (None, "a", "x", 1, 5, 9), (1, "c", "x", None, None, 10),
         (1, "d", "y", 3, 3, 11), (1, "d", "y", 3, 3, 11), (2, "a", "x", 1, 5, 12)]
PLACES = [(1, "x", 100), (1, "x", 101), (1, "x", 100), (1, "y", 200), (1, "y", None), (None, "x", 300)]


@pytest.mark.parametrize("rule", ["both_minima", "start_only"])
@pytest.mark.parametrize("learner", [["course_id", "user_ext_id"], ["course_id", "user_ext_id", "assessment_ext_id"]])
def test_first_attempts_in_one_pass(spark, rule, learner):
    log = spark.createDataFrame(TRIES, LEARNERS)
    places = spark.createDataFrame(PLACES, "course_id INT, assessment_ext_id STRING, item_id INT")
    out = first_attempts_of_learners(log, places, learner, rule=rule)
    want = first_attempts(log, log.join(places, ["course_id", "assessment_ext_id"]), [*learner, "item_id"], rule, learner)
    columns = [*log.columns, "item_id"]
    assert optimized(out).count("Join ") == 1  # with the places, not with the answers themselves
    assert rows(out, *columns) == rows(want, *columns) and out.count() > 4


# two question attempts hold step 11; step 12 and step 10 hold no counted datum
LOGGED = [(10, 1, "todo", 0, None, 5, 100, "_order", "1,2"), (10, 1, "todo", 0, None, 5, 101, "note", "n"), (11, 1, "complete", 1, None, 6, 102, "choice0", "1"),
          (11, 2, "complete", 1, None, 6, 102, "choice0", "1"), (11, 1, "complete", 1, None, 6, 103, "note", "m"), (11, 2, "complete", 1, None, 6, 103, "note", "m"),
          (12, 1, "gradedright", 2, 1.0, 7, 104, "-finish", "1"), (13, 2, "gaveup", 2, None, 7, 105, "-finish", "1"), (14, None, "gaveup", 2, 0.5, 7, 106, "-finish", "1")]
LOGGED_COLUMNS = ("qas_id LONG, qa_id LONG, qas_state STRING, qas_sequencenumber INT, response_score DOUBLE, timecreated LONG, qasd_id LONG, "
                  "qasd_name STRING, qasd_value STRING")


def test_steps_that_cannot_be_last_keep_lists_and_scores_alone(spark):
    logged = spark.createDataFrame(LOGGED, LOGGED_COLUMNS)
    cut = Z._of_last_steps(logged)
    assert rows(cut.where("qas_id IS NULL"), "qa_id", "qas_state", "qasd_id", "qasd_name", "qasd_value", "response_score") == [
        (1, None, None, "-finish", None, 1.0), (1, None, None, "_order", "1,2", None)]
    assert {r["qas_id"] for r in cut.where("qas_shared").collect()} == {11}
    assert rows(Z.last_step_rows(cut).drop("qas_shared")) == rows(Z.last_step_rows(logged).select(*[c for c in Z.last_step_rows(cut).columns if c != "qas_shared"]))


def test_last_rows_of_a_step_id_that_stands_at_two_question_attempts(spark):
    log = [datum(a, 11, "complete", 1, None, d, "choice0", "1", 5) for a, d in ((1, 100), (1, 101), (2, 102))] + [
        datum(3, 12, "complete", 1, None, 103, "answer", "x", 6), datum(3, 12, "complete", 1, None, 104, "answer", "y", 6)]
    cube = spark.createDataFrame(log, CUBE)
    options = spark.createDataFrame([(70, 6, "x", 1.0), (71, 6, "z", 0.0)], "id LONG, question LONG, answer STRING, fraction DOUBLE")
    plain = Z.user_range_qo(cube, options)
    marked = Z.user_range_qo(cube.withColumn("qas_shared", F.col("qas_id") == 11), options)
    assert rows(marked, *plain.columns) == rows(plain)
    assert [r["qasd_id"] for r in marked.where("qas_id = 11 AND qas_indicator = 1").collect()] == [102]
    unread = Z.user_range_qo(cube, options, ["qa_id", "choice_fraction"])
    assert rows(unread) == rows(plain.drop("qa_id", "choice_fraction").select(*unread.columns))


def test_statistics_of_a_staged_table(spark):
    df = answers(spark)
    assert rows(with_group_stats(stage(df), ["test"], True, n=F.sum("q"))) == rows(with_group_stats(df, ["test"], n=F.sum("q")))


def test_staged_tables_are_written_in_the_named_codec(spark):
    for codec, end in (("zstd", ".zstd.parquet"), (None, ".snappy.parquet")):
        files = stage(answers(spark), "codec", codec).inputFiles()
        assert files and all(f.endswith(end) for f in files)


def test_entries_of_constraints_run_as_generated_code(spark):
    df = spark.createDataFrame([(1, 7), (1, None), (2, 8)], "id INT, up INT")
    found = C.violations({"t": df}, [C.Unique("t", ("id",)), C.NotNull("t", ("up",)), C.Parent("t", ("up",), "t", ("id",))])
    assert "lambda" not in optimized(found)
    assert rows(found, "kind", "key", "n") == sorted([("unique", ["1"], 2), ("not_null", [], 1), ("parent", ["7"], 1), ("parent", ["8"], 1)], key=repr)


def test_built_quiz_attempts_are_the_rows_of_the_role(spark, tmp_path):
    lines = [(1, 7, 1, "A", 3), (1, 7, 2, "N", 4), (1, 7, 1, "A", 3), (1, 8, 3, "R", 5), (2, 7, 1, None, 6), (3, None, 1, "A", 1), (None, 7, 1, "A", 1),
             (17, 9, 1, "A", 2), (4, 9, None, "A", 2), (4, 9, 2, "A", 2)]
    orders = [(1, 50), (2, 51), (2, 52), (2, 52), (3, 53), (17, 54), (4, None)]
    for name, data, columns in (("lineitem", lines, "l_orderkey LONG, l_suppkey LONG, l_linenumber INT, l_returnflag STRING, l_partkey LONG"),
                                ("orders", orders, "o_orderkey LONG, o_custkey LONG")):
        spark.createDataFrame(data, columns).write.parquet(os.path.join(tmp_path, f"{name}.parquet"))
    t = Tables(spark, str(tmp_path))
    base = {n: spark.read.parquet(os.path.join(tmp_path, f"{n}.parquet")) for n in ("lineitem", "orders")}
    t._made.update(base)
    flat = spark.sql(ROLES["m_flat"], **base)
    assert rows(t["m_flat"]) == rows(flat)
    want = spark.sql(ROLES["m_qattempts"], m_flat=flat)
    assert t["m_qattempts"].dtypes == want.dtypes and rows(t["m_qattempts"]) == rows(want)
