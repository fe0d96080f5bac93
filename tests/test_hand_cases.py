"""Cases with answers worked out by hand: nulls, ties, single rows, fan-out."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quizlens import functions as X
from quizlens.operators import quality as Q
from quizlens.operators.attempts import complete_only, first_attempts, first_n_per_group
from quizlens.operators.marts import discrimination, mart_heat
from quizlens.operators.ranking import after_offset, is_last_row, rank_share, strong, sum_where, weak
from quizlens.operators.reliability import user_fold, with_question_variance
from quizlens.plans import funnel as N


def answers(spark, data):
    return spark.createDataFrame(data, "user string, q string, score double").withColumn("test", F.lit("t"))


def fold(df, **kw):
    estimator = kw.get("estimator", "sample")
    return user_fold(with_question_variance(df, ["test", "q"], "score", estimator), ["test", "user"], ["test"], "score", **kw)


TWO = [("u1", "a", 1.0), ("u1", "b", 1.0), ("u2", "a", 0.0), ("u2", "b", 0.0)]


def test_reliability_smoothed(spark):
    for r in fold(answers(spark, TWO)).collect():
        assert (r.ssi2, r.sx2) == (1.0, 2.0)
        assert r.reliab == pytest.approx(1.0)


def test_reliability_population(spark):
    r = fold(answers(spark, TWO), estimator="population").first()
    assert (r.ssi2, r.sx2) == (0.5, 1.0)
    assert r.reliab == pytest.approx(1.000499, abs=1e-6)


def test_reliability_legacy(spark):
    r = fold(answers(spark, TWO), formula="legacy").first()
    assert r.reliab == pytest.approx(1 - (1 / 2.01) / 1.01)


def test_reliability_legacy_single_question_divides_whole(spark):
    df = answers(spark, [("u1", "a", 1.0), ("u2", "a", 0.0)])
    r = fold(df, formula="legacy").first()
    assert r.reliab == pytest.approx(1 - (0.5 / 0.51) / (1.01 - 1))


def test_one_user_has_no_reliability(spark):
    r = fold(answers(spark, TWO[:2])).first()
    assert r.ssi2 is None and r.sx2 is None and r.reliab is None


def test_weak_cut(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(4)], "u int, total double").withColumn("g", F.lit(1))
    out = rank_share(df, ["g"], ["total", "u"])
    assert rows(out, "cd") == [(0.25,), (0.5,), (0.75,), (1.0,)]
    n = out.agg(sum_where(strong()).alias("s"), sum_where(weak()).alias("w"), sum_where(weak(inclusive=True)).alias("wi")).first()
    assert tuple(n) == (1, 0, 1)


@pytest.mark.parametrize("nulls, expected", [("last", {1.0: 1, 2.0: 2, None: 3}), ("first", {None: 1, 1.0: 2, 2.0: 3})])
@pytest.mark.parametrize("bucket_rows", [1, 2, 1 << 20])
def test_rank_with_null_total(spark, nulls, expected, bucket_rows):
    df = spark.createDataFrame([("g", 1.0), ("g", None), ("g", 2.0)], "g string, total double")
    out = rank_share(df, ["g"], ["total"], nulls=nulls, bucket_rows=bucket_rows)
    assert {r.total: r.rnk for r in out.collect()} == expected


@pytest.mark.parametrize("bucket_rows", [1, 3, 7, 1 << 20])
def test_bucketed_rank_equals_window(spark, bucket_rows):
    """A hot group that holds most rows, a null group, ties: the same as the plain window for any bucket size."""
    from pyspark.sql import Window

    df = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 7 == 0, None).otherwise("cold").alias("g"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 5).alias("total"), (F.col("id") % 97).alias("u"))
    w = Window.partitionBy("g").orderBy(F.col("total").asc_nulls_last(), F.col("u").asc_nulls_last())
    want = df.select("g", "total", "u", F.rank().over(w).cast("bigint"), F.cume_dist().over(w))
    assert rows(rank_share(df, ["g"], ["total", "u"], bucket_rows=bucket_rows)) == rows(want)
    want = df.select("g", "total", "u", F.dense_rank().over(w).cast("bigint"))
    got = rank_share(df, ["g"], ["total", "u"], share=None, dense=True, bucket_rows=bucket_rows)
    assert rows(got) == rows(want)
    folded = df.groupBy("g", "total", "u").agg(F.count(F.lit(1)).alias("n"))
    heavy = rank_share(folded, ["g"], ["total", "u"], bucket_rows=bucket_rows, weight="n", unique=True).drop("n")
    want = df.select("g", "total", "u", F.rank().over(w).cast("bigint"), F.cume_dist().over(w)).distinct()
    assert rows(heavy) == rows(want)


def attempts(spark):
    return spark.createDataFrame(
        [("c", "u", "i", 10, 30, "x"), ("c", "u", "i", 20, 25, "y"), ("c", "v", "i", 1, 2, "z"), ("c", "v", "j", 1, 2, "w")],
        "course_id string, user_ext_id string, item_id string, action_start_ts int, action_ts int, q string")


def test_first_attempt_minima_that_never_meet_drop_the_user(spark):
    log = attempts(spark).drop("item_id")
    out = first_attempts(log, attempts(spark))
    assert {r.user_ext_id for r in out.collect()} == {"v"}


def test_first_attempt_start_only_keeps_the_first_row(spark):
    out = first_attempts(attempts(spark).drop("item_id"), attempts(spark), rule="start_only")
    assert [r.q for r in out.where("user_ext_id = 'u'").collect()] == ["x"]


def test_first_attempt_join_knows_no_item(spark):
    """Rows of another item with the same times come along: two items × two rows."""
    out = first_attempts(attempts(spark).drop("item_id"), attempts(spark))
    assert rows(out, "item_id", "q") == [("i", "w"), ("i", "z"), ("j", "w"), ("j", "z")]


def test_complete_only(spark):
    df = spark.createDataFrame([(3, 2), (2, 2)], "k_q int, max_aqord int")
    assert complete_only(df).count() == 1
    assert rows(complete_only(df, order_base=1)) == [(2, 2)]


def test_text_functions(spark):
    df = spark.createDataFrame(
        [("block-v1:org+C1+run+type@chapter+block@abc", "p1_3_1", "0.123456789012", "31,29,30", "choice10")],
        "loc string, q string, opt string, ids string, name string")
    r = df.select(
        X.course_of_block(F.col("loc")).alias("course"), X.block_part(F.col("loc")).alias("part"),
        X.block_kind(F.col("loc")).alias("kind"), X.problem_of_question(F.col("q")).alias("problem"),
        X.question_number(F.col("q")).alias("n"), X.short_option_id(F.col("opt")).alias("opt"),
        X.list_item(F.col("ids"), 2).alias("second"), X.list_item(F.col("ids"), 9).alias("none"),
        X.list_item(F.col("ids"), 0).alias("zero"), X.list_item(F.lit(None).cast("string"), 1).alias("null_list"),
        X.suffix_number(F.col("name"), "choice").alias("suffix"), X.last_digit(F.col("name")).alias("digit"),
        X.file_name(F.lit("https://x.example/a/b.gz\n")).alias("file"),
        X.concat_skip_nulls(F.lit("a"), F.lit(None).cast("string"), F.lit("b")).alias("cc")).first()
    assert tuple(r) == ("org+C1+run", "abc", "chapter", "p1", 2, "0.12345678", "29", "", "", None, 10, 0, "b.gz", "ab")


def test_long_ids_are_read_whole(spark):
    df = spark.createDataFrame([("block-v1:xxxx" + "c" * 120 + "+rest", "p" * 150 + "_2_1", "broken")], "p string, q string, t string")
    r = df.select(X.course_of_problem(F.col("p")).alias("c"), X.problem_of_question(F.col("q")).alias("p"), X.log_time(F.col("t")).alias("t")).first()
    assert (r.c, r.p, r.t) == ("c" * 120, "p" * 150, None)


def test_course_of_problem(spark):
    df = spark.createDataFrame([("block-v1:org+COURSE+run+type@problem+block@p",), ("short",)], "p string")
    assert rows(df.select(X.course_of_problem(F.col("p")))) == [("",), ("COURSE",)]


def test_last_row_indicator(spark):
    df = spark.createDataFrame([("s", 1, 5), ("s", 2, 5), ("s", 2, None), ("t", None, None)], "qas string, i int, stem int")
    out = is_last_row(df, ["qas"], ["i", "stem"], "last")
    assert rows(out, "qas", "i", "stem", "last") == sorted(
        [("s", 1, 5, 0), ("s", 2, 5, 0), ("s", 2, None, 1), ("t", None, None, 1)], key=repr)


def test_funnel(spark):
    log = spark.createDataFrame([("u1", 1, "i", 1), ("u1", 1, "i", 2), ("u2", 1, "i", 1)],
                                "user_ext_id string, course_id int, item_ext_id string, state int")
    members = spark.createDataFrame([("u1", "s"), ("u2", "s")], "user_ext_id string, session_id string")
    sessions = spark.createDataFrame([("s", "b")], "session_id string, branch_ext_id string")
    struc = spark.createDataFrame(
        [(1, "c", "b", "Original", 1, 1, 1, "item", "i", 1, "d", 1, None, None), (1, "c", "b", "Original", 1, 1, 2, "other", "j", 1, "d", 1, None, None)],
        "course_id int, cname string, bid string, bname string, m_ord int, l_ord int, i_ord int, i_name string, iid string, "
        "type_id int, descr string, graded int, strt timestamp_ntz, fin timestamp_ntz")
    out = Q.control_sum(N.progress_funnel(struc, N.progress(log, members, sessions)))
    assert rows(out, "i_name", "started", "completed", "total", "interact_cnt", "balanced") == [
        ("item", 1, 1, 2, 3, True), ("other", None, None, 0, None, True)]


def test_progress_counts_each_session_of_a_branch(spark):
    log = spark.createDataFrame([("u", 1, "i", 1)], "user_ext_id string, course_id int, item_ext_id string, state int")
    members = spark.createDataFrame([("u", "s1"), ("u", "s2")], "user_ext_id string, session_id string")
    sessions = spark.createDataFrame([("s1", "b"), ("s2", "b")], "session_id string, branch_ext_id string")
    assert rows(N.progress(log, members, sessions), "cnt") == [(2,)]


def test_missing_references(spark):
    tables = {"base": spark.createDataFrame([(1, 7), (3, 7)], "id int, kind int"),
              "linked": spark.createDataFrame([(1, 50), (10, 7), (2, 60), (None, 7)], "id int, kind int"),
              "whole": spark.createDataFrame([(1,)], "id int")}
    rules = [Q.ReferenceRule("base", "id", "linked"), Q.ReferenceRule("base", "kind", "linked"), Q.ReferenceRule("base", "id", "whole")]
    assert rows(Q.missing_references(tables, rules)) == [
        ("base", "id", "linked", "2,10"), ("base", "id", "whole", ""), ("base", "kind", "linked", "50,60")]
    assert Q.missing_rows(tables, rules).count() == 5


def test_step_signature_keeps_null_names(spark):
    steps = spark.createDataFrame([(1, 10, 0, "_order"), (1, 11, 1, "answer"), (1, 12, 2, None)],
                                  "qa_id int, qas_id int, qas_sequencenumber int, qasd_name string")
    r = Q.step_signatures(steps).first()
    assert (r.steps, r.sgnt, r.cnt) == (3, ["0:_order", "1:answer", "2:"], 1)


def test_key_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "id int, name string")
    assert rows(Q.duplicate_keys(df, ["id"])) == [(1, 2)]
    assert rows(Q.null_counts(df, ["id", "name"])) == [(0, 1)]


def test_first_rows_per_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 9)], "g string, n int")
    assert rows(first_n_per_group(df, ["g"], [F.col("n")], 2)) == [("a", 1), ("a", 2), ("b", 9)]


def test_offset_beyond_the_end_is_empty(spark):
    df = spark.range(5)
    assert after_offset(df, [F.col("id")], 7).count() == 0
    assert after_offset(df, [F.col("id")], 5).count() == 0
    assert rows(after_offset(df, [-F.col("id")], 3)) == [(0,), (1,)]
    ties = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "k int")
    assert rows(after_offset(ties, [F.col("k")], 2)) == [(1,), (1,), (2,)]
    assert rows(after_offset(ties, [F.col("k")], 4)) == [(2,)]
    assert after_offset(df, [F.col("id")], 0).count() == 5


def test_quartiles_add_up(spark):
    """weak + middle + strong is everything; ranks lie within 1..n."""
    df = spark.range(400).select(F.lit("g").alias("g"), (F.col("id") % 17).cast("double").alias("score"), F.col("id").alias("u"))
    ranked = rank_share(df, ["g"], ["score", "u"], bucket_rows=16)
    heat = mart_heat(ranked, ["g"], "u", "score").withColumn("d", discrimination()).first()
    middle = ranked.where((F.col("cd") >= 0.25) & (F.col("cd") <= 0.75)).count()
    assert heat.strong_denom + heat.weak_denom + middle == heat.cnt == 400
    assert heat.d > 0
    assert tuple(ranked.agg(F.min("rnk"), F.max("rnk")).first()) == (1, 400)


def test_filtered_step_signatures_read_kept_steps_from_files(spark):
    import suite.quality

    steps = spark.createDataFrame([(1, 11, 1, "answer"), (1, 12, 2, "_order"), (1, 13, 3, None), (2, 21, 1, "answer"), (3, 31, 1, "_order"), (4, 41, 1, None)],
                                  "qa_id BIGINT, qas_id BIGINT, qas_sequencenumber INT, qasd_name STRING")
    got = suite.quality.quality_step_signatures_filtered({"q_steps": steps})
    assert got.inputFiles() and all("kept-steps" in f for f in got.inputFiles())
    assert [tuple(r) for r in got.collect()] == [(3, ["1:answer", "2:_order", "3:"], 1, 1, 1)]
