"""Sinks, and whole runs from zipped exports to marts."""

import os
import zipfile

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quizlens.plans.export_load import Store, build_marts, load_exports, log_of_loads
from quizlens.sinks import tables as W
from quizlens.sinks.stage import shared_dir, stage


def test_upsert_fill_only_once_per_slug(spark):
    known = spark.createDataFrame([(1, "alg", None), (2, "geo", "g0"), (3, "old", None)], "id int, slug string, ext_id string")
    new = spark.createDataFrame([("alg", "a1"), ("alg", "a2"), ("geo", "g1"), ("top", "t1")], "slug string, ext_id string")
    assert rows(W.upsert_fill(new, known, "slug", "ext_id"), "slug", "ext_id", "id") == sorted(
        [("alg", "a1", 1), ("alg", "a2", None), ("geo", "g0", 2), ("geo", "g1", None), ("old", None, 3), ("top", "t1", None)], key=repr)


def test_upsert_ignore(spark):
    known = spark.createDataFrame([(1, "a")], "id int, descr string")
    new = spark.createDataFrame([(1, "b"), (2, "c"), (2, "c")], "id int, descr string")
    assert rows(W.upsert_ignore(new, known, ["id"])) == [(1, "a"), (2, "c")]


def test_update_from_with_null_keys(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 5, "y")], "i int, stem int, v string")
    source = spark.createDataFrame([(1, None, "new")], "i int, stem int, v string")
    assert rows(W.update_from(df, source, ["i", "stem"], "v", null_as_zero=True), "i", "v") == [(1, "new"), (2, None)]


def test_literal_rows_and_copy(spark, tmp_path):
    W.append_rows(spark, [(1, "a")], "id INT, name STRING", str(tmp_path / "t"))
    W.append_rows(spark, [(2, "b")], "id INT, name STRING", str(tmp_path / "t"))
    W.copy_table(spark.read.parquet(str(tmp_path / "t")), str(tmp_path / "copy"))
    assert rows(spark.read.parquet(str(tmp_path / "copy"))) == [(1, "a"), (2, "b")]
    W.drop_table(spark, "no_such_table")


def test_report_isolates_failures(spark, tmp_path):
    report = W.RunReport(spark)
    assert not report.write("bad", spark.range(3).select(F.raise_error(F.lit("boom")).alias("x")), lambda d: d.write.format("noop").mode("overwrite").save())
    assert report.write("good", spark.range(3), lambda d: W.write_table(d, str(tmp_path / "g")))
    got = {r.step: (r.n, r.error) for r in report.frame().collect()}
    assert got["good"] == (3, None) and got["bad"][0] is None and "boom" in got["bad"][1]


def test_stage_uses_the_shared_folder(spark):
    staged = stage(spark.range(5), "t")
    assert staged.count() == 5
    assert all(shared_dir(spark) in f for f in staged.inputFiles())


def test_shared_folder_must_be_named_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"
        folder = None

        def getCheckpointDir(self):
            return self.folder

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        shared_dir(Session())
    Session.sparkContext.folder = "hdfs:///checkpoints/"
    assert shared_dir(Session()) == "hdfs:///checkpoints"
    Session.conf = {"spark.checkpoint.dir": "hdfs:///shared"}
    assert shared_dir(Session()) == "hdfs:///shared"


def export(folder, name, slug, users, escape=""):
    """A small course: one graded item with a two-question test, and a session."""
    answers = [(u, q, s) for u, scores in users.items() for q, s in zip(("q1", "q2"), scores)]
    files = {
        "course_item_types": "course_item_type_id,course_item_type_desc,course_item_type_category,course_item_type_graded,atom_content_type_id\n6,exam,quiz,t,1\n1,lecture,video,f,2\n",
        "assessment_types": "assessment_type_id,assessment_type_desc\n7,summative\n5,formative\n",
        "assessment_question_types": "assessment_question_type_id,assessment_question_type_desc\n1,mcq\n",
        "courses": f'course_id,course_slug,course_name,course_desc\nc-{slug},{slug},"Course \\"{slug}\\"",\n',
        "course_branches": f"course_id,course_branch_id,authoring_course_branch_name,authoring_course_branch_created_ts\nc-{slug},b-{slug},,2020-01-01 00:00:00\n",
        "course_branch_modules": f"course_branch_id,course_module_id,course_branch_module_order,course_branch_module_name,course_branch_module_desc\nb-{slug},m,0,Module,\n",
        "course_branch_lessons": f"course_branch_id,course_lesson_id,course_module_id,course_branch_lesson_order,course_branch_lesson_name\nb-{slug},l,m,0,Lesson\n",
        "course_branch_items": f"course_branch_id,course_item_id,course_lesson_id,course_branch_item_order,course_item_type_id,course_branch_item_name,course_branch_item_optional\nb-{slug},exam,l,0,6,Exam,f\nb-{slug},video,l,1,1,Video,f\n",
        "assessments": "assessment_id,assessment_type_id,assessment_update_ts,assessment_passing_fraction\na,7,2020-01-02 00:00:00,\n",
        "assessment_questions": 'assessment_question_id,assessment_question_type_id,assessment_question_prompt,assessment_question_update_ts\nq1,1,"first\nquestion",2020-01-03 00:00:00\nq2,1,second,\n',
        "course_branch_item_assessments": f"course_branch_id,course_item_id,assessment_id\nb-{slug},exam,a\n",
        "assessment_assessments_questions": "assessment_id,assessment_question_id,assessment_question_internal_id,assessment_question_cuepoint,assessment_question_order,assessment_question_weight\na,q1,i1,,0,1\na,q2,i2,,1,1\n",
        "assessment_options": "assessment_option_id,assessment_question_id,assessment_option_display,assessment_option_feedback,assessment_option_correct,assessment_option_index\n"
                              "0.11111111999,q1,yes,,t,0\n0.22222222999,q1,no,,f,1\no3,q2,yes,,t,0\n",
        "on_demand_sessions": f"course_id,s,a,b,c,branch\nc-{slug},s1,2020-02-01 00:00:00,2020-03-01 00:00:00,,b-{slug}\n",
        "on_demand_session_memberships": f"course_id,s,u,a,b\nc-{slug},s1,u1,2020-02-01 00:00:00,\n",
        "assessment_actions": "h1,h2,h3,h4,h5,h6,h7,h8,h9,partner_user_id\n" + "".join(
            f"x{u},x{u},a,,,0,2020-02-02 00:10:00,2020-02-02 00:00:00,,{u}\n" for u in users),
        "assessment_responses": "r,a,x,v,q,s,w\n" + "".join(f"r{u}{q},a,x{u},0,{q},{s},{s}\n" for u, q, s in answers),
        "assessment_response_options": "r,o,c,f,s\n" + "".join(
            f"r{u}q1,0.11111111000,t,,{'t' if scores[0] else 'f'}\nr{u}q1,0.22222222000,f,,{'f' if scores[0] else 't'}\n"
            for u, scores in users.items()),
    }
    with zipfile.ZipFile(os.path.join(folder, name), "w") as z:
        for member, text in files.items():
            z.writestr(f"{member}.csv", text)


def test_exports_to_marts(spark, tmp_path):
    folder, store = tmp_path / "in", Store(spark, str(tmp_path / "store"))
    folder.mkdir()
    export(folder, "one.zip", "alg", {"u1": (1, 1), "u2": (0, 0), "u3": (1, 0), "u4": (1, 1)})
    (folder / "broken.zip").write_bytes(b"no zip")
    report = load_exports(store, str(folder))
    assert store.rejects().count() == 0
    assert [r[1] for r in rows(report.rejects())] == ["broken"]
    assert report.frame().where("error is not null").count() == 0
    assert rows(store.table("course"), "slug", "name") == [("alg", 'Course "alg"')]
    assert store.table("item").count() == 2 and store.table("q_option").count() == 3
    assert rows(store.table("q_option"), "ext_id") == [("0.11111111",), ("0.22222222",), ("o3",)]
    assert store.table("caq_event").count() == 8 and store.table("cqo_event").count() == 8

    built = build_marts(store)
    assert built.frame().where("error is not null").count() == 0
    heat = {r.question_ext_id: r for r in store.table("mart_heat").collect()}
    assert (heat["q1"].cnt, heat["q1"].tot_num, heat["q1"].tot_denom, heat["q1"].max_aqord1) == (4, 3.0, 4, 2)
    assert heat["q1"].prompt == "first\nquestion" and heat["q2"].q_update_ts is None
    # shares by user: u2 .25, u3 .5, u1 .75, u4 1
    assert (heat["q1"].strong_num, heat["q1"].strong_denom, heat["q1"].weak_num, heat["q1"].weak_denom) == (1.0, 1, 0.0, 0)
    test = store.table("mart_str").first()
    assert (test.cnt, test.cnt_user, test.k_min, test.k_max, test.max_aqord1) == (4, 4, 2, 2, 2)
    ssi2, sx2 = 0.25 + 1 / 3, 11 / 12
    assert test.ssi2 == pytest.approx(ssi2) and test.sx2 == pytest.approx(sx2)
    assert test.mn_reliab == pytest.approx((1 - ssi2 / (sx2 + 0.001)) / (1 - 1 / 2.001))
    aud = {(r.question_ext_id, r.q_o_ext_id): r for r in store.table("mart_aud").collect()}
    yes = aud[("q1", "0.11111111")]
    assert (yes.cnt, yes.user_cnt, yes.strong_num, yes.strong_denom, yes.weak_num, yes.weak_denom) == (4, 4, 1, 1, 0, 0)
    assert aud[("q2", "o3")].strong_num == 0

    # a second run finds everything loaded; a new archive is added without touching the first
    load_exports(store, str(folder))
    assert store.table("caq_event").count() == 8
    assert build_marts(store).steps == []
    export(folder, "two.zip", "geo", {"u9": (1, 0)})
    load_exports(store, str(folder))
    again = build_marts(store)
    assert {s[0]: s[1] for s in again.steps} == {"str": 1, "heat": 2, "aud": 3}
    assert store.table("mart_heat").count() == 4 and store.table("course").count() == 2


def test_bad_values_are_rejected_and_listed(spark, tmp_path):
    folder, store = tmp_path / "in", Store(spark, str(tmp_path / "store"))
    folder.mkdir()
    export(folder, "one.zip", "alg", {"u1": (1, "much"), "u2": (0, 0), "u3": (1, 0)})
    assert load_exports(store, str(folder)).frame().where("error is not null").count() == 0
    listed = store.rejects()
    assert rows(listed, "step", "archive", "member", "line", "column_name", "text") == sorted([
        ("caq_event", "one", "assessment_responses.csv", 2, "assessment_response_score", "much"),
        ("caq_event", "one", "assessment_responses.csv", 2, "assessment_response_weighted_score", "much")])
    assert store.table("caq_event").where("question_ext_id is not null").count() == 5


def test_only_new_courses_are_built_from_their_own_loads(spark, tmp_path):
    folder, store = tmp_path / "in", Store(spark, str(tmp_path / "store"))
    folder.mkdir()
    export(folder, "one.zip", "alg", {"u1": (1, 1), "u2": (0, 1)})
    export(folder, "none.zip", "empty", {})
    load_exports(store, str(folder))
    build_marts(store)
    # the course without any answer has no row in a mart and is not built again
    assert build_marts(store).steps == []
    loads = [r[0] for r in store.table("course").where("slug = 'alg'").select("load_id").collect()]
    for name in ("caq_event", "cqo_event"):
        log = log_of_loads(store.table(name), loads)
        plan = log._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "load_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert len({f.split("load_id=")[1].split("/")[0] for f in log.inputFiles()}) <= 2 and log.count() == 4
