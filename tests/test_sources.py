"""Readers on archives and files made here."""

import gzip
import io
import json
import os
import tarfile
import zipfile

from helpers import rows
from pyspark.sql import functions as F

from quizlens.operators import submissions as S
from quizlens.operators.testbank import extract_test_bank, listed_options, rejected_elements
from quizlens.operators.tree import build_tree, parse_structure
from quizlens.sinks import tables as W
from quizlens.sources import archives as A
from quizlens.sources import files as R


def zipped(folder, name, **members):
    with zipfile.ZipFile(os.path.join(folder, name), "w", zipfile.ZIP_DEFLATED) as z:
        for member, text in members.items():
            z.writestr(f"{member}.csv", text)


def test_csv_with_escapes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('id,prompt\n1,"say \\"yes\\", then\nstop"\n2,plain\n')
    out = R.read_csv(spark, str(path), "id INT, prompt STRING")
    assert rows(out) == [(1, 'say "yes", then\nstop'), (2, "plain")]


def test_archive_csv_by_name_position_and_errors(spark, tmp_path):
    zipped(tmp_path, "one.zip", q='id,prompt,extra\n1,"a \\"b\\"\nc",x\n2,,y\n')
    zipped(tmp_path, "two.zip", q="prompt,id\nz,3\n")
    zipped(tmp_path, "none.zip", other="id\n1\n")
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    (tmp_path / "skip.txt").write_text("x")
    out = A.read_archive_csv(spark, str(tmp_path), "q.csv", "id INT, prompt STRING, graded BOOLEAN")
    assert rows(A.readable_rows(out), "archive", "id", "prompt", "graded") == [
        ("one", 1, 'a "b"\nc', None), ("one", 2, None, None), ("two", 3, "z", None)]
    assert [r[0] for r in rows(A.failed_archives(out))] == ["broken", "none"]
    by_place = A.read_archive_csv(spark, str(tmp_path / "two.zip"), "q.csv", "first STRING, second INT", by="position")
    assert rows(by_place, "first", "second", "archive") == [("z", 3, "two")]


def test_listing(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(b"12345")
    (tmp_path / "b.txt").write_bytes(b"1")
    assert rows(R.list_files(spark, str(tmp_path), ".zip"), "name", "length") == [("a.zip", 5)]
    lists = tmp_path / "list"
    lists.mkdir()
    (lists / "log.txt").write_text("https://files.example.org/x/a.zip\r\nhttps://files.example.org/x/late.zip\n\n")
    assert rows(R.sizes_of_listed(spark, str(lists), str(tmp_path))) == [("a.zip", 5), ("late.zip", None)]


def test_renamed_columns(spark, tmp_path):
    (tmp_path / "c.csv").write_text("n;t;e\n1;name;ext\n")
    assert R.read_renamed_csv(spark, str(tmp_path / "c.csv"), "a INT, b STRING, c STRING", ["id", "name", "ext_id"]).first().asDict() == {
        "id": 1, "name": "name", "ext_id": "ext"}


def check(submission, **more):
    return {"username": "u", "event_type": "problem_check", "event_source": "server",
            "time": "2020-04-10T04:10:56.174582+00:00", "context": {"user_id": 5, "course_id": "c"},
            "event": {"problem_id": "p", "attempts": 1, "grade": 1.0, "max_grade": 2.0, "success": "correct",
                      "submission": submission}} | more


def log_of(spark, tmp_path, *lines, name="a.gz"):
    with gzip.open(tmp_path / name, "wt", encoding="utf-8") as out:
        for line in lines:
            out.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
    return R.read_event_log(spark, str(tmp_path / name))


def test_checkbox_group(spark, tmp_path):
    q = {"q1": {"input_type": "checkboxgroup", "response_type": "choiceresponse", "question": "two\nlines", "correct": False,
                "choices_map": {"c0": "zero", "c1": "one", "c2": "two"}, "choice_correct": ["c0", "c1", "c1"],
                "answer_correct": ["A", "B", "C"], "choice": ["c1", "c2"], "answer": ["x", "y"]}}
    out = S.flatten_submissions(log_of(spark, tmp_path, check(q)))
    assert rows(out, *S.OPTION) == [("c0", "zero", True, False, "A", ""), ("c1", "one", True, True, "C", "x"),
                                    ("c2", "two", False, True, "", "y")]
    assert out.first().question_txt == "two\nlines" and out.first().user_id == 5


def test_choice_group(spark, tmp_path):
    q = {"q1": {"input_type": "choicegroup", "response_type": "m", "question": "two\nlines", "correct": True,
                "choices_map": {"c0": "zero", "c1": "one"}, "choice_correct": ["c1"], "answer_correct": ["one"],
                "choice": "c1", "answer": "one"}}
    out = S.flatten_submissions(log_of(spark, tmp_path, check(q)))
    assert rows(out, *S.OPTION) == [("c0", "zero", False, False, "", ""), ("c1", "one", True, True, "one", "one")]
    assert out.first().question_txt == "two lines"


def test_other_inputs_and_rejects(spark, tmp_path):
    option = {"input_type": "optioninput", "response_type": "o", "question": "q", "correct": True,
              "answers_available": ["a", "b"], "answer_correct": ["b"], "answer": "b"}
    formula = {"input_type": "formulaequationinput", "response_type": "n", "question": "q", "correct": False,
               "answer": "7", "answer_correct": ["8", "9"]}
    text = {"input_type": "textline", "response_type": "s", "question": "q", "correct": True, "answer": "hi",
            "answer_correct": ["hi", "hello"]}
    odd = {"input_type": "drawing", "response_type": "d", "question": "q", "correct": True}
    log = log_of(spark, tmp_path, check({"q1": option}), check({"q2": formula}), check({"q3": text}), check({"q4": odd}),
                 "no json {", check({}, event_type="problem_publish", event="text"), check({"q5": text}, event_source="browser"))
    out = S.flatten_submissions(log)
    assert rows(out.where("question_id = 'q1'"), "choice_txt", "option_correct", "option_selected") == [
        ("a", False, False), ("b", True, True)]
    assert out.where("question_id = 'q1'").select("choice_id").distinct().count() == 2
    assert rows(out.where("question_id = 'q2'"), *S.OPTION) == [(None, "7", None, None, "8", ""), (None, "7", None, None, "9", "")]
    assert rows(out.where("question_id = 'q3'"), *S.OPTION) == [(None, "hi", True, False, "hello", ""), (None, "hi", True, True, "hi", "")]
    assert rows(S.unknown_inputs(log), "question_id", "input_type") == [("q4", "drawing")]
    assert rows(S.log_counters(log)) == [("a.gz", 7, 4, 0, 1)]
    assert rows(S.checks_per_file(log)) == [("a.gz", 4)]
    assert S.publish_times(log).count() == 1
    assert rows(S.input_profile(log)) == [("drawing|d",), ("formulaequationinput|n",), ("optioninput|o",), ("textline|s",)]
    assert S.submissions_as_json(log).count() == 4


def test_cut_off_and_cap(spark, tmp_path):
    q = {"q": {"input_type": "textline", "question": "Привет", "correct": True, "answer": "a", "answer_correct": ["a"]}}
    log = log_of(spark, tmp_path, check(q, username="old", time="2020-04-01T00:00:00.1+00:00"), check(q, username="edge", time="2020-04-10T00:00:00.9+00:00"),
                 check(q, username="n1"), check(q, username="n2"), check(q, username="n3"))
    assert rows(S.flatten_submissions(log, since="2020-04-10 00:00:00"), "username") == [("n1",), ("n2",), ("n3",)]
    assert rows(S.flatten_submissions(log, since="2020-04-10 00:00:00", per_archive=2, spread=4), "username") == [("n1",), ("n2",)]
    assert "Привет" in S.submissions_as_json(log).first().submission


XML = """<problem><p>Intro</p><label>Pick</label>
<multiplechoiceresponse><label>inner</label><choicegroup><choice correct="true">yes</choice><compoundhint>h</compoundhint>
<choice>no</choice></choicegroup></multiplechoiceresponse>
<choiceresponse><checkboxgroup><choice correct="false">c</choice></checkboxgroup></choiceresponse>
<optionresponse><optioninput options="('a, b','it''s',c)" correct="it's"/></optionresponse>
<h3>Say</h3><stringresponse answer="low"><additional_answer answer="lower"/><textline/></stringresponse>
<numericalresponse answer="4"><formulaequationinput/></numericalresponse>
<div><stringresponse answer="deep"/></div></problem>"""


def test_test_bank_from_archives(spark, tmp_path):
    with tarfile.open(tmp_path / "ALG.tar.gz", "w:gz") as tar:
        for name, text in (("course/problem/p1.xml", XML), ("course/problem/p2.xml", "<problem><problem/>"),
                           ("course/html/x.xml", "<a/>")):
            data = text.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    (tmp_path / "BAD.tar.gz").write_bytes(b"broken")
    docs = A.read_problem_xml(spark, str(tmp_path))
    assert rows(docs.where("xml is not null"), "course", "problem") == [("ALG", "p1"), ("ALG", "p2")]
    assert [r[0] for r in rows(A.failed_archives(docs, "course"))] == ["BAD"]
    out = extract_test_bank(docs)
    got = rows(out, "question_id", "input_type", "choice_txt", "option_correct")
    assert got == sorted([
        ("p1_2_1", "choicegroup", "yes", "true"), ("p1_2_1", "choicegroup", "no", ""), ("p1_3_1", "checkboxgroup", "c", "false"),
        ("p1_4_1", "optioninput", "a, b", "false"), ("p1_4_1", "optioninput", "it's", "true"), ("p1_4_1", "optioninput", "c", "false"),
        ("p1_5_1", "textline", "low", ""), ("p1_5_1", "textline", "lower", ""), ("p1_6_1", "formulaequationinput", "4", "")], key=repr)
    texts = {r.question_id: r.question_txt for r in out.collect()}
    assert texts["p1_2_1"] == "Intro\nPick\ninner" and texts["p1_3_1"] == "" and texts["p1_5_1"] == "Say\n"
    assert rows(out.where("question_id = 'p1_2_1'"), "choice_id") == [("choice_0",), ("choice_1",)]
    assert rows(rejected_elements(docs), "problem", "reject", "tag") == [
        ("p1", "nested response not read", "stringresponse"), ("p1", "no correct attribute", "choice"), ("p2", "document not parsed", None)]


def test_listed_options():
    assert listed_options("('a','b')") == ["a", "b"]
    assert listed_options('("x, y",z)') == ["x, y", "z"]


def locator(kind, name):
    return f"block-v1:org+C1+run+type@{kind}+block@{name}"


def test_structure_file_to_tree(spark, tmp_path):
    lines = [
        ["0", locator("chapter", "ch"), locator("sequential", "s1"), locator("vertical", "v1"), locator("problem", "i1"), "Chapter", "First", "V", "I"],
        ["0", locator("chapter", "ch"), locator("sequential", "s2"), locator("vertical", "v1"), locator("html", "i2"), "Later name", "Second", "V2", ""],
        ["0", locator("chapter", "x").replace("C1", "C9"), locator("sequential", "y"), locator("vertical", "z"), locator("html", "w"), "a", "b", "c", "d"],
    ]
    with gzip.open(tmp_path / "s.csv.gz", "wt") as out:
        out.write("\n".join(";".join(line) for line in lines) + "\n")
    course = spark.createDataFrame([(1, "org+C1+run", "Course")], "id int, ext_id string, name string")
    parsed = parse_structure(R.read_structure_csv(spark, str(tmp_path)), keep=["line_no"])
    tree = build_tree(parsed, course)
    assert rows(tree["chapter"], "ext_id", "name", "course_id") == [("ch", "Chapter", 1)]
    assert rows(tree["sequential"], "ext_id", "name") == [("s1", "First"), ("s2", "Second")]
    assert rows(tree["item"], "ext_id", "item_type", "name") == [("i1", "problem", "I"), ("i2", "html", "none")]
    v = tree["vertical"].join(tree["sequential"].withColumnRenamed("id", "sequential_id").select("sequential_id", F.col("ext_id").alias("s")), "sequential_id")
    assert rows(v, "ext_id", "s") == [("v1", "s1")]


def test_existing_nodes_are_kept(spark):
    raw = spark.createDataFrame([(1, locator("chapter", "ch"), locator("sequential", "s"), locator("vertical", "v"), locator("problem", "i"), "new", "S", "V", "I")],
                                "line_no int, c1 string, c2 string, c3 string, c4 string, c5 string, c6 string, c7 string, c8 string")
    course = spark.createDataFrame([(1, "org+C1+run", "Course")], "id int, ext_id string, name string")
    old = {"chapter": spark.createDataFrame([(77, "ch", 1, "old")], "id bigint, ext_id string, course_id bigint, name string")}
    tree = build_tree(parse_structure(raw, keep=["line_no"]), course, old)
    assert rows(tree["chapter"], "id", "name") == [(77, "old")]
    assert rows(tree["sequential"], "chapter_id") == [(77,)]


def test_code_page_of_an_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "Верно"), (2, "Неверно; нет"), (3, None)], "id INT, answer STRING")
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    W.export_csv(df.coalesce(1), str(tmp_path / "out"), encoding="windows-1251")
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == before
    part = next((tmp_path / "out").glob("*.csv"))
    assert part.read_bytes().decode("cp1251").splitlines() == ["id;answer", "1;Верно", '2;"Неверно; нет"', "3;"]
