"""Typed loads with a reject stream, line numbers of files read in blocks, and rejects of the tracking log."""

import gzip
import json
import zipfile

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quizlens.operators import submissions as S
from quizlens.sources import archives as A
from quizlens.sources import files as R
from quizlens.sources import typed as L
import suite.files
from suite.registry import Tables

SCHEMA = "id INT, price DOUBLE, day DATE, name STRING, ok BOOLEAN"


def test_archive_records_are_rows_or_rejects(spark, tmp_path):
    lines = ["id,price,day,name,ok", "1,2.5,2020-01-01,a,true", "x,2.5,2020-13-01,b,true", "3,,,,", '4,1,2020-01-02,"two\nlines",false', "5,1", "6,much,2020-01-01,c,perhaps", "7,1,2020-01-01,d,true,more"]
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("t.csv", "\n".join(lines) + "\n")
    with zipfile.ZipFile(tmp_path / "other.zip", "w") as z:
        z.writestr("u.csv", "id\n1\n")
    load = L.load_archives(spark, str(tmp_path), "t.csv", SCHEMA)
    assert rows(load.rows, "id", "name", "ok", "archive") == [(1, "a", True, "one"), (3, None, None, "one"), (4, "two\nlines", False, "one")]
    assert rows(load.rejected, "line", "column_name", "text", "reason") == sorted([
        (2, "id", "x", "not a int"), (2, "day", "2020-13-01", "not a date"), (5, None, "5,1", L.FIELDS), (6, "price", "much", "not a double"),
        (6, "ok", "perhaps", "not a boolean"), (7, None, "7,1,2020-01-01,d,true,more", L.FIELDS)], key=repr)
    assert rows(load.failed, "archive") == [("other",)]
    assert load.rows.count() + load.rejected.select("archive", "member", "line").distinct().count() == 7


def test_numbers_of_records_over_many_batches(spark, tmp_path, monkeypatch):
    lines = [f"{i},{'bad' if i % 11 == 0 else i},2020-01-01,{'x' * 40},true" + (",more" if i % 7 == 0 else "") for i in range(1, 3001)]
    with zipfile.ZipFile(tmp_path / "one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("t.csv", "id,price,day,name,ok\n" + "\n".join(lines) + "\n")
    monkeypatch.setattr("quizlens.sources.archives.BLOCK_BYTES", 4000)
    load = L.load_archives(spark, str(tmp_path), "t.csv", SCHEMA)
    wrong = {(i, L.FIELDS) for i in range(1, 3001) if i % 7 == 0} | {(i, "not a double") for i in range(1, 3001) if i % 11 == 0 and i % 7}
    assert {(r.line, r.reason) for r in load.rejected.collect()} == wrong
    assert load.rows.count() == 3000 - len(wrong)


def test_one_large_member_is_parsed_in_blocks_cut_at_ends_of_records(spark, tmp_path, monkeypatch):
    lines = [f'{i},{"?" if i % 10 == 3 else i},2020-01-01,"a ""{i}""\n\\"b\\", c",true' + (",more" if i % 7 == 0 else "") for i in range(1, 301)]
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as z:
        z.writestr("t.csv", "id,price,day,name,ok\n" + "\n".join(lines))
    monkeypatch.setattr("quizlens.sources.archives.TEXT_BYTES", 500)
    files = R.list_files(spark, str(tmp_path), ".zip")
    blocks = A.read_members(files, "t.csv", SCHEMA, numbered=True).groupBy(A.BLOCK).count().collect()
    assert len(blocks) > 10 and max(b["count"] for b in blocks) < 60
    load = L.load_members(files, "t.csv", SCHEMA)
    wrong = {(i, L.FIELDS) for i in range(1, 301) if i % 7 == 0} | {(i, "not a double") for i in range(1, 301) if i % 10 == 3 and i % 7}
    assert {(r.line, r.reason) for r in load.rejected.collect()} == wrong
    assert rows(load.rows, "id", "name") == sorted([(i, f'a "{i}"\n"b", c') for i in range(1, 301) if i % 7 and i % 10 != 3], key=repr)


@pytest.mark.parametrize("packed", [False, True])
def test_csv_records_are_rows_or_rejects(spark, tmp_path, packed):
    lines = ["id;price;day;name;ok"] + [f"{i};{'?' if i % 10 == 3 else i};2020-01-01;n{i};true" if i % 10 else f"{i};1" for i in range(1, 201)]
    text = "\n".join(lines) + "\n"
    path = tmp_path / ("a.csv.gz" if packed else "a.csv")
    path.write_bytes(gzip.compress(text.encode()) if packed else text.encode())
    load = L.load_csv(spark, str(path), SCHEMA, sep=";")
    wrong = [(i, None, f"{i};1", L.FIELDS) for i in range(10, 201, 10)] + [(i, "price", "?", "not a double") for i in range(3, 201, 10)]
    assert rows(load.rejected, "line", "column_name", "text", "reason") == sorted(wrong, key=repr)
    assert rows(load.rows, "id") == sorted([(i,) for i in range(1, 201) if i % 10 not in (0, 3)], key=repr)


def test_empty_and_clean_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n")
    load = L.load_csv(spark, str(tmp_path / "a.csv"), "id INT, name STRING")
    assert load.rows.count() == 0 and load.rejected.count() == 0
    (tmp_path / "b.csv").write_text("name\nany text\n")
    load = L.load_csv(spark, str(tmp_path / "b.csv"), "name STRING")
    assert rows(load.rows) == [("any text", "b.csv")] and load.rejected.count() == 0


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "3000")
    yield
    spark.conf.set(key, old)


def test_lines_of_a_log_read_in_blocks_keep_their_numbers(spark, tmp_path, small_splits):
    for name, n in (("a.log", 900), ("b.log", 5), ("c.log", 400)):
        (tmp_path / name).write_text("".join(json.dumps({"username": f"{name}-{i}", "event_type": "problem_check", "event_source": "server", "time": f"{i}"}) + "\n" for i in range(1, n + 1)))
    with gzip.open(tmp_path / "d.log.gz", "wt") as out:
        out.writelines(json.dumps({"username": f"d.log.gz-{i}"}) + "\n" for i in range(1, 301))
    log = R.read_event_log(spark, str(tmp_path))
    assert log.rdd.getNumPartitions() > 10
    got = {(r.archive, r.line_no, r.username) for r in log.collect()}
    assert got == {(name, i, f"{name}-{i}") for name, n in (("a.log", 900), ("b.log", 5), ("c.log", 400), ("d.log.gz", 300)) for i in range(1, n + 1)}
    first = S.problem_checks(log, per_archive=7)
    assert rows(first, "archive", "line_no") == sorted([(a, i) for a in ("a.log", "c.log") for i in range(1, 8)] + [("b.log", i) for i in range(1, 6)], key=repr)


def test_rejects_of_the_log(spark, tmp_path):
    def line(time="2020-04-10T04:10:56.1+00:00", **questions):
        return json.dumps({"username": "u", "event_type": "problem_check", "event_source": "server", "time": time, "context": {}, "event": {"submission": questions}})

    good = {"input_type": "choicegroup", "choices_map": {"c0": "a"}, "choice_correct": ["c0"], "answer_correct": ["a"], "choice": "c0", "answer": "a"}
    lines = [line(q=good), "no json", line(time="yesterday", q=good), line(time=None, q=good), line(time="2019-01-01T00:00:00", q={"input_type": "odd"}),
             line(), line(q1={"input_type": "odd"}, q2={}, q3={"input_type": "textline", "answer_correct": []}, q4={"input_type": "optioninput"}, q5=good),
             line(q=good | {"choices_map": {}}), json.dumps({"username": "u", "event_type": "other"})]
    (tmp_path / "a.log").write_text("\n".join(lines) + "\n")
    log = R.read_event_log(spark, str(tmp_path))
    since = "2020-01-01 00:00:00"
    assert rows(S.log_rejects(log, since), "line_no", "question_id", "reason", "text") == sorted([
        (2, None, "unreadable line", "no json"), (3, None, "bad time", "yesterday"), (4, None, "bad time", None), (6, None, "no questions", None),
        (7, "q1", "unknown kind", "odd"), (7, "q2", "unknown kind", None), (7, "q3", "no options", "textline"), (7, "q4", "no options", "optioninput"),
        (8, "q", "no options", "choicegroup")], key=repr)
    assert {r.line_no for r in S.flatten_submissions(log, since).collect()} == {1, 7}
    assert S.log_counters(log).first().bad_times == 2
    assert {(r.line_no, r.reason) for r in S.log_rejects(log).collect()} >= {(2, "unreadable line"), (5, "unknown kind")}


def test_written_log_files_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(suite.files, "log_lines", lambda t: spark.range(0, 1000, 1, 2).select(F.to_json(F.struct(F.lit("problem_publish").alias("event_type"), "id")).alias("value")))
    monkeypatch.setattr(suite.files, "LOG_FILE_LINES", 150)
    per_file = suite.files.read_log(Tables(spark, "")).groupBy("archive").agg(F.count(F.lit(1)).alias("n"), F.max("line_no").alias("last")).collect()
    assert sum(r["n"] for r in per_file) == 1000 and len(per_file) == 8
    assert all(r["n"] == r["last"] <= 150 for r in per_file)
