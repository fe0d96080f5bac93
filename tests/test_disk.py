"""What runs leave on disk: archives put together from deflated pieces, shuffle files and staged tables that go when they have been read."""

import os
import zipfile
import zlib

from helpers import rows
from pyspark.sql import functions as F

from quizlens.plans import quiz as plans
from quizlens.sinks import archives as Z
from quizlens.sinks import tables as W
from quizlens.sinks.stage import FREED, at_once, freed_shuffles, shared_dir, stage, temporary
from quizlens.sources import archives as A
from quizlens.sources import typed as L
from quizlens.sources.files import list_files
from suite import load_all
from suite import quiz as Q
from suite.registry import ROLES, STORED, Tables

load_all()


def shuffle_files(spark):
    disk = spark._jsc.sc().env().blockManager().diskBlockManager()
    return {f for d in disk.localDirsString() for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def pieces(spark):
    top = f"{shared_dir(spark)}/quizlens".removeprefix("file://")
    return {d for d in os.listdir(top) if d.startswith("pieces-")} if os.path.isdir(top) else set()


def test_archives_of_pieces_are_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Z, "PIECE_BYTES", 300)
    lines = [(load, m, 1, f"{load},{m},{i},ünï {i * 7919 % 1000}") for load in (1, 2, None) for m in (0, 1) for i in range(900)]
    lines += [(load, m, 0, "a,b,c,d") for load in (1, 2) for m in (0, 1)] + [(None, m, 0, "a,b,c,d") for m in (0, 1)]
    df = spark.createDataFrame(lines, "load BIGINT, number INT, place INT, line STRING").repartition(5)
    before = pieces(spark)
    Z.write_zips(df, str(tmp_path), ["first.csv", "second.csv"])
    assert pieces(spark) == before
    assert sorted(os.listdir(tmp_path)) == ["load1.zip", "load2.zip", "loadNone.zip"]
    for load in (1, 2, None):
        with zipfile.ZipFile(tmp_path / f"load{load}.zip") as archive:
            assert archive.testzip() is None and archive.namelist() == ["first.csv", "second.csv"]
            for m, name in enumerate(archive.namelist()):
                text = archive.read(name).decode()
                assert text.startswith("a,b,c,d\n") and text.endswith("\n")
                assert sorted(text.splitlines()[1:]) == sorted(t for ld, n, p, t in lines if (ld, n, p) == (load, m, 1))


def test_joined_crc():
    a, b = b"first part, ", os.urandom(70_001)
    assert Z.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert Z.joined_crc(0, zlib.crc32(b), len(b)) == zlib.crc32(b) and Z.joined_crc(zlib.crc32(a), 0, 0) == zlib.crc32(a)


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    before, setting = shuffle_files(spark), spark.conf.get(FREED, None)
    df = spark.range(1000).withColumn("k", F.col("id") % 3).repartition(4, "id")
    staged = stage(df)
    W.write_table(df, str(tmp_path / "t"))
    W.overwrite_partitions(df, str(tmp_path / "p"), ["k"])
    assert not shuffle_files(spark) - before
    assert staged.count() == 1000
    with freed_shuffles(spark), freed_shuffles(spark):
        assert spark.conf.get(FREED) == "true"
    assert spark.conf.get(FREED, None) == setting


def test_temporary_tables_go_with_their_run(spark):
    with temporary(spark):
        gone, kept = stage(spark.range(3), "gone"), stage(spark.range(4), "kept", keep=True)
        inner = at_once(spark, [lambda n=n: stage(spark.range(n), "inner") for n in (1, 2)])
        assert [d.count() for d in (gone, kept, *inner)] == [3, 4, 1, 2]
        files = [f for d in (gone, *inner) for f in d.inputFiles()]
    assert kept.count() == 4 and not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_few_partitions_are_written_without_a_shuffle(spark, tmp_path):
    df = spark.range(100, numPartitions=2).withColumn("k", F.col("id") % 2)
    for _ in range(2):
        W.overwrite_partitions(df, str(tmp_path / "t"), ["k"], few=True, compression="zstd")
    files = [f for _, _, names in os.walk(tmp_path / "t") for f in names if f.endswith(".parquet")]
    assert len(files) == 4 and all(f.endswith(".zstd.parquet") for f in files)
    assert rows(spark.read.parquet(str(tmp_path / "t")), "id", "k") == rows(df.select("id", F.col("k").cast("int")))


def test_right_records_are_staged_without_their_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("quizlens.sources.archives.TEXT_BYTES", 200)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("t.csv", "n,s\n" + "".join(f"{'x' if i in (40, 77) else i},text {i}\n" if i != 60 else "1,2,3\n" for i in range(1, 101)))
    load = L.load_members(list_files(spark, str(tmp_path), ".zip"), "t.csv", "n INT, s STRING")
    assert load.rows.count() == 97
    assert rows(load.rejected, "line", "reason") == sorted([(40, "not a int"), (77, "not a int"), (60, "number of fields")], key=repr)
    staged = spark.read.parquet(os.path.dirname(load.rows.inputFiles()[0]))
    assert staged.where("line IS NOT NULL").count() == 3 and all(f.endswith(".zstd.parquet") for f in staged.inputFiles())
    assert A.BLOCK in staged.columns and staged.select(A.BLOCK).distinct().count() > 3


def test_option_marts_stage_the_log_once(spark, tmp_path, monkeypatch):
    """The questions are read from the staged option rows; the last steps themselves are not staged and dealt anew."""
    lines = [(o, s, n, "A" if (o + n) % 2 else "R", 3 * o + n) for o in range(1, 9) for s in (1, 2, 4) for n in (1, 2, 3)]
    base = {
        "lineitem": (lines, "l_orderkey LONG, l_suppkey LONG, l_linenumber INT, l_returnflag STRING, l_partkey LONG"),
        "orders": ([(o, 20 + o % 4) for o in range(1, 9)], "o_orderkey LONG, o_custkey LONG"),
        "supplier": ([(s, f"s{s}", s % 2) for s in (1, 2, 4)], "s_suppkey LONG, s_name STRING, s_nationkey INT"),
        "nation": ([(n, f"n{n}", n) for n in (0, 1)], "n_nationkey INT, n_name STRING, n_regionkey INT"),
        "region": ([(r, f"r{r}") for r in (0, 1)], "r_regionkey INT, r_name STRING"),
        "customer": ([(c,) for c in (0, 1, 20, 21, 22, 23)], "c_custkey LONG")}
    t = Tables(spark, str(tmp_path))
    for name, (data, columns) in base.items():
        spark.createDataFrame(data, columns).write.parquet(f"{tmp_path}/{name}.parquet")
        t._made[name] = spark.read.parquet(f"{tmp_path}/{name}.parquet")
    staged = []
    for module in (Q, plans):
        monkeypatch.setattr(module, "stage", lambda df, name="stage", *more: staged.append(name) or stage(df, name, *more))
    p, options, questions = Q.options_and_questions(t)
    assert [n for n in staged if n not in ("places", "scope")] == ["options", "questions"]
    steps = plans.last_step_rows(Q.cube(t)[1])
    want = plans.questions_of(steps)
    assert want.count() > 5 and rows(questions, *sorted(want.columns)) == rows(want, *sorted(want.columns))
    unread = ["qa_id", "response_score", "stem_fraction", "choice_fraction", "choice_answer"]
    whole = plans.ranged_options(steps.drop(*Q.NO_OPTION), p["question_answers"], unread)
    assert set(options.columns) == set(whole.columns) and rows(options, *whole.columns) == rows(whole)


def test_step_data_that_are_read_once_are_not_staged(spark):
    assert "x_data" in ROLES and "x_data" not in STORED
