"""Course archives, exports in an older code page, literal rows, ids of texts."""

import io
import tarfile

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import functions as F

from quizlens.functions.columns import text_hash
from quizlens.operators import submissions as S
from quizlens.operators.testbank import extract_test_bank
from quizlens.sinks import tables as W
from quizlens.sinks.stage import scratch_path, stage
from quizlens.sources import archives as A
from quizlens.sources import files as R
from suite.files import problem_docs, read_log
from suite.registry import ORACLES, query


def tar_courses(docs, folder):
    """One .tar.gz per course with a member per problem and one that is none; documents come sorted by course and are streamed."""
    uri = folder if "://" in folder else f"file://{folder}"
    store, root = pa_fs.FileSystem.from_uri(uri)
    store.create_dir(root, recursive=True)

    def run(batches):
        fs, base = pa_fs.FileSystem.from_uri(uri)
        at, out, tar, done = None, None, None, []

        def add(name, text):
            data = text.encode()
            entry = tarfile.TarInfo(name)
            entry.size = len(data)
            tar.addfile(entry, io.BytesIO(data))

        def close():
            if tar is not None:
                tar.close()
                out.close()

        for batch in batches:
            for course, problem, xml in zip(*(c.to_pylist() for c in batch.columns)):
                if course != at:
                    close()
                    out = fs.open_output_stream(f"{base}/{course}.tar.gz", compression=None)
                    tar, at = tarfile.open(fileobj=out, mode="w|gz"), course
                    done.append(course)
                    add("course/html/about.xml", "<html/>")
                add(f"course/problem/{problem}.xml", xml)
        close()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["course"])

    docs.select("course", "problem", "xml").repartition("course").sortWithinPartitions("course", "problem").mapInArrow(
        run, "course STRING").write.format("noop").mode("overwrite").save()


@query("source_course_archives", ORACLES["test_bank_options"])
def source_course_archives(t):
    """Problem documents inside course archives, to options of the test bank."""
    folder = scratch_path(t.spark, "courses")
    tar_courses(problem_docs(t), folder)
    docs = stage(A.read_problem_xml(t.spark, folder), "docs")
    bank = extract_test_bank(docs.where(F.col("error").isNull()))
    return bank.withColumn("choice_id", F.when(F.col("input_type") == "optioninput", "hash").otherwise(F.col("choice_id")))


@query("sink_code_page", """
SELECT id, question, answer, fraction FROM {m_answers} UNION ALL SELECT id, question, answer, fraction FROM {m_answers}
""")
def sink_code_page(t):
    """Rows exported in code page 1251 and in UTF-8, read back."""
    out = None
    for encoding in ("windows-1251", "UTF-8"):
        rows, path = t["m_answers"].select("id", "question", "answer", "fraction"), scratch_path(t.spark, "csv")
        W.export_csv(rows, path, encoding=encoding)
        with W.java_charsets(t.spark, encoding):
            back = stage(R.read_csv(t.spark, path, rows.schema, sep=";", encoding=encoding), "read")
        out = back if out is None else out.unionByName(back)
    return out


@query("sink_literal_rows", """
SELECT n_nationkey AS id, n_name AS name FROM nation UNION ALL SELECT 1000, 'Atlantis' UNION ALL SELECT 1001, NULL
""")
def sink_literal_rows(t):
    """A query's result copied to a table, literal rows added."""
    path, rows = scratch_path(t.spark, "copy"), t["nation"].select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    W.copy_table(rows, path)
    W.append_rows(t.spark, [(1000, "Atlantis"), (1001, None)], rows._jdf.schema().toDDL().replace(" NOT NULL", ""), path)
    return t.spark.read.schema(rows.schema).parquet(path)


@query("sink_ledger_times", "SELECT 'structure' AS dest, count(DISTINCT n_name) AS loads, true AS stamped FROM nation")
def sink_ledger_times(t):
    """A load is registered once, with the time of its registration."""
    ledger, now = W.Ledger(t.spark, scratch_path(t.spark, "ledger")), F.current_timestamp()
    ledger.add(t["nation"].join(t["supplier"], F.col("s_nationkey") == F.col("n_nationkey"), "left"), "structure", "n_name")
    recent = F.col("load_ts").between(now - F.expr("INTERVAL 1 HOUR"), now)
    return ledger.rows().groupBy("dest").agg(F.count(F.lit(1)).alias("loads"), F.every(recent).alias("stamped"))


@query("log_submissions_json", """
SELECT concat('q', l_linenumber) AS question_id, k AS input_type, concat('r_', k) AS response_type, 'line one' || chr(10) || 'line two' AS question,
  l_returnflag = 'A' AS correct, count(*) AS n
FROM (SELECT *, CASE l_linenumber % 6 WHEN 0 THEN 'checkboxgroup' WHEN 1 THEN 'choicegroup' WHEN 2 THEN 'optioninput'
    WHEN 3 THEN 'formulaequationinput' WHEN 4 THEN 'textline' ELSE 'drawing' END AS k FROM lineitem WHERE l_linestatus = 'F') x
GROUP BY 1, 2, 3, 4, 5
""")
def log_submissions_json(t):
    """Every submitted question as JSON text, read back."""
    told = S.submissions_as_json(read_log(t)).select("question_id", F.from_json(
        "submission", "input_type STRING, response_type STRING, question STRING, correct BOOLEAN").alias("s"))
    return told.groupBy("question_id", "s.input_type", "s.response_type", "s.question", "s.correct").agg(F.count(F.lit(1)).alias("n"))


@query("text_ids", """
SELECT lang, count(DISTINCT text) AS texts, count(DISTINCT text) AS ids, count(DISTINCT text) AS pairs FROM documents GROUP BY lang
""")
def text_ids(t):
    """equal texts have one id, different texts different ones."""
    rows = t["documents"].select("lang", "text", text_hash(F.col("text")).alias("id"))
    return rows.groupBy("lang").agg(F.countDistinct("text").alias("texts"), F.countDistinct("id").alias("ids"), F.countDistinct("text", "id").alias("pairs"))
