"""Sources, sinks and log events: test tables written as the platforms deliver them, read back and compared."""

import zipfile

import pyarrow as pa
import pyarrow.csv as pa_csv
import pyarrow.fs as pa_fs
from pyspark.sql import functions as F

from quizlens.operators import submissions as S
from quizlens.operators.testbank import extract_test_bank, rejected_elements
from quizlens.operators.tree import STRUCTURE_FIELDS, parse_structure
from quizlens.plans import export_load as L
from quizlens.sinks import tables as W
from quizlens.sinks.stage import scratch_path, stage
from quizlens.sources import archives as A
from quizlens.sources import files as R
from quizlens.sources.typed import load_archives, load_csv
from suite.registry import query, role


def zip_partitions(df, folder: str, member: str) -> None:
    """One zip archive with a CSV member per partition, written by the tasks."""
    uri = folder if "://" in folder else f"file://{folder}"
    fs, root = pa_fs.FileSystem.from_uri(uri)
    fs.create_dir(root, recursive=True)

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        store, base = pa_fs.FileSystem.from_uri(uri)
        with store.open_output_stream(f"{base}/part{number}.zip") as out, zipfile.ZipFile(
                out, "w", zipfile.ZIP_DEFLATED) as zipped, zipped.open(member, "w") as text:
            heading = True
            for batch in batches:
                pa_csv.write_csv(batch, text, pa_csv.WriteOptions(include_header=heading))
                heading = False
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32())], names=["part"])

    df.mapInArrow(run, "part INT").write.format("noop").mode("overwrite").save()


@query("source_csv", "SELECT doc_id, text, lang, n_chars FROM documents")
def source_csv(t):
    """Texts with quotes, separators and line breaks through CSV."""
    path = scratch_path(t.spark, "csv")
    W.export_csv(t["documents"].select("doc_id", "text", "lang", "n_chars"), path, sep=",")
    return R.read_csv(t.spark, path, "a BIGINT, b STRING, c STRING, d BIGINT").toDF("doc_id", "text", "lang", "n_chars")


@query("source_archive_csv", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  CAST(NULL AS BOOLEAN) AS is_graded FROM orders
""")
def source_archive_csv(t):
    """Orders in several zip archives; a column no archive has reads as null."""
    folder = scratch_path(t.spark, "zips")
    zip_partitions(t["orders"].repartition(4), folder, "orders.csv")
    schema = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, is_graded BOOLEAN")
    rows = A.readable_rows(A.read_archive_csv(t.spark, folder, "orders.csv", schema))
    return rows.drop("archive").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query("source_structure_csv", f"SELECT {', '.join(STRUCTURE_FIELDS)} FROM {{t_parsed}}")
def source_structure_csv(t):
    """Gzipped structure file with nine positional columns."""
    path = scratch_path(t.spark, "structure")
    t["t_structure"].select(F.lit("0").alias("c0"), *[f"c{i}" for i in range(1, 9)]).write.csv(
        path, sep=";", compression="gzip")
    return parse_structure(R.read_structure_csv(t.spark, path)).select(*STRUCTURE_FIELDS)


@query("source_listed_sizes", "SELECT CAST(ceil(count(*) / 500.0) AS BIGINT) AS listed, true AS all_landed FROM orders")
def source_listed_sizes(t):
    """A file per 500 orders, found through a list of addresses."""
    folder, lists = scratch_path(t.spark, "landed"), scratch_path(t.spark, "list")
    t["orders"].coalesce(1).write.option("maxRecordsPerFile", 500).parquet(folder)
    found = R.list_files(t.spark, folder, ".parquet")
    found.select(F.concat(F.lit("https://files.example.org/"), "name")).coalesce(1).write.text(lists)
    sizes = R.sizes_of_listed(t.spark, lists, folder)
    return sizes.agg(F.count(F.lit(1)).alias("listed"), F.every(F.col("length") > 0).alias("all_landed"))


@query("sink_partitions", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS price
FROM orders UNION ALL SELECT o_orderkey, 'new', o_totalprice FROM orders WHERE o_orderstatus = 'P'
""")
def sink_partitions(t):
    """One partition replaced, the others kept, new rows appended."""
    path = scratch_path(t.spark, "parts")
    rows = t["orders"].select("o_orderkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    W.overwrite_partitions(rows, path, ["o_orderstatus"])
    twice = rows.where(F.col("o_orderstatus") == "F").withColumn("price", F.col("price") * 2)
    W.overwrite_partitions(twice, path, ["o_orderstatus"])
    fresh = rows.where(F.col("o_orderstatus") == "P").withColumn("o_orderstatus", F.lit("new"))
    W.append(fresh, path, ["o_orderkey", "price", "o_orderstatus"], ["o_orderstatus"])
    return t.spark.read.schema(rows.schema).parquet(path)


@query("sink_exports", """
SELECT event_id, event_type, value, props FROM events UNION ALL SELECT event_id, event_type, value, props FROM events
""")
def sink_exports(t):
    """CSV and JSON exports read back."""
    rows, csv, js = t["events"].select("event_id", "event_type", "value", "props"), scratch_path(t.spark, "c"), scratch_path(t.spark, "j")
    W.export_csv(rows, csv)
    W.export_json(rows, js)
    return R.read_csv(t.spark, csv, rows.schema, sep=";").unionByName(t.spark.read.json(js, schema=rows.schema))


@query("sink_upsert_ignore", """
SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal > 0
UNION ALL SELECT o_custkey AS id, 'from orders' AS name FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY o_custkey
""")
def sink_upsert_ignore(t):
    """W5."""
    known = t["customer"].where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    new = t["orders"].select(F.col("o_custkey").alias("id"), F.lit("from orders").alias("name"))
    return W.upsert_ignore(new, known, ["id"])


@query("sink_upsert_fill", """
WITH known AS (SELECT s_suppkey AS id, concat('slug', s_suppkey % 40) AS slug,
                 CASE WHEN s_acctbal > 2000 THEN s_name END AS ext_id FROM supplier),
news AS (SELECT concat('slug', n_nationkey * 2) AS slug, n_name AS ext_id FROM nation)
SELECT k.id, k.slug, coalesce(k.ext_id, n.ext_id) AS ext_id FROM known k LEFT JOIN news n ON n.slug = k.slug
UNION ALL
SELECT NULL, slug, ext_id FROM news WHERE slug NOT IN (SELECT slug FROM known WHERE ext_id IS NULL)
""")
def sink_upsert_fill(t):
    """W6."""
    known = t["supplier"].select(
        F.col("s_suppkey").alias("id"), F.concat(F.lit("slug"), (F.col("s_suppkey") % 40).cast("string")).alias("slug"),
        F.when(F.col("s_acctbal") > 2000, F.col("s_name")).alias("ext_id"))
    news = t["nation"].select(F.concat(F.lit("slug"), (F.col("n_nationkey") * 2).cast("string")).alias("slug"),
                              F.col("n_name").alias("ext_id"))
    return W.upsert_fill(news, known, "slug", "ext_id")


@query("sink_updates", """
WITH prices AS (SELECT p_partkey, p_retailprice FROM part WHERE p_size > 20)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN 'right' WHEN l_returnflag = 'R' THEN 'wrong'
  END AS verdict, CASE WHEN l_linestatus = 'F' THEN p_retailprice END AS price, CAST(NULL AS VARCHAR) AS display
FROM lineitem LEFT JOIN prices ON coalesce(p_partkey, 0) = coalesce(l_partkey, 0)
""")
def sink_updates(t):
    """W14, W15, W16."""
    rows = W.add_columns(t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"),
                         verdict="string", price="double", display="string")
    flag = F.col("l_returnflag")
    rows = W.update_where(rows, "verdict", (flag == "A", F.lit("right")), (flag == "R", F.lit("wrong")))
    prices = t["part"].where(F.col("p_size") > 20).select(F.col("p_partkey").alias("l_partkey"),
                                                         F.col("p_retailprice").alias("price"))
    rows = W.update_from(rows, prices, ["l_partkey"], "price", only=F.col("l_linestatus") == "F", null_as_zero=True)
    return rows.drop("l_returnflag", "l_linestatus")


@query("sink_view", "SELECT DISTINCT n_regionkey AS region_id FROM nation")
def sink_view(t):
    """W20."""
    W.named_view(t["nation"].select(F.col("n_regionkey").alias("region_id")).distinct(), "quizlens_regions")
    out = t.spark.table("quizlens_regions")
    W.drop_view(t.spark, "quizlens_regions")
    return out


@query("sink_ledger", """
SELECT n_nationkey, n_name FROM nation WHERE n_name NOT IN (SELECT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey
  WHERE s_acctbal > 8000)
""")
def sink_ledger(t):
    """Loads already registered are left out."""
    ledger = W.Ledger(t.spark, scratch_path(t.spark, "ledger"))
    rich = t["nation"].join(t["supplier"].where(F.col("s_acctbal") > 8000), F.col("s_nationkey") == F.col("n_nationkey"))
    ledger.add(rich, "structure", "n_name")
    ledger.add(t["nation"], "caq_event", "n_name")
    return ledger.unseen(t["nation"], "structure", "n_name").select("n_nationkey", "n_name")


# --- event logs of the provider platform ----------------------------------------------------------------------------
@query("events_answers_log", """
SELECT CAST(o_custkey AS VARCHAR) AS user_ext_id, CAST(o_orderkey AS VARCHAR) AS action_ext_id,
  CAST(l_partkey AS VARCHAR) AS question_ext_id, l_quantity AS response_score
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
""")
def events_answers_log(t):
    """E1."""
    key = F.col("o_orderkey").cast("string")
    actions = t["orders"].select(
        F.lit(1).alias("load_id"), key.alias("assessment_action_id"), F.col("o_custkey").cast("string").alias("user_ext_id"),
        F.lit("a").alias("assessment_id"), F.lit("b").alias("assessment_action_base_id"),
        F.lit(1).alias("assessment_action_version"), F.col("o_orderdate").alias("assessment_action_ts"),
        F.col("o_orderdate").alias("assessment_action_start_ts"))
    responses = t["lineitem"].select(
        F.lit(1).alias("load_id"), F.col("l_orderkey").cast("string").alias("assessment_action_id"),
        F.col("l_partkey").cast("string").alias("assessment_question_id"), F.col("l_quantity").alias("assessment_response_score"),
        F.col("l_tax").alias("assessment_response_weighted_score"), F.lit("r").alias("assessment_response_id"))
    return L.answers_log({"assessment_actions": actions, "assessment_responses": responses}).select(
        "user_ext_id", "action_ext_id", "question_ext_id", "response_score")


@query("events_option_log", """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS response_ext_id, CASE WHEN id LIKE '0.%' THEN substring(id, 1, 10) ELSE id END
  AS option_ext_id, l_returnflag = 'A' AS correct, l_linestatus = 'F' AS selected
FROM (SELECT *, CASE WHEN l_tax > 0.04 THEN concat('0.', l_partkey + 100000, '12345') ELSE concat('o', l_partkey) END AS id
      FROM lineitem) x
""")
def events_option_log(t):
    """E2, D9's id rule."""
    part = F.col("l_partkey")
    raw = t["lineitem"].select(
        F.lit(1).alias("load_id"), F.col("l_orderkey").cast("string").alias("assessment_response_id"),
        F.when(F.col("l_tax") > 0.04, F.concat(F.lit("0."), (part + 100000).cast("string"), F.lit("12345")))
        .otherwise(F.concat(F.lit("o"), part.cast("string"))).alias("assessment_option_id"),
        (F.col("l_returnflag") == "A").alias("assessment_response_correct"),
        (F.col("l_linestatus") == "F").alias("assessment_response_selected"))
    return L.option_log({"assessment_response_options": raw}).drop("load_id")


# --- tracking log ---------------------------------------------------------------------------------------------------
def log_lines(t, *keep):
    """A tracking-log line per order row: a graded submission with one question whose kind follows the line number."""
    kinds = F.array(*[F.lit(k) for k in (*S.INPUT_TYPES, "drawing")])
    kind = F.get(kinds, F.col("l_linenumber") % 6)
    picked = F.when(F.col("l_returnflag") == "A", "c0").when(F.col("l_returnflag") == "R", "c1").otherwise("c2")
    shown = F.when(F.col("l_returnflag") == "A", "first").when(F.col("l_returnflag") == "R", "second").otherwise("third")
    many = kind == "checkboxgroup"
    submission = F.struct(
        kind.alias("input_type"), F.concat(F.lit("r_"), kind).alias("response_type"), F.lit("line one\nline two").alias("question"),
        (F.col("l_returnflag") == "A").alias("correct"),
        F.create_map(F.lit("c0"), F.lit("first"), F.lit("c1"), F.lit("second"), F.lit("c2"), F.lit("third")).alias("choices_map"),
        F.array(F.lit("first"), F.lit("second"), F.lit("third")).alias("answers_available"),
        F.array(F.lit("c0"), F.lit("c1")).alias("choice_correct"), F.array(F.lit("first"), F.lit("second")).alias("answer_correct"),
        F.when(many, F.lit("@choice@")).otherwise(picked).alias("choice"),
        F.when(many, F.lit("@answer@")).otherwise(shown).alias("answer"))
    event = F.struct(
        F.concat(F.lit("p"), F.col("l_suppkey").cast("string")).alias("problem_id"), F.lit(1).alias("attempts"),
        F.col("l_tax").alias("grade"), F.lit(3.0).alias("max_grade"), F.lit("incorrect").alias("success"),
        F.create_map(F.concat(F.lit("q"), F.col("l_linenumber").cast("string")), submission).alias("submission"))
    line = F.to_json(F.struct(
        F.concat(F.lit("u"), F.col("l_orderkey").cast("string")).alias("username"),
        F.when(F.col("l_linestatus") == "F", "problem_check").otherwise("problem_publish").alias("event_type"),
        F.lit("server").alias("event_source"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".174582+00:00")).alias("time"),
        F.struct(F.col("l_partkey").alias("user_id"), F.lit("c").alias("course_id")).alias("context"), event.alias("event")))
    # the chosen values of a checkbox group are arrays
    line = F.replace(F.replace(line, F.lit('"@choice@"'), F.concat(F.lit('["'), picked, F.lit('","c1"]'))),
                     F.lit('"@answer@"'), F.concat(F.lit('["'), shown, F.lit('","second"]')))
    return t["lineitem"].repartition(t.spark.sparkContext.defaultParallelism).select(line.alias("value"), *keep)


LOG_FILE_LINES = 200_000


def read_log(t):
    path = scratch_path(t.spark, "log")
    # a gzipped file is read by one task, so files are bounded and their number grows with the log
    log_lines(t).write.option("maxRecordsPerFile", LOG_FILE_LINES).text(path, compression="gzip")
    return R.read_event_log(t.spark, path)


role("g_check", """
SELECT *, l_linenumber % 6 AS kind,
  CASE WHEN l_returnflag = 'A' THEN 'c0' WHEN l_returnflag = 'R' THEN 'c1' ELSE 'c2' END AS picked,
  CASE WHEN l_returnflag = 'A' THEN 'first' WHEN l_returnflag = 'R' THEN 'second' ELSE 'third' END AS shown
FROM {lineitem} WHERE l_linestatus = 'F' AND l_shipdate > TIMESTAMP '1996-01-01 00:00:00'
""")
role("g_options", """
SELECT 'c0' AS id, 'first' AS txt, true AS good UNION ALL SELECT 'c1', 'second', true UNION ALL SELECT 'c2', 'third', false
""")


@query("log_flatten", """
SELECT concat('u', l_orderkey) AS username, l_partkey AS user_id, concat('p', l_suppkey) AS problem_id,
  concat('q', l_linenumber) AS question_id, l_tax AS grade, l_returnflag = 'A' AS resp_correct, x.* FROM {g_check} c
JOIN LATERAL (
  SELECT 'checkboxgroup' AS input_type, concat('line one', chr(10), 'line two') AS question_txt, o.id AS choice_id,
    o.txt AS choice_txt, o.good AS option_correct, o.id IN (c.picked, 'c1') AS option_selected,
    CASE WHEN o.good THEN o.txt ELSE '' END AS choice_txt2,
    CASE WHEN o.id IN (c.picked, 'c1') THEN o.txt ELSE '' END AS choice_txt3 FROM {g_options} o WHERE c.kind = 0
  UNION ALL
  SELECT 'choicegroup', 'line one line two', o.id, o.txt, o.good, o.id = c.picked,
    CASE WHEN o.good THEN o.txt ELSE '' END, CASE WHEN o.id = c.picked THEN c.shown ELSE '' END
  FROM {g_options} o WHERE c.kind = 1
  UNION ALL
  SELECT 'optioninput', 'line one line two', 'hash', o.txt, o.good, o.txt = c.shown, '', '' FROM {g_options} o WHERE c.kind = 2
  UNION ALL
  SELECT 'formulaequationinput', 'line one line two', NULL, c.shown, NULL, NULL, o.txt, '' FROM {g_options} o
  WHERE c.kind = 3 AND o.good
  UNION ALL
  SELECT 'textline', 'line one line two', NULL, c.shown, c.shown IN ('first', 'second'), c.shown = o.txt, o.txt, ''
  FROM {g_options} o WHERE c.kind = 4 AND o.good) x ON true
""")
def log_flatten(t):
    """E4, E4a-E4e, S6, F22, F24, P16. Ids made by hashing are shown as 'hash'."""
    flat = S.flatten_submissions(read_log(t), since="1996-01-01 00:00:00", spread=16)
    return flat.withColumn("choice_id", F.when(F.col("input_type") == "optioninput", "hash").otherwise(F.col("choice_id"))).select(
        "username", "user_id", "problem_id", "question_id", "grade", "resp_correct", "input_type", "question_txt", *S.OPTION)


@query("log_unknown_inputs", """
SELECT concat('q', l_linenumber) AS question_id, 'drawing' AS input_type, count(*) AS n FROM {g_check} WHERE kind = 5
GROUP BY l_linenumber
""")
def log_unknown_inputs(t):
    """E4f."""
    return S.unknown_inputs(read_log(t), since="1996-01-01 00:00:00").groupBy("question_id", "input_type").agg(
        F.count(F.lit(1)).alias("n"))


@query("log_counts", """
SELECT CAST(count(*) AS BIGINT) AS lines, CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS checks,
  CAST(sum(CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END) AS BIGINT) AS published, CAST(0 AS BIGINT) AS unreadable
FROM lineitem
""")
def log_counts(t):
    """E6, E8, E9, per file and then over all files."""
    log = stage(read_log(t), "log")
    total = S.log_counters(log).agg(F.sum("lines").alias("lines"), F.sum("unreadable").alias("unreadable"))
    checks = S.checks_per_file(log).agg(F.sum("checks").alias("checks"))
    published = S.publish_times(log).agg(F.count("time").alias("published"))
    return total.withColumns({"checks": checks.scalar(), "published": published.scalar()})


@query("log_input_profile", """
SELECT DISTINCT concat(k, '|r_', k) AS kind FROM (
  SELECT CASE l_linenumber % 6 WHEN 0 THEN 'checkboxgroup' WHEN 1 THEN 'choicegroup' WHEN 2 THEN 'optioninput'
    WHEN 3 THEN 'formulaequationinput' WHEN 4 THEN 'textline' ELSE 'drawing' END AS k
  FROM lineitem WHERE l_linestatus = 'F') x
""")
def log_input_profile(t):
    """E7, A16."""
    return S.input_profile(read_log(t))


@query("log_blank_questions", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN '  ' ELSE p_name END AS question_txt FROM part WHERE p_size > 25
""")
def log_blank_questions(t):
    """E10, F9."""
    return S.blank_questions(t["part"].select(
        "p_partkey", F.when(F.col("p_size") > 25, "  ").otherwise(F.col("p_name")).alias("question_txt")))


# --- test bank ------------------------------------------------------------------------------------------------------
def problem_docs(t):
    """A problem document per part: a choice group, an option list, a typed answer and an option without 'correct'."""
    name = F.col("p_name")
    xml = F.concat(
        F.lit("<problem><p>About "), name, F.lit("</p><label>Pick <b>one</b></label><multiplechoiceresponse><choicegroup>"
        "<choice correct='true'>yes "), name, F.lit("</choice><compoundhint>hint</compoundhint><choice correct='false'>no</choice>"
        "<choice>maybe</choice></choicegroup></multiplechoiceresponse><optionresponse><p>extra</p>"
        "<optioninput options=\"('a','"), name, F.lit("')\" correct='a'/></optionresponse><h3>Type</h3><stringresponse answer='"),
        name, F.lit("'><additional_answer answer='other'/><textline size='20'/></stringresponse>"
                    "<div><stringresponse answer='lost'/></div></problem>"))
    return t["part"].select(F.col("p_brand").alias("course"), F.concat(F.lit("x"), F.col("p_partkey").cast("string")).alias("problem"),
                            xml.alias("xml"))


@query("test_bank_options", """
SELECT p_brand AS course, concat('x', p_partkey) AS problem, x.* FROM part p JOIN LATERAL (
  SELECT concat('x', p.p_partkey, '_2_1') AS question_id, concat('About ', p.p_name, chr(10), 'Pick one', chr(10)) AS question_txt,
    'choicegroup' AS input_type, 'choice_0' AS choice_id, concat('yes ', p.p_name) AS choice_txt, 'true' AS option_correct
  UNION ALL SELECT concat('x', p.p_partkey, '_2_1'), concat('About ', p.p_name, chr(10), 'Pick one', chr(10)), 'choicegroup',
    'choice_1', 'no', 'false'
  UNION ALL SELECT concat('x', p.p_partkey, '_2_1'), concat('About ', p.p_name, chr(10), 'Pick one', chr(10)), 'choicegroup',
    'choice_2', 'maybe', ''
  UNION ALL SELECT concat('x', p.p_partkey, '_3_1'), 'extra', 'optioninput', 'hash', 'a', 'true'
  UNION ALL SELECT concat('x', p.p_partkey, '_3_1'), 'extra', 'optioninput', 'hash', p.p_name, 'false'
  UNION ALL SELECT concat('x', p.p_partkey, '_4_1'), concat('Type', chr(10)), 'textline', '', p.p_name, ''
  UNION ALL SELECT concat('x', p.p_partkey, '_4_1'), concat('Type', chr(10)), 'textline', '', 'other', '') x ON true
""")
def test_bank_options(t):
    """E12, E12a-E12e, F26."""
    rows = extract_test_bank(problem_docs(t))
    return rows.withColumn("choice_id", F.when(F.col("input_type") == "optioninput", "hash").otherwise(F.col("choice_id")))


@query("test_bank_lost", """
SELECT p_brand AS course, concat('x', p_partkey) AS problem, concat('x', p_partkey, '_2_1') AS question_id,
  'no correct attribute' AS reject, 'choice' AS tag FROM part
UNION ALL
SELECT p_brand, concat('x', p_partkey), NULL, 'nested response not read', 'stringresponse' FROM part
""")
def test_bank_lost(t):
    """E12f, E12g."""
    return rejected_elements(problem_docs(t))


# --- rejects --------------------------------------------------------------------------------------------------------
role("b_orders", """
SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN concat('n/a ', o_custkey) ELSE CAST(o_custkey AS VARCHAR(20)) END AS cust,
  CASE WHEN o_orderkey % 89 = 0 THEN '2020-13-45' WHEN o_orderkey % 83 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
FROM {orders}
""")


def planted_orders(t):
    """Orders as texts, some of which do not fit a number or a date."""
    key = F.col("o_orderkey")
    return t["orders"].select(
        key, F.when(key % 97 == 0, F.concat(F.lit("n/a "), F.col("o_custkey").cast("string"))).otherwise(F.col("o_custkey").cast("string")).alias("cust"),
        F.when(key % 89 == 0, "2020-13-45").when(key % 83 == 0, None).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))


@query("load_archive_rejects", """
SELECT 'cust' AS column_name, 'not a bigint' AS reason, cust AS value, count(*) AS n FROM {b_orders} WHERE cust LIKE 'n/a%' GROUP BY cust
UNION ALL SELECT 'day', 'not a date', day, count(*) FROM {b_orders} WHERE day = '2020-13-45' GROUP BY day
UNION ALL SELECT 'rows', NULL, NULL, count(*) FROM {b_orders} WHERE cust NOT LIKE 'n/a%' AND coalesce(day, '') <> '2020-13-45'
UNION ALL SELECT 'rejected lines', NULL, NULL, count(*) FROM {b_orders} WHERE cust LIKE 'n/a%' OR day = '2020-13-45'
""")
def load_archive_rejects(t):
    """Planted bad values in zip archives are listed, all other records are typed rows."""
    folder = scratch_path(t.spark, "zips")
    zip_partitions(planted_orders(t).repartition(4), folder, "orders.csv")
    load = load_archives(t.spark, folder, "orders.csv", "o_orderkey BIGINT, cust BIGINT, day DATE")
    return _listed(load, load.rejected.groupBy("column_name", "reason", F.col("text").alias("value")))


def _listed(load, values):
    """Values per reject, and how many records became rows or were rejected."""
    total = lambda df, name: df.agg(F.lit(name).alias("column_name"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("value"), F.count(F.lit(1)).alias("n"))
    lines = load.rejected.select("archive", "member", "line").distinct()
    return values.agg(F.count(F.lit(1)).alias("n")).unionByName(total(load.rows, "rows")).unionByName(total(lines, "rejected lines"))


@query("load_csv_rejects", """
SELECT 'cust' AS column_name, 'not a bigint' AS reason, cust AS value, count(*) AS n FROM {b_orders} WHERE cust LIKE 'n/a%' AND o_orderkey % 7 <> 0 GROUP BY cust
UNION ALL SELECT 'day', 'not a date', day, count(*) FROM {b_orders} WHERE day = '2020-13-45' AND o_orderkey % 7 <> 0 GROUP BY day
UNION ALL SELECT NULL, 'number of fields', CAST(o_orderkey AS VARCHAR(20)), count(*) FROM {b_orders} WHERE o_orderkey % 7 = 0 GROUP BY o_orderkey
UNION ALL SELECT 'rows', NULL, NULL, count(*) FROM {b_orders} WHERE cust NOT LIKE 'n/a%' AND coalesce(day, '') <> '2020-13-45' AND o_orderkey % 7 <> 0
UNION ALL SELECT 'rejected lines', NULL, NULL, count(*) FROM {b_orders} WHERE cust LIKE 'n/a%' OR day = '2020-13-45' OR o_orderkey % 7 = 0
""")
def load_csv_rejects(t):
    """Lines with too few fields or bad values, in plain text files."""
    path, key = scratch_path(t.spark, "lines"), F.col("o_orderkey").cast("string")
    line = F.when(F.col("o_orderkey") % 7 == 0, key).otherwise(F.concat_ws(";", key, "cust", F.coalesce("day", F.lit(""))))
    planted_orders(t).select(line.alias("value")).write.text(path)
    load = load_csv(t.spark, path, "o_orderkey BIGINT, cust BIGINT, day DATE", sep=";", header=False)
    return _listed(load, load.rejected.groupBy("column_name", "reason", F.col("text").alias("value")))


role("g_bad", """
SELECT *, CASE WHEN l_orderkey % 50 = 3 THEN 'unreadable line' WHEN l_linestatus <> 'F' THEN NULL WHEN l_orderkey % 50 = 5 THEN 'bad time'
  WHEN l_shipdate <= TIMESTAMP '1996-01-01 00:00:00' THEN NULL WHEN l_linenumber % 6 = 5 THEN 'unknown kind'
  WHEN l_orderkey % 50 = 9 THEN 'no options' END AS reason FROM {lineitem}
""")


@query("log_rejects", """
SELECT reason, CASE WHEN reason IN ('unknown kind', 'no options') THEN concat('q', l_linenumber) END AS question_id, count(*) AS n
FROM {g_bad} WHERE reason IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT 'counted bad times', NULL, count(*) FROM {g_bad} WHERE reason = 'bad time'
""")
def log_rejects(t):
    """E4, E4f, E6: unreadable lines, bad times, unknown kinds and empty option lists, planted in the log, are listed."""
    key, line = F.col("l_orderkey") % 50, F.col("value")
    empty = line
    for name, value in (("choices_map", "{}"), ("answers_available", "[]"), ("answer_correct", "[]")):
        empty = F.regexp_replace(empty, rf'"{name}":(\{{[^}}]*\}}|\[[^\]]*\])', f'"{name}":{value}')
    broken = F.regexp_replace(line, r'"time":"[^"]*"', '"time":"some day"')
    planted = F.when(key == 3, F.lit("{not a log line")).when(key == 5, broken).when(key == 9, empty).otherwise(line)
    path = scratch_path(t.spark, "log")
    log_lines(t, "l_orderkey").select(planted.alias("value")).write.text(path, compression="gzip")
    log = stage(R.read_event_log(t.spark, path), "log")
    found = S.log_rejects(log, since="1996-01-01 00:00:00").groupBy("reason", "question_id").agg(F.count(F.lit(1)).alias("n"))
    counted = S.log_counters(log).agg(F.lit("counted bad times").alias("reason"), F.lit(None).cast("string").alias("question_id"), F.sum("bad_times").alias("n"))
    return found.unionByName(counted)


@query("log_line_numbers", "SELECT CAST(count(*) AS BIGINT) AS lines, CAST(count(*) AS BIGINT) AS numbered, true AS complete FROM lineitem")
def log_line_numbers(t):
    """E5: every file's lines carry the numbers 1 to n."""
    per_file = read_log(t).groupBy("archive").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("line_no").alias("d"), F.min("line_no").alias("low"), F.max("line_no").alias("high"))
    return per_file.agg(F.sum("n").alias("lines"), F.sum("d").alias("numbered"), F.every((F.col("low") == 1) & (F.col("high") == F.col("n"))).alias("complete"))
