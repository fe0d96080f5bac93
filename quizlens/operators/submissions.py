"""Flattening of tracking-log submissions: one row per answer option."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.functions import log_time, text_hash
from quizlens.operators.attempts import first_n_per_group
from quizlens.schemas import CHECK_EVENT

INPUT_TYPES = ("checkboxgroup", "choicegroup", "optioninput", "formulaequationinput", "textline")
SHEET = ["archive", "line_no", "time", "username", "user_id", "problem_id", "max_grade", "attempts", "grade", "success",
         "question_id", "input_type", "question_txt", "resp_correct"]
OPTION = ["choice_id", "choice_txt", "option_correct", "option_selected", "choice_txt2", "choice_txt3"]


def is_check() -> Column:
    return (F.col("event_type") == "problem_check") & (F.col("event_source") == "server")


def problem_checks(log: DataFrame, since: str | None = None, per_archive: int | None = None,
                   spread: int | None = None) -> DataFrame:
    """Graded submissions after a cut-off time; `per_archive` keeps the first n of each log file, `spread` distributes
    the kept rows (a gzipped file is read by one task)."""
    rows = log.where(is_check())
    if since is not None:
        rows = rows.where(log_time(F.col("time")) > F.lit(since).cast("timestamp_ntz"))
    if per_archive is not None:
        rows = first_n_per_group(rows, ["archive"], [F.col("line_no")], per_archive)
    return rows.repartition(spread) if spread else rows


def submitted_questions(checks: DataFrame) -> DataFrame:
    """One row per question of a submission, with the submission in `s`.

    inline() unpacks the parsed event as a generator, so the text is parsed once per row.
    """
    parsed = checks.select("archive", "line_no", "time", "username", "user_id",
                           F.inline(F.array(F.from_json("event", CHECK_EVENT))))
    return parsed.select(
        "archive", "line_no", "time", "username", "user_id", "problem_id", "max_grade", "attempts", "grade", "success",
        F.explode("submission").alias("question_id", "s"))


def _option(choice_id, choice_txt, correct, selected, txt2, txt3) -> Column:
    return F.struct(
        choice_id.cast("string").alias("choice_id"), choice_txt.cast("string").alias("choice_txt"),
        correct.cast("boolean").alias("option_correct"), selected.cast("boolean").alias("option_selected"),
        txt2.cast("string").alias("choice_txt2"), txt3.cast("string").alias("choice_txt3"))


def _text_of(ids: Column, texts: Column, wanted: Column) -> Column:
    """Text at the place of the wanted id, the last one if it stands twice, '' if it is not there."""
    hits = F.filter(F.arrays_zip(ids.alias("a"), texts.alias("b")), lambda p: p["a"] == wanted)
    return F.coalesce(F.try_element_at(hits, F.lit(-1))["b"], F.lit(""))


def _contains(values: Column, wanted: Column) -> Column:
    return F.coalesce(F.array_contains(values, wanted), F.lit(False))


def _options() -> Column:
    s = {n: F.col(f"s.{n}") for n in ("choices_map", "answers_available", "choice_correct", "answer_correct", "choice",
                                      "answer")}
    none, empty = F.lit(None), F.lit("")
    chosen, written = F.col("__chosen"), F.col("__written")
    entries = F.map_entries(s["choices_map"])
    many = F.transform(entries, lambda e: _option(
        e["key"], e["value"], _contains(s["choice_correct"], e["key"]), _contains(chosen, e["key"]),
        _text_of(s["choice_correct"], s["answer_correct"], e["key"]), _text_of(chosen, written, e["key"])))
    one = F.transform(entries, lambda e: _option(
        e["key"], e["value"], _contains(s["choice_correct"], e["key"]), F.coalesce(s["choice"] == e["key"], F.lit(False)),
        _text_of(s["choice_correct"], s["answer_correct"], e["key"]),
        F.when(s["choice"] == e["key"], s["answer"]).otherwise(empty)))
    listed = F.transform(s["answers_available"], lambda x: _option(
        text_hash(x), x, _contains(s["answer_correct"], x), F.coalesce(s["answer"] == x, F.lit(False)), empty, empty))
    formula = F.transform(s["answer_correct"], lambda x: _option(none, s["answer"], none, none, x, empty))
    typed = F.transform(s["answer_correct"], lambda x: _option(
        none, s["answer"], _contains(s["answer_correct"], s["answer"]), F.coalesce(s["answer"] == x, F.lit(False)), x,
        empty))
    kind = F.col("s.input_type")
    return (F.when(kind == "checkboxgroup", many).when(kind == "choicegroup", one).when(kind == "optioninput", listed)
            .when(kind == "formulaequationinput", formula).when(kind == "textline", typed))


def flatten_submissions(log: DataFrame, since: str | None = None, per_archive: int | None = None,
                        spread: int | None = None) -> DataFrame:
    """The flat sheet: one row per option of every question of every graded submission.

    All kinds of questions go through one scan: each row builds its own list of options, which is then exploded.
    """
    asked = submitted_questions(problem_checks(log, since, per_archive, spread))
    many = F.col("s.input_type") == "checkboxgroup"
    asked = asked.withColumns({
        "__chosen": F.when(many, F.from_json("s.choice", "array<string>")),
        "__written": F.when(many, F.from_json("s.answer", "array<string>"))})
    text = F.when(F.col("s.input_type") == "checkboxgroup", F.col("s.question")).otherwise(
        F.replace(F.col("s.question"), F.lit("\n"), F.lit(" ")))
    flat = asked.withColumns({"input_type": F.col("s.input_type"), "question_txt": text,
                              "resp_correct": F.col("s.correct"), "o": F.explode(_options())})
    return flat.select(*SHEET, *[f"o.{c}" for c in OPTION])


def log_rejects(log: DataFrame, since: str | None = None) -> DataFrame:
    """What the sheet leaves out: (archive, line_no, question_id, reason, text), one row per line or question.

    Lines that are no log rows; graded submissions without a readable time, where a cut-off needs one; submissions without questions; questions of an
    unknown kind; questions of a known kind without any option. All are found in one scan, the event is parsed once.
    """
    name, nothing = F.lit(None).cast("string"), F.array().cast("array<struct<question_id: string, reason: string, text: string>>")

    def one(reason: str, text: Column) -> Column:
        return F.array(F.struct(name.alias("question_id"), F.lit(reason).alias("reason"), text.alias("text")))

    def problem(entry: Column) -> Column:
        s = entry["value"]
        kind = s["input_type"]
        options = F.when(kind.isin("checkboxgroup", "choicegroup"), F.size(F.map_keys(s["choices_map"]))).when(
            kind == "optioninput", F.size(s["answers_available"])).otherwise(F.size(s["answer_correct"]))
        return F.when(kind.isNull() | ~kind.isin(*INPUT_TYPES), F.lit("unknown kind")).when(options.isNull() | (options <= 0), F.lit("no options"))

    rows = log.where(F.col("_corrupt").isNotNull() | is_check()).withColumn("__submission", F.from_json("event", CHECK_EVENT)["submission"])
    questions = F.map_entries("__submission")
    wrong = F.transform(F.filter(questions, lambda e: problem(e).isNotNull()), lambda e: F.struct(
        e["key"].alias("question_id"), problem(e).alias("reason"), e["value"]["input_type"].alias("text")))
    time = log_time(F.col("time"))
    found = F.when(F.col("_corrupt").isNotNull(), one("unreadable line", F.col("_corrupt")))
    if since is not None:
        found = found.when(time.isNull(), one("bad time", F.col("time"))).when(time <= F.lit(since).cast("timestamp_ntz"), nothing)
    found = found.when(F.coalesce(F.size("__submission"), F.lit(0)) <= 0, one("no questions", name)).otherwise(wrong)
    return rows.select("archive", "line_no", F.explode(found).alias("r")).select("archive", "line_no", "r.*")


def unknown_inputs(log: DataFrame, since: str | None = None) -> DataFrame:
    """Questions of a kind the sheet has no rule for."""
    asked = submitted_questions(problem_checks(log, since))
    kind = F.col("s.input_type")
    return asked.where(kind.isNull() | ~kind.isin(*INPUT_TYPES)).select(
        "archive", "line_no", "time", "question_id", kind.alias("input_type"))


def input_profile(log: DataFrame) -> DataFrame:
    """Distinct pairs of input type and response type."""
    asked = submitted_questions(problem_checks(log))
    return asked.select(F.concat_ws("|", "s.input_type", "s.response_type").alias("kind")).distinct()


def submissions_as_json(log: DataFrame) -> DataFrame:
    """Each submitted question as JSON text, non-ASCII kept."""
    asked = submitted_questions(problem_checks(log))
    return asked.select("archive", "line_no", "time", "question_id", F.to_json("s").alias("submission"))


def log_counters(log: DataFrame) -> DataFrame:
    """Per archive: lines, graded submissions and those of them without a readable time, unreadable lines."""
    return log.groupBy("archive").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(is_check()).alias("checks"),
        F.count_if(is_check() & log_time(F.col("time")).isNull()).alias("bad_times"),
        F.count_if(F.col("_corrupt").isNotNull()).alias("unreadable"))


def checks_per_file(log: DataFrame) -> DataFrame:
    return log.where(is_check()).groupBy("archive").agg(F.count(F.lit(1)).alias("checks"))


def publish_times(log: DataFrame) -> DataFrame:
    return log.where(F.col("event_type") == "problem_publish").select("archive", "time")


def blank_questions(sheet: DataFrame) -> DataFrame:
    return sheet.where(F.trim("question_txt") == "")
