"""Quiz platform: partner scope, attempt cube, decoded options, and the marts str, heat and aud.

Input tables carry the platform's own column names (see quizlens.schemas). Attempt rows keep ids and numbers only;
names and texts are joined to the finished counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizlens.functions import list_item, suffix_number
from quizlens.functions.columns import last_digit
from quizlens.operators.attempts import last_steps
from quizlens.operators.frames import with_group_stats
from quizlens.operators.marts import mart_heat, mart_str
from quizlens.operators.ranking import is_last_row, learner_ranks, strong, sum_where, weak
from quizlens.operators.reliability import user_fold, with_question_variance
from quizlens.sinks.stage import stage

Tables = Mapping[str, DataFrame]

# Fixed values of the platform: module types of a quiz, answers of a true/false question and their common ending.
QUIZ_MODULE = 14
QUIZ_MODULE_OTHER_SITE = 25
TRUE, FALSE, TRUE_FALSE_END = "Верно", "Неверно", "ерно"

SCOPE = ["course_id", "partnerid", "groupid"]
TEST = [*SCOPE, "mid", "qz_id"]


# --- scope and dimensions -------------------------------------------------------------------------------------------
def partner_scope(t: Tables, columns: Sequence[str] = ("course_id", "groupid", "partnerid")) -> DataFrame:
    """Distinct courses (groups, partners, managers) reachable from a manager through contract and group."""
    m, ca, pgr = t["manager"].alias("m"), t["cassign"].alias("ca"), t["partner_group"].alias("pgr")
    gr = t["groups"].select(F.col("id").alias("groupid"), "courseid")
    return (
        m.join(t["partner"].alias("p"), F.col("p.id") == F.col("m.partnerid"), "left_semi")
        .join(t["user"].alias("u"), F.col("u.id") == F.col("m.userid"), "left_semi")
        .join(ca, F.col("ca.managerid") == F.col("m.id"))
        .join(t["contract"].alias("co"), F.col("co.id") == F.col("ca.contractid"), "left_semi")
        .join(pgr, F.col("pgr.contractid") == F.col("ca.contractid"))
        .select(F.col("m.id").alias("managerid"), "m.partnerid", "pgr.groupid", "pgr.courseid")
        .join(gr, ["groupid", "courseid"], "left_semi")
        .join(t["course"].alias("c"), F.col("c.id") == F.col("courseid"), "left_semi")
        .withColumnRenamed("courseid", "course_id").select(*columns).distinct()
    )


def _scoped_courses(t: Tables) -> DataFrame:
    return partner_scope(t, ["course_id"])


def _modules(t: Tables, module: int) -> DataFrame:
    return t["course_modules"].where(F.col("module") == module).select(
        F.col("course").alias("course_id"), F.col("section").alias("mid"), F.col("instance").alias("qz_id"))


def _counted_quizzes(t: Tables) -> DataFrame:
    return t["quiz"].where(F.col("attempts") > 0)


def _scoped_quizzes(t: Tables, module: int) -> DataFrame:
    modules = _modules(t, module).join(_scoped_courses(t), "course_id", "left_semi")
    return _counted_quizzes(t).join(modules, F.col("id") == F.col("qz_id"), "left_semi")


def _scoped_slots(t: Tables, module: int) -> DataFrame:
    quizzes = _scoped_quizzes(t, module).select(F.col("id").alias("quizid"))
    return t["quiz_slots"].join(quizzes, "quizid", "left_semi")


def scoped_dimension(t: Tables, name: str, module: int = QUIZ_MODULE) -> DataFrame:
    """Rows of course, course_sections, quiz, question or question_answers that belong to partner courses."""
    if name == "course":
        return t["course"].join(_scoped_courses(t), F.col("id") == F.col("course_id"), "left_semi")
    if name == "course_sections":
        modules = _modules(t, module).join(_scoped_courses(t), "course_id", "left_semi")
        return t["course_sections"].join(modules, F.col("id") == F.col("mid"), "left_semi").distinct()
    if name == "quiz":
        return _scoped_quizzes(t, module).distinct()
    slots = _scoped_slots(t, module)
    if name == "question":
        return t["question"].join(slots, F.col("id") == F.col("questionid"), "left_semi").distinct()
    if name == "question_answers":
        known = slots.join(t["question"], F.col("id") == F.col("questionid"), "left_semi")
        return t["question_answers"].join(known, F.col("question") == F.col("questionid"), "left_semi").distinct()
    raise ValueError(f"no scoped dimension {name!r}")


def _slots_of_courses(t: Tables, module: int) -> DataFrame:
    """Course, section, quiz, slot and question of every counted quiz."""
    return (
        _modules(t, module)
        .join(t["course"].select(F.col("id").alias("course_id")), "course_id", "left_semi")
        .join(t["course_sections"].select(F.col("id").alias("mid")), "mid", "left_semi")
        .join(_counted_quizzes(t).select(F.col("id").alias("qz_id")), "qz_id", "left_semi")
        .join(t["quiz_slots"].select(F.col("quizid").alias("qz_id"), F.col("slot").alias("aq_ord"),
                                     F.col("questionid").alias("qid")), "qz_id")
        .join(t["question"].select(F.col("id").alias("qid")), "qid", "left_semi")
    )


def question_answer_sheet(t: Tables, module: int = QUIZ_MODULE) -> DataFrame:
    """Course × section × quiz × question × listed answers of partner courses."""
    rows = _slots_of_courses(t, module).join(_scoped_courses(t), "course_id", "left_semi")
    answers = t["question_answers"].select(F.col("question").alias("qid"), F.col("id").alias("answer_id"), "answer",
                                           "fraction")
    return with_names(rows.join(answers, "qid"), t, prompt=True)


def with_names(df: DataFrame, t: Tables, prompt: bool = False) -> DataFrame:
    """Names of course, section and quiz (and the question's text) by inner joins on the ids."""
    c = t["course"].select(F.col("id").alias("course_id"), F.col("fullname").alias("cname"))
    s = t["course_sections"].select(F.col("id").alias("mid"), "section", F.col("name").alias("m_name"))
    q = t["quiz"].select(F.col("id").alias("qz_id"), F.col("name").alias("quizname"))
    out = df.join(c, "course_id").join(s, "mid").join(q, "qz_id")
    if prompt:
        out = out.join(t["question"].select(F.col("id").alias("qid"), F.col("questiontext").alias("prompt")), "qid")
    return out


# --- attempts -------------------------------------------------------------------------------------------------------
def _minute_text(unix: str) -> Column:
    return F.from_unixtime(unix, "yyyy-MM-dd HH:mm:ss")


def graded_attempts(t: Tables, module: int = QUIZ_MODULE_OTHER_SITE, first_only: bool = True) -> DataFrame:
    """Graded or given-up steps of question attempts with their place in the course."""
    steps = t["question_attempt_steps"].where(F.col("state").like("grade%") | (F.col("state") == "gaveup")).select(
        F.col("questionattemptid"), "state", F.col("fraction").alias("response_score"),
        _minute_text("timecreated").alias("attm_time"))
    tries = t["quiz_attempts"].where(F.col("attempt") == 1) if first_only else t["quiz_attempts"]
    tries = tries.select(F.col("quiz").alias("qz_id"), "attempt", F.col("state").alias("quizstate"), "sumgrades", "userid",
                         F.col("uniqueid").alias("questionusageid"))
    asked = t["question_attempts"].select(F.col("id").alias("questionattemptid"), "questionusageid",
                                          F.col("questionid").alias("qid"))
    return (
        tries.join(asked, "questionusageid").join(_slots_of_courses(t, module), ["qz_id", "qid"])
        .join(steps, "questionattemptid")
    )


def graded_steps(t: Tables, module: int = QUIZ_MODULE) -> DataFrame:
    """Graded first attempts of the members of partner groups, with group, partner and manager."""
    scope = partner_scope(t, ["course_id", "groupid", "partnerid", "managerid"])
    return (graded_attempts(t, module).join(scope, "course_id")
            .join(t["groups_members"].select("groupid", "userid"), ["groupid", "userid"]))


def score_totals(t: Tables) -> DataFrame:
    """First attempts with the stored total and the sum of the graded fractions of the learner in the quiz."""
    steps = t["question_attempt_steps"].where(F.col("state").like("grade%") | (F.col("state") == "gaveup"))
    rows = (
        t["quiz_attempts"].where(F.col("attempt") == 1).select("quiz", "userid", "sumgrades", "uniqueid")
        .join(t["question_attempts"].select("id", F.col("questionusageid").alias("uniqueid")), "uniqueid")
        .join(steps.select(F.col("questionattemptid").alias("id"), "fraction"), "id")
    )
    return with_group_stats(rows, ["quiz", "userid"], sumfraction=F.sum("fraction"))


def attempt_cube(t: Tables, module: int = QUIZ_MODULE, values: bool = True, last_only: bool = False) -> DataFrame:
    """Attempt × question × step × step datum of the members of partner groups (the flat quiz log).

    Without `values` a datum's value is '' or null, for folds that ask only whether there is one. With `last_only` the log is cut to what last steps,
    their order lists and their closing scores follow from (see _of_last_steps).

    The few places and groups are staged, so their size is known before the attempts are shuffled. Attempts meet their learner's groups before they are
    multiplied by questions, and steps meet their data while both are narrow. The rows come dealt by question attempt.
    """
    places = stage(_slots_of_courses(t, module), "places")
    enrolled = stage(partner_scope(t), "scope").join(t["groups_members"].select("groupid", "userid"), "groupid")
    tries = t["quiz_attempts"].select(
        F.col("id").alias("qza_id"), F.col("quiz").alias("qz_id"), "userid", "attempt", "sumgrades", "uniqueid")
    asked = t["question_attempts"].select(
        F.col("id").alias("qa_id"), F.col("slot").alias("qa_slot"), F.col("questionusageid").alias("uniqueid"),
        F.col("questionid").alias("qid"), "questionsummary", "rightanswer", "responsesummary")
    steps = t["question_attempt_steps"].select(
        F.col("questionattemptid").alias("qa_id"), F.col("id").alias("qas_id"), F.col("state").alias("qas_state"),
        F.col("sequencenumber").alias("qas_sequencenumber"), F.col("fraction").alias("response_score"), "timecreated")
    data = t["question_attempt_step_data"].select(
        F.col("attemptstepid").alias("qas_id"), F.col("id").alias("qasd_id"), F.col("name").alias("qasd_name"),
        (F.col("value") if values else F.when(F.col("value").isNotNull(), F.lit(""))).alias("qasd_value"))
    usages = t["question_usages"].select(F.col("id").alias("uniqueid")).distinct()
    asked = asked.join(places.select("qid"), "qid", "left_semi").join(usages, "uniqueid", "left_semi")
    logged = steps.join(data, "qas_id")
    return (
        tries.join(places.select("qz_id", "course_id").distinct(), "qz_id").join(enrolled, ["course_id", "userid"])
        .join(asked, "uniqueid").join(places, ["qz_id", "qid", "course_id"])
        .join(_of_last_steps(logged) if last_only else logged, "qa_id")
        .withColumn("qas_attm_time", _minute_text("timecreated")).drop("timecreated")
        .withColumn("questionusageid", F.col("uniqueid"))
    )


def _of_last_steps(logged: DataFrame) -> DataFrame:
    """Steps with data, cut while they are dealt by step: a step without any counted datum is no last step, so of its rows only order lists and closing
    scores are kept, without their step's and datum's ids and states.

    Adds qas_shared: the step's id stands at several question attempts.
    """
    step, name = Window.partitionBy("qas_id"), F.col("qasd_name")
    counted, order, finish = F.col("__counted"), name == "_order", name == "-finish"
    rows = logged.withColumns({
        "__counted": F.max(F.coalesce(holds_answer(), F.lit(False))).over(step),
        "qas_shared": F.coalesce(F.min("qa_id").over(step) != F.max("qa_id").over(step), F.lit(False)),
    }).where(counted | order | finish)
    kept = {c: F.when(counted, F.col(c)) for c in ("qas_id", "qas_state", "qas_sequencenumber", "timecreated", "qasd_id")}
    return rows.withColumns(kept | {
        "qasd_value": F.when(counted | order, F.col("qasd_value")), "response_score": F.when(counted | finish, F.col("response_score")),
    }).drop("__counted")


# the order of the rows of the flat log inside one step
LOG_ORDER = ["partnerid", "course_id", "groupid", "qasd_name", "qasd_id", "mid", "aq_ord"]
STEP_ORDER = [*LOG_ORDER, "stem_id", "choice_id"]


# --- decoded options ------------------------------------------------------------------------------------------------
def is_choice(name: str = "qasd_name") -> Column:
    return F.col(name).startswith("choice")


def is_answer(name: str = "qasd_name") -> Column:
    return F.col(name) == "answer"


def holds_answer() -> Column:
    """A step counts when it holds a choice, a sub-answer or an answer, or when the learner gave up."""
    return F.col("qasd_name").startswith("sub") | is_choice() | is_answer() | (F.col("qas_state") == "gaveup")


def last_step_rows(cube: DataFrame) -> DataFrame:
    """Rows of the last counted step of each question attempt, with each order list (qasd_order) and each closing score (finish_score) of the attempt.

    All three come from the one pass over the attempt's rows, which the log is already dealt by.
    """
    attempt = Window.partitionBy("qa_id")

    def listed(name: str, column: str) -> Column:
        return F.collect_list(F.when(F.col("qasd_name") == name, F.struct(F.col(column).alias("v")))).over(attempt)

    rows = cube.where(F.col("qa_id").isNotNull()).withColumns({
        "__last": F.max(F.when(holds_answer(), F.col("qas_id"))).over(attempt),
        "__orders": listed("_order", "qasd_value"), "__finishes": listed("-finish", "response_score"),
    }).where(F.col("qas_id") == F.col("__last"))
    rows = rows.withColumn("__order", F.explode_outer("__orders")).withColumn("__finish", F.explode_outer("__finishes"))
    return rows.withColumns({"qasd_order": F.col("__order.v"), "finish_score": F.col("__finish.v")}).drop(
        "__last", "__orders", "__finishes", "__order", "__finish")


def option_rows(cube: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows of the last step of each question attempt, joined to the options they speak of.

    A checkbox row 'choiceN' names the option at place N of the order list; a radio 'answer' holds the place of the
    chosen option and meets all listed answers; other questions meet all listed answers and are compared by text.
    """
    return decoded_rows(last_step_rows(cube), answers)


def decoded_rows(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Last-step rows joined to the options they speak of."""
    stems = answers.select(F.col("question").alias("__qid"), F.col("id").alias("stem_id"),
                           F.col("answer").alias("stem_answer"), F.col("fraction").alias("stem_fraction"))
    chosen = answers.select(F.col("id").alias("choice_id"), F.col("answer").alias("choice_answer"),
                            F.col("fraction").alias("choice_fraction"))
    rows = rows.withColumn("__qid", F.when(is_answer(), F.col("qid"))).join(stems, "__qid", "left")
    place = F.when(is_choice(), suffix_number(F.col("qasd_name"), "choice") + 1).when(
        is_answer(), F.col("qasd_value").try_cast("int") + 1)
    rows = rows.withColumn("__picked", list_item(F.col("qasd_order"), place).try_cast("bigint"))
    return (
        rows.join(chosen, F.col("__picked") == F.col("choice_id"), "left")
        .withColumns({
            "stem": F.when(is_choice(), F.col("__picked")).when(is_answer(), F.col("stem_id")).otherwise(F.lit(0)),
            "choice": F.when(is_choice(), F.col("qasd_value").try_cast("int"))
            .when(is_answer() & (F.col("choice_id") > 0), (F.col("stem_id") == F.col("choice_id")).cast("int"))
            .otherwise(F.lit(0)),
        }).drop("__qid", "__picked")
    )


def with_text_choice(rows: DataFrame) -> DataFrame:
    """choice of questions without an order list: true/false codes, or the text itself; null stays null."""
    value, stem = F.col("qasd_value"), F.col("stem_answer")
    hit = ((value == "0") & (stem == FALSE)) | ((value == "1") & (stem == TRUE)) | (value == stem)
    return rows.withColumn("choice", F.when(F.col("qasd_order").isNull(), hit.cast("int")).otherwise(F.col("choice")))


def _typed() -> Column:
    return F.col("qasd_order").isNull() & ~F.col("stem_answer").endswith(TRUE_FALSE_END)


def with_input_answer(rows: DataFrame) -> DataFrame:
    """input_answer: a typed text that matches none of the listed answers. `rows` is read twice; only rows of typed questions are shuffled."""
    is_typed, datum = F.coalesce(_typed(), F.lit(False)), Window.partitionBy("qasd_id")
    hits = F.sum((F.col("qasd_value") == F.col("stem_answer")).cast("int")).over(datum)
    text = F.when(F.col("qasd_id").isNotNull() & (hits == 0), F.max("qasd_value").over(datum))
    rest = rows.where(~is_typed).withColumn("input_answer", F.lit(None).cast(rows.schema["qasd_value"].dataType))
    return rows.where(is_typed).withColumn("input_answer", text).unionByName(rest)


def with_display(rows: DataFrame) -> DataFrame:
    """option_val and display: of the chosen option for checkboxes, of the listed answer else."""
    return rows.withColumns({
        "option_val": F.when(is_choice(), F.col("choice_fraction")).otherwise(F.col("stem_fraction")),
        "display": F.when(is_choice(), F.col("choice_answer")).otherwise(F.col("stem_answer")),
    })


def with_step_indicator(rows: DataFrame) -> DataFrame:
    """qas_indicator: 1 on the last row of a step, so that its score is counted once."""
    return is_last_row(rows, ["qas_id"], STEP_ORDER, "qas_indicator")


def user_range_qo(cube: DataFrame, answers: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """All decoding steps. `cube` is read once and may be unstaged; name only the columns that are wanted, because its rows are staged here with
    their options: the typed answers and the last rows of the steps are found over them."""
    return ranged_options(last_step_rows(cube), answers, without)


def ranged_options(rows: DataFrame, answers: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """The decoding steps after the choice of the last steps. Columns `without` which the result is wanted are not staged."""
    return finished_options(staged_options(rows, answers, without))


def staged_options(rows: DataFrame, answers: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """Last-step rows with their options, staged without the columns `without`. Each row is there with one option at least, so what is asked of the rows
    alone, such as the distinct questions, can be read from here too.

    Where the rows tell which step ids stand at several question attempts (qas_shared), the others' last rows are found while the rows are dealt by
    question attempt, and only the rows of such ids are dealt anew by step.
    """
    joined = with_display(with_text_choice(decoded_rows(rows, answers)))
    if "qas_shared" in joined.columns:
        joined = is_last_row(joined, ["qa_id", "qas_id"], STEP_ORDER, "qas_indicator")
    return stage(joined.drop(*without), "options", "zstd")


def finished_options(joined: DataFrame) -> DataFrame:
    """Typed answers and the last rows of the steps, of staged_options()."""
    if "qas_shared" not in joined.columns:
        return with_step_indicator(with_input_answer(joined))
    shared = with_step_indicator(joined.where("qas_shared").drop("qas_indicator"))
    return with_input_answer(joined.where(~F.col("qas_shared")).unionByName(shared).drop("qas_shared"))


def question_kind(of_options: bool = False) -> Column:
    """checkbox, radio, and for options also option (true/false) and text."""
    kind = F.when(is_choice(), F.lit("checkbox")).when(is_answer() & F.col("qasd_order").isNotNull(), F.lit("radio"))
    if of_options:
        open_ = is_answer() & F.col("qasd_order").isNull()
        ends = F.col("stem_answer").endswith(TRUE_FALSE_END)
        kind = kind.when(open_ & ends, F.lit("option")).when(open_ & ~ends, F.lit("text"))
    return kind


# --- folds and marts ------------------------------------------------------------------------------------------------
def first_attempt_questions(cube: DataFrame) -> DataFrame:
    """One row per question of a first attempt, with the score of its closing step; `cube` is read once and may be unstaged and without values."""
    return questions_of(last_step_rows(cube.where(F.col("attempt") == 1)))


def questions_of(rows: DataFrame) -> DataFrame:
    """Distinct questions of first attempts among last-step rows. A step that holds data of several kinds gives a row per kind, several closing
    scores a row per score; neither listed options nor texts take part."""
    return rows.where(F.col("attempt") == 1).select(
        *TEST, "aq_ord", "qid", question_kind().alias("qtype"), "qa_id", "qza_id", "userid", "sumgrades", "qas_id", "qas_state",
        "qas_sequencenumber", F.col("finish_score").alias("response_score"), "qas_attm_time").distinct()


def user_range_q(questions: DataFrame) -> DataFrame:
    """Completeness markers, dense rank and rank share by (sumgrades, learner). `questions` is a staged table."""
    return learner_ranks(questions, TEST, "userid", "sumgrades", "aq_ord", dense=True)


def user_range_a(questions: DataFrame, estimator: str = "sample", test: Sequence[str] = tuple(TEST)) -> DataFrame:
    """One row per learner and test with the reliability. `questions` is a staged table."""
    rows = with_question_variance(questions, [*test, "qid"], estimator=estimator, staged=True)
    return user_fold(rows, [*test, "userid"], list(test), estimator=estimator,
                     sumgrades=F.max("sumgrades"), max_aqord=F.max("aq_ord"))


def _platform(mart: DataFrame) -> DataFrame:
    return mart.withColumn("platform_id", F.lit(3))


def mart_str_quiz(ranged: DataFrame, t: Tables, test: Sequence[str] = tuple(TEST), with_mean: bool = True) -> DataFrame:
    mart = mart_str(ranged, list(test), "userid", F.max("max_aqord"), with_mean=with_mean)
    return _platform(with_names(mart, t).withColumnRenamed("qz_id", "quizid"))


def mart_heat_quiz(ranged: DataFrame, t: Tables, test: Sequence[str] = tuple(TEST)) -> DataFrame:
    mart = mart_heat(ranged, [*test, "aq_ord", "qid"], "userid", k_min=F.min("k_q"), k_max=F.max("k_q"),
                     max_aqord1=F.max("max_aqord"))
    return _platform(with_names(mart, t, prompt=True))


def _option_counts() -> list[Column]:
    low, up = weak(inclusive=True), strong()
    return [
        F.min("qas_state").alias("min_state"), F.max("qas_state").alias("max_state"),
        F.count(F.lit(1)).alias("cnt"), F.sum("choice").alias("tot_num"),
        F.countDistinct("userid").alias("user_cnt"), F.max("rnk").alias("max_rnk"),
        sum_where(low, F.col("choice")).alias("weak_num"), sum_where(low).alias("weak_denom"),
        sum_where(up, F.col("choice")).alias("strong_num"), sum_where(up).alias("strong_denom"),
    ]


def _options_ranked(options: DataFrame, ranged: DataFrame) -> DataFrame:
    return options.withColumn("qtype", question_kind(of_options=True)).join(
        ranged.select("qas_id", "rnk", "cd"), "qas_id")


def mart_aud_quiz(options: DataFrame, ranged: DataFrame, t: Tables) -> DataFrame:
    """One row per option: rows, choices, points given by the platform, and the weak (cut included) and strong shares."""
    points = F.col("qas_indicator") * F.col("finish_score")
    mart = _options_ranked(options, ranged).groupBy(
        *TEST, "aq_ord", "qid", "qtype", F.col("stem").alias("option_id"), "option_val").agg(
        F.max("display").alias("display"), *_option_counts(), F.sum(points).alias("tot_num2"),
        sum_where(weak(inclusive=True), points).alias("weak_num2"), sum_where(strong(), points).alias("strong_num2"))
    return _platform(with_names(mart, t, prompt=True))


def mart_aud_typed_quiz(options: DataFrame, ranged: DataFrame, t: Tables) -> DataFrame:
    """Variant with one row per displayed text and typed answer."""
    mart = _options_ranked(options, ranged).groupBy(
        *TEST, "aq_ord", "qid", "qtype", "option_val", "display", F.col("input_answer").alias("figment")).agg(
        *_option_counts())
    return _platform(with_names(mart, t, prompt=True))


# --- the older site: views over the base tables, population variance, nulls first -----------------------------------
OLD_TEST = ["course_id", "mid", "qz_id"]


def user_range_q_old(attempts: DataFrame) -> DataFrame:
    """`attempts` is a staged table of graded_attempts."""
    return learner_ranks(attempts, OLD_TEST, "userid", "sumgrades", "aq_ord", dense=True, nulls="first")


def user_range_a_old(attempts: DataFrame) -> DataFrame:
    return user_range_a(attempts, estimator="population", test=OLD_TEST)


def last_step(t: Tables) -> DataFrame:
    """(question attempt, step): the greatest step that holds a choice or an answer, over the base tables."""
    return last_steps(_steps_with_data(t), is_choice("name") | is_answer("name"), "questionattemptid", "attemptstepid")


def _steps(t: Tables) -> DataFrame:
    return t["question_attempt_steps"].select(
        F.col("id").alias("attemptstepid"), "questionattemptid", "sequencenumber", "state", "fraction")


def _steps_with_data(t: Tables, how: str = "inner") -> DataFrame:
    return _steps(t).join(t["question_attempt_step_data"].select("attemptstepid", "name", "value"), "attemptstepid", how)


def _attempts_of_users(t: Tables) -> DataFrame:
    tries = t["quiz_attempts"].select("userid", "quiz", F.col("id").alias("quizattemptid"), "attempt", "sumgrades",
                                      F.col("uniqueid").alias("questionusageid"))
    usages = t["question_usages"].select(F.col("id").alias("questionusageid"), "preferredbehaviour")
    asked = t["question_attempts"].withColumnRenamed("id", "questionattemptid")
    return tries.join(usages, "questionusageid").join(asked, "questionusageid")


def _is_sub(name: str = "name") -> Column:
    return F.col(name).startswith("sub")


def _number(name: str, whole: bool) -> Column:
    """The number in 'subN' or 'choiceN': the whole number, or the last digit, the rule of the older views (right only below ten)."""
    if not whole:
        return last_digit(F.col(name))
    return F.coalesce(F.when(_is_sub(name), suffix_number(F.col(name), "sub")).otherwise(suffix_number(F.col(name), "choice")), F.lit(0))


def _whole_value(name: str = "value") -> Column:
    """The value as a number; text counts as 0."""
    return F.coalesce(F.col(name).try_cast("int"), F.lit(0))


def step_detail(t: Tables, first_step_only: bool = False, whole_numbers: bool = False) -> DataFrame:
    """Every step datum with stem and choice decoded from the order lists; places come from the last digit of the name,
    the rule of the older views, or from the whole number."""
    stem_list, choice_list = F.col("name").isin("_stemorder", "_order"), F.col("name") == "_choiceorder"
    entry = F.struct(F.col("attemptstepid").alias("step"), F.col("value").alias("list"))

    def listed(cond: Column) -> Column:
        cond = cond & (F.col("sequencenumber") == 0) if first_step_only else cond
        return F.collect_list(F.when(cond, entry)).over(Window.partitionBy("questionattemptid"))

    # an order list meets the choice lists of its own step
    rows = _steps_with_data(t, "left").where(F.col("questionattemptid").isNotNull()).withColumns(
        {"__stems": listed(stem_list), "__choices": listed(choice_list)})
    rows = rows.withColumn("__stem", F.explode("__stems")).withColumn(
        "__choice", F.explode_outer(F.filter("__choices", lambda c: c["step"] == F.col("__stem.step"))))
    rows = rows.withColumns({"stem_str_step": F.col("__stem.step"), "stem_str": F.col("__stem.list"), "choice_str": F.col("__choice.list")}).drop(
        "__stems", "__choices", "__stem", "__choice")
    rows = _attempts_of_users(t).join(rows, "questionattemptid")
    stem = F.when(_is_sub() | is_choice("name"), list_item(F.col("stem_str"), _number("name", whole_numbers) + 1)).otherwise(F.lit("0"))
    choice = F.when(_is_sub(), list_item(F.col("choice_str"), _whole_value())).otherwise(F.lit("0"))
    return rows.withColumns({"stem": stem, "choice": choice})


def _with_option(rows: DataFrame, t: Tables, picked: Column, own_question: bool) -> DataFrame:
    """Value and text of the option whose id is `picked`; of the row's own question only, where asked."""
    options = t["question_answers"].select(
        F.col("id").alias("__picked"), F.col("question").alias("questionid"), F.col("fraction").alias("option_val"),
        F.col("answer").alias("option_txt"))
    on = ["__picked", "questionid"] if own_question else ["__picked"]
    # staged, so that its size decides how it is joined to the wide rows
    options = stage(options if own_question else options.drop("questionid"), "answers")
    return rows.withColumn("__picked", picked.try_cast("bigint")).join(options, on, "left").drop("__picked")


def step_detail_with_answers(t: Tables, whole_numbers: bool = False) -> DataFrame:
    """Step detail of the first step's lists with the option each row speaks of."""
    rows = step_detail(t, first_step_only=True, whole_numbers=whole_numbers)
    place = F.when(_is_sub() | is_choice("name"), _number("name", whole_numbers) + 1).when(is_answer("name"), _whole_value() + 1)
    return _with_option(rows, t, list_item(F.col("stem_str"), place), own_question=True)


def step_detail_multiple_choice(t: Tables) -> DataFrame:
    """The step view of multiple-choice questions: each datum of the first step is read as an order list, the choice is the datum's own value,
    and an option is found by its id alone, whatever its question."""
    first = F.when((F.col("sequencenumber") == 0) & F.col("__there"), F.struct(F.col("value").alias("list")))
    data = t["question_attempt_step_data"].select("attemptstepid", "name", "value", F.lit(True).alias("__there"))
    rows = _steps(t).join(data, "attemptstepid", "left").where(F.col("questionattemptid").isNotNull())
    rows = rows.withColumn("__lists", F.collect_list(first).over(Window.partitionBy("questionattemptid"))).withColumn(
        "__list", F.explode("__lists")).withColumn("stem_str", F.col("__list.list")).drop("__lists", "__list", "__there")
    rows = _attempts_of_users(t).join(rows, "questionattemptid")
    by_number, by_value = list_item(F.col("stem_str"), last_digit(F.col("name")) + 1), list_item(F.col("stem_str"), _whole_value() + 1)
    stem = F.when(is_choice("name"), by_number).when(is_answer("name"), by_value).otherwise(F.lit("0"))
    picked = F.when(_is_sub() | is_choice("name"), by_number).when(is_answer("name"), by_value)
    rows = rows.withColumns({"stem": stem, "choice": F.col("value"), "choice_str": F.col("stem_str")})
    return _with_option(rows, t, picked, own_question=False)


def matrix_answers(t: Tables) -> DataFrame:
    """What learners put into the cells of matrix questions: one row per 'subN' datum, (question attempt, step, stem place, choice place, stem,
    choice), both places from 1.

    The stem stands at N + 1 in the list of stems, the choice at the datum's value in the list of choices; both lists come from one fold of the
    first step's data by question attempt, so they arrive in one row and numbers above nine are read whole. A place outside its list, and a
    value that is no number, has a null stem or choice; an attempt without lists keeps its rows with both null.
    """
    data = _steps_with_data(t)
    lists = data.where((F.col("sequencenumber") == 0) & F.col("name").isin("_stemorder", "_order", "_choiceorder")).groupBy("questionattemptid").agg(
        F.split(F.max(F.when(F.col("name") != "_choiceorder", F.col("value"))), ",").alias("stems"),
        F.split(F.max(F.when(F.col("name") == "_choiceorder", F.col("value"))), ",").alias("choices"))
    cells = data.where(_is_sub()).select(
        "questionattemptid", "attemptstepid", (suffix_number(F.col("name"), "sub") + 1).alias("stem_place"),
        F.col("value").try_cast("int").alias("choice_place"))
    return cells.join(lists, "questionattemptid", "left").select(
        "questionattemptid", "attemptstepid", "stem_place", "choice_place", F.get("stems", F.col("stem_place") - 1).alias("stem"),
        F.get("choices", F.col("choice_place") - 1).alias("choice"))


def answer_steps(t: Tables, value: str | None = None) -> DataFrame:
    """Step data named 'answer', optionally with one value."""
    rows = _attempts_of_users(t).join(_steps_with_data(t), "questionattemptid").where(is_answer("name"))
    return rows if value is None else rows.where(F.col("value") == value)


def last_step_options(t: Tables) -> DataFrame:
    """Option rows of the last step: stem by place in the order list, choice, value and text of the option."""
    counts, attempt = is_choice("name") | is_answer("name"), Window.partitionBy("questionattemptid")
    orders = F.collect_list(F.when(F.col("name") == "_order", F.struct(F.col("value").alias("list")))).over(attempt)
    steps = _steps_with_data(t).where(F.col("questionattemptid").isNotNull()).withColumns(
        {"__last": F.max(F.when(counts, F.col("attemptstepid"))).over(attempt), "__orders": orders})
    steps = steps.where(counts & (F.col("attemptstepid") == F.col("__last"))).withColumn("__order", F.explode("__orders")).withColumn(
        "stem_str", F.col("__order.list")).drop("__last", "__orders", "__order")
    asked = t["question_attempts"].select(F.col("id").alias("questionattemptid"), "questionid")
    listed = t["question_answers"].select(F.col("question").alias("__q"), F.lit(1).alias("__listed"))
    options = t["question_answers"].select(F.col("id").alias("__option"), F.col("fraction").alias("option_val"),
                                           F.col("answer").alias("option_txt"))
    place = F.when(is_choice("name"), last_digit(F.col("name")) + 1).otherwise(
        F.coalesce(F.col("value").try_cast("int"), F.lit(0)) + 1)
    rows = (
        steps.join(asked, "questionattemptid")
        .withColumn("__q", F.when(is_answer("name"), F.col("questionid"))).join(listed, "__q", "left")
        .withColumn("stem", list_item(F.col("stem_str"), place).try_cast("bigint"))
        .join(options, F.col("stem") == F.col("__option"), "left")
    )
    choice = F.when(is_choice("name"), F.col("value").try_cast("int")).when(
        F.col("__option") > 0, F.lit(1)).otherwise(F.lit(0))
    return rows.select("questionattemptid", "attemptstepid", "questionid", "state", "name", "value", "stem",
                       choice.alias("choice"), "option_val", "option_txt")


def user_range_qo_old(ranged: DataFrame, options: DataFrame) -> DataFrame:
    """Ranked questions × their option rows."""
    return ranged.join(options.select("questionattemptid", "name", "stem", "choice", "option_val", "option_txt"),
                       "questionattemptid")


def mart_aud_old(options: DataFrame, t: Tables) -> DataFrame:
    """Options by kind (the name's beginning): an answer meets all listed answers of its question."""
    listed = t["question_answers"].select(F.col("question").alias("__q"), F.col("id").alias("aw_id"),
                                          F.col("fraction").alias("aw_fraction"), F.col("answer").alias("aw_answer"))
    radio = F.substring("name", 1, 6) == "answer"
    rows = options.withColumn("__q", F.when(is_answer("name"), F.col("qid"))).join(listed, "__q", "left")
    hit = ((is_answer("name") & (F.col("aw_id") == F.col("stem"))) | (is_choice("name") & (F.col("choice") == 1)))
    # a null comparison adds nothing to a sum
    chosen = hit.cast("int")
    mart = rows.groupBy(
        *OLD_TEST, "k_q", "max_aqord", "aq_ord", "qid",
        F.when(radio, "radio").otherwise("checkbox").alias("answ_type"),
        F.when(radio, F.col("aw_id")).otherwise(F.col("stem")).alias("option_id"),
        F.when(radio, F.col("aw_fraction")).otherwise(F.col("option_val")).alias("option_val"),
    ).agg(
        F.max(F.when(radio, F.col("aw_answer")).otherwise(F.col("option_txt"))).alias("display"),
        F.count(F.lit(1)).alias("cnt"), F.countDistinct("userid").alias("user_cnt"),
        sum_where(weak(), chosen).alias("weak_num"), sum_where(weak()).alias("weak_denom"),
        sum_where(strong(), chosen).alias("strong_num"), sum_where(strong()).alias("strong_denom"))
    return _platform(with_names(mart, t, prompt=True))


def step_listing(t: Tables, course_id: int | None = None, module: int = QUIZ_MODULE_OTHER_SITE) -> DataFrame:
    """Graded steps of a course in reading order."""
    rows = with_names(graded_attempts(t, module), t, prompt=True)
    if course_id is not None:
        rows = rows.where(F.col("course_id") == course_id)
    return rows.orderBy("course_id", "mid", "qz_id", "userid", "aq_ord")
