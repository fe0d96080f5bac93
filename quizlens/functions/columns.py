"""Column helpers. All of them are built-in expressions, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def list_item(ids: Column, n: Column | int) -> Column:
    """The n-th entry (1-based) of a comma-separated id list; '' when n is out of range, null for a null list."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.when(ids.isNotNull(), F.coalesce(F.get(F.split(ids, ","), n - 1), F.lit("")))


def suffix_number(name: Column, prefix: str) -> Column:
    """The number after a prefix: 'choice10' -> 10. Null when there is none."""
    return F.substring(name, F.lit(len(prefix) + 1), F.length(name)).try_cast("int")


def last_digit(name: Column) -> Column:
    """The last character as a number, the older rule for 'choiceN' (right only below ten); no digit counts as 0."""
    return F.coalesce(F.right(name, F.lit(1)).try_cast("int"), F.lit(0))


def concat_skip_nulls(*cols: Column) -> Column:
    return F.concat_ws("", *cols)


def short_option_id(option_id: Column) -> Column:
    """Option ids written as fractions differ in their tail between files; their first ten characters agree."""
    return F.when(option_id.startswith("0."), F.substring(option_id, 1, 10)).otherwise(option_id)


def score_of(correct: Column) -> Column:
    """1 for true, 0 for false and for null."""
    return F.when(correct, F.lit(1)).otherwise(F.lit(0))


def text_hash(text: Column) -> Column:
    """A stable id for a text."""
    return F.xxhash64(text).cast("string")


def surrogate_id(*key: Column) -> Column:
    """A stable 64-bit id of a natural key; made in every task alone, without a global counter."""
    return F.xxhash64(*key)


def none_if_missing(col: Column) -> Column:
    return F.coalesce(col, F.lit("none"))


def file_name(url: Column) -> Column:
    """What follows the last slash, trimmed."""
    return F.trim(F.regexp_replace(F.substring_index(url, "/", -1), r"[\r\n]", ""))


def log_time(text: Column) -> Column:
    """Time of a log line to the second, from ISO text with fraction and zone; null when it is no time."""
    return F.try_to_timestamp(F.substring(text, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")


# Block locators: block-v1:<course>+type@<kind>+block@<id>

def course_of_block(locator: Column) -> Column:
    return F.regexp_extract(locator, r"^block-v1:(.*?)\+type@", 1)


def block_kind(locator: Column) -> Column:
    return F.regexp_extract(locator, r"\+type@([^+]*)\+", 1)


def block_part(locator: Column) -> Column:
    return F.substring_index(locator, "+block@", -1)


# Problem and question ids of the tracking log

def course_of_problem(problem_id: Column) -> Column:
    """Text after the 13-character locator prefix, up to the first plus sign."""
    rest = F.substring(problem_id, F.lit(14), F.length(problem_id))
    return F.substring(rest, F.lit(1), F.greatest(F.instr(rest, "+") - 1, F.lit(0)))


def problem_of_question(question_id: Column) -> Column:
    """Text before the first underscore."""
    return F.substring(question_id, F.lit(1), F.greatest(F.instr(question_id, "_") - 1, F.lit(0)))


def question_number(question_id: Column) -> Column:
    """The number between the first and the second underscore, minus one, because numbering starts at two."""
    return F.get(F.split(question_id, "_"), F.lit(1)).try_cast("int") - 1
