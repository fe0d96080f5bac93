"""Column expressions: text decoding, scores, reliability formulas."""

from quizlens.functions.columns import (
    block_kind,
    block_part,
    concat_skip_nulls,
    course_of_block,
    course_of_problem,
    file_name,
    last_digit,
    list_item,
    log_time,
    none_if_missing,
    problem_of_question,
    question_number,
    score_of,
    short_option_id,
    suffix_number,
    surrogate_id,
    text_hash,
)
from quizlens.functions.reliability import alpha_legacy, alpha_smoothed, variance

__all__ = [
    "alpha_legacy", "alpha_smoothed", "block_kind", "block_part", "concat_skip_nulls", "course_of_block",
    "course_of_problem", "file_name", "last_digit", "list_item", "log_time", "none_if_missing",
    "problem_of_question", "question_number", "score_of", "short_option_id", "suffix_number", "surrogate_id",
    "text_hash", "variance",
]
