"""Fold of answers to one row per learner and test, with the terms of Cronbach's alpha."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.functions.reliability import alpha_legacy, alpha_smoothed, variance
from quizlens.operators.frames import with_group_stats
from quizlens.sinks.stage import stage


def with_question_variance(df: DataFrame, question_keys: Sequence[str], score: str = "response_score",
                           estimator: str = "sample", staged: bool = False) -> DataFrame:
    """Variance of the score over all answers to a question, on each answer. `staged`: df is a staged table."""
    return with_group_stats(df, question_keys, staged, question_var=variance(score, estimator))


def user_fold(
    df: DataFrame,
    user_keys: Sequence[str],
    test_keys: Sequence[str],
    score: str = "response_score",
    estimator: str = "sample",
    formula: str | None = "smoothed",
    count_as: str = "k_a",
    **extra: Column,
) -> DataFrame:
    """One row per `user_keys`: resp_sum, ssi2 (sum of item variances), number of answers, sx2 (variance of the sums
    over `test_keys`) and the reliability. Expects question_var on the rows, which are read once: the fold is staged."""
    folded = df.groupBy(*user_keys).agg(
        F.sum(score).alias("resp_sum"),
        F.sum("question_var").alias("ssi2"),
        F.count(F.lit(1)).alias(count_as),
        *[e.alias(n) for n, e in extra.items()],
    )
    folded = with_group_stats(stage(folded, "learners", "zstd"), test_keys, True, sx2=variance("resp_sum", estimator))
    if formula is None:
        return folded
    alpha = {"smoothed": alpha_smoothed, "legacy": alpha_legacy}[formula]
    return folded.withColumn("reliab", alpha(F.col("ssi2"), F.col("sx2"), F.col(count_as)))
