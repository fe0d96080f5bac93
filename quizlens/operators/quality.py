"""Data-quality checks: references, keys, totals, step signatures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.operators.frames import counted, with_group_stats


@dataclass(frozen=True)
class ReferenceRule:
    """Each value of `linked_field` in `linked` should stand in `field` of `base`."""

    base: str
    field: str
    linked: str
    linked_field: str | None = None


def _gaps(tables: Mapping[str, DataFrame], rule: ReferenceRule) -> DataFrame:
    refs = tables[rule.linked].select(F.col(rule.linked_field or rule.field).alias("__ref"))
    base = tables[rule.base].select(F.col(rule.field).alias("__base"))
    return refs.join(base, F.col("__ref") == F.col("__base"), "left_anti")


def _named(rule: ReferenceRule) -> list[Column]:
    return [F.lit(rule.base).alias("name"), F.lit(rule.field).alias("field"), F.lit(rule.linked).alias("foreign_table")]


def missing_rows(tables: Mapping[str, DataFrame], rules: Sequence[ReferenceRule]) -> DataFrame:
    """One row per reference without a base row: (name, field, foreign_table, missed_id). Null references are included as
    null ids, because nothing equals null."""
    parts = [_gaps(tables, r).select(*_named(r), F.col("__ref").cast("string").alias("missed_id")) for r in rules]
    return reduce(DataFrame.unionByName, parts)


def missing_references(tables: Mapping[str, DataFrame], rules: Sequence[ReferenceRule]) -> DataFrame:
    """One row per rule: (name, field, foreign_table, missed_rows) with the list of missing ids in the order of the ids'
    own type, '' when none.

    Each rule is one aggregate over its own gaps, so ids of different types keep their order. A list is one value by
    nature; missing_rows has one row per gap.
    """
    listed = F.expr("coalesce(listagg(CAST(__ref AS STRING), ',') WITHIN GROUP (ORDER BY __ref), '')")
    parts = [_gaps(tables, r).where(F.col("__ref").isNotNull()).agg(listed.alias("missed_rows")).select(*_named(r), "missed_rows") for r in rules]
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that stand more than once, with their count."""
    return counted(df, key, "n").where(F.col("n") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of nulls of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def total_check(scores: DataFrame, keys: Sequence[str], stored: str = "sumgrades",
                score: str = "response_score") -> DataFrame:
    """Stored total against the sum of the scores."""
    return with_group_stats(scores, keys, sumfraction=F.sum(score)).withColumn("agrees", F.col(stored).eqNullSafe(F.col("sumfraction")))


def control_sum(funnel: DataFrame) -> DataFrame:
    """started + completed = total."""
    return funnel.withColumn(
        "balanced", F.coalesce(F.col("started"), F.lit(0)) + F.coalesce(F.col("completed"), F.lit(0)) == F.col("total"))


def distinct_questions(df: DataFrame, attempt: Sequence[str], question: str) -> DataFrame:
    return df.groupBy(*attempt).agg(F.countDistinct(question).alias("n_questions"))


def answer_pairs(steps: DataFrame, is_answer: Column, keys: Sequence[str] = ("qa_id", "qas_id")) -> DataFrame:
    """Distinct (attempt, step) pairs that hold an answer."""
    return steps.where(is_answer).select(*keys).distinct()


def step_signatures(steps: DataFrame, attempt: str = "qa_id", step: str = "qas_id",
                    number: str = "qas_sequencenumber", name: str = "qasd_name") -> DataFrame:
    """Histogram of (number of steps, sorted list of 'number:name') over attempts.

    Equal entries of an attempt are counted before they are collected; the list is written out only for the rows of
    the histogram.
    """
    entry = F.concat_ws("", F.col(number).cast("string"), F.lit(":"), F.col(name))
    entries = counted(steps.select(attempt, entry.alias("entry")), [attempt, "entry"], "times")
    lists = entries.groupBy(attempt).agg(F.sort_array(F.collect_list(F.struct("entry", "times"))).alias("packed"))
    sizes = steps.groupBy(attempt).agg(F.countDistinct(step).alias("steps"))
    histogram = sizes.join(lists, attempt).groupBy("steps", "packed").agg(
        F.count(F.lit(1)).alias("cnt"), F.max(attempt).alias("max_id"), F.min(attempt).alias("min_id"))
    sgnt = F.flatten(F.transform("packed", lambda e: F.array_repeat(e["entry"], e["times"].cast("int"))))
    return histogram.select("steps", sgnt.alias("sgnt"), "cnt", "max_id", "min_id")
