"""Choosing the attempt, the step or the row of a learner that counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizlens.sinks.stage import stage


def first_starts(events: DataFrame, keys: Sequence[str], start: str = "action_start_ts", time: str | None = None,
                 **extra: Column) -> DataFrame:
    """Earliest start per key, and the earliest time when `time` is named; the two minima are independent."""
    aggs = [F.min(start).alias(start)]
    if time:
        aggs.append(F.min(time).alias(time))
    aggs += [expr.alias(name) for name, expr in extra.items()]
    return events.groupBy(*keys).agg(*aggs)


def first_attempts(
    answers: DataFrame,
    placed: DataFrame,
    keys: Sequence[str] = ("course_id", "user_ext_id", "item_id"),
    rule: str = "both_minima",
    join_on: Sequence[str] = ("course_id", "user_ext_id"),
    start: str = "action_start_ts",
    time: str = "action_ts",
) -> DataFrame:
    """Answer rows of the first attempt.

    `placed` is the answer log with the item each answer belongs to; `answers` is the log itself. The first start (and
    with rule 'both_minima' the first time, taken independently) of each key is joined back to the log on `join_on`
    and the minima. Two properties of the rule are kept on purpose: a learner whose two minima never meet in one row
    is dropped, and the join back knows no item, so rows of another item with the same times come along.
    """
    if rule == "both_minima":
        firsts = first_starts(placed, keys, start, time)
        on = [*join_on, time, start]
    elif rule == "start_only":
        firsts = first_starts(placed, keys, start)
        on = [*join_on, start]
    else:
        raise ValueError("rule must be 'both_minima' or 'start_only'")
    return answers.join(firsts, on)


def last_steps(steps: DataFrame, counts: Column, attempt: str = "qa_id", step: str = "qas_id") -> DataFrame:
    """(attempt, step): the greatest step id among the rows for which `counts` holds."""
    return steps.where(counts).groupBy(attempt).agg(F.max(step).alias(step))


def rows_of_last_step(steps: DataFrame, counts: Column, attempt: str = "qa_id", step: str = "qas_id") -> DataFrame:
    return steps.join(last_steps(steps, counts, attempt, step), [attempt, step])


def first_attempts_of_learners(
    answers: DataFrame,
    places: DataFrame,
    learner: Sequence[str] = ("course_id", "user_ext_id"),
    place: Sequence[str] = ("course_id", "assessment_ext_id"),
    rule: str = "both_minima",
    item: str = "item_id",
    start: str = "action_start_ts",
    time: str = "action_ts",
) -> DataFrame:
    """first_attempts() of answers that belong to the items of `places`, with one shuffle of the answers.

    `places` names the items of a `place`; it is small and staged, so its size decides how the answers meet it. The answers of one `learner`, few by
    nature, are dealt to one task, which finds the minima per item and keeps the rows that meet them, whatever their own item.
    """
    if rule not in ("both_minima", "start_only"):
        raise ValueError("rule must be 'both_minima' or 'start_only'")
    marks = {"__start": start} | ({"__time": time} if rule == "both_minima" else {})
    listed = places.select(*place, item).distinct().groupBy(*place).agg(F.collect_list(F.struct(item)).alias("__items"))
    rows = answers.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in learner])).join(stage(listed, "places", "zstd"), [*place], "left")
    placed = rows.repartition(*learner).select("*", F.posexplode_outer("__items").alias("__pos", "__place")).withColumns(
        {"__placed": F.col("__pos").isNotNull(), "__item": F.col(f"__place.{item}")})
    at_item = Window.partitionBy(*learner, "__placed", "__item")
    placed = placed.withColumns({m: F.min(c).over(at_item) for m, c in marks.items()})
    firsts = F.collect_set(F.when(F.col("__placed"), F.struct("__item", *marks))).over(Window.partitionBy(*learner))
    # an answer stands once per item of its place; one of them speaks for it
    own = placed.withColumn("__firsts", firsts).where(F.coalesce("__pos", F.lit(0)) == 0)
    met = F.filter("__firsts", lambda f: reduce(Column.__and__, [f[m] == F.col(c) for m, c in marks.items()]))
    return own.select(*answers.columns, F.explode(F.transform(met, lambda f: f["__item"])).alias(item))


def complete_only(df: DataFrame, answered: str = "k_q", last_ord: str = "max_aqord", order_base: int = 0) -> DataFrame:
    """Rows of learners who answered every question of the test."""
    return df.where(F.col(answered) == F.col(last_ord) + (1 - order_base))


def first_n_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each group in the given order. Spark cuts each group to n rows before the shuffle."""
    rn = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn("__rn", rn).where(F.col("__rn") <= n).drop("__rn")
