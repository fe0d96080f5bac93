"""Small DataFrame helpers: null-safe joins and group statistics without windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.sinks.stage import stage


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on equally named keys where null equals null. Keeps the left keys and the right non-key columns."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        on = same if on is None else on & same
    joined = left.join(renamed, on, how)
    return joined.drop(*[f"__r_{k}" for k in keys])


def with_group_stats(df: DataFrame, keys: Sequence[str], staged: bool = False, **stats: Column) -> DataFrame:
    """Adds statistics of a group to each of its rows.

    Same values as an unordered window, but by a partial aggregation and a join: a group that holds a large part of
    all rows is never sorted in one task. Use a plain window only where the groups are small by nature, such as the
    answers of one user in one test.

    `staged` says that df is a staged table: the statistics are staged too, so their size is known and rows need not be shuffled to meet few groups.
    """
    grouped = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in stats.items()])
    return join_on_keys(df, stage(grouped, "groups", "zstd") if staged else grouped, keys)


def counted(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
