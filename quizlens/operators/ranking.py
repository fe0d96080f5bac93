"""Exact ranks and rank shares over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizlens.operators.frames import join_on_keys
from quizlens.sinks.stage import stage

# A group of up to so many rows is ranked by one window; in a larger one, one in so many folded rows becomes a cut, so a bucket holds about this many rows.
BUCKET_ROWS = 1 << 20


def _large_groups(df: DataFrame, groups: Sequence[str], bucket_rows: int) -> DataFrame | None:
    """The groups of more than `bucket_rows` rows as a staged table of at most rows / bucket_rows rows; None where there is none."""
    counts = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > bucket_rows)
    large = stage(counts.drop("__rows"), "large-groups")
    return None if large.isEmpty() else large


def _sort_key(names: Sequence[str], nulls: str) -> Column:
    """A struct which compares like ORDER BY names ASC with the given place of nulls."""
    parts: list[Column] = []
    for n in names:
        flag = F.col(n).isNull() if nulls == "last" else F.col(n).isNotNull()
        parts += [flag, F.col(n)]
    return F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])


def rank_share(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    rank: str | None = "rnk",
    share: str | None = "cd",
    dense: bool = False,
    nulls: str = "last",
    bucket_rows: int = BUCKET_ROWS,
    weight: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Adds rank() (or dense_rank()) and cume_dist() by group in ascending order of the order columns.

    Groups are counted first. Those of up to `bucket_rows` rows are ranked by a window: one shuffle by group, and nothing is joined back.

    Rows of the larger ones with the same order key are peers, so they are first folded to one row per (group, order key) with a
    count; ranks are running sums of the counts. A group is cut into ordered buckets by a fixed share of its own keys
    (chosen by hash, so a task that is run again picks the same ones), each bucket is summed in its own task, and the
    rows before the bucket are added. No large group is sorted whole in one task, and nothing is approximate.
    For a descending key pass its negation as a column.

    df is read twice. With `weight` a row of df stands for that many rows.
    `unique` says that no two rows share a (group, order key), so nothing has to be folded and joined back.
    """
    if nulls not in ("last", "first"):
        raise ValueError("nulls must be 'last' or 'first'")
    groups, order = list(groups), list(order)
    large = _large_groups(df, groups, bucket_rows)
    if large is None:
        return _window_ranks(df, groups, order, rank, share, dense, nulls, weight)
    small = _window_ranks(join_on_keys(df, large, groups, "left_anti"), groups, order, rank, share, dense, nulls, weight)
    return small.unionByName(_bucket_ranks(join_on_keys(df, large, groups, "left_semi"), groups, order, rank, share, dense, nulls, bucket_rows, weight, unique))


def _window_ranks(df: DataFrame, groups: list[str], order: list[str], rank: str | None, share: str | None, dense: bool, nulls: str,
                  weight: str | None) -> DataFrame:
    ordered = Window.partitionBy(*groups).orderBy(*_ordering(order, nulls))
    upto = F.sum(weight).over(ordered) if weight else None  # peers included
    out = {}
    if rank:
        if dense:
            value = F.dense_rank().over(ordered)
        else:
            value = upto - F.sum(weight).over(Window.partitionBy(*groups, *order)) + 1 if weight else F.rank().over(ordered)
        out[rank] = value.cast("bigint")
    if share:
        out[share] = upto / F.sum(weight).over(Window.partitionBy(*groups)) if weight else F.cume_dist().over(ordered)
    return df.select("*", *[c.alias(n) for n, c in out.items()])


def _bucket_ranks(df: DataFrame, groups: list[str], order: list[str], rank: str | None, share: str | None, dense: bool, nulls: str,
                  bucket_rows: int, weight: str | None, unique: bool) -> DataFrame:
    if unique:
        folded = df.withColumn("__n", F.col(weight) if weight else F.lit(1).cast("bigint"))
    else:
        rows = F.sum(weight) if weight else F.count(F.lit(1))
        folded = df.groupBy(*groups, *order).agg(rows.alias("__n"))
    ranked = _running_ranks(stage(folded, "ranks"), groups, order, nulls, bucket_rows)
    out = []
    if rank:
        value = F.col("__keys") if dense else F.col("__upto") - F.col("__n") + 1
        out.append(value.cast("bigint").alias(rank))
    if share:
        out.append((F.col("__upto") / F.col("__total")).alias(share))
    if unique:
        return ranked.select(*df.columns, *out)
    return join_on_keys(df, ranked.select(*groups, *order, *out), groups + order)


def _ordering(order: list[str], nulls: str) -> list[Column]:
    return [F.col(o).asc_nulls_last() if nulls == "last" else F.col(o).asc_nulls_first() for o in order]


def _cuts_below(cuts: Column, key: Column) -> Column:
    """Number of entries of a sorted array that are below the key, by binary search."""
    size = F.size(cuts)
    middle = lambda a: F.floor((a["low"] + a["high"]) / 2).cast("int")
    step = lambda a, _: F.when(a["low"] >= a["high"], a).when(
        F.get(cuts, middle(a)) < key, F.struct((middle(a) + 1).alias("low"), a["high"].alias("high"))).otherwise(
        F.struct(a["low"].alias("low"), middle(a).alias("high")))
    steps = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), size.alias("high")), step, lambda a: a["low"])


def _running_ranks(folded: DataFrame, groups: list[str], order: list[str], nulls: str, bucket_rows: int) -> DataFrame:
    key = _sort_key(order, nulls)
    cuts = (
        folded.where(F.pmod(F.xxhash64(*groups, *order), F.lit(bucket_rows)) == 0)
        .groupBy(*groups).agg(F.sort_array(F.collect_list(key)).alias("__cuts"))
    )
    bucketed = (
        join_on_keys(folded.withColumn("__key", key), cuts, groups, "left")
        .withColumn("__bucket", F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(_cuts_below(F.col("__cuts"), F.col("__key"))))
        .drop("__cuts", "__key")
    )
    by_bucket = Window.partitionBy(*groups).orderBy("__bucket")
    before = by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        bucketed.groupBy(*groups, "__bucket").agg(F.sum("__n").alias("__rows"), F.count(F.lit(1)).alias("__distinct"))
        .select(
            *groups, "__bucket",
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
            F.coalesce(F.sum("__distinct").over(before), F.lit(0)).alias("__keys_before"),
            F.sum("__rows").over(Window.partitionBy(*groups)).alias("__total"),
        )
    )
    inside = (Window.partitionBy(*groups, "__bucket").orderBy(*_ordering(order, nulls))
              .rowsBetween(Window.unboundedPreceding, 0))
    return (
        join_on_keys(bucketed, totals, groups + ["__bucket"])
        .withColumn("__upto", F.col("__rows_before") + F.sum("__n").over(inside))
        .withColumn("__keys", F.col("__keys_before") + F.count(F.lit(1)).over(inside))
    )


def learner_ranks(rows: DataFrame, test: Sequence[str], user: str, score: str, question_order: str | None = None,
                  dense: bool = False, nulls: str = "last", count_as: str = "k_q") -> DataFrame:
    """Adds rank and rank share of the learner in the test by (score, learner), the number of answers of the learner in
    the test, and, when question_order is named, the greatest question order (max_aqord).

    Tests of up to BUCKET_ROWS answers get all marks from windows over one shuffle by test. Answers of larger tests are folded to learners first
    (partial aggregation, so a learner or test with very many answers is no hot task). `rows` is read twice.
    """
    test = list(test)
    large = _large_groups(rows, test, BUCKET_ROWS)
    if large is None:
        return _learner_windows(rows, test, user, score, question_order, dense, nulls, count_as)
    small = _learner_windows(join_on_keys(rows, large, test, "left_anti"), test, user, score, question_order, dense, nulls, count_as)
    return small.unionByName(_folded_learners(join_on_keys(rows, large, test, "left_semi"), test, user, score, question_order, dense, nulls, count_as))


def _learner_windows(rows: DataFrame, test: list[str], user: str, score: str, question_order: str | None, dense: bool, nulls: str,
                     count_as: str) -> DataFrame:
    # ranks first: rows dealt by test are dealt by learner of the test too
    ranked = _window_ranks(rows, test, [score, user], "rnk", "cd", dense, nulls, None)
    learner = Window.partitionBy(*test, user)
    marks = {count_as: F.count(F.lit(1)).over(learner)}
    if question_order:
        marks["max_aqord"] = F.max(question_order).over(learner)
    return ranked.withColumns(marks).select(*rows.columns, *marks, "rnk", "cd")


def _folded_learners(rows: DataFrame, test: list[str], user: str, score: str, question_order: str | None, dense: bool, nulls: str,
                     count_as: str) -> DataFrame:
    keys = [*test, user, score]
    last = [F.max(question_order).alias("__last")] if question_order else []
    folded = stage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), *last), "learners")
    # a learner has one folded row per distinct score in the test
    learner = Window.partitionBy(*test, user)
    marks = {count_as: F.sum("__rows").over(learner)}
    if question_order:
        marks["max_aqord"] = F.max("__last").over(learner)
    ranked = rank_share(folded.withColumns(marks), test, [score, user], dense=dense, nulls=nulls, weight="__rows", unique=True)
    return join_on_keys(rows, ranked.drop("__rows", "__last"), keys)


def strong(cd: Column | str = "cd", cut: float = 0.75) -> Column:
    """Learners above the upper cut."""
    cd = F.col(cd) if isinstance(cd, str) else cd
    return cd > F.lit(cut)


def weak(cd: Column | str = "cd", cut: float = 0.25, inclusive: bool = False) -> Column:
    """Learners below the lower cut; one mart counts those on the cut too."""
    cd = F.col(cd) if isinstance(cd, str) else cd
    return cd <= F.lit(cut) if inclusive else cd < F.lit(cut)


def sum_where(cond: Column, value: Column | int = 1) -> Column:
    """sum(case when cond then value else 0 end)."""
    value = F.lit(value) if isinstance(value, int) else value
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def is_last_row(df: DataFrame, groups: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """floor(cume_dist()): 1 on the last peer group in ascending order with nulls last, else 0.

    Read from the end, the last peers are those of rank 1: one shuffle and one sort, and no row of a group is held. Meant for many groups, such as
    steps or orders; the rows of one group are read by one task.
    """
    from_end = Window.partitionBy(*groups).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    return df.withColumn(name, (F.rank().over(from_end) == 1).cast("bigint"))


def latest_only(df: DataFrame, groups: Sequence[str], order: str) -> DataFrame:
    """Rows whose order value is the greatest of their group, i.e. cume_dist() = 1."""
    top = df.groupBy(*groups).agg(F.max(order).alias("__top"))
    return join_on_keys(df, top, groups).where(F.col(order).eqNullSafe(F.col("__top"))).drop("__top")


def after_offset(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """ORDER BY … OFFSET n: exactly the rows after the first n, whatever the number of ties.

    Rows are counted per key and the counts summed over ordered buckets, so no task sees all rows. Of rows that tie at the
    bound, those with the smaller hash count as first. `order` holds ascending sort expressions, nulls first; the sort of
    the result is the caller's.
    """
    if n <= 0:
        return df
    keys = [f"__k{i}" for i in range(len(order))]
    keyed = df.withColumns(dict(zip(keys, order, strict=True)))
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt")).withColumn("__all", F.lit(1))
    ranked = rank_share(counts, ["__all"], keys, rank="__rank", share=None, nulls="first", weight="__cnt", unique=True)
    # rows of a key that still belong to the first n
    before = ranked.select(*keys, "__cnt", F.greatest(F.lit(n) - F.col("__rank") + 1, F.lit(0)).alias("__skip")).where("__skip < __cnt")
    kept = join_on_keys(keyed, before, keys)
    split = kept.where("__skip > 0").withColumn("__row", F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*df.columns))))
    whole = kept.where("__skip = 0").select(*df.columns)
    return whole.unionByName(split.where("__row > __skip").select(*df.columns))
