"""Mixing sources to target weights by Pfair scheduling.

Each source is a stream of blocks of `block_size` units (characters, tokens or rows); one block takes one slot. With integer weights a of
total W, block j (from 1) of a source is released at slot floor((j-1)*W/a) and due by slot ceil(j*W/a); every slot goes to the released
block with the earliest deadline. At every slot the blocks given to a source then differ from its share of the slots by less than one
block. After W slots each source has had exactly its weight of blocks, so the schedule repeats: only one period is worked out (W is
bounded by `resolution` plus the number of sources), and a block's slot follows from its number alone. Slots of sources that have run out stay empty;
the rest keep their proportions, and nothing is dropped or repeated.

Rows of a source are ordered by a hash of their id. Their running sizes are summed in two steps, within (source, leading hash digits) and
over the digits, so that a source with a third of all rows is not one task.

Defined results: a null source is a source of its own. A null size counts 0. A row belongs to the block in which it starts. Null ids are
ordered by a hash of the whole row; repeated rows follow one another. Empty tables give empty results. Other columns are carried
along; columns named as the output's are replaced.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_SOURCES = 10_000
NEW = ("size", "block", "slot", "place")


def whole_weights(shares: Mapping[str, float], resolution: int) -> dict[str, int]:
    """Integer weights of about `resolution` in total, at least 1 each."""
    total = math.fsum(shares.values()) or 1.0
    return {s: max(1, round(resolution * v / total)) for s, v in sorted(shares.items())}


def period(weights: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """(source, block number in the period, slot in the period), slot by slot, earliest deadline first."""
    total = sum(weights.values())
    waiting = [(0, s, 0) for s in weights]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, str, int]] = []  # deadline, heavier first, source, block
    out = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // weights[s]), -weights[s], s, j))
        _, _, s, j = heapq.heappop(ready)
        out.append((s, j, slot))
        if j + 1 < weights[s]:
            heapq.heappush(waiting, ((j + 1) * total // weights[s], s, j + 1))
    return out


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def mix(docs: DataFrame, size: Column, weights: Mapping[str | None, float] | None = None, block_size: int = 65536, temperature: float = 0.5,
        resolution: int = 1000, source: str = "source", id: str = "doc_id", digits: int = 3) -> DataFrame:
    """docs with size, block (number within its source), slot and place (start within the block). Order by slot, place, id.

    Without weights a source's share is its total size to the power `temperature`; sources missing from given weights get the smallest one.
    """
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c not in NEW]
    name = F.coalesce(docs[id].cast("string"), F.concat(F.lit("row"), F.xxhash64(*[docs[c] for c in docs.columns]).cast("string")))
    rows = docs.select(
        *[docs[c] for c in rest], F.coalesce(size, F.lit(0)).cast("bigint").alias("size"), _key(docs[source]).alias("__source"), F.md5(name).alias("__hash"),
    ).withColumn("__digits", F.substring("__hash", 1, digits))

    # sums per (source, leading digits): sources * 16^digits rows at most
    part = rows.groupBy("__source", "__digits").agg(F.sum("size").alias("__sum"))
    before = Window.partitionBy("__source").orderBy("__digits").rowsBetween(Window.unboundedPreceding, -1)
    starts = part.select("__source", "__digits", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))

    totals = {r[0]: r[1] for r in part.groupBy("__source").agg(F.sum("__sum")).limit(MAX_SOURCES + 1).collect()}
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is None:
        shares = {s: float(t) ** temperature for s, t in totals.items()}
    else:
        given = {("null" if s is None else "=" + str(s)): float(w) for s, w in weights.items()}
        shares = {s: given.get(s, min(given.values(), default=1.0)) for s in totals}
    units = whole_weights(shares, resolution)
    total = sum(units.values())
    # resolution + MAX_SOURCES rows at most: a bounded broadcast
    slots = F.broadcast(spark.createDataFrame(
        [(s, j, t, units[s]) for s, j, t in period(units)], "__source STRING, __turn BIGINT, __slot BIGINT, __units BIGINT"))

    within = Window.partitionBy("__source", "__digits").orderBy("__hash", id, "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__before", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, ["__source", "__digits"])
    at = F.col("__before") + F.col("__start")
    placed = placed.withColumn("block", F.floor(at / F.lit(block_size)).cast("bigint")).withColumn("place", at - F.col("block") * block_size)
    # the source's weight decides the turn, so it is joined first; both tables are bounded as above
    heavy = F.broadcast(spark.createDataFrame(list(units.items()), "__source STRING, __weight BIGINT"))
    placed = placed.join(heavy, "__source").withColumn("__turn", F.col("block") % F.col("__weight"))
    placed = placed.join(slots, ["__source", "__turn"])
    slot = F.floor(F.col("block") / F.col("__weight")).cast("bigint") * F.lit(total) + F.col("__slot")
    return placed.select(*rest, "size", "block", slot.cast("bigint").alias("slot"), F.col("place").cast("bigint").alias("place"))


def in_order(mixed: DataFrame, id: str = "doc_id") -> DataFrame:
    """Rows in mixed order: range partitions by slot, each sorted."""
    return mixed.repartitionByRange("slot", "place", id).sortWithinPartitions("slot", "place", id)
