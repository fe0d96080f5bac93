"""Exact top-k search by inner product, block at a time.

Vectors are whole numbers: floor(scale * x) per component. Candidates are put in an order that brings like vectors together (by the
dimension of their largest component and its sign, then by id) and cut into shards of `shard_rows`, each shard into blocks of `block_rows`. A block
keeps per dimension the largest and the smallest component (the maxima of its terms) and a forward index, its matrix.

Queries are cut into groups of `group_rows`. Each (query group, shard) cell is one unit of work of bounded size: for every query the bounds of all
blocks are summed from the term maxima, blocks are visited from the highest bound down, and a query leaves as soon as the next bound is
below its k-th score (equal bounds are visited, since ties go to the smaller id). The cells' k best per query are merged by a partial
aggregate. The result is exact.

The work is queries x candidates in blocks. Shards are sent to as many cells as there are query groups, queries to as many as there are
shards; no row per pair is made.

Defined results: vectors that are null or hold null or non-finite components, and rows with a null id, take no part. Missing components count
as 0, so vectors of different lengths can meet. Rows with one id are one vector, the smallest of theirs. Components and scores beyond 64
bits are clipped. Empty tables give empty results; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizlens.sinks.stage import stage

_EXACT = float(1 << 53)


def whole_vectors(rows: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """(id, v): the rows that take part, one per id."""
    good = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = rows.select(rows[id].cast("bigint").alias("id"), rows[vector].cast("array<double>").alias("v")).where(F.col("id").isNotNull() & good)
    return kept.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("bigint")).alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of an integer list column as a matrix, filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    width = int(max(lengths.max(initial=0), width or 0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows; clipped to 64 bits."""
    size = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if size < _EXACT:  # every partial sum is a whole number that a double holds exactly
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if size < 2.0**63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -(2**63), 2**63 - 1).astype(np.int64)


def search_blocks(queries: np.ndarray, query_ids: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Ids and scores of the k best candidates per query (id -1 where there are fewer), and the number of (query, block) pairs scored."""
    n = len(queries)
    best_s, best_i = np.full((n, k), np.iinfo(np.int64).min), np.full((n, k), -1, np.int64)
    filled = np.zeros(n, np.int64)
    if not blocks or not n:
        return best_i, best_s, 0
    high = np.array([m.max(0) for _, m in blocks]).astype(float)
    low = np.array([m.min(0) for _, m in blocks]).astype(float)
    q = queries.astype(float)
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    bounds += 1e-9 * np.abs(bounds) + 1  # rounding never takes a bound below its block's scores
    order = np.argsort(-bounds, axis=1, kind="stable")
    active, scored = np.arange(n), 0
    for turn in range(len(blocks)):
        nxt = order[active, turn]
        live = (filled[active] < k) | (bounds[active, nxt] >= best_s[active, k - 1])
        active, nxt = active[live], nxt[live]
        if not len(active):
            break
        scored += len(active)
        for b in np.unique(nxt):
            rows = active[nxt == b]
            ids, m = blocks[b]
            s = products(queries[rows], m)
            own = ids[None, :] == query_ids[rows][:, None]
            floor = np.where(filled[rows] < k, np.iinfo(np.int64).min, best_s[rows, k - 1])
            if m.shape[0] > k:  # nothing below the block's own k-th score can enter; one place more for the query itself
                kk = min(k + 1, m.shape[0])
                floor = np.maximum(floor, np.partition(s, m.shape[0] - kk, axis=1)[:, m.shape[0] - kk])
            r, c = np.nonzero((s >= floor[:, None]) & ~own)
            all_r = np.concatenate([r, np.repeat(np.arange(len(rows)), filled[rows])])
            have = np.arange(k)[None, :] < filled[rows][:, None]
            all_s = np.concatenate([s[r, c], best_s[rows][have]])
            all_i = np.concatenate([ids[c], best_i[rows][have]])
            o = np.lexsort((all_i, np.invert(all_s), all_r))
            all_r, all_s, all_i = all_r[o], all_s[o], all_i[o]
            counts = np.bincount(all_r, minlength=len(rows))
            place = np.arange(len(all_r)) - np.repeat(np.cumsum(counts) - counts, counts)
            keep = place < k
            best_s[rows[all_r[keep]], place[keep]] = all_s[keep]
            best_i[rows[all_r[keep]], place[keep]] = all_i[keep]
            filled[rows] = np.minimum(counts, k)
    return best_i, best_s, scored


def top_k(rows: DataFrame, is_query: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding", scale: int = 1024, block_rows: int = 512,
          shard_rows: int = 16384, group_rows: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows for each row whose id meets `is_query` (a condition over `id`)."""
    clean = stage(whole_vectors(rows, id, vector, scale), "topk-vectors")
    magnitude = F.transform("v", lambda x: F.abs(x))
    dominant = F.array_position(magnitude, F.array_max(magnitude))
    likeness = F.coalesce(F.when(F.get("v", (dominant - 1).cast("int")) < 0, -dominant).otherwise(dominant), F.lit(0))
    n, n_queries = clean.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    shards, groups = -(-n // shard_rows) or 1, -(-n_queries // group_rows) or 1

    # range partitions by (likeness, id) are the shards; each is sent to every query group's cell
    ranged = clean.withColumn("likeness", likeness).repartitionByRange(shards, "likeness", "id").withColumn("shard", F.spark_partition_id())
    candidates = ranged.select("shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(False).alias("query"), "likeness", "id", "v")
    queries = clean.where(is_query).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group"),
        F.lit(True).alias("query"), F.lit(0).cast("bigint").alias("likeness"), "id", "v")

    def cell(table: pa.Table) -> pa.Table:
        is_q = table.column("query").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        ids = table.column("id").to_numpy()
        like = table.column("likeness").to_numpy()
        m = _matrix(table.column("v"))
        at = np.flatnonzero(~is_q)
        at = at[np.lexsort((ids[at], like[at]))]
        blocks = [(ids[at[b : b + block_rows]], m[at[b : b + block_rows]]) for b in range(0, len(at), block_rows)]
        found, scores, _ = search_blocks(m[is_q], ids[is_q], blocks, k)
        has = scores > np.iinfo(np.int64).min
        has |= found >= 0
        r, c = np.nonzero(has)
        return pa.table({"query_id": pa.array(ids[is_q][r]), "vec_id": pa.array(found[r, c]), "score": pa.array(scores[r, c])})

    both = candidates.unionByName(queries)
    found = both.groupBy("shard", "group").applyInArrow(cell, "query_id BIGINT, vec_id BIGINT, score BIGINT")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
