"""Best-fit packing of documents into bins of a fixed number of tokens, under conflicts.

A bin takes no two pieces of one duplicate cluster and at most `per_source` pieces of one source. Pieces are packed in falling size. Open
bins are kept in order of their residual space; a piece looks up the first bin whose residual is large enough and goes on to the next
larger one until it finds a bin that has neither its cluster's bit nor its source's full bit set: the tightest compatible bin. Else it
opens a bin. Each bin carries two bitmaps, of the clusters it holds and of the sources that are full in it.

A text longer than a bin is cut into full pieces and a rest; nothing is dropped. Pieces are dealt to shards of about `shard_pieces` by a hash of their
id and number, each shard is packed by itself in bounded memory, and only the last bins of each shard stay emptier than a single
packer's would. A cluster or source that holds a third of all pieces is spread over all shards.

With `order` the shards are stretches of that order instead, numbered along it: bins sorted by number then follow a mix of the sources,
and each stretch of bins has the mix's proportions.

Defined results: null texts and texts without words have size 0 and are packed as such (piece 0). A null cluster conflicts with
nothing; a null source is a source. Repeated rows are packed each for itself. An empty table gives an empty result. Other columns
are left out.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizlens.sinks.stage import stage


def best_fit(sizes: Sequence[int], sources: Sequence, clusters: Sequence, capacity: int, per_source: int) -> tuple[list[int], list[int]]:
    """Bin of each piece and its place in that bin, for pieces in the given order."""
    source_bit = {s: 1 << k for k, s in enumerate(dict.fromkeys(sources))}
    # only clusters that occur twice can conflict
    often = [c for c, n in Counter(c for c in clusters if c is not None).items() if n > 1]
    cluster_bit = {c: 1 << k for k, c in enumerate(often)}
    open_bins: list[tuple[int, int]] = []  # residual, bin
    full_of: list[int] = []
    holds: list[int] = []
    counts: list[Counter] = []
    filled: list[int] = []
    bins, places = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = source_bit[source], cluster_bit.get(cluster, 0)
        i = bisect_left(open_bins, (size, -1))
        while i < len(open_bins) and (holds[open_bins[i][1]] & c or full_of[open_bins[i][1]] & s):
            i += 1
        if i < len(open_bins):
            residual, b = open_bins.pop(i)
        else:
            residual, b = capacity, len(filled)
            full_of.append(0)
            holds.append(0)
            counts.append(Counter())
            filled.append(0)
        holds[b] |= c
        counts[b][source] += 1
        if counts[b][source] >= per_source:
            full_of[b] |= s
        bins.append(b)
        places.append(filled[b])
        filled[b] += 1
        if residual >= size:
            insort(open_bins, (residual - size, b))
    return bins, places


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def copies(text: Column) -> Column:
    """Cluster of exact copies: a hash of the text, null for texts without words, which conflict with nothing."""
    return F.when(word_count(text) > 0, F.xxhash64(text))


def read_order(docs: DataFrame) -> tuple[Column, Column]:
    """File and row in the file of rows read from Parquet files, which Spark numbers in the order they were written; partition and row of other frames."""
    try:
        docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return F.lpad(F.spark_partition_id().cast("string"), 10, "0"), F.monotonically_increasing_id()
    return F.col("_metadata.file_name"), F.col("_metadata.row_index")


def _positions(rows: DataFrame, pieces: Column, chunk_rows: int = 1024) -> DataFrame:
    """rows with `at`, the number of pieces before each row's own in the order of file and row; summed within chunks, over chunks and over files."""
    rows = rows.withColumns({"chunk": F.floor(F.col("row") / F.lit(chunk_rows)), "pieces": pieces})
    chunks = rows.groupBy("file", "chunk").agg(F.sum("pieces").alias("n"))
    files = chunks.groupBy("file").agg(F.sum("n").alias("n"))

    def before(n: str, window) -> Column:
        return F.coalesce(F.sum(n).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    files = files.select("file", before("n", Window.orderBy("file")).alias("file_at"))
    chunks = chunks.select("file", "chunk", before("n", Window.partitionBy("file").orderBy("chunk")).alias("chunk_at")).join(files, "file")
    placed = rows.withColumn("row_at", before("pieces", Window.partitionBy("file", "chunk").orderBy("row"))).join(chunks, ["file", "chunk"])
    return placed.withColumn("at", F.col("file_at") + F.col("chunk_at") + F.col("row_at"))


def pack(docs: DataFrame, size: Column, cluster: Column, capacity: int = 2048, per_source: int = 2, shard_pieces: int = 4096,
         id: str = "doc_id", source: str = "source", order: tuple[Column, Column] | None = None) -> DataFrame:
    """One row per piece: id, piece, start and size in tokens, bin_id, place in the bin."""
    file, row = order or (F.lit(None).cast("string"), F.lit(None).cast("bigint"))
    rows = stage(docs.select(docs[id].alias("doc_id"), docs[source].cast("string").alias("source"), F.coalesce(size, F.lit(0)).cast("bigint").alias("total"),
                             cluster.cast("bigint").alias("cluster"), file.alias("file"), row.cast("bigint").alias("row")), "packing-sizes")
    last = F.floor(F.greatest(F.col("total") - 1, F.lit(0)) / F.lit(capacity)).cast("bigint")
    placed = rows.withColumn("at", F.lit(0)) if order is None else _positions(rows, last + 1)
    pieces = placed.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    pieces = pieces.select("doc_id", "source", "cluster", "piece", (F.col("at") + F.col("piece")).alias("at"), (F.col("piece") * capacity).alias("start"),
                           F.least(F.lit(capacity), F.col("total") - F.col("piece") * capacity).cast("bigint").alias("size"))
    if order is None:
        n = rows.agg(F.coalesce(F.sum(last + 1), F.lit(0))).first()[0]
        shard = F.pmod(F.xxhash64("doc_id", "piece", "size"), F.lit(-(-n // shard_pieces) or 1))
    else:
        shard = F.floor(F.col("at") / F.lit(shard_pieces))
    dealt = pieces.withColumn("shard", shard.cast("bigint")).drop("at")

    def run(group: pa.Table) -> pa.Table:
        g = group.to_pydict()
        order = sorted(range(group.num_rows), key=lambda i: (-g["size"][i], g["doc_id"][i] is not None, g["doc_id"][i] or 0, g["piece"][i]))
        bins, places = best_fit(*([g[c][i] for i in order] for c in ("size", "source", "cluster")), capacity, per_source)
        first = g["shard"][0] << 32
        at = group.take(pa.array(order, pa.int64())).select(["doc_id", "piece", "start", "size"])
        return at.append_column("bin_id", pa.array([first + x for x in bins], pa.int64())).append_column("place", pa.array(places, pa.int64()))

    schema = f"doc_id {docs.schema[id].dataType.simpleString()}, piece BIGINT, start BIGINT, size BIGINT, bin_id BIGINT, place BIGINT"
    return dealt.groupBy("shard").applyInArrow(run, schema)
