"""Tables, upserts, exports and the ledger of what has been loaded."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from quizlens.sinks.stage import at_once, freed_shuffles


# --- writing --------------------------------------------------------------------------------------------------------
def write_table(df: DataFrame, path: str) -> None:
    """Create or replace."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str, columns: Sequence[str] | None = None, partition_by: Sequence[str] = ()) -> None:
    """Adds rows; `columns` fixes the target's columns and their order."""
    out = df.select(*columns) if columns else df
    out.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], few: bool = False, compression: str | None = None) -> None:
    """Replaces the partitions that occur in df and leaves the others; running it twice gives the same table.

    `few` says that df has few partitions: each task writes to them as its rows lie, and nothing is shuffled for it.
    """
    # rows of one partition meet in few tasks, and a large partition is still split by size
    out = (df if few else df.hint("rebalance", *partition_by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with freed_shuffles(df.sparkSession):
        (out.option("compression", compression) if compression else out).partitionBy(*partition_by).parquet(path)


def append_rows(spark: SparkSession, rows: Sequence[tuple], schema: str, path: str) -> None:
    """Literal rows."""
    append(spark.createDataFrame(list(rows), schema), path)


# fixed values: the charsets that Spark writes and reads without its setting for all of Java's
SPARK_CHARSETS = {"US-ASCII", "ISO-8859-1", "UTF-8", "UTF-16BE", "UTF-16LE", "UTF-16", "UTF-32"}


@contextmanager
def java_charsets(spark: SparkSession, encoding: str) -> Iterator[None]:
    """Lets the actions inside use any charset Java knows, e.g. windows-1251; the session's own setting is put back."""
    name = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(name, None)
    if encoding.upper() in SPARK_CHARSETS:
        yield
        return
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def export_csv(df: DataFrame, path: str, sep: str = ";", encoding: str = "UTF-8") -> None:
    """CSV for spreadsheets, in any charset Java knows, e.g. windows-1251."""
    with java_charsets(df.sparkSession, encoding):
        df.write.mode("overwrite").csv(path, sep=sep, header=True, encoding=encoding, ignoreLeadingWhiteSpace=False,
                                       ignoreTrailingWhiteSpace=False)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def copy_table(source: DataFrame, path: str) -> None:
    """Copies a query's result, e.g. of read_jdbc, to a table."""
    write_table(source, path)


def tag_course(df: DataFrame, course_id: int | Column) -> DataFrame:
    return df.withColumn("course_id", course_id if isinstance(course_id, Column) else F.lit(course_id))


def named_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropTempView(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def table_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jpath)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


# --- upserts --------------------------------------------------------------------------------------------------------
def first_of_key(rows: DataFrame, key: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by `order`, ties by the remaining columns in their order; nulls come first.

    A minimum per key, added up on the map side, so a key that holds a third of the rows is one row per task.
    """
    rest = [c for c in rows.columns if c not in key]
    ranked = [o.alias(f"o{i}") for i, o in enumerate(order)] + [F.col(c).alias(f"c{i}") for i, c in enumerate(rest)]
    if not ranked:
        return rows.distinct()
    least = rows.groupBy(*key).agg(F.min(F.struct(*ranked)).alias("__first"))
    kept = {c: F.col(f"__first.c{i}") for i, c in enumerate(rest)} | {k: F.col(k) for k in key}
    return least.select(*[kept[c].alias(c) for c in rows.columns])


def upsert_ignore(new: DataFrame, existing: DataFrame, key: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Existing rows plus new rows whose key is not there yet; of several new rows of a key the first by `order`, then by their columns."""
    fresh = first_of_key(new, key, order).join(existing, list(key), "left_anti")
    return existing.unionByName(fresh.select(existing.columns))


def upsert_fill(new: DataFrame, existing: DataFrame, key: str, marker: str) -> DataFrame:
    """A row known by key but without marker is filled from the first new row of that key; other new rows are inserted.

    A filled row keeps its own value in the columns `new` does not have.
    """
    columns = existing.columns
    first = Window.partitionBy(key).orderBy(*[c for c in new.columns if c != key])
    ranked = new.withColumn("__rn", F.row_number().over(first))
    open_keys = existing.where(F.col(marker).isNull()).select(key).distinct()
    filling = ranked.where(F.col("__rn") == 1).drop("__rn").select(
        key, F.lit(True).alias("__fill"), *[F.col(c).alias(f"__n_{c}") for c in new.columns if c != key])
    fill = F.col(marker).isNull() & F.col("__fill").isNotNull()
    kept = existing.join(filling, key, "left").select(*[
        F.when(fill, F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c) if c in new.columns and c != key else F.col(c)
        for c in columns])
    used = ranked.join(open_keys.withColumn("__open", F.lit(True)), key, "left")
    inserted = used.where(F.col("__open").isNull() | (F.col("__rn") > 1)).select(*[
        F.col(c) if c in new.columns else F.lit(None).cast(existing.schema[c].dataType).alias(c) for c in columns])
    return kept.unionByName(inserted)


def update_where(df: DataFrame, column: str, *cases: tuple[Column, Column], only: Column | None = None) -> DataFrame:
    """UPDATE … SET column = CASE … on all rows, or on those for which `only` holds."""
    value = None
    for cond, new in cases:
        value = F.when(cond, new) if value is None else value.when(cond, new)
    if only is not None:
        value = F.when(only, value).otherwise(F.col(column))
    return df.withColumn(column, value)


def update_from(df: DataFrame, source: DataFrame, keys: Sequence[str], column: str, only: Column | None = None,
                null_as_zero: bool = False) -> DataFrame:
    """UPDATE … SET column = (SELECT column FROM source WHERE keys agree); no match gives null.

    With null_as_zero keys agree as coalesce(a, 0) = coalesce(b, 0).
    """
    def key(side: str, k: str) -> Column:
        return F.coalesce(F.col(f"{side}.{k}"), F.lit(0)) if null_as_zero else F.col(f"{side}.{k}")

    on = None
    for k in keys:
        same = key("t", k) == key("s", k)
        on = same if on is None else on & same
    joined = df.alias("t").join(source.alias("s"), on, "left")
    new = F.col(f"s.{column}")
    if column in df.columns:
        old = F.col(f"t.{column}")
        new = new if only is None else F.when(only, new).otherwise(old)
    elif only is not None:
        new = F.when(only, new)
    kept = [F.col(f"t.{c}") for c in df.columns if c != column]
    return joined.select(*kept, new.alias(column))


def add_columns(df: DataFrame, **types: str) -> DataFrame:
    return df.withColumns({n: F.lit(None).cast(t) for n, t in types.items()})


# --- ledger and report ----------------------------------------------------------------------------------------------
class Ledger:
    """What has been loaded: (load_name, dest, load_ts) rows in a small table."""

    SCHEMA = "load_name STRING, dest STRING, load_ts TIMESTAMP"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, self.SCHEMA)

    def unseen(self, df: DataFrame, dest: str, name: str = "archive") -> DataFrame:
        """Rows of df whose load has not reached `dest`."""
        done = self.rows().where(F.col("dest") == dest).select(F.col("load_name").alias(name))
        return df.join(done, name, "left_anti")

    def add(self, loads: DataFrame, dest: str, name: str = "archive") -> None:
        """Registers the distinct loads; call it after their rows are written."""
        append(loads.select(F.col(name).alias("load_name")).distinct().select(
            "load_name", F.lit(dest).alias("dest"), F.current_timestamp().alias("load_ts")), self.path)


def _observed(seen: Observation) -> int:
    """Rows that an observed write has seen. Where Spark has found out that there is nothing to write, it drops the observation with the plan."""
    try:
        return int(seen.get["n"])
    except Py4JError:
        return 0


@dataclass
class RunReport:
    """Rows written and seconds per step, and the errors of steps that failed."""

    spark: SparkSession
    steps: list[tuple[str, int | None, float, str | None]] = field(default_factory=list)
    rejected: list[DataFrame] = field(default_factory=list)

    def write(self, step: str, df: DataFrame, writer) -> bool:
        """Runs writer(df) and notes what it did; a failure is recorded and the next steps can go on."""
        return self.write_all([(step, df, writer)])[0]

    def write_all(self, steps: Sequence[tuple]) -> list[bool]:
        """As write() for steps (step, df, writer) that do not read what another one writes; they run at once and are noted in their order."""
        def run(step: str, df: DataFrame, writer) -> tuple:
            seen, start = Observation(), time.monotonic()
            try:
                writer(df.observe(seen, F.count(F.lit(1)).alias("n")))
                return step, _observed(seen), time.monotonic() - start, None
            except Exception as error:  # noqa: BLE001 - reported
                return step, None, time.monotonic() - start, f"{type(error).__name__}: {error}"

        done = [run(*steps[0])] if len(steps) == 1 else at_once(self.spark, [lambda s=s: run(*s) for s in steps])
        self.steps += done
        return [error is None for *_, error in done]

    def reject(self, step: str, errors: DataFrame) -> None:
        """Notes archives that could not be read: (archive, error)."""
        self.rejected.append(errors.select(F.lit(step).alias("step"), "archive", "error"))

    def rejects(self) -> DataFrame:
        out = self.spark.createDataFrame([], "step STRING, archive STRING, error STRING")
        for part in self.rejected:
            out = out.unionByName(part)
        return out

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.steps, "step STRING, n BIGINT, seconds DOUBLE, error STRING")
