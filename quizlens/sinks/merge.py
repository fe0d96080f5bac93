"""Upserts into a stored table that rewrite only the partitions they touch.

A keyed table lies in `slots` partitions by a hash of its key. A merge finds the slots of its rows, reads and rewrites these and leaves all other
files as they are: a load of some thousand rows costs some slots, not the table. The new rows are staged first, so the slots and the merge see the
same rows; the result of a merge is staged before it replaces what it was read from, and replacing slots twice gives the same table, so a merge
that was cut off is run again. Choose the number of slots so that one fits a task, e.g. bytes / 256 MB; at most that many values of `slot` come to
the driver. The key's values should be many: rows of one key are always in one slot.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlens.sinks.stage import scratch_path, stage
from quizlens.sinks.tables import first_of_key, overwrite_partitions, table_exists, upsert_fill, upsert_ignore

SLOT = "slot"


class KeyedTable:
    """A Parquet table in hash slots of `key`; `slots` is fixed when the table is made."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], slots: int = 64):
        if slots < 1 or not key:
            raise ValueError("a keyed table needs a key and at least one slot")
        self.spark, self.path, self.key, self.slots = spark, path, list(key), slots

    def _slotted(self, rows: DataFrame) -> DataFrame:
        if SLOT in rows.columns:
            raise ValueError(f"{SLOT} is the name of the table's partition column")
        number = F.pmod(F.xxhash64(*self.key), F.lit(self.slots)).cast("string")
        return rows.withColumn(SLOT, F.concat(number, F.lit(f"of{self.slots}")))

    def create(self, rows: DataFrame) -> None:
        """Writes the rows as a new table; all its former slots go."""
        self._slotted(rows).hint("rebalance", SLOT).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(SLOT).parquet(
            self.path)

    def rows(self) -> DataFrame:
        """All rows, without the slot."""
        return self._stored().drop(SLOT)

    def _stored(self, touched: Sequence[str] | None = None) -> DataFrame:
        stored = self.spark.read.parquet(self.path)
        return stored if touched is None else stored.where(F.col(SLOT).isin(list(touched)))

    def _check_layout(self) -> None:
        other = self._stored().where(~F.col(SLOT).endswith(f"of{self.slots}")).select(SLOT).limit(1).collect()
        if other:
            raise ValueError(f"{self.path} lies in other slots than {self.slots}: {other[0][0]}")

    def _merge(self, new: DataFrame, rule: Callable[[DataFrame, DataFrame], DataFrame]) -> list[str]:
        """Replaces the slots of the new rows by rule(new, their rows); returns these slots."""
        if not table_exists(self.spark, self.path):
            raise ValueError(f"no table in {self.path}")
        self._check_layout()
        staged = stage(self._slotted(new), "merge-new")
        touched = sorted(r[0] for r in staged.select(SLOT).distinct().collect())  # at most `slots` values
        if touched:
            merged = stage(rule(staged.drop(SLOT), self._stored(touched).drop(SLOT)), "merge-slots")
            overwrite_partitions(self._slotted(merged), self.path, [SLOT])
        return touched

    def insert_new(self, new: DataFrame, order: Sequence[Column] = ()) -> list[str]:
        """Adds the rows whose key is not there yet, of each key the first by `order`. As in SQL, a null key is never there yet."""
        return self._merge(new, lambda rows, kept: upsert_ignore(rows, kept, self.key, order))

    def replace(self, new: DataFrame, order: Sequence[Column] = ()) -> list[str]:
        """The first new row of a key by `order` takes the place of the stored one; keys that are not there yet are added.

        A column that the new rows lack keeps its stored value, null in added rows. Null keys are equal here.
        """
        def rule(rows: DataFrame, kept: DataFrame) -> DataFrame:
            first = first_of_key(rows, self.key, order).select(
                *[F.col(k).alias(f"__k_{k}") for k in self.key], *[F.col(c).alias(f"__n_{c}") for c in rows.columns if c not in self.key],
                F.lit(True).alias("__new"))
            on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in self.key]
            joined = kept.withColumn("__old", F.lit(True)).join(first, on, "full")
            fresh = F.col("__new").isNotNull()

            def value(c: str) -> Column:
                if c in self.key:
                    return F.when(F.col("__old").isNotNull(), F.col(c)).otherwise(F.col(f"__k_{c}"))
                return F.when(fresh, F.col(f"__n_{c}")).otherwise(F.col(c)) if c in rows.columns else F.col(c)

            return joined.select(*[value(c).alias(c) for c in kept.columns])

        return self._merge(new, rule)

    def fill(self, new: DataFrame, marker: str) -> list[str]:
        """Rows known by key but without `marker` are filled from the first new row, other new rows are inserted (upsert_fill)."""
        if len(self.key) != 1:
            raise ValueError("fill takes a key of one column")
        return self._merge(new, lambda rows, kept: upsert_fill(rows, kept, self.key[0], marker))

    def update(self, source: DataFrame, column: str, value: Column, only: Column | None = None) -> list[str]:
        """Sets `column` of the rows whose key stands in `source` to `value`, an expression over the columns of the table and those of
        the source under `s.`; the source's first row of a key counts. Slots without a key of the source are not read."""
        def rule(rows: DataFrame, kept: DataFrame) -> DataFrame:
            first = first_of_key(rows, self.key, ()).withColumn("__hit", F.lit(True)).alias("s")
            on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in self.key]
            hit = F.col("s.__hit").isNotNull() if only is None else F.col("s.__hit").isNotNull() & F.coalesce(only, F.lit(False))
            return kept.alias("t").join(first, on, "left").select(*[
                F.when(hit, value).otherwise(F.col(f"t.{c}")).alias(c) if c == column else F.col(f"t.{c}").alias(c) for c in kept.columns])

        return self._merge(source, rule)


def scratch_table(spark: SparkSession, key: Sequence[str], slots: int = 64) -> KeyedTable:
    """A keyed table in the shared folder that goes with the application."""
    return KeyedTable(spark, scratch_path(spark, "keyed"), key, slots)
