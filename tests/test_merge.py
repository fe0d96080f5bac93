"""Merges into keyed tables: results, and files that stay."""

import os

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quizlens.sinks.merge import KeyedTable


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture()
def table(spark, tmp_path):
    keyed = KeyedTable(spark, str(tmp_path / "t"), ["id"], slots=16)
    keyed.create(spark.range(200).select("id", F.lit("old").alias("name"), F.when(F.col("id") % 2 == 0, F.lit("x")).alias("mark")))
    return keyed


def test_only_touched_slots_are_rewritten(spark, table):
    before = files(table.path)
    touched = table.replace(spark.createDataFrame([(3, "new"), (900, "added")], "id LONG, name STRING"))
    after = files(table.path)
    assert 1 <= len(touched) <= 2
    gone = before - after
    assert gone and all(any(f"slot={s}/" in f for s in touched) for f in gone)
    assert before - gone <= after
    assert table.rows().count() == 201
    assert rows(table.rows().where("id IN (3, 900, 4)")) == [(3, "new", None), (4, "old", "x"), (900, "added", None)]


def test_first_new_row_by_order(spark, table):
    new = spark.createDataFrame([(500, "b", "p"), (500, "a", "q"), (500, "c", None), (7, "z", "z")], "id LONG, name STRING, mark STRING")
    table.insert_new(new, [F.length("name"), F.col("mark")])
    assert rows(table.rows().where("id IN (7, 500)")) == [(500, "c", None), (7, "old", None)]
    table.insert_new(new.withColumn("id", F.lit(501).cast("long")))
    assert rows(table.rows().where("id = 501")) == [(501, "a", "q")]


def test_merging_twice_gives_the_same_table(spark, table):
    new = spark.range(190, 230).select("id", F.lit("new").alias("name"), F.lit("m").alias("mark"))
    table.insert_new(new)
    once = rows(table.rows())
    table.insert_new(new)
    assert rows(table.rows()) == once and len(once) == 230


def test_fill_and_update(spark, table):
    table.fill(spark.createDataFrame([(1, "one"), (2, "two")], "id LONG, mark STRING"), "mark")
    # 1 had no mark and is filled; 2 had one, so the new row is inserted
    assert rows(table.rows().where("id IN (1, 2)")) == [(1, "old", "one"), (2, "old", "x"), (2, None, "two")]
    touched = table.update(spark.createDataFrame([(9, "n9"), (9, "m9"), (10, None)], "id LONG, label STRING"), "name", F.col("s.label"))
    assert len(touched) <= 2
    assert rows(table.rows().where("id IN (9, 10, 11)")) == [(10, None, "x"), (11, "old", None), (9, "m9", None)]


def test_null_keys_and_empty_merges(spark, table):
    before = files(table.path)
    assert table.insert_new(spark.createDataFrame([], "id LONG, name STRING, mark STRING")) == []
    assert files(table.path) == before
    nulls = spark.createDataFrame([(None, "n", None)], "id LONG, name STRING, mark STRING")
    table.replace(nulls)
    table.replace(nulls.withColumn("name", F.lit("m")))
    assert rows(table.rows().where("id IS NULL")) == [(None, "m", None)]


def test_layout_is_checked(spark, table):
    with pytest.raises(ValueError):
        KeyedTable(spark, table.path, ["id"], slots=8).insert_new(spark.createDataFrame([(1, "a", "b")], "id LONG, name STRING, mark STRING"))
    with pytest.raises(ValueError):
        KeyedTable(spark, table.path + "-none", ["id"], 8).insert_new(spark.createDataFrame([(1,)], "id LONG"))
    with pytest.raises(ValueError):
        table.replace(spark.createDataFrame([(1, "a")], "id LONG, slot STRING"))
