"""The constraint catalogue on small tables."""

import pytest
from helpers import rows

from quizlens.operators.constraints import NotNull, Parent, Unique, summary, violations


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "course": spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "d")], "id INT, slug STRING"),
        "branch": spark.createDataFrame([("1", 1.0, "x"), ("7", 7.0, "x"), ("7", 2.0, None), ("no", None, None), ("2", 1.5, "y")],
                                        "course STRING, other DOUBLE, name STRING"),
        "none": spark.createDataFrame([], "id INT, slug STRING"),
    }


def test_each_kind(tables):
    found = violations(tables, [Unique("course", ("id",)), NotNull("course", ("id",)), Parent("branch", ("course",), "course", ("id",)),
                                NotNull("branch", ("name", "other"))])
    assert rows(found) == sorted([
        ("unique", "course", "id", None, ["2"], 2), ("not_null", "course", "id", None, [], 2),
        ("parent", "branch", "course", "course", ["7"], 2), ("parent", "branch", "course", "course", ["no"], 1),
        ("not_null", "branch", "name,other", None, [], 2)], key=repr)


def test_keys_with_nulls_break_no_unique_or_parent_rule(tables):
    rules = [Unique("course", ("id", "slug")), Parent("branch", ("other",), "course", ("id",))]
    assert rows(violations(tables, rules)) == [("parent", "branch", "other", "course", ["1.5"], 1), ("parent", "branch", "other", "course", ["7"], 1)]


def test_texts_with_the_separator_stay_apart(spark):
    t = {"t": spark.createDataFrame([("a,b", "c"), ("a", "b,c")], "x STRING, y STRING")}
    assert rows(violations(t, [Unique("t", ("x", "y"))])) == []


def test_summary_names_every_rule(tables):
    rules = [Unique("course", ("slug",)), Unique("none", ("id",)), Parent("course", ("id",), "none"), NotNull("none", ("slug",))]
    assert rows(summary(tables, rules)) == sorted([
        ("unique", "course", "slug", None, 1, 2), ("unique", "none", "id", None, 0, 0),
        ("parent", "course", "id", "none", 2, 3), ("not_null", "none", "slug", None, 0, 0)], key=repr)


def test_a_table_may_be_its_own_parent(spark):
    tree = {"node": spark.createDataFrame([(1, None), (2, 1), (3, 9)], "id INT, up INT")}
    assert rows(violations(tree, [Parent("node", ("up",), "node", ("id",))])) == [("parent", "node", "up", "node", ["9"], 1)]


def test_each_table_is_scanned_once_and_nothing_is_joined(spark, tables, tmp_path):
    stored = {}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    rules = [Unique("course", ("id",)), Unique("course", ("slug",)), NotNull("course", ("id",)), Parent("branch", ("course",), "course", ("id",)),
             Parent("branch", ("other",), "course", ("id",)), NotNull("branch", ("name",)), Parent("none", ("id",), "course"),
             Unique("none", ("id",)), NotNull("none", ("slug",)), Unique("branch", ("name",))]
    plan = violations(stored, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3
    assert "Join" not in plan


def test_widths_must_agree_and_rules_must_exist(tables):
    with pytest.raises(ValueError):
        Parent("branch", ("course", "name"), "course", ("id",))
    with pytest.raises(ValueError):
        violations(tables, [])
