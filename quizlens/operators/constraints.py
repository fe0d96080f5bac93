"""A catalogue of declared constraints, checked in one scan a table.

Each table is read once, whatever the number of rules that name it as child or as parent: a row is expanded into one entry per rule, (rule, key,
how often as child, how often as parent), and all entries are folded by (rule, key). Entries are added up on the map side first, so a key that
holds a third of a table costs one row per task. There is no join.

Keys are compared as texts of the declared types: a child's columns are cast to its parent's types first, so 7 and 7.0 agree; a value that does
not fit that type keeps its own text and has no parent. As in SQL, a key with a null breaks neither a unique nor a parent rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


@dataclass(frozen=True)
class Unique:
    """No two rows of `table` agree in all `columns`."""

    table: str
    columns: tuple[str, ...]
    kind = "unique"


@dataclass(frozen=True)
class NotNull:
    """`columns` are filled in each row of `table`."""

    table: str
    columns: tuple[str, ...]
    kind = "not_null"


@dataclass(frozen=True)
class Parent:
    """Each key of `table` stands in `parent`; parent columns of the same names when none are given."""

    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...] | None = None
    kind = "parent"

    def __post_init__(self):
        if len(self.columns) != len(self.fields):
            raise ValueError(f"{self.table}{self.columns} and {self.parent}{self.fields} have different widths")

    @property
    def fields(self) -> tuple[str, ...]:
        return self.parent_columns or self.columns


Rule = Unique | NotNull | Parent

KEY = "array<string>"
ENTRY = f"struct<rule: int, key: {KEY}, child: bigint, parent: bigint>"


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _text(name: str, own: StructType, declared: StructType | None = None, field: str | None = None) -> Column:
    value = _quoted(name)
    text = value.cast("string")
    if declared is None or declared[field].dataType == own[name].dataType:
        return text
    fitted = value.try_cast(declared[field].dataType)
    if not isinstance(own[name].dataType, StringType):  # 1.5 is not 1
        fitted = F.when(fitted.try_cast(own[name].dataType) == value, fitted)
    return F.coalesce(fitted.cast("string"), text)


def _entry(rule: int, key: Column, child: int, parent: int) -> Column:
    return F.struct(F.lit(rule).alias("rule"), key.alias("key"), F.lit(child).cast("bigint").alias("child"),
                    F.lit(parent).cast("bigint").alias("parent"))


def _entries(tables: Mapping[str, DataFrame], schemas: Mapping[str, StructType], table: str, rules: Sequence[Rule]) -> DataFrame:
    """The entries of one table for all rules that name it."""
    schema, out = schemas[table], []

    def filled(columns):
        return reduce(Column.__and__, [_quoted(c).isNotNull() for c in columns])

    for number, rule in enumerate(rules):
        if rule.table == table:
            if isinstance(rule, NotNull):
                out.append(F.when(~filled(rule.columns), _entry(number, F.array().cast(KEY), 1, 0)))
            else:
                declared = schemas[rule.parent] if isinstance(rule, Parent) else None
                fields = rule.fields if isinstance(rule, Parent) else rule.columns
                key = F.array(*[_text(c, schema, declared, f) for c, f in zip(rule.columns, fields, strict=True)])
                out.append(F.when(filled(rule.columns), _entry(number, key, 1, 0)))
        if isinstance(rule, Parent) and rule.parent == table:
            key = F.array(*[_text(f, schema) for f in rule.fields])
            out.append(F.when(filled(rule.fields), _entry(number, key, 0, 1)))
    # gaps are left out after the explosion: both run as generated code
    listed = F.array(*[e.cast(ENTRY) for e in out])
    return tables[table].select(F.explode(listed).alias("__entry")).where(F.col("__entry").isNotNull()).select("__entry.*")


def _broken(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """(rule, key, n): the keys that break a rule, with the rows that do."""
    named = sorted({r.table for r in rules} | {r.parent for r in rules if isinstance(r, Parent)})
    schemas = {n: tables[n].schema for n in named}
    folded = reduce(DataFrame.unionByName, [_entries(tables, schemas, n, rules) for n in named]).groupBy("rule", "key").agg(
        F.sum("child").alias("n"), F.sum("parent").alias("parents"))

    def of(kind: type) -> Column:
        return F.col("rule").isin([i for i, r in enumerate(rules) if isinstance(r, kind)])

    return folded.where((of(Unique) & (F.col("n") > 1)) | (of(NotNull) & (F.col("n") > 0))
                        | (of(Parent) & (F.col("n") > 0) & (F.col("parents") == 0))).drop("parents")


def _names(rules: Sequence[Rule]) -> list[Column]:
    def listed(values):
        return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), F.col("rule") + 1)

    return [listed([r.kind for r in rules]).alias("kind"), listed([r.table for r in rules]).alias("table"),
            listed([",".join(r.columns) for r in rules]).alias("columns"),
            listed([r.parent if isinstance(r, Parent) else None for r in rules]).alias("parent")]


def violations(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per broken rule and key: (kind, table, columns, parent, key, n), n the rows with that key.

    `key` is the list of the key's texts, empty for a not-null rule, whose rows are counted together. A rule that holds has no row, an
    empty table breaks none.
    """
    if not rules:
        raise ValueError("no rules")
    return _broken(tables, rules).select(*_names(rules), "key", "n")


def summary(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per rule, broken or not: (kind, table, columns, parent, broken_keys, broken_rows)."""
    if not rules:
        raise ValueError("no rules")
    found = _broken(tables, rules)
    spark = found.sparkSession
    per_rule = found.groupBy("rule").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    every = spark.range(len(rules)).select(F.col("id").cast("int").alias("rule"))
    return every.join(per_rule, "rule", "left").select(
        *_names(rules), F.coalesce("k", F.lit(0)).alias("broken_keys"), F.coalesce("n", F.lit(0)).alias("broken_rows"))
