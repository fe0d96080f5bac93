"""Register of queries and their oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from quizlens.sinks.stage import stage

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
        "embeddings", "pages", "benchmark", "labels", "conversations")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ROLES: dict[str, str] = {}
STORED: set[str] = set()

BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {}

_MARK = re.compile(r"\{(\w+)\}")


def role(name: str, sql: str, stored: bool = False) -> None:
    """A table of the learning platforms, as a select over the test tables or earlier roles. Table names stand in
    braces. The text is plain enough to mean the same in Spark SQL and in the checking database. A large role that is
    read several times is stored, as the platform's own table would be."""
    ROLES[name] = sql
    if stored:
        STORED.add(name)


def built(name: str):
    """Registers fn(tables) -> DataFrame as the way Spark makes a role's rows; the role's text says what they are."""

    def add(fn: Callable[[Tables], DataFrame]):
        BUILDERS[name] = fn
        return fn

    return add


_SCHEMAS: dict[str, object] = {}


class Tables:
    """Test tables and role tables of one folder as DataFrames, made on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in BUILDERS:
                self._made[name] = BUILDERS[name](self)
            elif name in ROLES:
                sql = ROLES[name]
                used = {n: self[n] for n in set(_MARK.findall(sql))}
                made = self.spark.sql(sql, **used)
                if name in STORED:
                    # every stored role ends in a shuffle or reads a stored one, so its files are already spread
                    made = stage(made, name, "zstd")
                self._made[name] = made
            elif name in BASE:
                path = f"{self.sf_dir}/{name}.parquet"
                if name not in _SCHEMAS:  # the test tables have one schema in all folders
                    _SCHEMAS[name] = self.spark.read.parquet(path).schema
                self._made[name] = self.spark.read.schema(_SCHEMAS[name]).parquet(path)
            else:
                raise KeyError(name)
        return self._made[name]

    def view(self, names: dict[str, str]) -> Mapping[str, DataFrame]:
        return _View(self, names)


class _View(Mapping):
    """Role tables under the names the plans use, each made when it is asked for."""

    def __init__(self, tables: Tables, names: dict[str, str]):
        self._tables, self._names = tables, names

    def __getitem__(self, short: str) -> DataFrame:
        return self._tables[self._names[short]]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def _needed(sql: str, seen: list[str]) -> None:
    for n in _MARK.findall(sql):
        if n in ROLES and n not in seen:
            _needed(ROLES[n], seen)
            seen.append(n)


def oracle(sql: str) -> str:
    """The select with its roles as common table expressions in front."""
    seen: list[str] = []
    _needed(sql, seen)
    plain = _MARK.sub(r"\1", sql).strip()
    heads = [f"{n} AS MATERIALIZED ({_MARK.sub(chr(92) + '1', ROLES[n]).strip()})" for n in seen]
    if not heads:
        return plain
    if plain.upper().startswith("WITH "):
        return "WITH " + ",\n".join(heads) + ",\n" + plain[5:]
    return "WITH " + ",\n".join(heads) + "\n" + plain


def query(name: str, sql: str | None = None):
    """Registers fn(tables) -> DataFrame under a name, with its oracle."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return add
