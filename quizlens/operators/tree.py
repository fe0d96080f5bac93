"""Content trees: set-based find-or-insert of nodes, level by level."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizlens.functions import (
    block_kind,
    block_part,
    course_of_block,
    none_if_missing,
    surrogate_id,
)

STRUCTURE_FIELDS = ["course_id", "chapter_id", "chapter_name", "sequential_id", "sequential_name", "vertical_id",
                    "vertical_name", "item_type", "item_id", "item_name"]


def parse_structure(raw: DataFrame, locators: Sequence[str] = ("c1", "c2", "c3", "c4"),
                    names: Sequence[str] = ("c5", "c6", "c7", "c8"), keep: Sequence[str] = ()) -> DataFrame:
    """Course, chapter, sequential, vertical and item ids out of the block locators of a structure file."""
    chapter, sequential, vertical, item = (F.col(c) for c in locators)
    return raw.select(
        *keep,
        course_of_block(chapter).alias("course_id"),
        block_part(chapter).alias("chapter_id"), F.col(names[0]).alias("chapter_name"),
        block_part(sequential).alias("sequential_id"), F.col(names[1]).alias("sequential_name"),
        block_part(vertical).alias("vertical_id"), F.col(names[2]).alias("vertical_name"),
        block_kind(item).alias("item_type"), block_part(item).alias("item_id"), F.col(names[3]).alias("item_name"),
    )


def node_ids(ext_ids: DataFrame, ext_id: str, existing: DataFrame | None, as_name: str) -> DataFrame:
    """Adds the id of the node an external id names: that of the existing node, else the hash a new node gets."""
    fresh = surrogate_id(F.col(ext_id))
    if existing is None:
        return ext_ids.withColumn(as_name, fresh)
    known = existing.select(F.col("ext_id").alias("__ext"), F.col("id").cast("bigint").alias("__id"))
    return (ext_ids.join(known, F.col(ext_id) == F.col("__ext"), "left")
            .withColumn(as_name, F.coalesce("__id", fresh)).drop("__ext", "__id"))


def find_or_insert(rows: DataFrame, existing: DataFrame | None, ext_id: str, order: Column, parent: str,
                   parent_ext: str, parents: DataFrame | None, **fields: Column) -> DataFrame:
    """Existing nodes and, for external ids not among them, a new node from the first row in the given order.

    Tables have id, ext_id, the parent's id under the name `parent`, and the named fields. A parent is looked up among
    the existing nodes of its level; one that is new too has its id by rule, so levels do not wait for each other.
    """
    firsts = rows.where(F.col(ext_id).isNotNull()).groupBy(F.col(ext_id).alias("ext_id")).agg(
        F.min_by(F.struct(F.col(parent_ext).alias("__parent"), *[e.alias(n) for n, e in fields.items()]), order)
        .alias("f"))
    if existing is not None:
        firsts = firsts.join(existing, "ext_id", "left_anti")
    flat = firsts.select("ext_id", "f.*")
    new = node_ids(flat, "__parent", parents, parent).select(
        surrogate_id(F.col("ext_id")).alias("id"), "ext_id", parent, *fields)
    return new if existing is None else existing.select(new.columns).unionByName(new)


def build_tree(parsed: DataFrame, course: DataFrame, existing: Mapping[str, DataFrame] | None = None,
               order: str = "line_no") -> dict[str, DataFrame]:
    """Chapter, sequential, vertical and item tables from parsed structure rows.

    Rows of courses not in `course` are skipped. A node takes parent, type and name from its first row in file order.
    """
    old = existing or {}
    at = F.col(order)
    rows = parsed.join(course.select(F.col("ext_id").alias("course_id")), "course_id", "left_semi")
    chapter = find_or_insert(rows, old.get("chapter"), "chapter_id", at, "course_id", "course_id", course,
                             name=F.col("chapter_name"))
    sequential = find_or_insert(rows, old.get("sequential"), "sequential_id", at, "chapter_id", "chapter_id",
                                old.get("chapter"), name=F.col("sequential_name"))
    vertical = find_or_insert(rows, old.get("vertical"), "vertical_id", at, "sequential_id", "sequential_id",
                              old.get("sequential"), name=F.col("vertical_name"))
    item = find_or_insert(rows, old.get("item"), "item_id", at, "vertical_id", "vertical_id", old.get("vertical"),
                          item_type=none_if_missing(F.col("item_type")), name=none_if_missing(F.col("item_name")))
    return {"course": course, "chapter": chapter, "sequential": sequential, "vertical": vertical, "item": item}
