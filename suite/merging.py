"""Merges into keyed tables that rewrite only the slots they touch."""

from pyspark.sql import functions as F

from quizlens.sinks.merge import scratch_table
from suite.registry import query, role

# customers known so far, and the orders of customers who are known, new or unnamed
role("w_known", """
SELECT c_custkey AS id, c_name AS name, CASE WHEN c_acctbal > 5000 THEN c_mktsegment END AS segment FROM {customer} WHERE c_acctbal > 0
""")
role("w_orders", """
SELECT CASE WHEN o_custkey % 50 = 7 THEN o_custkey + 1000000 ELSE o_custkey END AS id, concat('order ', o_orderkey) AS name,
       o_orderpriority AS segment, o_totalprice AS price FROM {orders} WHERE o_orderstatus <> 'P'
""")
role("w_first", """
SELECT id, name, segment FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY price DESC, name) AS place FROM {w_orders}) ranked WHERE place = 1
""")


def _known(t):
    keyed = scratch_table(t.spark, ["id"], slots=16)
    keyed.create(t["w_known"])
    return keyed


@query("merge_insert_new", """
SELECT * FROM {w_known} UNION ALL SELECT id, name, segment FROM {w_first} WHERE id NOT IN (SELECT id FROM {w_known})
""")
def merge_insert_new(t):
    """Of a key's new rows the one with the highest price, then by name."""
    table = _known(t)
    # the order is a column of the new rows; the table has none of that name
    table.insert_new(t["w_orders"], [-F.col("price")])
    return table.rows()


@query("merge_replace", """
SELECT coalesce(f.id, k.id) AS id, CASE WHEN f.id IS NULL THEN k.name ELSE f.name END AS name, k.segment
FROM {w_known} k FULL JOIN {w_first} f ON f.id = k.id
""")
def merge_replace(t):
    """Stored rows replaced by key; a column that the new rows lack stays."""
    table = _known(t)
    table.replace(t["w_orders"].select("id", "name", "price"), [-F.col("price")])
    return table.rows()


@query("merge_fill", """
SELECT k.id, k.name, coalesce(k.segment, n.segment) AS segment FROM {w_known} k
LEFT JOIN (SELECT id, min(segment) AS segment FROM {w_orders} GROUP BY id) n ON n.id = k.id
UNION ALL
SELECT id, NULL, segment FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY segment) AS place FROM {w_orders}) o
WHERE place > 1 OR id NOT IN (SELECT id FROM {w_known} WHERE segment IS NULL)
""")
def merge_fill(t):
    """Rows without a marker filled from the first new row, all other new rows inserted."""
    table = _known(t)
    table.fill(t["w_orders"].select("id", "segment"), "segment")
    return table.rows()


@query("merge_update", """
SELECT k.id, CASE WHEN k.segment IS NULL AND p.id IS NOT NULL THEN concat(k.name, '/', p.name) ELSE k.name END AS name, k.segment
FROM {w_known} k LEFT JOIN (SELECT id, min(name) AS name FROM {w_orders} GROUP BY id) p ON p.id = k.id
""")
def merge_update(t):
    """A column set from another table by key, in the slots of that table's keys, where a condition holds."""
    table = _known(t)
    table.update(t["w_orders"].select("id", "name"), "name", F.concat("t.name", F.lit("/"), "s.name"), only=F.col("t.segment").isNull())
    return table.rows()
