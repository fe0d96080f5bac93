"""Filters, joins, aggregates, windows, sorts and scalar functions, each on whole test tables."""

from pyspark.sql import functions as F

from quizlens import functions as X
from quizlens.operators.attempts import first_n_per_group
from quizlens.operators.frames import counted, with_group_stats
from quizlens.operators.ranking import after_offset, is_last_row, latest_only, rank_share, strong, sum_where, weak
from quizlens.operators.reliability import user_fold, with_question_variance
from quizlens.sinks.stage import stage
from suite.registry import query


def r6(expr):
    return F.round(expr, 6)


# --- filters and projections ----------------------------------------------------------------------------------------
@query("filter_equality_and_null", """
SELECT l_orderkey, l_suppkey, l_linenumber AS line_no, CAST(3 AS INTEGER) AS platform_id FROM lineitem
WHERE l_returnflag = 'A' AND l_linestatus = 'F' AND l_shipdate IS NOT NULL AND NOT (l_quantity IS NULL)
""")
def filter_equality_and_null(t):
    """P1, P2, P3, P4, S9."""
    return t["lineitem"].where(
        (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F") & F.col("l_shipdate").isNotNull()
        & ~F.col("l_quantity").isNull()
    ).select("l_orderkey", "l_suppkey", F.col("l_linenumber").alias("line_no"), F.lit(3).alias("platform_id"))


@query("filter_patterns", """
SELECT p_partkey, p_name, p_type FROM part
WHERE (p_name LIKE 'small%' OR p_name LIKE '%widget' OR p_name LIKE '%e%r%') AND p_type NOT LIKE 'ECO%'
  AND NOT regexp_matches(p_brand, '^Brand#1')
""")
def filter_patterns(t):
    """P5, P6, P10."""
    name = F.col("p_name")
    return t["part"].where(
        (name.startswith("small") | name.endswith("widget") | name.like("%e%r%"))
        & ~F.col("p_type").like("ECO%") & ~F.col("p_brand").rlike("^Brand#1")
    ).select("p_partkey", "p_name", "p_type")


@query("filter_in_list", """
SELECT event_id, event_type, value FROM events WHERE event_type IN ('view', 'purchase') AND value >= 10
""")
def filter_in_list(t):
    """P7, P17."""
    return (t["events"].where(F.col("event_type").isin("view", "purchase") & (F.col("value") >= 10))
            .select("event_id", "event_type", "value"))


@query("filter_in_subquery", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
""")
def filter_in_subquery(t):
    """P8, J9, J10 in its semi form."""
    rich = t["customer"].where(F.col("c_acctbal") > 0)
    return (t["orders"].join(rich, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
            .select("o_orderkey", "o_custkey"))


@query("filter_not_exists", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
""")
def filter_not_exists(t):
    """P9, J10."""
    dear = t["orders"].where(F.col("o_totalprice") > 400000)
    return (t["customer"].join(dear, F.col("o_custkey") == F.col("c_custkey"), "left_anti")
            .select("c_custkey", "c_name"))


@query("filter_column_pair", """
SELECT count(*) AS same_side, CAST(sum(CASE WHEN l_discount = l_tax THEN 1 ELSE 0 END) AS BIGINT) AS same_rate
FROM lineitem WHERE (l_returnflag = 'A' AND l_linestatus = 'F') OR l_discount = l_tax
""")
def filter_column_pair(t):
    """P14, P10, A21."""
    same = F.col("l_discount") == F.col("l_tax")
    return (t["lineitem"].where(((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")) | same)
            .agg(F.count(F.lit(1)).alias("same_side"), sum_where(same).alias("same_rate")))


@query("filter_log_time", """
SELECT event_id, substring(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 1, 19) AS at FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:01'
""")
def filter_log_time(t):
    """P16, F21."""
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    at = X.log_time(text)
    return (t["events"].where(at > F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
            .select("event_id", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("at")))


# --- joins ----------------------------------------------------------------------------------------------------------
@query("join_inner_dimensions", """
SELECT l_orderkey, l_linenumber, s_name, n_name, r_name, l_quantity FROM lineitem
JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
""")
def join_inner_dimensions(t):
    """Dimensions are broadcast by Spark's own size check."""
    return (t["lineitem"].join(t["supplier"], F.col("s_suppkey") == F.col("l_suppkey"))
            .join(t["nation"], F.col("n_nationkey") == F.col("s_nationkey"))
            .join(t["region"], F.col("r_regionkey") == F.col("n_regionkey"))
            .select("l_orderkey", "l_linenumber", "s_name", "n_name", "r_name", "l_quantity"))


@query("join_left_hierarchy", """
SELECT r_name, n_name, s_name, c.n AS n_customers FROM region
LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey
LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey) c ON c.c_nationkey = n_nationkey
""")
def join_left_hierarchy(t):
    """J3, J8."""
    return (t["region"].join(t["nation"], F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .join(t["supplier"], F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .join(counted(t["customer"], ["c_nationkey"], "n_customers"),
                  F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("r_name", "n_name", "s_name", "n_customers"))


@query("join_left_with_condition", """
SELECT o_orderkey, l_linenumber, l_shipdate IS NULL AS missing FROM orders
LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' AND l_quantity > 40
""")
def join_left_with_condition(t):
    """J4."""
    kept = t["lineitem"].where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40))
    return (t["orders"].join(kept, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select("o_orderkey", "l_linenumber", F.col("l_shipdate").isNull().alias("missing")))


@query("join_computed_key", """
SELECT l_orderkey, l_linenumber, item, p_name FROM (
  SELECT *, split_part(concat(l_suppkey, ',', l_partkey, ',', l_orderkey), ',', l_linenumber % 4 + 1) AS item FROM lineitem) x
LEFT JOIN part ON p_partkey = TRY_CAST(item AS BIGINT)
""")
def join_computed_key(t):
    """An id picked from an ordered list by position, then an equi-join."""
    ids = F.concat_ws(",", "l_suppkey", "l_partkey", "l_orderkey")
    picked = t["lineitem"].withColumn("item", X.list_item(ids, F.col("l_linenumber") % 4 + 1))
    return (picked.withColumn("key", F.col("item").try_cast("bigint"))
            .join(t["part"], F.col("p_partkey") == F.col("key"), "left")
            .select("l_orderkey", "l_linenumber", "item", "p_name"))


@query("join_self_roles", """
SELECT a.l_orderkey, a.l_linenumber, b.l_partkey AS order_part, c.l_tax AS finish_tax FROM lineitem a
LEFT JOIN lineitem b ON b.l_orderkey = a.l_orderkey AND b.l_returnflag = 'R' AND b.l_linestatus = 'O'
LEFT JOIN lineitem c ON c.l_orderkey = a.l_orderkey AND c.l_returnflag = 'A' AND c.l_linestatus = 'F'
""")
def join_self_roles(t):
    """A row, its ordering row and its closing row from one table; the two roles are filtered before the join."""
    li = t["lineitem"]
    b = li.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")).select(
        "l_orderkey", F.col("l_partkey").alias("order_part"))
    c = li.where((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")).select(
        "l_orderkey", F.col("l_tax").alias("finish_tax"))
    return (li.join(b, "l_orderkey", "left").join(c, "l_orderkey", "left")
            .select("l_orderkey", "l_linenumber", "order_part", "finish_tax"))


@query("join_to_extreme_row", """
SELECT l_orderkey, l_linenumber, l_shipdate::VARCHAR AS shipped FROM lineitem JOIN (
  SELECT l_orderkey, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY l_orderkey) last USING (l_orderkey, l_shipdate)
""")
def join_to_extreme_row(t):
    """J2, J8, N5."""
    return (latest_only(t["lineitem"], ["l_orderkey"], "l_shipdate")
            .select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped")))


@query("join_through_bridge", """
SELECT o_custkey, s_nationkey, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON s_suppkey = l_suppkey GROUP BY o_custkey, s_nationkey
""")
def join_through_bridge(t):
    """J11, J13."""
    return counted(
        t["orders"].join(t["lineitem"], F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t["supplier"], F.col("s_suppkey") == F.col("l_suppkey")), ["o_custkey", "s_nationkey"], "n")


# --- aggregates -----------------------------------------------------------------------------------------------------
@query("agg_basic", """
SELECT item_id, question_id, count(*) AS cnt, count(DISTINCT user_id) AS users, sum(score) AS total, min(score) AS lowest,
  max(score) AS highest, round(avg(score), 2) AS mean, round(sum(score) / count(*), 6) AS p,
  round(var_samp(score), 6) AS var_sample, round(var_pop(score), 6) AS var_population,
  max(option_id) AS last_option, min(option_id) AS first_option
FROM {answers} GROUP BY item_id, question_id
""")
def agg_basic(t):
    """A1, A2, A3, A4, A5, A6, A10, A12, A13, A20, F15."""
    return t["answers"].groupBy("item_id", "question_id").agg(
        F.count(F.lit(1)).alias("cnt"), F.countDistinct("user_id").alias("users"), F.sum("score").alias("total"),
        F.min("score").alias("lowest"), F.max("score").alias("highest"), F.round(F.avg("score"), 2).alias("mean"),
        r6(F.sum("score") / F.count(F.lit(1))).alias("p"), r6(X.variance("score")).alias("var_sample"),
        r6(X.variance("score", "population")).alias("var_population"), F.max("option_id").alias("last_option"),
        F.min("option_id").alias("first_option"))


@query("agg_conditional", """
SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
  CAST(sum(CAST(l_linestatus = 'F' AS INTEGER)) AS BIGINT) AS closed,
  round(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity * l_discount ELSE 0 END), 4) AS weighted
FROM lineitem GROUP BY l_suppkey HAVING sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) > 1
""")
def agg_conditional(t):
    """A7, A8, A9, A14."""
    return t["lineitem"].groupBy("l_suppkey").agg(
        sum_where(F.col("l_returnflag") == "R").alias("returned"),
        F.sum((F.col("l_linestatus") == "F").cast("int")).alias("closed"),
        F.round(sum_where(F.col("l_returnflag") == "A", F.col("l_quantity") * F.col("l_discount")), 4)
        .alias("weighted")).where(F.col("returned") > 1)


@query("agg_expression_keys", """
SELECT CASE WHEN l_quantity > 25 THEN 'large' ELSE 'small' END AS size_class, substring(o_orderpriority, 1, 1) AS prio,
  count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey
GROUP BY CASE WHEN l_quantity > 25 THEN 'large' ELSE 'small' END, substring(o_orderpriority, 1, 1)
""")
def agg_expression_keys(t):
    """A11, F1, F12."""
    rows = t["lineitem"].join(t["orders"], F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.groupBy(
        F.when(F.col("l_quantity") > 25, "large").otherwise("small").alias("size_class"),
        F.substring("o_orderpriority", 1, 1).alias("prio")).agg(F.count(F.lit(1)).alias("n"))


@query("agg_distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def agg_distinct_rows(t):
    """A16."""
    return t["lineitem"].select("l_suppkey", "l_returnflag").distinct()


@query("agg_sorted_array", """
SELECT o_custkey, list_sort(list(o_orderpriority)) AS prios,
  string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) AS listed FROM orders GROUP BY o_custkey
""")
def agg_sorted_array(t):
    """Equal entries are counted before they are collected."""
    entries = counted(t["orders"], ["o_custkey", "o_orderpriority"], "n")
    packed = F.sort_array(F.collect_list(F.struct("o_orderpriority", "n")))
    prios = F.flatten(F.transform(packed, lambda e: F.array_repeat(e["o_orderpriority"], e["n"].cast("int"))))
    return entries.groupBy("o_custkey").agg(prios.alias("prios")).withColumn(
        "listed", F.coalesce(F.array_join("prios", ","), F.lit("")))


@query("agg_frequency", """
SELECT event_type, props, count(*) AS n FROM events GROUP BY event_type, props
""")
def agg_frequency(t):
    """A19."""
    return counted(t["events"], ["event_type", "props"], "n")


@query("agg_id_probe", """
SELECT count(*) AS n, max(event_id) AS top, count(DISTINCT event_id) AS ids FROM events
""")
def agg_id_probe(t):
    """A21, Q4."""
    return t["events"].agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("top"),
                           F.countDistinct("event_id").alias("ids"))


@query("agg_two_levels", """
SELECT item_id, count(*) AS learners, min(k) AS k_min, max(k) AS k_max, round(avg(total), 6) AS mean_total FROM (
  SELECT item_id, user_id, count(*) AS k, sum(score) AS total FROM {answers} GROUP BY item_id, user_id) f
GROUP BY item_id
""")
def agg_two_levels(t):
    """A15."""
    folded = t["answers"].groupBy("item_id", "user_id").agg(F.count(F.lit(1)).alias("k"), F.sum("score").alias("total"))
    return folded.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("learners"), F.min("k").alias("k_min"), F.max("k").alias("k_max"),
        r6(F.avg("total")).alias("mean_total"))


# --- windows --------------------------------------------------------------------------------------------------------
@query("window_ranks", """
SELECT item_id, user_id, question_id, attempt_id, score, resp_sum,
  rank() OVER (PARTITION BY item_id ORDER BY resp_sum NULLS LAST, user_id NULLS LAST) AS rnk,
  round(cume_dist() OVER (PARTITION BY item_id ORDER BY resp_sum NULLS LAST, user_id NULLS LAST), 6) AS cd
FROM (SELECT *, sum(score) OVER (PARTITION BY item_id, user_id) AS resp_sum FROM {answers}) a
""")
def window_ranks(t):
    """The bucketed form, as for groups of unknown size."""
    rows = with_group_stats(t["answers"], ["item_id", "user_id"], resp_sum=F.sum("score"))
    return rank_share(rows, ["item_id"], ["resp_sum", "user_id"], bucket_rows=512).select(
        "item_id", "user_id", "question_id", "attempt_id", "score", "resp_sum", "rnk", r6(F.col("cd")).alias("cd"))


@query("window_dense_rank", """
SELECT o_orderkey, o_orderstatus, dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority, o_custkey) AS rnk,
  round(cume_dist() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority, o_custkey), 6) AS cd FROM orders
""")
def window_dense_rank(t):
    """N2."""
    rows = t["orders"].select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    return rank_share(rows, ["o_orderstatus"], ["o_orderpriority", "o_custkey"], dense=True).select(
        "o_orderkey", "o_orderstatus", "rnk", r6(F.col("cd")).alias("cd"))


@query("window_group_values", """
SELECT attempt_id, supp_id, question_id, user_id, score,
  count(*) OVER (PARTITION BY item_id, user_id) AS k, max(question_id) OVER (PARTITION BY item_id, user_id) AS top_question,
  sum(score) OVER (PARTITION BY item_id, user_id) AS total,
  round(var_samp(score) OVER (PARTITION BY item_id, question_id), 6) AS question_var
FROM {answers}
""")
def window_group_values(t):
    """Partial aggregates joined back, so no group is gathered in one task."""
    rows = with_group_stats(t["answers"], ["item_id", "user_id"], k=F.count(F.lit(1)), top_question=F.max("question_id"),
                            total=F.sum("score"))
    return with_question_variance(rows, ["item_id", "question_id"], "score").select(
        "attempt_id", "supp_id", "question_id", "user_id", "score", "k", "top_question", "total",
        r6(F.col("question_var")).alias("question_var"))


@query("window_last_row", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(cume_dist() OVER (
  PARTITION BY l_orderkey ORDER BY l_linenumber NULLS LAST, l_partkey NULLS LAST)) AS BIGINT) AS last_row FROM lineitem
""")
def window_last_row(t):
    """The rows of rank 1 from the end."""
    rows = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey")
    return is_last_row(rows, ["l_orderkey"], ["l_linenumber", "l_partkey"], "last_row")


@query("window_distinct", """
SELECT DISTINCT l_suppkey, l_returnflag, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem
""")
def window_distinct(t):
    """Distinct rows with a group count; folded before the count is joined back."""
    folded = counted(t["lineitem"], ["l_suppkey", "l_returnflag"], "part_n")
    return with_group_stats(folded, ["l_suppkey"], n=F.sum("part_n")).drop("part_n")


@query("window_over_aggregate", """
SELECT item_id, user_id, sum(score) AS resp_sum, count(*) AS k_a,
  round(var_samp(sum(score)) OVER (PARTITION BY item_id), 6) AS sx2 FROM {answers} GROUP BY item_id, user_id
""")
def window_over_aggregate(t):
    """N10, N11."""
    folded = user_fold(t["answers"].withColumn("question_var", F.lit(0.0)), ["item_id", "user_id"], ["item_id"], "score",
                       formula=None)
    return folded.select("item_id", "user_id", "resp_sum", "k_a", r6(F.col("sx2")).alias("sx2"))


@query("window_rank_by_interval", """
SELECT attempt_id, supp_id, question_id, item_id, user_id, rank() OVER (PARTITION BY item_id
  ORDER BY score, action_ts - start_ts DESC NULLS FIRST, user_id) AS rnk FROM {answers}
""")
def window_rank_by_interval(t):
    """N13, F18, L1."""
    rows = t["answers"].withColumn("longer", -(F.col("action_ts") - F.col("start_ts")))
    return rank_share(rows, ["item_id"], ["score", "longer", "user_id"], share=None).select(
        "attempt_id", "supp_id", "question_id", "item_id", "user_id", "rnk")


@query("weak_strong_pairs", """
WITH ranked AS (
  SELECT *, cume_dist() OVER (PARTITION BY item_id ORDER BY resp_sum NULLS LAST, user_id) AS cd
  FROM (SELECT *, sum(score) OVER (PARTITION BY item_id, user_id) AS resp_sum FROM {answers}) a)
SELECT item_id, question_id, sum(CASE WHEN cd > 0.75 THEN score ELSE 0 END) AS strong_num,
  CAST(sum(CASE WHEN cd > 0.75 THEN 1 ELSE 0 END) AS BIGINT) AS strong_denom,
  CAST(sum(CASE WHEN cd < 0.25 THEN 1 ELSE 0 END) AS BIGINT) AS weak_denom,
  CAST(sum(CASE WHEN cd <= 0.25 THEN 1 ELSE 0 END) AS BIGINT) AS weak_denom_inclusive
FROM ranked GROUP BY item_id, question_id
""")
def weak_strong_pairs(t):
    """P11, A7."""
    rows = stage(with_group_stats(t["answers"], ["item_id", "user_id"], resp_sum=F.sum("score"))
                 .select("item_id", "question_id", "user_id", "score", "resp_sum"))
    ranked = rank_share(rows, ["item_id"], ["resp_sum", "user_id"])
    return ranked.groupBy("item_id", "question_id").agg(
        sum_where(strong(), F.col("score")).alias("strong_num"), sum_where(strong()).alias("strong_denom"),
        sum_where(weak()).alias("weak_denom"), sum_where(weak(inclusive=True)).alias("weak_denom_inclusive"))


# --- sort, limit, set operations ------------------------------------------------------------------------------------
@query("top_frequencies", """
SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY l_suppkey, l_returnflag
ORDER BY n DESC, l_suppkey, l_returnflag LIMIT 20
""")
def top_frequencies(t):
    """L1, L3, L5."""
    return (counted(t["lineitem"], ["l_suppkey", "l_returnflag"], "n")
            .orderBy(F.col("n").desc(), "l_suppkey", "l_returnflag").limit(20))


@query("preview_rows", """
SELECT event_id, user_id, event_type, value, props FROM events ORDER BY event_id LIMIT 100
""")
def preview_rows(t):
    """L2, L6, S10."""
    return (t["events"].select("event_id", "user_id", "event_type", "value", "props").orderBy("event_id").limit(100))


@query("rows_after_offset", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 746
""")
def rows_after_offset(t):
    """L4, M50."""
    rows = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice")
    return (after_offset(rows, [-F.col("o_totalprice"), F.col("o_orderkey")], 746)
            .orderBy(F.col("o_totalprice").desc(), "o_orderkey"))


@query("first_rows_per_group", """
SELECT event_type, event_id, user_id FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events) x WHERE rn <= 50
""")
def first_rows_per_group(t):
    """E5: the cap per archive of the sampling run."""
    return first_n_per_group(t["events"], ["event_type"], [F.col("ts"), F.col("event_id")], 50).select(
        "event_type", "event_id", "user_id")


@query("union_distinct", """
SELECT n_name AS name FROM nation UNION SELECT r_name FROM region UNION SELECT c_mktsegment FROM customer
""")
def union_distinct(t):
    """L7."""
    return (t["nation"].select(F.col("n_name").alias("name")).union(t["region"].select("r_name"))
            .union(t["customer"].select("c_mktsegment")).distinct())


@query("union_all_by_name", """
SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey AS id, s_name AS name FROM supplier
""")
def union_all_by_name(t):
    """E11."""
    return t["customer"].select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).unionByName(
        t["supplier"].select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")))


@query("unnest_lists", """
WITH words AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
SELECT word, count(*) AS n, count(DISTINCT p_partkey) AS parts FROM words GROUP BY word
""")
def unnest_lists(t):
    """L8, L9, F29."""
    words = t["part"].select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("p_partkey").alias("parts"))


# --- scalar functions -----------------------------------------------------------------------------------------------
@query("scalar_text", """
SELECT p_partkey, substring(p_name, 3, 4) AS mid, position(' ' IN p_name) AS blank_at, right(p_brand, 1) AS last_char,
  split_part(p_name, ' ', 2) AS second_word, concat(p_type, ':', p_size) AS pair, p_type || '/' || p_brand AS joined,
  replace(replace(p_brand, 'Brand', 'B'), '#', '-') AS short_brand, trim('  ' || p_name || ' ') = p_name AS trimmed,
  CASE WHEN p_name LIKE '% %' THEN substring(p_name, 1, position(' ' IN p_name) - 1) ELSE p_name END AS first_word
FROM part
""")
def scalar_text(t):
    """F1, F2, F3, F4, F5, F6, F7, F8, F9."""
    name = F.col("p_name")
    return t["part"].select(
        "p_partkey", F.substring(name, 3, 4).alias("mid"), F.instr(name, " ").cast("bigint").alias("blank_at"),
        F.right("p_brand", F.lit(1)).alias("last_char"),
        F.split_part(name, F.lit(" "), F.lit(2)).alias("second_word"),
        X.concat_skip_nulls(F.col("p_type"), F.lit(":"), F.col("p_size").cast("string")).alias("pair"),
        F.concat("p_type", F.lit("/"), "p_brand").alias("joined"),
        F.replace(F.replace("p_brand", F.lit("Brand"), F.lit("B")), F.lit("#"), F.lit("-")).alias("short_brand"),
        (F.trim(F.concat(F.lit("  "), name, F.lit(" "))) == name).alias("trimmed"),
        F.substring_index(name, " ", 1).alias("first_word"))


@query("scalar_numbers", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_extendedprice) AS BIGINT) AS whole,
  round(l_extendedprice * (1 - l_discount), 4) AS net, CAST(l_partkey // 3 AS BIGINT) AS third,
  l_partkey % 7 AS rest, least(l_linenumber, 3) AS small, coalesce(TRY_CAST(l_returnflag AS INTEGER), 0) AS flag_no,
  CAST(l_returnflag = 'A' AS INTEGER) AS score, coalesce(NULLIF(l_linestatus, 'F'), 'none') AS status,
  CAST(CAST('t' AS BOOLEAN) AS INTEGER) AS yes FROM lineitem
""")
def scalar_numbers(t):
    """F10, F11, F13, F14, F15, F16, F17, F28."""
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", F.floor("l_extendedprice").alias("whole"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"),
        F.expr("l_partkey div 3").alias("third"), (F.col("l_partkey") % 7).alias("rest"),
        F.least("l_linenumber", F.lit(3)).alias("small"),
        F.coalesce(F.col("l_returnflag").try_cast("int"), F.lit(0)).alias("flag_no"),
        X.score_of(F.col("l_returnflag") == "A").alias("score"),
        X.none_if_missing(F.nullif("l_linestatus", F.lit("F"))).alias("status"),
        F.lit("t").cast("boolean").cast("int").alias("yes"))


@query("scalar_times", """
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at,
  CAST(date_diff('second', TIMESTAMP '2024-01-01 00:00:00', date_trunc('second', ts)) AS BIGINT) AS seconds FROM events
""")
def scalar_times(t):
    """F18, F19, F21."""
    unix = F.unix_timestamp(F.col("ts").cast("timestamp"))
    since = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz") - F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return t["events"].select(
        "event_id", F.from_unixtime(unix, "yyyy-MM-dd HH:mm:ss").alias("at"),
        since.cast("interval second").cast("decimal(20,0)").cast("bigint").alias("seconds"))


@query("scalar_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, json_keys(props) AS names,
  list_contains(json_keys(props), 'k') AS has_k FROM events
""")
def scalar_json(t):
    """F22, F24."""
    props = F.from_json("props", "map<string,int>")
    return t["events"].select("event_id", F.element_at(props, "k").alias("k"), F.map_keys(props).alias("names"),
                              F.array_contains(F.map_keys(props), "k").alias("has_k"))


@query("list_items", """
SELECT l_orderkey, l_linenumber, l_partkey, split_part(ids, ',', l_linenumber) AS item,
  CASE WHEN l_linenumber - 6 >= 1 THEN split_part(ids, ',', l_linenumber - 6) ELSE '' END AS guarded,
  TRY_CAST(substring('choice' || l_partkey, 7) AS INTEGER) AS number, right('choice' || l_partkey, 1)::INTEGER AS digit
FROM (SELECT *, concat(l_suppkey, ',', l_partkey, ',', l_orderkey) AS ids FROM lineitem) x
""")
def list_items(t):
    """F3, F4, F10, U5."""
    rows = t["lineitem"].withColumns({
        "ids": F.concat_ws(",", "l_suppkey", "l_partkey", "l_orderkey"),
        "name": F.concat(F.lit("choice"), F.col("l_partkey").cast("string"))})
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", X.list_item(F.col("ids"), F.col("l_linenumber")).alias("item"),
        X.list_item(F.col("ids"), F.col("l_linenumber") - 6).alias("guarded"),
        X.suffix_number(F.col("name"), "choice").alias("number"), X.last_digit(F.col("name")).alias("digit"))
