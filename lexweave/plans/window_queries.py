"""Bounded frames, sequence numbers, carry-forward, reading order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexweave.operators import matching as m
from lexweave.operators import order
from lexweave.plans.registry import query, table


@query("""
WITH w AS (SELECT o_custkey, o_orderkey, o_orderpriority AS k,
  coalesce(list(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), []) AS a,
  coalesce(list(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING), []) AS b FROM orders)
SELECT o_orderkey, len(list_filter(a, lambda x: x > k)) + len(list_filter(b, lambda x: x < k)) > 3 AS outlier FROM w
""")
def order_outliers(spark, sf):
    o = table(spark, sf, "orders")
    return order.outliers(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderpriority").select("o_orderkey", "outlier")


@query("""
WITH w AS (SELECT o_orderkey,
  list_sort(coalesce(list(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), [])) AS a,
  list_sort(coalesce(list(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING), [])) AS b FROM orders)
SELECT o_orderkey, coalesce(a[len(a) // 2 + 1], '') AS lo, coalesce(b[len(b) // 2 + 1], chr(65535)) AS hi FROM w
""")
def order_bounds(spark, sf):
    o = table(spark, sf, "orders")
    return order.bounds(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderpriority").select("o_orderkey", "lo", "hi")


@query("SELECT l_orderkey, l_linenumber, l_partkey, printf('%d-%04d', l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS id FROM lineitem")
def sequence_ids(spark, sf):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.format_string("%d-%04d", "l_orderkey", F.row_number().over(w)).alias("id"))


@query("SELECT event_id, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), 'head') AS context FROM events")
def left_context_lag(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf, "events").select("event_id", F.coalesce(F.lag("event_type").over(w), F.lit("head")).alias("context"))


@query("SELECT conv_id, turn, last_value(CASE WHEN role <> 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section FROM conversations")
def section_carry_forward(spark, sf):
    """The last marker seen so far."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf, "conversations").select("conv_id", "turn", F.last(F.when(F.col("role") != "assistant", F.col("turn")), ignorenulls=True).over(w).alias("section"))


@query("""
SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_quantity >= 25 THEN 0 ELSE 1 END, l_returnflag, l_extendedprice DESC, l_linenumber) AS pos FROM lineitem
""")
def reading_order_sort(spark, sf):
    """Side, tier, falling x, then the given order."""
    w = Window.partitionBy("l_orderkey").orderBy(F.when(F.col("l_quantity") >= 25, 0).otherwise(1), "l_returnflag", F.desc("l_extendedprice"), "l_linenumber")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.row_number().over(w).alias("pos"))


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders QUALIFY rank <= 3")
def topk_per_group(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return m.top_per_group(o, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


@query("""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber) AS i FROM lineitem)
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM f WHERE i = 1
""")
def first_occurrence(spark, sf):
    """Duplicates by key: the first one wins, by one aggregate."""
    x = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber")
    return m.first_match(x, ["l_partkey", "l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber"])
