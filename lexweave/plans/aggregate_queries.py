"""Counts, histograms, medians, votes, intervals, digests and grouped dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.functions import text as t
from lexweave.operators import dictionary, layout, quality
from lexweave.plans.registry import query, table


@query("SELECT source, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM documents GROUP BY source")
def report_counts_share(spark, sf):
    return t.count_share(table(spark, sf, "documents"), ["source"])


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), (o_orderstatus, o_orderpriority), ())")
def report_grouping_sets(spark, sf):
    """All count tables of a report in one pass."""
    o = table(spark, sf, "orders")
    sets = [[F.col("o_orderstatus")], [F.col("o_orderpriority")], [F.col("o_orderstatus"), F.col("o_orderpriority")], []]
    return o.groupingSets(sets, "o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT event_type, (floor(value / 10) * 10)::BIGINT AS bin, count(*) AS n FROM events GROUP BY ALL")
def tier_histogram(spark, sf):
    e = table(spark, sf, "events")
    return e.groupBy("event_type", (F.floor(F.col("value") / 10) * 10).cast("long").alias("bin")).agg(F.count("*").alias("n"))


@query("""
WITH RECURSIVE h AS (
  SELECT event_type, (floor(value / 10) * 10)::BIGINT AS bin, count(*) AS n FROM events GROUP BY ALL
), r AS (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, bin) AS i FROM h WHERE n >= 5
), g AS (
  SELECT event_type, 1 AS i, [bin] AS kept FROM r WHERE i = 1
  UNION ALL
  SELECT r.event_type, r.i, CASE WHEN len(list_filter(kept, lambda k: abs(k - bin) < 30)) = 0 THEN list_append(kept, bin) ELSE kept END
  FROM g JOIN r ON r.event_type = g.event_type AND r.i = g.i + 1
)
SELECT event_type, unnest(arg_max(kept, i)) AS peak FROM g GROUP BY event_type
""")
def greedy_peaks(spark, sf):
    """Bins by falling count, kept if far enough from all kept ones."""
    h = tier_histogram(spark, sf)
    return layout.greedy_peaks(h, ["event_type"], "bin", "n", least=5, gap=30).select("event_type", F.explode("peaks").alias("peak"))


@query("SELECT l_returnflag, l_linestatus, list_sort(list(l_quantity))[len(list(l_quantity)) // 2 + 1] AS median FROM lineitem GROUP BY ALL")
def upper_median(spark, sf):
    """The upper of the two middle values, from counts of distinct values: no list of a group is built."""
    x = table(spark, sf, "lineitem")
    return layout.upper_median_by_counts(x, ["l_returnflag", "l_linestatus"], "l_quantity").select("l_returnflag", "l_linestatus", F.col("median"))


@query("""
SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS plain, count(*) FILTER (WHERE event_type = 'view') AS voiced, count(*) FILTER (WHERE event_type NOT IN ('click', 'view')) AS semi
FROM events GROUP BY user_id
""")
def voicing_stats_pivot(spark, sf):
    e = table(spark, sf, "events")
    click, view = F.col("event_type") == "click", F.col("event_type") == "view"
    return e.groupBy("user_id").agg(F.count_if(click).alias("plain"), F.count_if(view).alias("voiced"), F.count_if(~click & ~view).alias("semi"))


@query("""
WITH s AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS plain, count(*) FILTER (WHERE event_type <> 'click') AS others FROM events GROUP BY 1)
SELECT e.event_id FROM events e JOIN s USING (user_id) WHERE e.event_type = 'view' AND plain = 0 AND others >= 3
""")
def anomaly_zero_count(spark, sf):
    """Rows whose class has no support where the others have some."""
    e = table(spark, sf, "events")
    s = e.groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("plain"), F.count_if(F.col("event_type") != "click").alias("others"))
    return e.where("event_type = 'view'").join(s.where("plain = 0 AND others >= 3"), "user_id", "left_semi").select("event_id")


@query("""
WITH w AS (SELECT p_partkey, p_brand, unnest(string_split(p_name, ' ')) AS word FROM part)
SELECT p_brand, word, count(DISTINCT p_partkey) AS support FROM w GROUP BY ALL HAVING count(DISTINCT p_partkey) >= 3
""")
def support_threshold(spark, sf):
    w = table(spark, sf, "part").select("p_partkey", "p_brand", F.explode(F.split("p_name", " ")).alias("word"))
    return w.groupBy("p_brand", "word").agg(F.count_distinct("p_partkey").alias("support")).where("support >= 3")


@query("""
WITH t AS (SELECT conv_id, turn, replace(coalesce(text, ''), '-', '') AS a FROM conversations),
     c AS (SELECT conv_id, turn, a, lower(a) AS b, CASE WHEN turn % 3 = 2 THEN substr(a, 2) ELSE translate(a, 'aeiouAEIOU', 'eiouaeioua') END AS d FROM t),
     x AS (SELECT *, len(a) = len(b) AND len(b) = len(d) AS same, string_split(a, '') AS al, string_split(b, '') AS bl, string_split(d, '') AS dl FROM c)
SELECT conv_id, turn,
       CASE WHEN same AND a = '' THEN '' WHEN same THEN array_to_string([CASE WHEN bl[i] = dl[i] THEN bl[i] ELSE al[i] END for i in range(1, len(a) + 1)], '')
            WHEN a = b OR a = d THEN a WHEN b = d THEN b END AS vote FROM x
""")
def majority_vote(spark, sf):
    """Three readings of a whole text to one, place by place, or, of unequal length, the one read twice."""
    c = table(spark, sf, "conversations")
    a = F.translate(F.coalesce("text", F.lit("")), "-", "")
    d = F.when(F.col("turn") % 3 == 2, F.expr("substring(_a, 2)")).otherwise(F.translate("_a", "aeiouAEIOU", "eiouaeioua"))
    return c.select("conv_id", "turn", a.alias("_a")).select("conv_id", "turn", t.positional_vote(F.array("_a", F.lower("_a"), d)).alias("vote"))


@query("""
WITH x AS (SELECT lang, source, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS correct FROM documents JOIN labels USING (doc_id) GROUP BY ALL), y AS (SELECT *, correct / n AS p, 1.959964 * 1.959964 AS zz FROM x)
SELECT lang, source, n, correct, p AS rate,
  round(greatest(0.0, (p + zz / (2 * n) - 1.959964 * sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)), 9) AS low,
  round(least(1.0, (p + zz / (2 * n) + 1.959964 * sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)), 9) AS high FROM y
""")
def wilson_interval(spark, sf):
    x = table(spark, sf, "documents").select("doc_id", "lang", "source").join(table(spark, sf, "labels"), "doc_id")
    x = x.groupBy("lang", "source").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("correct"))
    low, high = t.wilson(F.col("correct"), F.col("n"))
    return x.select("lang", "source", "n", "correct", (F.col("correct") / F.col("n")).alias("rate"), F.round(low, 9).alias("low"), F.round(high, 9).alias("high"))


@query("SELECT n::INT AS n, round(1 - pow(0.1, 1.0 / n), 12) AS rate FROM (VALUES (50), (450), (1200), (2000)) v(n)")
def detectable_rate(spark, sf):
    n = spark.createDataFrame([(50,), (450,), (1200,), (2000,)], "n int")
    return n.select("n", F.round(t.detectable_rate(F.col("n")), 12).alias("rate"))


@query(f"""
WITH b AS (SELECT source, doc_id // {quality.DIGEST_BLOCK} AS block, sha256(string_agg(sha256(text), chr(10) ORDER BY doc_id)) AS h FROM documents GROUP BY ALL)
SELECT source, substr(sha256(string_agg(h, chr(10) ORDER BY block)), 1, 12) AS digest FROM b GROUP BY source
""")
def content_digest(spark, sf):
    """A digest by source of digests by range of ids: no row gathers more than a range's hashes, or one for each range."""
    d = table(spark, sf, "documents").select("source", "doc_id", F.col("text").cast("binary").alias("content"))
    return quality.digest_by_range(d, "source", "doc_id")


@query("""
WITH w AS (SELECT p_brand, p_type, string_agg(DISTINCT p_name, '・' ORDER BY p_name) AS names, min(p_partkey) AS ord FROM part GROUP BY ALL)
SELECT p_brand, '/' || string_agg(p_type || ';' || names, '/' ORDER BY ord) || '/' AS line FROM w GROUP BY p_brand
""")
def nested_dictionary(spark, sf):
    """Key to words in order of first appearance to notes, as one dictionary line."""
    p = table(spark, sf, "part").select(F.col("p_brand").alias("key"), F.col("p_type").alias("word"), F.col("p_name").alias("note"), F.col("p_partkey").alias("ord"))
    return dictionary.grouped_lines(p, by_note_text=True).select(F.col("key").alias("p_brand"), "line")
