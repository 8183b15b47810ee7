"""Semi, anti, left, full, band and first-match joins on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.functions import text as t
from lexweave.operators import matching as m
from lexweave.plans.registry import query, table

_KEY = "lower(regexp_replace(trim(regexp_replace(text, '[^A-Za-z ]+', '', 'g')), ' +', ' ', 'g'))"


@query(f"""
WITH d AS (SELECT doc_id, lang, {_KEY} AS key FROM documents),
     b AS (SELECT DISTINCT {_KEY} AS key FROM benchmark)
SELECT lang, CASE WHEN key = '' THEN 'excluded' WHEN doc_id % 7 = 0 THEN 'unverified' ELSE 'accepted' END AS status, count(*) AS n,
       count(*) / sum(count(*)) OVER () AS share
FROM d WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.key = d.key) GROUP BY ALL
""")
def nol_anti_join(spark, sf):
    """Normalise whole texts, leave out what the reference lexicon has, count by status with the share of all."""
    key = t.normal_key(F.col("text"))
    status = F.when(key == "", "excluded").when(F.col("doc_id") % 7 == 0, "unverified").otherwise("accepted")
    d = table(spark, sf, "documents").select("lang", status.alias("status"), F.sha2(key.cast("binary"), 256).alias("key"))
    b = table(spark, sf, "benchmark").select(F.sha2(key.cast("binary"), 256).alias("key")).distinct()
    return t.count_share(d.join(b, "key", "left_anti"), ["lang", "status"])


@query("SELECT doc_id, lang, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def lexicon_semi_join(spark, sf):
    good = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    return table(spark, sf, "documents").select("doc_id", "lang", "source").join(good, "doc_id", "left_semi")


@query("""
SELECT d.doc_id, CASE WHEN n_chars < 40 THEN 'excluded' WHEN l.doc_id IS NULL THEN 'unverified' WHEN quality = 0 THEN 'excluded' WHEN toxic = 1 THEN 'unverified' ELSE 'accepted' END AS status,
       CASE WHEN n_chars < 40 THEN 'too-short' WHEN l.doc_id IS NULL THEN 'no-label' WHEN quality = 0 THEN 'low-quality' WHEN toxic = 1 THEN 'toxic' END AS reason
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def status_routing(spark, sf):
    """An ordered decision list: the first rule that holds sets status and reason."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    x = d.join(table(spark, sf, "labels").withColumn("seen", F.lit(True)), "doc_id", "left")
    rules = [(F.col("n_chars") < 40, "excluded", "too-short"), (F.col("seen").isNull(), "unverified", "no-label"), (F.col("quality") == 0, "excluded", "low-quality"), (F.col("toxic") == 1, "unverified", "toxic")]
    return x.select("doc_id", t.first_rule(rules, "accepted", None).alias("_r")).select("doc_id", "_r.status", "_r.reason")


@query("""
WITH o AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'accepted' ELSE 'excluded' END AS status, doc_id % 11 AS k FROM labels),
     n AS (SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'accepted' WHEN quality = 1 THEN 'unverified' ELSE 'excluded' END AS status, doc_id % 11 + toxic AS k FROM labels)
SELECT o.status AS old_status, n.status AS new_status, count(*) AS n,
       count(*) FILTER (WHERE o.status = 'accepted' AND n.status = 'accepted' AND o.k <> n.k) AS key_changes
FROM o JOIN n USING (doc_id) WHERE o.status <> n.status OR o.k <> n.k GROUP BY ALL
""")
def build_compare_transitions(spark, sf):
    """Two builds joined on id: status transitions, and key changes of rows accepted in both."""
    labels = table(spark, sf, "labels")
    old = labels.select("doc_id", F.when(F.col("quality") == 1, "accepted").otherwise("excluded").alias("old_status"), (F.col("doc_id") % 11).alias("old_key"))
    new = labels.select(
        "doc_id",
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "accepted").when(F.col("quality") == 1, "unverified").otherwise("excluded").alias("new_status"),
        (F.col("doc_id") % 11 + F.col("toxic")).alias("new_key"),
    )
    both = old.join(new, "doc_id").where("old_status <> new_status OR old_key <> new_key")
    return both.groupBy("old_status", "new_status").agg(F.count("*").alias("n"), F.count_if((F.col("old_status") == "accepted") & (F.col("new_status") == "accepted") & (F.col("old_key") != F.col("new_key"))).alias("key_changes"))


@query("""
WITH a AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders WHERE year(o_orderdate) <= 1994 GROUP BY 1),
     b AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders WHERE year(o_orderdate) > 1994 AND o_orderstatus <> 'P' GROUP BY 1)
SELECT label, coalesce(a.n, 0) AS old_n, coalesce(b.n, 0) AS new_n, coalesce(b.n, 0) - coalesce(a.n, 0) AS diff,
       round(coalesce(b.n, 0) / nullif((SELECT sum(n) FROM b), 0), 9) AS new_share
FROM a FULL JOIN b USING (label)
""")
def side_by_side_full_outer(spark, sf):
    """Counts of two builds side by side; shares are of the new one."""
    o = table(spark, sf, "orders").withColumn("label", F.col("o_orderpriority"))
    a = o.where(F.year("o_orderdate") <= 1994).groupBy("label").agg(F.count("*").alias("old_n"))
    b = o.where((F.year("o_orderdate") > 1994) & (F.col("o_orderstatus") != "P")).groupBy("label").agg(F.count("*").alias("new_n"))
    total = b.agg(F.sum("new_n").alias("total"))  # one row
    x = a.join(b, "label", "full").crossJoin(F.broadcast(total)).na.fill(0, ["old_n", "new_n"])
    return x.select("label", "old_n", "new_n", (F.col("new_n") - F.col("old_n")).alias("diff"), F.round(F.try_divide("new_n", "total"), 9).alias("new_share"))


@query("""
WITH a AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_partkey % 3 <> 0), b AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_partkey % 3 <> 1)
SELECT 'added' AS side, * FROM (SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL SELECT 'removed' AS side, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
""")
def added_removed_pairs(spark, sf):
    """Set difference of two builds' (key, word) pairs, both ways."""
    p = table(spark, sf, "part")
    a, b = (p.where(F.col("p_partkey") % 3 != k).select("p_brand", "p_type").distinct() for k in (0, 1))
    return b.exceptAll(a).select(F.lit("added").alias("side"), "*").unionByName(a.exceptAll(b).select(F.lit("removed").alias("side"), "*"))


@query("SELECT doc_id, source, CASE quality WHEN 1 THEN 'o' WHEN 0 THEN 'x' ELSE '' END AS judgment, CASE WHEN toxic = 1 THEN 'toxic' ELSE '' END AS note FROM documents LEFT JOIN labels USING (doc_id)")
def carry_over_judgments(spark, sf):
    """Earlier judgments by key; rows without one get empty cells."""
    x = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id", "left")
    return x.select("doc_id", "source", F.when(F.col("quality") == 1, "o").when(F.col("quality") == 0, "x").otherwise("").alias("judgment"), F.when(F.col("toxic") == 1, "toxic").otherwise("").alias("note"))


@query("""
SELECT n.doc_id FROM labels n LEFT JOIN (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'accepted' ELSE 'unverified' END AS status FROM labels WHERE doc_id % 5 <> 0) o USING (doc_id)
WHERE n.quality = 1 AND coalesce(o.status, '') <> 'accepted'
""")
def promoted_rows(spark, sf):
    """Accepted now and not before, rows that weren't there before included."""
    labels = table(spark, sf, "labels")
    old = labels.where("doc_id % 5 <> 0").select("doc_id", F.when(F.col("doc_id") % 3 == 0, "accepted").otherwise("unverified").alias("old_status"))
    return labels.where("quality = 1").join(old, "doc_id", "left").where("coalesce(old_status, '') <> 'accepted'").select("doc_id")


@query("""
WITH d AS (SELECT doc_id, list_distinct(string_split(lower(replace(text, chr(10), ' ')), ' ')) AS forms FROM documents),
     w AS (SELECT DISTINCT unnest(string_split(lower(replace(text, chr(10), ' ')), ' ')) AS word FROM benchmark),
     u AS (SELECT doc_id, unnest(forms) AS word FROM d)
SELECT doc_id, len(forms)::INT AS n_forms FROM d WHERE NOT EXISTS (SELECT 1 FROM u JOIN w USING (word) WHERE u.doc_id = d.doc_id)
""")
def added_none_of_forms(spark, sf):
    """Items of which every form is missing in the base; forms are the distinct words of the whole text."""
    words = F.split(F.lower(F.translate("text", "\n", " ")), " ")
    d = table(spark, sf, "documents").select("doc_id", F.array_distinct(words).alias("forms"))
    base = table(spark, sf, "benchmark").select(F.explode(words).alias("word"))
    return m.none_of_forms(d, "doc_id", "forms", base, "word").select("doc_id", F.size("forms").alias("n_forms"))


@query("""
WITH a AS (SELECT event_id, user_id, floor(epoch(ts))::BIGINT AS s FROM events WHERE event_type = (SELECT min(event_type) FROM events)),
     b AS (SELECT event_id AS other_id, user_id, floor(epoch(ts))::BIGINT AS s2 FROM events WHERE event_type = (SELECT max(event_type) FROM events)),
     j AS (SELECT a.event_id, other_id, abs(s - s2) AS distance FROM a JOIN b ON a.user_id = b.user_id AND abs(s - s2) <= 86400),
     k AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY distance, other_id) = 1)
SELECT a.event_id, k.other_id, k.distance FROM a LEFT JOIN k USING (event_id)
""")
def nearest_band_join(spark, sf):
    """Two systems' records of one key linked to the nearest within a window."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"))
    ends = e.agg(F.min("event_type").alias("lo"), F.max("event_type").alias("hi"))
    e = e.crossJoin(F.broadcast(ends))
    a = e.where("event_type = lo").select("event_id", "user_id", "s")
    b = e.where("event_type = hi").select(F.col("event_id").alias("other_id"), "user_id", F.col("s").alias("s2"))
    return m.nearest_in_band(a, b, ["user_id"], ("s", "s2"), 86400, "event_id", "other_id", ["other_id"]).select("event_id", "other_id", "distance")


@query("""
SELECT a.event_id, arg_min(b.event_id, (b.ts, b.event_id)) AS next_id
FROM events a JOIN events b ON a.user_id = b.user_id AND b.event_type <> a.event_type AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 6 HOUR
GROUP BY a.event_id
""")
def self_theta_top1(spark, sf):
    """Self join with a range condition, the first partner of each row."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    b = e.select(F.col("event_id").alias("next_id"), "user_id", F.col("event_type").alias("type2"), F.col("us").alias("us2"))
    pairs = m.band_join(e, b, ["user_id"], ("us", "us2"), 6 * 3600 * 10**6).where("us2 > us AND type2 <> event_type")
    return m.first_match(pairs, ["event_id"], ["us2", "next_id"], ["next_id"])


@query("""
WITH tiers(i, tier) AS (VALUES (0, 950.0), (1, 1200.0), (2, 1450.0), (3, 1700.0), (4, 1950.0))
SELECT p_partkey, (SELECT arg_min(tier, (abs(p_retailprice - tier), i)) FROM tiers)::DOUBLE AS tier,
       CASE WHEN (SELECT min(abs(p_retailprice - tier)) FROM tiers) <= 60 THEN p_retailprice - (SELECT arg_min(tier, (abs(p_retailprice - tier), i)) FROM tiers) END AS off
FROM part
""")
def nearest_tier(spark, sf):
    """The nearest of a few tiers; the offset only within the margin."""
    tier = m.nearest_of(F.col("p_retailprice"), [950.0, 1200.0, 1450.0, 1700.0, 1950.0])
    x = table(spark, sf, "part").select("p_partkey", "p_retailprice", tier.alias("tier"))
    off = F.col("p_retailprice") - F.col("tier")
    return x.select("p_partkey", "tier", F.when(F.abs(off) <= 60, off).alias("off"))


@query("""
WITH e AS (SELECT DISTINCT l_partkey % 50 AS a, l_suppkey % 50 AS b FROM lineitem)
SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b
""")
def variant_edges(spark, sf):
    """An undirected relation stored both ways."""
    e = table(spark, sf, "lineitem").select((F.col("l_partkey") % 50).alias("a"), (F.col("l_suppkey") % 50).alias("b"))
    return m.both_directions(e, "a", "b")


@query("""
WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part),
     q AS (SELECT DISTINCT substr(word, 1, len(word) - 1) || 'x' AS wrong FROM w WHERE len(word) >= 4),
     c AS (SELECT wrong, word FROM q JOIN w ON len(word) = len(wrong) AND levenshtein(wrong, word) = 1)
SELECT wrong, min(word) AS fixed FROM c GROUP BY wrong HAVING count(DISTINCT word) = 1
""")
def edit_distance_unique_fix(spark, sf):
    """A repair is taken only if exactly one lexicon word is one substitution away."""
    w = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    q = w.where(F.length("word") >= 4).select(F.concat(F.expr("substring(word, 1, length(word) - 1)"), F.lit("x")).alias("wrong")).distinct()
    a = q.select("wrong", F.explode(m.deletions(F.col("wrong"))).alias("k"))
    b = w.select("word", F.explode(m.deletions(F.col("word"))).alias("k"))
    c = a.join(b, "k").where(F.levenshtein("wrong", "word") == 1).groupBy("wrong").agg(F.count_distinct("word").alias("n"), F.min("word").alias("fixed"))
    return c.where("n = 1").select("wrong", "fixed")


@query("""
WITH b AS (SELECT DISTINCT p_brand AS brand FROM part)
SELECT x.brand AS a, y.brand AS b FROM b x JOIN b y ON len(x.brand) = len(y.brand) AND x.brand <> y.brand AND hamming(x.brand, y.brand) = 1
""")
def hamming_one_pairs(spark, sf):
    """Pairs one character apart, met on the string with one place left out."""
    b = table(spark, sf, "part").select(F.col("p_brand").alias("a")).distinct()
    k = b.select("a", F.explode(m.deletions(F.col("a"))).alias("k"))
    return k.join(k.select(F.col("a").alias("b"), "k"), "k").where(m.hamming_one(F.col("a"), F.col("b"))).select("a", "b").distinct()


@query("""
WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part),
     p AS (SELECT word, unnest(range(2, len(word))) AS n FROM w)
SELECT p.word, w.word AS part FROM p JOIN w ON w.word = substr(p.word, 1, p.n)
""")
def substring_join(spark, sf):
    """Words whose proper beginning is itself a word."""
    w = table(spark, sf, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    starts = w.where(F.length("word") > 2).select("word", F.explode(F.transform(F.sequence(F.lit(2), F.length("word") - 1), lambda n: F.substring(F.col("word"), F.lit(1), n))).alias("part"))
    return starts.join(w.select(F.col("word").alias("part")), "part", "left_semi").select("word", "part")


@query("""
WITH r AS (
  SELECT c_custkey, 1 AS method, n_nationkey AS ord, 'nation' AS how FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1
  UNION ALL SELECT c_custkey, 2, 0, 'segment' FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
  UNION ALL SELECT c_custkey, 3, s_suppkey, 'supplier' FROM customer JOIN supplier ON c_nationkey = s_nationkey WHERE s_acctbal > 0)
SELECT c_custkey, coalesce(arg_min(how, (method, ord)), 'none') AS how, arg_min(ord, (method, ord)) AS ord FROM customer LEFT JOIN r USING (c_custkey) GROUP BY c_custkey
""")
def method_rank_first_match(spark, sf):
    """Three lookups of falling rank; the first method that finds something decides."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    s = table(spark, sf, "supplier").where("s_acctbal > 0").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.min("s_suppkey").alias("ord"))
    hits = (
        c.join(n, "c_nationkey").select("c_custkey", F.lit(1).alias("method"), F.col("c_nationkey").cast("long").alias("ord"), F.lit("nation").alias("how"))
        .unionByName(c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", F.lit(2).alias("method"), F.lit(0).cast("long").alias("ord"), F.lit("segment").alias("how")))
        .unionByName(c.join(s, "c_nationkey").select("c_custkey", F.lit(3).alias("method"), "ord", F.lit("supplier").alias("how")))
    )
    best = m.first_match(hits, ["c_custkey"], ["method", "ord"], ["how", "ord"])
    return c.join(best, "c_custkey", "left").select("c_custkey", F.coalesce("how", F.lit("none")).alias("how"), "ord")
