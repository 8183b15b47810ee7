"""Cleaning, parsing and rendering of the driver's texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.functions import text as t
from lexweave.plans.registry import query, table


@query("SELECT doc_id, replace(replace(replace(text, chr(9), ' '), chr(10), ' '), chr(13), ' ') AS cell FROM documents")
def flatten_tsv(spark, sf):
    return table(spark, sf, "documents").select("doc_id", t.flat_cell(F.col("text")).alias("cell"))


@query("""
WITH h AS (SELECT doc_id, split_part(text, chr(10), 1) AS line FROM documents)
SELECT doc_id, regexp_extract(line, '^([A-Za-z]+) ([^.,;]*)', 1) AS reading, regexp_extract(line, '^([A-Za-z]+) ([^.,;]*)', 2) AS rest FROM h WHERE regexp_matches(line, '^[A-Za-z]+ [^.,;]*')
""")
def head_parse(spark, sf):
    """A head and what follows, from lines that have the form."""
    line = F.split("text", "\n")[0]
    x = table(spark, sf, "documents").select("doc_id", line.alias("line")).where(F.col("line").rlike("^[A-Za-z]+ [^.,;]*"))
    part = lambda i: F.regexp_extract("line", "^([A-Za-z]+) ([^.,;]*)", i)
    return x.select("doc_id", part(1).alias("reading"), part(2).alias("rest"))


@query("SELECT doc_id, lower(regexp_replace(trim(regexp_replace(text, '[^A-Za-z ]+', '', 'g')), ' +', ' ', 'g')) AS key FROM documents")
def normalize_text(spark, sf):
    """Keys of whole texts: documents that differ after a common beginning have different ones."""
    return table(spark, sf, "documents").select("doc_id", t.normal_key(F.col("text")).alias("key"))


@query("SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, lpad(regexp_extract(url, '([0-9]+)[^0-9]*$', 1), 7, '0') AS name FROM pages")
def url_parts(spark, sf):
    number = F.regexp_extract("url", "([0-9]+)[^0-9]*$", 1)
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"), F.lpad(number, 7, "0").alias("name"))


@query("SELECT page_id, len(regexp_extract_all(html, '<p[ >]')) AS n_paragraphs, coalesce(array_to_string(list_distinct(list_sort(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))), ' '), '') = '' AS no_links FROM pages")
def html_attr_scan(spark, sf):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return table(spark, sf, "pages").select("page_id", F.regexp_count("html", F.lit("<p[ >]")).cast("long").alias("n_paragraphs"), (F.size(F.array_distinct(links)) == 0).alias("no_links"))


@query("SELECT event_id, json_extract_string(props, '$.' || (SELECT min(k) FROM (SELECT unnest(json_keys(props)) AS k FROM (SELECT props FROM events ORDER BY event_id LIMIT 1)))) AS first_prop FROM events")
def json_props(spark, sf):
    """One field of the JSON column, whose name is the first row's smallest."""
    e = table(spark, sf, "events")
    keys = e.orderBy("event_id").limit(1).select(F.array_min(F.json_object_keys("props")).alias("k")).first()
    return e.select("event_id", F.get_json_object("props", f"$.{keys['k']}").alias("first_prop"))


@query("SELECT source, count(*) AS n, count(*) FILTER (WHERE regexp_matches(text, '[A-Z]{4,}')) AS shouting, count(*) FILTER (WHERE contains(text, '|')) AS piped FROM documents GROUP BY source")
def strata_counts(spark, sf):
    """Named, overlapping strata counted in one pass."""
    strata = {"shouting": F.col("text").rlike("[A-Z]{4,}"), "piped": F.col("text").contains("|")}
    return table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"), *[F.count_if(c).alias(k) for k, c in strata.items()])


@query("""
WITH d AS (SELECT doc_id, CASE WHEN n_chars < 50 THEN ['reading:a→b(short)'] ELSE [] END || CASE WHEN doc_id % 2 = 0 THEN ['notation:x→y(even)'] ELSE [] END AS f FROM documents)
SELECT doc_id, coalesce(array_to_string(f, '; '), '') AS fixes FROM d
""")
def flatten_fixes(spark, sf):
    fix = lambda *v: F.struct(*[F.lit(x).alias(k) for k, x in zip(("field", "from", "to", "reason"), v, strict=True)])
    own = F.array_compact(F.array(F.when(F.col("n_chars") < 50, fix("reading", "a", "b", "short")), F.when(F.col("doc_id") % 2 == 0, fix("notation", "x", "y", "even"))))
    return table(spark, sf, "documents").select("doc_id", t.flat_fixes(own).alias("fixes"))
