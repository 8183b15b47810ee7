"""The composed steps over a built volume: a page for each of some two hundred spellings, with lexicon and second reader."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.functions import kana
from lexweave.operators import build, cleanse, dictionary
from lexweave.operators import resolve as rs
from lexweave.plans.fixtures import READINGS, _values
from lexweave.plans.registry import query

#: What a page is a case of, by its number: in the lexicon; read alike twice; read once; no spelling; a particle; spelled differently by the second reader.
CASES = ("lexicon", "twice", "once", "bare", "particle", "spelled")


def _volume() -> tuple[list, list, list]:
    """Candidates, second reader's entries and lexicon words, in reading order."""
    first = {c: (on or kun)[0] for c, (on, kun) in READINGS.items()}
    later = {c: r for c, r in first.items() if r[0] not in "はひふへほ"}
    order = str.maketrans(kana.SMALL, kana.FULL, "-") | str.maketrans(*kana._unvoiced_table())
    pairs = sorted(((f"{ra}-{rb}", a + b) for a, ra in first.items() for b, rb in later.items() if a != b), key=lambda p: (p[0].translate(order).translate(order), p))
    candidates, second, base = [], [], []
    for k, (reading, spelling) in enumerate(pairs):
        case = CASES[k % len(CASES)]
        candidates.append((f"e{k:03d}", k, reading, None if case == "bare" else spelling, "助" if case == "particle" else "名"))
        if case == "lexicon":
            base.append((reading.replace("-", ""), spelling))
        if case in ("twice", "spelled"):
            second.append((k, reading, spelling if case == "twice" else "鬱鬱"))
    return candidates, second, base


CANDIDATES, SECOND, BASE = _volume()
_SQL = f"""
WITH c AS ({_values(CANDIDATES, 'id, k, reading, notation, pos')}), s AS ({_values(SECOND, 'k, reading, notation')}), l AS ({_values(BASE, 'key, word')}),
     r AS ({_values([(c, r) for c, (on, kun) in READINGS.items() for r in dict.fromkeys([*on, *kun])], 'ch, r')}),
     fit AS (SELECT DISTINCT id FROM c JOIN r a ON a.ch = substr(notation, 1, 1) JOIN r b ON b.ch = substr(notation, 2, 1) WHERE a.r || b.r = replace(reading, '-', '')),
     v AS (SELECT c.id, c.k, replace(c.reading, '-', '') AS skk_key, c.notation,
                  CASE WHEN c.notation IS NULL THEN 'no-notation' WHEN c.pos = '助' THEN 'pos-particle' END AS gone,
                  l.key IS NOT NULL AS known, fit.id IS NOT NULL AS fits, coalesce(s.reading = c.reading, false) AS read_alike, coalesce(s.notation = c.notation, false) AS spelled_alike
           FROM c LEFT JOIN l ON l.key = replace(c.reading, '-', '') AND l.word = c.notation LEFT JOIN fit ON fit.id = c.id LEFT JOIN s ON s.k = c.k),
     verdicts AS (SELECT id, k, notation, CASE WHEN gone IS NULL THEN skk_key END AS skk_key, CASE WHEN gone IS NOT NULL THEN 'none' WHEN known THEN 'L' WHEN fits THEN 'align' ELSE 'none' END AS method,
                  CASE WHEN gone IS NOT NULL THEN gone WHEN known OR NOT fits THEN NULL WHEN NOT read_alike THEN 'align-single-reading' WHEN NOT spelled_alike THEN 'align-single-notation' END AS reason,
                  CASE WHEN gone IS NOT NULL THEN 'excluded' WHEN known OR (fits AND read_alike AND spelled_alike) THEN 'accepted' ELSE 'unverified' END AS status FROM v)
"""


def _clean(spark):
    kind = "id string, k int, reading string, notation string, pos string"
    page = F.struct(F.lit(100).alias("x"), F.lit(200).alias("y"), F.lit(30).alias("width"), F.lit(400).alias("height"))
    x = spark.createDataFrame(CANDIDATES, kind).select("id", F.lit("v").alias("pid"), F.col("k").alias("frame"), F.col("k").alias("seq"), page.alias("bbox"), "reading", "notation", "pos", F.col("reading").alias("line"), F.lit(False).alias("kango"))
    ordinal = F.struct(F.lit(0).alias("side"), F.col("k").alias("line"))
    second = spark.createDataFrame(SECOND, "k int, reading string, notation string").select(F.lit("v").alias("pid"), F.col("k").alias("frame"), F.lit(102).alias("x"), F.lit(205).alias("y"), "reading", "notation", ordinal.alias("ord"))
    none = spark.createDataFrame([], "id string, reading string, notation string")
    return cleanse.cleanse(x, second, none, none, rs.Lexicons(_base(spark), None, {}, READINGS))


def _base(spark):
    return spark.createDataFrame(BASE, "key string, word string").select(F.lit("nasi").alias("section"), "key", "word")


@query(_SQL + "SELECT id, status, method, reason, skk_key FROM verdicts")
def cleanse_volume(spark, sf):
    """All steps over a volume; the SQL derives each verdict from lexicon, readings and second reader."""
    return _clean(spark).select("id", "status", "method", "reason", "skk_key")


@query(
    _SQL
    + """, words AS (SELECT DISTINCT status, skk_key, notation, known FROM (SELECT status, skk_key, notation, method = 'L' AS known FROM verdicts WHERE status <> 'excluded'))
SELECT dictionary, skk_key AS key, '/' || notation || ';（名）/' AS line FROM (
  SELECT 'verified' AS dictionary, skk_key, notation FROM words WHERE status = 'accepted' UNION ALL
  SELECT 'noL', skk_key, notation FROM words WHERE status = 'accepted' AND NOT known UNION ALL
  SELECT 'unverified', skk_key, notation FROM words WHERE status = 'unverified')
"""
)
def build_dictionaries(spark, sf):
    """Three dictionaries of the clean volume, a line for each key."""
    words = build.dictionaries(_clean(spark).withColumn("ord", F.col("seq").cast("long")), _base(spark))
    lines = dictionary.grouped_lines(words.withColumn("key", F.concat("dictionary", F.lit("\t"), "key")))
    return lines.select(F.split("key", "\t")[0].alias("dictionary"), F.split("key", "\t")[1].alias("key"), "line")
