"""Operators on Japanese entries, on the small fixtures of their rules. SQL restates what each must give."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexweave.functions import align, kana
from lexweave.functions import text as t
from lexweave.operators import dictionary, layout, order, quality
from lexweave.plans.fixtures import READINGS, _values
from lexweave.plans.registry import query


HEADS = (
    ("かは-ぎし川岸(名)川の岸。", "かは-ぎし", "川岸", False, "名"),
    ("ながむ 眺(他動下二) 遠く", "ながむ", "眺", False, "他動下二"),
    ("しんらい一信頼(名)", "しんらい", "信頼", True, "名"),
    ("いちば一場(名)", "いちば", "一場", False, "名"),
    ("おお(感)", "おお", None, False, "感"),
)


@query(_values(HEADS, "line, reading, notation, kango, pos"))
def parse_heads(spark, sf):
    x = spark.createDataFrame([(r[0],) for r in (*HEADS, ("川の岸に立つ",), ("カハ(名)",))], "line string")
    return x.select("line", kana.parse_head(F.col("line")).alias("h")).where("h IS NOT NULL").select("line", "h.*")


POS = (("名", "noun", "noun", None), ("名、副", "noun", "noun,adverb", None), ("他動四", "verb", "verb", "四段"), ("自動地", "verb", "verb", None), ("自動下二", "verb", "verb", "下二"), ("形二", "adjective", "adjective", "シク"), ("枕", "makura", "makura", None), ("助動", "auxiliary", "auxiliary", None))


@query(_values(POS, "raw, category, categories, conjugation"))
def normalize_pos_labels(spark, sf):
    x = spark.createDataFrame([(r[0],) for r in POS], "raw string").select(kana.normalize_pos(F.col("raw")).alias("p"))
    return x.select("p.raw", "p.category", F.array_join("p.categories", ",").alias("categories"), "p.conjugation")


KEYS = ("あし-づつ", "あいきゃう", "ヴァイオリン", "ぱっぱ", "がー・ぐ")


@query(f"""
SELECT reading, translate(translate(reading, '-ー・', ''), 'ぁぃぅぇぉっゃゅょゎ' || 'がぎぐげござじずぜぞだぢづでどばびぶべぼぱぴぷぺぽヴ', 'あいうえおつやゆよわ' || 'かきくけこさしすせそたちつてとはひふへほはひふへほウ') AS key
FROM ({_values([(k,) for k in KEYS], 'reading')})
""")
def collation_keys(spark, sf):
    x = spark.createDataFrame([(k,) for k in KEYS], "reading string")
    return x.select("reading", kana.collation_key(F.col("reading")).alias("key"))


VARIANTS = (("おもふ", False, "おもう"), ("あぢ-さゐ", False, "あじさい"), ("はな-ぢ", False, "はなぢ"), ("あい-きやう", True, "あいきょう"), ("てふてふ", True, "ちょうちょう"), ("くわう-さい", True, "こうさい"), ("たいやう-ねん", True, "たいようねん"))


@query(_values(VARIANTS, "reading, kango, modern"))
def modern_spelling(spark, sf):
    x = spark.createDataFrame([r[:2] for r in VARIANTS], "reading string, kango boolean")
    return x.select("reading", "kango", kana.modern_variants("reading", "kango")[0].alias("modern"))


ALIGNED = (("明場", "あけば", True), ("國方", "くにがた", True), ("方留", "かたどめ", True), ("愛校", "あいこう", True), ("出足", "であし", True), ("柱時", "はしらどき", True), ("國柱", "くにのはしら", True), ("學國", "がっこく", True), ("明場", "あけもと", False), ("方々", "かたがた", True))


@query(_values(ALIGNED, "notation, reading, fits"))
def align_readings(spark, sf):
    x = spark.createDataFrame([r[:2] for r in ALIGNED], "notation string, reading string")
    return x.select("notation", "reading", align.fits_udf(READINGS)("notation", "reading").alias("fits"))


#: Sixty keys in order, of which every seventh was moved by nine places.
OUTLIER_KEYS = tuple(f"{'あかさたなはまやらわ'[(k + (9 if k % 7 == 3 else 0)) // 6 % 10]}{'いきしちにひ'[(k + (9 if k % 7 == 3 else 0)) % 6]}" for k in range(60))


@query(f"""
WITH k AS ({_values(list(enumerate(OUTLIER_KEYS)), 'seq, key')})
SELECT a.seq, a.key, count(*) FILTER (WHERE (b.seq < a.seq AND b.key > a.key) OR (b.seq > a.seq AND b.key < a.key)) > 3 AS outlier FROM k a JOIN k b ON abs(a.seq - b.seq) BETWEEN 1 AND 6 GROUP BY a.seq, a.key
""")
def collation_outliers(spark, sf):
    x = spark.createDataFrame([("v", i, k) for i, k in enumerate(OUTLIER_KEYS)], "pid string, seq int, key string")
    return order.outliers(x, ["pid"], ["seq"], "key").select("seq", "key", "outlier")


VOTES = (("a", ["くん-すゐ", "ぐん-すゐ", "ぐんすゐ"], "ぐんすゐ"), ("b", ["ゑんのはぎ", "ねんのはぎ", "ゑんのはざ"], "ゑんのはぎ"), ("c", ["ぶまゐ", "ぶ-まる", "ぶまる"], "ぶまる"), ("d", ["せんぴ", "ぜんぴ"], None), ("e", ["あげざま", "あげざま"], "あげざま"))


@query(_values([(a, c) for a, _, c in VOTES], "id, vote"))
def vote_readings(spark, sf):
    x = spark.createDataFrame([r[:2] for r in VOTES], "id string, readings array<string>")
    return x.select("id", t.positional_vote(F.col("readings")).alias("vote"))


REREAD = (("a", 0, "こんばく"), ("a", 1, "こんぱく"), ("a", 2, "こん-ぱく"), ("a", 3, "こんぱく"), ("b", 0, "でんぱう"), ("b", 1, "でんばう"), ("c", 0, "いろは"), ("d", 0, "に"), ("d", 1, "に"), ("d", 2, "ほ"))


@query(f"""
WITH r AS (SELECT id, system, reading, replace(reading, '-', '') AS bare FROM ({_values(REREAD, 'id, system, reading')})), c AS (SELECT id, bare, count(*) AS n, arg_min(reading, system) AS first FROM r GROUP BY ALL),
     m AS (SELECT id, max(n) AS top FROM c GROUP BY id), w AS (SELECT c.id, count(*) AS k, min(first) AS first FROM c JOIN m ON c.id = m.id AND n = top GROUP BY c.id)
SELECT r.id, CASE WHEN w.k > 1 THEN r.reading ELSE w.first END AS reading FROM r JOIN w USING (id) WHERE system = 0
""")
def vote_rereadings(spark, sf):
    return quality.vote_rereadings(spark.createDataFrame(list(REREAD), "id string, system int, reading string"))


@query("SELECT * FROM (VALUES ('v-042-0001', 'R', 1, -10), ('v-042-0002', 'R', 1, -12), ('v-042-0003', 'L', 1, -10)) v(id, side, tier, \"offset\")")
def page_layout(spark, sf):
    """Heads of a two-sided page in reading order, with their tiers."""
    row = lambda i, text, x, y: ("v", 42, 4000, i, text, x, y, 30, 400, 0.9)
    lines = [row(0, "あし-つぎ足繼(名)高くて", 3900, 390), row(1, "あし-ば足場(名)足を", 3700, 388)] + [row(2 + k, "本文の列", 3850 - 30 * k, 405) for k in range(5)]
    lines += [row(7, "あし-ぶみ足踏(名)足で", 1900, 930)] + [row(8 + k, "本文の列", 1850 - 30 * k, 945) for k in range(5)]
    df = spark.createDataFrame(lines, "pid string, frame int, page_width int, line_idx int, text string, x int, y int, width int, height int, conf double")
    return layout.extract_candidates(df).select("id", "side", "tier", "offset")


NOTES = (("てふ-てふ", "ちょうちょう", "名", "てふてふ（名）"), ("あし-ば", "あしば", "名", "（名）"), ("おもふ", "おもう", "他動四", "おもふ（他動）"), ("いや-まし", "いやまし", "名、副", "（名・副）"))


@query(_values(NOTES, "reading, modern, pos, annotation"))
def annotations(spark, sf):
    x = spark.createDataFrame([r[:3] for r in NOTES], "reading string, modern string, pos string")
    return x.select("reading", "modern", "pos", dictionary.annotation(F.col("reading"), F.col("modern"), kana.normalize_pos(F.col("pos"))).alias("annotation"))


@query("SELECT * FROM (VALUES ('nasi', 'あしば', '足庭;（名）'), ('nasi', 'ちょうちょう', '蝶蝶;てふてふ（名）')) v(section, key, words)")
def dictionary_without_lexicon(spark, sf):
    """Clean entries to dictionary words, without those that the base lexicon has."""
    clean = spark.createDataFrame(
        [("てふ-てふ", "ちょうちょう", "ちょうちょう", "蝶蝶", "蝶蝶", "名", 0), ("あし-ば", "あしば", "あしば", "足場", "足場", "名", 1), ("あし-ば", "あしば", "あしば", "足庭", "足庭", "名", 2)],
        "reading string, modern string, skk_key string, shinjitai string, notation string, raw string, ord long",
    ).select("*", F.lit(False).alias("okuri"), F.lit(None).cast("array<string>").alias("alt_notations"), kana.normalize_pos(F.col("raw")).alias("pos"))
    lexicon = spark.createDataFrame([("nasi", "あしば", "足場")], "section string, key string, word string")
    words = dictionary.without_lexicon(dictionary.entries(dictionary.dictionary_words(clean)), lexicon)
    lines = dictionary.grouped_lines(words)
    return lines.select(F.lit("nasi").alias("section"), "key", F.regexp_replace("line", "^/|/$", "").alias("words"))
