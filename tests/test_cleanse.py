"""Steps of the composed cleansing that the volume query has no case of."""

import pytest
from pyspark.sql import functions as F

from lexweave.functions import align, sino, transcription
from lexweave.operators import aligning, build, cleanse
from lexweave.plans.fixtures import READINGS


def test_long_input_gives_a_result():
    a = align.Aligner({"山": ([], ["やま"]), "川": (["せん"], ["かわ"])})
    assert a.fits("山" * 750, "やま" * 750 * 2) is False and a.fits("山川" * 375, ("やまかわ") * 375)
    s = sino.Sino({"山": ["さん"], "川": ["せん"]})
    assert s.segment("山川" * 750, "さんせん" * 750) == ["さん", "せん"] * 750 and s.segment("山川", "さん" * 1500) is None
    assert transcription.transcriptions("さん" * 1500) == ["サン" * 1500] and len(transcription.transcriptions("おを" * 1500)) <= transcription.MOST_WORD


def test_readings_between_neighbours(spark):
    df = spark.createDataFrame([("いさき", "いさか", "いさく"), ("-いう", "こあ", "こう"), ("あし", "か", "き")], "r string, lo string, hi string")
    got = df.select(cleanse.in_order(F.col("r"), F.col("lo"), F.col("hi")).alias("a"), cleanse.with_dropped_head(F.col("r"), F.col("lo"), F.col("hi")).alias("b")).collect()
    assert "いざき" in got[0]["a"] and "りさき" not in got[0]["a"] and "こ-いう" in got[1]["b"] and got[2]["b"] == ["か-あし", "が-あし"]


def test_spellings_in_a_row_are_cut(spark):
    df = spark.createDataFrame([("肱臂", ["肱", "臂"]), ("肱臂", ["肱"]), ("ab", ["a", "b", "ab"]), (None, ["a"])], "s string, p array<string>")
    assert [r["c"] for r in df.select(cleanse.cut_into("s", "p").alias("c")).collect()] == [["肱", "臂"], None, ["ab"], None]


@pytest.mark.parametrize(
    ("forms", "variants", "bare", "words", "want"),
    [
        (["足場"], ["あしば"], "あしば", [], "あしば"),
        (["足場"], ["あしわ", "あしば"], "あしば", [], "あしば"),
        (["物"], ["ものわ", "ものは"], "ものは", [], "ものは"),
        (["足場"], ["てあし"], "てあし", [], None),
        (["音円"], ["おんえん"], "おんえん", [(0, 0, 2, "おんねん")], "おんねん"),
        (["丹羽足"], ["にはあし", "にわあし"], "にはあし", [(0, 0, 2, "にわ")], "にわあし"),
    ],
)
def test_nouns(forms, variants, bare, words, want):
    more = {"物": ([], ["もの"]), "音": (["おん"], []), "円": (["えん"], []), "丹": (["たん"], ["に"]), "羽": (["う"], ["は", "はね"])}
    assert aligning.NounRules(READINGS | more, None).choose(forms, variants, bare, words) == want


def test_dictionaries_are_written_in_two_encodings(spark, tmp_path):
    pos = F.struct(F.array(F.lit("noun")).alias("categories"), F.lit("名").alias("raw"))
    rows = [("a", "accepted", "あし-ば", "足場", "あしば"), ("b", "accepted", "あし-げ", "足毛", "あしげ"), ("c", "unverified", "いし", "𠮷", "いし"), ("d", "excluded", "うし", "牛", "うし")]
    clean = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "id string, status string, reading string, notation string, skk_key string, ord long")
    clean = clean.select("*", F.col("skk_key").alias("modern"), F.col("notation").alias("shinjitai"), F.lit(False).alias("okuri"), F.lit(None).cast("array<string>").alias("alt_notations"), pos.alias("pos"))
    base = spark.createDataFrame([("nasi", "あしば", "足場")], "section string, key string, word string")
    assert [r["id"] for r in build.in_no_lexicon(clean, base).collect()] == ["b"]
    words = build.dictionaries(clean, base)
    assert {(r["dictionary"], r["word"]) for r in words.collect()} == {("verified", "足場"), ("verified", "足毛"), ("noL", "足毛"), ("unverified", "𠮷")}
    assert {r["dictionary"]: (r["ari"], r["nasi"], r["words"]) for r in build.sizes(words).collect()} == {"verified": (0, 2, 2), "noL": (0, 1, 1), "unverified": (0, 1, 1)}
    dropped = build.write(clean, base, str(tmp_path), "own", "test")
    assert dropped["unverified", "euc-jp"] == 1 and dropped["verified", "utf-8"] == 0
    text = [r["value"] for r in spark.read.text(f"{tmp_path}/verified.utf-8").collect()]
    assert text[3] == ";; 2 entries" and text[-2:] == ["あしげ /足毛;（名）/", "あしば /足場;（名）/"]


def test_a_draw_is_repeatable(spark):
    rows = spark.createDataFrame([("s", f"i{k}") for k in range(50)] + [("t", "x")], "stratum string, id string")
    a = build.draw_by_stratum(rows.repartition(5), 7, 3).collect()
    assert sorted(a) == sorted(build.draw_by_stratum(rows.coalesce(1), 7, 3).collect())
    assert {r["stratum"]: r["total"] for r in a} == {"s": 50, "t": 1} and sorted(r["no"] for r in a if r["stratum"] == "s") == list(range(1, 8))
