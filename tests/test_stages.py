"""Selections and late repairs of clean entries; cases of our own but for the transcriptions'."""

import pytest
from pyspark.sql import functions as F

from lexweave.functions import kana
from lexweave.functions.transcription import transcriptions
from lexweave.operators import resolve as rs
from lexweave.operators import stages as st
from lexweave.plans.fixtures import READINGS
from lexweave.sources import lexicons

KIND = "id string, status string, method string, reason string, reading string, notation string, skk_key string, modern string, source struct<reading:string>, ndl struct<reading:string>, fixes array<struct<field:string,from:string,to:string,reason:string>>"


def clean(spark, *rows):
    base = {"id": "a", "status": "accepted", "method": "L", "reason": None, "reading": "あしば", "notation": "足場", "skk_key": "あしば", "modern": "あしば", "source": ("あし-ば",), "ndl": ("あしーば",), "fixes": []}
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], KIND)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_rereading_targets(spark):
    df = clean(spark, {}, {"id": "b", "ndl": None}, {"id": "c", "ndl": ("あしげ",)}, {"id": "d", "status": "excluded", "ndl": None}, {"id": "e", "reason": "align-rendaku", "status": "unverified"}, {"id": "f", "reason": "align-dzi", "status": "unverified"})
    assert ids(st.rereading_targets(df)) == ["b", "c", "e", "f"] and ids(st.rereading_targets(df, full=True)) == ["e"]
    head = spark.createDataFrame([("a",), ("e",)], "id string")
    assert ids(st.variant_targets(df, head)) == ["e"]


def test_read_head(spark):
    x = spark.createDataFrame([("a", 20, "足場(名)"), ("a", 10, "あし-ば"), ("b", 1, "あし ば。x"), ("c", 1, "。")], "id string, y int, text string")
    assert {r["id"]: (r["reading"], r["notation"]) for r in st.read_head(x).collect()} == {"a": ("あし-ば", "足場"), "b": ("あしば", None), "c": (None, None)}


def test_notes(spark):
    df = clean(spark, {"id": "a", "notation": "大夫", "reading": "たいふ", "skk_key": "たいふ", "modern": "たいふ"}, {"id": "b", "notation": "大夫", "reading": "たいふ", "skk_key": "たいふ"}, {"id": "c"})
    assert [tuple(r) for r in st.note_targets(df).orderBy("id").collect()] == [("a", 1), ("b", 1)]
    got = {r["id"]: r for r in st.apply_notes(df, spark.createDataFrame([("a", True), ("b", False)], "id string, yu boolean")).collect()}
    assert got["a"]["skk_key"] == "たゆう" and got["a"]["modern"] == "たゆう" and len(got["a"]["fixes"]) == 1 and got["b"]["skk_key"] == "たいふ"


def test_strata(spark):
    df = clean(spark, {}, {"id": "b", "method": "align", "ndl": None}, {"id": "c", "method": "align", "fixes": [("reading", "a", "b", st.VOTED)]}, {"id": "d", "status": "unverified", "ndl": None})
    got = {(r["stratum"], r["id"]) for r in st.in_strata(df, st.strata(F.col("id") == "a")).collect()}
    assert got == {("all", "a"), ("all", "b"), ("all", "c"), ("L", "a"), ("align-other", "b"), ("align-ndl-agree", "c"), ("voted", "c"), ("unverified", "d"), ("noL", "a")}


@pytest.mark.parametrize(("consensus", "sources", "want"), [("あいう", ["かい-う", "あ-いう"], "あ-いう"), ("あいう", ["か-いう"], "あ-いう"), ("あいう", ["かい-うえ"], "あいう")])
def test_separators(spark, consensus, sources, want):
    df = spark.createDataFrame([(consensus, sources)], "c string, s array<string>")
    assert df.select(st.with_separators(F.col("c"), F.col("s")).alias("x")).first()["x"] == want


def test_same_notation(spark):
    df = spark.createDataFrame([("銳國", "鋭国"), ("銳", "鋭国"), ("足", "手")], "a string, b string")
    got = [r["x"] for r in df.select(st.same_notation(F.col("a"), F.col("b"), {"銳": "鋭", "鋭": "銳"}, {"國": "国"}).alias("x")).collect()]
    assert got == [True, False, False]


@pytest.fixture(scope="module")
def lex(spark):
    base = [("nasi", "かんのん", "観音"), ("nasi", "ちゅう", "中"), ("nasi", "あしば", "足場"), ("nasi", "がくこう", "學校"), ("nasi", "しんのう", "親王")]
    return rs.Lexicons(spark.createDataFrame(base, "section string, key string, word string"), None, {}, READINGS)


def test_liaison(spark, lex):
    df = spark.createDataFrame([("a", "観音堂", "かんおんどう"), ("b", "馬頭観音", "ばとうかんおん"), ("c", "四親王家", "よんしんおうけ"), ("d", "足場", "あしば")], "id string, notation string, modern string")
    got = {r["id"]: r["modern"] for r in st.with_liaison(df, lex).collect()}
    assert got == {"a": "かんのんどう", "b": "ばとうかんのん", "c": "よんしんのうけ", "d": "あしば"}


def test_ra_to_u(spark, lex):
    df = spark.createDataFrame([("a", "ちゅら", "中", "noun", None, True), ("b", "がくこら", "學校", "noun", None, True), ("c", "あしら", "足場", "noun", None, True)], "id string, reading string, notation string, category string, conjugation string, kango boolean")
    assert {r["id"]: r["skk_key"] for r in st.fix_ra(df, lex).collect()} == {"b": "がくこう"}


def test_voicing(spark, lex):
    kind = "id string, reading string, notation string, category string, conjugation string, kango boolean, method string, sources array<string>"
    rows = [("a", "あし-は", "足場", "noun", None, False, "align", ["あしば", "あしは"]), ("b", "かし", "足", "noun", None, False, "align", ["がし"]), ("c", "あしば", "足場", "noun", None, False, "align", ["あしは"]), ("d", "かし", "足", "noun", None, False, "L", ["がし"]), ("e", "あしば", "足場", "noun", None, False, "align", ["あしば"])]
    got = {r["id"]: (r["verdict"], r["reading"], r["method"]) for r in st.resolve_voicing(spark.createDataFrame(rows, kind), lex).collect()}
    assert got == {"a": ("fixed", "あし-ば", "L"), "b": ("voicing-ambiguous", None, None)}


def test_dzi_and_doubled(spark, lex):
    readings = READINGS | {"血": (["けつ"], ["ち"]), "鼻": (["び"], ["はな"]), "地": (["じ", "ち"], [])}
    df = spark.createDataFrame([(["鼻血"], "はなぢ"), (["地"], "ぢ"), (["鼻"], "はなづ")], "s array<string>, k string")
    assert [tuple(r["x"]) for r in df.select(st.dzi_udf(readings)("s", "k").alias("x")).collect()][:2] == [(True, "はなぢ"), (True, "じ")]
    e = spark.createDataFrame([("a", "足場足場", "あしば"), ("b", "足場", "あしば"), ("c", "足場場足", "あしば")], "id string, notation string, key string")
    assert [tuple(r) for r in st.split_doubled(e, lex).collect()] == [("a", "足場", "足場")]


def test_transcriptions():
    assert transcriptions("きやう") == ["キャゥ"] and transcriptions("せう") == ["ショゥ"] and transcriptions("くわん-せん") == ["クヮンセン"]
    assert "ヲゥミネ" in transcriptions("おほ-みね") and "フミカエス" in transcriptions("ふみ-かへす", verb=True) and "ブっザイセ" in transcriptions("ぶつ-ざい-せ", kango=True)
    assert transcriptions("あし") == ["アシ"] and transcriptions("かふ", verb=True) == ["カウ"] and transcriptions("いう") == ["ユゥ"]


def test_loose_keys(spark):
    key = lambda s: spark.createDataFrame([(s,)], "s string").select(lexicons.loose_key(F.col("s")).alias("k")).first()["k"]
    assert key("キャゥ") == key("キョゥ") and key("ヂシャ") == key("ジシャ") and key("ガン") == key("カン") and key("アクダゥ") != key("アクダラ")


def test_word_list(spark, lex):
    lines = spark.createDataFrame([("p", i, x) for i, x in enumerate(["整理番号\tid\tx\ty", "1\ta\tFafa.|,faua.\tハハ.|,ハワ", "2\tb\tNaraxi\tナラシ,ス,イタ", "3\tc\tAxiba\tアシバ"])], "path string, line_no int, line string")
    keys = lexicons.missionary_keys(lines)
    e = spark.createDataFrame([("a", "はは", False, False), ("b", "ならす", False, True), ("c", "つき", False, False)], "id string, reading string, kango boolean, verb boolean")
    assert ids(st.in_word_list(e, keys)) == ["a", "b"]
    kind = "id string, reading string, notation string, category string, conjugation string, kango boolean"
    r = spark.createDataFrame([("a", "のしば", "足場", "noun", None, False), ("b", "あしば", "足場", "noun", None, False), ("c", "のしば", "明", "noun", None, False)], kind)
    assert [(x["id"], x["skk_key"]) for x in st.repair_by_word_list(r, keys, lex).collect()] == [("a", "あしば")]


def test_fallback(spark):
    e = spark.createDataFrame([("a", "おもふ", False, "verb"), ("b", "かは", False, "noun"), ("c", "-", False, "noun")], "id string, reading string, kango boolean, category string")
    got = {r["id"]: (r["status"], r["skk_key"], r["reason"]) for r in st.fallback(e).collect()}
    assert got == {"a": ("unverified", "おもw" if kana._OKURI["う"][0] == "w" else "おもu", None), "b": ("unverified", "かわ", None), "c": ("excluded", None, "no-skk-key")}
