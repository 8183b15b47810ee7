"""Entries from page to dictionary, on the worked examples of the rules and on cases of our own."""

import math

import pytest
from pyspark.sql import functions as F

from lexweave.functions import kana
from lexweave.functions import text as t
from lexweave.operators import dictionary, layout, order, quality, sampling


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("reading", "want"), [("・あ＝い--う-", "あ-い-う"), ("-", ""), ("あ", "あ"), (None, None)])
def test_normalize_reading(spark, reading, want):
    assert one(spark, reading, kana.normalize_reading) == want


@pytest.mark.parametrize(("raw", "want", "bad"), [("。足場〔", "足場", False), ("足a場", "足a場", True), ("abc", None, True), (None, None, False), ("", None, False), ("足る", "足る", False)])
def test_normalize_notation(spark, raw, want, bad):
    got = one(spark, raw, kana.normalize_notation)
    assert (got["notation"], got["bad"]) == (want, bad)


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("あし 足 (名)", ("あし", "足", False, "名")), ("おもふ思(他動四)", ("おもふ", "思", False, "他動四")), ("ああ(感)", ("ああ", None, False, "感")),
        ("あい〳〵く愛(名)", ("あい-く", "愛", False, "名")), ("あい!きう愛久(名)", ("あい-きう", "愛久", False, "名")),
        ("かん一感(名)", ("かん", "感", True, "名")), ("いち一(名)", ("いち", "一", False, "名")), ("アイ愛(名)", None), ("あい愛(X)", None), ("あい愛", None), ("あい愛(名詞のとてもとても長い)", None),
    ],
)
def test_parse_head(spark, line, want):
    got = one(spark, line, kana.parse_head)
    assert (tuple(got) if got else None) == want


def test_kana_rules(spark):
    assert one(spark, "おどろかす", lambda c: kana.dictionary_forms(c, F.lit("verb"))) == ["おどろかす", "おどろかせる", "おどろかしる", "おどろかする"]
    assert one(spark, "たかし", lambda c: kana.dictionary_forms(c, F.lit("adjective"))) == ["たかし", "たかい", "たかしい"]
    assert one(spark, "あし", lambda c: kana.dictionary_forms(c, F.lit("noun"))) == ["あし"]
    for k, want in (("かす", ["k"]), ("う", ["u", "w"]), ("しい", ["s"]), ("ん", ["n"]), ("x", [])):
        assert one(spark, k, kana.okuri_letters) == want
    assert tuple(one(spark, "たかし", lambda c: kana.adjective_form(c, F.lit("ク")))) == ("たかい", "たかi", ["たか"])
    assert tuple(one(spark, "うらめし", lambda c: kana.adjective_form(c, F.lit("シク")))) == ("うらめしい", "うらめしi", ["うらめし", "うらめ"])
    assert one(spark, "うらめし", lambda c: kana.adjective_form(c, F.lit(None).cast("string"))) is None
    assert one(spark, "がまんづよし", lambda c: kana.adjective_form(c, F.lit(None).cast("string")))["skk_key"] == "がまんづよi"
    for okuri, cat, want in (("る", "verb", True), ("える", "verb", True), ("かす", "verb", False), ("しい", "adjective", True), ("しい", "noun", False)):
        assert one(spark, okuri, lambda c, cat=cat: kana.valid_okuri(c, F.lit(cat))) is want


@pytest.mark.parametrize(
    ("reading", "kango", "first", "also"),
    [
        ("あし-つぎ", False, "あしつぎ", None), ("いふ", False, "いう", None), ("かは", False, "かわ", None), ("をとこ", False, "おとこ", None), ("おほきい", False, "おおきい", None), ("みづ", False, "みず", None),
        ("あし-はら", False, "あしはら", None), ("ちぢむ", False, "ちぢむ", None), ("つづく", False, "つづく", None), ("あふぎ", False, "あうぎ", "おうぎ"), ("あふぐ", False, "あうぐ", "あおぐ"),
        ("あいきゃう", True, "あいきょう", None), ("せうせう", True, "しょうしょう", None), ("かう", True, "こう", None), ("くわん", True, "かん", None), ("じふ", True, "じゅう", None), ("ぢしん", True, "じしん", None),
        ("がくかう", True, "がくこう", "がっこう"), ("りふ", True, "りゅう", "りつ"), ("きよう", True, "きよう", "きょう"), ("しゆう", True, "しゆう", "しゅう"), ("いやう", True, "よう", None), ("へいたいやう", True, "へいたいよう", None), ("じゃう-くわう", True, "じょうこう", None), ("ぐわう", True, "ごう", None),
    ],
)
def test_spelling_variants(reading, kango, first, also):
    got = kana.spelling_variants(reading, kango)
    assert got[0] == first and (also is None or also in got) and len(got) == len(set(got)) <= 48


def test_repairs(spark):
    got = one(spark, "あし-か", kana.repairs)
    assert {"のし-か", "あく-か", "あし-が", "あし-や", "あじ-か", "あ--か"} <= set(got) and "あし-か" not in got and len(got) == len(set(got))


def test_order(spark):
    keys = [("v", i, k) for i, k in enumerate("abcdefxghijkl")] + [("w", 0, "z")]
    df = spark.createDataFrame(keys, "pid string, seq int, key string")
    assert [r["key"] for r in order.outliers(df, ["pid"], ["seq"], "key").where("outlier").collect()] == ["x"]
    b = {r["key"]: (r["lo"], r["hi"]) for r in order.bounds(df, ["pid"], ["seq"], "key").collect()}
    assert b["a"] == ("", "e") and b["z"] == ("", "￿") and b["x"] == ("d", "j")


def test_votes(spark):
    xs = [(["あ-い", "あう", "かい"], "あい"), (["あい"], None), ([], None), (["あ", "いう", "いう"], "いう"), ([None, "あ", "あ"], "あ")]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(xs)], "i int, r array<string>")
    assert [r["v"] for r in df.orderBy("i").select(t.positional_vote(F.col("r")).alias("v")).collect()] == [w for _, w in xs]


def test_second_reader_and_link(spark):
    row = lambda i, s, x, y, w=30, h=100: ("v", 1, 2000, i, s, x, y, w, h, None)
    lines = [row(i, "本文", 1500 - 10 * i, 200) for i in range(6)] + [row(6, "あし", 1800, 170, 40), row(7, "〔足〕", 1805, 275), row(8, "あし", 1700, 170, 20), row(9, "いろ", 1600, 120, 40)]
    df = spark.createDataFrame(lines, "pid string, frame int, page_width int, line_idx int, text string, x int, y int, width int, height int, conf double")
    got = layout.extract_second_reader(df)
    assert [(r["x"], r["reading"], r["notation"]) for r in got.collect()] == [(1800, "あし", "足")]
    c = spark.createDataFrame([("a", "v", 1, (1840, 230, 1, 1)), ("b", "v", 1, (1841, 170, 1, 1)), ("c", "v", 2, (1800, 170, 1, 1))], "id string, pid string, frame int, bbox struct<x:int,y:int,width:int,height:int>")
    linked = {r["id"]: r["ndl"] for r in layout.link_readers(c, got).collect()}
    assert linked["a"]["notation"] == "足" and linked["b"] is None and linked["c"] is None


def test_medians_and_peaks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 5), ("b", None)], "g string, v int")
    assert {r["g"]: r["median"] for r in layout.upper_median_by_counts(df, ["g"], "v").collect()} == {"a": 3, "b": 5}
    bins = spark.createDataFrame([("a", 0, 9), ("a", 10, 8), ("a", 400, 7), ("a", 900, 4)], "g string, v int, n int")
    assert layout.greedy_peaks(bins, ["g"], "v", "n", 5, 300).first()["peaks"] == [0, 400]


def test_accuracy(spark):
    rows = [("d", str(i), "x" if i < 2 else "o") for i in range(450)]
    got = quality.accuracy(spark.createDataFrame(rows, "name string, id string, judgment string")).first()
    assert (got["n"], got["correct"], got["errors"]) == (450, 448, ["0", "1"])
    assert math.isclose(got["low"], 0.984, abs_tol=1e-3) and math.isclose(got["high"], 0.9988, abs_tol=1e-3)
    with pytest.raises(Exception, match="not judged"):
        quality.accuracy(spark.createDataFrame([("d", "7", "")], "name string, id string, judgment string")).collect()
    low, high = t.wilson(F.lit(0), F.lit(0))
    assert tuple(spark.range(1).select(low, high).first()) == (0.0, 1.0)


def test_judgments(spark):
    kind = "id string, skk_key string, notation string, status string, method string, fixes array<struct<field:string,from:string,to:string,reason:string>>"
    clean = spark.createDataFrame([("a", "k", "n", "unverified", "x", None), ("b", "k", "n", "unverified", "x", []), ("c", "k", "n", "excluded", "x", [])], kind)
    got = {r["id"]: r for r in quality.apply_judgments(clean, spark.createDataFrame([("a", "k", "n"), ("c", "k", "n"), ("b", "k", "m")], "id string, skk_key string, notation string")).collect()}
    assert got["a"]["status"] == "accepted" and got["a"]["fixes"][0]["reason"] == "judged" and got["b"]["status"] == "unverified" and got["c"]["status"] == "excluded"
    known = spark.createDataFrame([("a", "k", "n", "o", "1", 1), ("a", "k", "n", "x", "2", 2), ("a", "k", "n", "", "3", 3)], "id string, skk_key string, notation string, judgment string, note string, file_ord int")
    rows = {r["id"]: (r["judgment"], r["note"]) for r in quality.carry_over(clean.select("id", "skk_key", "notation"), known).collect()}
    assert rows == {"a": ("x", "2"), "b": ("", ""), "c": ("", "")}


def test_generator_and_draws():
    u = sampling.uniform(1)
    first = [next(u) for _ in range(3)]
    # worked by hand in 32-bit arithmetic
    state, want = 1, []
    for _ in range(3):
        state = (state + 0x6D2B79F5) % 2**32
        a = (state ^ state >> 15) * (1 | state) % 2**32
        a = a ^ (a + (a ^ a >> 7) * (61 | a) % 2**32) % 2**32
        want.append((a ^ a >> 14) / 2**32)
    assert first == want
    ids = [str(i) for i in range(50)]
    got = sampling.draw_many(ids, 30, [1, 2, 3])
    assert len(set(got)) == 30 and got == sampling.draw_many(ids, 30, [1, 2, 3]) and sorted(sampling.draw(ids, 50, 4)) == sorted(ids)
    whole, part = sampling.draw_nested(ids, ids[:20], 10, [5])
    assert len(part) == 10 and set(part) <= set(ids[:20]) and set(whole) & set(ids[:20]) <= set(part)


def test_seeds(spark):
    metas = spark.createDataFrame([("a", [1, 4000000000]), ("b", [2]), ("c", [])], "label string, seeds array<bigint>")
    assert [tuple(r) for r in sampling.seeds_used_elsewhere(metas, "b", [4000000000, 2]).collect()] == [("a", [4000000000])]


def test_dictionary_order(spark):
    rows = [("nasi", "い", "b", "", "名", 2), ("nasi", "い", "a", "ゐ", "名", 1), ("nasi", "い", "a", "ゐ", "副", 3), ("nasi", "い", "a", "", "", 4), ("nasi", "あ", "c", "", "", 5), ("ari", "あk", "d", "", "", 6), ("ari", "いk", "d", "", "", 7)]
    df = spark.createDataFrame(rows, "section string, key string, word string, historical string, label string, ord long")
    lines = [(r["section"], r["line"]) for r in dictionary.rendered(dictionary.entries(df)).collect()]
    assert lines == [("ari", "いk /d/"), ("ari", "あk /d/"), ("nasi", "あ /c/"), ("nasi", "い /a;ゐ（名・副）/b;（名）/")]


def test_digest(spark):
    import hashlib

    files = [("b", b"2"), ("a", b"1")]
    want = hashlib.sha256("\n".join(hashlib.sha256(c).hexdigest() for _, c in sorted(files)).encode()).hexdigest()[:12]
    assert quality.digest(spark.createDataFrame(files, "path string, content binary")).first()["digest"] == want


def test_digest_by_range(spark):
    import hashlib

    texts = {("a", 0): b"x", ("a", 1): b"", ("a", 3): b"y", ("a", 2): None, ("a", 9): b"x", ("b", 4): None, (None, 5): b"z"}
    sha = lambda xs: hashlib.sha256("\n".join(xs).encode()).hexdigest()
    want = {}
    for g in {g for g, _ in texts}:
        ranges = {}
        for (_, i), c in sorted((k, c) for k, c in texts.items() if k[0] == g and c is not None):
            ranges.setdefault(i // 2, []).append(hashlib.sha256(c).hexdigest())
        want[g] = sha([sha(v) for _, v in sorted(ranges.items())])[:12] if ranges else None
    df = spark.createDataFrame([(c, i, g) for (g, i), c in texts.items()], "content binary, id long, g string")
    assert dict(map(tuple, quality.digest_by_range(df, "g", "id", 2).collect())) == want
    assert quality.digest_by_range(df.limit(0), "g", "id").collect() == []
