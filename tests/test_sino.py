from lexweave.functions import align
from lexweave.functions.sino import Sino, aligned_with_learned, refuted_udf, sino_udf, without_h_twins

TABLE = {"學": ["がく"], "校": ["かう"], "協": ["けふ"], "和": ["くわ", "わ"], "櫻": ["あう"], "花": ["くわ"], "法": ["ほふ", "はふ"], "立": ["りふ", "りつ"], "奉": ["ほう"], "行": ["かう", "ぎやう"], "觀": ["くわん"], "音": ["おん", "いん"]}


def test_parts():
    s = Sino(TABLE)
    assert s.segment("學校", "がく-かう") == ["がく", "かう"] and s.segment("學校", "がっかう") == ["がっ", "かう"]
    assert s.match("協和", "けふ-わ") == ("きょうわ", "けふ-わ") and s.match("櫻花", "あう-くあ") == ("おうか", "あう-くわ")
    assert s.match("法", "ほふ")[0] == "ほう" and s.segment("立法", "りっぱふ") == ["りっ", "ぱふ"]
    assert s.segment("學校", "あし") is None and s.segment("學び", "がくび") is None
    assert s.segment("奉行", "ほうぎやう") and s.segment("學校", "がくがう") and Sino(TABLE, voicing="none").segment("學校", "がくがう") is None
    assert Sino(TABLE, voicing="nasal").segment("觀校", "くわんがう") and Sino(TABLE, voicing="nasal").segment("學校", "がくがう") is None
    assert s.segment("音々", "おんおん") == ["おん", "おん"]
    assert Sino({}, {"校": ["こう"]}).segment("校", "かう") == ["かう"]


def test_udfs(spark):
    df = spark.createDataFrame([("學校", "がく-かう"), ("學校", "あしば"), (None, "あ"), ("足場", "あしば")], "n string, r string")
    readings = {"足": ([], ["あし"]), "場": ([], ["ば"])}
    got = df.select(sino_udf(Sino(TABLE))("n", "r").alias("m"), refuted_udf(Sino(TABLE), readings)("n", "r").alias("x")).collect()
    assert [r["m"]["modern"] for r in got] == ["がくこう", None, None, None] and [r["x"] for r in got] == [False, True, True, False]


def test_learned_and_twins():
    own, more = {"杉": ([], ["すぎ"]), "原": ([], ["はら"])}, {"杉": ([], ["すぎ"]), "原": ([], ["はら", "わら"])}
    a, b = align.Aligner(own), align.Aligner(more)
    assert not aligned_with_learned("杉原", "すぎわら", "すぎはら", a, b) and aligned_with_learned("杉原", "すぎはら", "すぎはら", a, b) and aligned_with_learned("杉原", "すぎわら", "すぎわら", a, b)
    assert without_h_twins(more)["原"] == ([], ["はら"])
