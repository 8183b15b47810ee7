from lexweave.functions import align
from lexweave.operators import lexicon as lx
from lexweave.plans.fixtures import READINGS
from lexweave.sources import files, lexicons, pages

BASE = ''';; okuri-ari entries.
ながm /眺;見る/詠/
;; okuri-nasi entries.
かわぎし /川岸/
しんらい /信頼/新来;来る/(concat "x\\057y")/[別]/
かわぎし /河岸/
'''


def lines(spark, text):
    return spark.createDataFrame([("p", i, x) for i, x in enumerate(text.split("\n"))], "path string, line_no int, line string")


def test_base_lexicon(spark):
    x = lexicons.base_lexicon(lines(spark, BASE))
    got = sorted((r["section"], r["key"], r["ord"], r["word"]) for r in x.collect())
    assert got == [("ari", "ながm", 0, "眺"), ("ari", "ながm", 1, "詠"), ("nasi", "かわぎし", 0, "川岸"), ("nasi", "かわぎし", 0, "河岸"), ("nasi", "しんらい", 0, "信頼"), ("nasi", "しんらい", 1, "新来")]
    assert {r["word"] for r in lexicons.last_lines(x).where("key = 'かわぎし'").collect()} == {"河岸"}


def test_lines_in_another_encoding(spark, tmp_path):
    (tmp_path / "l.txt").write_bytes(BASE.encode("euc_jp"))
    got = [r["line"] for r in files.numbered_lines(spark, f"{tmp_path}/l.txt", "euc_jp").orderBy("line_no").collect()]
    assert got == BASE.split("\n")
    assert files.numbered_lines(spark, f"{tmp_path}/none").count() == 0
    assert files.tsv(spark, f"{tmp_path}/none.tsv", "a string").count() == 0


def test_characters(spark):
    text = "U+570B\tkJapanese\tコク くに\nU+570B\tkJapaneseNewVariant\tU+56FD\nU+5354\tkSemanticVariant\tU+53F6<kX U+5354\n# x"
    f = lexicons.character_fields(lines(spark, text))
    assert {tuple(r) for r in lexicons.character_variants(f).collect()} == {("國", "国", "variant"), ("国", "國", "variant"), ("協", "叶", "semantic"), ("叶", "協", "semantic")}
    assert [tuple(r) for r in lexicons.new_forms(f).collect()] == [("國", "国")]
    assert sorted((r["kind"], r["reading"]) for r in lexicons.character_readings(f).collect()) == [("kun", "くに"), ("on", "こく")]


def test_xml_dictionaries(spark, tmp_path):
    xml = "<JMdict><entry><k_ele><keb>足場</keb></k_ele><k_ele><keb>足庭</keb></k_ele><r_ele><reb>あしば</reb></r_ele><r_ele><reb>あしにわ</reb><re_restr>足庭</re_restr><re_inf>&ok;</re_inf></r_ele><r_ele><reb>アシバ</reb><re_nokanji/></r_ele><sense><pos>&n;</pos></sense></entry>\n<entry><r_ele><reb>ああ</reb></r_ele></entry></JMdict>"
    (tmp_path / "d.xml").write_text(xml)
    x = lexicons.dictionary_forms(files.elements(spark, f"{tmp_path}/d.xml", "</entry>")).collect()
    assert sorted((r["skeleton"], r["kanji"], r["reading"], r["old"], r["pos"]) for r in x) == [("足場", "足場", "あしば", False, ["n"]), ("足庭", "足庭", "あしにわ", True, ["n"]), ("足庭", "足庭", "あしば", False, ["n"])]
    chars = '<kanjidic2><character><literal>生</literal><reading r_type="ja_on">セイ</reading><reading r_type="ja_kun">い.きる</reading><reading r_type="ja_kun">-う</reading><reading r_type="pinyin">sheng</reading><nanori>いく</nanori></character></kanjidic2>'
    (tmp_path / "k.xml").write_text(chars)
    y = lexicons.character_dictionary(files.elements(spark, f"{tmp_path}/k.xml", "</character>")).collect()
    assert sorted(map(tuple, y)) == [("生", "kun", "いきる"), ("生", "nanori", "いく"), ("生", "on", "せい")]


def test_open_dictionary(spark, tmp_path):
    rows = [
        '{"word":"蝶々","pos":"noun","forms":[{"form":"蝶々","tags":["canonical"],"ruby":[["蝶","ちょう"],["々","ちょう"]]},{"form":"てふてふ","tags":["hiragana","historical"]},{"form":"蝶蝶","tags":["alternative","kanji"]}]}',
        '{"word":"粗粗し","pos":"adj","forms":[{"form":"粗粗し","tags":["canonical"],"ruby":[["粗","あら"],["粗","あら"]]}]}',
        '{"word":"山","pos":"name"}',
        '{"word":"見る","pos":"verb","head_templates":[{"args":{"type":"2"}}],"forms":[{"form":"見る","tags":["canonical"],"ruby":[["見","み"]]},{"form":"不見","tags":["canonical"],"ruby":[["見","み"]]}]}',
    ]
    (tmp_path / "w.jsonl").write_text("\n".join(rows))
    x = lexicons.open_dictionary(files.json_lines(spark, f"{tmp_path}/w.jsonl", lexicons.WIKTIONARY)).collect()
    got = sorted((r["skeleton"], r["kanji"], r["reading"], r["old"], r["pos"][0]) for r in x)
    assert ("蝶蝶", "蝶蝶", "ちょうちょう", False, "n") in got and ("蝶蝶", "蝶蝶", "てふてふ", True, "n") in got
    assert ("見", "見る", "みる", False, "v1") in got and not any(g[0] in ("粗粗", "山") for g in got) and len(got) == 5


def test_missionary_keys(spark):
    x = lexicons.missionary_keys(lines(spark, "整理番号\tid\t見出し\t片仮名\n1\ta\tx\tナラシ,ス,イタ|カゥ\n2\tb\ty\tヅ ヂ"))
    assert {r["key"] for r in x.collect()} == {"ナラシ", "ナラス", "コゥ", "スシ"}


def test_layout_xml(spark):
    xml = """<OCRDATASET><PAGE IMAGENAME="R0000007.jpg" WIDTH="900" HEIGHT="600"><TEXTBLOCK>
    <LINE X="700" Y="20" WIDTH="12" HEIGHT="300" CONF="0.5" ORDER="1" STRING="かは-ぎし川岸(名)川の岸" />
    <LINE X="720" Y="22" WIDTH="14" HEIGHT="150" CONF="0.75" ORDER="0" STRING="&quot;岸&quot; &amp;&#12288;川&#x304E;し" /></TEXTBLOCK></PAGE>
    <PAGE IMAGENAME="x.jpg"><LINE X="1" STRING="a"/><LINE X="2" ORDER="0" STRING="b"/></PAGE></OCRDATASET>"""
    x = pages.layout_lines(spark.createDataFrame([("v", xml)], "pid string, xml string")).orderBy("image_name", "line_idx").collect()
    assert [(r["frame"], r["page_width"], r["x"], r["conf"], r["text"]) for r in x] == [(7, 900, 720, 0.75, '"岸" &　川ぎし'), (7, 900, 700, 0.5, "かは-ぎし川岸(名)川の岸"), (None, None, 1, None, "a"), (None, None, 2, None, "b")]


def test_json_pages(spark):
    m = '{"sequences":[{"canvases":[{"width":10,"height":20,"images":[{"resource":{"@id":"u1"}}]},{"width":11,"height":21,"images":[]}]}]}'
    c = pages.canvases(spark.createDataFrame([("v", m)], "pid string, json string"))
    assert [tuple(r) for r in c.orderBy("frame").collect()] == [("v", 1, 10, 20, "u1"), ("v", 2, 11, 21, None)]
    t = spark.createDataFrame([("v", 1, '[{"contenttext":"あ","xmin":1,"ymin":2,"xmax":4,"ymax":8}]'), ("v", 9, "")], "pid string, page int, coordjson string")
    got = pages.full_text_lines(t, c).orderBy("frame").collect()
    assert (got[0]["width"], got[0]["height"], got[0]["page_width"]) == (3, 6, 10) and got[1]["text"] is None and got[1]["page_width"] is None


def test_page_ranges(spark):
    x = spark.range(1, 10).withColumnRenamed("id", "frame")
    assert [r["frame"] for r in x.where(files.page_ranges("2-3,7")).collect()] == [2, 3, 7]
    assert x.where(files.page_ranges("")).count() == 9


def test_statistics_and_anomalies(spark):
    lexicon = spark.createDataFrame([("nasi", r, w) for w, r in (("足留", "あしどめ"), ("場留", "ばどめ"), ("足場", "あしば"), ("貝柱", "かいばしら"), ("飛出", "とびで"))], "section string, key string, word string")
    stats = lx.reading_stats(lexicon, None, READINGS)
    rows = {(r["ch"], r["base"], r["context"]): (r["plain"], r["voiced"], r["semi"]) for r in stats.collect()}
    assert rows["留", "とめ", "other"] == (0, 2, 0) and rows["場", "は", "head"] == (0, 1, 0)
    more = stats.unionByName(spark.createDataFrame([("柱", "ちゅう", "head", 0, 4, 0)], "ch string, base string, context string, plain long, voiced long, semi long"))
    e = spark.createDataFrame([("a", "柱", "ちゅう"), ("b", "足場", "あしば")], "id string, notation string, reading string")
    assert [tuple(r) for r in lx.voicing_anomalies(e, more, READINGS).collect()] == [("a", "柱", "ちゅう", "plain")]


def test_learned_readings(spark):
    pairs = [("蒸かす", "ふかす"), ("蒸かし", "ふかし"), ("蒸", "むし"), ("足留", "あしどめ"), ("愛留", "あいぶん"), ("場留", "ばぶん"), ("國留", "くにぶん"), ("留う", "わう"), ("留い", "わい"), ("留え", "わえ"), ("留は", "はは"), ("留ほ", "はほ")]
    got = {(r["ch"], r["reading"]): r["words"] for r in lx.learned_readings(spark.createDataFrame(pairs, "word string, reading string"), READINGS, 2).collect()}
    assert got == {("蒸", "ふ"): 2, ("留", "ぶん"): 3, ("留", "は"): 2}


def test_merged_characters(spark):
    t = "ch string, kind string, reading string"
    own = spark.createDataFrame([("登", "on", "とう"), ("喰", "on", "さん")], t)
    other = spark.createDataFrame([("登", "on", "どう"), ("登", "kun", "のぼる"), ("登", "on", "とう"), ("喰", "kun", "くう"), ("尽", "kun", "づく"), ("尽", "on", "じん"), ("登", "nanori", "のり")], t)
    assert {tuple(r) for r in lx.merge_characters(own, other).collect()} == {("登", "on", "とう"), ("登", "kun", "のぼる"), ("喰", "kun", "くう"), ("尽", "on", "じん")}
    assert ("登", "kun", "のり") in {tuple(r) for r in lx.merge_characters(own, other, names=True).collect()}


def test_parts(spark):
    x = lx.part_words(spark.createDataFrame([("abcd",)], "w string"), "w")
    assert {(r["part"], r["place"]) for r in x.collect()} == {("ab", "head"), ("abc", "head"), ("abcd", "head"), ("abcd", "tail"), ("bcd", "tail"), ("cd", "tail"), ("bc", "mid")}


def test_alignment_options():
    a = align.Aligner(READINGS)
    assert a.segment("貝柱", "かいのはしら") == [("貝", "かい"), ("柱", "はしら")]
    assert a.segment("時々", "ときどき") == [("時", "とき"), ("々", "どき")]
    assert not align.Aligner(READINGS, voicing=False).fits("足留", "あしどめ")
    assert not align.Aligner(READINGS, last_kun=True).fits("愛國", "あいこく") and align.Aligner(READINGS, last_kun=True).fits("愛國", "あいくに")
    assert a.fits("飛", "とぶよ", 1) and not a.fits("飛", "とぶよ", 0)
