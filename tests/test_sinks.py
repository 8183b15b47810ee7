from pyspark.sql import functions as F

from lexweave.sources import sinks


def test_euc_jp(spark):
    xs = ["あいう足場", "ASCII /;", "①", "㈱", "é", "𠮷", "鷗", None, ""]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, s string").withColumn("ok", sinks.is_euc_jp("s")).orderBy("i").collect()
    assert [r["ok"] for r in rows] == [True, True, False, False, False, False, False, None, True]
    got = spark.createDataFrame([("足場",)], "s string").select(sinks.to_euc_jp("s").alias("b")).first()["b"]
    assert bytes(got) == "足場".encode("euc_jp")


def test_dictionary_file(spark, tmp_path):
    rows = [("nasi", "い", "a", "", 1), ("nasi", "あ", "b", "ゐ", 2), ("ari", "あk", "d", "", 3), ("ari", "いk", "①", "", 4), ("ari", "いk", "e", "①", 5)]
    entries = spark.createDataFrame(rows, "section string, key string, word string, note string, ord long")
    kept, dropped = sinks.encodable_entries(entries)
    assert dropped.first()["dropped"] == 1
    lines = sinks.dictionary_text(kept, [";; title", ";; more"])
    want = [";; title", ";; more", ";; okuri-ari entries.", "いk /e/", "あk /d/", ";; okuri-nasi entries.", "あ /b;ゐ/", "い /a/"]
    assert [r["line"] for r in lines.collect()] == want
    sinks.write_text(lines, f"{tmp_path}/d")
    assert next(tmp_path.glob("d/part*")).read_text().split("\n")[:-1] == want


def test_report_and_tsv(spark):
    kind = "id string, status string, method string, skk_key string, modern string, reading string, notation string, shinjitai string, pos struct<raw:string,category:string>, `order` string, reason string, source struct<reading:string,notation:string,line:string>, fixes array<struct<field:string,from:string,to:string,reason:string>>, pid string, frame int, bbox struct<x:int,y:int,width:int,height:int>"
    row = lambda i, s, r, fixes: (i, s, "L", "k", "m", "r", None, None, ("名", "noun"), "ok", r, ("a\tb", None, "l\nm"), fixes, "v", 4, (5, 20, 10, 900))
    clean = spark.createDataFrame([row("1", "accepted", None, [("reading", "a", "b", "x")]), row("2", "accepted", None, [("reading", "a", "b", "x"), ("notation", "c", "d", "y")]), row("3", "unverified", None, None), row("4", "excluded", "bad", [])], kind)
    got = {(r["table"], r["value"]): (r["n"], r["share"]) for r in sinks.report(clean).collect()}
    assert got["status", "accepted"] == (2, 0.5) and got["method", "L"] == (2, 0.5) and got["unverified", "-"] == (1, 0.25) and got["excluded", "bad"] == (1, 0.25) and got["fix", "reading: x"] == (2, 0.5)
    cells = sinks.tsv_rows(clean, sinks.crop_url("u", F.col("pid"), F.col("frame"), F.col("bbox"))).where("id = '2'").first()
    assert cells["source_reading"] == "a b" and cells["line"] == "l m" and cells["notation"] == "" and cells["fixes"] == "reading:a→b(x); notation:c→d(y)" and cells["crop"] == "u/v/R0000004/0,0,50,440/full/0/default.jpg"


def test_sections(spark):
    old = spark.createDataFrame([("v1", "a"), ("v2", "b")], "label string, body string")
    new = spark.createDataFrame([("v2", "c")], "label string, body string")
    assert [tuple(r) for r in sinks.upsert_section(old, new).collect()] == [("v2", "c"), ("v1", "a")]
