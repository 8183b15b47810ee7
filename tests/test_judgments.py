import json

from lexweave.sources import files
from lexweave.sources import judgments as js

HEAD = "no\tid\tskk_key\tnotation\treading\tmethod\tjudgment\tnote\n"


def test_judged_tables(spark, tmp_path):
    for label, rows in (("v1", "1\ta\tk\tn・m\tr\tL\to\t\n2\tb\tk\tn\tr\tL\tx\tbad\n"), ("v2", "1\ta\tk\tn・m\tr\tL\tx\tlater\n2\tb\tk\tn\tr\tL\t\t\n")):
        (tmp_path / label).mkdir()
        (tmp_path / label / "verified.tsv").write_text(HEAD + rows)
    x = js.judged(spark, f"{tmp_path}/*/*.tsv")
    assert {(r["label"], r["name"], r["id"]) for r in x.collect()} == {(v, "verified", i) for v in ("v1", "v2") for i in "ab"}
    assert {r["id"]: (r["judgment"], r["note"]) for r in js.known_judgments(x).collect()} == {"a": ("x", "later"), "b": ("x", "bad")}
    assert [tuple(r) for r in js.accepted_judgments(x).collect()] == [("a", "k", "n")]


def test_metas(spark, tmp_path):
    for label, meta in (("v2", {"n": 3, "seeds": [4000000000], "sampled_at": "2025-02"}), ("v1", {"n": 1, "seeds": [], "sampled_at": "2025-01"})):
        (tmp_path / label).mkdir()
        (tmp_path / label / "sample.json").write_text(json.dumps(meta, indent=1))
    assert [(r["label"], r["seeds"]) for r in js.sample_metas(spark, f"{tmp_path}/*/sample.json").collect()] == [("v1", []), ("v2", [4000000000])]
    assert js.sample_metas(spark, f"{tmp_path}/none/*.json").count() == 0


def test_rereadings(spark, tmp_path):
    (tmp_path / "v-001-0001.xml").write_text('<OCRDATASET><PAGE IMAGENAME="x"><LINE X="1" Y="9" STRING="足場(名)"/><LINE X="1" Y="2" STRING="あし-ば"/></PAGE></OCRDATASET>')
    assert [tuple(r) for r in js.rereadings(spark, f"{tmp_path}/*.xml").collect()] == [("v-001-0001", "あし-ば足場(名)", "あし-ば", "足場")]


def test_pairs(spark, tmp_path):
    for name, text in (("a", ";; x\nい /b;n/c/\n"), ("b", "い /c/d/\n")):
        (tmp_path / name).write_text(text)
    a, b = (js.dictionary_pairs(files.numbered_lines(spark, f"{tmp_path}/{n}")) for n in "ab")
    assert {tuple(r) for r in js.changed_pairs(a, b).collect()} == {("added", "い", "d"), ("removed", "い", "b")}
