import re

from lexweave.llm import licenses
from tests.llm.cases import documents, frame

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def base(t):
    w = WORD.findall(lower(t))
    hits = [(k, label) for phrase, label in licenses.BASE for p in [phrase.split()] for k in range(len(w)) if w[k : k + len(p)] == p]
    places = [k for k, _ in hits]
    return len(w), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits}))


EXTRA = [
    "Licensed under CC BY-NC 4.0.", "cc by cc by", "cc BY!! General Public, License all rights reserved", "all rights all rights reserved reserved", "general public public license", "ccby cc", "Kelvin cc by",
    "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software and its associated documentation files", "x " * 50 + "released under the MIT license " + "y " * 9 + "Released under the MIT License",
]


def test_base_against_brute_force(spark):
    rows = documents() + [(900 + i, t, None, None, 0, 0, 0, "", "", "", 0) for i, t in enumerate(EXTRA)]
    got = licenses.scan(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_base"], str(r["first_word"]), str(r["last_word"]), r["base_labels"]) for r in got) == sorted((str(d), n, b, str(f), str(z), ls) for d, t, *_ in rows for n, b, f, z, ls in [base(t)])
    assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} for r in got)
    by = {r["doc_id"]: r for r in got if (r["doc_id"] or 0) >= 900}
    assert by[900]["labels"] == "cc-by,cc-by-nc-4.0" and by[907]["labels"] == "mit" and 0.6 < by[907]["score"] < 1
    assert by[908]["labels"] == "mit" and by[908]["score"] == 1 and by[904]["labels"] == ""


def test_empty(spark):
    assert licenses.scan(frame(spark, [])).collect() == []
