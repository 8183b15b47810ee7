"""The pipeline against its stages' brute-force versions, each on its own input."""

from collections import Counter

import corpus_pipeline as cp

from lexweave.llm import quality, sharding
from tests.llm.test_classifiers import corpus
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import brute as joined
from tests.llm.test_mixing import brute_targets


def test_stages(spark, tmp_path):
    docs, labels = corpus()
    docs = [d[:5] for d in docs]
    copies = [(3000 + i, docs[i][1], docs[i][2], "s2", 0) for i in range(40)]
    near = [(4000 + i, docs[i][1] + " Ending", docs[i][2], "s3", 0) for i in range(40)]
    odd = [(6000, None, None, None, None), (6001, "", "en", "s", 0), (None, "no id here", "en", "s", 10)]
    spark.createDataFrame(docs + copies + near + odd, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    long = next(d[1] for d in docs if len(d[1].split()) > 60 and d[1][1:3].islower())
    bench = [(1, " ".join(long.split()[20:40]))]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(cp.STAGES):
        given = rows.collect()
        out = stage(spark, rows, str(tmp_path))
        out.write.parquet(f"{tmp_path}/stage{k}")
        rows = spark.read.parquet(f"{tmp_path}/stage{k}")
        got = rows.collect()
        assert got, name
        if k < len(cp.STAGES) - 1:
            assert tuple(rows.columns) == cp.COLUMNS
        if name == "quality":
            score = quality.score_expr(spark.createDataFrame(given, rows.schema), quality.train(spark.createDataFrame(given, rows.schema), spark.read.parquet(f"{tmp_path}/labels.parquet")))
            assert Counter(map(str, got)) == Counter(str(r) for r in score.where("score >= 0.3").drop("score").collect())
        if name == "near_copies":
            stay = {d for d, _, c in joined([(r["doc_id"], r["text"]) for r in given]) if d is not None and d == c}
            assert Counter(r["doc_id"] for r in got if r["doc_id"] is not None) == Counter(r["doc_id"] for r in given if r["doc_id"] in stay)
            assert not any(3000 <= (r["doc_id"] or 0) < 5000 and r["doc_id"] - (3000 if r["doc_id"] < 4000 else 4000) in stay for r in got if r["source"] == "s2")
        if name == "decontaminate":
            assert any(x[5] for x in contaminated([(r["doc_id"], r["text"]) for r in given], bench))
            assert not any(x[5] for x in contaminated([(r["doc_id"], r["text"]) for r in got], bench))
            assert all(r["n_chars"] == len(r["text"]) for r in got if r["text"] and r["text"] not in {g["text"] for g in given})
        if name == "mix":
            sizes, taken, most = Counter(), Counter(), Counter()
            for r in given:
                sizes[r["source"]] += len((r["text"] or "").split())
                most[r["source"]] = max(most[r["source"]], len((r["text"] or "").split()))
            for r in got:
                taken[r["source"]] += len((r["text"] or "").split())
            for s, t in brute_targets(dict(sizes)).items():
                assert abs(taken[s] - t) <= most[s] + 1
        if name == "shard":
            want = sharding.place(spark.createDataFrame(given, cp_schema(rows)), "doc_id", sharding.even_tree(40)).collect()
            assert Counter(map(str, got)) == Counter(map(str, want))
    assert Counter(map(str, cp.run(spark, str(tmp_path)).collect())) == Counter(map(str, got))


def cp_schema(rows):
    return rows.drop("shard").schema


def _written(spark, path, docs, items):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_few_rows(spark, tmp_path):
    """Blanks, copies with and without an id, and a one-word item, one row a partition."""
    text = " ".join(f"w{k}" for k in range(40))
    docs = [(1, text, "en", "s", 0, "x"), (2, text, "en", "s", 0, "x"), (None, text, None, None, None, None), (3, " ", "en", "s", 1, ""), (4, None, None, "t", None, None), (5, "only hello", "fr", "t", 3, "y"), (6, "hello", "fr", "t", 3, "y")]
    got = cp.run(spark, _written(spark, tmp_path / "few", docs, [(1, "hello")])).collect()
    by = Counter(r["doc_id"] for r in got)
    assert None not in by and 2 not in by and 6 not in by and by[1] >= 1  # copies of 1 go, and a text of nothing but the item
    assert {r["text"].strip() for r in got if r["doc_id"] == 5} <= {"only"}
    assert cp.run(spark, _written(spark, tmp_path / "none", [], [])).collect() == []
