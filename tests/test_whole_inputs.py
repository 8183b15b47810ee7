"""Queries over whole inputs, on fixtures that a cut of the input would answer otherwise."""

import __spark_entry__ as entry


def write(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def run(spark, name, folder):
    return sorted(map(tuple, entry.queries()[name](spark, folder).collect()), key=str)


def test_keys_tell_texts_with_one_beginning_apart(spark, tmp_path):
    start = "Same words again. " * 20
    sf = write(spark, tmp_path, documents=([(1, start + "One"), (2, start + "two\n2"), (3, "")], "doc_id long, text string"))
    same = ("same words again " * 20).strip()
    assert run(spark, "normalize_text", sf) == [(1, f"{same} one"), (2, f"{same} two"), (3, "")]


def test_forms_beyond_the_first_words_are_looked_up(spark, tmp_path):
    docs = [(1, "a b c d e f known"), (2, "a b\nKnown"), (3, "a b\nc a"), (4, "unknown")]
    sf = write(spark, tmp_path, documents=(docs, "doc_id long, text string"), benchmark=([(1, "so known\nis")], "item_id long, text string"))
    assert run(spark, "added_none_of_forms", sf) == [(3, 3), (4, 1)]


def test_anomalies_of_odd_users_count(spark, tmp_path):
    events = [(10 * u + k, u, "view" if k < 2 else "buy") for u in (1, 2) for k in range(3)]
    events += [(30, 3, "click"), (31, 3, "view"), (32, 3, "buy"), (33, 3, "buy"), (50, 5, "view"), (51, 5, "view")]
    sf = write(spark, tmp_path, events=(events, "event_id long, user_id long, event_type string"))
    assert run(spark, "anomaly_zero_count", sf) == [(10,), (11,), (20,), (21,)]


def test_a_common_first_line_is_not_a_known_text(spark, tmp_path):
    docs = [(1, "Title\nown words", "en"), (2, "TITLE!\nbenchmark words", "en"), (3, "Title", "en"), (4, "7\nwords", "en"), (5, "...", "en"), (7, "Other", "fr")]
    sf = write(spark, tmp_path, documents=(docs, "doc_id long, text string, lang string"), benchmark=([(1, "Title\nbenchmark words")], "item_id long, text string"))
    assert run(spark, "nol_anti_join", sf) == [("en", "accepted", 3, 0.6), ("en", "excluded", 1, 0.2), ("fr", "unverified", 1, 0.2)]
