from lexweave import storage
from lexweave.llm import lines
from tests.llm.cases import documents, frame


def test_clear_takes_packed_texts_along(spark):
    storage.clear(spark)
    assert lines.dedup_lines(frame(spark)).count() == len(documents())
    assert any(t for _, t in storage._WRITTEN) and storage.clear(spark) >= 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("lexweave_shards")]
