import os

from lexweave import storage


def test_written_tables_are_read_back_and_cleared(spark):
    df = spark.range(10).selectExpr("id", "cast(null as string) as s")
    out = storage.materialize(df, "t")
    assert out.dtypes == df.dtypes and out.count() == 10
    path = storage._WRITTEN[-1][0]
    assert path.startswith(storage.shared_dir(spark)) and os.path.isdir(path.removeprefix("file:"))
    assert storage.clear(spark) >= 1 and not os.path.exists(path.removeprefix("file:")) and storage.clear(spark) == 0
    assert storage.materialize(spark.createDataFrame([], "a int"), "t").count() == 0
