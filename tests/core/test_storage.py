from pathlib import Path

from pyspark.sql import functions as F

from ledgerloom import storage


def test_measures_come_with_the_write(spark):
    df, seen = storage.materialize_with(spark.range(100), "m", n=F.count("*"), odd=F.count_if(F.col("id") % 2 == 1))
    assert (df.count(), seen) == (100, {"n": 100, "odd": 50})
    empty, seen = storage.materialize_with(spark.range(0), "m", n=F.count("*"))
    assert (empty.count(), seen["n"]) == (0, 0)


def test_clear_deletes_the_tables_of_this_run(spark):
    storage.materialize(spark.range(3), "gone")
    folder = Path(storage.run_dir(spark).removeprefix("file:"))
    assert any(folder.glob("gone-*"))
    storage.clear(spark)
    assert not folder.exists()
    assert storage.materialize(spark.range(3), "again").count() == 3
