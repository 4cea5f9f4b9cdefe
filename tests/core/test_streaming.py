import datetime as dt

from ledgerloom.streaming import upserts


def write(spark, folder, name, rows):
    spark.createDataFrame(rows, "k string, v long, at timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def test_upsert_stream(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    t = dt.datetime(2024, 1, 1)

    def run():
        stream = spark.readStream.schema("k string, v long, at timestamp").option("recursiveFileLookup", "true").parquet(src)
        q = stream.writeStream.foreachBatch(upserts.upsert_sink(spark, out, ["k"], "v")).option("checkpointLocation", state).trigger(availableNow=True).start()
        q.awaitTermination()
        return sorted((r.k, r.v) for r in upserts.read_upserted(spark, out).collect())

    write(spark, src, "a", [("x", 1, t), ("x", 3, t), ("y", 5, t)])
    assert run() == [("x", 3), ("y", 5)]
    write(spark, src, "b", [("x", 2, t), ("y", 6, t), ("z", None, t)])
    assert run() == [("x", 3), ("y", 6), ("z", None)]
    # a batch that comes again changes nothing
    upserts.upsert_sink(spark, out, ["k"], "v")(spark.createDataFrame([("x", 99, t)], "k string, v long, at timestamp"), 0)
    assert sorted((r.k, r.v) for r in upserts.read_upserted(spark, out).collect()) == [("x", 3), ("y", 6), ("z", None)]


def test_windows_and_first_deliveries(spark, tmp_path):
    src = str(tmp_path / "src")
    t = dt.datetime(2024, 1, 1)
    write(spark, src, "a", [("x", 1, t), ("x", 2, t + dt.timedelta(minutes=1)), ("y", 3, t + dt.timedelta(minutes=12))])
    stream = spark.readStream.schema("k string, v long, at timestamp").option("recursiveFileLookup", "true").parquet(src)
    q = upserts.first_deliveries(stream, "k", "at", "1 hour").writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.k for r in spark.table("firsts").collect()) == ["x", "y"]
    q = upserts.windowed_counts(stream, "at", ["k"], "10 minutes", "1 hour").writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.k, r.n) for r in spark.table("counts").collect()) == [("x", 2), ("y", 1)]


def test_a_batch_rewrites_the_parts_it_touches(spark, tmp_path):
    out, t = str(tmp_path / "out"), dt.datetime(2024, 1, 1)
    sink = upserts.upsert_sink(spark, out, ["k"], "v", parts=8)
    want = {}
    for epoch in range(6):
        rows = [(f"k{i}", epoch, t) for i in (range(200) if epoch == 0 else [epoch, 100 + epoch])] + [(None, epoch, t)]
        sink(spark.createDataFrame(rows, "k string, v long, at timestamp"), epoch)
        want |= {k: v for k, v, _ in rows}
        assert {r.k: r.v for r in upserts.read_upserted(spark, out).collect()} == want
    written = {e: len(list((tmp_path / f"out/b{e}").glob("__part=*"))) for e in (0, 5)}
    assert written[0] >= 1 and 1 <= written[5] <= 3
    # what only old batches name is gone
    assert len(list((tmp_path / "out/_done").glob("0*"))) == upserts.KEPT_BATCHES
