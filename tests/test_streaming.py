from gleaner.streaming.flows import drain, landed, latest_topk, running_topk, stream_dedup, stream_fifo_dedup


def put(spark, path, rows, n):
    spark.createDataFrame(rows, "uri string, content string, score double").coalesce(1).write.mode("append").parquet(f"{path}/in")


def test_running_topk_resumes(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, [("a", "alpha", 7.0), ("b", "beta", 3.0)], 0)
    schema = spark.read.parquet(f"{path}/in").schema
    run = lambda: drain(running_topk(landed(spark, f"{path}/in", schema, 1), f"{path}/state", f"{path}/cp", "score", 2), lambda: latest_topk(spark, f"{path}/state"))
    assert sorted(r.score for r in run().collect()) == [3.0, 7.0]
    put(spark, path, [("c", "gamma", 8.0), ("d", "delta", 1.5)], 1)
    assert sorted(r.score for r in run().collect()) == [1.5, 3.0]
    put(spark, path, [("e", "epsilon", 2.0)], 2)
    assert sorted(r.score for r in run().collect()) == [1.5, 2.0]
    # Only the folder of the last batch, and the one it was made from, are kept.
    assert sorted(x.name for x in (tmp_path / "state").iterdir()) == ["batch=1", "batch=2"]


def test_stream_dedups(spark, tmp_path):
    path = str(tmp_path)
    put(spark, path, [("a", "alpha", 0.9), ("b", "alpha", 0.4), ("c", "gamma", 0.4)], 0)
    schema = spark.read.parquet(f"{path}/in").schema
    for i, flow in enumerate((stream_dedup, lambda s: stream_fifo_dedup(s, 10, lanes=2))):
        flow(landed(spark, f"{path}/in", schema)).writeStream.format("memory").queryName(f"out{i}").outputMode("append").option("checkpointLocation", f"{path}/cp{i}").trigger(availableNow=True).start().awaitTermination()
        assert sorted(r.content for r in spark.table(f"out{i}").collect()) == ["alpha", "gamma"]
