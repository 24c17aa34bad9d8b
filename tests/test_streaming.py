from pyspark.sql import functions as F

from statuta.streaming import fold


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = {}

    def keep(batch, _):
        seen.update({r.user_id: (r.status, r.events) for r in batch.collect()})

    q = fold.fold_stream(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state")).foreachBatch(keep).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert seen == {r.user_id: (r.status, r.events) for r in fold.fold_batch(events).collect()}


def test_artifacts(spark):
    parts = spark.createDataFrame([("t", "a", 0, False, "x"), ("t", "a", 1, True, "y"), ("t", "a", 2, False, "z"), ("t", "a", 3, True, "w"), ("t", "b", 0, True, "q")], "task string, artifact string, seq int, append boolean, text string")
    assert {r.artifact: r.content for r in fold.merge_artifacts(parts).orderBy(F.col("artifact")).collect()} == {"a": "zw", "b": "q"}
