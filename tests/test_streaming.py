from pyspark.sql import functions as F

from corpuscle.streaming.resume import pending, run_batches


def test_resumes_without_repeating(spark, tmp_path):
    schema = "window_id string, n int"
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    for rows in ([("a", 1), ("b", 2), ("b", 2)], [("b", 9), ("c", 3)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        run_batches(spark.readStream.schema(schema).parquet(src), "window_id", lambda d: d.withColumn("m", F.col("n") * 2), out, check).awaitTermination(60)
    assert sorted((r.window_id, r.m) for r in spark.read.parquet(out).collect()) == [("a", 2), ("b", 4), ("c", 6)]
    todo = spark.createDataFrame([("a", 1), (None, 2)], schema)
    assert [r.window_id for r in pending(todo, todo.limit(1), "window_id").collect()] == [None]
