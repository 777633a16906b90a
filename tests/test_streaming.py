from pyspark.sql import functions as F

from lathework.streaming import monitor

ROWS = [("a", n, s) for n, s in enumerate([0, 0, 0, 0, 0, 3, 3, 4, 4, 4, 4, 4, 4])] + [("b", n, None if n == 1 else n) for n in range(4)]


def frame(spark):
    return spark.createDataFrame(ROWS, "run_id string, n int, step bigint").select("run_id", F.timestamp_seconds("n").alias("ts"), "step")


def test_stall_on_the_fifth_unchanged_check(spark):
    got = monitor.stalls(frame(spark)).where("run_id = 'a'").orderBy("ts").collect()
    assert [r["unchanged"] for r in got] == [1, 2, 3, 4, 5, 0, 1, 0, 1, 2, 3, 4, 5]
    assert [r["stalled"] for r in got].count(True) == 2


def test_hangs_keep_the_high_water_mark(spark):
    rows = spark.createDataFrame([("a", n, c) for n, c in enumerate([0, 1, 1, 3, 2, 3])], "run_id string, n int, hangs bigint").select("run_id", F.timestamp_seconds("n").alias("ts"), "hangs")
    assert [r["alarm"] for r in monitor.hangs(rows).orderBy("ts").collect()] == [False, True, False, True, False, False]


def test_stream_equals_batch(spark, tmp_path):
    frame(spark).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(monitor.PROGRESS).parquet(str(tmp_path / "in"))
    query = monitor.stream_stalls(stream).writeStream.format("memory").queryName("stalls").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = sorted(map(tuple, spark.table("stalls").collect()))
    assert got == sorted(map(tuple, monitor.stalls(frame(spark)).collect()))


def test_recovery_and_progress(spark):
    rows = spark.createDataFrame([("a", n) for n in range(6)], "run_id string, n int").select("run_id", F.timestamp_seconds("n").alias("ts"))
    got = monitor.recovery(rows).orderBy("ts").collect()
    assert [r["level"] for r in got] == [0, 1, 2, 3, 3, 3] and [r["give_up"] for r in got].count(True) == 2
    one = monitor.latest_progress(frame(spark), 8).where("run_id = 'a'").first()
    assert (one["step"], one["percent"], one["remaining"], one["eta_seconds"]) == (4, 50.0, 4, 60.0)
