import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from stratawork.functions.times import instant_from_utc, utc_from_instant
from stratawork.streaming import jobs

SCHEMA = "id int, key string, ts timestamp, amount double"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def land(spark, folder, data):
    """One file per call, as a source system would deliver it."""
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    time.sleep(0.05)


@pytest.fixture
def drop(tmp_path):
    return tmp_path / "in"


def test_append_restart_adds_only_new_files(spark, drop, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        jobs.append_files(jobs.new_files(spark, str(drop), SCHEMA), out, checkpoint).awaitTermination()
        return spark.read.parquet(out).count()

    land(spark, drop, [(1, "a", at(1), 1.0), (2, "b", at(1), 2.0)])
    assert run() == 2
    assert run() == 2
    land(spark, drop, [(3, "a", at(2), 3.0)])
    assert run() == 3


def test_append_mode_drops_rows_behind_the_watermark(spark, drop, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = jobs.new_files(spark, str(drop), SCHEMA)
        windows = jobs.tumbling(stream, "ts", ["key"], "amount", width="1 day", lateness="1 day")
        jobs.append_files(windows, out, checkpoint).awaitTermination()

    land(spark, drop, [(1, "a", at(1, 5), 1.0), (2, "a", at(10, 5), 2.0)])
    run()
    land(spark, drop, [(3, "a", at(1, 6), 100.0), (4, "a", at(20, 5), 4.0)])
    run()
    run()
    got = {r["window_start"]: (float(r["revenue"]), r["events"]) for r in spark.read.parquet(out).collect()}
    assert got == {at(1): (1.0, 1), at(10): (2.0, 1)}


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_running_state(spark, drop, tmp_path, mode):
    land(spark, drop, [(1, "a", at(1), 1.0), (2, "b", at(1), 2.0)])
    seen = []

    def keep(batch, batch_id):
        seen.append({r["key"]: float(r["lifetime_value"]) for r in batch.collect()})

    def run():
        state = jobs.running_state(jobs.new_files(spark, str(drop), SCHEMA), "key", "amount")
        jobs.each_batch(state, keep, str(tmp_path / "cp"), mode).awaitTermination()

    run()
    land(spark, drop, [(3, "a", at(2), 5.0)])
    run()
    assert seen[0] == {"a": 1.0, "b": 2.0}
    assert seen[-1] == ({"a": 6.0, "b": 2.0} if mode == "complete" else {"a": 6.0})


def test_upsert_log_survives_replay(spark, tmp_path, drop):
    stream_schema = spark.createDataFrame([], SCHEMA).schema
    log = jobs.UpsertLog(spark, str(tmp_path / "log"), stream_schema, ["key"], ["ts"])
    one = spark.createDataFrame([(1, "a", at(1), 1.0), (2, "a", at(3), 2.0), (3, "b", at(1), 3.0)], SCHEMA)
    two = spark.createDataFrame([(4, "a", at(2), 4.0)], SCHEMA)
    log(one, 0)
    log(two, 1)
    before = sorted(tuple(r) for r in log.read().collect())
    log(two, 1)
    log(one, 0)
    assert sorted(tuple(r) for r in log.read().collect()) == before
    # A late older event does not win.
    assert {r[1]: r[0] for r in before} == {"a": 2, "b": 3}
    assert len(stream_schema) == 4


def test_upsert_log_as_sink(spark, drop, tmp_path):
    land(spark, drop, [(1, "a", at(1), 1.0)])
    land(spark, drop, [(2, "a", at(2), 2.0)])
    stream = jobs.new_files(spark, str(drop), SCHEMA, max_files_per_trigger=1)
    log = jobs.UpsertLog(spark, str(tmp_path / "log"), stream.schema, ["key"], ["ts"])
    jobs.each_batch(stream, log, str(tmp_path / "cp"), "append").awaitTermination()
    assert log.read().count() == 1


def test_rate_source(spark, tmp_path):
    stream = jobs.rate_source(spark, rows_per_second=50)
    assert stream.isStreaming
    assert stream.columns == ["transaction_id", "product_id", "customer_id", "amount", "transaction_date"]
    query = stream.writeStream.format("memory").queryName("rates").start()
    try:
        for _ in range(60):
            if spark.table("rates").count():
                break
            time.sleep(0.25)
    finally:
        query.stop()
    got = spark.table("rates")
    assert got.count() > 0
    assert got.filter((F.col("transaction_id") < 3000) | ~F.col("product_id").between(101, 103)).count() == 0


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_naive_times_keep_their_utc_meaning(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-01-15 00:00:00' AS t")
        row = df.select(
            F.unix_timestamp(instant_from_utc("t")).alias("s"), utc_from_instant(instant_from_utc("t")).alias("back")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert row["s"] == 1705276800
    assert row["back"] == dt.datetime(2024, 1, 15)
