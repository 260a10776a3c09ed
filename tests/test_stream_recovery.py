"""Logs of batches: replays, compaction by levels, readers before, during and after it."""

import datetime as dt

import pytest

from stratawork.streaming import jobs
from stratawork.workspace import Storage

SCHEMA = "key string, ts int, amount double"


@pytest.fixture
def log(spark, tmp_path):
    shape = spark.createDataFrame([], SCHEMA).schema
    return jobs.UpsertLog(spark, str(tmp_path / "log"), shape, ["key"], ["ts"], fanout=3)


def batch(spark, n):
    """Key k is written by every batch; older times come in later batches, too. Ties go to the later batch."""
    data = [(f"k{k}", (7 * n + 3 * k) % 11, float(n)) for k in range(5)] + [(f"own{n}", 0, float(n)), (None, n, float(n))]
    return spark.createDataFrame(data, SCHEMA)


def expected(spark, upto):
    newest = {}
    for n in range(upto):
        for key, ts, amount in batch(spark, n).collect():
            if key not in newest or ts >= newest[key][0]:
                newest[key] = (ts, amount)
    return sorted(((k, *v) for k, v in newest.items()), key=str)


def test_compaction_by_levels(spark, log):
    for n in range(20):
        log(batch(spark, n), n)
        before = log.read()
        log.compact()
        # a frame from before, and one from after
        assert sorted(rows_of(before), key=str) == expected(spark, n + 1)
        assert sorted(rows_of(log.read()), key=str) == expected(spark, n + 1)
    levels = [(m.level, m.first, m.last) for m in log.live()]
    assert levels == [(2, 0, 8), (2, 9, 17), (0, 18, 18), (0, 19, 19)]
    assert len(log.manifest()) == 2 and log.compact() == 0


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_readers_between_the_write_and_the_swap(spark, log, monkeypatch):
    for n in range(3):
        log(batch(spark, n), n)
    seen = []
    publish = Storage.publish

    def look_first(self, path, text):
        seen.append(sorted(rows_of(log.read()), key=str))
        assert log.manifest() == []
        publish(self, path, text)

    monkeypatch.setattr(Storage, "publish", look_first)
    assert log.compact() == 1
    assert seen == [expected(spark, 3)] and len(log.manifest()) == 1


def test_a_compaction_that_dies_changes_nothing(spark, log, monkeypatch):
    for n in range(3):
        log(batch(spark, n), n)

    def die(self, path, text):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(Storage, "publish", die)
        with pytest.raises(OSError):
            log.compact()
    assert log.manifest() == [] and sorted(rows_of(log.read()), key=str) == expected(spark, 3)
    assert log.compact() == 1
    assert sorted(rows_of(log.read()), key=str) == expected(spark, 3)
    # three batches and the folder that was left behind
    assert log.vacuum() == 4 and log.vacuum() == 0
    assert sorted(rows_of(log.read()), key=str) == expected(spark, 3)


def test_replay_behind_a_compaction(spark, log):
    for n in range(4):
        log(batch(spark, n), n)
    log.compact()
    log(batch(spark, 2), 2)
    log(batch(spark, 3), 3)
    assert sorted(rows_of(log.read()), key=str) == expected(spark, 4)
    log.vacuum()
    assert log.batches() == [3] and sorted(rows_of(log.read()), key=str) == expected(spark, 4)


def test_empty_logs(spark, log, tmp_path):
    assert log.read().collect() == [] and log.compact() == 0 and log.vacuum() == 0
    plain = jobs.BatchLog(spark, str(tmp_path / "none"), log.schema)
    assert plain.read().collect() == [] and plain.batches() == []


def test_batch_that_dies_while_it_writes(spark, tmp_path):
    """A folder without its end mark is no batch; the repeated batch replaces it."""
    log = jobs.BatchLog(spark, str(tmp_path / "log"), spark.createDataFrame([], SCHEMA).schema)
    log(batch(spark, 0), 0)
    log(batch(spark, 1), 1)
    Storage(spark).delete(f"{log.base}/_batch=1/_SUCCESS")
    assert log.batches() == [0] and log.read().count() == 7
    log(batch(spark, 1), 1)
    assert log.batches() == [0, 1] and log.read().count() == 14


def test_recovery_of_a_failed_batch(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    log = jobs.BatchLog(spark, str(tmp_path / "log"), spark.createDataFrame([], SCHEMA).schema)
    calls = []

    def handle(frame, n):
        log(frame, n)
        calls.append(n)
        if calls == [0, 1]:
            raise RuntimeError("before the commit")

    for n in range(4):
        batch(spark, n).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = jobs.new_files(spark, source, SCHEMA, max_files_per_trigger=1)
        jobs.each_batch(stream, handle, checkpoint, "append").awaitTermination()

    with pytest.raises(Exception, match="before the commit"):
        run()
    run()
    assert calls == [0, 1, 1, 2, 3]
    want = sorted((tuple(r) for n in range(4) for r in batch(spark, n).collect()), key=str)
    assert sorted(rows_of(log.read()), key=str) == want


def test_windows_come_out_once_and_closed(spark, tmp_path):
    """Four triggers: open windows wait, late rows count until their window is out, then are dropped."""
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    at = lambda day: dt.datetime(2024, 1, day, 12)
    deliveries = [[(1, 1.0), (2, 2.0)], [(5, 3.0), (1, 10.0)], [(4, 4.0), (9, 5.0), (1, 99.0)], [(20, 6.0), (2, 99.0)]]
    shown = []

    def run(stream):
        windows = jobs.tumbling(stream, "ts", ["key"], "amount", width="1 day", lateness="2 days")
        return jobs.append_files(windows, out, checkpoint)

    for k in range(len(deliveries)):
        parts = [spark.createDataFrame([("a", at(d), x) for d, x in deliveries[k]], "key string, ts timestamp, amount double").repartition(3)]
        folder = str(tmp_path / "in")
        parts[0].write.mode("append").parquet(folder)
        run(jobs.new_files(spark, folder, parts[0].schema)).awaitTermination()
        shown.append(sorted((r.window_start.day, float(r.revenue), r.events) for r in spark.read.schema("window_start timestamp, key string, revenue decimal(38,6), events long").parquet(out).collect()))
    assert shown[0] == []
    assert shown[1] == [(1, 11.0, 2), (2, 2.0, 1)]
    assert shown[2] == [*shown[1], (4, 4.0, 1), (5, 3.0, 1)]
    assert shown[3] == [*shown[2], (9, 5.0, 1)]
