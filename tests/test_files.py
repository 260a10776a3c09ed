"""File audits, the ledger, several sources, the catalog and reuse, against what lies on storage."""

import os
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from stratawork import catalog, workspace
from stratawork.operators import nested
from stratawork.plans import catalogue, flows
from stratawork.plans.views import TABLES
from stratawork.sources import files
from stratawork.sources.ledger import FileLedger


def test_file_sizes_and_rows_are_those_of_storage(spark, sf):
    got = {(r.table_name, r.filename): (r.file_size, r.record_count, r.within_limit) for r in catalogue.QUERIES["file_size_audit"](spark, sf).collect()}
    want = {}
    for name in TABLES:
        top = Path(sf, f"{name}.parquet")
        for path in sorted(top.rglob("*.parquet")) if top.is_dir() else [top]:
            size = os.path.getsize(path)
            want[name, path.name] = (size, pq.ParquetFile(path).metadata.num_rows, size <= 10 * 1024 * 1024)
    assert got == want


def test_files_above_the_limit(spark, tmp_path):
    for n, rows in enumerate((10, 50_000)):
        spark.range(rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    verdicts = {r.record_count: r.within_limit for r in files.file_contents(spark.read.parquet(str(tmp_path / "t")), 0.05).collect()}
    assert verdicts == {10: True, 50_000: False}


def test_partition_profile_is_that_of_the_partitions(spark, sf):
    got = {r.table_name: r.asDict() for r in catalogue.QUERIES["partition_profile"](spark, sf).collect()}
    assert set(got) == set(TABLES)
    for name in TABLES:
        held = [sum(1 for _ in part) for part in spark.read.parquet(f"{sf}/{name}.parquet").rdd.glom().toLocalIterator()]
        sizes = [n for n in held if n]
        row = got[name]
        assert (row["partition_count"], row["total_rows"], row["min_rows"], row["max_rows"]) == (len(sizes), sum(sizes), min(sizes), max(sizes))
        assert row["avg_rows"] == pytest.approx(sum(sizes) / len(sizes))
        assert row["skew_ratio"] == pytest.approx(max(sizes) * len(sizes) / sum(sizes))
        assert row["is_skewed"] == (row["skew_ratio"] > 2)


def deliver(spark, folder, name, ids):
    """One file of ``folder`` holds these ids from now on."""
    draft = workspace.new_folder(spark, "draft")
    spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).write.parquet(draft)
    storage = workspace.Storage(spark)
    [part] = [n for n in storage.names(draft) if n.startswith("part-")]
    storage.move(f"{draft}/{part}", f"{folder}/{name}.parquet", replace=True)


@pytest.fixture
def inbox(spark, tmp_path):
    folder = str(tmp_path / "inbox")
    return folder, FileLedger(spark, folder, str(tmp_path / "ledger"))


def ids(ledger):
    return Counter((r.id, r.load) for r in ledger.rows().collect())


def test_ledger(spark, inbox):
    folder, ledger = inbox
    read = lambda paths: spark.read.schema("id long").parquet(*paths)
    assert ledger.load(read) == 0 and ledger.rows() is None and ledger.pending().count() == 0
    deliver(spark, folder, "a", [1, 2, 2])
    deliver(spark, folder, "sub/b", [3])
    assert ledger.load(read) == 2 and ledger.load(read) == 0
    assert ids(ledger) == {(1, 1): 1, (2, 1): 2, (3, 1): 1}
    deliver(spark, folder, "a", [1, 9, 9, 9])
    deliver(spark, folder, "c", [4])
    assert sorted(r.file_path.rsplit("/")[-1] for r in ledger.pending().collect()) == ["a.parquet", "c.parquet"]
    assert ledger.load(read) == 2
    assert ids(ledger) == {(1, 2): 1, (9, 2): 3, (3, 1): 1, (4, 2): 1}
    assert ledger.known().count() == 4


def test_ledger_takes_a_backlog_in_loads(spark, inbox):
    folder, ledger = inbox
    for k in range(5):
        deliver(spark, folder, f"f{k}", [k])
    read = lambda paths: spark.read.schema("id long").parquet(*paths)
    assert [ledger.load(read, max_files=2) for _ in range(4)] == [2, 2, 1, 0]
    assert sorted(i for i, _ in ids(ledger)) == [0, 1, 2, 3, 4]


def test_ledger_repeats_a_load_that_died(spark, inbox, monkeypatch):
    folder, ledger = inbox
    read = lambda paths: spark.read.schema("id long").parquet(*paths)
    deliver(spark, folder, "a", [1])
    ledger.load(read)
    deliver(spark, folder, "b", [2])
    with monkeypatch.context() as patch:
        # rows are landed, the files are not noted
        patch.setattr(type(spark), "createDataFrame", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            ledger.load(read)
    assert ids(ledger) == {(1, 1): 1}
    assert ledger.load(read) == 1 and ids(ledger) == {(1, 1): 1, (2, 2): 1}


def test_sources_that_fail_are_set_aside(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "good"))
    text = spark.createDataFrame([('{"a":1}',), ('{"a":',)], "t string")
    sources = {
        "good": lambda: spark.read.parquet(str(tmp_path / "good")),
        "gone": lambda: spark.read.parquet(str(tmp_path / "gone")),
        "torn": lambda: nested.parse_json_or_stop(text, "t", "a int"),
        "empty": lambda: spark.range(0),
    }
    discarded = []
    got = catalog.ingest_sources(spark, sources, lambda df, n: df.write.parquet(str(tmp_path / f"raw_{n}")), discarded.append)
    rows = {r.source: (r.status, r.record_count, r.error) for r in got.collect()}
    assert rows == {
        "good": ("LANDED", 4, None),
        "gone": ("FAILED", None, "PATH_NOT_FOUND"),
        "torn": ("FAILED", None, "USER_RAISED_EXCEPTION"),
        "empty": ("LANDED", 0, None),
    }
    assert discarded == ["gone", "torn"]
    assert spark.read.parquet(str(tmp_path / "raw_good")).columns == ["id", "source_system", "ingestion_timestamp"]
    with pytest.raises(ZeroDivisionError):  # no failure of a source
        catalog.ingest_sources(spark, {"x": lambda: 1 / 0}, print)


@pytest.mark.parametrize("bad", ['{"a": "x y"}', '{"a":', "no json [at] all: true", "é 日本"])
def test_the_offending_text_is_shown(spark, bad):
    text = spark.createDataFrame([('{"a":1}',), (bad,), (None,)], "t string")
    with pytest.raises(Exception) as caught:
        nested.parse_json_or_stop(text, "t", "a int").collect()
    assert nested.offending_text(caught.value) == bad
    assert nested.offending_text(ValueError("else")) is None
    fine = nested.parse_json_or_stop(text.filter(F.col("t") != bad), "t", "a int")
    assert [tuple(r) for r in fine.collect()] == [(1,)]


def evaluations(spark, df):
    """``df`` with a step that counts the rows it is asked for."""
    seen = spark.sparkContext.accumulator(0)

    def step(value):
        seen.add(1)
        return value

    return df.withColumn("id", F.udf(step, "long")("id")), seen


@pytest.mark.parametrize(("level", "limit"), [(StorageLevel.MEMORY_AND_DISK, None), (StorageLevel.DISK_ONLY, None), (StorageLevel.MEMORY_ONLY, 100)])
def test_reuse_evaluates_once(spark, level, limit):
    df, seen = evaluations(spark, spark.range(200))
    with workspace.reused(df, level, limit) as held:
        assert held.filter("id < 50").count() == 50 and held.agg(F.sum("id")).first()[0] == 19_900 and held.count() == 200
        assert held.is_cached == (limit is None)
    assert seen.value == 200 and not df.is_cached
    df.count()
    plain, seen = evaluations(spark, spark.range(200))
    for _ in range(2):
        plain.filter("id < 50").count()
    assert seen.value == 400


def test_flows_evaluate_their_input_once(spark):
    raw, seen = evaluations(spark, spark.range(90).withColumn("n", F.col("id") % 3))
    got = flows.quarantine(raw, flows.LayerFolders(spark, "split"), F.col("n") > 0)
    assert Counter(r.route for r in got.collect()) == {"accepted": 60, "quarantined": 30}
    assert seen.value == 90


def test_reuse_lets_go_after_an_error(spark):
    df = spark.range(10)
    with pytest.raises(ValueError), workspace.reused(df):
        raise ValueError
    assert not df.is_cached
