import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import Row, functions as F, types as T

from stratawork import catalog, workspace
from stratawork.sources import files, jdbc
from stratawork.sources.rows import from_pandas, from_rows


@pytest.fixture(scope="module")
def layers(spark):
    made = catalog.Layers.for_email(spark, "Test-User+1@example.com")
    yield made
    spark.sql(f"DROP SCHEMA {made.get_schema_path()} CASCADE")


def test_rows(spark):
    strict = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("v", T.StringType())])
    assert from_rows(spark, [(1, "a")], strict).schema == strict
    with pytest.raises(Exception, match="NULL|None|nullable"):
        from_rows(spark, [(None, "a")], strict)
    with pytest.raises(Exception):
        from_rows(spark, [("x", "a")], strict)
    assert from_rows(spark, [(1, "a")], ["id", "v"]).columns == ["id", "v"]
    assert from_rows(spark, [{"id": 1}, {"id": 2}]).count() == 2
    assert from_rows(spark, [Row(id=1, v="a")]).first()["v"] == "a"


def test_pandas_by_name(spark):
    frame = pd.DataFrame({"v": ["a", "b"], "id": [1, 2], "extra": [0, 0]})
    df = from_pandas(spark, frame, "id long, v string")
    assert df.columns == ["id", "v"] and df.count() == 2


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,Ann\n2,Bo\n")
    (tmp_path / "b.psv").write_text("id|name\n1|Ann\n2|Bo\n")
    schema = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType())])
    df = files.ingest_csv(spark, str(tmp_path / "a.csv"), schema)
    assert df.count() == 2 and df.first()["name"] == "Ann"
    assert [f.dataType for f in df.schema] == [f.dataType for f in schema]
    assert files.ingest_csv(spark, str(tmp_path / "a.csv")).dtypes == [("id", "string"), ("name", "string")]
    piped = files.ingest_csv(spark, str(tmp_path / "b.psv"), options={"delimiter": "|"})
    assert piped.count() == 2 and "name" in piped.columns


def test_json_lines_and_documents(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"id":1}\n{"id":2}\n')
    (tmp_path / "doc.json").write_text('[\n {"id":1,\n "sub":{"x":1}},\n {"id":2}\n]')
    assert files.ingest_json(spark, str(tmp_path / "lines.json")).count() == 2
    doc = files.ingest_json(spark, str(tmp_path / "doc.json"), "id int, sub struct<x:int>", multiline=True)
    assert sorted((r["id"], r["sub"] and r["sub"]["x"]) for r in doc.collect()) == [(1, 1), (2, None)]


def test_lineage(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n")
    df = files.with_lineage(
        files.ingest_csv(spark, str(tmp_path / "a.csv")), source_file=True, source_system="shop", source_api="api"
    )
    row = df.first()
    assert (row["source_file"], row["source_system"], row["source_api"]) == ("a.csv", "shop", "api")
    assert row["ingestion_timestamp"] is not None
    assert files.with_lineage(df, timestamp=False).columns == df.columns


def test_file_checks(spark, tmp_path):
    (tmp_path / "small.csv").write_text("id\n1\n")
    (tmp_path / "large.csv").write_text("id\n" + "1\n" * 2000)
    assert files.validate_file_size(spark, str(tmp_path / "small.csv"))
    assert not files.validate_file_size(spark, str(tmp_path / "large.csv"), 0.001)
    assert not files.validate_file_size(spark, str(tmp_path / "missing.csv"))
    scan = files.ingest_csv(spark, str(tmp_path))
    manifest = {r["filename"]: r["record_count"] for r in files.file_manifest(scan).collect()}
    assert manifest == {"small.csv": 1, "large.csv": 2000}
    audit = {r["file_path"].rsplit("/")[-1]: r["within_limit"] for r in files.file_size_audit(spark, str(tmp_path), 0.001).collect()}
    assert audit == {"small.csv": True, "large.csv": False}


def test_jdbc_options():
    options = jdbc.read_options("jdbc:x", "t", driver="d", partition_column="id", bounds=(0, 100), partitions=8)
    assert options["numPartitions"] == "8" and options["upperBound"] == "100" and options["driver"] == "d"
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "(select 1) q")
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "t", partition_column="id")


def test_layer_names(spark, layers):
    assert layers.schema == "test_user_1"
    assert layers.get_table_path("Bronze", "sales") == "spark_catalog.test_user_1.bronze_sales"
    with pytest.raises(ValueError, match="copper"):
        layers.get_table_path("copper", "sales")


def test_table_writes(spark, layers, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert layers.write(df, "bronze", "t").count() == 2
    assert layers.write(df, "bronze", "t", mode="append").count() == 4
    # Overwriting replaces the schema.
    assert layers.write(df.withColumn("w", F.lit(1)), "bronze", "t").columns == ["id", "v", "w"]
    parted = layers.write(df, "silver", "t", partition_by=["v"])
    assert parted.count() == 2
    assert "v" in [c.name for c in spark.catalog.listColumns(layers.get_table_path("silver", "t")) if c.isPartition]
    (tmp_path / "c.csv").write_text("id,name\n1,Ann\n")
    got = catalog.ingest_csv_with_schema(layers, str(tmp_path / "c.csv"), "id int, name string", "people")
    assert got.first()["name"] == "Ann"
    counts = {r["table_name"]: r["record_count"] for r in layers.inventory("bronze_").collect()}
    assert counts == {"bronze_t": 2, "bronze_people": 1}
    assert layers.inventory("gold_").count() == 0
    assert catalog.find_tables(spark, "*_t", layers.get_schema_path()) == ["bronze_t", "silver_t"]
    hits = catalog.find_columns(spark, "NAM", layers.get_schema_path())
    assert hits == [("bronze_people", "name", "string")]
    assert catalog.describe(spark, layers.get_table_path("bronze", "t")).filter("col_name = 'w'").count() == 1
    report = catalog.catalog_report(spark)
    assert report["catalog"] == "spark_catalog" and layers.schema in report["schemas"]


def test_ingest_all(spark):
    layers = catalog.Layers(spark, "all_sources")
    layers.create_schema()
    try:
        sources = {"files": spark.range(3), "api": spark.range(2)}
        catalog.ingest_all(layers, sources)
        got = {r["table_name"]: r["record_count"] for r in catalog.ingest_all(layers, sources).collect()}
        assert got == {"bronze_files": 6, "bronze_api": 4}
        assert layers.table("bronze", "api").first()["source_system"] == "api"
        assert catalog.ingest_all(layers, sources, "overwrite").agg(F.sum("record_count")).first()[0] == 5
    finally:
        spark.sql(f"DROP SCHEMA {layers.get_schema_path()} CASCADE")


def test_bucketed_tables_join_without_a_shuffle(spark, layers):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    for name in ("left", "right"):
        catalog.save_table(df, layers.get_table_path("silver", name), bucket_by=(4, ["id"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = layers.table("silver", "left").join(layers.table("silver", "right"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_file_writes(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, day string")
    for fmt in ("parquet", "json", "csv"):
        catalog.save_files(df, str(tmp_path / fmt), fmt)
    assert files.ingest_csv(spark, str(tmp_path / "csv")).count() == 2
    catalog.save_files(df.select("day"), str(tmp_path / "text"), "text")
    assert spark.read.text(str(tmp_path / "text")).count() == 2
    days = str(tmp_path / "days")
    catalog.save_files(df, days, partition_by=["day"])
    rerun = spark.createDataFrame([(3, "2024-01-02"), (4, "2024-01-02")], df.schema)
    catalog.replace_partitions(rerun, days, ["day"])
    assert sorted(r["id"] for r in spark.read.parquet(days).collect()) == [1, 3, 4]


def test_bounded_pandas(spark):
    assert len(catalog.bounded_to_pandas(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        catalog.bounded_to_pandas(spark.range(6), 5)


@pytest.mark.parametrize("limit", [2, 100])
def test_distinct_schema_names(spark, limit):
    data = [("a.b@x", "a_b"), ("a.b@y", "a_b"), ("a-b@z", "a_b"), ("c@x", "c")]
    df = spark.createDataFrame(data, "email string, base_name string")
    got = {r["email"]: r["schema_name"] for r in catalog.distinct_schema_names(df, max_group_rows=limit).collect()}
    assert got == {"a-b@z": "a_b_1", "a.b@x": "a_b_2", "a.b@y": "a_b_3", "c@x": "c"}


def test_sample_is_reproducible_and_near_its_fraction(spark):
    df = spark.range(100_000)
    first = catalog.sample_rows(df, "id", 0.1)
    assert first.count() == catalog.sample_rows(df.repartition(7), "id", 0.1).count()
    assert 9_000 < first.count() < 11_000


def test_shared_folder_comes_from_the_session(spark):
    assert workspace.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "id int, d date")
    kept = workspace.durable(df)
    assert kept.collect() == df.collect()
    assert "FileScan parquet" in kept._jdf.queryExecution().executedPlan().toString()
