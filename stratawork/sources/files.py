"""File sources, lineage columns and file-level audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MEGABYTE = 1024 * 1024


def ingest_csv(
    spark: SparkSession,
    file_path: str,
    schema: T.StructType | str | None = None,
    options: dict | None = None,
) -> DataFrame:
    """CSV with a header and without type inference unless ``options`` say otherwise."""
    settings = {"header": "true", "inferSchema": "false", **(options or {})}
    reader = spark.read.options(**settings)
    return (reader.schema(schema) if schema else reader).csv(file_path)


def ingest_json(
    spark: SparkSession,
    file_path: str,
    schema: T.StructType | str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """JSON lines, or whole-file documents with ``multiline``."""
    reader = spark.read.option("multiLine", multiline)
    return (reader.schema(schema) if schema else reader).json(file_path)


def ingest_parquet(spark: SparkSession, file_path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet; named columns alone are read from storage."""
    df = spark.read.parquet(file_path)
    return df.select(*columns) if columns else df


def with_lineage(
    df: DataFrame,
    *,
    source_system: str | None = None,
    source_file: bool = False,
    source_api: str | None = None,
    timestamp: bool = True,
) -> DataFrame:
    """Add where rows came from and when. ``source_file`` needs a frame scanned from files."""
    added = {}
    if source_file:
        added["source_file"] = F.col("_metadata.file_name")
    if source_system:
        added["source_system"] = F.lit(source_system)
    if source_api:
        added["source_api"] = F.lit(source_api)
    if timestamp:
        added["ingestion_timestamp"] = F.current_timestamp()
    return df.withColumns(added) if added else df


def file_manifest(scan: DataFrame) -> DataFrame:
    """Name, day of last change and record count of every file behind a scan."""
    return (
        scan.groupBy(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("filename"),
            F.to_date(F.col("_metadata.file_modification_time")).alias("modified_on"),
        )
        .agg(F.count("*").alias("record_count"))
    )


def file_size_audit(spark: SparkSession, path: str, max_size_mb: float = 10.0) -> DataFrame:
    """Size of every file below a path and whether it is within the limit.

    Sizes come from the file listing; no content is read.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
        (F.col("length") <= F.lit(int(max_size_mb * MEGABYTE))).alias("within_limit"),
    )


def file_contents(scan: DataFrame, max_size_mb: float = 10.0) -> DataFrame:
    """Name, size, rows and limit verdict of every file behind a scan.

    Sizes come with the listing. Rows are counted from the files' footers where the format has them, as no column
    is read; one row per file and task is shuffled.
    """
    size = F.col("_metadata.file_size")
    per_file = scan.groupBy(F.col("_metadata.file_name").alias("filename"), size.alias("file_size")).agg(F.count("*").alias("record_count"))
    return per_file.withColumn("within_limit", F.col("file_size") <= F.lit(int(max_size_mb * MEGABYTE)))


def validate_file_size(spark: SparkSession, file_path: str, max_size_mb: float = 10.0) -> bool:
    """False for a missing path and for a path with any file above the limit.

    Sizes come from the file listing; no content is read.
    """
    try:
        files = spark.read.format("binaryFile").load(file_path).select("length")
        largest = files.agg(F.max("length")).first()[0]
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise
    return largest is not None and largest <= max_size_mb * MEGABYTE
