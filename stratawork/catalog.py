"""Layered tables: names, writers, views and catalog reports."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .functions.names import schema_name_for
from .operators.joins import join_null_safe
from .operators.ordered import DEFAULT, ordered_scan
from .operators.profile import counted
from .sources.files import ingest_csv, with_lineage

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class Layers:
    """Tables of one user: ``catalog.schema.layer_name``."""

    spark: SparkSession
    schema: str
    catalog: str = "spark_catalog"

    @classmethod
    def for_email(cls, spark: SparkSession, email: str, catalog: str = "spark_catalog") -> "Layers":
        layers = cls(spark, schema_name_for(email), catalog)
        layers.create_schema()
        return layers

    def create_schema(self) -> None:
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.get_schema_path()}")

    def get_schema_path(self) -> str:
        return f"{self.catalog}.{self.schema}"

    def get_table_path(self, layer: str, table_name: str) -> str:
        layer = layer.lower()
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}: expected {', '.join(LAYERS)}")
        return f"{self.get_schema_path()}.{layer}_{table_name}"

    def table(self, layer: str, table_name: str) -> DataFrame:
        return self.spark.table(self.get_table_path(layer, table_name))

    def write(self, df: DataFrame, layer: str, table_name: str, **settings) -> DataFrame:
        """Write one table of a layer and return it as read back."""
        name = self.get_table_path(layer, table_name)
        save_table(df, name, **settings)
        return self.spark.table(name)

    def inventory(self, prefix: str = "") -> DataFrame:
        """Record count of every table whose name starts with ``prefix``, in one job."""
        tables = self.spark.catalog.listTables(self.get_schema_path())
        names = sorted(t.name for t in tables if not t.isTemporary and t.name.startswith(prefix))
        frames = {n: self.spark.table(f"{self.get_schema_path()}.{n}") for n in names}
        return table_inventory(self.spark, frames)


def save_table(
    df: DataFrame,
    table_name: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    bucket_by: tuple[int, list[str]] | None = None,
) -> None:
    """Write a catalog table; overwriting replaces the schema, too.

    With ``partition_by`` the rows are spread so that each partition value is written by few
    tasks; adaptive execution splits a value that is too large for one. Tables with the same
    ``bucket_by`` (count, keys) join on these keys without a shuffle.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        buckets, keys = bucket_by
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(table_name)


def save_files(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: list[str] | None = None
) -> None:
    """Write parquet, JSON, CSV or text files below a path."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions that occur in ``df`` (re-run of one processing date)."""
    writer = df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def ingest_csv_with_schema(layers: Layers, file_path: str, schema: T.StructType | str, table_name: str) -> DataFrame:
    """Read CSV under an explicit schema and overwrite the raw table."""
    return layers.write(ingest_csv(layers.spark, file_path, schema), "bronze", table_name)


def ingest_all(layers: Layers, sources: dict[str, DataFrame], mode: str = "append") -> DataFrame:
    """Write every source (files, API pages, database, object store) to its raw table.

    Each table gets the name of its source and an ingestion time; the result is the inventory
    of the raw layer. A scheduler may as well run the sources as tasks of their own.
    """
    for name, df in sources.items():
        layers.write(with_lineage(df, source_system=name), "bronze", name, mode=mode)
    return layers.inventory("bronze_")


INVENTORY = "source string, status string, record_count long, error string"


def ingest_sources(
    spark: SparkSession,
    sources: dict[str, Callable[[], DataFrame]],
    write: Callable[[DataFrame, str], object],
    discard: Callable[[str], object] | None = None,
) -> DataFrame:
    """Land every source that can be read, set aside those that cannot; the inventory of the run.

    ``write(df, name)`` lands one source. Rows are counted by an observation of that write, not by another
    scan. A source that fails, as it is opened or while its rows are read, is reported with the condition of its
    error; ``discard(name)`` removes what it left, and the others go on.
    """
    found = []
    for name, open_source in sources.items():
        try:
            rows, seen = counted(with_lineage(open_source(), source_system=name), f"ingest {name}")
            write(rows, name)
            found.append((name, "LANDED", seen.get["rows"], None))
        except PySparkException as error:
            if discard:
                discard(name)
            found.append((name, "FAILED", None, root_condition(error)))
    return spark.createDataFrame(found, INVENTORY)


def root_condition(error: PySparkException) -> str:
    """The condition of the innermost named cause of a failed job, such as ``PATH_NOT_FOUND``."""
    named = re.findall(r"\[([A-Z][A-Z0-9_.]+)\]", str(error))
    return named[-1] if named else error.getCondition() or type(error).__name__


def table_inventory(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """Name and record count of each frame as one union of counts."""
    if not frames:
        return spark.createDataFrame([], "table_name string, record_count long")
    counts = [
        df.agg(F.count("*").alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def catalog_report(spark: SparkSession) -> dict:
    """Where the session stands and what it can see."""
    return {
        "catalog": spark.catalog.currentCatalog(),
        "schema": spark.catalog.currentDatabase(),
        "user": spark.sql("SELECT current_user()").first()[0],
        "catalogs": [c.name for c in spark.catalog.listCatalogs()],
        "schemas": [d.name for d in spark.catalog.listDatabases()],
        "tables": [t.name for t in spark.catalog.listTables()],
    }


def find_tables(spark: SparkSession, pattern: str, schema: str | None = None) -> list[str]:
    """Tables whose name matches a ``*`` pattern."""
    return [t.name for t in spark.catalog.listTables(schema, pattern)]


def find_columns(spark: SparkSession, part: str, schema: str | None = None) -> list[tuple[str, str, str]]:
    """(table, column, type) for every column whose name contains ``part``."""
    hits = []
    for table in spark.catalog.listTables(schema):
        name = table.name if table.isTemporary else f"{'.'.join(table.namespace)}.{table.name}"
        columns = spark.catalog.listColumns(name)
        hits += [(table.name, c.name, c.dataType) for c in columns if part.lower() in c.name.lower()]
    return hits


def column_search(spark: SparkSession, part: str, tables: str = "*", schema: str | None = None) -> DataFrame:
    """``table_name``, ``column_name``, ``data_type`` and ``is_partition`` of matching columns of matching tables.

    The rows come from the catalog and number as its columns do; no table is read.
    """
    found = []
    for table in spark.catalog.listTables(schema, tables):
        name = table.name if table.isTemporary else f"{'.'.join(table.namespace)}.{table.name}"
        columns = spark.catalog.listColumns(name)
        found += [(table.name, c.name, c.dataType, c.isPartition) for c in columns if part.lower() in c.name.lower()]
    return spark.createDataFrame(found, "table_name string, column_name string, data_type string, is_partition boolean")


def describe(spark: SparkSession, table_name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}")


def bounded_to_pandas(df: DataFrame, max_rows: int = 100_000):
    """Hand a small result to pandas; a larger one is an error, not a driver out of memory."""
    head = df.limit(max_rows + 1).toPandas()
    if len(head) > max_rows:
        raise ValueError(f"more than {max_rows} rows; filter or aggregate first")
    return head


def distinct_schema_names(
    users: DataFrame, base: str = "base_name", email: str = "email", max_group_rows: int = DEFAULT
) -> DataFrame:
    """Unique names: a base name used more than once gets ``_k`` by sorted e-mail; no base name, no name."""
    counts = users.groupBy(base).agg(F.count("*").alias("__uses"))
    numbered = ordered_scan(users, [base], [email], row_number="__k", max_group_rows=max_group_rows)
    suffix = F.concat(F.col(base), F.lit("_"), F.col("__k").cast("string"))
    named = join_null_safe(numbered, counts, [base]).withColumn(
        "schema_name", F.when(F.col("__uses") > 1, suffix).otherwise(F.col(base))
    )
    return named.drop("__uses", "__k")


def sample_rows(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Reproducible sample by multiplicative hash of an integer key.

    Unlike ``df.sample`` a re-run, a retry or another engine picks the same rows.
    """
    hashed = F.pmod(F.pmod(F.col(key), F.lit(2**31)) * F.lit(2654435761), F.lit(2**32))
    return df.filter(hashed < F.lit(int(fraction * 2**32)))
