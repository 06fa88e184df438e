"""Tables of a namespace: create, read, replace, append, list."""

import contextlib
import contextvars
import datetime
import re
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo.session import fresh_path


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def replace_table(df: DataFrame, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace contents and schema of a table; return the new table.

    The rows become a version of their own, a table in the namespace beside it
    named ``<namespace>_versions``; the name is a view of one version and is
    moved to the new one in a single change of the catalog. So a table may be
    replaced by a query over itself, a failed job leaves the old table alone, a
    reader always finds the name, and readers of the old version finish
    undisturbed. Old versions stay until ``drop_old_versions``.
    """
    spark = df.sparkSession
    versions, name = _versions(spark, table)
    ensure_namespace(spark, versions, f"{_folder_of(spark, table)}_versions")
    version = f"{versions}.{name}__{time.time_ns()}_{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("errorifexists").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(version)
    chosen = f"AS SELECT * FROM {version}"
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "VIEW":
            # One change of the catalog; replacing a view would drop it first.
            spark.sql(f"ALTER VIEW {table} {chosen}")
            return spark.table(table)
        spark.sql(f"DROP TABLE {table}")  # made by other means
    spark.sql(f"CREATE VIEW {table} {chosen}")
    return spark.table(table)


def drop_old_versions(spark: SparkSession, table: str, older_than: datetime.timedelta) -> list[str]:
    """Drop versions of a table, with their files, that were replaced and are
    older than the longest reader may take; return their names."""
    versions, name = _versions(spark, table)
    if not spark.catalog.databaseExists(versions):
        return []
    named = [
        r.tableName
        for r in spark.sql(f"SHOW TABLES IN {versions}").collect()
        if re.fullmatch(rf"{re.escape(name)}__\d+_[0-9a-f]{{8}}", r.tableName)
    ]
    named.sort(key=lambda v: int(v.split("__")[-1].split("_")[0]))
    limit = time.time_ns() - int(older_than.total_seconds() * 1e9)
    # A version was in use until the next one came.
    replaced = [v for v, after in zip(named, named[1:]) if int(after.split("__")[-1].split("_")[0]) < limit]
    for version in replaced:
        spark.sql(f"DROP TABLE {versions}.{version}")
    return replaced


def _versions(spark: SparkSession, table: str) -> tuple[str, str]:
    namespace, _, name = table.rpartition(".")
    return f"{namespace or spark.catalog.currentDatabase()}_versions", name


_scopes: contextvars.ContextVar[list[list[str]]] = contextvars.ContextVar("scopes", default=[])


def staged(df: DataFrame, name: str, result: bool = False) -> DataFrame:
    """Write the rows to the shared folder and read them from there, so that
    what follows may scan them often, and from any executor, without computing
    them again. Within a ``scratch`` they go with it, unless they are a
    ``result``: those belong to the scratch around it, or stay."""
    path = _staging_path(df.sparkSession, name, result)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_in_turn(frames: Iterable[DataFrame], name: str, result: bool = False) -> DataFrame:
    """As ``staged``, the rows of at least one frame, all of one schema. What a frame
    left behind, its shuffles above all, goes before the next one is asked for."""
    path = None
    for df in frames:
        path = path or _staging_path(df.sparkSession, name, result)
        with scratch(df.sparkSession):
            df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _staging_path(spark: SparkSession, name: str, result: bool) -> str:
    path, scopes = fresh_path(spark, name), _scopes.get()
    if len(scopes) > result:
        scopes[-1 - result].append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """A block whose staged tables are removed when it ends, well or not. What
    leaves the block may only read results."""
    paths: list[str] = []
    token = _scopes.set([*_scopes.get(), paths])
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in paths:
            remove(spark, path)
        # Shuffle files go once the driver collects what referred to them, which a
        # large heap puts off until disks are full.
        spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def append_table(df: DataFrame, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """Append rows, creating the table on first use."""
    writer = df.write.mode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def replace_partitions(df: DataFrame, table: str, partition_by: list[str]) -> DataFrame:
    """Put rows into a table, in place of the partitions they belong to; other
    partitions stay. Creates the table on first use."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        empty = df.limit(0).write.format("parquet").partitionBy(*partition_by)
        empty.saveAsTable(table)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(_folder_of(spark, table))
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def tables_with_prefix(spark: SparkSession, namespace: str, prefix: str) -> DataFrame:
    """Tables whose name starts with the prefix, taken literally: in a LIKE
    pattern the underscores of the prefix would match any character."""
    return (
        spark.sql(f"SHOW TABLES IN {namespace}")
        .where(F.col("tableName").startswith(prefix))
        .select(F.col("tableName").alias("table_name"))
    )


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, nullability."""
    rows = [
        (i, field.name, field.dataType.simpleString(), field.nullable)
        for i, field in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "pos int, name string, type string, nullable boolean"
    )


def _folder_of(spark: SparkSession, table: str) -> str:
    namespace, _, name = table.rpartition(".")
    database = spark.catalog.getDatabase(namespace or spark.catalog.currentDatabase())
    return f"{database.locationUri.rstrip('/')}/{name}"
