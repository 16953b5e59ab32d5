"""Named tables: scan, append, replace."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.sinks.files import delete, prune_versions, version_path, versions


def in_own_catalog(spark: SparkSession, name: str) -> bool:
    """True for a table of a configured catalog (Iceberg and the like), false for the session catalog."""
    parts = name.split(".")
    catalog = parts[0] if len(parts) == 3 else spark.catalog.currentCatalog()
    return catalog != "spark_catalog"


def scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def _ensure_namespace(spark: SparkSession, name: str) -> None:
    namespace = ".".join(name.split(".")[:-1])
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def append_table(df: DataFrame, name: str, root: str | None = None, by: Sequence[str] = ()) -> None:
    """Append by column name. A table that does not exist yet is created, a Parquet table below ``root``.

    ``by`` partitions a table that a configured catalog creates.
    """
    spark = df.sparkSession
    if in_own_catalog(spark, name):
        if spark.catalog.tableExists(name):
            df.writeTo(name).append()
        else:
            _ensure_namespace(spark, name)
            writer = df.writeTo(name)
            (writer.partitionedBy(*map(F.col, by)) if by else writer).create()
    elif spark.catalog.tableExists(name):
        df.select(spark.table(name).columns).write.insertInto(name)
    else:
        replace_table(df, name, root)


def replace_table(
    df: DataFrame, name: str, root: str | None = None, properties: Mapping[str, str] | None = None,
    by: Sequence[str] = (),
) -> None:
    """Replace a table's whole content; readers see the old or the new content, never a part.

    With a catalog of its own this is one atomic ``createOrReplace``. A Parquet table of the session catalog
    is written to a new version folder below ``root`` and the table is pointed at it afterwards, so the query
    may read the table it replaces, and a failure leaves the old content.
    """
    spark = df.sparkSession
    properties = dict(properties or {})
    _ensure_namespace(spark, name)
    if in_own_catalog(spark, name):
        writer = df.writeTo(name)
        for key, value in properties.items():
            writer = writer.tableProperty(key, value)
        (writer.partitionedBy(*map(F.col, by)) if by else writer).createOrReplace()
        return
    if root is None:
        raise ValueError("a Parquet table needs the folder that holds its versions")
    home = f"{root}/{name.split('.')[-1]}"
    number = max(versions(spark, home), default=0) + 1
    location = version_path(home, number)
    df.write.mode("overwrite").partitionBy(*by).parquet(location)
    exists = spark.catalog.tableExists(name)
    if exists and dict(spark.table(name).dtypes) == dict(df.dtypes):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    else:
        if exists:
            spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=location, source="parquet", schema=df.schema)
    if properties:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    spark.catalog.refreshTable(name)
    prune_versions(spark, home)


def replace_partitions(df: DataFrame, name: str, root: str | None, by: Sequence[str]) -> None:
    """Replace the rows of those values of ``by`` that df has; all other folders of the table stay as they are."""
    spark = df.sparkSession
    if in_own_catalog(spark, name):
        df.writeTo(name).overwritePartitions()
        return
    home = f"{root}/{name.split('.')[-1]}"
    location = version_path(home, max(versions(spark, home)))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(location)
    spark.catalog.refreshTable(name)


def clear_partition(spark: SparkSession, name: str, root: str | None, by: str, value: str) -> None:
    """Remove the rows that have one value of a partition column; a replacement without rows would leave them."""
    if in_own_catalog(spark, name):
        spark.sql(f"DELETE FROM {name} WHERE {by} = '{value}'")
        return
    home = f"{root}/{name.split('.')[-1]}"
    delete(spark, f"{version_path(home, max(versions(spark, home)))}/{by}={value}")
    spark.catalog.refreshTable(name)


def location(spark: SparkSession, name: str) -> str:
    """Where a table's content lies. A replaced Parquet table of the session catalog lies elsewhere than before."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else name


def build_model(
    spark: SparkSession, name: str, sql: str, root: str | None = None, properties: Mapping[str, str] | None = None
) -> None:
    """Materialise a SQL model as a table, swapped in whole."""
    replace_table(spark.sql(sql), name, root, properties)


def table_batch_writer(name: str) -> Callable[[DataFrame, int], None]:
    """Raw records of micro-batches into a table of a configured catalog, by ingestion day and batch.

    One atomic commit replaces the rows of the batch; no file holds rows of two batches.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        numbered = df.withColumns({
            "ingest_date": F.to_date("ingestion_time"), "batch_id": F.lit(batch_id).cast("bigint")})
        if df.sparkSession.catalog.tableExists(name):
            numbered.writeTo(name).overwrite(F.col("batch_id") == batch_id)
        else:
            append_table(numbered, name, by=["ingest_date", "batch_id"])
    return write
