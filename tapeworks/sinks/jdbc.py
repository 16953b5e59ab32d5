"""Appending to a database."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapeworks.schemas import HOT_TRADE

# Many rows per round trip, and no transaction isolation: the store is append-only.
JDBC_DEFAULTS = {"batchsize": "10000", "isolationLevel": "NONE"}


def jdbc_options(url: str, table: str, connections: int = 16, **options: str) -> dict[str, str]:
    """``connections`` bounds how many tasks write at once, whatever the number of partitions."""
    return {**JDBC_DEFAULTS, "numPartitions": str(connections), **options, "url": url, "dbtable": table}


def append_jdbc(df: DataFrame, options: Mapping[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("append").save()


def _execute(df: DataFrame, options: Mapping[str, str], statement: str) -> None:
    jvm = df.sparkSession._jvm
    if "driver" in options:
        jvm.java.lang.Class.forName(options["driver"])
    login = jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in options:
            login.setProperty(key, options[key])
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], login)
    try:
        connection.createStatement().executeUpdate(statement)
    finally:
        connection.close()


# Column types of the stores, by those of the table's schema.
COLUMN_TYPES = {
    "ansi": {"string": "VARCHAR(64)", "double": "DOUBLE PRECISION", "timestamp": "TIMESTAMP(6)", "bigint": "BIGINT"},
    "columnar": {"string": "String", "double": "Float64", "timestamp": "DateTime64(6, 'UTC')", "bigint": "Int64"},
}


def hot_table_ddl(table: str, dialect: str = "columnar", schema: StructType = HOT_TRADE) -> str:
    """Definition of a hot table that :func:`jdbc_batch_writer` can write to: the trades and ``batch_id``.

    No column may be missing: rows that lack one go to the rejects (``hot.unstorable``). In the columnar dialect the table is
    laid out by month, in order of symbol and time, as the files are; elsewhere an index is for the store to add.
    """
    types = COLUMN_TYPES[dialect]
    columns = [(f.name, types[f.dataType.simpleString()]) for f in schema] + [("batch_id", types["bigint"])]
    if dialect == "columnar":
        needed, layout = "", "\nENGINE = MergeTree PARTITION BY toYYYYMM(trade_ts) ORDER BY (symbol, trade_ts)"
    else:
        needed, layout = " NOT NULL", ""
    return f"CREATE TABLE {table} (\n" + ",\n".join(f"  {name} {kind}{needed}" for name, kind in columns) + f"\n){layout}"


def jdbc_batch_writer(
    options: Mapping[str, str], delete: str = "DELETE FROM {table} WHERE batch_id = {batch_id}"
) -> Callable[[DataFrame, int], None]:
    """Writes micro-batches with a batch_id column; what an earlier attempt left of a batch is deleted first.

    An attempt can have come before only if this writer has begun the batch already, or has begun none yet (the job may have been
    started again); all other batches are appended without a delete.
    """
    begun: list[int] = []

    def write(df: DataFrame, batch_id: int) -> None:
        if not begun or batch_id <= begun[-1]:
            _execute(df, options, delete.format(table=options["dbtable"], batch_id=int(batch_id)))
        begun[:] = [batch_id]
        append_jdbc(df.withColumn("batch_id", F.lit(batch_id).cast("bigint")), options)
    return write
