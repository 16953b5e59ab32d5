import glob

import pyarrow.parquet as pq
import pytest
from helpers import bronze, final_plan, payload, trades

from pyspark.sql import functions as F
from tapeworks import session
from tapeworks.sinks import files, jdbc, tables


def test_append_matches_columns_by_name(spark, tmp_path, table_name):
    name = table_name("t")
    tables.append_table(spark.createDataFrame([(1, "a")], "n int, s string"), name, str(tmp_path))
    tables.append_table(spark.createDataFrame([("b", 2)], "s string, n int"), name, str(tmp_path))
    assert sorted(tuple(r) for r in tables.scan(spark, name).collect()) == [(1, "a"), (2, "b")]


def test_replace_may_read_what_it_replaces(spark, tmp_path, table_name):
    name, root = table_name("t"), str(tmp_path)
    tables.replace_table(spark.range(5), name, root)
    for _ in range(4):
        tables.replace_table(spark.table(name).withColumn("id", F.col("id") + 1), name, root, {"layer": "x"})
    assert [r.id for r in spark.table(name).orderBy("id").collect()] == [4, 5, 6, 7, 8]
    assert len(files.versions(spark, f"{root}/{name}")) == 2
    properties = {r.key: r.value for r in spark.sql(f"show tblproperties {name}").collect()}
    assert properties["layer"] == "x"


def test_replace_with_other_columns(spark, tmp_path, table_name):
    name, root = table_name("t"), str(tmp_path)
    tables.replace_table(spark.range(2), name, root)
    tables.replace_table(spark.range(1).withColumn("s", F.lit("x")), name, root)
    assert spark.table(name).columns == ["id", "s"]


def test_sql_model_equals_the_operator(spark, sf_dir, tmp_path, table_name):
    from tapeworks.operators.gold import daily_trade_metrics
    from tapeworks.plans import fixtures as fx

    clean, daily, root = table_name("silver"), table_name("gold"), str(tmp_path)
    tables.replace_table(fx.silver_with_gaps(spark, sf_dir), clean, root)
    tables.build_model(spark, daily, f"""
        WITH amounts AS (
          SELECT coalesce(date(source_ts), date(ingestion_time)) AS trade_date, symbol, quantity,
                 lower(side) = 'buy' AS bought
          FROM {clean} WHERE coalesce(source_ts, ingestion_time) IS NOT NULL)
        SELECT trade_date, symbol, count(*) AS trades, sum(if(bought, quantity, 0D)) AS buy_qty
        FROM amounts GROUP BY 1, 2""", root)
    wanted = daily_trade_metrics(spark.table(clean)).select("trade_date", "symbol", "trades", "buy_qty")
    assert sorted(spark.table(daily).collect()) == sorted(wanted.collect())


def test_failed_replace_leaves_the_table(spark, tmp_path, table_name):
    name, root = table_name("t"), str(tmp_path)
    tables.replace_table(spark.range(3), name, root)
    with pytest.raises(Exception, match="stop here"):
        tables.replace_table(spark.range(3).withColumn("id", F.raise_error(F.lit("stop here")).cast("long")), name, root)
    assert spark.table(name).count() == 3
    tables.replace_table(spark.range(1), name, root)
    assert spark.table(name).count() == 1


def test_catalog_of_a_name(spark):
    assert tables.in_own_catalog(spark, "lakehouse.silver.trades")
    assert not tables.in_own_catalog(spark, "spark_catalog.silver.trades")
    assert not tables.in_own_catalog(spark, "silver.trades")


def test_hot_month_becomes_several_sorted_files(spark, tmp_path):
    """Nine tenths of the rows are in one month and of one symbol."""
    rows = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 10 > 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 7)).alias("symbol"),
        F.timestamp_seconds(F.lit(1704067200) + F.xxhash64("id") % 1000000).alias("trade_ts"),
        F.sha2(F.col("id").cast("string"), 512).alias("filler"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "2m")
    try:
        files.write_by_month(rows, str(tmp_path / "hot"), "trade_ts")
    finally:
        spark.conf.set(size, before)
    written = glob.glob(str(tmp_path / "hot" / "month=202401" / "*.parquet"))
    assert len(written) > 3
    for path in written:
        table = pq.read_table(path, columns=["symbol", "trade_ts"]).to_pylist()
        keys = [(r["symbol"], r["trade_ts"]) for r in table]
        assert keys == sorted(keys)
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 200_000


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    write = files.month_batch_writer(str(tmp_path / "hot"), "trade_ts")
    first = trades(spark, ("a", "S", 1.0, 1.0, "2024-01-31 10:00:00"), ("b", "S", 1.0, 1.0, "2024-02-01 10:00:00"))
    for batch_id in (0, 0, 1, 0):
        write(first, batch_id)
    got = spark.read.parquet(str(tmp_path / "hot"))
    assert got.groupBy("month", "batch_id").count().count() == 4 and got.count() == 4


def test_bronze_days_are_pruned(spark, tmp_path):
    path = str(tmp_path / "bronze")
    files.write_bronze(bronze(spark, payload(), ingested="2024-05-01 10:00:00"), path)
    files.write_bronze(bronze(spark, payload(), payload(), ingested="2024-05-02 10:00:00"), path)
    day = spark.read.parquet(path).filter("ingest_date = date'2024-05-02'")
    assert day.count() == 2
    again = spark.read.parquet(path).filter("ingest_date = date'2024-05-02'")
    assert "PartitionFilters: [isnotnull(ingest_date" in final_plan(again)


def test_versions_without_success_do_not_count(spark, tmp_path):
    root = str(tmp_path / "state")
    assert files.versions(spark, root) == []
    for n in (3, 10, 2):
        spark.range(1).write.parquet(files.version_path(root, n))
    (tmp_path / "state" / "v=11").mkdir()
    assert files.versions(spark, root) == [2, 3, 10]
    files.prune_versions(spark, root, keep=1)
    assert files.versions(spark, root) == [10]


@pytest.mark.parametrize("exists", [False, True])
def test_calls_to_a_catalog_of_its_own(spark, monkeypatch, exists):
    """Which writer calls are made; no such catalog is on the classpath."""
    calls = []

    class Writer:
        def __getattr__(self, step):
            return lambda *a: (calls.append((step, *map(str, a))), self)[1]

    class Frame:
        class sparkSession:
            class catalog:
                tableExists = staticmethod(lambda name: exists)

            sql = staticmethod(lambda text: calls.append(("sql", text)))

        def writeTo(self, name):
            calls.append(("to", name))
            return Writer()

        def withColumns(self, *_):
            return self

    name = "lakehouse.bronze.trades"
    tables.append_table(Frame(), name)
    tables.replace_table(Frame(), name, properties={"format-version": "2"})
    tables.table_batch_writer(name)(Frame(), 3)
    made = [c for c in calls if c[0] not in ("sql", "to")]
    replaced = [("tableProperty", "format-version", "2"), ("createOrReplace",)]
    if exists:
        assert made[0] == ("append",) and made[1:3] == replaced
        assert made[3][0] == "overwrite" and "batch_id" in made[3][1] and "3" in made[3][1]
    else:
        assert made[:3] == [("create",), *replaced] and made[4:] == [("create",)]
        assert made[3][0] == "partitionedBy" and "ingest_date" in made[3][1] and "batch_id" in made[3][2]
    assert {c[1] for c in calls if c[0] == "to"} == {name}


def test_scratch_is_gone_afterwards(spark):
    with pytest.raises(ZeroDivisionError):
        with files.scratch(spark, "job") as folder:
            assert files.staged(spark.range(3), folder).count() == 3
            1 / 0
    path, fs = files._filesystem(spark, folder)
    assert not fs.exists(path)


def test_jdbc_options():
    got = jdbc.jdbc_options("jdbc:x", "trades", driver="d", batchsize="5")
    assert got == {"batchsize": "5", "isolationLevel": "NONE", "numPartitions": "16", "driver": "d",
                   "url": "jdbc:x", "dbtable": "trades"}


def test_jdbc_batch_that_may_be_a_repeat_is_deleted_first(spark, monkeypatch):
    """Order and content only; no database is started here."""
    done = []

    def append(df, options):
        done.append(df.columns)
        if len(done) == 4:
            raise RuntimeError("lost")

    monkeypatch.setattr(jdbc, "_execute", lambda df, options, statement: done.append(statement))
    monkeypatch.setattr(jdbc, "append_jdbc", append)
    write, columns = jdbc.jdbc_batch_writer(jdbc.jdbc_options("jdbc:x", "hot")), ["id", "batch_id"]
    write(spark.range(1), 7)
    write(spark.range(1), 8)
    with pytest.raises(RuntimeError):
        write(spark.range(1), 9)
    write(spark.range(1), 9)
    write(spark.range(1), 10)
    assert done == ["DELETE FROM hot WHERE batch_id = 7", columns, columns, columns,
                    "DELETE FROM hot WHERE batch_id = 9", columns, columns]


def test_hot_table_has_the_columns_that_are_written():
    for dialect in jdbc.COLUMN_TYPES:
        ddl = jdbc.hot_table_ddl("hot", dialect)
        assert [line.split()[0] for line in ddl.splitlines()[1:8]] == [
            "trade_id", "symbol", "side", "price", "quantity", "trade_ts", "batch_id"]
    assert "price Float64" in jdbc.hot_table_ddl("hot") and "ORDER BY (symbol, trade_ts)" in jdbc.hot_table_ddl("hot")
    assert "symbol VARCHAR(64) NOT NULL" in jdbc.hot_table_ddl("hot", "ansi")


def test_shared_folder(spark, monkeypatch):
    class Named:
        conf = {"spark.checkpoint.dir": "s3://bucket/shared/"}

        class sparkContext:
            master = "spark://host"

    assert session.shared_root(Named) == "s3://bucket/shared"
    Named.conf = {}
    with pytest.raises(RuntimeError):
        session.shared_root(Named)
    assert session.workspace(spark, "x") != session.workspace(spark, "x")
