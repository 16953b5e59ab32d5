"""File layouts, numbered versions, and writes that may be repeated."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.times import month_key
from tapeworks.session import workspace


def write_by_month(df: DataFrame, path: str, ts: str, mode: str = "overwrite") -> None:
    """Month folders, files sorted by (symbol, time): the layout of the hot and the bar table.

    ``rebalance`` keeps a symbol's rows of a month together, and lets adaptive execution cut a month or symbol
    that is far larger than the others into several tasks and join small ones. A plain ``repartition`` on the
    month would send each month through one task.
    """
    laid_out = df.withColumn("month", month_key(F.col(ts))).hint("rebalance", "month", "symbol")
    (
        laid_out.sortWithinPartitions("month", "symbol", ts)
        .write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy("month").parquet(path)
    )


def clustered_by_day(df: DataFrame, day: Column, then: str = "symbol") -> DataFrame:
    """Rows of a day together and sorted, so that readers of few days skip most files and row groups.

    Days of very different size become files of similar size. No column is added.
    """
    name = "clustering_day"
    together = df.withColumn(name, day).hint("rebalance", name)
    return together.sortWithinPartitions(name, then).drop(name)


def write_bronze(df: DataFrame, path: str, mode: str = "append") -> None:
    """Raw records in one folder per ingestion day; days of very different size become files of similar size."""
    dated = df.withColumn("ingest_date", F.to_date("ingestion_time"))
    dated.hint("rebalance", "ingest_date").write.mode(mode).partitionBy("ingest_date").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int, by: Sequence[str] = ()) -> None:
    """Write a micro-batch into folders of its own; the same batch again replaces them and nothing else.

    Rows of a folder are brought together first, into files of the size that adaptive execution aims at.
    """
    numbered = df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    (
        (numbered.hint("rebalance", *by) if by else numbered.hint("rebalance"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by, "batch_id").parquet(path)
    )


def bronze_batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Bronze by ingestion day and batch."""
    return lambda df, batch_id: write_batch(
        df.withColumn("ingest_date", F.to_date("ingestion_time")), path, batch_id, ["ingest_date"]
    )


def month_batch_writer(path: str, ts: str) -> Callable[[DataFrame, int], None]:
    """Hot trades or bars by month and batch, sorted for reading."""
    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(df.withColumn("month", month_key(F.col(ts))), path, batch_id, ["month"])
    return write


def compact(
    spark: SparkSession, path: str, by: str, value: str, merge: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Bring the batches of one folder ``by=value`` together in few files, under the number of the newest of them.

    ``merge`` may reduce the rows on the way. The rows are written aside first, and named as finished by one rename;
    a run that stops after that is completed by the next, which finds the finished rows. Not to be run while the
    folder is written to; readers may miss the folder for the moment of the swap.
    """
    _finish_compaction(spark, path, by)
    home = f"{path}/{by}={value}"
    folder, fs = _filesystem(spark, home)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    numbers = [int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")]
    if len(numbers) < 2:
        return
    rows = spark.read.parquet(home).drop("batch_id")
    merged = merge(rows) if merge else rows
    aside, _ = _filesystem(spark, f"{path}/_compacting")
    fs.delete(aside, True)
    target = f"{path}/_compacting/{by}={value}/batch_id={max(numbers)}"
    merged.hint("rebalance").write.mode("overwrite").parquet(target)
    fs.rename(aside, _filesystem(spark, f"{path}/_compacted")[0])
    _finish_compaction(spark, path, by)


def _finish_compaction(spark: SparkSession, path: str, by: str) -> None:
    """Puts finished rows in the place of the batches that they are made of."""
    done, fs = _filesystem(spark, f"{path}/_compacted")
    if not fs.exists(done):
        return
    for entry in fs.listStatus(done):
        name = entry.getPath().getName()
        if name.startswith(f"{by}="):
            home = _filesystem(spark, f"{path}/{name}")[0]
            fs.delete(home, True)
            fs.rename(entry.getPath(), home)
    fs.delete(done, True)


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the folders that are there; nothing else is listed."""
    return [p for p in paths if (place := _filesystem(spark, p))[1].exists(place[0])]


def merge_batches(
    spark: SparkSession, path: str, first: int, last: int, by: str | None = None,
    merge: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Bring the batches from ``first`` to ``last`` together, in each folder of ``by``, as that of the last of them.

    These batches must be finished: one that is written again would replace them all. ``merge`` may reduce the rows.
    The rows are written aside and named as finished by one rename; a run that stops after that is completed by the
    next. Readers may miss a folder for the moment of the swap.
    """
    _finish_merge(spark, path)
    top, fs = _filesystem(spark, path)
    if not fs.exists(top):
        return
    names = [s.getPath().getName() for s in fs.listStatus(top)]
    homes = [n for n in names if n.startswith(f"{by}=")] if by else [""]
    aside = f"{path}/_merging"
    delete(spark, aside)
    merged = False
    for home in homes:
        numbers = [n for n in _batches(spark, f"{path}/{home}") if first <= n <= last]
        if len(numbers) > 1:
            rows = spark.read.parquet(*(f"{path}/{home}/batch_id={n}" for n in numbers))
            rows = merge(rows) if merge else rows
            rows.hint("rebalance").write.mode("overwrite").parquet(f"{aside}/{home}/batch_id={last}")
            merged = True
    if merged:
        write_note(spark, f"{aside}/_range", f"{first} {last}")
        fs.rename(_filesystem(spark, aside)[0], _filesystem(spark, f"{path}/_merged")[0])
        _finish_merge(spark, path)


def _batches(spark: SparkSession, home: str) -> list[int]:
    folder, fs = _filesystem(spark, home)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return [int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")]


def _finish_merge(spark: SparkSession, path: str) -> None:
    done, fs = _filesystem(spark, f"{path}/_merged")
    if not fs.exists(done):
        return
    first, last = map(int, read_note(spark, f"{path}/_merged/_range").split())
    names = [s.getPath().getName() for s in fs.listStatus(done)]
    for home in ([""] if f"batch_id={last}" in names else [n for n in names if not n.startswith("_")]):
        for number in _batches(spark, f"{path}/{home}"):
            if first <= number <= last:
                delete(spark, f"{path}/{home}/batch_id={number}")
        ready, place = (_filesystem(spark, f"{root}/{home}/batch_id={last}")[0] for root in (f"{path}/_merged", path))
        if fs.exists(ready):
            fs.rename(ready, place)
            if home:
                delete(spark, f"{path}/_merged/{home}")
    delete(spark, f"{path}/_merged")


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions below a folder, oldest first."""
    path, fs = _filesystem(spark, root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    numbers = [int(n.removeprefix("v=")) for n in names if n.startswith("v=")]
    return sorted(n for n in numbers if fs.exists(_filesystem(spark, f"{root}/v={n}/_SUCCESS")[0]))


def version_path(root: str, number: int) -> str:
    return f"{root}/v={number}"


def prune_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all but the newest versions; readers of the last but one may still finish."""
    for number in versions(spark, root)[:-keep]:
        path, fs = _filesystem(spark, version_path(root, number))
        fs.delete(path, True)


def write_note(spark: SparkSession, root: str, text: str) -> None:
    """Puts a small text in the place of the one that is there; readers see the old or the new one, whole."""
    folder, fs = _filesystem(spark, root)
    number = max(_notes(fs, folder), default=0) + 1
    aside, place = (spark._jvm.org.apache.hadoop.fs.Path(folder, n) for n in (f"_{number}", str(number)))
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(aside, place)
    for old in _notes(fs, folder):
        if old < number:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, str(old)), False)


def read_note(spark: SparkSession, root: str) -> str | None:
    """The text that was last put there."""
    folder, fs = _filesystem(spark, root)
    numbers = _notes(fs, folder)
    if not numbers:
        return None
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(folder, str(max(numbers))))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _notes(fs, folder) -> list[int]:
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return [int(n) for n in names if n.isdigit()]


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the library's own; nothing happens if there is none."""
    folder, fs = _filesystem(spark, path)
    fs.delete(folder, True)


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A folder of the shared space for one job; deleted when the job is done or has failed."""
    folder = workspace(spark, purpose)
    try:
        yield folder
    finally:
        path, fs = _filesystem(spark, folder)
        fs.delete(path, True)


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the files.

    It is computed once however often it is used, and a lost executor does not bring the work back.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
