"""Parquet sinks. Appends never rewrite what is there; overwrites replace one batch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asof import latest
from tidemark.operators.gates import clean_rows, quarantined_rows
from tidemark.session import materialized


def write_clean(df: DataFrame, path: str, key: str = "entity_id") -> DataFrame:
    """Rows that may proceed; replaces the batch at ``path``."""
    clean_rows(df, key).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def dead_letters(df: DataFrame, batch_id: str, key: str = "entity_id") -> DataFrame:
    return quarantined_rows(df, key).select(
        "*", F.lit(f"null {key}").alias("reason"), F.lit(batch_id).alias("batch_id")
    )


def write_dlq(df: DataFrame, path: str, batch_id: str, key: str = "entity_id") -> None:
    """Adds the batch's quarantined rows. A repeat of the batch replaces its own folder only."""
    rows = dead_letters(df, batch_id, key).drop("batch_id")
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def by_day(df: DataFrame, ts: str, column: str = "date") -> DataFrame:
    """Dated rows, rebalanced by day: few files per day, and a heavy day is split."""
    dated = df.withColumn(column, F.to_date(ts))
    return dated.hint("rebalance", column)


def append_features(df: DataFrame, path: str, ts: str = "ts") -> None:
    """Append-only feature history, partitioned by day."""
    by_day(df, ts).write.mode("append").partitionBy("date").parquet(path)


def append_log(df: DataFrame, path: str, ts: str = "request_ts", hourly: bool = False) -> None:
    """Append-only inference log, partitioned by day; by hour too where a day is heavy."""
    out = by_day(df, ts)
    parts = ["date", "hour"] if hourly else ["date"]
    out = out.withColumn("hour", F.hour(ts)) if hourly else out
    out.write.mode("append").partitionBy(*parts).parquet(path)


def append_online(df: DataFrame, path: str, batch_id: str, key: str = "entity_id", seq: str = "write_seq") -> None:
    """The batch's last write per key as one delta; the same batch again replaces its delta."""
    latest(df, [key], [seq]).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_online(spark: SparkSession, path: str, key: str = "entity_id", seq: str = "write_seq") -> DataFrame:
    """Current value per key over all deltas: by write order, so a late backfill still wins."""
    return latest(spark.read.parquet(path).drop("batch_id"), [key], [seq])


def compact_online(spark: SparkSession, path: str, target: str) -> None:
    """Folds all deltas into one at ``target``, the next round's starting folder."""
    read_online(spark, path).write.mode("overwrite").parquet(f"{target}/batch_id=0")


ONLINE_BUCKETS = 64


def upsert_online(
    df: DataFrame, path: str, key: str = "entity_id", seq: str = "write_seq", buckets: int = ONLINE_BUCKETS
) -> int:
    """Merges a batch into the online table at ``path``: one row per key, one file per bucket of keys.

    Only the buckets that the batch touches are read and rewritten, and however many batches came before, a
    bucket is one file. The merged rows are written aside first, then take the place of their buckets. A batch that
    comes again, or is cut off and starts anew, gives the same table, as the greatest ``seq`` of a key
    always wins. Returns the number of files that were read.
    """
    spark = df.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    batch = materialized(latest(df, [key], [seq]).select("*", bucket), "online-batch")
    touched = [r["bucket"] for r in batch.select("bucket").distinct().collect()]  # at most ``buckets``
    there = children(spark, path, "bucket=")
    read = [b for b in touched if f"bucket={b}" in there]
    rows, n_files = batch, 0
    if read:
        old = spark.read.schema(batch.schema).option("basePath", path).parquet(*[f"{path}/bucket={b}" for b in read])
        n_files = len(old.inputFiles())
        rows = latest(batch.unionByName(old), [key], [seq])
    merged = materialized(rows.repartition(len(touched) or 1, "bucket"), "online-merged")
    out = merged.repartition(len(touched) or 1, "bucket").write.mode("overwrite")
    out.option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return n_files


def children(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the entries below a folder, in whatever store it is; none if it does not exist."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not store.exists(folder):
        return []
    names = (entry.getPath().getName() for entry in store.listStatus(folder))
    return sorted(name for name in names if name.startswith(prefix))


def make_folder(spark: SparkSession, path: str) -> None:
    """An empty folder, in whatever store it is, unless it is there: a stream or a read may begin before the first write."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(folder)


def drop_days(spark: SparkSession, path: str, before: str) -> list[str]:
    """Deletes the days of a table partitioned by ``date`` that lie before the given one. No row is read."""
    gone = [name for name in children(spark, path, "date=") if name < f"date={before}"]
    for name in gone:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    return gone


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
