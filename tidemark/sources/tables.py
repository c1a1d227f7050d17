"""Scans with explicit schemas: no footer is read to infer one, and column pruning stays Spark's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
_ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
_LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz"
)
_LABELS = "doc_id bigint, quality int, toxic int"
_DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

SCHEMAS = {
    "events": _EVENTS,
    "orders": _ORDERS,
    "lineitem": _LINEITEM,
    "labels": _LABELS,
    "documents": _DOCUMENTS,
}


def schema_of(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(schema_of(name)).parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str, files_a_batch: int | None = None) -> DataFrame:
    """The same table as a file stream; new files of that name are picked up as they land.

    A backlog is taken in one batch, or in batches of so many files.
    """
    reader = spark.readStream.schema(schema_of(name)).option("pathGlobFilter", f"{name}*.parquet")
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.parquet(folder)


def stream_folder(spark: SparkSession, path: str, name: str, files_a_batch: int | None = None) -> DataFrame:
    """All files of a folder with the columns of table ``name`` as a stream, in one batch or so many files a batch."""
    reader = spark.readStream.schema(schema_of(name))
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.parquet(path)
