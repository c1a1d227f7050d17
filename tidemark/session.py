"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


# Scratch folders of local sessions that name none, by application.
_LOCAL_SCRATCH: dict[str, str] = {}


def local_session(cores: int | str = 8, app: str = "tidemark", memory: str = "16g") -> SparkSession:
    """A local session for tests and the benchmark, with a scratch folder; clusters bring their own."""
    scratch = os.environ.get("TIDEMARK_SCRATCH") or tempfile.mkdtemp(prefix="tidemark-")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run, below the shared folder the session names."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    """Where this package writes, below the shared folder the session names.

    A local session that was made elsewhere and names none gets a temporary folder, once: on a
    cluster the executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        name_of = spark.sparkContext.applicationId
        root = _LOCAL_SCRATCH.get(name_of) or _LOCAL_SCRATCH.setdefault(name_of, tempfile.mkdtemp(prefix="tidemark-"))
    return f"{root.rstrip('/')}/tidemark"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands this package to the Python workers through Spark, unless they find it by themselves."""
    root, context = Path(__file__).resolve().parents[1], spark.sparkContext
    found = [Path.cwd(), *map(Path, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    if root in [p.resolve() for p in found] or context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    # Spark copies the archive to wherever the workers run.
    context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/tidemark", "zip", root, "tidemark"))


def split_count(spark: SparkSession) -> int:
    """How many pieces to cut a global order or a hot key into: as many as the session has shuffle partitions."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def materialized(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table: for results that several later jobs read.

    It survives lost executors, cuts the lineage, and later reads prune its columns.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
