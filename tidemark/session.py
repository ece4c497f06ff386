"""Session settings, the shared folder, and staged tables."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_folders: dict[str, str] = {}


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the operators rely on.

    ``master`` and ``shuffle_partitions`` stay unset on a cluster, where the
    submit command names them.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Streaming state lies on disk, not on the heap.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; a cluster must name one,
    because a driver-local folder does not survive the loss of an executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; each call gives another one."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tidemark/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where one result feeds several actions: later plans start from a
    columnar scan that any executor can redo, not from recomputed lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_frame(
    spark: SparkSession, rows: list[dict], columns: pa.Schema, schema: StructType
) -> DataFrame:
    """A few driver-made rows as a local relation, without a Python worker."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, columns), schema)
