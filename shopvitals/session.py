"""Session settings every job relies on, and the shared folder jobs write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def pin_session(spark: SparkSession) -> SparkSession:
    """Set the runtime options results depend on; safe on a session owned by someone else."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A repeated JSON key keeps its last value.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def pin_streaming(spark: SparkSession) -> SparkSession:
    """Keep streaming state on local disk with changelogs in the checkpoint, not on the heap.

    To be set before a query's first start; a checkpoint keeps the store it began with.
    """
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session without that setting
    falls back to a temporary folder; a cluster job without it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="shopvitals-")
    return f"{root.rstrip('/')}/shopvitals/{label}-{uuid.uuid4().hex}"


def materialize_at(frame: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write an intermediate result to the shared folder; the frame to go on with, and its folder.

    For results that several branches of a plan read: the input is scanned once, a lost
    executor costs no recomputation, and the planner knows the size of what it joins.
    The folder is for ``discard`` once nothing reads it any more.
    """
    path = shared_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path), path


def materialize(frame: DataFrame, label: str) -> DataFrame:
    """As ``materialize_at``, where the caller's result still reads the folder when it returns."""
    return materialize_at(frame, label)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``materialize_at`` wrote, through Spark's own file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def side_by_side(job: Callable[[Any], Any], items: Iterable[Any]) -> list[Any]:
    """Start one Spark job per item at the same time; results in the order of the items.

    For writes that share nothing: while one has few tasks left, the others use the cluster.
    """
    items = list(items)
    with ThreadPoolExecutor(max(1, min(8, len(items)))) as pool:
        return list(pool.map(job, items))
