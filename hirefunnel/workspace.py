"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

ADAPTIVE = "spark.sql.adaptive.enabled"

# Settings the jobs expect. The time zone decides which hour an event belongs to; adaptive
# execution sizes shuffles by what arrives and splits hot partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    ADAPTIVE: "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# A trigger saves what it changed instead of the files of the state (Spark saves those now and then,
# beside the triggers) and does not look up each key once more to count the state's rows. Changes that
# are not in files yet take a few MB of a partition's memory at most.
STATE = {
    STATE_STORE: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
}


#: Where scratch folders go if the cluster names no shared folder.
SCRATCH_DIR = "hirefunnel.scratch.dir"


def configure(spark: SparkSession, scratch_dir: str | None = None) -> SparkSession:
    """Session settings. `scratch_dir` is a folder that all executors share; it is needed where
    `spark.checkpoint.dir` is not set, and that setting goes first."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if scratch_dir:
        spark.conf.set(SCRATCH_DIR, scratch_dir)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the time of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def setting(spark: SparkSession, key: str, value: str):
    """A session setting for the time of a block."""
    return settings(spark, {key: value})


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder the cluster names in spark.checkpoint.dir, or else below
    the `scratch_dir` of `configure`.

    A machine-local folder is taken only where both are absent and all of Spark runs in this
    one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_DIR, None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="hirefunnel-")
