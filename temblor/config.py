"""Session defaults, connection settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Iterator, Mapping

from pyspark.sql import SparkSession

ROCKSDB_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SESSION_DEFAULTS = {
    # year(), month(), datediff() and window() all depend on the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

STREAM_DEFAULTS = {
    # Join and window state outgrows the heap long before it outgrows local disks.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_STATE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Moments as 64-bit numbers; Spark's default of 12 bytes takes half as long again to write.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(
    app_name: str, master: str | None = None, hive: bool = False, **conf: str
) -> SparkSession:
    """A session with the defaults above; `conf` entries override them.

    `hive` keeps the catalog in the metastore that the cluster is configured with; without it,
    table names are forgotten when the session ends, and tables live on by their path alone.
    """
    builder = SparkSession.builder.appName(app_name)
    if hive:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Apply runtime settings for a block, then put the former ones back."""
    former = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in former.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path in the folder that all executors can reach.

    The cluster names that folder in `spark.checkpoint.dir`. A machine-local temporary
    folder is used only where the setting is absent and the master is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="temblor-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class JdbcTarget:
    """Where relational results go. Credentials come from the caller, never from code."""

    url: str
    driver: str = "org.postgresql.Driver"
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    max_connections: int = 16
    batch_size: int = 10_000
    extra: Mapping[str, str] = field(default_factory=dict)

    def options(self, table: str) -> dict[str, str]:
        settings = {
            "url": self.url,
            "driver": self.driver,
            "dbtable": table,
            # Bounds the number of simultaneous connections whatever the partition count.
            "numPartitions": str(self.max_connections),
            "batchsize": str(self.batch_size),
        }
        if self.user is not None:
            settings["user"] = self.user
        if self.password is not None:
            settings["password"] = self.password
        return {**settings, **self.extra}


@dataclass(frozen=True)
class KafkaTopic:
    """One topic on one broker list."""

    servers: str
    topic: str
    extra: Mapping[str, str] = field(default_factory=dict)

    def read_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "subscribe": self.topic, **self.extra}

    def write_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "topic": self.topic, **self.extra}
