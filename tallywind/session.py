"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Settings every job needs: one time zone, runtime re-planning, date folders listed
# by some tasks instead of one each, and a state store that keeps large key counts
# off the JVM heap.
ENGINE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass(frozen=True)
class ObjectStore:
    """An S3-compatible store. Keys are read from the named environment variables."""

    endpoint: str
    access_key_env: str | None = None
    secret_key_env: str | None = None
    path_style: bool = True
    ssl: bool = True

    def settings(self) -> dict[str, str]:
        prefix = "spark.hadoop.fs.s3a."
        found = {
            prefix + "endpoint": self.endpoint,
            prefix + "path.style.access": str(self.path_style).lower(),
            prefix + "connection.ssl.enabled": str(self.ssl).lower(),
        }
        for setting, variable in (
            ("access.key", self.access_key_env),
            ("secret.key", self.secret_key_env),
        ):
            if variable is not None:
                found[prefix + setting] = os.environ[variable]
        return found


def build_session(
    app_name: str,
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    object_store: ObjectStore | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session. `shuffle_partitions` also fixes the number of state
    partitions of a new streaming query, so size it for the cluster before the
    first start; AQE coalesces it again for batch queries."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = dict(ENGINE_SETTINGS)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if object_store is not None:
        settings.update(object_store.settings())
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event times carry no zone and are read as UTC, whatever the host says. This
    changes the session it is given; jobs get a session of their own that is so set."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, from `spark.checkpoint.dir`. Only a
    local master may fall back to a temporary folder of this machine."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tallywind-")
    return _local_root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared root that no other run uses. Nothing is created."""
    return f"{shared_root(spark)}/tallywind/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made and no longer needs."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file that says something is done."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True).close()


def marked(spark: SparkSession, path: str) -> bool:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)
