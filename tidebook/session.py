"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  Batch shuffles start with INITIAL_PARTITIONS unless the caller sets a
# count; AQE merges small partitions and splits skewed joins.  A streaming query fixes the partition
# count of its state (spark.sql.shuffle.partitions) with its first checkpoint, so set that before it.
INITIAL_PARTITIONS = "1000"
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "20000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SETTINGS, **(extra or {})}
    if "spark.sql.shuffle.partitions" not in settings:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = INITIAL_PARTITIONS
    for key, value in settings.items():
        builder = builder.config(key, value)
    ship_package()
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that change results or state layout on a session we did not build."""
    for key in (
        "spark.sql.session.timeZone",
        "spark.sql.streaming.stateStore.providerClass",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
    ):
        spark.conf.set(key, SETTINGS[key])
    ship_package()
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, visible to every executor.

    Only a local session without that setting falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="tidebook-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage where later steps read their input several times; the files outlive
    any lost executor and go when the driver ends.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(target)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package() -> None:
    """Send our functions to executors by value, so that workers need no copy of the package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules["tidebook"])
