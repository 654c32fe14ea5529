"""Table writes: partition overwrite, retry-safe append, keyed upsert, compaction."""

from __future__ import annotations

from datetime import date, datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.operators.changes import DELETE, LOG_ORDER, last_changes, to_config
from tidebook.operators.latest import latest_by
from tidebook.schemas import CDC_BRONZE
from tidebook.session import settle, shared_dir
from tidebook.sinks import files
from tidebook.sources.tables import TABLES

TICK_PARTITIONS = ["exchange", "symbol", "event_date"]
BAR_PARTITIONS = ["exchange", "symbol", "event_date"]
BAR_KEY = ["exchange", "symbol", "window_start"]
TICK_KEY = ["exchange", "symbol", "last_update_id"]
_FOLDERS_PER_JOB = 500
STATE_BUCKETS = 64
TARGET_BYTES = 128 * 1024 * 1024  # fixed value: size compaction aims at


def as_view(df: DataFrame, name: str) -> None:
    """A model evaluated on every read, so that its "now" moves."""
    df.createOrReplaceTempView(name)


def as_table(df: DataFrame, path: str, partitions: list[str] | None = None) -> DataFrame:
    """A model stored on every run; returns the stored rows."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_event_date(df: DataFrame, time_column: str) -> DataFrame:
    return df.withColumn("event_date", F.to_date(time_column))


def _balanced(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bring a partition's rows together, but let AQE split the large ones and merge the small."""
    return df.hint("rebalance", *columns)


def overwrite_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace exactly the partitions present in ``df``; repeating the write changes nothing."""
    (
        _balanced(df, partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def append_once(df: DataFrame, path: str, partitions: list[str], key: list[str], batch: str) -> None:
    """Append a streaming batch so that a retried batch adds nothing twice.

    A marker is set before the append.  Finding it means an earlier attempt may have written
    some of the rows, and only then are the stored rows compared by key, within the batch's bounds.
    """
    if not files.touch(df.sparkSession, f"{path}/_batches/{batch}"):
        df = without_stored(df, path, partitions, key)
    _balanced(df, partitions).write.mode("append").partitionBy(*partitions).parquet(path)


def without_stored(df: DataFrame, path: str, partitions: list[str], key: list[str]) -> DataFrame:
    """The rows whose key is not stored yet.

    The batch's smallest and largest value of its date (else of its offset) are literals on the stored
    side, so the read is pruned to those partitions or row groups.
    """
    spark = df.sparkSession
    if not _has_data(spark, path):
        return df
    match = list(dict.fromkeys([*partitions, *key]))
    stored = spark.read.schema(df.schema).parquet(path).select(*match)
    bound = next((c for c in ("event_date", "kafka_offset") if c in match), None)
    if bound:
        low, high = df.agg(F.min(bound), F.max(bound)).first()
        if low is None:
            return df
        stored = stored.where(F.col(bound).between(F.lit(low), F.lit(high)))
    return df.join(stored, match, "left_anti")


def _has_data(spark: SparkSession, path: str) -> bool:
    return any(not name.startswith(("_", ".")) for name in files.children(spark, path))


def append_ticks(ticks: DataFrame, path: str, batch: str) -> None:
    append_once(with_event_date(ticks, "exchange_event_ts"), path, TICK_PARTITIONS, TICK_KEY, batch)


def append_audit(audit: DataFrame, path: str, batch: str) -> None:
    append_once(audit, path, ["symbol"], ["kafka_partition", "kafka_offset"], batch)


def append_bars(bars: DataFrame, path: str) -> None:
    """Append bars whose (exchange, symbol, window start) is not stored yet.

    A stream emits each bar once, so nothing that is stored is rewritten: a crash loses nothing, a
    retried batch adds nothing twice, and a bar that a backfill has stored stays.
    """
    rows = without_stored(with_event_date(bars, "window_start"), path, BAR_PARTITIONS, BAR_KEY)
    _balanced(rows, BAR_PARTITIONS).write.mode("append").partitionBy(*BAR_PARTITIONS).parquet(path)


def upsert_changes(audit: DataFrame, path: str, buckets: int = STATE_BUCKETS) -> None:
    """Fold a batch of change events into the next version of a state table.

    Symbols are dealt into ``buckets`` by their hash.  A version is a folder that holds the buckets its
    batch touched, folded with the newest complete version of each, so that neither reading nor writing
    grows with the untouched part of the state.  The fold keeps the last change of each symbol in log
    order, so folding a retried batch again changes nothing.  Deletions stay as marked rows: an older
    event that arrives later must not bring the symbol back.  ``buckets`` never changes for a table.
    """
    spark = audit.sparkSession
    changes = last_changes(audit)
    bucket = F.pmod(F.xxhash64("symbol"), F.lit(buckets)).cast("int")
    touched = {r[0] for r in changes.select(bucket).distinct().collect()}  # numbers below ``buckets``
    held = state_buckets(spark, path)
    if not touched and complete_versions(spark, path):
        return
    stored = [f"{_version(path, held[b])}/bucket={b}" for b in sorted(touched & set(held))]
    if stored:
        changes = changes.unionByName(spark.read.schema(changes.schema).parquet(*stored))
    latest = latest_by(changes, ["symbol"], LOG_ORDER).withColumn("bucket", bucket)
    earlier = complete_versions(spark, path)
    version = earlier[-1] + 1 if earlier else 0
    _balanced(latest, ["bucket"]).write.mode("overwrite").partitionBy("bucket").parquet(_version(path, version))
    _forget(spark, path, earlier[:-2])


def state_buckets(spark: SparkSession, path: str) -> dict[int, int]:
    """The newest complete version of each bucket that has rows."""
    newest = {}
    for version in complete_versions(spark, path):
        newest |= {b: version for b in _buckets(spark, path, version)}
    return newest


def _buckets(spark: SparkSession, path: str, version: int) -> list[int]:
    names = files.children(spark, _version(path, version))
    return [int(name.split("=", 1)[1]) for name in names if name.startswith("bucket=")]


def _forget(spark: SparkSession, path: str, versions: list[int]) -> None:
    """Remove from old versions the buckets that a later one has."""
    newest = state_buckets(spark, path)
    for version in versions:
        own = _buckets(spark, path, version)
        for b in own:
            if newest[b] > version:
                files.remove(spark, f"{_version(path, version)}/bucket={b}")
        if all(newest[b] > version for b in own):
            files.remove(spark, _version(path, version))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Current config rows: of each bucket its newest complete version."""
    if not complete_versions(spark, path):
        raise FileNotFoundError(f"no complete version below {path}")
    schema = T.StructType([CDC_BRONZE[c] for c in ("symbol", "op", "after_json", *LOG_ORDER)])
    stored = [f"{_version(path, v)}/bucket={b}" for b, v in sorted(state_buckets(spark, path).items())]
    changes = spark.read.schema(schema).parquet(*stored) if stored else spark.createDataFrame([], schema)
    return to_config(changes.where(F.col("op") != DELETE))


def _version(path: str, version: int) -> str:
    return f"{path}/version={version:020d}"


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    found = [name for name in files.children(spark, path) if name.startswith("version=")]
    return sorted(
        int(name.split("=", 1)[1]) for name in found if files.exists(spark, f"{path}/{name}/_SUCCESS")
    )


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Data files below ``path``: ``folder`` and ``bytes``.  Contents are not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("bytes"))
    )
    return listing.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "bytes")


def small_file_folders(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Folders that hold more files than their size needs."""
    needed = F.ceil(F.sum("bytes") / F.lit(target_bytes))
    return (
        file_sizes(spark, path)
        .groupBy("folder")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), needed.alias("needed_files"))
        .where(F.col("files") > F.col("needed_files"))
    )


def compact(
    spark: SparkSession,
    path: str,
    partitions: list[str],
    target_bytes: int = TARGET_BYTES,
    before: date | None = None,
) -> DataFrame:
    """Rewrite closed partitions that have too many small files; returns what was found before.

    Only dates before ``before`` (today, UTC) are touched: they are read, copied to the shared folder, and put back
    in as many files as their size needs by dynamic partition overwrites.  Nothing may write
    to those dates meanwhile; a table that is written at any date needs a table format's atomic swap.
    If the overwrite fails, the copy in the shared folder stays and the error names it.
    """
    today = datetime.now(timezone.utc).date()
    if before is not None and before > today:
        raise ValueError(f"dates from {today} on are still written to")
    closed = small_file_folders(spark, path, target_bytes)
    if "event_date" in partitions:
        day = F.to_date(F.regexp_extract("folder", r"/event_date=([^/]+)", 1))
        closed = closed.where(day < F.lit(before or today))
    found = settle(closed, "small-folders")
    batch: list = []
    for row in found.toLocalIterator():
        batch.append(row)
        if len(batch) == _FOLDERS_PER_JOB:
            _rewrite(spark, path, partitions, batch, target_bytes)
            batch = []
    if batch:
        _rewrite(spark, path, partitions, batch, target_bytes)
    return found


def compact_all(spark: SparkSession, paths: dict[str, str], before: date | None = None) -> dict[str, int]:
    """Compact each registered table that has a folder in ``paths``; the folders rewritten, by table."""
    unknown = set(paths) - set(TABLES)
    if unknown:
        raise KeyError(f"not registered: {sorted(unknown)}")
    return {
        name: compact(spark, path, TABLES[name]["partitions"], before=before).count()
        for name, path in paths.items()
        if TABLES[name]["partitions"]
    }


def _rewrite(spark: SparkSession, path: str, partitions: list[str], found: list, target_bytes: int) -> None:
    """Compact some folders.  Partition values are read as text, so that their spelling stays."""
    read = spark.read.option("basePath", path)
    folders = [r["folder"] for r in found]
    data = [f for f in read.parquet(*folders).schema.fields if f.name not in partitions]
    schema = T.StructType([*data, *[T.StructField(p, T.StringType()) for p in partitions]])
    rows = read.schema(schema).parquet(*folders)
    # Each file wanted is one task of the overwrite, and each task one file: hashed together, several would share a
    # task, which sorts all it gets.  The file follows from the row's position: a recomputed task places its rows as
    # before.  Folders (at most _FOLDERS_PER_JOB) are numbered by a window.
    sizes = rows.groupBy(*partitions, "_metadata.file_path").agg(F.max("_metadata.file_size").alias("bytes"))
    wanted = sizes.groupBy(*partitions).agg(F.ceil(F.sum("bytes") / F.lit(target_bytes)).alias("_files"))
    before = Window.orderBy(*partitions).rowsBetween(Window.unboundedPreceding, -1)
    wanted = wanted.withColumn("_first", F.coalesce(F.sum("_files").over(before), F.lit(0)))
    wanted = wanted.select(*[F.col(p).alias(f"_of_{p}") for p in partitions], "_files", "_first")
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    placed = rows.select("*", place.alias("_place")).join(
        F.broadcast(wanted), reduce(and_, [F.col(p).eqNullSafe(F.col(f"_of_{p}")) for p in partitions])
    )
    shard = (F.col("_first") + F.pmod("_place", "_files")).cast("int")
    staged = shared_dir(spark, "compacted")
    placed.select(*rows.columns, shard.alias("_shard")).write.parquet(staged)
    total = sum(r["needed_files"] for r in found)
    copy = spark.read.parquet(staged).repartitionById(total, "_shard").drop("_shard")
    try:
        copy.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    except Exception as error:
        raise RuntimeError(f"partitions of {path} were not put back; their rows are in {staged}") from error
    files.remove(spark, staged)
