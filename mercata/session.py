"""Session set-up and the shared folder that written intermediates go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}
_handed_out: ContextVar[list[str] | None] = ContextVar("scratch paths of the work at hand", default=None)
_tables: dict[str, str] = {}  # names in the catalog of tables below the shared folder, by path

# Everything else is left to the cluster's own settings: executors and memory depend on where the job runs.
# How finely rows are shuffled follows the input, see ``fine_shuffles``.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Generated methods above 8,000 bytes are never compiled by the JVM; rows with many
    # cleaning rules run faster operator by operator than in one method of that size.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "mercata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Rows of text take some ten times their shuffled size when they are sorted, often twice in a stage.
SHUFFLE_TASK = 16 << 20  # bytes that one task reads of a shuffle
INPUT_PER_PARTITION = 4 << 20  # bytes of compressed input; mapped to text and shuffled they stay below ``SHUFFLE_TASK``
# What holds while a query builds its tables, whatever the size of the input.
BUILD_CONF = {
    # Else shuffle files stay until the driver collects its garbage, and a chain of jobs fills the disks with them.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Rows dealt by an order's id stay where they are when they are joined by the id and more.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.parquet.compression.codec": "zstd",
    # Where every task's share of the smaller side is this small, neither side is sorted for the join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": f"{SHUFFLE_TASK}b",
}

SENT_KEYS = 2_000_000  # counted keys up to which they are sent to all tasks (some 200 MB), so that rows stay in place


def sent(keys: DataFrame, n: int) -> DataFrame:
    """The side of a join with ``n`` keys, counted: sent to all tasks if these are few."""
    return F.broadcast(keys) if n <= SENT_KEYS else keys


@contextmanager
def fine_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Shuffles of the work inside are cut so that a task can sort its share in memory, whatever the size of the input.

    Partitions are merged again where they turn out to be small. Shuffle files go with the job that wrote them. The
    caller's settings are put back at the end.
    """
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // INPUT_PER_PARTITION))
    wanted = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{SHUFFLE_TASK}b",
    }
    jvm = spark._jvm.org.apache.spark.network.util.JavaUtils
    before = {k: spark.conf.get(k, None) for k in (*wanted, *BUILD_CONF)}
    for key in BUILD_CONF:
        spark.conf.set(key, BUILD_CONF[key])
    for key in wanted:
        value = before[key]
        if value is None or (jvm.byteStringAsBytes(value) > SHUFFLE_TASK if key.endswith("Bytes") else int(value) < partitions):
            spark.conf.set(key, wanted[key])
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is made, but only in local
    mode: on a cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        application = context.applicationId
        if application not in _local_dirs:
            _local_dirs[application] = tempfile.mkdtemp(prefix="mercata-")
        named = _local_dirs[application]
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, unique to this application."""
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    if (paths := _handed_out.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """A list of the scratch paths that the work inside asks for; other threads' paths are not in it."""
    paths: list[str] = []
    token = _handed_out.set(paths)
    try:
        yield paths
    finally:
        _handed_out.reset(token)


def name_table(path: str, name: str) -> None:
    """Tell that the files at ``path`` are table ``name`` of the catalog, so that it goes when they go."""
    _tables[path] = name


def _delete(spark: SparkSession, path: str) -> None:
    for own in [p for p in _tables if p == path or p.startswith(f"{path}/")]:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop(own)}")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch paths that nothing reads any more, and the catalog's entries for them."""
    for path in paths:
        _delete(spark, path)


def cut_lineage(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as a table below the shared folder and read on from there.

    The rows no longer depend on a re-run of the plan, so partition ids taken before
    the cut stay true even when executors are lost afterwards, and several readers
    share one computation while each still reads only the columns it needs.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote below the shared folder."""
    _delete(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def side_by_side(spark: SparkSession, *work: Callable[[], Any]) -> list[Any]:
    """Run independent actions at the same time, so the small ones do not wait for the large."""
    bound = [inheritable_thread_target(spark)(w) for w in work]
    with ThreadPoolExecutor(max_workers=len(bound)) as pool:
        return [f.result() for f in [pool.submit(b) for b in bound]]
