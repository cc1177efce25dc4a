"""The warehouse folder: one parquet table per name, in layers raw, staging, mart and ops.

Tables split by batch keep each batch in its own folder; loading a batch again replaces
that folder, so a retry leaves no second copy. Other tables are written whole to a new
version folder, and the highest version that was finished is the current one.

Later batches change some rows of the order fact and of the customers. These two, and what a batch looks up in
history, lie in buckets of their keys (see ``keyed_table``): a batch reads and rewrites the buckets of its
own keys, and no others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.schemas import DYNAMIC_INPUTS, KEYED, TABLES, conform
from mercata.sources.batches import list_folders, path_exists, remove_path
from mercata.sources.keyed_table import KeyedTable

VERSION = "v="
KEPT_VERSIONS = 2


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        """``buckets`` of each keyed table when it is next built: choose it so that a task can rewrite one."""
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._watchers: dict[str, Callable[[Warehouse], None]] = {}

    def watch(self, name: str, told: Callable[[Warehouse], None]) -> None:
        """Call ``told`` now and after every run that changed tables; one watcher per name."""
        self._watchers[name] = told
        told(self)

    def changed(self) -> None:
        """A run is over: watchers look at the tables anew."""
        for told in self._watchers.values():
            told(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{TABLES[name].layer}/{name}"

    def keyed(self, name: str) -> KeyedTable:
        return KeyedTable(self.spark, self.path(name), TABLES[name].ddl, KEYED[name], self.buckets)

    def _delete(self, path: str) -> None:
        remove_path(self.spark, path)

    # -- reading --------------------------------------------------------------

    def _versions(self, name: str) -> list[str]:
        folder = self.path(name)
        found = [f"{folder}/{v}" for v in list_folders(self.spark, folder) if v.startswith(VERSION)]
        return [v for v in found if path_exists(self.spark, f"{v}/_SUCCESS")]

    def read(self, name: str) -> DataFrame:
        """The current rows of a table; a table never written has none."""
        spec = TABLES[name]
        if name in KEYED:
            return self.keyed(name).read().select(*spec.columns)
        if spec.by_batch:
            source = self.path(name) if self.batch_ids(name) else None
        else:
            source = next(reversed(self._versions(name)), None)
        if source is None:
            return self._no_rows(name)
        return self.spark.read.schema(spec.ddl).parquet(source).select(*spec.columns)

    def _no_rows(self, name: str) -> DataFrame:
        """The filter tells Spark that there are none, so it leaves out joins with them."""
        return self.spark.createDataFrame([], TABLES[name].ddl.replace(" not null", "")).where(F.lit(False))

    def batch_ids(self, name: str) -> list[str]:
        """Batches of a table; one entry per batch."""
        if name in KEYED:
            return [r["batch_id"] for r in self.read(name).select("batch_id").distinct().orderBy("batch_id").collect()]
        prefix = "batch_id="
        return [n.removeprefix(prefix) for n in list_folders(self.spark, self.path(name)) if n.startswith(prefix)]

    def has_batch(self, name: str, batch_id: str) -> bool:
        return path_exists(self.spark, f"{self.path(name)}/batch_id={batch_id}")

    def read_batch(self, name: str, batch_id: str) -> DataFrame:
        """One batch of a table split by batch; no other folder is looked at."""
        spec = TABLES[name]
        if not self.has_batch(name, batch_id):
            return self._no_rows(name)
        rows = self.spark.read.schema(spec.ddl).option("basePath", self.path(name))
        return rows.parquet(f"{self.path(name)}/batch_id={batch_id}").select(*spec.columns)

    # -- writing --------------------------------------------------------------

    def replace(self, name: str, df: DataFrame) -> None:
        """Write a whole table as its next version; readers of the last one are not disturbed."""
        versions = self._versions(name)
        latest = int(versions[-1].rsplit(VERSION, 1)[1]) if versions else 0
        target = f"{self.path(name)}/{VERSION}{latest + 1:06d}"
        conform(df, name).write.mode("overwrite").parquet(target)
        for old in versions[: 1 - KEPT_VERSIONS]:
            self._delete(old)

    def replace_batch(self, name: str, df: DataFrame, batch_id: str) -> None:
        """Write one batch of a table, in place of what an earlier run of it left."""
        rows = conform(df, name).drop("batch_id")
        rows.write.mode("overwrite").parquet(f"{self.path(name)}/batch_id={batch_id}")

    def replace_all_batches(self, name: str, df: DataFrame) -> None:
        """Replace a batch-wise table as a whole, by rows that were not read from it."""
        (
            conform(df, name)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("batch_id")
            .parquet(self.path(name))
        )

    def drop_batches(self, name: str, batch_ids: Iterable[str]) -> None:
        for batch_id in batch_ids:
            self._delete(f"{self.path(name)}/batch_id={batch_id}")

    def clear(self, name: str) -> None:
        self._delete(self.path(name))

    def create(self, names: Iterable[str] = tuple(TABLES)) -> None:
        """(Re)create tables without rows; what they held is dropped."""
        for name in names:
            self.clear(name)
            if not TABLES[name].by_batch and name not in KEYED:
                self.replace(name, self.read(name))

    def state(self) -> dict[str, list]:
        """What a reader would see at this moment, by table: batches, versions or generations."""
        found = {}
        for name, spec in TABLES.items():
            if name in KEYED:
                found[name] = self.keyed(name).generations()[-1:]
            else:
                found[name] = self.batch_ids(name) if spec.by_batch else self._versions(name)[-1:]
        return found

    def tables(self, *names: str) -> dict[str, DataFrame]:
        return {n: self.read(n) for n in names}


RAW_DYNAMIC = tuple(f"raw_{n}" for n in DYNAMIC_INPUTS)
STAGING_DYNAMIC = tuple(f"stg_{n}" for n in DYNAMIC_INPUTS)
