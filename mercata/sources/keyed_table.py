"""Tables laid out by the hash of a key, of which a batch reads and writes only the buckets of its keys.

    <table>/g=<generation>/bucket=<n>/part-*.parquet     rows; a generation holds the buckets that one commit wrote
    <table>/gone/g=<generation>/part-*.parquet           keys whose rows in older generations no longer count
    <table>/manifest/<generation>.json                   for every bucket the generations that are current
    <table>/batches/<batch>.json                         the buckets that hold, or once held, rows of a batch

A commit writes the buckets it changes to a generation of its own and then its manifest; the highest manifest counts.
A run that breaks off before leaves files that no manifest names. Buckets that a commit does not touch stay as they are,
byte for byte. Rows that replace none are added to a bucket as one more generation, without a rewrite; a bucket of
``MERGED_PARTS`` generations is rewritten as one. Rows that replace others are added in the same way where buckets are
large: their keys are written beside them, and readers leave out what older generations have of these. ``buckets`` is fixed when a table is built and should follow its size: a bucket is what one task
rewrites. Looking keys up collects bucket numbers only.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.sources.batches import list_files, list_folders, path_exists, read_text, remove_path, size_of, write_text

KEPT_GENERATIONS = 2
MERGED_PARTS = 16  # generations a bucket may be spread over
LARGE_BUCKET = 8 << 20  # bytes; buckets of this size on average are added to, or rewritten without a shuffle
FEW_KEYS = 500_000  # counted keys up to which they are sent to all tasks, so that a table of any size stays in place
GONE = "gone"  # in a manifest: how many keys each generation has replaced in older ones


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, ddl: str, key: str, buckets: int = 16):
        self.spark, self.root, self.ddl, self.key, self._buckets = spark, root, ddl.replace(" not null", ""), key, buckets
        schema = spark.createDataFrame([], self.ddl).schema
        self.columns, self._key_ddl = schema.names, f"{key} {schema[key].dataType.simpleString()}"

    # -- manifests ------------------------------------------------------------

    def generations(self) -> list[int]:
        """Commits that can still be read, oldest first."""
        return [int(n.removesuffix(".json")) for n in list_files(self.spark, f"{self.root}/manifest") if n.endswith(".json")]

    def _manifest(self, generation: int | None = None) -> dict:
        """The state a reader sees: the number of buckets, and the generations of each that has rows."""
        if generation is None:
            generation = max(self.generations(), default=None)
        if generation is None:
            return {"generation": 0, "buckets": self._buckets, "of": {}, GONE: {}}
        told = json.loads(read_text(self.spark, f"{self.root}/manifest/{generation:09d}.json"))
        of = {int(b): g if isinstance(g, list) else [g] for b, g in told["of"].items()}
        return told | {"generation": generation, "of": of, GONE: {int(g): n for g, n in told.get(GONE, {}).items()}}

    def _commit(self, state: dict) -> None:
        # Keys are kept as long as some bucket has rows of an older generation.
        oldest = min((g for parts in state["of"].values() for g in parts), default=state["generation"])
        gone = {g: n for g, n in state.get(GONE, {}).items() if g > oldest}
        told = {"buckets": state["buckets"], "of": state["of"], GONE: gone}
        write_text(self.spark, f"{self.root}/manifest/{state['generation']:09d}.json", json.dumps(told))
        known = sorted(self.generations())
        kept = {pair for k in known[-KEPT_GENERATIONS:] for pair in self._parts(k)}
        named = {g for k in known[-KEPT_GENERATIONS:] for g in self._manifest(k)[GONE]}
        for k in known[:-KEPT_GENERATIONS]:
            for g in set(self._manifest(k)[GONE]) - named:
                remove_path(self.spark, self._gone(g))
            for b, g in self._parts(k) - kept:
                remove_path(self.spark, f"{self.root}/g={g:09d}/bucket={b}")
            remove_path(self.spark, f"{self.root}/manifest/{k:09d}.json")

    def _gone(self, generation: int) -> str:
        return f"{self.root}/{GONE}/g={generation:09d}"

    def _parts(self, generation: int) -> set[tuple[int, int]]:
        """The buckets and generations that a manifest names."""
        return {(b, g) for b, parts in self._manifest(generation)["of"].items() for g in parts}

    # -- reading --------------------------------------------------------------

    def bucket_of(self, key: str | Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def _rows(self, state: dict, wanted: Iterable[int] | None = None) -> DataFrame:
        chosen = sorted(state["of"] if wanted is None else set(wanted) & set(state["of"]))
        if not chosen:
            # The filter tells Spark that there are no rows, so it leaves out joins with them.
            return self.spark.createDataFrame([], self.ddl).where(F.lit(False))
        paths = [f"{self.root}/g={g:09d}/bucket={b}" for b in chosen for g in state["of"][b]]
        gone = [g for g in state[GONE] if any(part < g for b in chosen for part in state["of"][b])]
        if not gone:
            return self.spark.read.schema(self.ddl).parquet(*paths)
        # Both folders name the generation: a row goes if a later one has its key. There are at most FEW_KEYS of these.
        rows = self.spark.read.schema(f"{self.ddl}, g int").option("basePath", self.root).parquet(*paths)
        keys = self.spark.read.schema(f"{self._key_ddl}, g int").option("basePath", f"{self.root}/{GONE}")
        later = keys.parquet(*[self._gone(g) for g in gone]).select(F.col(self.key).alias("_gone"), F.col("g").alias("_later"))
        replaced = (F.col(self.key) == F.col("_gone")) & (F.col("g") < F.col("_later"))
        return rows.join(F.broadcast(later), replaced, "left_anti").select(*self.columns)

    def _size(self, state: dict, wanted: Iterable[int]) -> int:
        """Bytes of the files of some buckets."""
        parts = [(b, g) for b in wanted for g in state["of"].get(b, ())]
        return sum(size_of(self.spark, f"{self.root}/g={g:09d}/bucket={b}") for b, g in parts)

    def read(self) -> DataFrame:
        """All rows, as the newest manifest at this moment has them."""
        return self._rows(self._manifest())

    def exists(self) -> bool:
        return bool(self.generations())

    def _touched(self, keys: DataFrame, state: dict) -> tuple[set[int], DataFrame, int]:
        """The buckets of ``keys``, the keys as the side of a join, sent to all tasks if counted to be few, and the count."""
        bucket = self.bucket_of(self.key, state["buckets"]).alias("b")
        found = keys.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).collect()  # bucket numbers
        sought, n = keys.select(self.key), sum(r["n"] for r in found)
        return {r["b"] for r in found}, F.broadcast(sought) if n <= FEW_KEYS else sought, n

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the keys in ``keys`` (column ``key``), read from their buckets alone."""
        state = self._manifest()
        if not state["of"]:
            return self._rows(state)
        touched, sought, _ = self._touched(keys, state)
        return self._rows(state, touched).join(sought, self.key, "left_semi").select(*self.columns)

    # -- writing --------------------------------------------------------------

    def rebuild(self, rows: DataFrame) -> None:
        """Replace all rows. The number of buckets is the one this object was made with.

        If that is another than before, it is no longer known where earlier batches are: take one of them out
        before it is loaded again with other content.
        """
        if self._manifest()["buckets"] != self._buckets:
            remove_path(self.spark, f"{self.root}/batches")
        generation = max(self.generations(), default=0) + 1
        state = {"generation": generation, "buckets": self._buckets}
        self._commit(state | {"of": {b: [generation] for b in self._write(rows, state)}})

    def _write(self, rows: DataFrame, state: dict, stay: DataFrame | None = None) -> list[int]:
        """Write rows to the buckets of a new generation; which buckets got any. ``stay`` is written as it lies in files."""
        path = f"{self.root}/g={state['generation']:09d}"
        bucket = self.bucket_of(self.key, state["buckets"]).alias("bucket")
        # Split evenly within buckets too, so that neither a large bucket nor a hot key waits for one task.
        spread = rows.select(*self.columns, bucket).hint("rebalance", F.col("bucket"))
        if stay is not None:
            spread = spread.unionByName(stay.select(*self.columns, bucket))
        spread.write.mode("overwrite").partitionBy("bucket").parquet(path)
        return [int(n.removeprefix("bucket=")) for n in list_folders(self.spark, path) if n.startswith("bucket=")]

    def fold(self, changed: DataFrame, batch_id: str, keys: DataFrame | None = None, replace: bool = True) -> None:
        """Bring in what a batch changes: its earlier rows go, wherever an earlier run of it put them, and ``changed`` comes.

        With ``replace`` the rows of other batches that have a key of ``changed`` or of ``keys`` go as well. A table
        without a batch column knows rows by key only. Where nothing goes, only ``changed`` is written; where buckets are
        large and rows go by a few keys, ``changed`` and these keys.
        """
        state = self._manifest()
        gone = changed.select(self.key) if keys is None else changed.select(self.key).unionByName(keys.select(self.key))
        touched, sought, n_gone = self._touched(gone, state)
        touched = set(self._noted(batch_id, touched))
        if not touched:
            return
        fresh = state | {"generation": max(self.generations(), default=0) + 1}
        stay = self._rows(state, touched)
        full = any(len(state["of"].get(b, ())) >= MERGED_PARTS for b in touched)
        large = self._size(state, touched) >= LARGE_BUCKET * len(touched)
        few = n_gone + sum(state[GONE].values()) <= FEW_KEYS
        again = "batch_id" in self.columns and (not replace or large) and not stay.where(F.col("batch_id") == batch_id).isEmpty()
        if (not replace or (large and few)) and not full and not again:
            if replace:
                gone.select(self.key).distinct().write.mode("overwrite").parquet(self._gone(fresh["generation"]))
                fresh = fresh | {GONE: state[GONE] | {fresh["generation"]: n_gone}}
            added = self._write(changed, fresh)
            of = {b: [*state["of"].get(b, ()), fresh["generation"]] for b in added}
            self._commit(fresh | {"of": state["of"] | of})
            return
        if "batch_id" in self.columns:
            stay = stay.where(F.col("batch_id") != batch_id)
        if replace:
            stay = stay.join(sought, self.key, "left_anti")
        if large:
            written = self._write(changed, fresh, stay)
        else:
            written = self._write(stay.select(*self.columns).unionByName(changed.select(*self.columns)), fresh)
        of = {b: g for b, g in state["of"].items() if b not in touched}
        self._commit(fresh | {"of": of | {b: [fresh["generation"]] for b in written}})

    def rows_of_batch(self, batch_id: str) -> DataFrame:
        """The rows that the last finished run of a batch left, from the buckets it has touched."""
        path = f"{self.root}/batches/{batch_id}.json"
        noted = json.loads(read_text(self.spark, path)) if path_exists(self.spark, path) else []
        return self._rows(self._manifest(), noted).where(F.col("batch_id") == batch_id)

    def _noted(self, batch_id: str, touched: set[int]) -> list[int]:
        """All buckets that a batch has touched so far, these included; noted before they are written."""
        path = f"{self.root}/batches/{batch_id}.json"
        before = set(json.loads(read_text(self.spark, path))) if path_exists(self.spark, path) else set()
        told = sorted(before | touched)
        write_text(self.spark, path, json.dumps(told))
        return told
