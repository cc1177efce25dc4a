"""All tables of a test folder, each derived once per application and written to the shared folder.

The folder's tables are mapped to the raw inputs, cut into a seed and daily batches with
faults, staged, audited and built into the mart. A table is only derived when it is asked
for; what depends on it reads the written form.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.plans import audit, generator, jobs, mart, staging
from mercata.plans.generator import DAY, SEED, Plan
from mercata.schemas import DYNAMIC_INPUTS, STATIC_INPUTS
from mercata.session import cut_lineage, scratch_path
from mercata.sources import testdata
from mercata.sources.warehouse import Warehouse

# The test orders end on 2001-08-01: two months of daily batches follow the seed.
TEST_PLAN = Plan(first_day=dt.date(2001, 6, 1), last_day=dt.date(2001, 8, 1))


class StoredSource(Mapping):
    """The raw inputs of a folder of test tables; each is mapped and written on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._stored:
            mapped = testdata.SOURCES[name](self.spark, self.sf_dir)
            self._stored[name] = cut_lineage(mapped, f"source-{name}")
        return self._stored[name]

    def read_once(self, name: str) -> DataFrame:
        """An input for readers that take few rows or columns, or one reader: as written if it is, else mapped where it is read."""
        return self._stored[name] if name in self._stored else testdata.SOURCES[name](self.spark, self.sf_dir)

    def __iter__(self):
        return iter(testdata.SOURCES)

    def __len__(self) -> int:
        return len(testdata.SOURCES)


class Workspace:
    """Lazily derived tables of one source."""

    _open: dict[tuple[str, str], "Workspace"] = {}

    def __init__(self, spark: SparkSession, source: Mapping[str, DataFrame], plan: Plan = TEST_PLAN):
        self.spark, self.source, self.plan = spark, source, plan
        self.root = scratch_path(spark, "workspace")
        self.seed_at = plan.first_day - dt.timedelta(days=1)
        self._tables: dict[str, DataFrame] = {}
        self._batches: dict[str, DataFrame] | None = None
        self._seed: dict[str, DataFrame] = {}
        self._seeded: tuple[str, Warehouse] | None = None
        self.stream_root = scratch_path(spark, "stream")  # folder of what streams staged
        self.streamed: set[str] = set()  # inputs whose streams have run
        self.listed: str | None = None  # folder of some inputs as CSV

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Workspace":
        """The workspace of a folder of test tables, shared by all queries of the application."""
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._open:
            cls._open[key] = cls(spark, StoredSource(spark, sf_dir))
        return cls._open[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = f"{self.root}/{name}"
            self._derive(name).write.parquet(path)
            self._tables[name] = self.spark.read.parquet(path)
        return self._tables[name]

    def seeded(self) -> tuple[str, Warehouse]:
        """A warehouse after a seed run from CSV files, and the folder its batches come from."""
        if self._seeded is None:
            root = f"{self.root}/runs"
            generator.write_seed(self.inputs(), f"{root}/seed", self.plan)
            warehouse = Warehouse(self.spark, f"{self.root}/warehouse")
            warehouse.create()
            jobs.run_seed(warehouse, f"{root}/seed")
            self._seeded = root, warehouse
        return self._seeded

    def some(self, *names: str) -> list[DataFrame]:
        return [self[n] for n in names]

    def group(self, prefix: str, names=DYNAMIC_INPUTS) -> dict[str, DataFrame]:
        return {f"{prefix}_{n}": self[f"{prefix}_{n}"] for n in names}

    # -- raw ------------------------------------------------------------------

    def inputs(self) -> Mapping[str, DataFrame]:
        """The source for the seed and the days: each input is read whole once, else some rows or columns of it."""
        if not isinstance(self.source, StoredSource):
            return self.source
        return {n: self.source.read_once(n) for n in self.source}

    def seed(self, name: str) -> DataFrame:
        """One input of the seed."""
        if name not in self._seed:
            self._seed |= generator.seed_batch(self.inputs(), self.plan, [name])
        return self._seed[name]

    @property
    def daily(self) -> dict[str, DataFrame]:
        if self._batches is None:
            self._batches = generator.daily_batches(self.inputs(), self.plan)
        return self._batches

    def batches(self) -> DataFrame:
        """The seed and every day of the plan, with the time each was run."""
        days = self.spark.range(1).select(
            F.explode(F.sequence(F.lit(self.plan.first_day), F.lit(self.plan.last_day))).alias(DAY)
        )
        seed = self.spark.range(1).select(
            F.lit(SEED).alias("batch_id"), F.lit(self.seed_at).cast("timestamp").alias("run_time")
        )
        return seed.unionByName(
            days.select(
                generator.batch_id_of(F.col(DAY)).alias("batch_id"),
                F.col(DAY).cast("timestamp").alias("run_time"),
            )
        )

    def _raw(self, name: str) -> DataFrame:
        seed = self.seed(name).withColumns(
            {"batch_id": F.lit(SEED), "ingested_at": F.lit(self.seed_at).cast("timestamp")}
        )
        if name in STATIC_INPUTS:
            return seed
        days = self.daily[name].withColumns(
            {"batch_id": generator.batch_id_of(F.col(DAY)), "ingested_at": F.col(DAY).cast("timestamp")}
        )
        return seed.unionByName(days.drop(DAY))

    def raw(self, name: str) -> DataFrame:
        """Raw rows of an input: as written where they were asked for by name; one reader does without."""
        known = self._tables.get(f"raw_{name}")
        return self._raw(name) if known is None else known

    # -- staging --------------------------------------------------------------

    def staged(self, name: str, rejects: bool = False) -> staging.Staged:
        """One input staged. Where ``rejects`` are asked for, raw children that are written are read twice for them."""
        if name == "orders":
            return staging.stage_orders(self["raw_orders"])
        written = f"raw_{name}" in self._tables
        hold = partial(cut_lineage, label=f"doubtful-{name}") if rejects and written else None
        return staging.CHILD_STAGERS[name](self.raw(name), self["stg_orders"], hold=hold)

    def _derive(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self._raw(name.removeprefix("raw_"))
        if name.startswith("stg_"):
            source = name.removeprefix("stg_")
            if source in staging.STATIC_STAGERS:
                return staging.STATIC_STAGERS[source](self[f"raw_{source}"])
            return self.staged(source).clean
        return getattr(self, f"_{name}")()

    def _rejected_rows(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.staged(n, rejects=True).rejects for n in DYNAMIC_INPUTS])

    def _load_audit(self) -> DataFrame:
        return audit.audit_batches(
            self.batches(), self.group("raw"), self["rejected_rows"], self.group("stg")
        )

    # -- mart -----------------------------------------------------------------

    def _dim_product(self) -> DataFrame:
        return mart.build_dim_product(*self.some("stg_products", "stg_category_translation"))

    def _dim_seller(self) -> DataFrame:
        return mart.build_dim_seller(self["stg_sellers"])

    def _dim_customer(self) -> DataFrame:
        return mart.build_dim_customer(*self.some("stg_orders", "stg_order_items", "stg_customers"))

    def _fct_order_items(self) -> DataFrame:
        return mart.build_fct_order_items(
            *self.some("stg_order_items", "stg_orders", "stg_customers", "dim_product", "dim_seller")
        )

    def _fct_orders(self) -> DataFrame:
        return mart.build_fct_orders(
            *self.some(
                "stg_orders",
                "stg_customers",
                "stg_order_items",
                "stg_order_payments",
                "stg_order_reviews",
                "dim_customer",
            )
        )
