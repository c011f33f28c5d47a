"""A workspace binds a session, a source of bronze tables and a reporting date.

Silver tables and gold marts are registered in a catalog together with the tables they read.
``Workspace.table`` composes them lazily, so one query becomes one Catalyst plan;
``Workspace.refresh`` writes chosen tables (and what they need) to Parquet in dependency order,
after which every reader takes the written table instead of recomputing it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession

from pcmarts.operators.jobs import side_by_side
from pcmarts.sources.tables import current, new_version, publish, remove, scratch, versions

CATALOG: dict[str, "TableDef"] = {}

# the silver tables an hourly feed run renews
EVENT_TABLES = ("weather_observations", "catastrophe_events", "earthquake_events", "noaa_alerts", "news_events")

RULE_COUNTS = "run string, table_name string, rule string, passed bigint, failed bigint"

# the large tables that meet on the policy key
POLICY_KEYED = ("dim_policy", "fact_premium", "fact_claim", "fact_exposure")


@dataclass(frozen=True)
class TableDef:
    name: str
    layer: str
    needs: tuple[str, ...]
    build: Callable[["Workspace"], DataFrame]
    counted: Callable[["Workspace", Observation], DataFrame] | None = None


def table(name: str, layer: str, needs: Iterable[str] = (), counted=None):
    """Register a builder ``(workspace) -> DataFrame`` and the tables it reads.

    ``counted`` builds the same table and counts rule violations on the given observation.
    """

    def register(build):
        CATALOG[name] = TableDef(name, layer, tuple(needs), build, counted)
        return build

    return register


def configure(spark: SparkSession) -> SparkSession:
    """The session settings results and hot keys depend on: UTC, adaptive execution, its skew handling.

    Sizes (broadcast limits, partitions) are the deployment's and stay as they are.
    """
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }.items():
        spark.conf.set(key, value)
    return spark


@dataclass
class Workspace:
    spark: SparkSession
    bronze_reader: Callable[[str], DataFrame]
    as_of: date = field(default_factory=date.today)
    root: str | None = None
    _memo: dict[str, DataFrame] = field(default_factory=dict)
    _staged: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self):
        import pcmarts.plans  # noqa: F401  (fills the catalog)

        configure(self.spark)

    def bronze(self, name: str) -> DataFrame:
        key = f"bronze.{name}"
        if key not in self._memo:
            self._memo[key] = self.bronze_reader(name)
        return self._memo[key]

    def table(self, name: str) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = CATALOG[name].build(self)
        return self._memo[name]

    def staged(self, name: str, write: Callable[[str], DataFrame]) -> DataFrame:
        """What the plan of the named table needs written once; ``write`` fills a fresh scratch folder and reads it back.

        The folder is removed when ``refresh`` has published the table, else by ``close``.
        """
        key = f"staged.{name}"
        if key not in self._memo:
            folder = scratch(self.spark, name)
            self._staged.setdefault(name, []).append(folder)
            self._memo[key] = write(folder)
        return self._memo[key]

    def forget_staged(self) -> None:
        """Build the tables that have something written for their plans anew, with it, when they are asked for again."""
        self.forget(name for name in list(self._staged) if f"staged.{name}" in self._memo)

    def close(self) -> None:
        """Remove the scratch folders of this workspace. Plans of tables that read them cannot be run any more."""
        for name, folders in self._staged.items():
            for folder in folders:
                remove(self.spark, folder)
            self.forget([name])
        self._staged.clear()

    def path(self, name: str) -> str:
        if not self.root:
            raise ValueError("this workspace has no root folder to write to")
        return f"{self.root.rstrip('/')}/{CATALOG[name].layer}/{name}"

    def refresh(
        self, names: Iterable[str] | None = None, partition_by: dict | None = None, upstream: bool = True
    ) -> list[str]:
        """Write tables and everything they need, in dependency order, tables of one level side by side; return what was written.

        A table is written as a new version beside the ones before, which stay readable; readers take
        the newest version that is complete, so a failed write changes nothing. The versions before
        the last one are removed. Rule violations of this run are appended to ``rule_counts``.
        A refreshed table is read back from its files, so later tables carry no lineage beyond it
        and a lost executor never costs more than one stage of one table. Without ``upstream`` only
        the named tables are written and their other inputs are read as they lie under the root:
        the hourly run of the feeds is ``refresh(downstream(EVENT_TABLES), upstream=False)``.
        """
        names = list(names if names is not None else CATALOG)
        order = build_order(names)
        if not upstream:
            self.attach([n for n in order if n not in names])
            order = [n for n in order if n in names]
        self.forget(order)
        run, counts = uuid.uuid4().hex, []
        for level in levels(order):
            frames = {}
            for name in level:  # plans are built one after the other, written side by side
                made, seen = CATALOG[name], Observation(f"rules_{name}")
                frames[name] = (made.counted(self, seen) if made.counted else self.table(name), seen)
                self._memo[name] = frames[name][0]
            paths = side_by_side({n: partial(publish, df, self.path(n), (partition_by or {}).get(n, ())) for n, (df, _) in frames.items()})
            for name, (_, seen) in frames.items():
                self._memo[name] = self.spark.read.parquet(paths[name])
                if f"staged.{name}" in self._memo:  # written in this run, and read for the last time
                    del self._memo[f"staged.{name}"]
                    remove(self.spark, self._staged[name].pop())
                if CATALOG[name].counted:
                    failed = {k.removesuffix("__failed"): n for k, n in seen.get.items() if k.endswith("__failed")}
                    counts += [(run, name, rule, seen.get["rows"] - n, n) for rule, n in failed.items()]
        if counts:
            rows = self.spark.createDataFrame(counts, RULE_COUNTS)
            rows.coalesce(1).write.mode("append").parquet(f"{self.root.rstrip('/')}/rule_counts")
        return order

    def forget(self, names: Iterable[str]) -> None:
        """Drop the plans of the named tables and of all that read them: they are built anew when asked for."""
        for name in downstream(names):
            self._memo.pop(name, None)
            self._memo.pop(f"staged.{name}", None)

    def refresh_bucketed(self, buckets: int, names: Iterable[str] = POLICY_KEYED, key: str = "policy_id") -> list[str]:
        """Write tables as catalog tables hashed and sorted by one key, behind the views ``pcmarts_<name>``.

        Joins and groupings on the key then read matching buckets side by side: the shuffle is paid once at write time instead
        of in every mart. Each call builds the tables from their inputs, writes new versions beside the last, and turns the views
        to them when all are written: open readers finish, and a failure leaves everything as it was. The versions before the last go.
        """
        names, before = list(names), dict(self._memo)
        self.forget(names)  # plans that read what an earlier call wrote
        version = new_version().split("=")[1].replace("-", "_")
        tables = {name: f"pcmarts_{name}_v{version}" for name in names}

        def write(name: str, df: DataFrame) -> None:
            bucketed = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
            bucketed.option("path", f"{self.path(name)}_bucketed/version={version}").saveAsTable(tables[name])

        try:
            side_by_side({name: partial(write, name, self.table(name)) for name in names})
        except Exception:
            self._memo = before
            for name in names:
                self._drop_bucketed(name, tables[name])
            raise
        for name in names:
            view = f"pcmarts_{name}"
            if self.spark.catalog.tableExists(view) and self.spark.catalog.getTable(view).tableType != "VIEW":
                self.spark.sql(f"ALTER TABLE {view} RENAME TO {view}_v0")  # written before there were versions
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {tables[name]}")
            self._memo[name] = self.spark.table(view)
            for old in self._bucketed(name)[:-2]:
                self._drop_bucketed(name, old)
        return names

    def _bucketed(self, name: str) -> list[str]:
        """The versions of a bucketed table, oldest first."""
        return sorted(t.name for t in self.spark.catalog.listTables(pattern=f"pcmarts_{name}_v*"))

    def _drop_bucketed(self, name: str, version: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {version}")
        remove(self.spark, f"{self.path(name)}_bucketed/version={version.rsplit('_v', 1)[1]}")

    def drop_bucketed(self, names: Iterable[str] = POLICY_KEYED) -> None:
        """Drop the views of bucketed tables and all their versions."""
        self.forget(names)
        for name in names:
            self.spark.sql(f"DROP VIEW IF EXISTS pcmarts_{name}")
            for version in self._bucketed(name):
                self._drop_bucketed(name, version)

    def reopened(self) -> "Workspace":
        """The same workspace as it stands now: tables that have been refreshed are read at their newest version, others built anew."""
        other = Workspace(self.spark, self.bronze_reader, self.as_of, self.root)
        return other.attach([n for n in CATALOG if versions(self.spark, self.path(n))] if self.root else [])

    def attach(self, names: Iterable[str]) -> "Workspace":
        """Read the named tables from the root folder instead of computing them."""
        for name in names:
            self._memo[name] = self.spark.read.parquet(current(self.spark, self.path(name)))
        return self


def build_order(names: Iterable[str]) -> list[str]:
    """The names and everything they need, each after its inputs."""
    done: list[str] = []

    def visit(name: str):
        if name in done:
            return
        for parent in CATALOG[name].needs:
            visit(parent)
        done.append(name)

    for name in names:
        visit(name)
    return done


def levels(order: list[str]) -> list[list[str]]:
    """Names in build order, in groups: none needs another of its group or of a later one."""
    depth: dict[str, int] = {}
    for name in order:
        depth[name] = 1 + max((depth.get(parent, 0) for parent in CATALOG[name].needs), default=0)
    return [[n for n in order if depth[n] == d] for d in sorted(set(depth.values()))]


def downstream(names: Iterable[str]) -> list[str]:
    """Every registered table that reads one of the names, directly or not, in build order."""
    hit = set(names)
    grown = True
    while grown:
        more = {t.name for t in CATALOG.values() if set(t.needs) & hit} - hit
        hit |= more
        grown = bool(more)
    return [n for n in build_order(hit) if n in hit]
