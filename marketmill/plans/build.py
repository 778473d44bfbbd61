"""The whole build: load, stage, build the marts, test them."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.operators.quality import assert_all_pass, quality_report
from marketmill.plans.marts import all_marts, customer_orders_masked
from marketmill.plans.quality_suite import suite
from marketmill.plans.staging import all_staging
from marketmill.schemas import MARKETPLACE_FILES, SEED_FILES
from marketmill.sources.csv_files import load_csv_tables, source_root
from marketmill.sources.tables import Warehouse, Written, as_views, in_parallel

# Namespace of each mart.
MART_NAMESPACES = {
    "mart_customer_orders": "marts",
    "mart_olist_customer_orders": "olist_marts",
    "mart_olist_seller_performance": "olist_marts",
}


@dataclass(frozen=True)
class Build:
    rows: dict[str, int]
    models: dict[str, DataFrame]
    report: DataFrame


def staged_views(warehouse: Warehouse, tables: list[str]) -> dict[str, DataFrame]:
    """Staging over the loaded tables, registered as views; nothing is stored."""
    views = all_staging({table: warehouse.read("raw", table) for table in tables})
    as_views(views, warehouse.prefix)
    return views


class BuildState:
    """What finished steps of earlier builds have made, and from which input.

    A step is recorded when its rows are complete on storage, before any name points at
    them. Its `version` tells its input: the files of a load, the stored copies that a mart
    reads. The table has a row for each step and build.
    """

    NAMESPACE, TABLE = "build", "steps"
    SCHEMA = "step string, version string, location string, rows bigint, finished_at timestamp"

    def __init__(self, warehouse: Warehouse) -> None:
        self.warehouse = warehouse
        self.lock = threading.Lock()  # appends of one driver go one by one

    def finished(self, step: str, version: str) -> tuple[str, int] | None:
        """(location, rows) of the last record of a step, if it has this version."""
        if not self.warehouse.exists(self.NAMESPACE, self.TABLE):
            return None
        rows = self.warehouse.read(self.NAMESPACE, self.TABLE).where(F.col("step") == step)
        last = rows.agg(F.max_by(F.struct("version", "location", "rows"), "finished_at")).first()[0]
        return (last["location"], last["rows"]) if last and last["version"] == version else None

    def record(self, step: str, version: str, location: str, rows: int) -> None:
        row = (step, version, location, rows, datetime.now(timezone.utc))
        with self.lock:
            df = self.warehouse.spark.createDataFrame([row], self.SCHEMA)
            self.warehouse.append(df, self.NAMESPACE, self.TABLE)


def version_of(*parts: object) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()


def files_version(warehouse: Warehouse, path: str) -> str:
    """Of landing files: their names, sizes and times."""
    files = warehouse.spark.read.format("binaryFile").load(path)
    rows = files.select("path", "length", "modificationTime").orderBy("path").collect()
    return version_of([tuple(row) for row in rows])


def loaded(
    warehouse: Warehouse, root: str, files: Mapping[str, str], state: BuildState | None
) -> dict[str, int]:
    """`load_csv_tables`, leaving out files that are loaded as they are now."""
    if state is None:
        return load_csv_tables(warehouse, root, files)
    rows, left, versions = {}, {}, {}
    for file, table in files.items():
        versions[table] = files_version(warehouse, f"{root.rstrip('/')}/{file}")
        done = state.finished(f"raw.{table}", versions[table])
        if done and warehouse.exists("raw", table) and warehouse.location("raw", table) == done[0]:
            rows[table] = done[1]
        else:
            left[file] = table
    fresh = load_csv_tables(warehouse, root, left)
    for table, count in fresh.items():
        state.record(f"raw.{table}", versions[table], warehouse.location("raw", table), count)
    return {table: (rows | fresh)[table] for table in files.values()}


def stored_marts(
    warehouse: Warehouse,
    staged: dict[str, DataFrame],
    state: BuildState | None = None,
    version: str = "",
) -> dict[str, DataFrame]:
    """Rebuild the marts side by side and switch their names to the new rows.

    With a `state`, a mart whose rows an earlier build has completed from the input of this
    `version` is not computed again.
    """
    spark = warehouse.spark
    for namespace in set(MART_NAMESPACES.values()):
        warehouse.create_namespace(namespace)

    def made(name: str, df: DataFrame) -> Written:
        namespace = MART_NAMESPACES[name]
        done = state.finished(f"{namespace}.{name}", version) if state else None
        if done:
            location, rows = done
            return Written(namespace, name, location, spark.read.parquet(location).schema, rows)
        written = warehouse.stage(df, namespace, name)
        if state:
            state.record(f"{namespace}.{name}", version, written.location, written.rows)
        return written

    written = in_parallel(
        spark,
        {
            name: (lambda df=df, name=name: made(name, df))
            for name, df in all_marts(staged).items()
        },
    )
    for mart in written.values():
        warehouse.publish(mart)
    marts = {name: warehouse.read(MART_NAMESPACES[name], name) for name in written}
    masked = {
        "mart_customer_orders_masked": customer_orders_masked(marts["mart_customer_orders"])
    }
    as_views(masked, warehouse.prefix)
    return marts | masked


def build_all(
    warehouse: Warehouse,
    marketplace_root: str,
    seeds_root: str,
    bucket: str | None = None,
    stop_on_failure: bool = True,
    resume: bool = False,
) -> Build:
    """One full run. Any failing step stops it; so do failing data tests, unless told not to.

    With `resume`, steps that this or an earlier such build has finished from the same input
    are not done again: a broken build goes on where it stopped.

    Staging stays lazy, so a mart is one job from the loaded tables to the stored one,
    and the tests on a mart read the stored rows.
    """
    root = source_root(warehouse.spark, marketplace_root, MARKETPLACE_FILES, bucket)
    state = BuildState(warehouse) if resume else None
    rows = loaded(warehouse, root, MARKETPLACE_FILES, state)
    rows |= loaded(warehouse, seeds_root, SEED_FILES, state)
    staged = staged_views(warehouse, list(rows))
    version = version_of([(table, warehouse.location("raw", table)) for table in sorted(rows)])
    models = staged | stored_marts(warehouse, staged, state, version)
    report = quality_report(warehouse.spark, models, suite())
    if stop_on_failure:
        assert_all_pass(report)
    return Build(rows, models, report)
