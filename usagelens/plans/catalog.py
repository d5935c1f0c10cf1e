"""Registry of named report queries: a Spark plan builder plus, where SQL can
express it, an independent DuckDB statement over the same parquet tables.

Spark builders take (spark, sf_dir) and return a DataFrame; nothing is
collected.  Builders of KPI queries stage the device-hour rollup of the input
once per session and state of the input files, and builders of stream queries
run the stream; all others run no job.  Oracle SQL is written in the reference's own relational form
(EXISTS / correlated subqueries / rollups) where possible, so it is a second
derivation rather than a transliteration of the Spark plan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from usagelens.plans.oracle_views import with_views
from usagelens.sources import fixtures, registry


@dataclass
class Query:
    name: str
    build: Callable[["Inputs"], DataFrame]
    oracle: str | None

    @property
    def doc(self) -> str:
        return (self.build.__doc__ or "").strip()


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Decorator: register ``fn(inputs) -> DataFrame`` under ``name``."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, with_views(oracle) if oracle else None)
        return fn
    return deco


#: the tables that launches and page views are made of
LAUNCH_TABLES = ["events", "nation", "region"]
#: staged tables: (application, kind, partitions, state of the input files) -> table name
_ROLLUPS: dict[tuple, str] = {}


def drop_rollups(spark: SparkSession) -> None:
    """Drop this session's staged rollups and their files."""
    from usagelens.session import drop_staged
    for key in [k for k in _ROLLUPS if k[0] == spark.sparkContext.applicationId]:
        drop_staged(spark, _ROLLUPS.pop(key))


class Inputs:
    """Lazily built fact views and registry tables of one (session, sf_dir)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def launch(self) -> DataFrame:
        return fixtures.launch(self.spark, self.sf_dir)

    @cached_property
    def page(self) -> DataFrame:
        return fixtures.page(self.spark, self.sf_dir)

    @cached_property
    def app_event(self) -> DataFrame:
        return fixtures.app_event(self.spark, self.sf_dir)

    @cached_property
    def crash(self) -> DataFrame:
        return fixtures.crash(self.spark, self.sf_dir)

    @cached_property
    def launch_long(self) -> DataFrame:
        return fixtures.launch_long(self.spark, self.sf_dir)

    @cached_property
    def rollup(self) -> DataFrame:
        """Device-hour rollup of the launch log, computed once per query --
        one scan of the raw fact -- and written as a table bucketed by
        (product, device) in the shared checkpoint folder.  Every KPI branch
        reads it (column pruning would otherwise give each branch a different
        aggregate and defeat exchange reuse), and per-device steps find it
        already clustered.

        It is staged once per session and input, and all queries over that
        input read the same table; :func:`drop_rollups` removes the tables."""
        from usagelens.operators.kpis import device_partitioned
        return self._staged("launch_rollup", LAUNCH_TABLES, ["product_id", "device_id"],
                            lambda n: device_partitioned(self.launch))

    @cached_property
    def long_keys(self) -> DataFrame:
        """Device-day keys of the long launch history, staged like the rollup:
        first launches and return visits read one table, not the log twice."""
        from usagelens.operators.retention import launch_keys
        return self._staged("launch_keys", ["orders"], ["product_id", "device_id"],
                            lambda n: launch_keys(self.launch_long).repartition(n, "product_id", "device_id"))

    @cached_property
    def first_days(self) -> DataFrame:
        """First day of every device per entry, kept beside the rollup."""
        from usagelens.operators.realtime import first_days
        return self._staged("first_days", LAUNCH_TABLES, ["product_id", "device_id"],
                            lambda n: first_days(self.rollup).repartition(n, "product_id", "device_id"))

    @cached_property
    def page_days(self) -> DataFrame:
        """Page time per entry and day, staged with the rollup: the KPI's sum, its
        span of days and its keys read this small table, not the page log."""
        from usagelens.operators.kpis import page_rollup
        return self._staged("page_days", LAUNCH_TABLES, ["product_id", "d"],
                            lambda n: page_rollup(self.page).repartition(n, "product_id", "d"))

    @cached_property
    def transitions(self) -> DataFrame:
        """Page transitions per entry and day, staged once: the path reports
        read this summary as often as they need it."""
        from usagelens.operators.paths import transitions
        return self._staged("page_transitions", LAUNCH_TABLES, ["product_id", "d"],
                            lambda n: transitions(self.page).repartition(n, "product_id", "d"))

    def _staged(self, kind: str, tables: list[str], keys: list[str], build: Callable[[int], DataFrame]) -> DataFrame:
        from usagelens.session import files_state, write_bucketed
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        states = self.__dict__.setdefault("_states", {})          # asked once per query
        if tuple(tables) not in states:
            states[tuple(tables)] = files_state(self.spark, [f"{self.sf_dir}/{t}.parquet" for t in tables])
        key = (self.spark.sparkContext.applicationId, kind, n, self.sf_dir, states[tuple(tables)])
        name = _ROLLUPS.get(key)
        if name is None or not self.spark.catalog.tableExists(name):
            _ROLLUPS[key] = name = write_bucketed(build(n), keys, kind)
        return self.spark.table(name)

    def kpis(self, grain: str = "product", with_pages: bool = True) -> DataFrame:
        """Daily KPI summary at ``grain`` built on the shared rollup."""
        from usagelens.operators.kpis import daily_kpis
        key = (grain, with_pages)
        cache = self.__dict__.setdefault("_kpis", {})
        if key not in cache:
            cache[key] = daily_kpis(self.launch, self.page_days if with_pages else None, self.active, grain,
                                    rollup=self.rollup)
        return cache[key]

    @cached_property
    def active(self) -> DataFrame:
        return registry.active_channels(self.spark)

    def kpi_rows(self, *cols: str) -> DataFrame:
        """``cols`` of the launches and page views in active channels: where the
        KPI summary has rows.  Both come from staged tables; neither a log nor
        the summary itself is read a second time."""
        from usagelens.operators.kpis import only_active
        need = list(dict.fromkeys(["product_id", "channel_id", *cols]))
        parts = [only_active(t.select(*need), self.active).select(*cols) for t in (self.rollup, self.page_days)]
        return parts[0].unionAll(parts[1])

    @cached_property
    def kpi_days(self) -> DataFrame:
        """The days the KPI summary can have (page time alone counts too)."""
        return self.kpi_rows("d")

    def kpi_keys(self, *cols: str) -> DataFrame:
        """The distinct keys of the KPI summary."""
        return self.kpi_rows(*cols).distinct()

    @cached_property
    def channels(self) -> DataFrame:
        return registry.channels(self.spark)

    @cached_property
    def products(self) -> DataFrame:
        return registry.products(self.spark)

    @cached_property
    def event_defs(self) -> DataFrame:
        return registry.event_defs(self.spark)

    @cached_property
    def funnels(self) -> DataFrame:
        return registry.funnels(self.spark)


def load_all() -> dict[str, Query]:
    """Import every query module (registration happens on import)."""
    from usagelens.plans import (  # noqa: F401
        crash_queries,
        distribution_queries,
        event_queries,
        ingest_queries,
        kpi_queries,
        path_queries,
        report_queries,
        retention_queries,
        stream_queries,
    )
    return QUERIES


def spark_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    qs = load_all()
    return {n: (lambda spark, sf_dir, _q=q: _q.build(Inputs(spark, sf_dir))) for n, q in qs.items()}


def oracle_sqls() -> dict[str, str]:
    return {n: q.oracle for n, q in load_all().items() if q.oracle}
