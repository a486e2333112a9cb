"""Landing to gold in one call. Plain function calls; scheduling is the caller's business."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StringType, StructType

from ..operators.reconcile import layer_counts, require_ok
from ..operators.rules import TXN_RULES
from ..schemas import CUSTOMERS, LOANS, TABLES, TRANSACTIONS
from ..session import prepare
from ..sources.bronze import read_bronze, stream_bronze, stream_parts
from ..sources.landing import LANDED, landing_path, start_landing
from ..sources.registry import SchemaRegistry
from ..sources.tables import current_table, publish
from ..sources.versions import VersionedDir, has_entries, remove_folder
from ..streaming import ledger
from ..streaming.facts import FOUND, QUALITY, TAKEN, fact_changes, keep_quality, kept_quality, log_version, split_outputs, start_split
from ..streaming.ingest import INGESTED, drain_bronze, start_bronze
from ..streaming.scd1 import Scd1Target
from . import gold, incremental
from .silver import (
    TRANSACTION_COLUMNS, customers_target, fixed_transactions, loans_target, parts_reader,
)

GOLD = {
    "portfolio_summary": "Number, amount and mean rate of loans for each type and status",
    "customer_risk_profile": "Customers and their loans by credit tier",
    "daily_collections": "What payments brought in on each day",
    "npa_watchlist": "Loans in default, with the people to call",
}
#: Tables of the report that are empty on a clean feed.
QUARANTINES = ("customers_quarantine", "loans_quarantine", "transactions_quarantine")


@dataclass(frozen=True)
class Layout:
    """Where each layer lives below one shared root; ``views`` also offers gold in the catalog."""

    root: str
    views: bool = True

    def landing(self) -> str:
        return f"{self.root}/landing"

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/{table}_raw"

    def _generations(self, spark: SparkSession) -> VersionedDir:
        return VersionedDir(spark, f"{self.root}/silver/standing")

    def generation(self, spark: SparkSession) -> int:
        """Which build of silver readers see; a rebuild writes the next one beside it and switches last."""
        return self._generations(spark).latest() or 0

    def silver(self, spark: SparkSession, table: str, generation: int | None = None) -> str:
        return f"{self.root}/silver/{self.generation(spark) if generation is None else generation}/{table}"

    def gold_state(self, spark: SparkSession) -> str:
        """What gold is kept up to date from."""
        return f"{self.root}/gold_state/{self.generation(spark)}"

    def checkpoint(self, step: str) -> str:
        return f"{self.root}/checkpoints/{step}"

    def silver_checkpoint(self, table: str, generation: int) -> str:
        return self.checkpoint(f"silver/{generation}/{table}")

    def ledger(self) -> str:
        """Counts of landing and bronze; a build of silver has its own beside its tables."""
        return f"{self.root}/ledger"

    def registry(self, spark: SparkSession, table: str) -> SchemaRegistry:
        return SchemaRegistry(spark, f"{self.root}/checkpoints/schema/{table}")

    def customers(self, spark: SparkSession, generation: int | None = None, **options) -> Scd1Target:
        return customers_target(spark, self.silver(spark, "customers", generation), deltas=True, **options)

    def loans(self, spark: SparkSession, generation: int | None = None, **options) -> Scd1Target:
        return loans_target(spark, self.silver(spark, "loans", generation), deltas=True, **options)


#: How ``land`` writes unless told otherwise. A compressed file is one task of bronze, hence small ones.
LANDING_FILES = {"compression": "gzip", "max_records": 250_000}


def land(events: DataFrame | Mapping[str, DataFrame], layout: Layout, **options) -> None:
    """Drain change topics into landing files: one query for all tables, also unknown ones, and dead letters."""
    everything = reduce(DataFrame.unionByName, events.values()) if isinstance(events, Mapping) else events
    query = start_landing(
        everything, layout.landing(), layout.checkpoint("landing"), interval=None, tables=list(TABLES), **{**LANDING_FILES, **options})
    _finish([query])
    seen = ledger.notes(query, "landing", "", [LANDED])
    ledger.keep(everything.sparkSession, layout.ledger(), [(step, name, b, "landed", n) for step, _, b, name, n in seen])


def _finish(queries: Iterable[StreamingQuery]) -> None:
    """Wait for drain-and-stop queries; when one fails, stop the others and raise."""
    queries = list(queries)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def ingest(spark: SparkSession, layout: Layout) -> None:
    """New landing files to bronze, the tables side by side; a table nothing has landed for is left alone."""
    folders = {t: landing_path(layout.landing(), t) for t in TABLES}
    started = {
        t: start_bronze(spark, folder, layout.bronze(t), layout.checkpoint(f"bronze/{t}"))
        for t, folder in folders.items() if has_entries(spark, folder)
    }
    _finish(started.values())
    for table, query in started.items():
        drain_bronze(spark, layout.registry(spark, table), query, layout.bronze(table))
    names = {"events": "parsed", "malformed": "malformed"}
    ledger.keep(spark, layout.ledger(), [
        (step, t, b, names[m], n) for table, query in started.items()
        for step, t, b, m, n in ledger.notes(query, "bronze", table, [INGESTED])])


def build_silver(
    spark: SparkSession, layout: Layout, unit: str = "ms", buckets: int = 32, generation: int | None = None
) -> None:
    """New bronze rows to silver: two folds, and the transactions split by one read into valid and rejected."""
    generation = layout.generation(spark) if generation is None else generation
    targets = {
        CUSTOMERS: layout.customers(spark, generation, buckets=buckets), LOANS: layout.loans(spark, generation, buckets=buckets)}
    queries = [
        target.follow(
            stream_parts(spark, layout.bronze(t.name)), layout.silver_checkpoint(t.name, generation),
            parts_reader(t, layout.registry(spark, t.name), unit))
        for t, target in targets.items()
    ]
    facts = layout.silver(spark, TRANSACTIONS.name, generation)
    queries.append(start_split(
        fixed_transactions(stream_bronze(spark, layout.bronze(TRANSACTIONS.name)), unit), [TRANSACTIONS.key], TXN_RULES,
        facts, layout.silver_checkpoint(TRANSACTIONS.name, generation)))
    _finish(queries)
    keep_quality(queries[-1], f"{facts}_quality")
    ledger.keep(spark, f"{facts}_ledger", ledger.notes(queries[-1], "silver", TRANSACTIONS.name, [TAKEN, QUALITY, FOUND]))


def rebuild_silver(spark: SparkSession, layout: Layout, unit: str = "ms", buckets: int = 32) -> None:
    """Full refresh: take all of bronze into new silver tables, then switch to them and delete the old ones.

    Whatever the streams had seen before, every event is taken once, also into the quarantines. Until the
    switch readers see the old tables, and a rebuild that dies is begun anew; its leftovers are never read.
    """
    old = layout.generation(spark)
    for folder in (f"{layout.root}/silver/{old + 1}", layout.checkpoint(f"silver/{old + 1}")):
        remove_folder(spark, folder)
    build_silver(spark, layout, unit, buckets, old + 1)
    layout._generations(spark).write_note(old + 1, "rebuilt")
    for folder in (f"{layout.root}/silver/{old}", layout.checkpoint(f"silver/{old}"), f"{layout.root}/gold_state/{old}"):
        remove_folder(spark, folder)


def silver_tables(spark: SparkSession, layout: Layout, buckets: int = 32) -> dict[str, DataFrame]:
    """Current tables and quarantines; those that never had an event are empty."""
    tables = {}
    for table, target in ((CUSTOMERS, layout.customers(spark, buckets=buckets)), (LOANS, layout.loans(spark, buckets=buckets))):
        known = target.exists()
        tables[table.name] = target.current() if known else spark.createDataFrame([], table.columns)
        tables[f"{table.name}_quarantine"] = target.quarantine() if known else spark.createDataFrame(
            [], StructType([*table.columns.fields]).add("_failed_rules", ArrayType(StringType())).add("_quarantine_reason", "string"))
    shape = transaction_shape(spark, layout)
    valid, rejected = split_outputs(spark, layout.silver(spark, TRANSACTIONS.name), shape)
    tables[TRANSACTIONS.name] = valid.select(*TRANSACTION_COLUMNS)
    tables[f"{TRANSACTIONS.name}_quarantine"] = rejected
    return tables


def build_gold(spark: SparkSession, layout: Layout, as_of: Column | None = None, buckets: int = 32) -> None:
    """Bring the gold tables up to silver and publish each as a new version.

    The three aggregates follow the changes since their last build; the watchlist, a list of rows whose
    days count up, is made anew.
    """
    silver = silver_tables(spark, layout, buckets)
    customers, loans = silver["customers"], silver["loans"]
    frames = incremental_gold(spark, layout, silver, buckets)
    frames["npa_watchlist"] = gold.npa_watchlist(loans, customers, as_of)
    for name, frame in frames.items():
        publish(frame, layout.root, "gold", name, GOLD[name], view=layout.views)


def incremental_gold(spark: SparkSession, layout: Layout, silver: Mapping[str, DataFrame], buckets: int = 32) -> dict[str, DataFrame]:
    """The three gold aggregates, from their kept sums and what changed; plainly while a table has no event yet."""
    customers, loans = layout.customers(spark, buckets=buckets), layout.loans(spark, buckets=buckets)
    path, made = layout.gold_state(spark), {}
    made["portfolio_summary"] = (
        incremental.portfolio_summary(loans, path) if loans.exists() else gold.portfolio_summary(silver["loans"]))
    made["customer_risk_profile"] = (
        incremental.customer_risk_profile(customers, loans, path, buckets=buckets) if customers.exists() and loans.exists()
        else gold.customer_risk_profile(silver["customers"], silver["loans"]))
    facts, shape = layout.silver(spark, TRANSACTIONS.name), transaction_shape(spark, layout)
    upto = log_version(spark, facts)
    made["daily_collections"] = incremental.daily_collections(
        spark, upto, lambda since: fact_changes(spark, facts, since, shape), lambda: silver[TRANSACTIONS.name], path
    ) if upto >= 0 else gold.daily_collections(silver[TRANSACTIONS.name])
    return made


def transaction_shape(spark: SparkSession, layout: Layout) -> StructType:
    return fixed_transactions(read_bronze(spark, layout.bronze(TRANSACTIONS.name))).drop("_misfits").schema


def quality_report(spark: SparkSession, layout: Layout, threshold: float = 95.0, buckets: int = 32) -> DataFrame:
    """Share of checked events that passed, per table, from counts taken while they were written.

    (``table_name``, ``checked``, ``rejected``, ``pass_rate``, ``breached``): upserts of the folded tables and
    non-deletes of the transactions since the last rebuild; a table without an event has no row.
    """
    counts = []
    for table, target in ((CUSTOMERS, layout.customers(spark, buckets=buckets)), (LOANS, layout.loans(spark, buckets=buckets))):
        if target.exists():
            counts.append((table.name, *target.quality()))
    rows = spark.createDataFrame(counts, "table_name string, checked long, rejected long")
    facts = f"{layout.silver(spark, TRANSACTIONS.name)}_quality"
    rows = rows.unionByName(kept_quality(spark, facts).select(F.lit(TRANSACTIONS.name).alias("table_name"), "checked", "rejected"))
    passed = F.col("checked") - F.col("rejected")
    share = F.try_divide(passed, F.col("checked")) * 100
    return rows.where("checked > 0").select(
        "table_name", "checked", "rejected", F.round(share, 2).alias("pass_rate"), (share < threshold).alias("breached"))


def ledger_report(spark: SparkSession, layout: Layout, buckets: int = 32) -> DataFrame:
    """``ledger.reconcile`` of every table, unknown topics together as ``others``, from counts taken while writing.

    Landing and bronze count from the beginning; silver since its last rebuild, which takes all of bronze anew.
    """
    counted = ledger.totals(ledger.ledger(spark, layout.ledger())).drop("step")
    facts = ledger.ledger(spark, f"{layout.silver(spark, TRANSACTIONS.name)}_ledger")
    per_batch = facts.groupBy("step", "table_name", "batch").pivot("measure", ["taken", "checked", "rejected", "valid"]).agg(F.sum("n"))
    per_batch = per_batch.withColumn("deletes", F.col("taken") - F.col("checked")).drop("taken").unpivot(
        ["step", "table_name", "batch"], ["checked", "rejected", "valid", "deletes"], "measure", "n")
    folds = [
        (t.name, measure, n, 0)
        for t, target in ((CUSTOMERS, layout.customers(spark, buckets=buckets)), (LOANS, layout.loans(spark, buckets=buckets)))
        if target.exists()
        for measure, n in zip(("checked", "rejected", "deletes"), (*target.quality(), target.deleted()))]
    return ledger.reconcile(counted.unionByName(ledger.totals(per_batch).drop("step")).unionByName(
        spark.createDataFrame(folds, "table_name string, measure string, n long, gaps long")))


def refresh(
    spark: SparkSession,
    layout: Layout,
    unit: str = "ms",
    as_of: Column | None = None,
    buckets: int = 32,
    strict: bool = False,
) -> DataFrame:
    """Take what has landed through bronze, silver and gold; returns the layer report.

    ``strict`` raises when a table is empty, the quarantines (empty on a clean feed) excepted.
    """
    prepare(spark)
    ingest(spark, layout)
    build_silver(spark, layout, unit, buckets)
    build_gold(spark, layout, as_of, buckets)
    silver = silver_tables(spark, layout, buckets)
    report = layer_counts({
        "bronze": {f"{t}_raw": read_bronze(spark, layout.bronze(t)) for t in TABLES},
        "silver": silver,
        "gold": {name: current_table(spark, layout.root, "gold", name) for name in GOLD},
    })
    if strict:
        require_ok(report.where(~report["table_name"].isin(*QUARANTINES)))
    return report
