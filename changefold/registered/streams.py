"""The streaming path over the whole event table: landing, bronze, incremental fold, evolution.

Each query works in a new folder below the shared root the cluster names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, Row, functions as F
from pyspark.sql.streaming import DataStreamReader

from ..operators.fold import live, op_distribution
from ..operators.rules import TXN_RULES, all_failures
from ..plans import incremental
from ..plans.refresh import Layout, land, ledger_report, quality_report, refresh, silver_tables
from ..plans.silver import fixed_transactions
from ..session import scratch
from ..sources.bronze import bronze_events, project, read_bronze
from ..sources.landing import HIVE_NULL, PARTITIONS, hour_folders, hour_rounds, hour_tasks, landing_path, start_landing
from ..sources.registry import SchemaRegistry
from ..sources.tables import current_table
from ..streaming.facts import fact_changes, log_version, split_outputs, start_quarantine, start_split, start_valid
from ..streaming.ingest import drain_bronze, start_bronze
from ..streaming.scd1 import Scd1Target
from .book import (
    AS_OF, CHANGEFEED, CUSTOMERS, LOAN_OK, LOANS, TRANSACTIONS, TXN_OK, TXN_TYPES_SQL, Book, avg_2, query,
)
from .cdc import SCD1_SQL
from .loanbook import NPA_SQL, PORTFOLIO_SQL, RISK_SQL

_STEPS = 5


def event_messages(b: Book, hot: str | None = None) -> DataFrame:
    """The event table as a stream of change messages, spread by offset like a topic with partitions."""
    return _messages(b.stream("events").repartition("event_id"), hot)


def _messages(events: DataFrame, hot: str | None = None) -> DataFrame:
    """Change messages of events; ``hot`` is a time at which every third of them arrives instead of its own."""
    op = F.expr("case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end")
    moment = F.col("ts").cast("timestamp")
    arrived = moment if hot is None else F.when(F.col("event_id") % 3 == 0, F.lit(hot).cast("timestamp")).otherwise(moment)
    value = F.to_json(F.struct(
        "user_id", "event_type", "value", "props", op.alias("__op"), F.unix_millis(moment).alias("__ts_ms"),
        F.lit("user_events").alias("__table")))
    return events.select(
        F.lit("bank.public.user_events").alias("topic"), F.col("event_id").alias("offset"),
        arrived.alias("timestamp"), value.cast("binary").alias("value"))


def land_events(b: Book, root: str, hot: str | None = None, rows_per_task: int = 1_000_000) -> str:
    start_landing(
        event_messages(b, hot), f"{root}/landing", f"{root}/checkpoints/landing", interval=None,
        tasks_per_hour=hour_tasks(_messages(b.table("events"), hot), rows_per_task),
    ).awaitTermination()
    return landing_path(f"{root}/landing", "user_events")


def ingest_events(b: Book, root: str, landing: str) -> SchemaRegistry:
    registry = SchemaRegistry(b.spark, f"{root}/checkpoints/schema")
    started = start_bronze(b.spark, landing, f"{root}/bronze", f"{root}/checkpoints/bronze")
    drain_bronze(b.spark, registry, started, f"{root}/bronze")
    return registry


def in_pieces(b: Book, df: DataFrame, path: str) -> DataFrame:
    """Write a frame as five drops, every task its own files, and stream them back in five micro-batches."""
    df.withColumn("_drop", F.pmod(F.xxhash64(*df.columns), F.lit(_STEPS))) \
        .write.option("compression", "zstd").partitionBy("_drop").parquet(path)
    files = len(b.spark.read.parquet(path).inputFiles())
    reader = b.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", max(1, -(-files // _STEPS)))
    return reader.parquet(f"{path}/_drop=*")


#: Names of files that the driver holds at once.
_FILES_AT_ONCE = 100_000


def in_rounds(b: Book, rounds: Sequence[Row], path: str) -> DataFrame:
    """The event table as a stream that brings the hours of a round (``hour_rounds``) in one micro-batch, a file each."""
    events = b.table("events")
    of = b.spark.createDataFrame(rounds, ", ".join([*(f"{c} string" for c in PARTITIONS), "_drop int"]))
    at = F.col("ts").cast("timestamp")
    hours = [F.date_format(at, p).eqNullSafe(of[c]) for c, p in PARTITIONS.items()]
    dealt = events.join(F.broadcast(of), reduce(Column.__and__, hours)).select(*events.columns, "_drop")  # a row an hour
    dealt.repartition("_drop").write.option("compression", "zstd").partitionBy("_drop").parquet(path)
    return b.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/_drop=*")


_HOUR = ", ".join(f"cast(strftime(ts, '{code}') as int) \"{part}\"" for part, code in (
    ("year", "%Y"), ("month", "%m"), ("day", "%d"), ("hour", "%H")))


@query(f"select {_HOUR}, count(*) events from events group by all")
def landing_partitions(b: Book) -> DataFrame:
    landed = b.spark.read.text(land_events(b, scratch(b.spark, "landing")))
    return landed.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("events"))


_HOT_HOUR = "2024-01-15 12:30:00"
_HOT_ROWS = 500


@query(f"""
select {_HOUR}, count(*) events, count(*) >= 2 * {_HOT_ROWS} split
from (select case when event_id % 3 = 0 then timestamp '{_HOT_HOUR}' else ts end ts from events) e group by all""")
def landing_hot_hour(b: Book) -> DataFrame:
    """A third of all events arrives in one hour: several tasks write it, each other hour is one file."""
    landed = b.spark.read.text(land_events(b, scratch(b.spark, "hot-hour"), _HOT_HOUR, _HOT_ROWS))
    return landed.withColumn("file", F.input_file_name()).groupBy("year", "month", "day", "hour").agg(
        F.count(F.lit(1)).alias("events"), (F.count_distinct("file") > 1).alias("split"))


@query(f"select {_HOUR}, cast(ceil(count(*) / 20.0) as bigint) files from events group by all")
def landing_files(b: Book) -> DataFrame:
    """A file closes after twenty events: each hour, gathered in one task, has as many as that takes."""
    root, hour = scratch(b.spark, "files"), list(PARTITIONS)
    rounds = hour_rounds(_messages(b.table("events")), 20, _FILES_AT_ONCE).collect()  # a row an hour
    start_landing(
        _messages(in_rounds(b, rounds, f"{root}/rounds").repartition("event_id")),
        f"{root}/landing", f"{root}/checkpoint", interval=None, max_records=20, tasks_per_hour=1,
    ).awaitTermination()
    path, of = landing_path(f"{root}/landing", "user_events"), {tuple(r[c] or HIVE_NULL for c in hour): r["round"] for r in rounds}
    together = defaultdict(list)
    for at, folder in sorted(hour_folders(b.spark, path).items()):
        together[of.get(at)].append(folder)
    counts = []
    for folders in together.values():
        landed = b.spark.read.option("basePath", path).text(folders)
        files = landed.select(*(F.col(c).cast("int").alias(c) for c in hour), F.input_file_name().alias("file")).distinct()
        counts += files.groupBy(*hour).agg(F.count(F.lit(1)).alias("files")).collect()  # a row an hour
    return b.spark.createDataFrame(counts, ", ".join([*(f"{c} int" for c in hour), "files long"]))


@query("""
select case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end __op, count(*) events,
  count(*) with_source, count(*) with_stamp, count(*) parsed
from events group by 1""")
def bronze_metadata(b: Book) -> DataFrame:
    """Every bronze row knows its file and when it came; taken by a polling stream that is then stopped."""
    root = scratch(b.spark, "metadata")
    polling = start_bronze(
        b.spark, land_events(b, root), f"{root}/bronze", f"{root}/checkpoints/bronze", interval="1 second")
    polling.processAllAvailable()
    polling.stop()
    rows = read_bronze(b.spark, f"{root}/bronze")
    return rows.groupBy("__op").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("_source_file").endswith(".txt")).alias("with_source"),
        F.count_if(F.col("_ingest_ts") <= F.current_timestamp()).alias("with_stamp"), F.count("event").alias("parsed"))


@query("""
select case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end __op, event_type, count(*) events,
  count(distinct event_id) offsets, cast(sum(cast(value as decimal(18,2))) as double) total, min(epoch_us(ts) // 1000) first_ms
from events group by all""")
def bronze_ingest(b: Book) -> DataFrame:
    root = scratch(b.spark, "bronze")
    registry = ingest_events(b, root, land_events(b, root))
    rows = project(bronze_events(read_bronze(b.spark, f"{root}/bronze")), registry.load())
    return rows.groupBy("__op", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("_kafka_offset").alias("offsets"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("total"), F.min("__ts_ms").alias("first_ms"))


@query("""
select case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end __op, count(*) events
from events group by 1""")
def bronze_op_distribution(b: Book) -> DataFrame:
    """Lines landed by a batch job instead of a stream: bronze takes any folder of JSON lines."""
    root = scratch(b.spark, "ops")
    op = F.expr("case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end")
    lines = b.table("events").select(F.to_json(F.struct("event_id", "event_type", op.alias("__op"))).alias("value"))
    lines.write.text(f"{root}/landing")
    ingest_events(b, root, f"{root}/landing")
    return op_distribution(bronze_events(read_bronze(b.spark, f"{root}/bronze")))


@query("""
select event_type, count(*) events, count(case when event_type in ('view', 'click') then 1 end) with_channel,
  cast(sum(case when event_type in ('view', 'click') then cast(value as decimal(18,2))
    else cast(floor(value) as decimal(18,2)) end) as double) total,
  cast(sum(case when event_type in ('view', 'click') then (cast(event_id as hugeint) + 1) * 10000000
    else cast(event_id as hugeint) + 9007199254740993 end) as varchar) readings
from events group by event_type""")
def schema_evolution(b: Book) -> DataFrame:
    """A first drop with whole amounts and no channel, a second with cents and a new field.

    Readings are whole numbers no double keeps in the first drop, and doubles in the second.
    """
    root = scratch(b.spark, "evolution")
    events = b.table("events")
    late = F.col("event_type").isin("view", "click")
    old = events.where(~late).select(F.to_json(F.struct(
        F.col("event_id").alias("id"), "event_type", F.floor("value").alias("amount"),
        (F.col("event_id").cast("long") + 9007199254740993).alias("reading"))).alias("value"))
    new = events.where(late).select(F.to_json(F.struct(
        F.col("event_id").alias("id"), "event_type", F.col("value").alias("amount"),
        F.lit("app").alias("channel"), ((F.col("event_id") + 1) * 1e7).cast("double").alias("reading"))).alias("value"))
    landing = f"{root}/landing"
    for drop in (old, new):
        drop.write.mode("append").text(landing)
        registry = ingest_events(b, root, landing)
    rows = project(bronze_events(read_bronze(b.spark, f"{root}/bronze")), registry.load())
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count("channel").alias("with_channel"),
        F.sum(F.col("amount").cast("decimal(18,2)")).alias("total"),
        F.sum(F.col("reading").cast("decimal(28,0)")).cast("string").alias("readings"))


def follow_feed(b: Book, root: str, buckets: int = 16) -> Scd1Target:
    feed = in_pieces(b, b._project(CHANGEFEED), f"{root}/feed")
    target = Scd1Target(b.spark, f"{root}/target", ["user_id"], ("ts", "event_id"), "op = 'd'", buckets=buckets)
    target.follow(feed, f"{root}/checkpoint").awaitTermination()
    return target


@query(SCD1_SQL)
def scd1_incremental(b: Book) -> DataFrame:
    target = follow_feed(b, scratch(b.spark, "scd1"))
    return target.current().select("user_id", "event_id", "event_type", "value")


@query(SCD1_SQL)
def scd1_full_refresh(b: Book) -> DataFrame:
    root = scratch(b.spark, "scd1-full")
    target = Scd1Target(b.spark, root, ["user_id"], ("ts", "event_id"), "op = 'd'", buckets=16)
    target.full_refresh(b.feed)
    return target.current().select("user_id", "event_id", "event_type", "value")


def transaction_stream(b: Book, root: str) -> DataFrame:
    """The transactions as a change stream, numbered as they are written."""
    rows = b.transactions.withColumnsRenamed({"op": "__op"}).withColumns({
        "_kafka_offset": F.monotonically_increasing_id(), "__ts_ms": F.lit(1).cast("bigint")})
    return in_pieces(b, rows, f"{root}/transactions")


@query(f"""
with t as (select *, coalesce({TXN_OK}, false) ok from f_txns where op <> 'd')
select 'rejected' outcome, count(*) row_count, count(distinct txn_id) ids from t where not ok""")
def stream_quarantine(b: Book) -> DataFrame:
    root = scratch(b.spark, "quarantine")
    start_quarantine(
        transaction_stream(b, root), TXN_RULES, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return b.spark.read.parquet(f"{root}/out").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("txn_id").alias("ids")
    ).select(F.lit("rejected").alias("outcome"), "row_count", "ids")


@query(f"""
with t as (select *, coalesce({TXN_OK}, false) ok from f_txns where op <> 'd')
select case when ok then 'valid' else 'rejected' end outcome, count(distinct txn_id) ids,
  case when ok then count(distinct txn_id) else count(*) end row_count from t group by ok""")
def stream_split(b: Book) -> DataFrame:
    """Rules first: each id with any valid copy comes out valid exactly once, and every failing copy is kept."""
    root = scratch(b.spark, "split")
    start_split(
        transaction_stream(b, root), ["txn_id"], TXN_RULES, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    outputs = zip(("valid", "rejected"), split_outputs(b.spark, f"{root}/out"))
    counts = [
        rows.agg(F.countDistinct("txn_id").alias("ids"), F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("outcome"), "ids", "row_count")
        for name, rows in outputs
    ]
    return counts[0].unionByName(counts[1])


@query(f"""
with per_id as (select txn_id, bool_and(coalesce({TXN_OK}, false)) always, bool_or(coalesce({TXN_OK}, false)) ever
  from f_txns where op <> 'd' group by txn_id)
select case when always then 'always valid' when ever then 'sometimes valid' else 'never valid' end copies,
  count(*) ids, case when always then count(*) when not ever then 0 end passed
from per_id group by always, ever""")
def stream_valid(b: Book) -> DataFrame:
    """The first event of an id, then the rules. Offsets here are Spark's row numbers, which the oracle does not
    have, so only ids whose copies agree have an outcome it can tell."""
    root = scratch(b.spark, "valid")
    columns = ("txn_id", "loan_id", "amount", "txn_type", "txn_date")
    start_valid(
        transaction_stream(b, root), ["txn_id"], columns, TXN_RULES, f"{root}/out", f"{root}/checkpoint",
    ).awaitTermination()
    passed = split_outputs(b.spark, f"{root}/out")[0].groupBy("txn_id").agg(F.count(F.lit(1)).alias("n"))
    ok = TXN_RULES.passes()
    per_id = live(b.transactions, "op").groupBy("txn_id").agg(F.bool_and(ok).alias("always"), F.bool_or(ok).alias("ever"))
    copies = F.when(F.col("always"), "always valid").when(F.col("ever"), "sometimes valid").otherwise("never valid")
    counted = per_id.join(passed, "txn_id", "left").groupBy(copies.alias("copies")).agg(
        F.count(F.lit(1)).alias("ids"), F.coalesce(F.sum("n"), F.lit(0)).alias("passed"))
    return counted.withColumn("passed", F.when(F.col("copies") != "sometimes valid", F.col("passed")))


def _dealt(b: Book, name: str, *columns: str) -> DataFrame:
    """A table as a stream, its rows dealt to tasks; a number keeps AQE from merging tasks by the bytes of what grows later."""
    return b.stream(name).repartition(int(b.spark.conf.get("spark.sql.shuffle.partitions")), *columns)


def _message(table: str, rows: DataFrame, offset, op, moment=None, **encoded) -> DataFrame:
    """Change messages of one topic, all in one landing hour; ``rows`` may bring ``__op`` and ``__ts_ms``."""
    row = rows.withColumn("_offset", offset).withColumns(encoded)
    columns = [c for c in row.columns if c not in ("_offset", "op", "__op", "__ts_ms")]
    value = F.to_json(F.struct(
        *columns, op.alias("__op"), (F.lit(1) if moment is None else moment).alias("__ts_ms"), F.lit(table).alias("__table")))
    return row.select(
        F.lit(f"bank.public.{table}").alias("topic"), F.col("_offset").alias("offset"),
        F.lit(f"{AS_OF} 00:00:00").cast("timestamp").alias("timestamp"), value.cast("binary").alias("value"))


def loan_history(loans: DataFrame) -> DataFrame:
    """Every loan as a snapshot, a late older update, two updates of one moment whose offsets decide, and, for one
    in 97, a delete."""
    # (step, operation, time, status): steps are offsets, so the later of two equal times is the real row
    steps = [(1, "r", 10, "pending"), (2, "u", 5, "closed"), (3, "u", 20, "pending"), (4, "u", 20, None), (5, "d", 30, None)]
    versions = F.array(*(F.struct(
        F.lit(n).alias("n"), F.lit(o).alias("o"), F.lit(t).alias("t"), F.lit(s).cast("string").alias("s")) for n, o, t, s in steps))
    loans = loans.withColumn("_v", F.explode(versions)).where(
        "_v.o <> 'd' or cast(substr(loan_id, 2) as int) % 97 = 0")
    return loans.withColumns({"status": F.coalesce("_v.s", "status"), "__op": F.col("_v.o"), "__ts_ms": F.col("_v.t"), "_n": F.col("_v.n")}).drop("_v")


def book_messages(b: Book, history: bool = False) -> dict[str, DataFrame]:
    """The loan book as streams of change messages, one per topic.

    With ``history`` every loan comes as a snapshot, a late older update, two updates of one moment whose
    offsets decide, and, for one in 97, a delete; payments get an id of their own. Rows are dealt to tasks as they
    are read, before they become versions and text.
    """
    static = {t: b.table(t) for t in ("nation", "region")}
    customers = b.spark.sql(CUSTOMERS, customer=_dealt(b, "customer", "c_custkey"), **static)
    loans = b.spark.sql(LOANS, orders=_dealt(b, "orders", "o_orderkey"))
    transactions = b.spark.sql(TRANSACTIONS, lineitem=_dealt(b, "lineitem", "l_orderkey", "l_linenumber", "l_partkey"))
    created, op, moment, place = F.lit("c"), F.lit("c"), None, F.expr("xxhash64(loan_id)")
    if history:
        loans = loan_history(loans)
        op, moment, place = F.col("__op"), F.col("__ts_ms"), F.expr("cast(substr(loan_id, 2) as bigint) * 10 + _n")
        transactions = transactions.withColumns({
            "txn_id": F.concat_ws("-", "txn_id", "l_partkey", "l_suppkey"),
            "__ts_ms": F.coalesce(F.expr("pmod(cast(amount * 100 as bigint), 7)"), F.lit(0))})
    loan_rows = _message(
        "loans", loans, place, op, moment, disbursed_at=F.unix_millis(F.col("disbursed_at").cast("timestamp")))
    return {
        "customers": _message("customers", customers, F.expr("xxhash64(customer_id)"), created),
        "loans": loan_rows,
        "transactions": _message(
            "transactions", transactions, F.expr("xxhash64(txn_id, l_partkey, l_suppkey)"), F.col("op"),
            F.col("__ts_ms") if history else None, txn_date=F.unix_date("txn_date")),
    }


def _refreshed(b: Book, history: bool = False, views: bool = False) -> Layout:
    layout = Layout(scratch(b.spark, "refresh"), views=views)
    land(book_messages(b, history), layout, tasks_per_hour=8)
    refresh(b.spark, layout, as_of=b.as_of)
    return layout


@query(PORTFOLIO_SQL)
def refresh_portfolio(b: Book) -> DataFrame:
    """The whole way: change messages, landing, bronze, silver folds, gold, read back as published."""
    return current_table(b.spark, _refreshed(b).root, "gold", "portfolio_summary")


@query(PORTFOLIO_SQL)
def refresh_views(b: Book) -> DataFrame:
    """The same, read through the view that the catalog offers."""
    _refreshed(b, views=True)
    return b.spark.table("gold.portfolio_summary")


@query(f"""
with loan as (select count(*) n, 4 * count(case when not coalesce({LOAN_OK}, false) then 1 end) bad from f_loans),
pay as (select count(*) n, count(case when not coalesce({TXN_OK}, false) then 1 end) bad from f_txns where op <> 'd')
select 'customers' table_name, count(*) checked, 0 rejected, 100.0::double pass_rate, false breached from f_customers
union all select 'loans', 4 * n, bad, round(100.0 * (4 * n - bad) / (4 * n), 2), 100.0 * (4 * n - bad) / (4 * n) < 95 from loan
union all select 'transactions', n, bad, round(100.0 * (n - bad) / n, 2), 100.0 * (n - bad) / n < 95 from pay""")
def refresh_quality(b: Book) -> DataFrame:
    """Pass rates as counted while silver was written."""
    return quality_report(b.spark, _refreshed(b, history=True))


@query(RISK_SQL.replace("s_loans", "s_kept"))
def refresh_customer_risk(b: Book) -> DataFrame:
    """The same with snapshots, late and equal times and deletes among the loans."""
    return current_table(b.spark, _refreshed(b, history=True).root, "gold", "customer_risk_profile")


@query(NPA_SQL.replace("s_loans", "s_kept"))
def refresh_npa(b: Book) -> DataFrame:
    return current_table(b.spark, _refreshed(b, history=True).root, "gold", "npa_watchlist")


@query(f"""
with once as (select distinct txn_id, l_partkey, l_suppkey, loan_id, amount, txn_type, txn_date from f_txns
  where op <> 'd' and {TXN_OK}),
one as (select *, row_number() over (partition by txn_id, l_partkey, l_suppkey
  order by cast(amount * 100 as bigint) % 7, amount, loan_id, txn_date, txn_type) rn from once)
select cast(txn_date as varchar) txn_date, count(*) payment_count, cast(sum(amount) as double) total_collected,
  {avg_2('amount')} avg_emi
from one where rn = 1 and txn_type = 'PAYMENT' group by txn_date""")
def refresh_collections(b: Book) -> DataFrame:
    """Which of several valid copies counts is decided by their times, then by what they hold."""
    return current_table(b.spark, _refreshed(b, history=True).root, "gold", "daily_collections")


_DAILY_FIRST = f"""
select cast(txn_date as varchar) txn_date, count(*) payment_count, sum(amount) total_collected, {avg_2('amount')} avg_emi from (
  select *, row_number() over (partition by txn_id, l_partkey, l_suppkey
    order by cast(amount * 100 as bigint) % 7, amount, loan_id, txn_date, txn_type) rn from f_txns where op <> 'd' and {TXN_OK}) t
where rn = 1 and txn_type = 'PAYMENT' group by txn_date"""


def _drops(feed: DataFrame, path: str) -> Callable[[DataFrameReader | DataStreamReader, str], DataFrame]:
    """Write a feed once, a folder a drop; the function given back reads the drops that a pattern names."""
    feed.write.option("compression", "zstd").partitionBy("_drop").parquet(path)
    schema = feed.drop("_drop").schema
    return lambda reader, drops: reader.schema(schema).parquet(f"{path}/_drop={drops}")


@query(f"""
select 'portfolio_summary' table_name, concat_ws('/', loan_type, status) group_name, loan_count n, total_exposure total,
  avg_loan_amount first_average, avg_interest_rate second_average from ({PORTFOLIO_SQL.replace("s_loans", "s_kept")}) p
union all select 'customer_risk_profile', credit_tier, customer_count, total_active_exposure, avg_credit_score, avg_annual_income
from ({RISK_SQL.replace("s_loans", "s_kept")}) r
union all select 'daily_collections', txn_date, payment_count, cast(total_collected as double), avg_emi, null from ({_DAILY_FIRST}) d""")
def gold_incremental(b: Book) -> DataFrame:
    """Gold brought up to date after each of three drops of changes, from the signed changes only.

    Loans and customers come in versions, out of order, so that rows change their group, go and come back;
    payments come as copies whose first one, by time, may arrive last.
    """
    layout = Layout(scratch(b.spark, "incremental"), views=False)
    customers, loans = layout.customers(b.spark, buckets=8), layout.loans(b.spark, buckets=8)
    steps = 3
    lent = loan_history(b.loans.repartition("loan_id")).withColumn(
        "_kafka_offset", F.expr("cast(substr(loan_id, 2) as bigint) * 10 + _n")).drop("_n")
    lent = lent.withColumn("_drop", F.pmod(F.xxhash64("loan_id", "_kafka_offset"), F.lit(steps)))
    people = b.customers.repartition("customer_id").withColumn("_v", F.explode(F.array(F.lit(1), F.lit(2)))).withColumns({
        "credit_score": F.when(F.col("_v") == 1, F.pmod(F.col("credit_score") * 7, F.lit(300)) + 400).otherwise(F.col("credit_score")),
        "__op": F.lit("u"), "__ts_ms": F.col("_v").cast("long"), "_kafka_offset": F.xxhash64("customer_id")})
    people = people.withColumn("_drop", F.pmod(F.xxhash64("customer_id", "_v", F.lit(5)), F.lit(steps))).drop("_v")
    paid = b.transactions.withColumnsRenamed({"op": "__op"}).withColumns({
        "txn_id": F.concat_ws("-", "txn_id", "l_partkey", "l_suppkey"), "_kafka_offset": F.lit(0).cast("long"),
        "__ts_ms": F.coalesce(F.expr("pmod(cast(amount * 100 as bigint), 7)"), F.lit(0))}).drop("l_partkey", "l_suppkey")
    paid = paid.withColumn("_drop", F.pmod(F.xxhash64("txn_id", "amount"), F.lit(steps)))
    facts, path = f"{layout.root}/facts", f"{layout.root}/gold"
    people_drop, lent_drop, paid_drop = (
        _drops(feed, f"{layout.root}/drops/{name}") for name, feed in (("people", people), ("lent", lent), ("paid", paid)))
    for n in range(steps):
        customers.apply(people_drop(b.spark.read, str(n)), n)
        loans.apply(lent_drop(b.spark.read, str(n)), n)
        stream = paid_drop(b.spark.readStream, f"[0-{n}]")  # what came so far; the checkpoint knows what it took
        start_split(stream, ["txn_id"], TXN_RULES, facts, f"{layout.root}/checkpoint").awaitTermination()
        summary = incremental.portfolio_summary(loans, path)
        tiers = incremental.customer_risk_profile(customers, loans, path, buckets=8)
        daily = incremental.daily_collections(
            b.spark, log_version(b.spark, facts), lambda since: fact_changes(b.spark, facts, since),
            lambda: split_outputs(b.spark, facts)[0], path)

    def named(table: str, rows: DataFrame, group, *columns) -> DataFrame:
        names = ("n", "total", "first_average", "second_average")
        return rows.select(F.lit(table).alias("table_name"), group.alias("group_name"), *(
            (F.col(c) if c else F.lit(None)).cast("bigint" if name == "n" else "double").alias(name) for c, name in zip(columns, names)))

    return named("portfolio_summary", summary, F.concat_ws("/", "loan_type", "status"), "loan_count", "total_exposure",
                 "avg_loan_amount", "avg_interest_rate").unionByName(
        named("customer_risk_profile", tiers, F.col("credit_tier"), "customer_count", "total_active_exposure",
              "avg_credit_score", "avg_annual_income")).unionByName(
        named("daily_collections", daily, F.col("txn_date").cast("string"), "payment_count", "total_collected", "avg_emi", None))


@query(f"""
with bad as (select *, case when not coalesce(loan_amount > 0, false) then 'valid_loan_amount'
  when not coalesce(interest_rate between 1 and 30, false) then 'valid_interest_rate'
  when not coalesce(tenure_months between 12 and 360, false) then 'valid_tenure' else 'valid_loan_type' end reason
  from f_loans where not coalesce({LOAN_OK}, false)),
pay as (select case when not coalesce(amount > 0, false) then 'invalid_amount'
  when not coalesce(txn_type in {TXN_TYPES_SQL}, false) then 'invalid_txn_type' else 'missing_loan_id' end reason
  from f_txns where op <> 'd' and not coalesce({TXN_OK}, false))
select 'loans' table_name, reason, 4 * count(*) row_count from bad group by reason
union all select 'transactions', reason, count(*) from pay group by reason""")
def refresh_quarantine(b: Book) -> DataFrame:
    """Every failing event of the folded tables and of the transactions, by its first reason."""
    tables = silver_tables(b.spark, _refreshed(b, history=True))
    counted = [
        tables[f"{t}_quarantine"].groupBy(F.col("_quarantine_reason").alias("reason")).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(t).alias("table_name"), "reason", "row_count") for t in ("customers", "loans", "transactions")]
    return reduce(DataFrame.unionByName, counted)


_STRANGE = """case when l_partkey % 19 = 0 then 'dead_letters' when l_partkey % 11 = 0 then 'unheard_of' else 'transactions' end"""
_LOST = "(l_partkey % 13 = 0 or l_partkey % 17 = 0)"


def _strange_refreshed(b: Book) -> Layout:
    layout = Layout(scratch(b.spark, "conservation"), views=False)
    numbered = b.transactions.withColumn("_n", F.monotonically_increasing_id())
    value = F.to_json(F.struct(
        F.when(F.expr("l_partkey % 23 <> 0"), F.col("txn_id")).alias("txn_id"), "loan_id",
        F.when(F.expr("l_partkey % 13 = 0"), F.lit(123456789012.5)).otherwise(F.col("amount").cast("double")).alias("amount"),
        "txn_type", F.when(F.expr("l_partkey % 17 = 0"), F.lit(10 ** 9)).otherwise(F.unix_date("txn_date")).alias("txn_date"),
        F.col("op").alias("__op"), F.lit(1).alias("__ts_ms")))
    messages = numbered.select(
        F.concat(F.lit("bank.public."), F.expr(_STRANGE)).alias("topic"), F.expr("cast(_n % 2 as int)").alias("partition"),
        F.expr("_n div 2").alias("offset"), F.lit(f"{AS_OF} 00:00:00").cast("timestamp").alias("timestamp"),
        F.when(F.expr("l_partkey % 19 = 0"), F.lit("{broken")).otherwise(value).cast("binary").alias("value"))
    land(in_pieces(b, messages, f"{layout.root}/topics"), layout, tasks_per_hour=8)
    refresh(b.spark, layout)
    return layout


@query(f"""
with m as (select *, {_STRANGE} table_name, coalesce({TXN_OK}, false) and not {_LOST} and l_partkey % 23 <> 0 ok from f_txns)
select table_name, count(*) landed, count(case when table_name = 'transactions' and op = 'd' then 1 end) deletes,
  count(distinct case when table_name = 'transactions' and op <> 'd' and ok then txn_id end) valid,
  count(case when table_name = 'transactions' and op <> 'd' and ok then 1 end)
    - count(distinct case when table_name = 'transactions' and op <> 'd' and ok then txn_id end) duplicates,
  count(case when table_name = 'transactions' and op <> 'd' and not ok then 1 end) quarantined
from m group by table_name""")
def conservation(b: Book) -> DataFrame:
    """Nothing is lost between a topic and silver, by table.

    Messages of two partitions share offsets; some are no JSON, of an unknown table, without a key, with an
    amount that does not fit or a date in a wrong unit. What has landed is valid, a copy, a delete or in
    quarantine. Copies are counted in bronze.
    """
    layout = _strange_refreshed(b)
    landed = b.spark.read.text(layout.landing()).groupBy(F.col("table").alias("table_name")).agg(F.count(F.lit(1)).alias("landed"))
    silver = silver_tables(b.spark, layout)
    events = fixed_transactions(read_bronze(b.spark, layout.bronze("transactions")))
    deleted = F.coalesce(F.col("__op") == "d", F.lit(False))
    ok = (F.size(all_failures(events, TXN_RULES)) == 0) & F.col("txn_id").isNotNull()
    one = [
        frame.agg(*(count.alias(name) for name, count in counts.items())).withColumn("table_name", F.lit("transactions"))
        for frame, counts in (
            (events, {"deletes": F.count_if(deleted), "passing": F.count_if(~deleted & ok)}),
            (silver["transactions"], {"valid": F.count(F.lit(1))}),
            (silver["transactions_quarantine"], {"quarantined": F.count(F.lit(1))}))]
    counts = reduce(lambda x, y: x.join(y, "table_name"), one)
    counts = counts.select("table_name", "deletes", "valid", (F.col("passing") - F.col("valid")).alias("duplicates"), "quarantined")
    return landed.join(counts, "table_name", "left").na.fill(0)


@query(f"""
with m as (select *, case when l_partkey % 19 = 0 then 'dead_letters' when l_partkey % 11 = 0 then 'others' else 'transactions' end table_name,
  coalesce({TXN_OK}, false) and not {_LOST} and l_partkey % 23 <> 0 ok from f_txns),
c as (select table_name, count(*) landed, count(case when op = 'd' then 1 end) deletes,
  count(case when op <> 'd' then 1 end) checked, count(case when op <> 'd' and not ok then 1 end) rejected,
  count(distinct case when op <> 'd' and ok then txn_id end) valid from m group by table_name)
select table_name, landed, case when table_name = 'transactions' then landed end parsed,
  case when table_name = 'transactions' then 0 end malformed, case when table_name = 'transactions' then deletes end deletes,
  case when table_name = 'transactions' then checked end checked, case when table_name = 'transactions' then rejected end rejected,
  case when table_name = 'transactions' then valid end valid,
  case when table_name = 'transactions' then checked - rejected - valid end duplicates, 0 gaps, 'OK' status
from c""")
def count_ledger(b: Book) -> DataFrame:
    """The feed of ``conservation``, every layer reconciled from counts taken while it was written: no table is read."""
    return ledger_report(b.spark, _strange_refreshed(b)).where("landed > 0")
