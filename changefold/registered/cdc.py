"""Change feeds in batch: fold, deletes, dedup, envelopes, decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.temporal import decode_temporal
from ..operators.envelope import before_after, unwrap_envelope
from ..operators.fold import apply_changes, dedup_first as first_of, fold_latest, live, op_distribution as op_counts, published
from ..operators.rules import TXN_RULES
from ..sources.landing import decode, route
from .book import TXN_OK, TXN_ORDER, Book, query

_SEQ = ("ts", "event_id")
_LATEST = """select * from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn
  from f_feed) x where rn = 1"""


def _fold(b: Book, **options) -> DataFrame:
    return fold_latest(b.feed, ["user_id"], _SEQ, "op = 'd'", **options)


@query(f"select user_id, event_id, op, event_type, value from ({_LATEST}) l")
def scd1_fold(b: Book) -> DataFrame:
    return _fold(b).select("user_id", "event_id", "op", "event_type", "value")


SCD1_SQL = f"select user_id, event_id, event_type, value from ({_LATEST}) l where op <> 'd'"


@query(SCD1_SQL)
def scd1_fold_deletes(b: Book) -> DataFrame:
    return published(_fold(b), ["user_id"], _SEQ).select("user_id", "event_id", "event_type", "value")


@query("""
with up as (select * from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) rn
    from f_feed where op <> 'd') x where rn = 1),
del as (select user_id, max(ts) ts from f_feed where op = 'd' group by user_id)
select coalesce(up.user_id, del.user_id) user_id, up.value, coalesce(del.ts > up.ts, up.ts is null) _is_deleted,
  cast(case when coalesce(del.ts > up.ts, up.ts is null) then del.ts end as varchar) _deleted_at
from up full outer join del on up.user_id = del.user_id""")
def scd1_soft_delete(b: Book) -> DataFrame:
    soft = published(_fold(b, keep_image=True), ["user_id"], _SEQ, delete_mode="soft")
    return soft.select("user_id", "value", "_is_deleted", "_deleted_at")


@query(f"""
select loan_id, txn_id, cast(amount as double) amount, txn_type, cast(txn_date as varchar) txn_date from (
  select *, row_number() over (partition by loan_id order by txn_date desc, (op = 'd') desc, amount desc nulls last,
    l_partkey desc, l_suppkey desc, op desc, txn_id desc, txn_type desc) rn
  from f_txns where loan_id is not null and txn_date is not null and (op = 'd' or coalesce({TXN_OK}, false))) x
where rn = 1 and op <> 'd'""")
def scd1_fold_rules(b: Book) -> DataFrame:
    latest = apply_changes(b.transactions, ["loan_id"], ["txn_date"], "op = 'd'", rules=TXN_RULES)
    return latest.select("loan_id", "txn_id", "amount", "txn_type", "txn_date")


@query("select event_type, op, count(*) events from f_feed group by event_type, op order by op, event_type")
def op_distribution(b: Book) -> DataFrame:
    return op_counts(b.feed, ["event_type"], "op").orderBy("op", "event_type")


_FIRST_ORDER = ", ".join(f"{c} asc nulls first" for c in TXN_ORDER)


@query(f"""
select txn_id, loan_id, cast(amount as double) amount, txn_type, cast(txn_date as varchar) txn_date from (
  select *, row_number() over (partition by txn_id order by {_FIRST_ORDER}) rn from f_txns where op <> 'd') x
where rn = 1""")
def dedup_first(b: Book) -> DataFrame:
    first = first_of(live(b.transactions, "op"), ["txn_id"], TXN_ORDER)
    return first.select("txn_id", "loan_id", "amount", "txn_type", "txn_date")


_ROW = "struct<user_id:bigint,event_type:string,value:double>"
_PAYLOAD = f"""struct<before:{_ROW},after:{_ROW},source:struct<table:string,lsn:bigint>,op:string,ts_ms:bigint>"""


def _envelopes(b: Book) -> DataFrame:
    """The feed as nested JSON text, parsed again: an update's before-image has the value less one."""
    after = F.struct("user_id", "event_type", "value")
    before = F.struct("user_id", "event_type", (F.col("value") - 1).alias("value"))
    op = F.col("op")
    text = F.to_json(F.struct(
        F.when(op != "c", before).alias("before"),
        F.when(op != "d", after).alias("after"),
        F.struct(F.lit("users").alias("table"), F.col("event_id").alias("lsn")).alias("source"),
        "op",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
    ))
    return b.feed.select(F.from_json(text, _PAYLOAD).alias("payload"))


@query("""
select user_id, event_type, cast(round(case when op = 'd' then value - 1 else value end, 2) as double) value, op __op,
  'users' __table, epoch_us(ts) // 1000 __ts_ms, op = 'd' __deleted, cast(round(case when op <> 'c' then value - 1 end, 2) as double) before_value
from f_feed""")
def envelope_unwrap(b: Book) -> DataFrame:
    rows = unwrap_envelope(_envelopes(b))
    return rows.select(
        "user_id", "event_type", F.round("value", 2).alias("value"), "__op", "__table", "__ts_ms", "__deleted",
        F.round("__before.value", 2).alias("before_value"))


@query("""
select user_id, round(case when op <> 'c' then value - 1 end, 2) before_value,
  case when op <> 'd' then value end after_value, op, 'users' source_table, event_id source_lsn,
  epoch_us(ts) // 1000 event_ms
from f_feed""")
def before_after_diff(b: Book) -> DataFrame:
    rows = before_after(_envelopes(b), "user_id", {"value": "value"})
    return rows.select(
        "user_id", F.round("before_value", 2).alias("before_value"), "after_value", "op", "source_table",
        "source_lsn", F.unix_millis("event_ts").alias("event_ms"))


@query("""
select o_orderkey, cast(cast(o_orderdate as date) as varchar) from_days, cast(o_orderdate as varchar) from_ms,
  cast(o_orderdate as varchar) from_us, cast(null as varchar) wrong_unit from orders""")
def temporal_decode(b: Book) -> DataFrame:
    moment = F.col("o_orderdate").cast("timestamp")
    wire = b.table("orders").select(
        "o_orderkey", F.unix_date(F.to_date("o_orderdate")).alias("d"), F.unix_millis(moment).alias("ms"),
        F.unix_micros(moment).alias("us"))
    return wire.select(
        "o_orderkey", decode_temporal(F.col("d"), "days").alias("from_days"),
        decode_temporal(F.col("ms"), "ms").alias("from_ms"), decode_temporal(F.col("us"), "us").alias("from_us"),
        decode_temporal(F.col("us"), "ms").alias("wrong_unit"))


def _messages(b: Book, value) -> DataFrame:
    return b.table("events").select(
        F.concat(F.lit("bank.public."), F.col("event_type")).alias("topic"), F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"), value.cast("binary").alias("value"))


@query("""
select event_type "table", count(*) messages, min(event_id) first_offset, max(event_id) last_offset
from events group by event_type""")
def topic_route(b: Book) -> DataFrame:
    return route(_messages(b, F.col("props"))).groupBy("table").agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"))


@query("""
select event_type "table", count(case when event_type <> 'error' then 1 end) decoded,
  count(case when event_type = 'error' then 1 end) dead,
  cast(sum(case when event_type <> 'error' then cast(regexp_extract(props, '[0-9]+') as bigint) end) as bigint) sum_k
from events group by event_type""")
def json_decode(b: Book) -> DataFrame:
    """Errors lose their closing brace, so they must come out as dead letters."""
    cut = F.when(F.col("event_type") == "error", F.rtrim(F.col("props"), F.lit("}"))).otherwise(F.col("props"))
    good, dead = decode(route(_messages(b, cut)))
    k = F.try_variant_get("event", "$.k", "bigint")
    both = good.select("table", F.lit(1).alias("ok"), k.alias("k")).unionByName(
        dead.select("table", F.lit(0).alias("ok"), F.lit(None).cast("bigint").alias("k")))
    return both.groupBy("table").agg(
        F.count_if(F.col("ok") == 1).alias("decoded"), F.count_if(F.col("ok") == 0).alias("dead"),
        F.sum("k").alias("sum_k"))
