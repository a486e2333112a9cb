"""Current-state table kept up to date from a change stream.

State is the latest event per key, deletes included (so a late, older upsert cannot revive a key),
as Parquet split by a hash of the key into buckets. A micro-batch is folded first, then joined
only with the buckets it touches; those are written as a new version and a one-line manifest
``bucket -> version`` is committed last. A crash before that leaves the old state readable, a
replayed batch is recognised by its id, and untouched buckets are neither read nor written.

Buckets follow the data by linear hashing: with M of them, a key's bucket is its hash modulo the largest
doubling of the first number within M, or modulo twice that where this bucket was split already. When the
rows outgrow M buckets, the next ones in order are split by one more bit of the hash, and only those are moved.

With ``deltas`` every commit also writes what it changed: the old image of a changed key with sign -1, the
new one with 1, from the same pass.

One writer per target.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.fold import DELETES, IS_DELETE, fold_latest, latest_first, published, usable
from ..operators.rules import RuleSet, all_failures
from ..schemas import METADATA_COLUMNS, SEQUENCE
from ..sources.bronze import variant_field
from ..sources.registry import widen
from ..sources.versions import CODEC, PREFIX, VersionedDir, ensure_folder, folder_bytes

_BUCKET = "cf_bucket"
_SHARE, _SHARES = "cf_share", 4  # a bucket's keys are dealt to so many tasks, each with a file of its own
_ROW_BYTES = 100  # taken for a row's size until some were written
_DELTAS, _SIGN, _OLD = -1, "_sign", "cf_old"
_QUARANTINE = "event variant, _failed_rules array<string>, _quarantined_at timestamp, cf_version int"
_EMPTY = {"buckets": {}, "schema": None, "event_schema": None, "applied": {}, "first_quarantine": 1, "horizon": None,
          "count": None, "rows": 0, "row_bytes": None, "deltas_after": None, "checked": 0, "rejected": 0}


class Scd1Target:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        sequence: Sequence[str] = SEQUENCE,
        deletes: str = DELETES,
        rules: RuleSet | None = None,
        delete_mode: str = "hard",
        except_columns: Sequence[str] = METADATA_COLUMNS,
        buckets: int = 32,
        tombstone_retention: int | None = None,
        vacuum_every: int | None = 50,
        keep: int = 10,
        bucket_bytes: int = 128 << 20,
        deltas: bool = False,
    ):
        """``buckets`` is the first number of buckets; a target grows by itself so that each holds ``bucket_bytes``
        at most. ``deltas`` keeps what each commit changed for ``changes_since`` (hard deletes only).
        ``tombstone_retention`` forgets deletes that many sequence units behind the newest event. What
        is older than that horizon when it arrives is quarantined (``behind_retention``), since it could
        revive a forgotten key. Every ``vacuum_every`` commits, versions only manifests older than the ``keep`` newest need are deleted; a reader
        must be done within that many commits."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.sequence = list(sequence)
        self.deletes = deletes
        self.rules = rules
        self.delete_mode = delete_mode
        self.except_columns = list(except_columns)
        self.buckets = buckets
        self.tombstone_retention = tombstone_retention
        self.vacuum_every = vacuum_every
        self.keep = keep
        self.bucket_bytes = bucket_bytes
        if deltas and delete_mode != "hard":
            raise ValueError("deltas are kept for hard deletes only")
        self.deltas = deltas
        self._manifests = VersionedDir(spark, f"{self.root}/manifest")
        self._states = VersionedDir(spark, f"{self.root}/state")

    # -- reading ---------------------------------------------------------------------------------

    def current(self) -> DataFrame:
        """The published table."""
        return published(self.state(), self.keys, self.sequence, self.delete_mode, self.except_columns)

    def exists(self) -> bool:
        """Whether anything was ever applied."""
        return self._manifests.latest() is not None

    def state(self) -> DataFrame:
        """The folded events behind the published table, deletes included."""
        manifest = self._manifest()
        if manifest["schema"] is None:
            raise FileNotFoundError(f"nothing was ever applied to {self.root}")
        return self._read_buckets(self.spark, manifest, manifest["buckets"])

    def quarantine(self) -> DataFrame:
        """Events no batch could use, in their own columns, with the rules they broke."""
        latest, manifest = self._manifests.latest(), self._manifest()
        ensure_folder(self.spark, f"{self.root}/quarantine")
        rows = self.spark.read.schema(_QUARANTINE).parquet(f"{self.root}/quarantine").where(
            F.col("cf_version").between(manifest["first_quarantine"], latest))
        fields = _schema(manifest["event_schema"]).fields
        return rows.select(
            *(variant_field("event", f.name, f.dataType.simpleString()).alias(f.name) for f in fields),
            "_failed_rules", F.col("_failed_rules")[0].alias("_quarantine_reason"), "_quarantined_at",
        )

    def version(self) -> int:
        """The newest commit; 0 before the first."""
        return self._manifests.latest() or 0

    def applied(self) -> dict[str, int]:
        """The last batch id taken from each feed."""
        return self._manifest()["applied"]

    def quality(self) -> tuple[int, int]:
        """Upserts checked since the last full refresh, and how many of all events were rejected."""
        manifest = self._manifest()
        return manifest["checked"], manifest["rejected"]

    def deleted(self) -> int:
        """Delete events since the last full refresh."""
        return self._manifest().get("deletes", 0)

    def of_keys(self, keys: DataFrame) -> DataFrame:
        """State of the given keys (a column per key), from the buckets they are in only."""
        manifest = self._manifest()
        count = manifest["count"] or self.buckets
        asked = self._in_buckets(keys.select(*self.keys).distinct(), count)
        touched = {str(r[_BUCKET]) for r in asked.select(_BUCKET).distinct().collect()}  # at most one row a bucket
        held = {b: v for b, v in manifest["buckets"].items() if b in touched}
        rows = self._read_buckets(self.spark, manifest, held)
        return rows.join(asked.select(*self.keys), self.keys, "left_semi")

    def changes_since(self, version: int) -> DataFrame | None:
        """Published rows that came or went after a commit, with ``_sign`` 1 or -1; signs of rows that came and
        went again cancel out. None where that is not known any more (or never was): take ``current`` instead."""
        manifest = self._manifest()
        after, versions = manifest["deltas_after"], self._manifests.committed()
        if after is None or version < after or version + 1 < versions[0]:
            return None
        schema = _schema(manifest["schema"])
        made = self.spark.createDataFrame([], StructType([*schema.fields, StructField(_SIGN, IntegerType())]))
        for v in versions:
            if v > version and f"{_BUCKET}={_DELTAS}" in self._states.parts(v):
                own = StructType([*_schema(json.loads(self._manifests.read_note(v))["schema"]).fields, StructField(_SIGN, IntegerType())])
                rows = self.spark.read.schema(own).parquet(f"{self._states.path(v)}/{_BUCKET}={_DELTAS}")
                made = made.unionByName(_conform(rows, made.schema))
        return made.drop(IS_DELETE, *self.except_columns)

    # -- writing ---------------------------------------------------------------------------------

    def follow(
        self,
        stream: DataFrame,
        checkpoint: str,
        prepare: Callable[[DataFrame], DataFrame] | None = None,
        interval: str | None = None,
    ) -> StreamingQuery:
        """Apply a stream batch by batch; drain and stop, or poll every ``interval``."""

        def on_batch(batch: DataFrame, batch_id: int) -> None:
            self.apply(prepare(batch) if prepare else batch, batch_id, feed=checkpoint)

        writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
        writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
        return writer.start()

    def apply(self, events: DataFrame, batch_id: int, feed: str = "batch") -> None:
        """Fold one batch in. A batch id already applied from the same feed changes nothing."""
        manifest = self._manifest()
        if manifest["applied"].get(feed, -1) < batch_id:
            self._commit(events, manifest, {**manifest["applied"], feed: batch_id})

    def apply_upto(self, events: DataFrame, applied: dict[str, int]) -> None:
        """Fold one batch in that brings every named feed up to a batch id, all of them at once."""
        manifest = self._manifest()
        if any(manifest["applied"].get(feed, -1) < n for feed, n in applied.items()):
            self._commit(events, manifest, {**manifest["applied"], **applied})

    def full_refresh(self, events: DataFrame, applied: dict[str, int] | None = None) -> None:
        """Replace the state by a fold of the whole feed. ``applied`` says what it already contains."""
        version = (self._manifests.latest() or 0) + 1
        self._commit(events, {**_EMPTY, "first_quarantine": version}, applied or {})

    def _commit(self, events: DataFrame, manifest: dict, applied: dict[str, int]) -> None:
        spark = events.sparkSession
        version = (self._manifests.latest() or 0) + 1
        horizon = manifest["horizon"]
        seen = Observation()
        counts = [F.count_if(~F.col(IS_DELETE)).alias("checked"), F.count_if(F.col(IS_DELETE)).alias("deletes"),
                  F.count_if(F.size("_failed_rules") > 0).alias("rejected")]
        checked = self._checked(events, horizon)
        good = self._usable_rows(checked.observe(seen, *counts))
        old = _schema(manifest["schema"])
        schema = widen(old, good.schema)
        # A key hashes by its type, so types are settled before buckets are; a grown type moves every row.
        was = manifest["count"] or self.buckets
        folded = self._in_buckets(self._fold(_conform(good, schema)), was).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            facts = folded.groupBy(_BUCKET).agg(  # at most one row a bucket
                F.max(self.sequence[0]).alias("newest"), F.count(F.lit(1)).alias("n")).collect()
            quality = _observed(seen) or checked.agg(*counts).first().asDict()
            if quality["rejected"]:
                self._quarantine(checked, events, version)
            touched = {str(r[_BUCKET]) for r in facts}
            count = self._wanted(was, max(manifest["rows"], sum(r["n"] for r in facts)), manifest["row_bytes"])
            grown = any(schema[f.name].dataType != f.dataType for f in old.fields)
            moved = {str(b) for b in split_buckets(self.buckets, was, count)} if facts else set()
            reread = set(manifest["buckets"]) if grown else touched | moved
            prior = {b: v for b, v in manifest["buckets"].items() if b in reread}
            total, written = manifest["rows"], manifest["buckets"]
            row_bytes, deltas_after = manifest["row_bytes"], manifest["deltas_after"]
            if touched or grown:
                before, after = Observation(), Observation()
                merged = folded.drop(_BUCKET)
                if prior:
                    stored = _conform(self._read_buckets(spark, manifest, prior), schema).observe(
                        before, F.count(F.lit(1)).alias("n"))
                    merged = stored.withColumn(_OLD, F.lit(True)).unionByName(merged.withColumn(_OLD, F.lit(False)))
                share = F.pmod(F.xxhash64(F.lit(_SHARE), *self.keys), F.lit(_SHARES))
                merged = self._in_buckets(merged, count).withColumn(_SHARE, share).repartition(_BUCKET, _SHARE)
                if prior:  # a first load is folded already
                    merged = self._merged(merged, self.deltas)
                merged = merged.drop(_SHARE)
                if self.tombstone_retention is not None:
                    newest = max((r.newest for r in facts), default=horizon)
                    newest = None if newest is None else newest - self.tombstone_retention
                    horizon = newest if horizon is None else max(horizon, newest)
                    merged = merged.where(~F.col(IS_DELETE) | (F.col(self.sequence[0]) >= horizon) | (F.col(_BUCKET) < 0))
                merged = merged.observe(
                    after, F.count_if(F.col(_BUCKET) >= 0).alias("n"), F.count(F.lit(1)).alias("rows"))
                path = self._states.path(version)
                merged.write.mode("overwrite").partitionBy(_BUCKET).parquet(path)
                gone = (_observed(before) or {"n": stored.count()})["n"] if prior else 0
                made = _observed(after) or {"n": 0, "rows": 0}
                total += made["n"] - gone
                if made["rows"]:
                    row_bytes = folder_bytes(spark, path) / made["rows"]
                kept = {b: v for b, v in written.items() if b not in reread}
                names = (name.split("=") for name in self._states.parts(version))
                written = {**kept, **{n[1]: version for n in names if n[0] == _BUCKET and int(n[1]) >= 0}}
            else:
                count = was
        finally:
            folded.unpersist()
        if self.deltas and (deltas_after is None or not manifest["buckets"]):
            deltas_after = version
        event_schema = widen(_schema(manifest["event_schema"]), events.drop("_misfits").schema)
        self._manifests.write_note(version, json.dumps({
            "bucket_count": self.buckets,
            "count": count,
            "rows": total,
            "row_bytes": row_bytes,
            "buckets": written,
            "schema": schema.json(),
            "event_schema": event_schema.json(),
            "applied": applied,
            "first_quarantine": manifest["first_quarantine"],
            "horizon": horizon,
            "deltas_after": deltas_after,
            "checked": manifest["checked"] + quality["checked"],
            "rejected": manifest["rejected"] + quality["rejected"],
            "deletes": manifest.get("deletes", 0) + quality["deletes"],
        }))
        if self.vacuum_every and version % self.vacuum_every == 0:
            self.vacuum()

    def _wanted(self, count: int, rows: int, row_bytes: float | None) -> int:
        """Buckets for so many rows: half full on average, as those not split yet hold up to twice the others' rows."""
        return max(count, math.ceil(2 * rows * (row_bytes or _ROW_BYTES) / self.bucket_bytes))

    def _merged(self, rows: DataFrame, deltas: bool) -> DataFrame:
        """The fold of stored and new rows; with ``deltas`` also the images it exchanged, in a bucket of their own."""
        if not deltas:
            return self._fold(rows.drop(_OLD), _BUCKET, _SHARE)
        order = latest_first(rows.drop(_OLD, _BUCKET, _SHARE).schema, self.keys, self.sequence)
        rank = F.row_number().over(Window.partitionBy(_BUCKET, _SHARE, *self.keys).orderBy(*order))
        ranked = rows.withColumn("cf_rank", rank).where("cf_rank <= 2")
        first, shown = F.col("cf_rank") == 1, ~F.col(IS_DELETE)

        def out(when: Column, bucket: Column, sign: int | None) -> Column:
            return F.when(when, F.struct(bucket.alias("b"), F.lit(sign).cast("int").alias("s")))

        outs = F.array_compact(F.array(
            out(first, F.col(_BUCKET), None), out(first & ~F.col(_OLD) & shown, F.lit(_DELTAS), 1),
            out(~first & F.col(_OLD) & shown, F.lit(_DELTAS), -1)))
        plain = [c for c in rows.columns if c not in (_OLD, _BUCKET, _SHARE)]
        return ranked.select(*plain, F.explode(outs).alias("o")).select(*plain, F.col("o.s").alias(_SIGN), F.col("o.b").alias(_BUCKET))

    def _checked(self, events: DataFrame, horizon: int | None) -> DataFrame:
        """The events with ``_failed_rules``: why one cannot be used, empty where it can."""
        is_delete = F.coalesce(F.expr(self.deletes), F.lit(False))
        unusable = F.when(~usable(self.keys, self.sequence), F.array(F.lit("missing_key_or_sequence")))
        if horizon is not None:
            unusable = unusable.when(F.col(self.sequence[0]) < horizon, F.array(F.lit("behind_retention")))
        none = F.array().cast("array<string>")
        broken = F.when(is_delete, none).otherwise(all_failures(events, self.rules))
        return events.withColumn(IS_DELETE, is_delete).withColumn("_failed_rules", F.coalesce(unusable, broken))

    def _usable_rows(self, checked: DataFrame) -> DataFrame:
        """What goes into the fold, without columns state never shows."""
        hidden = [c for c in self.except_columns if c not in self.sequence]
        return checked.where(F.size("_failed_rules") == 0).drop("_failed_rules", *hidden)

    def _quarantine(self, checked: DataFrame, events: DataFrame, version: int) -> None:
        bad = checked.where(F.size("_failed_rules") > 0).select(
            F.to_variant_object(F.struct(*(c for c in events.columns if c != "_misfits"))).alias("event"),
            "_failed_rules", F.current_timestamp().alias("_quarantined_at"))
        bad.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.root}/quarantine/{PREFIX}{version}")

    def vacuum(self, keep: int | None = None) -> None:
        """Delete bucket versions that only manifests older than the ``keep`` newest refer to."""
        versions, keep = self._manifests.committed(), keep or self.keep
        notes = {v: json.loads(self._manifests.read_note(v))["buckets"] for v in versions}
        needed = {item for v in versions[-keep:] for item in notes[v].items()}
        for bucket, version in {item for v in versions[:-keep] for item in notes[v].items()} - needed:
            self._states.remove(version, f"{_BUCKET}={bucket}")
        for version in versions[:-keep]:
            self._states.remove(version, f"{_BUCKET}={_DELTAS}")
            self._manifests.remove(version)

    # -- helpers ---------------------------------------------------------------------------------

    def _fold(self, events: DataFrame, *within: str) -> DataFrame:
        return fold_latest(
            events, [*within, *self.keys], self.sequence, self.deletes, keep_image=self.delete_mode == "soft")

    def _in_buckets(self, rows: DataFrame, count: int) -> DataFrame:
        """Every row's bucket among ``count``: those below the split point were split by one more bit."""
        base = doubled(self.buckets, count)
        h = F.xxhash64(*self.keys)
        bucket = F.pmod(h, F.lit(base))
        return rows.withColumn(_BUCKET, F.when(bucket < count - base, F.pmod(h, F.lit(2 * base))).otherwise(bucket).cast("int"))

    def _manifest(self) -> dict:
        version = self._manifests.latest()
        if version is None:
            return dict(_EMPTY)
        manifest = {**_EMPTY, **json.loads(self._manifests.read_note(version))}
        if manifest["bucket_count"] != self.buckets:
            raise ValueError(f"{self.root} has {manifest['bucket_count']} buckets, not {self.buckets}")
        return manifest

    def _read_buckets(self, spark: SparkSession, manifest: dict, buckets: dict[str, int]) -> DataFrame:
        """The named buckets, each at its version."""
        schema = _schema(manifest["schema"])
        if not buckets:
            return spark.createDataFrame([], schema)
        paths = [f"{self._states.path(v)}/{_BUCKET}={b}" for b, v in sorted(buckets.items())]
        return spark.read.schema(schema).parquet(*paths)


def doubled(first: int, count: int) -> int:
    """The largest doubling of ``first`` that is not above ``count``."""
    return first << (count // first).bit_length() - 1


def split_buckets(first: int, was: int, count: int) -> set[int]:
    """The buckets among ``was`` that lose rows to new ones when there are ``count``."""
    lost = set()
    for new in range(was, count):
        bucket = new
        while bucket >= was:  # a new bucket may come from one that is new itself
            bucket -= doubled(first, bucket)
        lost.add(bucket)
    return lost


def _observed(seen: Observation) -> dict | None:
    """What a finished job observed; None where its plan turned out empty, which reports nothing."""
    try:
        return seen.get
    except Py4JJavaError:
        return None


def _schema(text: str | None) -> StructType:
    return StructType([]) if text is None else StructType.fromJson(json.loads(text))


def _conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its types: added ones NULL, grown ones converted, structs by field name."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(f: StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if have[f.name] == f.dataType:
            return F.col(f.name)
        boxed = F.to_variant_object(F.struct(F.col(f.name).alias("v")))
        return F.try_variant_get(boxed, "$.v", f.dataType.simpleString()).alias(f.name)

    return df.select(*(column(f) for f in schema.fields))
