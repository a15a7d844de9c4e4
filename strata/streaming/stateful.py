"""Event registry and alerts as stateful streams.

``registry_stream`` keeps one event per fingerprint in keyed state and applies actions in
their order: ``seen`` opens an event, refreshes it and opens a resolved one again (its
``resolved_at`` stays); ``review`` sets its status. However the actions are cut into
micro-batches, the state is that of one upsert after the other. Each batch yields the
changed events, with how many open events they add to or take from their group.

``alert_stream`` keeps, per (domain, period), the open events by severity. An alert is
raised once when a threshold is reached and again only after it has been cleared, or, with
``renotify_after``, when a timer finds it still standing. Replayed input raises nothing,
as the counts that it would add are not sent again: the registry knows the event.

State lives in the state store of the stream's checkpoint, partitioned by key. Every call for
a key costs many times what an action does, so the registry's key is a bucket of fingerprints:
its events are one value, read once and written once a batch. A bucket's rows of one batch are
sorted in its task, and a batch holds few of them per fingerprint.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
OPEN = ("open", "acknowledged")
# times are microseconds; ``seq`` orders the actions of one instant
ACTIONS = "event_fingerprint string, at long, seq long, action string, status string, domain string, event_code string, severity string, report_period string, run_id string"
EVENT = "domain string, event_code string, severity string, report_period string, status string, detected_at long, resolved_at long, run_id string"
CHANGES = f"event_fingerprint string, {EVENT}, change long, old_severity string, old_domain string, old_period string"
DELTAS = "domain string, report_period string, severity string, change long, at long"
ALERTS = "domain string, report_period string, severity string, event_count long, threshold long, notice int, at long"
ACTION_COLUMNS = [c.split()[0] for c in ACTIONS.split(", ")]
CHANGE = Row(*[c.split()[0] for c in CHANGES.split(", ")])
NOTICE = Row(*[c.split()[0] for c in ALERTS.split(", ")])
EVENT_COLUMNS = [c.split()[0] for c in EVENT.split(", ")]
# part of the state's layout: a checkpoint keeps the number that it began with
BUCKETS = 2048
STORED = pa.schema([("event_fingerprint", pa.string())] + [(n, {"string": pa.string(), "long": pa.int64()}[t]) for n, t in (c.split() for c in EVENT.split(", "))])


def applied(event: dict | None, action: dict) -> dict | None:
    """The event after one action; a review of an unknown event changes nothing."""
    if action["action"] == "seen":
        old = event or {"status": None, "resolved_at": None}
        status = "open" if old["status"] in (None, "resolved") else old["status"]
        kept = {c: action[c] for c in ("domain", "event_code", "severity", "report_period", "run_id")}
        return kept | {"status": status, "detected_at": action["at"], "resolved_at": old["resolved_at"]}
    if event is None:
        return None
    resolved = action["at"] if action["status"] == "resolved" else event["resolved_at"]
    return event | {"status": action["status"], "resolved_at": resolved}


def packed(events: dict[str | None, tuple]) -> bytes:
    """Events by fingerprint as one value of the state: a compressed Arrow stream."""
    columns = [pa.array(c, t) for c, t in zip(zip(*[(k, *v) for k, v in events.items()]), STORED.types)]
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, STORED, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=STORED))
    return out.getvalue().to_pybytes()


def unpacked(value: bytes) -> dict[str | None, tuple]:
    fingerprints, *columns = [c.to_pylist() for c in pa.ipc.open_stream(value).read_all().columns]
    return dict(zip(fingerprints, zip(*columns)))


class Registry(StatefulProcessor):
    """One event per fingerprint; a key holds those of its bucket."""

    def init(self, handle) -> None:
        self.events = handle.getValueState("events", "packed binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        actions: dict[str | None, list[dict]] = {}
        for r in rows:
            action = r["action"]
            actions.setdefault(action["event_fingerprint"], []).append(action)
        known = unpacked(bytes(self.events.get()[0])) if self.events.exists() else {}
        changed = []
        for fingerprint, own in actions.items():
            values = known.get(fingerprint)
            old = None if values is None else dict(zip(EVENT_COLUMNS, values))
            event = old
            for action in sorted(own, key=lambda r: (r["at"], r["seq"])):
                event = applied(event, action)
            if event is None or event == old:
                continue
            known[fingerprint] = values = tuple([event[c] for c in EVENT_COLUMNS])
            is_open, was_open = event["status"] in OPEN, old is not None and old["status"] in OPEN
            before = [old[c] for c in ("severity", "domain", "report_period")] if was_open else [None] * 3
            changed.append(CHANGE(fingerprint, *values, int(is_open) - int(was_open), *before))
        if changed:
            self.events.update((packed(known),))
        yield from changed

    def close(self) -> None:
        pass


def registry_stream(actions: DataFrame) -> DataFrame:
    """Changed events of a stream of ``ACTIONS``."""
    actions.sparkSession.conf.set(*STORE)
    bucket = F.pmod(F.xxhash64("event_fingerprint"), F.lit(BUCKETS)).alias("bucket")
    # one cell a row: a row's way to Python costs by its cells
    rows = actions.select(bucket, F.struct(*ACTION_COLUMNS).alias("action"))
    return rows.groupBy("bucket").transformWithState(Registry(), CHANGES, "Update", "None")


def deltas(changes: DataFrame) -> DataFrame:
    """What changed events add to and take from the open events of their groups (``DELTAS``)."""
    open_ = F.col("status").isin(*OPEN)
    now = changes.where(open_).select("domain", "report_period", "severity", F.lit(1).cast("long").alias("change"), F.col("detected_at").alias("at"))
    before = changes.where("old_domain IS NOT NULL").select(
        F.col("old_domain").alias("domain"), F.col("old_period").alias("report_period"), F.col("old_severity").alias("severity"),
        F.lit(-1).cast("long").alias("change"), F.greatest("detected_at", "resolved_at").alias("at"))
    both = now.unionByName(before).groupBy("domain", "report_period", "severity").agg(F.sum("change").alias("change"), F.max("at").alias("at"))
    return both.where("change <> 0")


class Alerts(StatefulProcessor):
    """Open events of a (domain, period) by severity, and which alerts stand."""

    def __init__(self, thresholds: dict[tuple[str, str], int], renotify_ms: int | None):
        self.thresholds, self.renotify_ms = thresholds, renotify_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "severity string", "n long, notices int, raised boolean, at long")

    def _get(self, severity: str) -> tuple:
        return tuple(self.counts.getValue((severity,))) if self.counts.containsKey((severity,)) else (0, 0, False, 0)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        added: dict[str, list[int]] = {}
        for r in rows:
            sums = added.setdefault(r["severity"], [0, 0])
            sums[0], sums[1] = sums[0] + r["change"], max(sums[1], r["at"])
        for severity in sorted(added):
            n, notices, raised, at = self._get(severity)
            n, at = n + added[severity][0], max(at, added[severity][1])
            limit = self.thresholds.get((key[0], severity))
            due = limit is not None and n >= limit
            if due and not raised:
                notices += 1
                yield NOTICE(*key, severity, n, limit, notices, at)
                if self.renotify_ms is not None:
                    self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.renotify_ms)
            self.counts.updateValue((severity,), (n, notices, due, at))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        standing = [(s, v) for (s,), v in self.counts.iterator() if v[2]]
        for severity, (n, notices, _, at) in standing:
            self.counts.updateValue((severity,), (n, notices + 1, True, at))
            yield NOTICE(*key, severity, n, self.thresholds[key[0], severity], notices + 1, at)
        if standing:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.renotify_ms)

    def close(self) -> None:
        pass


def alert_stream(changes: DataFrame, thresholds: dict[tuple[str, str], int], renotify_ms: int | None = None) -> DataFrame:
    """Notices (``ALERTS``) of a stream of ``DELTAS``; ``thresholds`` by (domain, severity) are a small fixed table."""
    changes.sparkSession.conf.set(*STORE)
    mode = "None" if renotify_ms is None else "ProcessingTime"
    return changes.groupBy("domain", "report_period").transformWithState(Alerts(thresholds, renotify_ms), ALERTS, "Update", mode)


def _run(stream: DataFrame, handle, checkpoint: str) -> None:
    stream.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _replaced(df: DataFrame, path: str, batch: int) -> None:
    """A batch's rows, in the place of what the same batch left before a crash."""
    df.withColumn("_batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("_batch").parquet(path)


def run_registry(spark: SparkSession, actions: str, root: str, files_per_batch: int = 1000) -> DataFrame:
    """Applies all actions under a folder that are new since the last run; the registry as it is now."""
    source = spark.readStream.schema(ACTIONS).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(actions)
    _run(registry_stream(source), lambda df, k: _replaced(df, f"{root}/changes", k), f"{root}/_registry")
    return current(spark, root)


def current(spark: SparkSession, root: str) -> DataFrame:
    """The last state of every event that a run has yielded."""
    changes = spark.read.parquet(f"{root}/changes")
    last = changes.groupBy("event_fingerprint").agg(F.max_by(F.struct(*EVENT_COLUMNS), "_batch").alias("e"))
    return last.select("event_fingerprint", *[F.col(f"e.{c}").alias(c) for c in EVENT_COLUMNS])


def run_alerts(spark: SparkSession, root: str, thresholds: dict[tuple[str, str], int], renotify_ms: int | None = None) -> DataFrame:
    """Raises what the changes since the last run call for; all notices so far."""
    schema = spark.read.parquet(f"{root}/changes").schema
    source = spark.readStream.schema(schema).parquet(f"{root}/changes").withColumn("_batch", F.col("_batch").cast("long"))

    def sums(df: DataFrame, k: int) -> None:
        _replaced(deltas(df), f"{root}/deltas", k)

    _run(source, sums, f"{root}/_deltas")
    stream = spark.readStream.schema(DELTAS).parquet(f"{root}/deltas")
    _run(alert_stream(stream, thresholds, renotify_ms), lambda df, k: _replaced(df, f"{root}/notices", k), f"{root}/_alerts")
    return spark.read.schema(ALERTS).parquet(f"{root}/notices")


# executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
