"""Ticks: the change feed cut into windows of event time, each handled once by a step.

A micro-batch files its events under their window. A window is closed when an event of a later
one has come; closed windows are handed to a step in order, one after another, so what a step
sees does not depend on where the batches are cut. An event for a window that is closed already
goes to the next open one. A step keeps its state in tables of one version a tick, reads the
version before its own and overwrites its own; after it comes the tick's commit. A batch that
runs again overwrites what it filed, skips the ticks it has committed and repeats the one it has
not, so every tick has its effect once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state as S
from ..session import shared_dir
from .feed import apply_tick, below

Step = Callable[["Tables", int, DataFrame, datetime], None]


class Tables:
    """Tables below one folder with one version a tick."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, name: str, tick: int, rows: DataFrame) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/tick={tick}")
        return self.read(name, tick, _ddl(rows))

    def read(self, name: str, tick: int, ddl: str) -> DataFrame:
        """One version; no rows where the tick wrote none."""
        return below(self.spark, f"{self.root}/{name}/tick={tick}", ddl)

    def every(self, name: str, ddl: str) -> DataFrame:
        """All versions, told apart by ``tick``."""
        return below(self.spark, f"{self.root}/{name}", f"{ddl}, tick int")


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)


class Ticks:
    """Files batches and closes windows of ``width`` from ``start`` on. ``at`` is the event time, ``key`` tells events apart."""

    def __init__(self, spark: SparkSession, root: str, start: datetime, width: timedelta, step: Step, schema: DataFrame, at: str = "ts", key: str = "event_id"):
        self.spark, self.root, self.start, self.width, self.step, self.at, self.key = spark, root.rstrip("/"), start, width, step, at, key
        self.columns, self.ddl = schema.columns, _ddl(schema)
        self.tables = Tables(spark, self.root)

    def _last(self, before: int | None = None) -> int:
        """Number of the last committed tick, of an earlier batch if one is given; -1 if there is none."""
        rows = self.tables.every("commits", "batch bigint")
        rows = rows if before is None else rows.filter(F.col("batch") < before)
        return rows.agg(F.coalesce(F.max("tick"), F.lit(-1))).first()[0]

    def _inbox(self) -> DataFrame:
        return below(self.spark, f"{self.root}/inbox", f"{self.ddl}, batch bigint, tick int")

    def deliver(self, rows: DataFrame, batch: int) -> None:
        seconds = F.unix_seconds(F.col(self.at)) - F.unix_seconds(F.lit(self.start).cast("timestamp"))
        own = F.floor(seconds / int(self.width.total_seconds())).cast("int")
        tick = F.greatest(F.coalesce(own, F.lit(0)), F.lit(self._last(batch) + 1))
        rows.withColumn("tick", tick).write.mode("overwrite").partitionBy("tick").parquet(f"{self.root}/inbox/batch={batch}")
        newest = self._inbox().filter(F.col("batch") <= batch).agg(F.max("tick")).first()[0]
        self._close(-1 if newest is None else newest - 1, batch)

    def _close(self, last: int, batch: int) -> None:
        for n in range(self._last() + 1, last + 1):
            rows = self._inbox().filter((F.col("tick") == n) & (F.col("batch") <= batch)).select(*self.columns)
            self.step(self.tables, n, rows.dropDuplicates([self.key]), self.start + (n + 1) * self.width)
            mark = self.spark.range(1).select(F.lit(batch).cast("bigint").alias("batch"))
            mark.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/tick={n}")

    def finish(self, more: int = 0) -> None:
        """Close the open window, too, and ``more`` empty ones after it."""
        newest, batch = self._inbox().agg(F.max("tick"), F.max("batch")).first()
        if newest is not None:
            self._close(newest + more, batch)


def run(stream: DataFrame, name: str, start: datetime, width: timedelta, step: Step, more: int = 0) -> Tables:
    """Run a stream over all available input, tick by tick, and return the tables of its step."""
    root = f"{shared_dir(stream.sparkSession)}/{name}-{uuid.uuid4().hex}"
    ticks = Ticks(stream.sparkSession, root, start, width, step, stream)
    writer = stream.writeStream.foreachBatch(ticks.deliver).option("checkpointLocation", f"{root}/offsets")
    writer.trigger(availableNow=True).start().awaitTermination()
    ticks.finish(more)
    return ticks.tables


# --- synchronising pages ------------------------------------------------------------------------

STATE = "page_id bigint, edited_at timestamp, event_id bigint, k bigint, status bigint, location string, effect string, artifact_present boolean"
CANDIDATES = "event_id bigint, page_id bigint, edited_at timestamp, k bigint"
NOT_APPLIED = "event_id bigint, page_id bigint, edited_at timestamp, k bigint, reason string"
MARKS = "watermark timestamp, due bigint"


def sync_pages(seed: DataFrame, shape: Callable[[DataFrame], DataFrame], limit: int | None = None) -> Step:
    """A step that picks what is due and brings the pages' state up to date.

    Due are the oldest ``limit`` events, extended over equal edit times; the others wait in
    ``carry``. Events processed already are dropped from the ``candidates``: those of a page's
    stored edit time, unless their id is larger than the stored one. The newest candidate of a
    page, by edit time and id, is written to ``state`` if it is newer than what is stored;
    everything else but repeats of a stored event goes to ``not_applied``, with the reason.
    ``shape`` adds status and location; ``seed`` is the state before the first tick.
    """
    version = lambda at, i: F.struct(F.col(at), F.coalesce(F.col(i), F.lit(2**63 - 1)))

    def step(t: Tables, n: int, rows: DataFrame, end: datetime) -> None:
        waiting = rows.select("event_id", "page_id", "edited_at", "k").unionByName(t.read("carry", n - 1, CANDIDATES))
        if limit is None:
            due = t.write("due", n, waiting)
        else:
            cut = waiting.select("edited_at").orderBy("edited_at").limit(limit).agg(F.max("edited_at")).first()[0]
            taken = F.col("edited_at") <= F.lit(cut).cast("timestamp")
            due = t.write("due", n, waiting.filter(F.coalesce(taken, F.lit(False))))
            t.write("carry", n, waiting.filter(~F.coalesce(taken, F.lit(False))))
        before = t.read("state", n - 1, STATE) if n else seed.select(*[F.col(c.split()[0]) for c in STATE.split(", ")])
        old = before.select("page_id", F.col("edited_at").alias("old_at"), F.col("event_id").alias("old_id"))
        known = due.join(old, "page_id", "left")
        repeat = F.coalesce(F.col("event_id") == F.col("old_id"), F.lit(False))
        done = F.coalesce((F.col("edited_at") == F.col("old_at")) & (version("edited_at", "event_id") <= version("old_at", "old_id")), F.lit(False))
        candidates = t.write("candidates", n, known.filter(~done).select("event_id", "page_id", "edited_at", "k"))
        newest = candidates.groupBy("page_id").agg(F.max_by(F.struct("edited_at", "event_id", "k"), F.struct("edited_at", "event_id")).alias("s")).select("page_id", "s.*")
        fresh = newest.join(old, "page_id", "left").filter(F.col("old_at").isNull() | (version("edited_at", "event_id") > version("old_at", "old_id")))
        incoming = shape(fresh.select("page_id", "edited_at", "event_id", "k"))
        after = apply_tick(incoming, before, "page_id", ["status"], "k", "location")
        applied = t.write("state", n, after).filter("effect <> 'kept'").select("page_id", F.col("event_id").alias("applied"))
        left = known.filter(~repeat).join(applied, "page_id", "left").filter(F.col("applied").isNull() | (F.col("applied") != F.col("event_id")))
        reason = F.when(done, "same_time").when(version("edited_at", "event_id") < version("old_at", "old_id"), "late").otherwise("superseded")
        t.write("not_applied", n, left.select("event_id", "page_id", "edited_at", "k", reason.alias("reason")))
        t.write("marks", n, due.agg(F.max("edited_at").alias("watermark"), F.count("*").alias("due")))

    return step


# --- rebuilding and retiring --------------------------------------------------------------------

REBUILDS = "newest timestamp, changes bigint, last_started timestamp, rebuild boolean, started_at timestamp"
QUEUE = "key string, state string, queued_at timestamp"
OWNERS = "page_id bigint, key string, at timestamp, event_id bigint, owns boolean"
ACTIONS = "key string, state string, action string, owner bigint"


def rebuild_when_changed(changes: Callable[[DataFrame], DataFrame], refused: Callable[[DataFrame], DataFrame]) -> Step:
    """A step that records a rebuild's start when a change is newer than the last recorded start.

    The start is the tick's end. A tick with ``refused`` rows rebuilds nothing and records no start,
    so its changes are still newer than the last start when the next tick looks.
    """

    def step(t: Tables, n: int, rows: DataFrame, end: datetime) -> None:
        own = changes(rows).agg(F.max("edited_at").alias("newest"), F.count("*").alias("changes"))
        past = t.every("rebuilds", REBUILDS).filter(F.col("tick") < n)
        one = {"older": past.agg(F.max("newest")).scalar(), "last_started": past.agg(F.max("started_at")).scalar(), "stop": refused(rows).agg(F.count("*") > 0).scalar()}
        seen = own.withColumns(one).withColumn("newest", F.greatest("newest", "older"))
        dirty = F.col("newest").isNotNull() & (F.col("last_started").isNull() | (F.col("newest") > F.col("last_started")))
        rebuild = dirty & ~F.col("stop")
        start = F.when(F.col("rebuild"), F.lit(end).cast("timestamp"))
        t.write("rebuilds", n, seen.withColumn("rebuild", rebuild).select("newest", "changes", "last_started", "rebuild", start.alias("started_at")))

    return step


def retire(queued: Callable[[DataFrame], DataFrame], owned: Callable[[DataFrame], DataFrame]) -> Step:
    """A step that retires artifact keys in two phases, after ``rebuild_when_changed`` of the same tick.

    ``queued`` gives ``key, queued_at`` of keys to retire, ``owned`` ``page_id, key, at, event_id, owns``:
    whether a page lives at a key from then on. A key queued again starts anew.
    """

    def step(t: Tables, n: int, rows: DataFrame, end: datetime) -> None:
        pages = t.read("owners", n - 1, OWNERS).unionByName(owned(rows))
        newest = F.max_by(F.struct("key", "at", "event_id", "owns"), F.struct("at", "event_id")).alias("s")
        owners = t.write("owners", n, pages.groupBy("page_id").agg(newest).select("page_id", "s.*"))
        living = owners.filter("owns").groupBy("key").agg(F.min("page_id").alias("page_id"))
        new = queued(rows).groupBy("key").agg(F.max("queued_at").alias("queued_at")).select("key", F.lit("queued").alias("state"), "queued_at")
        kept = t.read("queue", n - 1, QUEUE).join(new.select("key"), "key", "left_anti")
        queue = kept.unionByName(new)
        last = t.every("rebuilds", REBUILDS).filter(F.col("tick") <= n).agg(F.max("started_at")).first()[0]
        actions = t.write("actions", n, S.retire_artifacts(queue, living, F.lit(last).cast("timestamp")))
        swept = actions.filter("action = 'sweep'").select("key", F.lit("swept").alias("state"), F.lit(None).cast("timestamp").alias("queued_at"))
        t.write("queue", n, queue.join(actions.select("key"), "key", "left_anti").unionByName(swept))

    return step


def log_failures(failed: Callable[[DataFrame], DataFrame]) -> Step:
    """A step that appends a tick's failures to the log; a repeated tick writes its own part again."""

    def step(t: Tables, n: int, rows: DataFrame, end: datetime) -> None:
        t.write("failures", n, failed(rows))

    return step


def in_turn(*steps: Step) -> Step:
    def step(t: Tables, n: int, rows: DataFrame, end: datetime) -> None:
        for one in steps:
            one(t, n, rows, end)

    return step

