"""Incremental state: change selection, comparison, upserts, retirement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import best_per_group
from . import quality as Q

LOOKBACK_SECONDS = 60
RETRY_DELAY_SECONDS = 60
MAX_ATTEMPTS = 3


def lookback(watermark: Column) -> Column:
    """Edit times have minute precision, so the last minute is read again."""
    return watermark - F.make_interval(secs=F.lit(LOOKBACK_SECONDS))


def changed_since(feed: DataFrame, watermark: Column) -> DataFrame:
    return feed.filter(F.col("edited_at") > lookback(watermark))


def take_with_ties(feed: DataFrame, n: int) -> DataFrame:
    """The oldest ``n`` rows, and every further row of the last edit time taken.

    The cut is one value found by a bounded top-n, so no global order is built.
    """
    cut = feed.select("edited_at").orderBy("edited_at").limit(n).agg(F.max("edited_at").alias("cut"))
    return feed.filter(F.col("edited_at") <= cut.scalar())


def newest_per_page(events: DataFrame) -> DataFrame:
    return best_per_group(
        events, ["page_id"],
        [-F.unix_micros("edited_at"), -F.col("event_id")],
        ["event_id", "edited_at", "kind", "k"],
    )


def drop_processed(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidates not yet processed at their edit time."""
    done = stored.select("page_id", "edited_at")
    return candidates.join(done, ["page_id", "edited_at"], "left_anti")


def advance_watermark(candidates: DataFrame, old: Column) -> DataFrame:
    """Newest edit time of the batch; unchanged when there were no candidates."""
    return candidates.agg(F.coalesce(F.max("edited_at"), old).alias("watermark"))


def upsert(stored: DataFrame, changes: DataFrame, key: list[str], version: str) -> DataFrame:
    """Insert or replace by key. On equal versions the change wins."""
    cols = [c for c in stored.columns if c not in key]
    rows = stored.withColumn("__new", F.lit(0)).unionByName(changes.select(*stored.columns).withColumn("__new", F.lit(1)))
    newest = F.max_by(F.struct(*cols), F.struct(version, "__new"))
    return rows.groupBy(*key).agg(newest.alias("r")).select(*key, *[F.col(f"r.{c}").alias(c) for c in cols])


def classify_changes(
    incoming: DataFrame, stored: DataFrame, key: str, row_fields: list[str], fingerprint: str, location: str
) -> DataFrame:
    """new, changed, moved or unchanged per incoming row.

    A row is unchanged only when the row fields, the fingerprint and the location agree
    and the stored artifact exists (``artifact_present``).
    """
    old = stored.select(
        key, *[F.col(c).alias(f"__old_{c}") for c in [*row_fields, fingerprint, location]],
        F.col("artifact_present").alias("__present"),
    ).withColumn("__known", F.lit(True))
    rows = incoming.join(old, key, "left")
    same = F.lit(True)
    for c in [*row_fields, fingerprint]:
        same = same & F.col(c).eqNullSafe(F.col(f"__old_{c}"))
    moved = ~F.col(location).eqNullSafe(F.col(f"__old_{location}"))
    change = (
        F.when(F.col("__known").isNull(), "new")
        .when(moved, "moved")
        .when(~same | ~F.coalesce("__present", F.lit(False)), "changed")
        .otherwise("unchanged")
    )
    keep = [F.col(c) for c in incoming.columns]
    return rows.select(*keep, change.alias("change"), F.when(change == "moved", F.col(f"__old_{location}")).alias("old_location"))


def field_differences(stored: DataFrame, current: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Old and new text per differing field; a missing value counts as empty text."""
    text = lambda side, c: F.coalesce(F.col(f"{side}.{c}").cast("string"), F.lit(""))
    both = stored.alias("o").join(current.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    pairs = F.array(
        *[F.struct(F.lit(c).alias("field"), text("o", c).alias("old"), text("n", c).alias("new")) for c in fields]
    )
    rows = both.select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), F.explode(pairs).alias("d"))
    return rows.select(key, "d.*").filter("old <> new")


def retire_artifacts(queue: DataFrame, owners: DataFrame, last_rebuild: Column) -> DataFrame:
    """Next step for queued artifact keys.

    A queued key older than the last rebuild is dequeued when a page owns it again and
    swept otherwise; a key swept earlier is confirmed, or its owner synced again.
    """
    owned = owners.select("key", F.col("page_id").alias("owner"))
    eligible = queue.filter((F.col("state") == "swept") | (F.col("queued_at") < last_rebuild))
    rows = eligible.join(owned, "key", "left")
    action = (
        F.when((F.col("state") == "swept") & F.col("owner").isNotNull(), "resync")
        .when(F.col("state") == "swept", "confirm")
        .when(F.col("owner").isNotNull(), "dequeue")
        .otherwise("sweep")
    )
    return rows.select("key", "state", action.alias("action"), "owner")


def orphans(present: DataFrame, written: DataFrame) -> DataFrame:
    """Outputs that exist but were not written by this run."""
    return present.select("key").distinct().join(written.select("key"), "key", "left_anti")


def latest_version(versions: DataFrame, column: str) -> DataFrame:
    """Rows of the newest version; no rows when nothing was published."""
    return versions.filter(F.col(column) == versions.agg(F.max(column).alias("v")).scalar())


def job_rollup(jobs: DataFrame) -> DataFrame:
    """One row per job: start kept once, finish set only by a terminal status."""
    terminal = F.col("status").isin("completed", "failed", "skipped")
    order = F.struct("at", "event_id")
    per_job = jobs.groupBy("job_id").agg(
        F.max_by("status", order).alias("status"),
        F.count(F.lit(1)).alias("attempts"),
        F.min("at").alias("started_at"),
        F.max(F.when(terminal, F.col("at"))).alias("finished_at"),
    )
    return per_job


def job_status_report(jobs: DataFrame) -> DataFrame:
    per_job = job_rollup(jobs)
    seconds = F.unix_seconds("finished_at") - F.unix_seconds("started_at")
    return per_job.groupBy("status").agg(
        F.count(F.lit(1)).alias("jobs"),
        F.sum("attempts").alias("attempts"),
        F.max(seconds).alias("longest_seconds"),
    )


def route_failures(failures: DataFrame) -> DataFrame:
    """Transient failures get a next attempt, permanent or exhausted ones a dead letter."""
    again = Q.is_retryable("category") & (F.col("attempts") < MAX_ATTEMPTS)
    later = F.col("failed_at") + F.make_interval(secs=F.lit(RETRY_DELAY_SECONDS))
    return failures.withColumns(
        {"route": F.when(again, "retry").otherwise("dead_letter"), "next_at": F.when(again, later)}
    )


def rebuild_needed(changes: DataFrame, last_started: Column) -> DataFrame:
    """Compare the newest change with the start of the last rebuild; a change landing
    during that rebuild is newer than its start and so survives to the next tick."""
    return changes.agg(F.max("changed_at").alias("newest"), F.count(F.lit(1)).alias("changes")).withColumn(
        "rebuild", F.coalesce(F.col("newest") > last_started, F.lit(False))
    )
