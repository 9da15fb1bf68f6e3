"""Incremental maintenance as batch queries over the change feed."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators import state as S
from ..sources import sinks
from ..sources import tables as T
from ..streaming import feed as SF
from ..streaming import ticks as ST
from . import ctes

QUERIES = {}
CHECKS = {}


def query(name: str, check: str | None):
    def add(fn):
        QUERIES[name] = fn
        if check:
            CHECKS[name] = check
        return fn

    return add


def with_state(body: str) -> str:
    return f"WITH {ctes.STATE}\n{body}"



def watermark():
    return F.lit(T.CUTOFF).cast("timestamp")


SINCE = "edited_at > TIMESTAMP '2024-01-14 23:59:00'"
TICK = 50


@query("changed_since", with_state(f"SELECT event_id, page_id, edited_at FROM sync_events WHERE {SINCE} AND kind <> 'failed'"))
def changed_since(spark, folder):
    e = S.changed_since(T.sync_events(spark, folder, since=T.LOOKED_BACK), watermark())
    return e.filter("kind <> 'failed'").select("event_id", "page_id", "edited_at")


@query("point_lookup", with_state("SELECT page_id, edited_at, k FROM stored_state WHERE page_id = 7"))
def point_lookup(spark, folder):
    return T.stored_state(spark, folder).filter(F.col("page_id") == 7)


@query("recent_pages", with_state("SELECT page_id, edited_at, event_id FROM sync_events ORDER BY edited_at DESC, event_id DESC LIMIT 50"))
def recent_pages(spark, folder):
    e = T.sync_events(spark, folder).select("page_id", "edited_at", "event_id")
    return e.orderBy(F.desc("edited_at"), F.desc("event_id")).limit(50)


@query("oldest_first_feed", with_state(f"SELECT page_id, edited_at, event_id FROM sync_events WHERE {SINCE} ORDER BY edited_at, event_id"))
def oldest_first_feed(spark, folder):
    e = S.changed_since(T.sync_events(spark, folder, since=T.LOOKED_BACK), watermark()).select("page_id", "edited_at", "event_id")
    return e.orderBy("edited_at", "event_id")


@query(
    "take_n_with_ties",
    with_state(f"SELECT event_id, page_id, edited_at FROM sync_events WHERE {SINCE} QUALIFY rank() OVER (ORDER BY edited_at) <= {TICK}"),
)
def take_n_with_ties(spark, folder):
    e = S.changed_since(T.sync_events(spark, folder, since=T.LOOKED_BACK), watermark())
    return S.take_with_ties(e, TICK).select("event_id", "page_id", "edited_at")


@query(
    "queue_latest",
    with_state(
        "SELECT page_id, event_id, edited_at, kind FROM sync_events QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY edited_at DESC, event_id DESC) = 1"
    ),
)
def queue_latest(spark, folder):
    return S.newest_per_page(T.sync_events(spark, folder)).select("page_id", "event_id", "edited_at", "kind")


@query(
    "candidate_dedupe",
    with_state(
        "SELECT c.page_id, c.edited_at FROM changed_feed c WHERE NOT EXISTS (SELECT 1 FROM stored_state s WHERE s.page_id = c.page_id AND s.edited_at = c.edited_at)"
    ),
)
def candidate_dedupe(spark, folder):
    return S.drop_processed(T.changed_feed(spark, folder), T.stored_state(spark, folder)).select("page_id", "edited_at")


@query(
    "max_watermark",
    with_state(
        f"SELECT coalesce(max(edited_at), TIMESTAMP '{T.CUTOFF}') AS watermark, 'batch' AS source FROM sync_events WHERE {SINCE} "
        f"UNION ALL SELECT TIMESTAMP '{T.CUTOFF}', 'empty'"
    ),
)
def max_watermark(spark, folder):
    batch = S.changed_since(T.sync_events(spark, folder, since=T.LOOKED_BACK), watermark())
    moved = S.advance_watermark(batch, watermark()).withColumn("source", F.lit("batch"))
    kept = S.advance_watermark(batch.filter("page_id IS NULL"), watermark()).withColumn("source", F.lit("empty"))
    return moved.unionByName(kept)


@query(
    "state_upsert",
    with_state(
        "SELECT page_id, edited_at, k FROM (SELECT *, 0 AS new FROM stored_state UNION ALL SELECT *, 1 FROM changed_feed) "
        "QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY edited_at DESC, new DESC) = 1"
    ),
)
def state_upsert(spark, folder):
    return S.upsert(T.stored_state(spark, folder), T.changed_feed(spark, folder), ["page_id"], "edited_at")


CHANGES = """, inc AS (SELECT page_id, edited_at, k, k % 3 AS status, concat('docs/', CAST(k % 5 AS VARCHAR)) AS location FROM changed_feed),
old AS (SELECT page_id, edited_at, k, k % 3 AS status, concat('docs/', CAST(k % 5 AS VARCHAR)) AS location, page_id % 10 <> 3 AS present
  FROM stored_state WHERE k >= 20),
classed AS (
  SELECT i.*, CASE WHEN o.page_id IS NULL THEN 'new' WHEN i.location <> o.location THEN 'moved'
    WHEN i.status IS DISTINCT FROM o.status OR i.k IS DISTINCT FROM o.k OR NOT o.present THEN 'changed' ELSE 'unchanged' END AS change,
    o.location AS old_location FROM inc i LEFT JOIN old o USING (page_id))"""


def incoming_rows(df):
    return df.withColumns(
        {"status": F.col("k") % 3, "location": F.concat(F.lit("docs/"), (F.col("k") % 5).cast("string"))}
    )


def stored_rows(spark, folder):
    old = incoming_rows(T.stored_state(spark, folder)).filter("k >= 20")
    return old.withColumn("artifact_present", F.col("page_id") % 10 != 3)


@query(
    "change_detection",
    with_state(f"{CHANGES} SELECT page_id, change, CASE WHEN change = 'moved' THEN old_location END AS old_location FROM classed"),
)
def change_detection(spark, folder):
    out = S.classify_changes(
        incoming_rows(T.changed_feed(spark, folder)), stored_rows(spark, folder), "page_id", ["status"], "k", "location"
    )
    return out.select("page_id", "change", "old_location")


@query(
    "metadata_diff",
    with_state(
        """, j AS (SELECT coalesce(o.page_id, n.page_id) AS page_id, o.k AS ok, n.k AS nk, o.edited_at AS oe, n.edited_at AS ne
  FROM (SELECT * FROM stored_state WHERE k >= 20) o FULL JOIN changed_feed n ON o.page_id = n.page_id),
d AS (SELECT page_id, 'content_hash' AS field, coalesce(CAST(ok AS VARCHAR), '') AS old, coalesce(CAST(nk AS VARCHAR), '') AS new FROM j
  UNION ALL SELECT page_id, 'status', coalesce(CAST(ok % 3 AS VARCHAR), ''), coalesce(CAST(nk % 3 AS VARCHAR), '') FROM j
  UNION ALL SELECT page_id, 'last_edited', coalesce(strftime(oe, '%Y-%m-%d %H:%M:%S'), ''), coalesce(strftime(ne, '%Y-%m-%d %H:%M:%S'), '') FROM j)
SELECT * FROM d WHERE old <> new"""
    ),
)
def metadata_diff(spark, folder):
    shape = lambda df: df.select(
        "page_id", F.col("k").alias("content_hash"), "status", F.col("edited_at").alias("last_edited")
    )
    return S.field_differences(
        shape(stored_rows(spark, folder)), shape(incoming_rows(T.changed_feed(spark, folder))),
        "page_id", ["content_hash", "status", "last_edited"],
    )


@query(
    "stale_artifacts",
    with_state(
        """, q AS (SELECT concat('docs/', CAST(event_id % 400 AS VARCHAR)) AS key, max(edited_at) AS queued_at,
    CASE WHEN max(event_id) % 7 = 0 THEN 'swept' ELSE 'queued' END AS state FROM sync_events WHERE kind = 'failed' GROUP BY 1),
owners AS (SELECT concat('docs/', CAST(page_id AS VARCHAR)) AS key, page_id FROM stored_state),
r AS (SELECT max(edited_at) - INTERVAL 5 DAY AS rebuilt FROM sync_events)
SELECT q.key, q.state, o.page_id AS owner, CASE WHEN state = 'swept' AND o.page_id IS NOT NULL THEN 'resync' WHEN state = 'swept' THEN 'confirm'
  WHEN o.page_id IS NOT NULL THEN 'dequeue' ELSE 'sweep' END AS action
FROM q LEFT JOIN owners o USING (key) WHERE state = 'swept' OR queued_at < (SELECT rebuilt FROM r)"""
    ),
)
def stale_artifacts(spark, folder):
    e = T.sync_events(spark, folder)
    queue = retire_queue(e)
    owners = T.stored_state(spark, folder).select(
        F.concat(F.lit("docs/"), F.col("page_id").cast("string")).alias("key"), "page_id"
    )
    rebuilt = e.agg((F.max("edited_at") - F.expr("INTERVAL 5 DAYS")).alias("t")).scalar()
    return S.retire_artifacts(queue, owners, rebuilt).select("key", "state", "owner", "action")


def retire_queue(e):
    key = F.concat(F.lit("docs/"), (F.col("event_id") % 400).cast("string"))
    q = e.filter("kind = 'failed'").groupBy(key.alias("key")).agg(
        F.max("edited_at").alias("queued_at"), F.max("event_id").alias("last")
    )
    return q.select("key", "queued_at", F.when(F.col("last") % 7 == 0, "swept").otherwise("queued").alias("state"))


FAILED = """, failures AS (
  SELECT event_id, page_id, ts, CASE k % 8 WHEN 0 THEN 429 WHEN 1 THEN 503 WHEN 2 THEN 404 ELSE NULL END AS status_code,
    CASE k % 8 WHEN 3 THEN 'JSON parse failed' WHEN 4 THEN 'schema mismatch' WHEN 5 THEN 'boom' ELSE concat('status ', CAST(k % 8 AS VARCHAR)) END AS message,
    CASE k % 8 WHEN 6 THEN 'network' WHEN 7 THEN 'abort' END AS failure, CAST(k % 4 AS INT) AS attempts FROM sync_events WHERE kind = 'failed'),
classified AS (
  SELECT *, CASE WHEN failure = 'network' THEN 'network' WHEN failure = 'abort' THEN 'timeout' WHEN status_code = 429 THEN 'rate_limit'
    WHEN status_code >= 500 THEN 'http_5xx' WHEN status_code >= 400 THEN 'http_4xx'
    WHEN regexp_matches(message, 'JSON|parse|schema|validation') THEN 'validation' ELSE 'unknown' END AS category FROM failures)"""


def classified_failures(spark, folder):
    return classify_failures(T.sync_events(spark, folder))


def classify_failures(events):
    m = F.col("k") % 8
    rows = events.filter("kind = 'failed'").select(
        "event_id", "page_id", "ts",
        F.when(m == 0, 429).when(m == 1, 503).when(m == 2, 404).alias("status_code"),
        F.when(m == 3, "JSON parse failed").when(m == 4, "schema mismatch").when(m == 5, "boom")
        .otherwise(F.concat(F.lit("status "), m.cast("string"))).alias("message"),
        F.when(m == 6, "network").when(m == 7, "abort").alias("failure"),
        (F.col("k") % 4).cast("int").alias("attempts"),
    )
    return rows.withColumn("category", Q.error_category("status_code", "message", "failure"))


# Ticks of the streamed queries; the first one begins before the first event, or before the cut of the stored state.
DAYS, BEGIN, RESUME = 5, datetime(2024, 1, 1), datetime(2024, 1, 14)


def tick_sql(start: datetime) -> str:
    return f"CAST(floor((floor(epoch(ts)) - epoch(TIMESTAMP '{start}')) / {DAYS * 86400}) AS INTEGER)"


def run_ticks(stream, name, start, step, more=0):
    return ST.run(stream, name, start, timedelta(days=DAYS), step, more)


@query("failure_log", with_state(f"SELECT event_id, page_id, ts, {tick_sql(BEGIN)} AS tick FROM sync_events WHERE kind = 'failed'"))
def failure_log(spark, folder):
    stream = SF.shape(SF.open_events(spark, folder))
    failed = lambda rows: rows.filter("kind = 'failed'").select("event_id", "page_id", "ts")
    t = run_ticks(stream, "failure_log", BEGIN, ST.log_failures(failed))
    return t.every("failures", "event_id bigint, page_id bigint, ts timestamp")


@query("error_classify", with_state(f"{FAILED} SELECT category, category IN ('network', 'timeout', 'rate_limit', 'http_5xx') AS retryable, count(*) AS n FROM classified GROUP BY 1, 2"))
def error_classify(spark, folder):
    e = classified_failures(spark, folder)
    return e.groupBy("category", Q.is_retryable("category").alias("retryable")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "error_summary",
    with_state(
        f"""{FAILED} SELECT 'total' AS line, '' AS name, count(*) AS n FROM classified
UNION ALL SELECT 'category', category, count(*) FROM classified GROUP BY category
UNION ALL SELECT * FROM (SELECT 'message', message, count(*) AS c FROM classified GROUP BY message ORDER BY c DESC, message LIMIT 5)"""
    ),
)
def error_summary(spark, folder):
    return Q.error_summary(classified_failures(spark, folder))


@query(
    "retry_routing",
    with_state(
        f"""{FAILED} SELECT event_id, category, CASE WHEN category IN ('network', 'timeout', 'rate_limit', 'http_5xx') AND attempts < 3 THEN 'retry' ELSE 'dead_letter' END AS route,
  CASE WHEN category IN ('network', 'timeout', 'rate_limit', 'http_5xx') AND attempts < 3 THEN ts + INTERVAL 60 SECOND END AS next_at FROM classified"""
    ),
)
def retry_routing(spark, folder):
    f = classified_failures(spark, folder).withColumnRenamed("ts", "failed_at")
    return S.route_failures(f).select("event_id", "category", "route", "next_at")


@query(
    "job_status_rollup",
    with_state(
        """, jobs AS (SELECT event_id, event_id % 500 AS job_id, ts, CASE kind WHEN 'page.created' THEN 'queued' WHEN 'page.updated' THEN
    (CASE WHEN k % 2 = 0 THEN 'running' ELSE 'skipped' END) WHEN 'failed' THEN 'failed' ELSE 'completed' END AS status FROM sync_events),
j AS (SELECT job_id, last(status ORDER BY ts, event_id) AS status, count(*) AS attempts, min(ts) AS s,
    max(CASE WHEN status IN ('completed', 'failed', 'skipped') THEN ts END) AS f FROM jobs GROUP BY job_id)
SELECT status, count(*) AS jobs, CAST(sum(attempts) AS BIGINT) AS attempts,
  max(CAST(floor(epoch(f)) - floor(epoch(s)) AS BIGINT)) AS longest_seconds FROM j GROUP BY status"""
    ),
)
def job_status_rollup(spark, folder):
    return S.job_status_report(job_rows(T.sync_events(spark, folder)))


def job_rows(e):
    status = (
        F.when(F.col("kind") == "page.created", "queued")
        .when((F.col("kind") == "page.updated") & (F.col("k") % 2 == 0), "running")
        .when(F.col("kind") == "page.updated", "skipped")
        .when(F.col("kind") == "failed", "failed")
        .otherwise("completed")
    )
    return e.select("event_id", (F.col("event_id") % 500).alias("job_id"), F.col("ts").alias("at"), status.alias("status"))


# --- ticks -------------------------------------------------------------------------


RESUMED = f""", resumed AS (SELECT *, {tick_sql(RESUME)} AS tick FROM sync_events WHERE edited_at >= TIMESTAMP '{T.LOOKED_BACK}')"""


def seeded(spark, folder):
    """State before the first tick, with the ids of its events unknown."""
    stored = stored_rows(spark, folder).withColumns({"event_id": F.lit(None).cast("bigint"), "effect": F.lit("kept")})
    return stored.withColumn("status", F.col("status").cast("bigint"))


def resumed(spark, folder):
    """The feed from the looked-back watermark on, as a stream."""
    return SF.shape(SF.open_events(spark, folder)).filter(F.col("edited_at") >= F.lit(T.LOOKED_BACK).cast("timestamp"))


@query(
    "incremental_candidates",
    f"""WITH RECURSIVE {ctes.STATE}{RESUMED},
cuts AS (
  SELECT -1 AS n, TIMESTAMP '2000-01-01 00:00:00' AS cut
  UNION ALL
  SELECT n, coalesce(max(e), any_value(cut)) FROM (
    SELECT c.n + 1 AS n, c.cut, unnest(list_sort(list(r.edited_at) FILTER (r.edited_at > c.cut AND r.tick <= c.n + 1))[1:{TICK}]) AS e
    FROM cuts c CROSS JOIN resumed r WHERE c.n < (SELECT max(tick) FROM resumed) GROUP BY c.n, c.cut) GROUP BY n)
SELECT e.event_id, e.page_id, e.edited_at, c.n AS tick FROM cuts c JOIN cuts p ON p.n = c.n - 1 JOIN resumed e ON e.edited_at > p.cut AND e.edited_at <= c.cut
WHERE NOT EXISTS (SELECT 1 FROM stored_state s WHERE s.k >= 20 AND s.page_id = e.page_id AND s.edited_at = e.edited_at)""",
)
def incremental_candidates(spark, folder):
    t = run_ticks(resumed(spark, folder), "candidates", RESUME, ST.sync_pages(seeded(spark, folder), incoming_rows, TICK))
    return t.every("candidates", ST.CANDIDATES).select("event_id", "page_id", "edited_at", "tick")


@query(
    "incremental_upsert",
    with_state(
        f"""{RESUMED},
news AS (SELECT page_id, tick, edited_at, event_id, k FROM resumed QUALIFY row_number() OVER (PARTITION BY page_id, tick ORDER BY edited_at DESC, event_id DESC) = 1),
versions AS (
  SELECT page_id, -1 AS tick, edited_at, k, page_id % 10 <> 3 AS present FROM stored_state WHERE k >= 20
  UNION ALL SELECT page_id, tick, edited_at, k, true FROM news n
  WHERE NOT EXISTS (SELECT 1 FROM stored_state s WHERE s.k >= 20 AND s.page_id = n.page_id AND s.edited_at = n.edited_at)),
told AS (
  SELECT *, k % 3 AS status, concat('docs/', CAST(k % 5 AS VARCHAR)) AS location, row_number() OVER w AS nth, lag(k) OVER w AS old_k, lag(present) OVER w AS old_present,
    row_number() OVER (PARTITION BY page_id ORDER BY tick DESC) = 1 AS last FROM versions WINDOW w AS (PARTITION BY page_id ORDER BY tick))
SELECT tick, page_id, edited_at, k, status, location, CASE WHEN nth > 1 AND old_k = k AND old_present THEN 'touched' ELSE 'written' END AS effect FROM told WHERE tick >= 0
UNION ALL SELECT (SELECT max(tick) FROM resumed), page_id, edited_at, k, status, location, 'kept' FROM told WHERE last AND tick < (SELECT max(tick) FROM resumed)"""
    ),
)
def incremental_upsert(spark, folder):
    t = run_ticks(resumed(spark, folder), "upsert", RESUME, ST.sync_pages(seeded(spark, folder), incoming_rows))
    rows = t.every("state", ST.STATE)
    last = rows.agg(F.max("tick").alias("tick")).scalar()
    shown = rows.filter((F.col("effect") != "kept") | (F.col("tick") == last))
    return shown.select("tick", "page_id", "edited_at", "k", "status", "location", "effect")


def rare_changes(rows):
    return rows.filter("kind <> 'failed' AND event_id % 1700 = 11")


def refusals(rows):
    return rows.filter("kind = 'failed' AND event_id % 900 = 5")


# Rebuilds by tick: dirty while a change has come since the last tick that rebuilt.
REBUILT = f""", timed AS (SELECT *, {tick_sql(BEGIN)} AS tick FROM sync_events),
per_tick AS (
  SELECT n AS tick, TIMESTAMP '{BEGIN}' + INTERVAL {DAYS} DAY * (n + 1) AS ends,
    (SELECT max(edited_at) FROM timed WHERE tick <= n AND kind <> 'failed' AND event_id % 1700 = 11) AS newest,
    (SELECT count(*) FROM timed WHERE tick = n AND kind <> 'failed' AND event_id % 1700 = 11) AS changes,
    (SELECT count(*) FROM timed WHERE tick = n AND kind = 'failed' AND event_id % 900 = 5) > 0 AS refused
  FROM (SELECT unnest(range((SELECT max(tick) FROM timed) + 1 + $more)) AS n)),
rebuilds AS (
  SELECT -1 AS tick, CAST(NULL AS TIMESTAMP) AS newest, CAST(0 AS BIGINT) AS changes, CAST(NULL AS TIMESTAMP) AS last_started, false AS rebuild, CAST(NULL AS TIMESTAMP) AS started
  UNION ALL
  SELECT p.tick, p.newest, p.changes, r.started, p.newest IS NOT NULL AND (r.started IS NULL OR p.newest > r.started) AND NOT p.refused,
    CASE WHEN p.newest IS NOT NULL AND (r.started IS NULL OR p.newest > r.started) AND NOT p.refused THEN p.ends ELSE r.started END
  FROM rebuilds r JOIN per_tick p ON p.tick = r.tick + 1)"""


@query(
    "dirty_rebuild",
    f"WITH RECURSIVE {ctes.STATE}{REBUILT.replace('$more', '0')} SELECT CAST(tick AS INTEGER) AS tick, newest, changes, last_started, rebuild FROM rebuilds WHERE tick >= 0",
)
def dirty_rebuild(spark, folder):
    stream = SF.shape(SF.open_events(spark, folder))
    t = run_ticks(stream, "rebuild", BEGIN, ST.rebuild_when_changed(rare_changes, refusals))
    return t.every("rebuilds", ST.REBUILDS).select("tick", "newest", "changes", "last_started", "rebuild")


@query(
    "late_events",
    with_state(f"SELECT kind, count(*) AS n FROM sync_events WHERE NOT ({SINCE}) GROUP BY kind"),
)
def late_events(spark, folder):
    return SF.late_events(T.sync_events(spark, folder), watermark())


@query(
    "tick_counts",
    with_state(
        f"""SELECT to_timestamp(floor(epoch(ts) / 300) * 300)::TIMESTAMP AS tick, count(*) AS candidates,
  count(*) FILTER (s.page_id IS NULL) AS enqueued, count(*) FILTER (s.page_id IS NOT NULL) AS deduped
FROM sync_events e LEFT JOIN stored_state s ON s.page_id = e.page_id AND s.edited_at = e.edited_at GROUP BY 1"""
    ),
)
def tick_counts(spark, folder):
    return SF.tick_counts(T.sync_events(spark, folder), T.stored_state(spark, folder))


# --- streams (run to completion with availableNow) -------------------------------------


@query(
    "event_stream",
    with_state("SELECT event_id, page_id, edited_at, kind FROM sync_events WHERE kind <> 'failed'"),
)
def event_stream(spark, folder):
    out = SF.run_to_table(SF.page_changes(SF.open_events(spark, folder)), "event_stream")
    return out.select("event_id", "page_id", "edited_at", "kind")


@query("event_dedupe", with_state("SELECT event_id, page_id, edited_at FROM sync_events"))
def event_dedupe(spark, folder):
    events = SF.with_repeats(SF.open_events(spark, folder))
    out = SF.run_once_each(SF.shape(events), "event_dedupe")
    return out.select("event_id", "page_id", "edited_at")


def queued_keys(rows):
    return rows.filter("kind = 'failed'").select(F.concat(F.lit("docs/"), (F.col("event_id") % 200).cast("string")).alias("key"), F.col("edited_at").alias("queued_at"))


def page_homes(rows):
    """A page lives at its key while its newest change has an even fingerprint."""
    changed = rows.filter("kind <> 'failed'")
    return changed.select("page_id", F.concat(F.lit("docs/"), F.col("page_id").cast("string")).alias("key"), F.col("edited_at").alias("at"), "event_id", (F.col("k") % 2 == 0).alias("owns"))


@query(
    "two_phase_retire",
    f"""WITH RECURSIVE {ctes.STATE}{REBUILT.replace('$more', '2')},
queued AS (SELECT concat('docs/', CAST(event_id % 200 AS VARCHAR)) AS key, tick, max(edited_at) AS since FROM timed WHERE kind = 'failed' GROUP BY ALL),
homes AS (
  SELECT concat('docs/', CAST(page_id AS VARCHAR)) AS key, page_id, tick, k % 2 = 0 AS owns FROM timed WHERE kind <> 'failed'
  QUALIFY row_number() OVER (PARTITION BY page_id, tick ORDER BY edited_at DESC, event_id DESC) = 1),
owned AS (
  SELECT p.tick, h.key, h.page_id FROM per_tick p JOIN homes h ON h.tick <= p.tick
  QUALIFY row_number() OVER (PARTITION BY p.tick, h.page_id ORDER BY h.tick DESC) = 1 AND h.owns),
walk AS (
  SELECT key, -1 AS tick, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS TIMESTAMP) AS since, CAST(NULL AS VARCHAR) AS was, CAST(NULL AS VARCHAR) AS action, CAST(NULL AS BIGINT) AS owner
  FROM (SELECT DISTINCT key FROM queued)
  UNION ALL
  SELECT key, tick, CASE WHEN action = 'sweep' THEN 'swept' WHEN action IS NULL THEN now END, CASE WHEN action IS NULL THEN since END, CASE WHEN action IS NOT NULL THEN now END, action,
    CASE WHEN action IS NOT NULL THEN page_id END
  FROM (SELECT *, CASE WHEN now = 'swept' AND page_id IS NOT NULL THEN 'resync' WHEN now = 'swept' THEN 'confirm'
      WHEN now = 'queued' AND since < started AND page_id IS NOT NULL THEN 'dequeue' WHEN now = 'queued' AND since < started THEN 'sweep' END AS action
    FROM (SELECT w.key, r.tick, CASE WHEN q.since IS NOT NULL THEN 'queued' ELSE w.state END AS now, coalesce(q.since, w.since) AS since, r.started, o.page_id
      FROM walk w JOIN rebuilds r ON r.tick = w.tick + 1 LEFT JOIN queued q ON q.key = w.key AND q.tick = r.tick LEFT JOIN owned o ON o.key = w.key AND o.tick = r.tick) z) y)
SELECT CAST(tick AS INTEGER) AS tick, key, was AS state, action, owner FROM walk WHERE action IS NOT NULL""",
)
def two_phase_retire(spark, folder):
    stream = SF.shape(SF.open_events(spark, folder))
    step = ST.in_turn(ST.rebuild_when_changed(rare_changes, refusals), ST.retire(queued_keys, page_homes))
    return run_ticks(stream, "retire", BEGIN, step, more=2).every("actions", ST.ACTIONS).select("tick", "key", "state", "action", "owner")
