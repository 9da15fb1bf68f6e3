"""Ticks of a stream: any cut into batches, repeated batches, retirement in two phases."""

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marginalia.session import shared_dir
from marginalia.streaming import ticks as ST

START, HOUR = datetime(2024, 1, 1), timedelta(hours=1)
DDL = "event_id long, page_id long, ts timestamp, edited_at timestamp, kind string, k long"


def at(minute):
    return START + timedelta(minutes=minute)


def feed(spark, rows):
    """(event_id, page_id, minute, k) or with a kind as fifth."""
    return spark.createDataFrame([(r[0], r[1], at(r[2]), at(int(r[2])), r[4] if len(r) > 4 else "page.updated", r[3]) for r in rows], DDL)


def shape(df):
    return df.withColumns({"status": F.col("k") % 3, "location": F.concat(F.lit("d/"), (F.col("k") % 2).cast("string"))})


def empty_seed(spark):
    return spark.createDataFrame([], ST.STATE)


def ticks(spark, step, rows, name="ticks"):
    return ST.Ticks(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", START, HOUR, step, feed(spark, rows))


def state_of(t, n):
    return {r.page_id: (r.edited_at, r.event_id, r.k) for r in t.tables.read("state", n, ST.STATE).collect()}


ROWS = [(i, i % 5, 7 * i % 240 if i % 6 else 30, i % 4) for i in range(40)]


def split(rows, seed):
    r = random.Random(seed)
    cuts = sorted(r.sample(range(1, len(rows)), 3))
    return [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]


@pytest.mark.parametrize("limit", [None, 7])
def test_any_split_into_batches_gives_the_same_state(spark, limit):
    in_order = sorted(ROWS, key=lambda r: (r[2], r[0]))
    want = {}
    for i, page, minute, k in ROWS:
        want[page] = max(want.get(page, (at(0), -1, 0)), (at(minute), i, k))
    whole = None
    for seed in range(3):
        t = ticks(spark, ST.sync_pages(empty_seed(spark), shape, limit), ROWS)
        # The last split comes in no order of time at all.
        rows = in_order if seed < 2 else random.Random(5).sample(ROWS, len(ROWS))
        for batch, part in enumerate(split(rows, seed)):
            t.deliver(feed(spark, part), batch)
        t.finish(more=0 if limit is None else 6)
        last = t._last()
        assert state_of(t, last) == want
        if seed < 2:
            told = [sorted(map(tuple, t.tables.every(name, ddl).collect()), key=repr) for name, ddl in (("candidates", ST.CANDIDATES), ("not_applied", ST.NOT_APPLIED), ("marks", ST.MARKS))]
            whole = whole or told
            assert told == whole
        # Every event was applied or is told with a reason.
        applied = {r.event_id for r in t.tables.every("state", ST.STATE).filter("effect <> 'kept'").collect()}
        left = {r.event_id for r in t.tables.every("not_applied", ST.NOT_APPLIED).collect()}
        assert applied | left == {r[0] for r in ROWS}


def test_a_repeated_batch_has_its_effect_once(spark):
    done = []

    def step(t, n, rows, end):
        t.write("seen", n, rows.select("event_id"))
        done.append(n)
        if n == 1 and done.count(1) == 1:
            raise RuntimeError("lost")

    t = ticks(spark, step, ROWS)
    first, second = [(1, 1, 5, 0), (2, 1, 70, 0)], [(2, 1, 70, 0), (3, 1, 80, 0), (4, 1, 200, 0), (5, 1, 10, 0)]
    t.deliver(feed(spark, first), 0)
    with pytest.raises(RuntimeError):
        t.deliver(feed(spark, second), 1)
    t.deliver(feed(spark, second), 1)
    t.finish()
    # The event for the closed window came with the next open one, the repeated event counts once.
    assert sorted((r.tick, r.event_id) for r in t.tables.every("seen", "event_id long").collect()) == [(0, 1), (1, 2), (1, 3), (1, 5), (3, 4)]
    assert done == [0, 1, 1, 2, 3]


def test_distinct_events_of_one_minute_are_applied_or_told(spark):
    t = ticks(spark, ST.sync_pages(empty_seed(spark), shape), ROWS)
    t.deliver(feed(spark, [(5, 1, 10, 1), (6, 2, 10, 1), (9, 9, 61, 0)]), 0)
    # Of the closed window: a larger id of the stored minute wins, a smaller one and an older one are told, a repeat is not.
    t.deliver(feed(spark, [(7, 1, 10, 2), (4, 2, 10, 3), (3, 2, 5, 4), (6, 2, 10, 1)]), 1)
    t.finish()
    assert {p: (i, k) for p, (_, i, k) in state_of(t, t._last()).items()} == {1: (7, 2), 2: (6, 1), 9: (9, 0)}
    assert sorted((r.event_id, r.reason) for r in t.tables.every("not_applied", ST.NOT_APPLIED).collect()) == [(3, "late"), (4, "same_time")]


def test_rebuild_and_two_phases(spark):
    # dirty: k = 1; refused: k = 2; queued: kind failed, key by page; homes: kind home, owning while k is even.
    step = ST.in_turn(
        ST.rebuild_when_changed(lambda r: r.filter("kind = 'page.updated' AND k = 1"), lambda r: r.filter("kind = 'page.updated' AND k = 2")),
        ST.retire(
            lambda r: r.filter("kind = 'failed'").select(F.col("page_id").cast("string").alias("key"), F.col("edited_at").alias("queued_at")),
            lambda r: r.filter("kind = 'home'").select("page_id", F.col("page_id").cast("string").alias("key"), F.col("edited_at").alias("at"), "event_id", (F.col("k") % 2 == 0).alias("owns")),
        ),
    )
    rows = [
        (1, 0, 1, 1), (2, 10, 2, 0, "failed"), (3, 20, 3, 0, "failed"), (4, 20, 4, 0, "home"), (5, 30, 5, 0, "failed"),  # tick 0 rebuilds
        (6, 10, 65, 0, "home"),  # tick 1: quiet; the owner of 10 is back, 30 is confirmed
        (7, 0, 130, 1), (8, 0, 131, 2), (9, 40, 132, 0, "failed"),  # tick 2: refused
        (10, 0, 190, 3), (11, 40, 191, 0, "failed"),  # tick 3: still dirty; 40 queued again before the rebuild's start
        (12, 40, 250, 0, "failed"),  # tick 4: quiet; 40 is queued anew over swept, and waits for a rebuild
    ]
    t = ticks(spark, step, rows)
    for batch, part in enumerate((rows[:3], rows[3:7], rows[7:])):
        t.deliver(feed(spark, part), batch)
    t.finish(more=1)
    rebuilt = sorted((r.tick, r.rebuild, r.last_started) for r in t.tables.every("rebuilds", ST.REBUILDS).collect())
    assert rebuilt == [(0, True, None), (1, False, at(60)), (2, False, at(60)), (3, True, at(60)), (4, False, at(240)), (5, False, at(240))]
    got = sorted((r.tick, r.key, r.action, r.owner) for r in t.tables.every("actions", ST.ACTIONS).collect())
    assert got == [(0, "10", "sweep", None), (0, "20", "dequeue", 20), (0, "30", "sweep", None), (1, "10", "resync", 10), (1, "30", "confirm", None), (3, "40", "sweep", None)]
    assert [(r.key, r.state) for r in t.tables.read("queue", 5, ST.QUEUE).collect()] == [("40", "queued")]


def test_failures_are_appended_tick_by_tick(spark):
    t = ticks(spark, ST.log_failures(lambda r: r.filter("kind = 'failed'").select("event_id")), ROWS)
    t.deliver(feed(spark, [(1, 1, 1, 0, "failed"), (2, 1, 2, 0), (3, 1, 70, 0, "failed")]), 0)
    assert [r.event_id for r in t.tables.every("failures", "event_id long").collect()] == [1]
    t.deliver(feed(spark, [(4, 1, 200, 0, "failed")]), 1)
    t.finish()
    assert sorted((r.tick, r.event_id) for r in t.tables.every("failures", "event_id long").collect()) == [(0, 1), (1, 3), (3, 4)]


def test_an_empty_stream_has_no_ticks(spark):
    t = ticks(spark, ST.sync_pages(empty_seed(spark), shape), ROWS)
    t.deliver(feed(spark, []), 0)
    t.finish(more=3)
    assert t._last() == -1 and t.tables.every("state", ST.STATE).count() == 0
