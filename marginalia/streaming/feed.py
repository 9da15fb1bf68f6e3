"""The change feed as micro-batches, and the tick logic in batch form.

A tick reads the feed from the watermark minus the lookback, keeps ties at its size
limit, drops what is already processed and advances the watermark after success. The
ticks of a stream are in ``ticks``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state as S
from ..session import shared_dir
from ..sources.tables import shape_events

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
KNOWN_TYPES = ("signup", "view", "click", "purchase")


def open_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream of files."""
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("pathGlobFilter", "events*.parquet")
        .parquet(folder)
    )


def shape(events: DataFrame) -> DataFrame:
    return shape_events(events)


def page_changes(events: DataFrame) -> DataFrame:
    """Change rows of known event types; unknown shapes are rejected."""
    known = F.col("event_type").isin(*KNOWN_TYPES) & F.col("user_id").isNotNull()
    return shape_events(events.filter(known))


def with_repeats(events: DataFrame, every: int = 20) -> DataFrame:
    """Deliver every n-th event twice, as an at-least-once queue may."""
    copies = F.when(F.col("event_id") % every == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.select("*", F.explode(copies).alias("delivery")).drop("delivery")


def deliver_once(batch: DataFrame, batch_id: int, root: str) -> None:
    """Write the events of a micro-batch that no earlier batch wrote; one effect per event id.

    Ids are compared with everything written before, however late an event comes. They lie by
    day of the event, and only the days of the batch are read. A repeated batch overwrites its
    own folder.
    """
    spark = batch.sparkSession
    day = F.coalesce(F.to_date("ts"), F.lit("1970-01-01").cast("date"))
    rows = batch.dropDuplicates(["event_id"]).withColumn("day", day)
    schema = batch.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    earlier = below(spark, root, f"{schema}, batch bigint, day date").filter(F.col("batch") < batch_id).select("day", "event_id")
    rows.join(earlier, ["day", "event_id"], "left_anti").write.mode("overwrite").partitionBy("day").parquet(f"{root}/batch={batch_id}")


def run_once_each(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream of events over all available input, each event once, and return the table."""
    base = f"{shared_dir(stream.sparkSession)}/{name}-{uuid.uuid4().hex}"
    run = (
        stream.writeStream.foreachBatch(lambda batch, batch_id: deliver_once(batch, batch_id, f"{base}/rows"))
        .option("checkpointLocation", f"{base}/offsets")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    schema = stream.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    return below(stream.sparkSession, f"{base}/rows", f"{schema}, batch bigint, day date").select(*stream.columns)


def below(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not have been written yet."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all available input into a table and return the table."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    run = (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/rows")
        .option("checkpointLocation", f"{base}/offsets")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def tick_candidates(feed: DataFrame, stored: DataFrame, watermark: Column, limit: int) -> DataFrame:
    due = S.changed_since(feed, watermark)
    return S.drop_processed(S.take_with_ties(due, limit), stored)


def apply_tick(
    incoming: DataFrame, stored: DataFrame, key: str, row_fields: list[str], fingerprint: str, location: str
) -> DataFrame:
    """Next state: changed rows are written, unchanged ones only touched, others kept."""
    classed = S.classify_changes(incoming, stored, key, row_fields, fingerprint, location)
    cols = incoming.columns
    done = classed.select(
        *cols, F.when(F.col("change") == "unchanged", "touched").otherwise("written").alias("effect")
    ).withColumn("artifact_present", F.lit(True))
    kept = stored.join(incoming.select(key), key, "left_anti").select(
        *cols, F.lit("kept").alias("effect"), "artifact_present"
    )
    return done.unionByName(kept)


def late_events(feed: DataFrame, watermark: Column) -> DataFrame:
    """Events at or before the looked-back watermark, which a tick ignores, by kind."""
    late = feed.filter(F.col("edited_at") <= S.lookback(watermark))
    return late.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def tick_counts(feed: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidates, enqueued and deduplicated changes per five-minute tick."""
    done = stored.select("page_id", "edited_at", F.lit(True).alias("__done"))
    rows = feed.join(done, ["page_id", "edited_at"], "left")
    per_tick = rows.groupBy(F.window("ts", "5 minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(F.col("__done").isNull()).alias("enqueued"),
        F.count_if(F.col("__done").isNotNull()).alias("deduped"),
    )
    return per_tick.select(F.col("w.start").alias("tick"), "candidates", "enqueued", "deduped")
