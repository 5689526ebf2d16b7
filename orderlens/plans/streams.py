"""Driver-table runs of the streaming operators (K2, K3).

The events table arrives as one Parquet file.  For the upsert the feed is
first re-written by Spark into several files so that ``availableNow`` with
``maxFilesPerTrigger=1`` delivers it in several micro-batches, in no
particular time order - the result must still equal the batch
latest-per-key.  Checkpoints and outputs go to fresh folders below the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from orderlens import functions as X
from orderlens.operators.derive import with_serial_key
from orderlens.session import scratch_path
from orderlens.sources.buckets import read_bucketed
from orderlens.sources.tables import read_table
from orderlens.streaming.refresh import derive_stream, late_matches, stream_upsert

LATEST_SCHEMA = StructType([
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("ts", TimestampNTZType()), StructField("event_id", LongType()),
])


def latest_guard(s, t):
    """Newer (ts, event_id) wins; a replayed or late older change never does."""
    return (s("ts") > t("ts")) | ((s("ts") == t("ts")) & (s("event_id") > t("event_id")))


def stage_feed(spark: SparkSession, df: DataFrame, files: int, name: str) -> str:
    path = scratch_path(spark, name)
    df.repartition(files, "event_id").write.parquet(path)
    return path


def run_stream_upsert(spark: SparkSession, sf_dir: str, files: int = 4) -> DataFrame:
    events = read_table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    feed = stage_feed(spark, events, files, "events-feed")
    changes = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
               .parquet(feed))
    base = scratch_path(spark, "latest-by-user")
    q = stream_upsert(changes, base, LATEST_SCHEMA, ["user_id"], ["ts", "event_id"],
                      latest_guard, checkpoint=scratch_path(spark, "ckpt-upsert"),
                      trigger={"availableNow": True}, buckets=1)
    q.awaitTermination()
    return read_bucketed(spark, base).select("user_id", "event_type", "ts")


def run_stream_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table's own path, a file or a folder of files as Spark writes it; as a pattern,
    # because the file source takes a plain path for a folder
    schema = read_table(spark, sf_dir, "events").schema
    src = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    out = derive_stream(src, lambda df: with_serial_key(
        df, "event_type", "k", lambda c: X.serial_prefix(c, chars="ev")).select("event_id", "k"))
    sink = scratch_path(spark, "derived-events")
    q = (out.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", scratch_path(spark, "ckpt-derive"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(sink).select("event_id", "k")


SCAN_SCHEMA = StructType([StructField("order_id", LongType()), StructField("scan_ts", TimestampNTZType())])


def feed_in_order(spark: SparkSession, df: DataFrame, ts: str, slices: int, name: str) -> str:
    """``df`` as a folder that grew in time order: one append per slice of the time range."""
    path = scratch_path(spark, name)
    low, high = df.agg(F.min(ts), F.max(ts)).first()
    for i in range(slices):
        start, end = (low + (high - low) * k / slices for k in (i, i + 1))
        part = df.where((F.col(ts) >= F.lit(start)) & ((F.col(ts) < F.lit(end)) if i + 1 < slices else F.lit(True)))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def run_late_scans(spark: SparkSession, sf_dir: str, slices: int = 4, within: str = "14 days") -> DataFrame:
    """Per purchase (the order) the newest click (the scan) of its user within 14 days:
    both arrive as streams in time order, matches are merged into a table as they come."""
    events = read_table(spark, sf_dir, "events")
    of = lambda kind: events.where(F.col("event_type") == kind)
    orders = of("purchase").select(F.col("event_id").alias("order_id"), F.col("user_id").alias("buyer"), F.col("ts").alias("order_ts"))
    scans = of("click").select("user_id", F.col("ts").alias("scan_ts"))

    def feed(df, ts, name):
        path = feed_in_order(spark, df, ts, slices, name)
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    # one file is a slice of the time range, so rows of a file are out of order by its length
    days = "12 days"
    pairs = late_matches(feed(orders, "order_ts", "orders-feed"), feed(scans, "scan_ts", "scans-feed"), [("buyer", "user_id")],
                         "order_ts", "scan_ts", within, days, days).select("order_id", "scan_ts")
    base = scratch_path(spark, "late-scans")
    q = stream_upsert(pairs, base, SCAN_SCHEMA, ["order_id"], ["scan_ts"], lambda s, t: s("scan_ts") > t("scan_ts"),
                      checkpoint=scratch_path(spark, "ckpt-late"), buckets=1)
    q.awaitTermination()
    return read_bucketed(spark, base)

