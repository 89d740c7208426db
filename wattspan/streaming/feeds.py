"""Streaming forms of the incremental load and of the hourly consumption."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattspan.functions import calendar as cal
from wattspan.schema import KW, METERS
from wattspan.sources import tables

BATCH = "batch_id"


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def load_new_files(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: Sequence[str] = ("feed", "ts"),
    order: str | None = "seq",
) -> None:
    """Load the files that arrived since the last run; keys already stored win.

    A batch that is run again after a failure adds nothing twice.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        tables.append_new(batch, table, keys, order=order)

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def hourly_delta(readings: DataFrame, lateness: str, keys: Sequence[str] = ()) -> DataFrame:
    """Hourly consumption of streamed readings, open for ``lateness`` after the hour.

    State is one row per open hour. The watermark needs a zoned time column; in
    the pinned UTC session it is the same instant text.
    """
    at = F.col("ts").cast("timestamp")
    hours = (
        readings.withColumn("at", at)
        .withWatermark("at", lateness)
        .groupBy(*keys, F.window("at", "1 hour").alias("w"))
        .agg(
            *[
                (F.max_by(m, "at") - F.min_by(m, "at")).cast(KW).alias(m)
                for m in METERS
            ]
        )
    )
    hour = F.col("w.start").cast("timestamp_ntz")
    return hours.select(*keys, hour.alias("ts"), *METERS, cal.dow_sun0("w.start").alias("dow"))


def keep_state_on_disk(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB, outside the heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def deduplicated(stream: DataFrame, lateness: str, keys: Sequence[str] = ("feed", "seq")) -> DataFrame:
    """The first arrival of every row that a source may deliver more than once.

    A key is remembered until the watermark is ``lateness`` beyond its time, so copies in
    later batches are dropped and the state does not grow with the stream.
    """
    timed = stream.withColumn("_at", F.col("ts").cast("timestamp")).withWatermark("_at", lateness)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_at")


def chained_delta(readings: DataFrame, grain: str, lateness: str, keys: Sequence[str] = ()) -> DataFrame:
    """Consumption per day, or per day and band, from the hours of streamed readings.

    Hours close first and hand their first and last values on; a day closes once the
    watermark has passed it, and is written once. State is one row per open hour and per
    open day or band.
    """
    at = F.col("ts").cast("timestamp")
    ends = [f(m, "at").alias(f"{p}_{m}") for m in METERS for p, f in (("first", F.min_by), ("last", F.max_by))]
    hours = (
        readings.withColumn("at", at)
        .withWatermark("at", lateness)
        .groupBy(*keys, F.window("at", "1 hour").alias("w"))
        .agg(*ends)
        .select("*", F.window_time("w").alias("closed"), F.col("w.start").alias("hour"))
    )
    band = [cal.time_band("hour").alias("band")] if grain == "band" else []
    spent = [
        (F.max_by(f"last_{m}", "hour") - F.min_by(f"first_{m}", "hour")).cast(KW).alias(m) for m in METERS
    ]
    days = hours.groupBy(*keys, F.window("closed", "1 day").alias("d"), *band).agg(*spent)
    start = F.col("d.start").cast("timestamp_ntz")
    named = [F.to_date(start).alias("day"), "band"] if band else [start.alias("ts")]
    return days.select(*keys, *named, *METERS, cal.dow_sun0("d.start").alias("dow"))


def split_late(
    stream: DataFrame, timely: str, late: str, checkpoint: str, lateness: str, time: str = "ts"
) -> None:
    """Deal new rows to a folder for the aggregating streams and one for rows that come too late.

    A row is late if it is more than ``lateness`` before the latest time of the batches before
    its own, which is how far a watermark has got by then. So the aggregations lose nothing that
    is not kept beside them. A batch run again deals its rows alike and replaces its own output.
    """
    spark = stream.sparkSession
    marks = f"{checkpoint}/marks"

    def deal(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_late", F.lit(False))
        if batch_id:
            # One row a batch.
            reached = spark.read.parquet(marks).where(F.col(BATCH) < batch_id).select(F.max("reached"))
            behind = F.col(time).cast("timestamp") < reached.scalar() - F.expr(f"INTERVAL {lateness}")
            rows = batch.withColumn("_late", F.coalesce(behind, F.lit(False)))
        reached = batch.select(F.max(F.col(time).cast("timestamp")).alias("reached"))
        reached.coalesce(1).write.mode("overwrite").parquet(f"{marks}/{BATCH}={batch_id}")
        for path, side in ((late, "_late"), (timely, "NOT _late")):
            rows.where(side).drop("_late").write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    query = (
        stream.writeStream.foreachBatch(deal)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def write_updates(stream: DataFrame, path: str, checkpoint: str, mode: str = "update"):
    """Append every changed row with the number of the batch that changed it; with the mode
    ``append``, every row that is final.

    A batch run again replaces its own earlier output. Returns the progress of the last batch.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query.lastProgress


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last written state of every key."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in keys and c != BATCH]
    return rows.groupBy(*keys).agg(*[F.max_by(c, BATCH).alias(c) for c in rest])
