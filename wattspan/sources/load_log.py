"""The record of finished loads: one row per load, or per load and key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wattspan.schema import LOAD_LOG

# Field names of the JSON load-state file, and the column each becomes.
STATE_FIELDS = {
    "data_di_download": "downloaded_at",
    "data_inizio": "start",
    "data_fine": "end",
}
STATE_TEXT = "yyyy-MM-dd HH:mm:ss"


def _stamp(text: Column) -> Column:
    return F.try_to_timestamp(F.nullif(text, F.lit(""))).cast("timestamp_ntz")


def read_state_file(spark: SparkSession, path: str) -> DataFrame:
    """JSON load records: one array over many lines, or one record per line."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in STATE_FIELDS])
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.select(*[_stamp(F.col(f)).alias(c) for f, c in STATE_FIELDS.items()])


def append_state_file(entry: DataFrame, path: str) -> None:
    """Append load records as a JSON file of their own to a folder of such files."""
    rows = entry.where(F.col("end").isNotNull())
    rows.select(
        *[F.date_format(c, STATE_TEXT).alias(f) for f, c in STATE_FIELDS.items()]
    ).coalesce(1).write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, keys: Sequence[T.StructField] = ()) -> DataFrame:
    return spark.read.schema(T.StructType([*keys, *LOAD_LOG.fields])).parquet(path)


def log_entry(
    feeds: DataFrame, downloaded_at: Column | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """The record of a load: when it ran and the times it covers, for every key it touched."""
    stamp = F.current_timestamp() if downloaded_at is None else downloaded_at
    covered = feeds.groupBy(*keys).agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    return covered.select(
        *keys, stamp.cast("timestamp_ntz").alias("downloaded_at"), "start", "end"
    )


def append_log(entry: DataFrame, path: str) -> None:
    entry.where(F.col("end").isNotNull()).write.mode("append").parquet(path)
