"""Meter feeds as CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspan.functions.calendar import TEXT_FORMAT, parse_text
from wattspan.schema import KW, RAW_FEED

# Low bits of a generated row id: the row's number within its task.
ROW_BITS = (1 << 33) - 1


def _required(c: Column, what: str) -> Column:
    return F.when(c.isNull(), F.raise_error(F.lit(f"{what} is missing"))).otherwise(c)


def read_feed(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """One feed's file: header row, then time text and value by position.

    A malformed line or a missing time fails the read. ``seq`` orders the rows of
    a folder: files by the time they were written, then by name, lines within a
    file by place. A row's number within its task never reaches the size of a
    split, so adding the split's offset keeps lines of one file in order however
    the file is split. Values are kept at two decimals.
    """
    rows = (
        spark.read.schema(RAW_FEED)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    line = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(
        F.lit(ROW_BITS)
    )
    seq = F.struct(
        F.col("_metadata.file_modification_time").alias("written"),
        F.col("_metadata.file_name").alias("file"),
        line.alias("line"),
    )
    return rows.select(
        F.lit(feed).alias("feed"),
        seq.alias("seq"),
        parse_text(_required(F.col("Date"), "Date")).alias("ts"),
        F.col("kilowatt").cast(KW).alias("kilowatt"),
    )


def write_feed(
    feed: DataFrame, path: str, mode: str = "errorifexists", by: str | None = None
) -> None:
    """Time text and value with two decimals; ``mode="append"`` adds files with their own header.

    ``by`` names a column whose values get a folder each (``feed_folder``), all in one pass.
    """
    rows = feed.select(
        *([by] if by else []),
        F.date_format("ts", TEXT_FORMAT).alias("Date"),
        F.col("kilowatt").cast(KW).alias("kilowatt"),
    )
    writer = rows.write.mode(mode).option("header", True)
    (writer.partitionBy(by) if by else writer).csv(path)


def feed_folder(path: str, by: str, value: str) -> str:
    return f"{path}/{by}={value}"


def read_forecast_sample(spark: SparkSession, path: str) -> DataFrame:
    """Forecast file with day/month/year dates."""
    from wattspan.schema import FORECAST_SAMPLE

    rows = spark.read.schema(FORECAST_SAMPLE).option("header", True).csv(path)
    return rows.select(
        F.to_date("data", "dd/MM/yyyy").alias("day"),
        F.col("fascia_oraria").alias("band"),
        F.col("giorno_settimana").alias("dow"),
        F.col("previsioni").alias("building_forecast"),
    )
