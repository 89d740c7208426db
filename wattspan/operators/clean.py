"""Cleaning of raw meter feeds: alignment, deduplication, incremental loading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def align_feeds(feeds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows up to the last time every feed has reached.

    Without ``keys`` the horizon is a scalar subquery, which the parquet scan
    receives as a pushed filter. With ``keys`` each group has its own horizon.
    """
    horizon = (
        feeds.groupBy(*keys, "feed")
        .agg(F.max("ts").alias("_last"))
        .groupBy(*keys)
        .agg(F.min("_last").alias("_horizon"))
    )
    if not keys:
        return feeds.where(F.col("ts") <= horizon.scalar())
    return (
        feeds.join(horizon, list(keys)).where(F.col("ts") <= F.col("_horizon")).drop("_horizon")
    )


def feed_ends(wide: DataFrame, feeds: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The last time of every feed, per key, from feeds that stand side by side."""
    lasts = wide.groupBy(*keys).agg(*[F.max(F.when(F.col(f"has_{f}"), F.col("ts"))).alias(f) for f in feeds])
    each = F.array(*[F.struct(F.lit(f).alias("feed"), F.col(f).alias("end")) for f in feeds])
    return lasts.select(*keys, F.inline(each)).where("end IS NOT NULL")


def up_to_horizon(wide: DataFrame, ends: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows up to the last time that every feed of ``ends`` has reached, per key."""
    horizon = ends.groupBy(*keys).agg(F.min("end").alias("_horizon"))
    if not keys:
        return wide.where(F.col("ts") <= horizon.scalar())
    return wide.join(horizon, list(keys)).where(F.col("ts") <= F.col("_horizon")).drop("_horizon")


def dedup_feed(
    feeds: DataFrame, keys: Sequence[str] = ("feed", "ts"), order: str = "seq"
) -> DataFrame:
    """One row per key: the one read first.

    An aggregation rather than a window, so copies of a hot key collapse before
    the shuffle. ``order`` grows in reading order and names a row once per key. A
    number leaves a hash aggregation of fixed-width buffers; a struct, as
    ``meter_csv.read_feed`` makes it, orders rows across files.
    """
    rest = [c for c in feeds.columns if c not in keys and c != order]
    if isinstance(feeds.schema[order].dataType, T.StructType):
        first = feeds.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("_first"))
        return first.select(*keys, "_first.*").select(*feeds.columns)
    firsts = [F.min_by(c, order).alias(c) for c in rest]
    return (
        feeds.groupBy(*keys)
        .agg(*firsts, F.min(order).alias(order))
        .select(*feeds.columns)
    )


def load_window(feeds: DataFrame, keys: Sequence[str] = ("feed",)) -> DataFrame:
    """First and last time per feed."""
    return feeds.groupBy(*keys).agg(F.min("ts").alias("start"), F.max("ts").alias("end"))


def new_rows(feeds: DataFrame, load_log: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows after the end of the last recorded load; everything without one.

    With ``keys`` each group goes on from its own last load, so that one that
    lags behind the others loses nothing.
    """
    last = F.max_by("end", F.struct("downloaded_at", "end"))
    if keys:
        ends = load_log.groupBy(*keys).agg(last.alias("_since"))
        beyond = F.col("_since").isNull() | (F.col("ts") > F.col("_since"))
        return feeds.join(ends, list(keys), "left").where(beyond).select(*feeds.columns)
    last_end = load_log.agg(last.alias("end"))
    since = F.coalesce(last_end.scalar(), F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
    return feeds.where(F.col("ts") > since)
