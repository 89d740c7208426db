"""Meter feeds and weather derived from the given tables.

Every frame grows with the table it comes from. Running totals are built in two
steps, days first and then within each day, so no window holds a whole feed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wattspan.functions import calendar as cal
from wattspan.schema import KW, WEATHER_VARS

# Which event type or return flag plays which meter feed.
EVENT_FEED = {
    "view": "building",
    "signup": "building",
    "click": "data_center",
    "error": "data_center",
    "purchase": "solar",
}
FLAG_FEED = {"N": "building", "A": "data_center", "R": "solar"}

# Modulus and offset of every derived weather variable, in variable order.
WEATHER_RANGE = (
    (45, -5), (101, 0), (30, -10), (50, -10), (8, 0), (7, 0), (3, 0), (2, 0),
    (100, 0), (60, 980), (60, 970), (101, 0), (101, 0), (101, 0), (101, 0), (30, 0),
    (360, 0), (2, 0), (900, 0), (400, 0), (950, 0), (1000, 0), (1300, 0),
)

AS_OF = "2024-01-16"
SPLIT = "2024-01-20 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _feed_of(column: str, mapping: dict[str, str]):
    out = None
    for value, feed in mapping.items():
        cond = F.col(column) == value
        out = F.when(cond, feed) if out is None else out.when(cond, feed)
    return out


def raw_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Raw readings as text rows with duplicates on their quarter hour."""
    return table(spark, sf, "events").select(
        _feed_of("event_type", EVENT_FEED).alias("feed"),
        F.col("event_id").alias("seq"),
        F.date_format(cal.floor_minutes("ts", 15), cal.TEXT_FORMAT).alias("Date"),
        F.col("value").cast(KW).alias("kilowatt"),
    )


def parsed_feed(spark: SparkSession, sf: str) -> DataFrame:
    return raw_feed(spark, sf).select(
        "feed", "seq", cal.parse_text("Date").alias("ts"), "kilowatt"
    )


def _cents(column: str):
    return (F.col(column).cast(KW) * 100).cast("bigint")


def _register(amounts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Running meter register from whole hundredths per (keys, ts).

    The totals before each day run over the days of one feed in one task: as many rows as the
    calendar has days.
    """
    # The join below implies this filter for one of its sides; stated here, both
    # sides read the same shuffle.
    amounts = amounts.withColumn("_day", F.to_date("ts")).where(F.col("_day").isNotNull())
    before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        amounts.groupBy(*keys, "_day")
        .agg(F.sum("cents").alias("_total"))
        .select(*keys, "_day", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    )
    within = (
        Window.partitionBy(*keys, "_day")
        .orderBy("ts")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = amounts.withColumn("_run", F.sum("cents").over(within)).join(days, [*keys, "_day"])
    register = (F.col("_before") + F.col("_run")).cast("decimal(18,0)")
    hundredth = F.lit("0.01").cast("decimal(2,2)")
    return running.select(*keys, "ts", (register * hundredth).cast(KW).alias("kilowatt"))


def _slots_between(events: DataFrame, tasks: int) -> DataFrame:
    """Every quarter hour from the first event's hour to the last event."""
    span = events.agg(cal.truncate(F.min("ts"), "hour").alias("lo"), F.max("ts").alias("hi"))
    days = F.sequence(cal.truncate("lo", "day"), F.col("hi"), F.expr("INTERVAL 1 DAY"))
    slots = F.sequence(
        F.col("_day"),
        F.col("_day") + F.expr("INTERVAL '23:45' HOUR TO MINUTE"),
        F.expr("INTERVAL 15 MINUTE"),
    )
    # The days are spread over tasks before they unfold into slots.
    return (
        span.select("lo", "hi", F.explode(days).alias("_day"))
        .repartition(tasks, "_day")
        .select("lo", "hi", F.explode(slots).alias("ts"))
        .where((F.col("ts") >= F.col("lo")) & (F.col("ts") <= F.col("hi")))
        .select("ts")
    )


def _slots_of(events: DataFrame, site: Column) -> DataFrame:
    """The quarter hours in which a site has an event, and the starts of their hours."""
    both = F.array(cal.truncate("ts", "hour"), cal.floor_minutes("ts", 15))
    return events.select(site.alias("site"), F.explode(both).alias("ts")).distinct()


def meter_feeds(spark: SparkSession, sf: str, site: str | None = None) -> DataFrame:
    """Cumulative feeds on a quarter-hour grid; solar only where it has events.

    With ``site`` every value of that events column is a site of its own, which
    reports at its own events and at the start of their hours only.
    """
    ev = table(spark, sf, "events")
    keys = ["site"] if site else []
    if site:
        slots = _slots_of(ev, F.col(site))
    else:
        slots = _slots_between(ev, int(spark.conf.get("spark.sql.shuffle.partitions")))
    grid = slots.select(
        *keys,
        F.explode(F.array(F.lit("building"), F.lit("data_center"))).alias("feed"),
        "ts",
        F.lit(0).cast("bigint").alias("cents"),
    )
    events = ev.select(
        *([F.col(site).alias("site")] if site else []),
        _feed_of("event_type", EVENT_FEED).alias("feed"),
        cal.floor_minutes("ts", 15).alias("ts"),
        _cents("value").alias("cents"),
    )
    amounts = (
        events.unionByName(grid).groupBy(*keys, "feed", "ts").agg(F.sum("cents").alias("cents"))
    )
    return _register(amounts, [*keys, "feed"])


def long_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """Cumulative feeds with one reading per day over several years."""
    amounts = (
        table(spark, sf, "lineitem")
        .groupBy(_feed_of("l_returnflag", FLAG_FEED).alias("feed"), F.col("l_shipdate").alias("ts"))
        .agg(F.sum(_cents("l_quantity")).alias("cents"))
    )
    return _register(amounts, ["feed"])


def weather_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly weather: whole numbers made from each hour's events."""
    hours = (
        table(spark, sf, "events")
        .groupBy(cal.truncate("ts", "hour").alias("ts"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k"),
        )
    )
    return hours.select(
        "ts",
        *[
            ((F.col("k") * (i + 1) + F.col("n") * 7) % m + o).cast("double").alias(v)
            for i, (v, (m, o)) in enumerate(zip(WEATHER_VARS, WEATHER_RANGE))
        ],
    )


def weather_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Weather as service responses: one row per day, one array per variable."""
    at = F.struct("ts", *WEATHER_VARS)
    seconds = F.unix_timestamp(F.col("day").cast("timestamp"))
    hours = F.sequence(
        F.col("day").cast("timestamp_ntz"),
        F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 23 HOURS"),
        F.expr("INTERVAL 1 HOUR"),
    )
    days = (
        weather_hourly(spark, sf)
        .groupBy(F.to_date("ts").alias("day"))
        .agg(F.map_from_entries(F.collect_list(F.struct("ts", at))).alias("by_hour"))
    )

    def at_hour(hour):
        return F.try_element_at("by_hour", hour)

    def value_of(name):
        return lambda entry: entry[name]

    return days.select(
        seconds.alias("start"),
        (seconds + 86400).alias("end"),
        F.lit(3600).alias("step"),
        *[
            F.transform(F.transform(hours, at_hour), value_of(v)).alias(v) for v in WEATHER_VARS
        ],
    )
