"""Every registered query: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from suite import derive
from wattspan.functions import calendar as cal
from wattspan.functions import comfort
from wattspan.operators import (
    buckets,
    clean,
    ensemble,
    forecast,
    linear,
    merge,
    metrics,
    model,
    prep,
    readings,
    remote,
    weather,
)
from wattspan.plans import load
from wattspan.plans.store import Store
from wattspan.schema import FEATURES, FEEDS, KW, METERS, READINGS, SCALED_FEATURES, WEATHER_VARS
from wattspan.session import pin, shared_dir
from wattspan.sources import load_log, meter_csv, ramp, tables
from wattspan.sources.weather import explode_weather
from wattspan.streaming import feeds as streaming

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SITE = ["site"]


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fn(pin(spark), sf.rstrip("/"))

    REGISTRY[fn.__name__] = run
    return run


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# Shared inputs -----------------------------------------------------------------


def readings_of(spark, sf):
    return readings.join_readings(derive.meter_feeds(spark, sf))


def site_readings(spark, sf):
    return readings.join_readings(derive.meter_feeds(spark, sf, site="user_id"), SITE)


def long_readings(spark, sf):
    return readings.join_readings(derive.long_feeds(spark, sf))


def table_of(spark, sf, grain):
    return buckets.drop_empty(buckets.delta(readings_of(spark, sf), grain))


def hour_with_weather(spark, sf):
    return weather.merge_weather(
        table_of(spark, sf, "hour"), derive.weather_hourly(spark, sf), "hour"
    )


def flagged_days(spark, sf):
    # Both tables roll up from the same hourly states.
    state = buckets.bucket_state(readings_of(spark, sf), "hour")
    bands, days = (
        buckets.drop_empty(buckets.state_delta(buckets.roll_state(state, g), g))
        for g in ("band", "day")
    )
    return remote.flag_days(days, remote.band_flags(bands)), bands


def features_of(spark, sf):
    return prep.feature_rows(hour_with_weather(spark, sf))


# Sources and sinks ---------------------------------------------------------------


def _feed_files(spark, sf, folder):
    rows = derive.parsed_feed(spark, sf)
    early = F.col("ts") < ntz(derive.SPLIT)
    meter_csv.write_feed(rows.where(early), folder, by="feed")
    meter_csv.write_feed(rows.where(~early), folder, mode="append", by="feed")


def _read_feeds(spark, folder):
    parts = [
        meter_csv.read_feed(spark, meter_csv.feed_folder(folder, "feed", f), f) for f in FEEDS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def scan_feed(spark, sf):
    """CSV feeds read by position, typed and parsed."""
    folder = shared_dir(spark, "scan_feed")
    _feed_files(spark, sf, folder)
    return _read_feeds(spark, folder).select("feed", "ts", "kilowatt")


@query
def sink_roundtrip(spark, sf):
    """Feeds written to CSV in two appends, read back and counted per feed and day."""
    folder = shared_dir(spark, "sink_roundtrip")
    _feed_files(spark, sf, folder)
    return (
        _read_feeds(spark, folder)
        .groupBy("feed", F.to_date("ts").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("kilowatt").cast("decimal(18,2)").alias("total"),
        )
    )


@query
def select_year(spark, sf):
    return buckets.in_year(long_readings(spark, sf), 1998)


@query
def load_window(spark, sf):
    """Window of the load per feed, next to the recorded load as read back from its state file."""
    feeds = derive.parsed_feed(spark, sf)
    path = shared_dir(spark, "load_state")
    load_log.append_state_file(load_log.log_entry(feeds, ntz(derive.SPLIT)), path)
    log = load_log.read_state_file(spark, path).agg(
        F.struct(F.min("start").alias("start"), F.max("end").alias("end")).alias("w")
    )
    return (
        clean.load_window(feeds)
        .withColumn("_w", log.scalar())
        .select(
            "feed", "start", "end", F.col("_w.start").alias("log_start"), F.col("_w.end").alias("log_end")
        )
    )


@query
def weather_explode(spark, sf):
    return explode_weather(derive.weather_responses(spark, sf))


@query
def forecast_window(spark, sf):
    return weather.forecast_window(derive.weather_hourly(spark, sf), F.lit(derive.AS_OF))


@query
def archive_window(spark, sf):
    return weather.archive_window(
        derive.weather_hourly(spark, sf), ntz("2024-01-05 07:00:00"), ntz("2024-01-12 13:00:00")
    )


@query
def ramp_feed(spark, sf):
    """A ramp per feed over the span of its events."""
    spans = clean.load_window(derive.parsed_feed(spark, sf))
    return ramp.ramp_feed(spans, F.lit(100000), F.lit("0.41").cast("decimal(4,2)"))


# Cleaning ------------------------------------------------------------------------


@query
def align_feeds(spark, sf):
    return clean.align_feeds(derive.parsed_feed(spark, sf))


@query
def dedup_feed(spark, sf):
    return clean.dedup_feed(derive.parsed_feed(spark, sf))


@query
def incremental_feed(spark, sf):
    """Rows after the end of the recorded first load."""
    feeds = derive.meter_feeds(spark, sf)
    first = feeds.where(F.col("ts") < ntz(derive.SPLIT))
    log = load_log.log_entry(first, ntz(derive.SPLIT))
    return clean.new_rows(feeds, log)


@query
def insert_ignore(spark, sf):
    """A second load that overlaps the first by a day, with different values."""
    feeds = derive.meter_feeds(spark, sf)
    target = feeds.where(F.col("ts") < ntz(derive.SPLIT))
    batch = feeds.where(F.col("ts") >= ntz("2024-01-19 00:00:00")).withColumn(
        "kilowatt", (F.col("kilowatt") + 1).cast(KW)
    )
    return merge.insert_ignore(target, batch, ["feed", "ts"])


# Readings ------------------------------------------------------------------------


@query
def office_load(spark, sf):
    return readings.office_load(derive.meter_feeds(spark, sf))


@query
def join_readings(spark, sf):
    return readings_of(spark, sf)


@query
def raw_readings(spark, sf):
    """Duplicates dropped and feeds joined in one shuffle of the raw rows."""
    wide = readings.side_by_side(derive.parsed_feed(spark, sf), order="seq")
    return readings.readings_of(wide)


@query
def feed_roundtrip(spark, sf):
    """Deduplicated feeds by way of their side-by-side form."""
    wide = readings.side_by_side(derive.parsed_feed(spark, sf), order="seq")
    return readings.feed_rows(wide)


@query
def time_band(spark, sf):
    ev = derive.table(spark, sf, "events")
    return ev.select("event_id", F.hour("ts").alias("hour"), cal.time_band("ts").alias("band"))


@query
def calendar_parts(spark, sf):
    ev = derive.table(spark, sf, "events")
    parts = [c.alias(n) for n, c in cal.calendar_parts("ts").items() if n != "dow"]
    return ev.select(
        "event_id",
        *parts,
        cal.dow_sun0("ts").alias("dow_sun0"),
        cal.dow_mon0("ts").alias("dow_mon0"),
        cal.date_text("ts").alias("date_text"),
        cal.month_text("ts").alias("month_text"),
    )


# Buckets -------------------------------------------------------------------------


@query
def delta_hour(spark, sf):
    return buckets.delta(readings_of(spark, sf), "hour")


@query
def delta_day(spark, sf):
    return buckets.delta(readings_of(spark, sf), "day")


@query
def delta_band(spark, sf):
    return buckets.delta(readings_of(spark, sf), "band")


@query
def delta_month(spark, sf):
    return buckets.delta(long_readings(spark, sf), "month")


@query
def delta_year(spark, sf):
    return buckets.delta(long_readings(spark, sf), "year")


@query
def delta_hour_window(spark, sf):
    return buckets.delta_by_window(readings_of(spark, sf))


@query
def delta_rollup(spark, sf):
    """Day consumption from hourly states instead of readings."""
    state = buckets.bucket_state(readings_of(spark, sf), "hour")
    return buckets.state_delta(buckets.roll_state(state, "day"), "day")


@query
def drop_empty(spark, sf):
    return table_of(spark, sf, "hour")


@query
def semi_first_last(spark, sf):
    return buckets.period_ends(long_readings(spark, sf), "month")


@query
def semi_first_last_band(spark, sf):
    return buckets.period_ends(readings_of(spark, sf), "band")


@query
def band_sorted(spark, sf):
    return buckets.in_order(table_of(spark, sf, "band"), "band")


@query
def head_rows(spark, sf):
    return buckets.first_rows(table_of(spark, sf, "band"), 5, "day", "band")


@query
def site_readings_joined(spark, sf):
    return site_readings(spark, sf)


@query
def site_delta_hour(spark, sf):
    return buckets.drop_empty(buckets.delta(site_readings(spark, sf), "hour", SITE))


@query
def site_delta_band(spark, sf):
    return buckets.drop_empty(buckets.delta(site_readings(spark, sf), "band", SITE))


# Weather -------------------------------------------------------------------------


def _resampled(grain):
    def run(spark, sf):
        return weather.resample(derive.weather_hourly(spark, sf), grain)

    run.__name__ = f"weather_{grain}"
    return query(run)


weather_hour, weather_day, weather_month, weather_year = (
    _resampled(g) for g in ("hour", "day", "month", "year")
)


@query
def weather_band_last(spark, sf):
    return weather.band_weather(derive.weather_hourly(spark, sf), "last")


@query
def weather_band_mean(spark, sf):
    return weather.band_weather(derive.weather_hourly(spark, sf), "mean")


@query
def merge_weather(spark, sf):
    """The hourly table with weather that begins and ends two days later than the table."""
    later = (F.col("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts")
    hours = derive.weather_hourly(spark, sf).select(later, *WEATHER_VARS)
    return weather.merge_weather(table_of(spark, sf, "hour"), hours, "hour")


@query
def merge_weather_band(spark, sf):
    return weather.merge_weather(
        table_of(spark, sf, "band"), derive.weather_hourly(spark, sf), "band"
    )


@query
def merge_weather_day(spark, sf):
    return weather.merge_weather(
        table_of(spark, sf, "day"), derive.weather_hourly(spark, sf), "day"
    )


@query
def weather_indices(spark, sf):
    hours = derive.weather_hourly(spark, sf)
    return hours.select("ts", *[F.round(c, 6).alias(n) for n, c in comfort.weather_indices().items()])


@query
def cyclical(spark, sf):
    hours = derive.weather_hourly(spark, sf).select("ts", F.hour("ts").alias("hour"))
    points = [(F.round(c, 6) + 0.0).alias(n) for n, c in comfort.cyclical("hour", 24).items()]
    return hours.select("ts", *points)


# Remote work ---------------------------------------------------------------------


@query
def remote_threshold(spark, sf):
    means = remote.remote_threshold(table_of(spark, sf, "band"))
    return means.select(*[F.round(F.col(c).cast("double"), 6).alias(c) for c in means.columns])


@query
def remote_days(spark, sf):
    return flagged_days(spark, sf)[0]


@query
def remote_bands(spark, sf):
    bands = table_of(spark, sf, "band")
    return remote.flag_bands(bands, remote.band_flags(bands))


@query
def remote_counts(spark, sf):
    return remote.flag_counts(flagged_days(spark, sf)[0])


@query
def remote_pct_month(spark, sf):
    days, _ = flagged_days(spark, sf)
    return remote.flag_periods(table_of(spark, sf, "month"), days, "month")


@query
def remote_pct_year(spark, sf):
    days, _ = flagged_days(spark, sf)
    return remote.flag_periods(table_of(spark, sf, "year"), days, "year")


@query
def site_remote_days(spark, sf):
    """Flags by each site's own threshold."""
    bands = buckets.drop_empty(buckets.delta(site_readings(spark, sf), "band", SITE))
    return remote.band_flags(bands, SITE)


# Features and statistics ---------------------------------------------------------


@query
def feature_rows(spark, sf):
    rows = features_of(spark, sf)
    return rows.withColumns({c: F.round(c, 6) for c in ("heat_index", "wind_chill")})


@query
def scaled_features(spark, sf):
    rows = prep.scale(features_of(spark, sf))
    return rows.select("ts", *[F.round(c, 6).alias(c) for c in SCALED_FEATURES])


@query
def fill_zero(spark, sf):
    table = weather.merge_weather(
        table_of(spark, sf, "hour"), derive.weather_hourly(spark, sf), "hour"
    )
    return prep.fill_zero(table)


@query
def filter_outliers(spark, sf):
    return prep.filter_outliers(table_of(spark, sf, "hour"), "building", 0.95)


@query
def describe(spark, sf):
    stats = prep.describe(table_of(spark, sf, "band"), METERS)
    numbers = ("mean", "std", "min", "q25", "q50", "q75", "max")
    return stats.withColumns({c: F.round(c, 6) for c in numbers})


@query
def weather_features_band(spark, sf):
    """Feature means of the forecast window, without a model."""
    window = weather.forecast_window(derive.weather_hourly(spark, sf), F.lit(derive.AS_OF))
    rows = forecast.band_rollup(forecast.future_rows(window), prediction=None)
    return rows.withColumns({c: F.round(c, 6) for c in SCALED_FEATURES})


@query
def error_metrics(spark, sf):
    """Office load taken as the prediction of building load."""
    m = metrics.error_metrics(table_of(spark, sf, "hour"), "building", "office")
    return m.withColumns({c: F.round(c, 6) for c in ("mae", "mse", "rmse", "r2")})


@query
def linreg_one(spark, sf):
    """A line through most of the bands, and its errors on the others."""
    bands = table_of(spark, sf, "band").select(
        "day", "band", *[F.col(c).cast("double").alias(c) for c in ("office", "building")]
    )
    train, test = model.split(bands, 80, seed=0, keys=("day", "band"))
    fit = metrics.line_fit(train, "office", "building")
    line = fit.select(F.struct("slope", "intercept").alias("line")).scalar()
    scored = test.withColumn("_line", line).withColumn(
        "predicted", F.col("_line.intercept") + F.col("_line.slope") * F.col("office")
    )
    errors = metrics.error_metrics(scored, "building", "predicted").withColumnRenamed("n", "test_n")
    # One row each.
    both = fit.withColumn("_errors", errors.select(F.struct("*").alias("e")).scalar())
    digits = {"slope": 6, "intercept": 3, "mae": 3, "mse": 2, "rmse": 3, "r2": 6}
    return both.select("n", "slope", "intercept", "_errors.*").withColumns(
        {c: F.round(c, d) for c, d in digits.items()}
    )


# Models --------------------------------------------------------------------------

def _labelled(spark, sf):
    """Feature rows, written once: training reads them many times."""
    path = shared_dir(spark, "features")
    features_of(spark, sf).write.parquet(path)
    return model.with_label(spark.read.parquet(path))


def _split(spark, sf):
    return model.split(_labelled(spark, sf))


def _binned(train, folds=3):
    """Rows as trees are trained on, and the inputs and bins they have."""
    edges = ensemble.edges_of(train, FEATURES)
    rows = ensemble.training_rows(train, FEATURES, edges, folds, model.SEED + 1, ["ts"])
    return rows, edges, (len(FEATURES), ensemble.used_bins(edges))


def _of_one(base, test, edges, name):
    """Errors of one base model on rows it has not seen."""
    forest = base if isinstance(base, ensemble.Forest) else ensemble.Forest([])
    boosted = base if isinstance(base, ensemble.Boosted) else ensemble.Boosted(0.0, [], [])
    scored = ensemble.Stack(list(FEATURES), edges, forest, boosted, 0.0, [0.0, 0.0]).score(test)
    return model.evaluate(scored, {name: name})


@query
def train_test(spark, sf):
    rows = _labelled(spark, sf)
    train, test = model.split(rows)
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    ).groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("label"), 4).alias("label_sum"))


# One point of the grids: what the bases take where nothing else is asked.
FOREST = {"trees": (100,), "depth": (ensemble.DEEPEST,), "least": (2,)}
BOOSTED = {"rounds": (100,), "leaves": (31,), "kind": ("gbdt",)}


@query
def model_metrics(spark, sf):
    """Errors of a forest of 100 trees and of 100 rounds of boosting."""
    train, test = _split(spark, sf)
    rows, edges, size = _binned(train)
    forest, _ = ensemble.tune_forest(rows, *size, FOREST)
    boosted, _ = ensemble.tune_boosted(rows, *size, BOOSTED)
    stack = ensemble.Stack(list(FEATURES), edges, forest, boosted, 0.0, [0.0, 0.0])
    return model.evaluate(stack.score(test), {"forest": "forest", "boosted": "boosted"})


def _with_point(errors, point):
    return errors.select("*", *[F.lit(v).alias(k) for k, v in point.items() if k != "mse"])


@query
def tuned_forest(spark, sf):
    """The best of the 27 points of the forest's grid, by three folds, and its errors."""
    train, test = _split(spark, sf)
    rows, edges, size = _binned(train)
    best, point = ensemble.tune_forest(rows, *size)
    return _with_point(_of_one(best, test, edges, "forest"), point)


@query
def tuned_boosted(spark, sf):
    """The best of the 18 points of the grid of boosted trees, by three folds, and its errors."""
    train, test = _split(spark, sf)
    rows, edges, size = _binned(train)
    best, point = ensemble.tune_boosted(rows, *size)
    return _with_point(_of_one(best, test, edges, "boosted"), point)


SEVEN = ["office", "data_center", "band", "dow", "temperature_2m", "rain", "cloud_cover"]


def _bands_with_weather(spark, sf):
    """Bands with their weather, missing values as 0, written once."""
    path = shared_dir(spark, "bands")
    merge_weather_band(spark, sf).write.parquet(path)
    return model.with_label(prep.fill_zero(spark.read.parquet(path)))


def _rounded_errors(rows, columns):
    digits = {"mae": 3, "mse": 2, "rmse": 3, "r2": 6}
    return model.evaluate(rows, columns).withColumns({c: F.round(c, d) for c, d in digits.items()})


@query
def linreg_multi(spark, sf):
    """Building load from seven inputs, missing values as 0: errors on a fifth of the bands."""
    train, test = model.split(_bands_with_weather(spark, sf), 80, seed=0, keys=("day", "band"))
    fit = linear.fit(linear.state(train, SEVEN, model.LABEL))
    return _rounded_errors(linear.predict(test, fit, SEVEN), {"linear": "prediction"})


@query
def linreg_coefficients(spark, sf):
    """The line through seven inputs, from the merged states of its months."""
    rows = _bands_with_weather(spark, sf).withColumn("month", F.date_trunc("month", "day"))
    months = linear.state(rows, SEVEN, model.LABEL, ["month"])
    fit = linear.fit(linear.merged(months, len(SEVEN) + 1)).select("n", "fit.*")
    weights = [F.round(F.col("weights")[i], 6).alias(f"w_{c}") for i, c in enumerate(SEVEN)]
    return fit.select("n", F.round("intercept", 3).alias("intercept"), *weights)


BASES = {"by_office": ["office"], "by_center": ["data_center"]}


@query
def lasso_meta(spark, sf):
    """A lasso over the out-of-fold values of two lines, its weights and errors."""
    keys = ("day", "band")
    train, test = model.split(_bands_with_weather(spark, sf), 80, seed=0, keys=keys)
    dealt = train.withColumn("_fold", model.row_hash(model.SEED + 2, keys, 5))
    meta = linear.fit(
        linear.state(linear.out_of_fold(dealt, BASES, model.LABEL, 5), list(BASES), model.LABEL), 1.0
    )
    scored = test
    for name, inputs in BASES.items():
        scored = linear.predict(scored, linear.fit(linear.state(train, inputs, model.LABEL)), inputs, output=name)
    names = {n: n for n in BASES} | {"stack": "prediction"}
    errors = _rounded_errors(linear.predict(scored, meta, list(BASES)), names)
    found = meta.select(F.struct("fit.*").alias("f")).scalar()
    return errors.withColumn("_f", found).select(
        "*",
        F.round("_f.intercept", 3).alias("intercept"),
        *[F.round(F.col("_f.weights")[i], 6).alias(f"w_{n}") for i, n in enumerate(BASES)],
    ).drop("_f")


WEATHER_INPUTS = ["temperature_2m", "relative_humidity_2m", "cloud_cover", "wind_speed_10m", "hour", "dow", "band"]


@query
def forecast_linear(spark, sf):
    """Fit before the forecast window, score its hours, roll them up, append, read back."""
    hours = derive.weather_hourly(spark, sf)
    past = model.with_label(features_of(spark, sf).where(F.col("ts") < ntz(derive.AS_OF + " 00:00:00")))
    fit = linear.fit(linear.state(past, WEATHER_INPUTS, model.LABEL))
    window = weather.forecast_window(hours, F.lit(derive.AS_OF))
    scored = linear.predict(forecast.future_rows(window), fit, WEATHER_INPUTS)
    rows = forecast.rolled_up(scored, ntz(derive.AS_OF + " 00:00:00"))
    path = shared_dir(spark, "forecasts")
    tables.put_rows(rows, path, derive.AS_OF)
    digits = dict.fromkeys(SCALED_FEATURES, 6) | {forecast.FORECAST: 3}
    return tables.read_parts(spark, path).withColumns({c: F.round(c, d) for c, d in digits.items()})


@query
def stacked_metrics(spark, sf):
    """Both bases and the lasso over them, on rows that none has seen."""
    train, test = _split(spark, sf)
    stack, _ = ensemble.fit(train, FOREST, BOOSTED)
    names = {"forest": "forest", "boosted": "boosted", "stack": "prediction"}
    return model.evaluate(stack.score(test), names)


@query
def forecast_band(spark, sf):
    """Train before the forecast window, save, load, score, store twice, read back."""
    hours = derive.weather_hourly(spark, sf)
    train = _labelled(spark, sf).where(F.col("ts") < ntz(derive.AS_OF + " 00:00:00"))
    saved, path = shared_dir(spark, "model"), shared_dir(spark, "forecasts")
    stack, _ = ensemble.fit(train, FOREST, BOOSTED)
    ensemble.save(spark, stack, saved)
    rows = forecast.forecast_bands(
        ensemble.load(spark, saved),
        weather.forecast_window(hours, F.lit(derive.AS_OF)),
        updated_at=ntz(derive.AS_OF + " 00:00:00"),
    )
    for _ in range(2):  # a repeated run replaces its rows
        tables.put_rows(rows, path, derive.AS_OF)
    return tables.read_parts(spark, path)


# Streaming -----------------------------------------------------------------------


@query
def stream_incremental(spark, sf):
    """Two drops of files, the second overlapping the first by a day, loaded in two runs."""
    rows = derive.parsed_feed(spark, sf)
    folder = shared_dir(spark, "drops")
    target, checkpoint = shared_dir(spark, "loaded"), shared_dir(spark, "checkpoint")
    drops = [
        rows.where(F.col("ts") < ntz(derive.SPLIT)),
        rows.where(F.col("ts") >= ntz("2024-01-19 00:00:00")),
    ]
    for drop in drops:
        drop.write.mode("append").parquet(folder)
        streaming.load_new_files(
            streaming.stream_files(spark, folder, rows.schema), target, checkpoint
        )
    return tables.read(spark, target)


@query
def stream_delta_hour(spark, sf):
    """Hourly consumption of streamed readings, an hour of lateness allowed.

    Some readings arrive after all others, days behind the watermark, and are not counted.
    """
    folder = shared_dir(spark, "readings")
    out, checkpoint = shared_dir(spark, "hours"), shared_dir(spark, "checkpoint")
    rows = readings_of(spark, sf)
    late = (
        (F.col("ts") < ntz(derive.SPLIT)) & (F.minute("ts") == 45) & (F.hour("ts") % 6 == 0)
    )
    for drop in (rows.where(~late), rows.where(late)):
        drop.write.mode("append").parquet(folder)
        stream = streaming.stream_files(spark, folder, READINGS)
        streaming.write_updates(streaming.hourly_delta(stream, "1 hour"), out, checkpoint)
    return streaming.latest(spark, out, ["ts"]).select("ts", *METERS, "dow")


@query
def stream_dedup(spark, sf):
    """Rows that two overlapping drops deliver twice, once each, by the state of the stream."""
    streaming.keep_state_on_disk(spark)
    rows = derive.parsed_feed(spark, sf)
    folder, out, checkpoint = (shared_dir(spark, n) for n in ("drops", "once", "checkpoint"))
    drops = [
        rows.where(F.col("ts") < ntz(derive.SPLIT)),
        rows.where(F.col("ts") >= ntz("2024-01-19 00:00:00")),
    ]
    for drop in drops:
        drop.write.mode("append").parquet(folder)
        stream = streaming.stream_files(spark, folder, rows.schema)
        streaming.write_updates(streaming.deduplicated(stream, "3 days"), out, checkpoint, "append")
    return spark.read.parquet(out).select("feed", "seq", "ts", "kilowatt")


def _late_readings():
    return (F.col("ts") < ntz(derive.SPLIT)) & (F.minute("ts") == 45) & (F.hour("ts") % 6 == 0)


def _dealt_readings(spark, sf, aggregate=None):
    """Readings in two drops, some of them days late: folders of late rows and of closed windows."""
    streaming.keep_state_on_disk(spark)
    folder, timely, late, out, dealing, checkpoint = (
        shared_dir(spark, n) for n in ("readings", "timely", "late", "closed", "dealing", "checkpoint")
    )
    rows = readings_of(spark, sf)
    for drop in (rows.where(~_late_readings()), rows.where(_late_readings())):
        drop.write.mode("append").parquet(folder)
        stream = streaming.stream_files(spark, folder, READINGS)
        streaming.split_late(stream, timely, late, dealing, "1 HOUR")
        if aggregate:
            stream = streaming.stream_files(spark, timely, READINGS)
            streaming.write_updates(aggregate(stream), out, checkpoint, "append")
    return late, out


@query
def stream_late_rows(spark, sf):
    """The readings that came too late for the streams, kept beside them."""
    late, _ = _dealt_readings(spark, sf)
    return spark.read.schema(READINGS).parquet(late).select(*READINGS.names)


@query
def stream_delta_day(spark, sf):
    """Days that the watermark has passed, from the hours of a stream."""
    _, out = _dealt_readings(spark, sf, lambda s: streaming.chained_delta(s, "day", "1 hour"))
    return spark.read.parquet(out).select("ts", *METERS, "dow")


@query
def stream_delta_band(spark, sf):
    """Bands of the days that the watermark has passed, from the hours of a stream."""
    _, out = _dealt_readings(spark, sf, lambda s: streaming.chained_delta(s, "band", "1 hour"))
    return spark.read.parquet(out).select("day", "band", *METERS, "dow")


# Loads ---------------------------------------------------------------------------


def _stored_tables(spark, sf, splits, **options):
    """Every stored table after loading the feeds up to each time, one below the other."""
    feeds, hours = derive.meter_feeds(spark, sf), derive.weather_hourly(spark, sf)
    folder = shared_dir(spark, "raw")
    feeds.withColumn("seq", F.lit(0).cast("bigint")).write.parquet(f"{folder}/feeds")
    hours.write.parquet(f"{folder}/weather")
    raw, hours = (spark.read.parquet(f"{folder}/{n}") for n in ("feeds", "weather"))
    store = Store(shared_dir(spark, "store"))
    for split in splits:
        rows = raw if split is None else raw.where(F.col("ts") < ntz(split))
        load.load(rows, store, hours, downloaded_at=ntz(split or "2024-02-01 00:00:00"), **options)
    parts = []
    for grain in cal.GRAINS:
        table = load.classified(spark, store, grain)
        remote_column = {"hour": F.lit(None), "month": F.col("remote_pct"), "year": F.col("remote_pct")}
        time = F.col("day").cast("timestamp_ntz") if grain == "band" else F.col("ts")
        parts.append(
            table.select(
                F.lit(grain).alias("grain"),
                time.alias("ts"),
                (F.col("band") if grain == "band" else F.lit(None).cast("int")).alias("band"),
                *METERS,
                "rain",
                remote_column.get(grain, F.col("remote_flag") if "remote_flag" in table.columns else F.lit(None))
                .cast("string")
                .alias("remote"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def load_once(spark, sf):
    """One load of everything: five tables with weather and remote-working flags."""
    return _stored_tables(spark, sf, [None])


@query
def load_twice(spark, sf):
    """Two loads; buckets open at the first keep their values."""
    return _stored_tables(spark, sf, [derive.SPLIT, None])


@query
def load_twice_recomputed(spark, sf):
    """Two loads; buckets open at the first are computed again."""
    return _stored_tables(spark, sf, [derive.SPLIT, None], open_buckets=load.RECOMPUTE)


@query
def load_by_site(spark, sf):
    """Two loads of many sites, each with a horizon, last load and threshold of its own."""
    path = shared_dir(spark, "site-raw")
    feeds = derive.meter_feeds(spark, sf, site="user_id")
    feeds.withColumn("seq", F.lit(0).cast("bigint")).write.parquet(path)
    raw, store = spark.read.parquet(path), Store(shared_dir(spark, "site-store"))
    for split in (derive.SPLIT, None):
        rows = raw if split is None else raw.where(F.col("ts") < ntz(split))
        load.load(rows, store, keys=SITE, open_buckets=load.RECOMPUTE,
                  downloaded_at=ntz(split or "2024-02-01 00:00:00"))
    bands = load.classified(spark, store, "band", SITE)
    return bands.select(*SITE, "day", "band", *METERS, "dow", "remote_flag")


def _loaded_in_two(spark, sf):
    """A store after two loads, whose hours the second computed again where they were open."""
    path = shared_dir(spark, "usual-raw")
    feeds = derive.meter_feeds(spark, sf).withColumn("seq", F.lit(0).cast("bigint"))
    feeds.write.parquet(path)
    raw, store = spark.read.parquet(path), Store(shared_dir(spark, "usual-store"))
    for split in (derive.SPLIT, None):
        rows = raw if split is None else raw.where(F.col("ts") < ntz(split))
        load.load(rows, store, open_buckets=load.RECOMPUTE,
                  downloaded_at=ntz(split or "2024-02-01 00:00:00"))
    return store


@query
def usual_hours(spark, sf):
    """Stored hours without outliers, their limits found from the sketches that loads keep."""
    hours = load.usual_hours(spark, _loaded_in_two(spark, sf), "building", 0.95)
    return hours.select("ts", *METERS, "dow")


@query
def stored_summary(spark, sf):
    """Summary of the stored hours, quartiles found from the sketches that loads keep."""
    stats = load.summary(spark, _loaded_in_two(spark, sf))
    numbers = ("mean", "std", "min", "q25", "q50", "q75", "max")
    return stats.withColumns({c: F.round(c, 6) for c in numbers})
