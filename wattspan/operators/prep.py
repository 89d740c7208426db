"""Feature preparation and descriptive statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattspan.functions import calendar as cal
from wattspan.functions import comfort
from wattspan.operators import sketches as sk
from wattspan.schema import CALENDAR_FEATURES, SCALED_FEATURES, TARGET

# Parts of a column's range that ranks are located among, and how often.
CELLS, LEVELS = 1024, 2


def with_calendar(df: DataFrame, time: str = "ts") -> DataFrame:
    """Calendar parts of ``time``; replaces a stored day of week by the Monday-0 code."""
    return df.withColumns(cal.calendar_parts(time))


def feature_rows(
    agg_hour: DataFrame, wind_factor: float = comfort.WIND_TO_MPH, keys: Sequence[str] = ()
) -> DataFrame:
    """Model input from the hourly table: complete rows with solar production.

    ``keys`` and ``ts`` stay as the row's identity, followed by the features and
    the target.
    """
    usable = agg_hour.na.drop("any").where(F.col("solar") != 0)
    full = with_calendar(usable.withColumns(comfort.weather_indices(wind_factor=wind_factor)))
    return full.select(
        *keys,
        "ts",
        *[F.col(c).cast("double").alias(c) for c in SCALED_FEATURES],
        *CALENDAR_FEATURES,
        TARGET,
    )


def scaler_stats(df: DataFrame, columns: Sequence[str] = SCALED_FEATURES) -> DataFrame:
    """One row: mean and population standard deviation of every column."""
    return df.agg(
        *[
            F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c)
            for c in columns
        ]
    )


def _standard(c: Column, mean: Column, std: Column) -> Column:
    return (c - mean) / F.when(std == 0, 1.0).otherwise(std)


def scale(
    df: DataFrame, columns: Sequence[str] = SCALED_FEATURES, fitted_on: DataFrame | None = None
) -> DataFrame:
    """Standard-scaled columns, by the statistics of ``fitted_on`` (default: ``df`` itself)."""
    stats = scaler_stats(df if fitted_on is None else fitted_on, columns)
    row = stats.select(F.struct(*columns).alias("stats")).scalar()
    scaled = {
        c: _standard(F.col(c), F.col(f"_stats.{c}.mean"), F.col(f"_stats.{c}.std"))
        for c in columns
    }
    return df.withColumn("_stats", row).withColumns(scaled).drop("_stats")


def fill_zero(df: DataFrame) -> DataFrame:
    return df.na.fill(0)


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.inline(entries))
        .where(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


RANK = ("name", "prob", "side")


def _narrowed(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every wanted rank with the one of ``CELLS`` parts of its range that holds it.

    ``wanted`` has the rank counted from the low end of its range; so has the result.
    """
    width = (F.col("hi") - F.col("lo")) / CELLS
    cell = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(CELLS - 1)))
    inside = counts.join(wanted, "name").where(F.col("value").between(F.col("lo"), F.col("hi")))
    cells = inside.groupBy(*RANK, "pos", "rank", F.coalesce(cell, F.lit(0)).alias("cell")).agg(
        F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    along = Window.partitionBy(*RANK).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    return (
        cells.withColumn("upto", F.sum("n").over(along))
        .withColumn("before", F.col("upto") - F.col("n"))
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto")))
        .select(*RANK, "pos", (F.col("rank") - F.col("before")).alias("rank"), "lo", "hi")
    )


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int
) -> DataFrame:
    """Quantiles whose rank is off by a share of 1/accuracy of the rows at most, in one pass."""
    points = F.array(*[F.lit(float(p)) for p in probs])
    found = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), points, accuracy).alias(c) for c in columns]
    )
    each = F.array(
        *[
            F.struct(F.lit(c).alias("name"), F.lit(float(p)).alias("prob"), F.col(c)[i].alias("value"))
            for c in columns
            for i, p in enumerate(probs)
        ]
    )
    return found.select(F.inline(each)).where("value IS NOT NULL")


def _hinted(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], sketches: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Wanted ranks and the counts of the values near them, in two passes over the rows.

    The first counts the rows below and within the places that the sketches name, so a
    rank is known to be there, or below or above; the second takes the values of that part.
    The driver sees up to seven numbers per column and probability.
    """
    hints = {(r["name"], r["prob"]): (r["lo"], r["hi"]) for r in sk.brackets(sketches, probs).collect()}
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    stats = [f(c) for c in columns for f in (F.count, F.min, F.max)]
    places = [(c, p) for c in columns for p in probs if (c, p) in hints]
    for c, p in places:
        lo, hi = hints[c, p]
        stats += [F.count_if(F.col(c) < lo), F.count_if(F.col(c) <= hi)]
    found = tuple(numbers.agg(*[s.alias(f"s{i}") for i, s in enumerate(stats)]).first())
    size = 3 * len(columns)
    totals = {c: found[3 * i : 3 * i + 3] for i, c in enumerate(columns)}
    counted = {at: found[size + 2 * i : size + 2 * i + 2] for i, at in enumerate(places)}
    wanted, kept = [], []
    for c in columns:
        total, least, most = totals[c]
        near = F.lit(False)
        for p in map(float, probs) if total else ():
            pos = p * (total - 1)
            lo, hi = hints.get((c, p), (least, most))
            before, upto = counted.get((c, p), (0, total))
            for side, rank in (("lo", math.floor(pos)), ("hi", math.ceil(pos))):
                # Beyond the hint, the part reaches to the end of the column's range.
                if rank < before:
                    part = (rank, least, lo)
                else:
                    part = (rank - before, lo, hi if rank < upto else most)
                wanted.append((c, p, side, pos, *part))
                near = near | F.col(c).between(*part[1:])
        kept.append(F.when(near, F.col(c)).alias(c))
    schema = "name string, prob double, side string, pos double, rank bigint, lo double, hi double"
    ranks = df.sparkSession.createDataFrame(wanted, schema)
    return ranks, _value_counts(numbers.select(*kept), columns)


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], sketches: DataFrame | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation of numeric columns: (name, prob, value).

    Rows are counted per distinct value. The ranks wanted are located among equal
    parts of a column's range, then among parts of that part; only the values
    that are left, between neighbouring ends a millionth of the range apart, are
    put in order.

    ``sketches`` (``sketches.month_sketches`` of any months) say where the ranks should
    be: then the rows are counted around those places at once, and only values near them
    are grouped. Sketches that are old, or lack a column, cost time but change no result.
    """
    if sketches is None:
        counts = _value_counts(df, columns)
        pos = F.col("prob") * (F.col("total") - 1)
        rank = F.when(F.col("side") == "lo", F.floor("pos")).otherwise(F.ceil("pos"))
        wanted = (
            counts.groupBy("name")
            .agg(F.sum("n").alias("total"), F.min("value").alias("lo"), F.max("value").alias("hi"))
            .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
            .withColumn("side", F.explode(F.array(F.lit("lo"), F.lit("hi"))))
            .withColumn("pos", pos)
            .select(*RANK, "pos", rank.alias("rank"), "lo", "hi")
        )
    else:
        wanted, counts = _hinted(df, columns, probs, sketches)
    for _ in range(LEVELS if sketches is None else LEVELS - 1):
        wanted = _narrowed(counts, wanted)
    inside = Window.partitionBy(*RANK).orderBy("value")
    reached = (
        counts.join(wanted, "name")
        .where(F.col("value").between(F.col("lo"), F.col("hi")))
        .withColumn("at", F.sum("n").over(inside))
        .where(F.col("at") > F.col("rank"))
        .groupBy(*RANK, "pos")
        .agg(F.min("value").alias("value"))
    )
    ends = reached.groupBy("name", "prob", "pos").agg(
        F.max(F.when(F.col("side") == "lo", F.col("value"))).alias("lo"),
        F.max(F.when(F.col("side") == "hi", F.col("value"))).alias("hi"),
    )
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("pos") - F.floor("pos"))
    return ends.select("name", "prob", value.alias("value"))


def filter_outliers(
    df: DataFrame,
    column: str,
    threshold: float,
    accuracy: int | None = None,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """Rows between the (1 - threshold) and the threshold quantile, both included.

    ``accuracy`` asks for approximate quantiles instead of exact ones; ``sketches`` are
    hints for exact ones.
    """
    probs = [1 - threshold, threshold]
    if accuracy:
        found = approximate_quantiles(df, [column], probs, accuracy)
    else:
        found = quantiles(df, [column], probs, sketches)
    limits = found.agg(
        F.struct(
            F.max(F.when(F.col("prob") == 1 - threshold, F.col("value"))).alias("lo"),
            F.max(F.when(F.col("prob") == threshold, F.col("value"))).alias("hi"),
        ).alias("b")
    )
    value = F.col(column).cast("double")
    return (
        df.withColumn("_b", limits.scalar())
        .where((value <= F.col("_b.hi")) & (value >= F.col("_b.lo")))
        .drop("_b")
    )


def describe(
    df: DataFrame, columns: Sequence[str], sketches: DataFrame | None = None
) -> DataFrame:
    """Summary statistics, one row per column; ``sketches`` are hints for its quartiles."""
    stats = {
        "count": lambda c: F.count(c),
        "mean": lambda c: F.avg(F.col(c).cast("double")),
        "std": lambda c: F.stddev_samp(F.col(c).cast("double")),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    moments = df.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("name"), *[f(c).alias(s) for s, f in stats.items()])
                for c in columns
            ]
        ).alias("rows")
    ).select(F.inline("rows"))
    quarters = (
        quantiles(df, columns, [0.25, 0.5, 0.75], sketches)
        .groupBy("name")
        .agg(
            *[
                F.max(F.when(F.col("prob") == p, F.col("value"))).alias(a)
                for p, a in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
            ]
        )
    )
    return moments.join(quarters, "name", "left").select(
        "name", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )

