"""Quantile sketches that are kept per month and merged: hints where a rank lies.

A sketch answers within a rank error that holds for nearly all draws, so its answer
only says where to look. ``prep.quantiles`` counts the rows on both sides of that
place and returns the exact value, wherever it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Size of a sketch (some 50 kB when full), and the share of all rows on each side of its
# answer within which a rank is looked for: four times the error it has at that size.
SIZE, MARGIN = 2000, 0.006


def month_sketches(
    rows: DataFrame, columns: Sequence[str], time: str = "ts", size: int = SIZE
) -> DataFrame:
    """One sketch per month and column that has values: (ts, name, sketch).

    ``ts`` is the first instant of the month. Null values are left out.
    """
    sketched = rows.groupBy(F.date_trunc("month", F.col(time)).cast("timestamp_ntz").alias("ts")).agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias("sketch"),
            ).alias(c)
            for c in columns
        ]
    )
    each = F.array(
        *[
            F.struct(F.lit(c).alias("name"), F.col(f"{c}.n").alias("n"), F.col(f"{c}.sketch").alias("sketch"))
            for c in columns
        ]
    )
    return sketched.select("ts", F.inline(each)).where("n > 0").select("ts", "name", "sketch")


def brackets(sketches: DataFrame, probs: Sequence[float], margin: float = MARGIN) -> DataFrame:
    """Where the quantiles should lie, by the sketches of any months: (name, prob, lo, hi)."""
    merged = sketches.groupBy("name").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    at = F.kll_sketch_get_quantile_double  # takes literal ranks only
    ends = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("prob"),
                at("sketch", F.lit(max(0.0, p - margin))).alias("lo"),
                at("sketch", F.lit(min(1.0, p + margin))).alias("hi"),
            )
            for p in probs
        ]
    )
    return merged.select("name", F.inline(ends))
