"""Meter arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wattspan.schema import KW


def zero_if_missing(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0).cast(KW)).cast(KW)


def office(building: Column | str, data_center: Column | str, solar: Column | str) -> Column:
    """Office load: building without the data center, plus own production."""
    return (
        zero_if_missing(building) - zero_if_missing(data_center) + zero_if_missing(solar)
    ).cast(KW)


def percent_text(part: Column, whole: Column) -> Column:
    """``part / whole`` as text with two decimals and a percent sign."""
    share = part.cast("decimal(18,0)") / whole.cast("decimal(18,0)") * 100
    return F.concat(F.round(share, 2).cast("decimal(10,2)").cast("string"), F.lit("%"))
