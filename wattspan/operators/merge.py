"""Keyed writes expressed as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def one_per_key(
    batch: DataFrame, keys: Sequence[str], order: str | None, keep: str = "first"
) -> DataFrame:
    """The first or last row of a batch for every key.

    ``order=None`` states that keys are already unique.
    """
    if order is None:
        return batch
    pick = F.min_by if keep == "first" else F.max_by
    rest = [c for c in batch.columns if c not in keys]
    return (
        batch.groupBy(*keys).agg(*[pick(c, order).alias(c) for c in rest]).select(*batch.columns)
    )


def rows_to_insert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str | None = None
) -> DataFrame:
    """The part of ``batch`` whose keys ``target`` does not hold yet."""
    fresh = one_per_key(batch, keys, order)
    return fresh.join(target.select(*keys), list(keys), "left_anti").select(*batch.columns)


def insert_ignore(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str | None = None
) -> DataFrame:
    """``target`` with the new keys of ``batch``; existing rows win.

    Columns only the target has are NULL on the added rows.
    """
    return target.unionByName(
        rows_to_insert(target, batch, keys, order), allowMissingColumns=True
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: str | None = None,
) -> DataFrame:
    """``target`` with ``columns`` overwritten from ``source`` and its missing keys added.

    Other target columns stay, and are NULL on added rows. With ``order`` the
    last source row of a key wins.
    """
    src = one_per_key(source, keys, order, keep="last").select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit")
    )
    types = dict(target.dtypes)
    names = list(target.columns) + [c for c in columns if c not in types]
    joined = target.join(src, list(keys), "full")

    def value(c):
        if c in keys:
            return F.col(c)
        if c not in columns:
            return F.col(c)
        if c not in types:
            return F.col(f"_new_{c}").alias(c)
        return F.when(F.col("_hit"), F.col(f"_new_{c}").cast(types[c])).otherwise(F.col(c)).alias(c)

    return joined.select(*[value(c) for c in names])


def update_from(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """``target`` with ``columns`` set from the matching ``source`` row.

    ``source`` has one row per key. A column the target lacks is added.
    """
    src = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit")
    )
    joined = target.join(src, list(keys), "left")
    kept = [c for c in target.columns if c not in columns]
    values = []
    for c in columns:
        new = F.col(f"_new_{c}")
        old = F.col(c) if c in target.columns else F.lit(None)
        values.append(F.when(F.col("_hit"), new).otherwise(old).alias(c))
    return joined.select(*kept, *values)
