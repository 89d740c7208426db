"""Keyed tables as parquet folders, one per month and write, behind a pointer.

Every write goes to a folder of its own; then a numbered pointer file names, for
each month, the folders that hold it, and the columns of the table. A reader
follows the highest pointer, so it sees a write whole or not at all, and a
writer that dies before the pointer is there has changed nothing. A load touches
the months of its batch only: inserts add a folder to them, updates replace
theirs. ``compact`` joins a month's small folders once it has many. Folders that
only pointers before the last two name are deleted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattspan.operators import merge

# Partition column: the month as a number, yyyymm.
PERIOD = "period"
POINTERS = "_live"
# Folders a month may have before its small ones are joined, and the bytes that make one large.
FOLDERS, LARGE = 8, 256 << 20


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, fs = _folder(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in _names(spark, f"{path}/{POINTERS}") if n.isdigit())


def _pointer(spark: SparkSession, path: str, number: int) -> dict:
    file, fs = _folder(spark, f"{path}/{POINTERS}/{number:08d}")
    stream = fs.open(file)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _current(spark: SparkSession, path: str) -> tuple[int, dict | None]:
    numbers = _numbers(spark, path)
    return (numbers[-1], _pointer(spark, path, numbers[-1])) if numbers else (0, None)


def _publish(spark: SparkSession, path: str, number: int, state: dict) -> None:
    """Write a pointer under a name of its own, then give it its number."""
    draft, fs = _folder(spark, f"{path}/{POINTERS}/.{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    final, _ = _folder(spark, f"{path}/{POINTERS}/{number:08d}")
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"another writer changed {path} meanwhile")


def _written(state: dict | None) -> set[str]:
    return {f for folders in (state or {"months": {}})["months"].values() for f in folders}


def _forget(spark: SparkSession, path: str) -> None:
    """Delete pointers before the last two, and folders that only they name."""
    numbers = _numbers(spark, path)
    kept = set().union(*(_written(_pointer(spark, path, n)) for n in numbers[-2:]))
    for n in numbers[:-2]:
        for name in _written(_pointer(spark, path, n)) - kept:
            folder, fs = _folder(spark, f"{path}/{name}")
            fs.delete(folder, True)
        file, fs = _folder(spark, f"{path}/{POINTERS}/{n:08d}")
        fs.delete(file, False)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written with at least one row."""
    _, state = _current(spark, path)
    if state is not None:
        return bool(state["months"])
    return any(not name.startswith(("_", ".")) for name in _names(spark, path))


def months(
    spark: SparkSession, path: str, lo: int = 0, hi: int = 999999, also: Collection[int] = ()
) -> DataFrame:
    """The stored rows of the months from ``lo`` to ``hi`` and some more; folders of others are
    not read."""
    _, state = _current(spark, path)
    schema = T.StructType.fromJson(state["schema"])
    found = [
        f"{path}/{folder}/{PERIOD}={month}"
        for month, folders in sorted(state["months"].items())
        if lo <= int(month) <= hi or int(month) in also
        for folder in folders
    ]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    return months(spark, path)


def month_number(time):
    return (F.year(time) * 100 + F.month(time)).cast("int")


def time_span(batch: DataFrame, time: str = "ts"):
    """First and last time of a batch, or None: two values, so that scans can prune."""
    row = batch.agg(F.min(time).alias("lo"), F.max(time).alias("hi")).first()
    return None if row["lo"] is None else (row["lo"], row["hi"])


def month_span(times) -> tuple[int, int]:
    lo, hi = times
    return lo.year * 100 + lo.month, hi.year * 100 + hi.month


def month_bounds(span: tuple[int, int]) -> tuple[datetime, datetime]:
    """The first instant of a span of months, and the first behind it."""
    (lo, hi), after = span, span[1] + (1 if span[1] % 100 < 12 else 89)
    return datetime(lo // 100, lo % 100, 1), datetime(after // 100, after % 100, 1)


def _joined(stored: dict | None, fresh: T.StructType) -> T.StructType:
    """The columns a table has and those a write brings; what it has keeps its type."""
    fields = list(T.StructType.fromJson(stored["schema"]).fields) if stored else []
    have = {f.name for f in fields}
    fields += [f for f in fresh.fields if f.name not in have]
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def _write(
    df: DataFrame,
    path: str,
    time: str,
    keys: Sequence[str],
    replaced: tuple[int, int] | None,
    gather: bool = True,
    also: Collection[int] = (),
) -> None:
    """Write rows to a new folder and point to it; ``replaced`` months are given up for it."""
    spark = df.sparkSession
    number, state = _current(spark, path)
    schema = _joined(state, df.schema)
    name, fresh = _write_folder(df, schema, path, time, keys, gather)
    lo, hi = replaced or (1, 0)
    held = {
        m: f
        for m, f in (state["months"] if state else {}).items()
        if not (lo <= int(m) <= hi or int(m) in also)
    }
    for month in fresh:
        held[month] = [*held.get(month, []), name]
    _publish(spark, path, number + 1, {"schema": schema.jsonValue(), "months": held})
    _forget(spark, path)


def _write_folder(
    df: DataFrame, schema: T.StructType, path: str, time: str, keys: Sequence[str], gather: bool = True
) -> tuple[str, list[str]]:
    """Write rows to a folder that no pointer names yet: its name and the months it has."""
    spark = df.sparkSession
    have = set(df.columns)
    out = df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in have]
    ).withColumn(PERIOD, month_number(time))
    if gather:
        # A day of one key's rows stays together, so that later hourly aggregation
        # mostly finishes before its shuffle and time filters skip row groups. AQE
        # joins small pieces and splits crowded ones.
        together = [F.col(PERIOD), *[F.col(k) for k in keys if k != time], F.col("_day")]
        out = out.withColumn("_day", F.to_date(time)).hint("rebalance", *together).drop("_day")
    name = uuid.uuid4().hex
    out.sortWithinPartitions(PERIOD, time).write.partitionBy(PERIOD).parquet(f"{path}/{name}")
    prefix = f"{PERIOD}="
    found = [x.removeprefix(prefix) for x in _names(spark, f"{path}/{name}") if x.startswith(prefix)]
    return name, found


def _bytes(spark: SparkSession, path: str) -> int:
    folder, fs = _folder(spark, path)
    return fs.getContentSummary(folder).getLength()


def compact(
    spark: SparkSession,
    path: str,
    time: str = "ts",
    keys: Sequence[str] = (),
    most: int = FOLDERS,
    large: int = LARGE,
) -> list[str]:
    """Join the small folders of every month that has more than ``most``; the months it joined.

    Folders of ``large`` bytes stay as they are, so a row is written again a bounded number
    of times. Readers go on with the folders that their pointer named.
    """
    number, state = _current(spark, path)
    due = {}
    for month, folders in (state or {"months": {}})["months"].items():
        if len(folders) > most:
            small = [f for f in folders if _bytes(spark, f"{path}/{f}/{PERIOD}={month}") < large]
            if len(small) > 1:
                due[month] = small
    if not due:
        return []
    schema = T.StructType.fromJson(state["schema"])
    places = [f"{path}/{f}/{PERIOD}={month}" for month, small in due.items() for f in small]
    name, _ = _write_folder(spark.read.schema(schema).parquet(*places), schema, path, time, keys)
    held = {
        month: [f for f in folders if f not in due.get(month, ())] + [name] * (month in due)
        for month, folders in state["months"].items()
    }
    _publish(spark, path, number + 1, {"schema": state["schema"], "months": held})
    _forget(spark, path)
    return sorted(due)


def store_new(rows: DataFrame, path: str, keys: Sequence[str], time: str = "ts") -> bool:
    """Write a table that is not there yet, in one pass over its rows; False without any."""
    _write(rows, path, time, keys, None)
    return exists(rows.sparkSession, path)


def append_new(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    time: str = "ts",
    order: str | None = None,
    gather: bool = True,
    times=None,
) -> None:
    """Append the rows whose keys the table does not hold; stored rows win.

    Running it again with the same batch adds nothing. Only stored rows within
    the batch's times are looked at; usually there are none, and the batch is
    written without a join. ``gather=False`` keeps the batch's own layout.
    ``times``, a span that holds the batch, saves finding it out.
    """
    spark = batch.sparkSession
    times = times or time_span(batch, time)
    if times is None:
        return
    rows = merge.one_per_key(batch, keys, order)
    if exists(spark, path):
        stored = months(spark, path, *month_span(times)).where(F.col(time).between(*times))
        if not stored.isEmpty():
            rows = merge.rows_to_insert(stored, rows, keys)
    _write(rows, path, time, keys, None, gather)


def rewrite(
    spark: SparkSession,
    path: str,
    span: tuple[int, int],
    change: Callable[[DataFrame | None], DataFrame],
    time: str = "ts",
    keys: Sequence[str] = (),
    also: Collection[int] = (),
) -> None:
    """Replace the months of ``span``, and those in ``also``, by ``change`` of their stored rows.

    ``change`` gets None while the table does not exist, and must keep rows
    within the span. A month whose rows all go is gone from the table; columns
    that ``change`` does not return stay in the table, empty for its rows.
    """
    stored = months(spark, path, *span, also) if exists(spark, path) else None
    _write(change(stored), path, time, keys, span, also=also)


def append(df: DataFrame, path: str) -> None:
    """Append rows to a plain folder, creating it if it is not there."""
    df.write.mode("append").parquet(path)


# Whole folders behind a pointer: parts that are replaced one by one -----------------------


def put(spark: SparkSession, path: str, part: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder of its own, then point ``part`` to it.

    What the part held before counts until the pointer is there, and readers of it are not
    disturbed; the same part put again replaces itself only.
    """
    number, state = _current(spark, path)
    name = uuid.uuid4().hex
    write(f"{path}/{name}")
    held = {**(state["months"] if state else {}), part: [name]}
    _publish(spark, path, number + 1, {"months": held})
    _forget(spark, path)


def parts(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of every part."""
    _, state = _current(spark, path)
    return {p: f"{path}/{folders[0]}" for p, folders in (state or {"months": {}})["months"].items()}


def put_rows(df: DataFrame, path: str, part: str) -> None:
    put(df.sparkSession, path, part, df.write.parquet)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all parts of a table written by ``put_rows``."""
    return spark.read.option("mergeSchema", True).parquet(*parts(spark, path).values())
