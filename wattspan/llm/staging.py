"""Intermediate tables in the shared folder of the cluster, and columns that cannot clash."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SETTING = "spark.checkpoint.dir"
LAST = 2**63 - 1


#: The folder of a local session that names none; made once.
_OWN: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``; a folder is made only where it is unset and
    the master is local."""
    base = spark.conf.get(SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that every executor reaches")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="llm-"))
        base = _OWN[0]
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back.

    Work that is used more than once is computed once, and a lost executor costs
    a read instead of the whole lineage.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(text: str | Column = "text") -> Column:
    """A text column without nulls: a null text counts as an empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def id_or_last(doc_id: str = "doc_id") -> Column:
    """An id that orders rows without one after all others."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into the fold kept from training; a null id is "".
    """
    digits = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(digits.cast("binary")) % folds == fold


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks_for(rows: int, per_chunk: int) -> int:
    return max(1, math.ceil(rows / per_chunk))


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, for results worth keeping between
    tasks. Users bound its size."""
    import sys
    import types

    module = sys.modules.setdefault("_llm_worker_store", types.ModuleType("_llm_worker_store"))
    return module.__dict__.setdefault(name, {})
