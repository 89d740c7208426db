"""Shards of equal row counts that each hold the mixture of sources.

Proportional stratified interleaving: the rows of a source are shuffled by a
seeded hash and ranked; a row's fractional rank is its place in its source as a
share of that source, less a seeded part of a row, the same for all its rows.
Sorting all rows by fractional rank interleaves the sources in proportion, and
cutting that order into equal runs gives every shard the same mixture; sources of
one row fall anywhere instead of together.

Ranks are taken in two steps, so that no source and no order passes through one
task: rows fall into buckets of the hash (or of the fractional rank), buckets
are counted with partial aggregation, running totals of the counts give each
bucket its offset, first over runs of buckets, then within each, and only the rows
of one bucket are numbered together. The number of buckets follows the number of
rows. Equal rows are one counted row while ranks are taken; its copies are dealt
out in runs afterwards.

Nulls: a null source is a stratum of its own, a null id sorts last, a null text
has size 1 and the checksum of the empty text. Equal rows are interchangeable
and get different slots. An empty table gives an empty result. Further columns
of the input play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wattspan.llm.staging import chunks_for, id_or_last, partitions, staged, table, text_of

#: Rows that are numbered together, on average.
BUCKET_ROWS = 256
#: Buckets whose running totals are taken together, and copies of a row that one task makes.
RUN = 65_536


def described(docs: DataFrame, seed: int) -> DataFrame:
    """Size, checksum, stratum and shuffle key of every row; the text stays behind."""
    text = text_of()
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("stratum"),
        F.xxhash64(F.lit(seed), id_or_last(), text).alias("dealt"),
    )


def numbered(
    rows: DataFrame, keys: list[str], bucket: Column, order: list[str], number: str, of: str
) -> DataFrame:
    """Rows, each standing for ``copies``, with the number of their first one, from 0, in the
    order of (bucket, order) within keys, and the copies their keys have.

    ``bucket`` must not fall as ``order`` rises, and must hold few enough rows for one task.
    """
    rows = rows.withColumn("_bucket", bucket)
    counts = rows.groupBy(*keys, "_bucket").agg(F.sum("copies").alias("_n"))
    counts = counts.withColumn("_run", F.floor(F.col("_bucket") / RUN))
    totals = counts.groupBy(*keys, "_run").agg(F.sum("_n").alias("_n"))
    all_of = Window.partitionBy(*keys)

    def before(of: Window, by: str) -> Column:
        sum_of = F.sum("_n").over(of.orderBy(by).rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(sum_of, F.lit(0))

    runs = totals.select(
        *keys, "_run", before(all_of, "_run").alias("_first"), F.sum("_n").over(all_of).alias(of)
    )
    within_run = before(Window.partitionBy(*keys, "_run"), "_bucket")
    offsets = counts.withColumn("_before", within_run).drop("_n").join(runs, [*keys, "_run"]).drop("_run")
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    upto = F.sum("copies").over(within.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("_upto", upto)
        .join(offsets, [*keys, "_bucket"])
        .withColumn(number, F.col("_first") + F.col("_before") + F.col("_upto") - F.col("copies"))
        .drop("_bucket", "_before", "_first", "_upto")
    )


def each_copy(rows: DataFrame, number: str) -> DataFrame:
    """One row for each of a row's copies, numbered on; few tasks make none of many copies."""
    start, last, copies = F.lit(0).cast("long"), F.col("copies") - 1, F.col("copies")
    runs = rows.withColumn("_from", F.explode(F.sequence(start, last, F.lit(RUN).cast("long"))))
    runs = runs.repartition(partitions(rows.sparkSession), "dealt", "doc_id", "_from")
    last = F.least(copies - F.col("_from"), F.lit(RUN).cast("long")) - 1
    return (
        runs.withColumn("_copy", F.explode(F.sequence(start, last)))
        .withColumn(number, F.col(number) + F.col("_from") + F.col("_copy"))
        .withColumn("copies", F.lit(1).cast("long"))
        .drop("_from", "_copy")
    )


def share_bucket(share: Column, buckets: int) -> Column:
    return F.least(F.floor(share * buckets), F.lit(buckets - 1))


def interleave(docs: DataFrame, shards: int = 16, seed: int = 7) -> DataFrame:
    """One row per document: size, checksum, fractional rank, shard, and slot within the shard.

    Shard i holds the places from ceil(i*n/shards) up to ceil((i+1)*n/shards) of
    the interleaved order, so counts differ by one at most.
    """
    rows = described(docs, seed)
    rows = staged(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")), "dealt")
    buckets = chunks_for(rows.agg(F.sum("copies")).first()[0] or 0, BUCKET_ROWS)
    ranked = numbered(
        rows,
        ["stratum"],
        share_bucket(F.col("dealt").cast("double") / 2.0**64 + 0.5, buckets),
        ["dealt", "doc_id", "text_crc32"],
        "rank",
        "stratum_rows",
    )
    # A point of the row's share of its source: the same of every row, another in every source.
    point = F.xxhash64(F.lit(seed), "stratum").cast("double") / 2.0**64 + 0.5
    shared = each_copy(ranked, "rank").withColumn(
        "share", (F.col("rank") + point) / F.col("stratum_rows")
    ).withColumn("_all", F.lit(0))
    order = ["share", "dealt", "stratum", "rank"]
    placed = numbered(shared, ["_all"], share_bucket(F.col("share"), buckets), order, "place", "n")
    return (
        placed.withColumn("shard", F.expr(f"place * {shards} div n").cast("int"))
        .withColumn("slot", F.expr(f"place - (shard * n + {shards - 1}) div {shards}"))
        .select("doc_id", "size", "text_crc32", "stratum", "share", "shard", "slot")
    )


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards by the law of equal row counts."""
    dealt = interleave(table(spark, sf_dir, "documents"))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
