"""Documents packed into training sequences of several permitted lengths.

Variable-capacity best-fit: pieces are taken from the longest down; a piece goes
into the open bin that it fills best, and if none has room, a bin is opened whose
capacity costs least for what it is expected to hold (the piece and what is left
of the pieces that fit behind it). In the end every bin shrinks to the smallest
permitted capacity that holds its contents.

A document longer than the largest capacity is cut into pieces of that capacity.
Pieces are dealt by hash into groups of about ``GROUP`` pieces, their number
following the table's, and each group is packed on its own; no text moves, only
lengths. A group's last bins are all that the split costs. Rows that repeat are
counted, and ``COPIES`` of them at a time are dealt out, so a text that a third of
the table repeats fills no group.

Nulls: a null text is an empty one, which still takes its end mark; a null id is
an id like any other. Repeated rows are packed each; of pieces of one length the
hash, then the id, decide which comes first. An empty table gives an empty result. Further columns play no part.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspan.llm.staging import chunks_for, staged, table, text_of

CAPACITIES = (1024, 2048, 4096, 8192, 16384)
#: Pieces that are packed together, on average.
GROUP = 4096
#: Equal pieces that are dealt out together.
COPIES = 64
#: What a sequence costs besides its length, and the length at which attention costs as much
#: as all else.
OVERHEAD, ATTENTION = 64, 65536


def cost(capacity: int) -> float:
    return OVERHEAD + capacity * (1 + capacity / ATTENTION)


def opened(length: int, lengths: np.ndarray, sums: np.ndarray, at: int, room: int,
           capacities: Sequence[int]) -> int:
    """The capacity that costs least per unit it will hold.

    ``lengths`` ascend and ``sums`` are their running totals; the first ``at`` are
    still to be placed. ``room`` is free in open bins and served first.
    """
    best, least = capacities[-1], float("inf")
    for capacity in capacities:
        if capacity < length:
            continue
        fit = min(at, int(np.searchsorted(lengths, capacity - length, "right")))
        waiting = max(0, int(sums[fit]) - room)
        price = cost(capacity) / (length + min(capacity - length, waiting))
        if price < least:
            best, least = capacity, price
    return best


def best_fit(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES):
    """Bin, offset and final capacity of every piece, given in ascending order of length."""
    capacities = sorted(capacities)
    ascending = np.asarray(lengths, np.int64)
    sums = np.concatenate([[0], np.cumsum(ascending)])
    bins, offsets = np.zeros(len(ascending), np.int64), np.zeros(len(ascending), np.int64)
    size, used, spaces, room = [], [], [], 0
    for i in range(len(ascending) - 1, -1, -1):
        length = int(ascending[i])
        found = bisect_left(spaces, (length, -1))
        if found < len(spaces):
            space, k = spaces.pop(found)
            room -= space
        else:
            k = len(size)
            space = opened(length, ascending, sums, i, room, capacities)
            size.append(space)
            used.append(0)
        bins[i], offsets[i] = k, used[k]
        used[k] += length
        if space > length:
            insort(spaces, (space - length, k))
            room += space - length
    final = np.asarray(capacities)[np.searchsorted(capacities, used)] if used else np.zeros(0, int)
    return bins, offsets, final[bins]


def pieces(docs: DataFrame, length: Column, largest: int, *others: str | Column) -> DataFrame:
    """doc_id, piece, start and length of every piece; ``length`` counts the end mark."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(length - 1, F.lit(0)), F.lit(largest))
    cut = docs.select(
        "doc_id", length.alias("_whole"), *others, F.posexplode(starts).alias("piece", "start")
    )
    return cut.withColumn("length", F.least(F.col("_whole") - F.col("start"), F.lit(largest))).drop(
        "_whole"
    )


def pack(found: DataFrame, capacities: Sequence[int] = CAPACITIES, group: int = GROUP) -> DataFrame:
    """Pieces with bin_id, offset and capacity.

    ``found`` has doc_id, piece, start, length and dealt, a hash that deals pieces out.
    """
    names = ["doc_id", "piece", "start", "length", "dealt"]
    found = staged(found.groupBy(*names).agg(F.count(F.lit(1)).alias("n")), "pieces")
    groups = chunks_for(found.agg(F.sum("n")).first()[0] or 0, group)
    kind = found.schema["doc_id"].dataType.simpleString()

    def packed(part: pa.Table) -> pa.Table:
        part = part.take(np.repeat(np.arange(len(part)), part["copies"].to_numpy()))
        part = part.sort_by([(c, "ascending") for c in ("length", "dealt", "doc_id", "piece")])
        bins, offsets, capacity = best_fit(part["length"].to_numpy(), capacities)
        out = part.select(["doc_id", "piece", "start", "length"])
        out = out.append_column("bin_id", pa.array(part["group"].to_numpy() * 2**32 + bins))
        out = out.append_column("offset", pa.array(offsets))
        return out.append_column("capacity", pa.array(capacity, pa.int64()))

    schema = (
        f"doc_id {kind}, piece int, start bigint, length bigint, bin_id bigint, offset bigint, "
        "capacity bigint"
    )
    # The group is added before the rows move, so that one key of even groups deals them out.
    handful = F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n") - 1).cast("long"), F.lit(COPIES).cast("long")))
    dealt = (
        found.withColumn("from", handful)
        .withColumn("copies", F.least(F.col("n") - F.col("from"), F.lit(COPIES)))
        .withColumn("group", F.pmod(F.xxhash64("dealt", "piece", "from"), F.lit(groups)))
    )
    return dealt.groupBy("group").applyInArrow(packed, schema)


def pack_texts(docs: DataFrame, capacities: Sequence[int] = CAPACITIES) -> DataFrame:
    """Whole texts packed by UTF-8 bytes, one more per document for its end mark."""
    text = text_of()
    length = F.octet_length(text).cast("long") + 1
    dealt = F.xxhash64("doc_id", text).alias("dealt")
    return pack(pieces(docs, length, max(capacities), dealt), capacities)


def sequences(docs: DataFrame, packed: DataFrame) -> DataFrame:
    """bin_id, capacity and content: the bytes of the bin's pieces, each document ended by a 0."""
    whole = docs.select("doc_id", F.concat(text_of().cast("binary"), F.lit(b"\0")).alias("whole"))
    parts = packed.join(whole, packed["doc_id"].eqNullSafe(whole["doc_id"])).select(
        "bin_id",
        "capacity",
        "offset",
        F.expr("substring(whole, cast(start AS int) + 1, cast(length AS int))").alias("part"),
    )
    in_order = F.array_sort(F.collect_list(F.struct("offset", "part")))
    joined = F.aggregate(
        in_order, F.lit(b""), lambda whole, x: F.concat(whole, x["part"])
    )
    return parts.groupBy("bin_id", "capacity").agg(joined.alias("content"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bin, offset and capacity of every piece of every document."""
    return pack_texts(table(spark, sf_dir, "documents"))
