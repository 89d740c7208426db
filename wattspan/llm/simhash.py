"""SimHash fingerprints and the links between near ones, found at anchor points.

A fingerprint word of 2^m bits is compared at the anchors of a covering code:
the perfect Hamming code of 2^m - 1 bits, whose covering radius is 1, with the
last bit free. Two words that differ in at most two bits have a word between
them that differs from each in one bit at most; the anchor of that word lies
within its covering radius of 1. So the covering radius plus the threshold,
the threshold shared by both sides, is 2 for each: every word goes to all its
anchors within two bits (2^(m-1) + 1 of them, 33 for 64 bits and 17 for 32), and
words that link always meet. An anchor has at most 2,081 words within two bits
(64 bits), so no anchor grows with the data, however many copies there are.

Equal texts and equal fingerprints are brought together before that. Words of
an anchor arrive sorted in one stream; an anchor's links are thinned to a
spanning forest of them, which keeps every component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wattspan.llm.components import components
from wattspan.llm.staging import id_or_last, partitions, staged, table, text_of

SEED = 42
#: Shingles whose bits are counted at once; memory stays bounded for any text.
BLOCK = 255 * 64
THRESHOLD = 2


def shingle_hashes(text: str, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle as a number; fewer words than that make one shingle, none none."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
    return np.frombuffer(
        b"".join([xxhash.xxh64_digest(s, seed) for s in shingles]), dtype=">u8"
    ).astype(np.uint64)


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many hashes set each of the 64 bits, highest bit first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = np.unpackbits(hashes[at : at + BLOCK].astype(">u8").view(np.uint8)).reshape(-1, 64)
        whole = len(block) // 255 * 255
        if whole:  # sums of up to 255 bits fit a byte
            part = np.add.reduce(block[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8)
            total += part.sum(axis=0, dtype=np.int64)
        total += block[whole:].sum(axis=0, dtype=np.int64)
    return total


def fingerprint(hashes: np.ndarray) -> int:
    """The 64-bit fingerprint: a bit is 1 if more than half of the hashes set it."""
    bits = set_bits(hashes) * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int, *others: str | Column) -> DataFrame:
    """The named columns and fp, the fingerprint as a long; a text without words gets 0."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            values = np.array([fingerprint(shingle_hashes(x, words)) for x in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(values.view(np.int64))],
                names=[*batch.schema.names[:-1], "fp"],
            )

    schema = T.StructType([*docs.select(*others).schema.fields, T.StructField("fp", T.LongType())])
    return docs.select(*others, text_of().alias("text")).mapInArrow(batches, schema)


def flips(m: int) -> list[np.ndarray]:
    """By syndrome: what to flip in a word of 2^m bits to reach its anchors within two bits.

    Bits 1 to 2^m - 1 are the code's, numbered as their syndromes; bit 0 is free.
    """
    bit = np.uint64(1) << np.arange(2**m, dtype=np.uint64)
    found = [np.array([0, bit[0]], np.uint64)]
    for s in range(1, 2**m):
        pairs = [bit[i] | bit[i ^ s] for i in range(1, 2**m) if i < i ^ s and i != s]
        found.append(np.array([bit[s], bit[s] | bit[0], *pairs], np.uint64))
    return found


def syndromes(values: np.ndarray, m: int) -> np.ndarray:
    """XOR of the numbers of the set bits."""
    out = np.zeros(len(values), np.int64)
    for k in range(m):
        mask = np.uint64(sum(1 << i for i in range(2**m) if i >> k & 1))
        out |= (np.bitwise_count(values & mask).astype(np.int64) & 1) << k
    return out


def anchors(values: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """All (index of the value, anchor) with the anchor within two bits of the value."""
    table_of, index, found = flips(m), [], []
    syndrome = syndromes(values, m)
    order = np.argsort(syndrome, kind="stable")
    cuts = np.searchsorted(syndrome[order], np.arange(2**m + 1))
    for s, flip in enumerate(table_of):
        rows = order[cuts[s] : cuts[s + 1]]
        found.append((values[rows, None] ^ flip[None, :]).ravel())
        index.append(np.repeat(rows, len(flip)))
    return np.concatenate(index), np.concatenate(found)


def spanning(values: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Pairs of places that join all values linked directly or through others."""
    left, pairs = np.arange(1, len(values)), []
    queue = [0]
    while len(left) or queue:
        if not queue:
            queue, left = [int(left[0])], left[1:]
        at = queue.pop()
        apart = np.bitwise_count(values[left] ^ values[at])
        reached = left[apart <= threshold].tolist()
        left = left[apart > threshold]
        pairs += [(at, x) for x in reached]
        queue += reached
    return pairs


def runs(
    batches: Iterator[pa.RecordBatch], columns: int
) -> Iterator[tuple[np.ndarray, ...]]:
    """Sorted batches as blocks of columns in which no key (the first column) is cut."""
    kept = [np.zeros(0, np.int64)] * columns
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [
            np.concatenate([old, batch.column(i).to_numpy(zero_copy_only=False)])
            for i, old in enumerate(kept)
        ]
        cut = int(np.searchsorted(now[0], now[0][-1], "left"))
        if cut:
            yield tuple(x[:cut] for x in now)
        kept = [x[cut:] for x in now]
    if len(kept[0]):
        yield tuple(kept)


def forests(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Links (a, b) from batches (anchor, fp) sorted by anchor."""
    for anchor, prints in runs(batches, 2):
        values = prints.view(np.uint64)
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        ends = np.r_[starts[1:], len(anchor)]
        many = ends - starts > 1
        a, b = [], []
        for lo, hi in zip(starts[many], ends[many]):
            for x, y in spanning(values[lo:hi], threshold):
                a.append(prints[lo + x])
                b.append(prints[lo + y])
        if a:
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )


def compared(replicas: DataFrame, threshold: int) -> DataFrame:
    """Links between the replicas (anchor, fp) that meet at an anchor."""
    return (
        replicas.repartition(partitions(replicas.sparkSession), "anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(lambda found: forests(found, threshold), "a bigint, b bigint")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )


def near_links(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp), enough to join every component."""
    if threshold not in (1, 2):
        raise ValueError("anchors within two bits serve thresholds of one or two bits")

    def replicate(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(values), 4096):
                part = values[at : at + 4096]
                index, anchor = anchors(part, 6)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(part[index].view(np.int64))],
                    names=["anchor", "fp"],
                )

    # Even parts of the fingerprints, in a number of their own: each becomes 33 rows.
    even = prints.select("fp").repartition(partitions(prints.sparkSession), "fp")
    return compared(even.mapInArrow(replicate, "anchor bigint, fp bigint"), threshold)


def classes(docs: DataFrame, words: int, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, fp and component_id, the smallest id that links reach.

    Nulls: a null text is an empty one (fingerprint zero, linked like any
    other); a row without id gets the smallest id of its component, null if none
    has one. Repeated rows stay. Further columns play no part.
    """
    prints = staged(fingerprints(docs, words, "doc_id"), "prints")
    firsts = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "print-firsts")
    linked = components(near_links(firsts, threshold), "print-components")
    members = firsts.join(linked.withColumnRenamed("node", "fp"), "fp")
    smallest = members.groupBy("root").agg(F.min("first_id").alias("least_id"))
    moved = members.join(smallest, "root").select("fp", "least_id")
    by_print = firsts.join(moved, "fp", "left").select(
        "fp", F.coalesce("least_id", "first_id").alias("component_id")
    )
    # Written first: a join of two plain tables is one that Spark can split at common values.
    return prints.join(staged(by_print, "print-classes"), "fp")


def one_of_each(docs: DataFrame, words: int = 3, threshold: int = THRESHOLD) -> DataFrame:
    """One document of each component of near fingerprints, the one of the smallest id, as it came.

    Nulls: a null text is an empty one, and all texts without words are one
    group; a null id comes behind all others. Of rows that repeat an id and a
    text one stays. Further columns pass through.
    """
    # An id and 128 bits of its text.
    row = F.struct(id_or_last().alias("id"), F.md5(text_of().cast("binary")).alias("md5")).alias("row")
    prints = fingerprints(docs, words, row)
    firsts = staged(prints.groupBy("fp").agg(F.min("row").alias("row")), "print-firsts")
    linked = components(near_links(firsts, threshold), "print-components")
    of_class = firsts.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    kept = of_class.groupBy(F.coalesce("root", "fp").alias("class")).agg(F.min("row").alias("row"))
    # Rows that repeat become one in each task before texts move.
    once = docs.select(row, F.struct("*").alias("whole")).groupBy("row").agg(F.first("whole").alias("whole"))
    return once.join(kept.select("row"), "row").select("whole.*")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and the near-duplicate class of every document."""
    found = classes(table(spark, sf_dir, "documents"), words=3)
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
