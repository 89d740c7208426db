"""Benchmark passages in documents, found through spaced seeds and verified word by word.

Words are lower-cased runs without white space or ASCII punctuation. A spaced
seed is a fixed mask over neighbouring words; the hash of a window covers only
the words the mask selects, so a substituted word at an ignored place does not
hide a passage. Windows of the benchmark and of the documents are joined on
their hashes; around each hit the two word sequences are laid over each other,
and the longest stretch between two matches of which at least 80 % match (a match
counts 1, a substitution -4, and the sum is not negative) must be ``MIN_RUN``
words long. A shorter item must lie in the document as a whole, with 80 % of its words.

The masks are complete: no stretch of 13 words or more that is accepted, wherever its
substitutions lie, is without a window that some mask sees (a test goes through
all of them). An item of 6 to 12 words with s substitutions allowed is cut into s + 1
parts, one of which must be whole; the first words of each part are its windows.

Documents are read once. A filter over the benchmark's hashes tells which windows
can meet one; it is broadcast, with some 24 bits for each of the benchmark's
windows and 128 MB at most, beyond which more windows pass by chance; those fall out
at the join. Hits that lie near each other are kept as one segment of words with
some context, so neither texts nor windows are shuffled, and a passage found in very
many documents costs each of them one segment. Between segments more than
96 words hit nothing, whose sum is far below zero: they are passages of their own.

Nulls and limits: a null text has no words and is clean; items without an id are
searched as well; items of fewer than six words are not searched, as chance would
find them everywhere. Repeated rows give one result. Empty
tables give an empty result. Further columns play no part, and ``clean`` returns
those it got.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattspan.llm.staging import id_or_last, staged, table, text_of

# The masks (1: the word counts), and those of parts of short items.
MASKS = ("1101111", "1100010111", "11111001", "100101111")
PART_MASKS = ("111", "1111")
EVERY_MASK = MASKS + PART_MASKS
BREAKS = bytes(b for b in range(128) if not chr(b).isalnum())

MIN_RUN, LEAST_ITEM = 13, 6
PENALTY = 4
#: Words kept on both sides of a hit.
CONTEXT = 48
#: Bits of a filter over hashes, as a power of two: by default 8 MB. That of the benchmark
#: follows its windows between 2^20 and 2^30.
FILTER_BITS = 26

_TO_SPACE = bytes(32 if b in BREAKS else b for b in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> np.ndarray:
    """A 32-bit number for each word."""
    found = text.lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()
    return np.fromiter(map(crc32, found), np.uint32, len(found))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def window_hashes(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The hash of the selected words of every window of the mask."""
    count = len(words) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    wide = words.astype(np.uint64)
    out = np.full(count, number + 1, np.uint64)
    for at, bit in enumerate(mask):
        if bit == "1":
            out *= _FACTOR
            out += wide[at : at + count]
            out ^= out >> np.uint64(32)
    return mixed(out)


def filter_places(hashes: np.ndarray, size: int = FILTER_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the filter for every hash."""
    low = np.uint64(2**size - 1)
    return hashes & low, hashes >> np.uint64(64 - size)


def item_windows(words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of the mask, places and hashes of the windows by which an item is found."""
    n = len(words)
    if n >= MIN_RUN:
        for number, mask in enumerate(MASKS):
            h = window_hashes(words, mask, number)
            yield number, np.arange(len(h)), h
    elif n >= LEAST_ITEM:
        parts = n // (PENALTY + 1) + 1
        begins = [n * k // parts for k in range(parts + 1)]
        for lo, hi in zip(begins, begins[1:]):
            number = len(MASKS) + (hi - lo >= len(PART_MASKS[1]))
            yield number, np.array([lo]), window_hashes(words[lo:hi], EVERY_MASK[number], number)[:1]


def test_windows(items: DataFrame) -> DataFrame:
    """Hash, mask, item and place of every window of the benchmark."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for item, text in zip(*(c.to_pylist() for c in batch.columns)):
                for number, at, h in item_windows(words_of(text)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(h.view(np.int64)),
                            pa.array([number] * len(h), pa.int32()),
                            pa.array([item] * len(h), pa.int64()),
                            pa.array(at.astype(np.int32)),
                        ],
                        names=["h", "mask", "item", "item_pos"],
                    )

    return items.select("item", "text").mapInArrow(batches, "h bigint, mask int, item bigint, item_pos int")


def filter_of(windows: DataFrame, size: int = FILTER_BITS) -> np.ndarray:
    """The filter's bits in 64-bit words; at most 2^size / 64 rows reach the driver."""
    low = F.col("h").bitwiseAND(F.lit(2**size - 1))
    high = F.shiftrightunsigned("h", 64 - size)
    rows = (
        windows.select(F.explode(F.array(low, high)).alias("bit"))
        .groupBy(F.floor(F.col("bit") / 64).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS int))")).alias("bits"))
        .toPandas()
    )
    out = np.zeros(2**size // 64, np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def candidates(words: np.ndarray, bits: np.ndarray, masks=range(len(EVERY_MASK))) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows of some masks that the filter lets through, by place."""
    places, hashes, size = [], [], (64 * len(bits)).bit_length() - 1
    for number in masks:
        h = window_hashes(words, EVERY_MASK[number], number)
        one, two = filter_places(h, size)
        passed = np.flatnonzero(bits[one >> np.uint64(6)] >> (one & np.uint64(63)) & np.uint64(1))
        two = two[passed]
        passed = passed[
            (bits[two >> np.uint64(6)] >> (two & np.uint64(63)) & np.uint64(1)).astype(bool)
        ]
        places.append(passed)
        hashes.append(h[passed])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, hashed = np.concatenate(places), np.concatenate(hashes)
    order = np.argsort(place, kind="stable")
    return place[order], hashed[order]


SEGMENT = (
    "row bigint, doc_id bigint, start int, words array<int>, pos array<int>, hashes array<bigint>"
)


def segments(docs: DataFrame, bits: np.ndarray, masks=range(len(EVERY_MASK))) -> DataFrame:
    """Stretches of documents that the filter lets through, with their windows' hashes."""
    shipped = docs.sparkSession.sparkContext.broadcast(bits)
    longest = max(map(len, EVERY_MASK))

    def of_text(row, doc_id, text):
        words = words_of(text)
        place, hashed = candidates(words, shipped.value, masks)
        if not len(place):
            return
        cuts = np.flatnonzero(np.diff(place) > 2 * CONTEXT) + 1
        for at, h in zip(np.split(place, cuts), np.split(hashed, cuts)):
            start = max(0, int(at[0]) - CONTEXT)
            part = words[start : int(at[-1]) + longest + CONTEXT]
            yield row, doc_id, start, part.view(np.int32), at.astype(np.int32), h.view(np.int64)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            rows = [x for one in zip(*(c.to_pylist() for c in batch.columns)) for x in of_text(*one)]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()),
                         pa.list_(pa.int32()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)],
                    names=["row", "doc_id", "start", "words", "pos", "hashes"],
                )

    return docs.select(
        F.xxhash64(id_or_last(), text_of()).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
    ).mapInArrow(batches, SEGMENT)


def best_stretch(equal: np.ndarray) -> tuple[int, int]:
    """Begin and end of the longest stretch from a match to a match that sums to 0 or more."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -PENALTY))])
    ends = np.flatnonzero(equal)
    if not len(ends):
        return 0, 0
    # The lowest sum before any match up to here never rises, so the first place
    # that is low enough for an end can be searched for.
    lowest = np.minimum.accumulate(np.where(equal, total[:-1], np.iinfo(np.int64).max))
    begins = np.searchsorted(-lowest, -total[ends + 1], "left")
    at = int(np.argmax(ends + 1 - begins))
    return int(begins[at]), int(ends[at]) + 1


FOUND = "doc_id bigint, row bigint, item bigint, start int, length int, matches int"


def verified(pairs: DataFrame) -> DataFrame:
    """Pairs whose words agree over a long enough stretch, with the stretch."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            out = []
            for doc_id, row, start, words, item, item_words, shift in zip(
                *(c.to_pylist() for c in batch.columns)
            ):
                # Word k of the item lies over word k + shift of the document.
                first = max(start, shift)
                last = min(start + len(words), shift + len(item_words))
                doc_part = np.array(words[first - start : last - start])
                equal = doc_part == np.array(item_words[first - shift : last - shift])
                if len(item_words) >= MIN_RUN:
                    lo, hi = best_stretch(equal)
                    good = hi - lo >= MIN_RUN
                else:
                    lo, hi = 0, len(equal)
                    good = hi == len(item_words) and equal.sum() * (PENALTY + 1) >= PENALTY * hi
                if good:
                    out.append((doc_id, row, item, first + lo, hi - lo, int(equal[lo:hi].sum())))
            if out:
                kinds = [pa.int64()] * 3 + [pa.int32()] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)],
                    names=["doc_id", "row", "item", "start", "length", "matches"],
                )

    columns = ["doc_id", "row", "start", "words", "item", "item_words", "shift"]
    return pairs.select(*columns).mapInArrow(batches, FOUND)


def item_words(items: DataFrame) -> DataFrame:
    @F.pandas_udf("array<int>")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: words_of(x).view(np.int32))

    return items.select("item", found("text").alias("item_words"))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, row, item, start, length and matches (in words) of the longest stretch of every
    document and item that overlap."""
    # Items are known by number inside: equal texts are one item, and ids may be missing.
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")
    ).withColumn("item", F.xxhash64("text"))
    texts = items.dropDuplicates(["item"])
    windows = staged(test_windows(texts), "test-windows")
    # One row for each of the masks that the items need.
    masks = {r["mask"]: r["count"] for r in windows.groupBy("mask").count().collect()}
    size = min(30, max(20, (24 * sum(masks.values())).bit_length()))
    found = staged(segments(docs, filter_of(windows, size), sorted(masks)), "segments")
    hits = found.select(
        "row", "start", F.explode(F.arrays_zip("pos", F.col("hashes").alias("h"))).alias("hit")
    ).select("row", "start", F.col("hit.pos").alias("pos"), F.col("hit.h").alias("h"))
    laid = (
        hits.join(windows.drop("mask"), "h")
        .select("row", "start", "item", (F.col("pos") - F.col("item_pos")).alias("shift"))
        .distinct()
    )
    pairs = laid.join(found.drop("pos", "hashes"), ["row", "start"]).join(item_words(texts), "item")
    best = (
        verified(pairs)
        .groupBy("doc_id", "row", "item")
        .agg(F.max(F.struct("length", "matches", (-F.col("start")).alias("before"))).alias("b"))
    )
    return best.join(items.select("item", "item_id").distinct(), "item").select(
        "doc_id",
        "row",
        "item_id",
        (-F.col("b.before")).alias("start"),
        F.col("b.length").alias("length"),
        F.col("b.matches").alias("matches"),
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a passage of a benchmark item, with the passage."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return overlaps(docs, items).select("doc_id", "item_id", "start", "length", "matches")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any such passage, with the columns they came with."""
    found = overlaps(docs.select("doc_id", "text"), benchmark).select("row").distinct()
    keyed = docs.select(F.xxhash64(id_or_last(), text_of()).alias("row"), F.struct("*").alias("in_"))
    return keyed.join(found, "row", "left_anti").select("in_.*")
