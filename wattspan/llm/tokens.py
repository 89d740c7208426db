"""Token counts of a byte-level byte-pair vocabulary, without any token.

A text is cut at special strings (one token each), then into pieces by the
vocabulary's pattern. The symbols of a piece, its bytes at first, form a linked
list; a heap gives the adjacent pair of lowest rank (leftmost of equals), which
becomes one symbol, and its new neighbours join the heap. What counts is the
number of merges: tokens = bytes - merges.

Pieces repeat within a language, so a worker keeps the counts of those it has
met, a bounded number of short ones.

Nulls: a null text is an empty one and has no tokens. Repeated rows get equal
counts. The whole text is counted, whatever its length. Further columns play no
part.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspan.llm.staging import table, text_of, worker_store

# Fixed value: the pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LIMIT = 1024
VOCABULARY = "byte_bpe_50k.json"

#: Pieces whose counts a worker keeps, and the longest of them.
KEPT, KEPT_LENGTH = 400_000, 64
POSITION = (1 << 40) - 1


def printed_bytes() -> dict[str, str]:
    """The character that stands for each byte in a vocabulary file -> the byte's own character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): chr(b) for b in plain} | {chr(256 + k): chr(b) for k, b in enumerate(others)}


def read_vocabulary(path: str) -> tuple[dict[tuple[str, str], int], list[str]]:
    """Rank of every merge, its two sides as characters below 256, and the special strings."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, of = content["model"], printed_bytes()
    if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        raise ValueError("only plain byte-pair vocabularies are counted")
    ranks = {}
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        ranks["".join(map(of.get, a)), "".join(map(of.get, b))] = rank
    return ranks, [x["content"] for x in content["added_tokens"]]


def merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many pairs merge, lowest rank first and leftmost among equals."""
    n, done = len(symbols), 0
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank_of = ranks.get
    found = [rank_of(x) for x in zip(symbols, symbols[1:])]
    heap = [r << 40 | i for i, r in enumerate(found) if r is not None]
    found.append(None)
    heapify(heap)
    while heap:
        top = heappop(heap)
        i = top & POSITION
        if found[i] != top >> 40:
            continue
        j = after[i]
        k = after[j]
        symbols[i] += symbols[j]
        after[i] = k
        found[j] = None
        done += 1
        if k < n:
            before[k] = i
            found[i] = r = rank_of((symbols[i], symbols[k]))
            if r is not None:
                heappush(heap, r << 40 | i)
        else:
            found[i] = None
        h = before[i]
        if h >= 0:
            found[h] = r = rank_of((symbols[h], symbols[i]))
            if r is not None:
                heappush(heap, r << 40 | h)
    return done


def counter(
    ranks: dict[tuple[str, str], int], special: list[str], known: dict[str, int]
) -> Callable[[str], int]:
    """A function from a text to its tokens; ``known`` keeps counts of pieces."""
    pieces = regex.compile(PATTERN).findall
    cut = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))))

    def of_piece(piece: str) -> int:
        raw = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        count = len(raw) - merges(list(raw), ranks)
        if len(piece) <= KEPT_LENGTH:
            if len(known) >= KEPT:
                known.clear()
            known[piece] = count
        return count

    def of_text(text: str) -> int:
        total, parts = 0, [text]
        if special:
            parts = cut.split(text)
            total = len(parts) - 1
        for part in parts:
            for piece in pieces(part):
                total += known.get(piece) or of_piece(piece)
        return total

    return of_text


def count_tokens(path: str, spark: SparkSession, text: Column | str = "text") -> Column:
    """The tokens of a text column by the vocabulary at ``path``, read by the driver.

    What is broadcast is the vocabulary, whose size does not follow the data.
    """
    shipped = spark.sparkContext.broadcast(read_vocabulary(path))

    @F.pandas_udf("bigint")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of_text = counter(*shipped.value, worker_store(f"pieces of {path}"))
        for part in texts:
            yield part.map(of_text).astype("int64")

    return counted(text_of(text))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over the limit."""
    import public_tokenizers

    counted = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.octet_length(text_of()).cast("long").alias("n_bytes"),
        count_tokens(public_tokenizers.path(VOCABULARY), spark).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
