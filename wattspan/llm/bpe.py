"""Byte-pair encoding by a segment tree of ranks, and its decoding.

A text is cut at special strings (one id each), then into pieces by the
vocabulary's pattern. The leaves of a piece's tree are the ranks of its adjacent
pairs, each with its place; an inner node holds the smaller of its two. So the
root is the lowest rank and, among equals, its leftmost place. That pair becomes
one symbol: the leaf of its right half is emptied, the leaves of the new symbol
and of the one before it get new ranks, and each change climbs one path to the
root. A piece is done when the root is empty. n bytes cost n log n steps, however
long the piece is. Short pieces of a block are merged side by side, one numpy step
for a merge in each of them; long ones have a tree to themselves.

Pieces repeat within a language, so a worker keeps the ids of those it has met: a
bounded number of short ones, the older half of which gives way to new ones.

Decoding joins the bytes of the ids; bytes that are no UTF-8 become U+FFFD.

Nulls: a null text is an empty one and has no ids; a null array of ids decodes to
an empty text, a null or unknown id to nothing. Repeated rows get equal ids. The
whole text is encoded, whatever its length. Columns of the input stay, in their
order; a new column takes the place of an equally named one.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspan.llm.staging import table, text_of, worker_store
from wattspan.llm.tokens import PATTERN, VOCABULARY, printed_bytes

#: Pieces whose ids a worker keeps, and the most bytes of one that is kept.
KEPT, KEPT_LENGTH = 300_000, 64
#: Characters of texts that are encoded at once; a longer text is a block of its own.
BLOCK = 1 << 20
#: A leaf is rank * 2^40 + place; an empty one is above all others.
PLACE, EMPTY = 40, 1 << 62

# Fixed value: the same pattern for texts of ASCII only, where it needs no Unicode classes.
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"


@dataclass(frozen=True)
class Vocabulary:
    """``pairs`` has the rank of two adjacent ids (left * 2^32 + right), ``merged`` the id that
    each rank makes, ``of_byte`` the ids of single bytes, ``raw`` the bytes of every id."""

    pairs: dict[int, int]
    merged: list[int]
    of_byte: list[int]
    raw: dict[int, bytes]
    special: dict[str, int]


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, of = content["model"], printed_bytes()
    if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        raise ValueError("only plain byte-pair vocabularies are encoded")
    ids = model["vocab"]
    raw = {i: "".join(map(of.get, token)).encode("latin-1") for token, i in ids.items()}
    special = {x["content"]: x["id"] for x in content["added_tokens"]}
    raw |= {i: token.encode() for token, i in special.items()}
    pairs, merged = {}, []
    for rank, pair in enumerate(model["merges"]):
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        pairs[ids[a] << 32 | ids[b]] = rank
        merged.append(ids[a + b])
    single = {token: i for i, token in raw.items() if len(token) == 1}
    return Vocabulary(pairs, merged, [single[bytes([b])] for b in range(256)], raw, special)


def encode_piece(piece: bytes, words: Vocabulary) -> list[int]:
    """The ids of one piece: always the pair of lowest rank, leftmost among equals."""
    symbols = [words.of_byte[b] for b in piece]
    n = len(symbols)
    if n < 2:
        return symbols
    rank_of, merged = words.pairs.get, words.merged
    size = 1 << (n - 2).bit_length()
    tree = [EMPTY] * (2 * size)
    for i in range(n - 1):
        rank = rank_of(symbols[i] << 32 | symbols[i + 1])
        if rank is not None:
            tree[size + i] = rank << PLACE | i
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(place: int, value: int) -> None:
        node = size + place
        tree[node] = value
        while node > 1:
            other = tree[node ^ 1]
            if other < value:
                value = other
            node >>= 1
            if tree[node] == value:
                return
            tree[node] = value

    def pair(i: int, j: int) -> int:
        rank = rank_of(symbols[i] << 32 | symbols[j])
        return EMPTY if rank is None else rank << PLACE | i

    while tree[1] != EMPTY:
        root = tree[1]
        i = root & (1 << PLACE) - 1
        j = after[i]
        symbols[i] = merged[root >> PLACE]
        after[i] = k = after[j]
        if k < n:
            put(j, EMPTY)
            before[k] = i
            put(i, pair(i, k))
        else:
            put(i, EMPTY)
        h = before[i]
        if h >= 0:
            put(h, pair(h, i))
    out, i = [], 0
    while i < n:
        out.append(symbols[i])
        i = after[i]
    return out


class Merger:
    """Merges short pieces side by side: a row has the symbols and the tree of one piece."""

    def __init__(self, words: Vocabulary):
        known = sorted(words.pairs.items())
        self.keys = np.array([k for k, _ in known] + [EMPTY], np.int64)
        self.ranks = np.array([r for _, r in known] + [0], np.int64)
        self.merged = np.array(words.merged, np.int64)
        self.of_byte = np.array([*words.of_byte, -1], np.int64)

    def leaf(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank and place of pairs; empty where there is no such pair."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        there = (self.keys[at] == key) & (right >= 0) & (left >= 0)
        return np.where(there, self.ranks[at] << PLACE | place, EMPTY)

    def merge(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of pieces of 2 to ``width`` + 1 bytes, ``width`` a power of two."""
        rows = len(pieces)
        padded = np.full((rows, width + 2), 256, np.int64)
        sizes = np.fromiter(map(len, pieces), np.int64, rows)
        inside = np.arange(width + 2) < sizes[:, None]
        padded[inside] = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = self.of_byte[padded]
        tree = np.full((rows, 2 * width), EMPTY, np.int64)
        tree[:, width:] = self.leaf(symbols[:, :width], symbols[:, 1 : width + 1], np.arange(width))
        level = width // 2
        while level:
            below = tree[:, 2 * level : 4 * level]
            tree[:, level : 2 * level] = np.minimum(below[:, ::2], below[:, 1::2])
            level //= 2
        # The place before the first is kept behind the last.
        after = np.tile(np.arange(1, width + 3), (rows, 1))
        before = np.tile(np.arange(-1, width + 1), (rows, 1))
        active = np.flatnonzero(tree[:, 1] != EMPTY)
        while len(active):
            root = tree[active, 1]
            i = root & (1 << PLACE) - 1
            j = after[active, i]
            k, h = after[active, j], before[active, i]
            symbols[active, i] = self.merged[root >> PLACE]
            symbols[active, j] = -1
            after[active, i] = k
            before[active, np.minimum(k, width + 1)] = i
            right = np.where(k <= width, symbols[active, np.minimum(k, width + 1)], -1)
            gone = j < width
            tree[active[gone], width + j[gone]] = EMPTY
            tree[active, width + i] = self.leaf(symbols[active, i], right, i)
            has = h >= 0
            tree[active[has], width + h[has]] = self.leaf(
                symbols[active[has], h[has]], symbols[active[has], i[has]], h[has]
            )
            nodes = [width + i, width + np.minimum(j, width - 1), width + np.maximum(h, 0)]
            step = width
            while step > 1:
                nodes = [n >> 1 for n in nodes]
                for n in nodes:
                    tree[active, n] = np.minimum(tree[active, 2 * n], tree[active, 2 * n + 1])
                step >>= 1
            active = active[tree[active, 1] != EMPTY]
        left = symbols >= 0
        flat = symbols[left].astype(np.int32).tobytes()
        ends = np.cumsum(left.sum(axis=1)).tolist()
        return [flat[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]


class Pieces(dict):
    """The ids of pieces as the bytes of int32 numbers, two generations of them."""

    def __init__(self, words: Vocabulary):
        super().__init__()
        self.words, self.merger, self.old = words, Merger(words), {}

    def encode(self, piece: str) -> bytes:
        return array("i", encode_piece(piece.encode("utf-8", "surrogatepass"), self.words)).tobytes()

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece) or self.encode(piece)
        if len(piece) <= KEPT_LENGTH:
            self[piece] = found
        return found

    def learn(self, pieces: set[str]) -> None:
        """Encode what is not known yet of the pieces, short ones side by side."""
        if len(self) > KEPT // 2:
            self.old.clear()
            self.old.update(self)
            self.clear()
        by_width: dict[int, tuple[list[str], list[bytes]]] = {}
        for piece in pieces:
            if piece in self or piece in self.old:
                continue
            raw = piece.encode("utf-8", "surrogatepass")
            if 1 < len(raw) <= KEPT_LENGTH:
                names, raws = by_width.setdefault(1 << (len(raw) - 2).bit_length(), ([], []))
                names.append(piece)
                raws.append(raw)
        for width, (names, raws) in by_width.items():
            for at in range(0, len(raws), BLOCK // width // 16):
                part = slice(at, at + BLOCK // width // 16)
                self.update(zip(names[part], self.merger.merge(raws[part], width)))


def encoder(pieces: Pieces) -> Callable[[list[str]], Iterator[bytes]]:
    """A function from texts to their ids, the bytes of int32 numbers."""
    every, plain = regex.compile(PATTERN).findall, re.compile(PLAIN_PATTERN).findall
    special, ids_of = pieces.words.special, pieces.__getitem__
    longest_first = sorted(special, key=len, reverse=True)
    cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split

    def parts(text: str) -> list[list[str] | bytes]:
        """The pieces between special strings, and the ids of these."""
        if not any(s in text for s in longest_first):
            return [plain(text) if text.isascii() else every(text)]
        return [
            array("i", [special[part]]).tobytes() if at % 2 else every(part)
            for at, part in enumerate(cut(text))
        ]

    def of_texts(texts: list[str]) -> Iterator[bytes]:
        at = 0
        while at < len(texts):
            block, held = [], 0
            while at < len(texts) and (not block or held + len(texts[at]) <= BLOCK):
                block.append(parts(texts[at]))
                held += len(texts[at])
                at += 1
            seen: set[str] = set()
            for part in chain.from_iterable(block):
                if isinstance(part, list):
                    seen.update(part)
            pieces.learn(seen)
            for text in block:
                yield b"".join(
                    part if isinstance(part, bytes) else b"".join(map(ids_of, part)) for part in text
                )

    return of_texts


def of_worker(path: str, words: Vocabulary) -> Callable[[list[str]], Iterator[bytes]]:
    """The encoder of this worker, with the pieces it has met."""
    kept = worker_store(f"ids of pieces of {path}")
    if "pieces" not in kept:
        kept["pieces"] = Pieces(words)
    return encoder(kept["pieces"])


def id_arrays(found: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))


def text_of_ids(ids: list[int], raw: dict[int, bytes]) -> str:
    return b"".join(map(raw.__getitem__, filter(raw.__contains__, ids))).decode("utf-8", "replace")


def encode(path: str, spark: SparkSession, text: Column | str = "text") -> Column:
    """The ids of a text column by the vocabulary at ``path``, an array of int.

    The driver reads the vocabulary and broadcasts it; its size does not follow the data.
    """
    shipped = spark.sparkContext.broadcast(read_vocabulary(path))

    @F.arrow_udf("array<int>")
    def encoded(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of_texts = of_worker(path, shipped.value)
        for part in texts:
            yield id_arrays(list(of_texts(part.to_pylist())))

    return encoded(text_of(text)).alias("ids")


def decode(path: str, spark: SparkSession, ids: Column | str = "ids") -> Column:
    """The text of an array of ids by the vocabulary at ``path``."""
    shipped = spark.sparkContext.broadcast(read_vocabulary(path).raw)

    @F.arrow_udf("string")
    def decoded(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in arrays:
            yield pa.array([text_of_ids(ids.as_py() or [], shipped.value) for ids in part], pa.string())

    return decoded(ids if isinstance(ids, Column) else F.col(ids)).alias("decoded")


def encoded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The rows with the ids of their text (``ids``) and what these decode to (``decoded``)."""
    shipped = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    # Both in one worker, so that ids do not travel to another one and back.
    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def both(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of_texts = of_worker(path, shipped.value)
        for part in texts:
            found = list(of_texts(part.to_pylist()))
            back = [text_of_ids(np.frombuffer(x, np.int32).tolist(), shipped.value.raw) for x in found]
            yield pa.StructArray.from_arrays([id_arrays(found), pa.array(back, pa.string())], ["ids", "decoded"])

    return docs.withColumn("_both", both(text_of(text))).withColumns(
        {"ids": F.col("_both.ids"), "decoded": F.col("_both.decoded")}
    ).drop("_both")


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of their decoding."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded(docs, public_tokenizers.path(VOCABULARY)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
