"""Product codes of vectors: codebooks per part, and exact nearest entries by bitmasks.

Vectors are cut into equal parts, each with a codebook of its own. For every
component the entries of a codebook lie sorted, and the mask after each of them has
the bits of all entries up to there. A part looks for its nearest entry like this:
the entries beside it in every component give an initial radius, the least of their
distances. In each component the entries within the radius are a range of the
sorted ones, hence the difference of two prefix masks; the AND over the components
has exactly the entries of the box, and no entry outside the box can be nearer.
Only those are measured, so the result is exact, ties included. Codebooks of more
than 64 entries are searched 64 at a time, with the best distance so far as radius.

A round sums the parts of every entry: partitions send one row per part, entry
and component, so only codebooks (parts x entries numbers) come together at the
driver and go back with the code.

Nulls: vectors that are null or hold null or non-finite components take no part,
nor do those that cannot be cut into the parts, or whose length is not that of the
first (the one with the smallest id). A null id is the last one. Repeated ids are
rows of their own; the first entries take one vector (the smallest) per id. Fewer
ids than entries give smaller codebooks. Whole components beyond 2^27 count as
2^27, so that no sum overflows. An empty table gives an empty result. Columns
other than id, vector and label play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspan.llm.staging import id_or_last, staged, table
from wattspan.llm.topk import complete, whole_numbers

PARTS, ENTRIES, ROUNDS = 16, 64, 2
LARGEST = 2**27
#: Parts that are looked up at once.
BLOCK = 1 << 15
FAR = np.int64(2**62)


class Slices:
    """Up to 64 entries of a codebook, sorted by each component, with prefix masks."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        none = np.zeros((1, entries.shape[1]), np.uint64)
        self.prefix = np.concatenate([none, np.bitwise_or.accumulate(bits, axis=0)])

    def distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        apart = x - self.entries[entry]
        return (apart * apart).sum(axis=1)

    def initial(self, x: np.ndarray) -> np.ndarray:
        """The least distance to an entry beside ``x`` in some component."""
        best = np.full(len(x), FAR)
        for j in range(x.shape[1]):
            at = np.searchsorted(self.sorted[:, j], x[:, j])
            for beside in (at - 1, at):
                beside = np.clip(beside, 0, len(self.entries) - 1)
                best = np.minimum(best, self.distance(x, self.order[beside, j]))
        return best

    def within(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """A mask per row: the entries no farther than the radius in any component."""
        mask = np.full(len(x), ~np.uint64(0))
        for j in range(x.shape[1]):
            low = np.searchsorted(self.sorted[:, j], x[:, j] - radius, "left")
            high = np.searchsorted(self.sorted[:, j], x[:, j] + radius, "right")
            mask &= self.prefix[high, j] ^ self.prefix[low, j]
        return mask

    def nearest(self, x: np.ndarray, best: np.ndarray, code: np.ndarray, first: int) -> None:
        """Improve ``best`` (squared distances) and ``code`` (entries from ``first``) in place."""
        bound = np.minimum(best, self.initial(x))
        # One more than the root, against rounding; a larger box only has more candidates.
        mask = self.within(x, np.sqrt(bound.astype(float)).astype(np.int64) + 1)
        bits = np.unpackbits(mask.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, entry = np.nonzero(bits)
        apart = self.distance(x[row], entry)
        least = np.full(len(x), FAR)
        np.minimum.at(least, row, apart)
        # Rows and entries are in order, so the first that reaches the least is the lowest entry.
        at = np.flatnonzero(apart == least[row])
        rows, firsts = np.unique(row[at], return_index=True)
        better = least[rows] < best[rows]
        rows, firsts = rows[better], firsts[better]
        best[rows] = least[rows]
        code[rows] = first + entry[at[firsts]]


def assigned(x: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every row and its squared distance; ties go to the lower entry."""
    code, best = np.zeros(len(x), np.int64), np.full(len(x), FAR)
    for first in range(0, len(codebook), 64):
        slices = Slices(codebook[first : first + 64])
        for at in range(0, len(x), BLOCK):
            part = slice(at, at + BLOCK)
            slices.nearest(x[part], best[part], code[part], first)
    return code, best


def rows_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def usable(
    vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, label: str = "label"
) -> DataFrame:
    """vec_id, label and v (whole numbers) of the vectors that take part, as a written table."""
    kept = vectors.where(complete(F.col(vector)) & (F.size(vector) > 0) & (F.size(vector) % parts == 0))
    bounded = F.transform(
        whole_numbers(F.col(vector)), lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), x))
    )
    found = staged(
        kept.select("vec_id", F.col(label).alias("label"), bounded.alias("v")), "whole-vectors"
    )
    first = found.agg(F.min(F.struct(id_or_last("vec_id"), F.col("v"))).alias("first"))
    return found.where(F.size("v") == first.select(F.size("first.v")).scalar())


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """(part, entry, component): the parts of the vectors with the smallest ids."""
    ids = rows.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries)
    # As many rows as entries.
    few = F.broadcast(ids.withColumnRenamed("vec_id", "_id"))
    found = (
        rows.join(few, F.col("vec_id").eqNullSafe(F.col("_id")))
        .groupBy("vec_id").agg(F.min("v").alias("v"))
        .orderBy(F.asc_nulls_last("vec_id"))
        .collect()
    )
    if not found:
        return np.zeros((parts, 0, 0), np.int64)
    start = np.array([r["v"] for r in found], np.int64)
    return start.reshape(len(start), parts, -1).transpose(1, 0, 2)


def improved(rows: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Every entry replaced by the floored mean of the parts nearest to it; unused ones stay."""
    parts, entries, width = codebooks.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            v = rows_of(batch.column(0), parts * width).reshape(-1, parts, width)
            for p in range(parts):
                code, _ = assigned(v[:, p], codebooks[p])
                np.add.at(total[p], code, v[:, p])
                count[p] += np.bincount(code, minlength=entries)
        p, e = np.nonzero(count)
        cell = np.repeat(p * entries + e, width) * width + np.tile(np.arange(width), len(p))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell), pa.array(total[p, e].ravel()), pa.array(np.repeat(count[p, e], width))],
            names=["cell", "total", "n"],
        )

    sums = rows.select("v").mapInArrow(summed, "cell bigint, total bigint, n bigint")
    out = codebooks.copy().ravel()
    for row in sums.groupBy("cell").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[row["cell"]] = row["total"] // row["n"]
    return out.reshape(codebooks.shape)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) after some rounds over all rows."""
    found = first_codebooks(rows, parts, entries)
    for _ in range(rounds if found.size else 0):
        found = improved(rows, found)
    return found


def coded(rows: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """vec_id, label, the code of every part (array) and the squared error of every vector."""
    parts, _, width = codebooks.shape

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            v = rows_of(batch.column(2), parts * width).reshape(-1, parts, width)
            code, error = np.zeros((len(v), parts), np.int32), np.zeros(len(v), np.int64)
            for p in range(parts):
                nearest, apart = assigned(v[:, p], codebooks[p])
                code[:, p] = nearest
                error += apart
            ends = pa.array(np.arange(0, parts * len(v) + 1, parts, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(code.ravel())),
                 pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code array<int>, error bigint"
    return rows.select("vec_id", "label", "v").mapInArrow(batches, schema)


def decoded(codebooks: np.ndarray, code: str = "code") -> Column:
    """The vector that a code stands for, whole numbers."""

    @F.arrow_udf("array<bigint>")
    def looked_up(codes: pa.Array) -> pa.Array:
        parts, _, width = codebooks.shape
        v = codebooks[np.arange(parts), rows_of(codes, parts)].reshape(-1)
        ends = pa.array(np.arange(0, len(v) + 1, parts * width, dtype=np.int32))
        return pa.ListArray.from_arrays(ends, pa.array(v))

    return looked_up(code)


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def hexadecimal(code: Column) -> Column:
    """Two hexadecimal digits for every number of an array, joined."""
    return F.array_join(F.transform(code, lambda x: F.lpad(F.lower(F.hex(x)), 2, "0")), "")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, the error of its label, and the codebooks' digest."""
    rows = usable(table(spark, sf_dir, "embeddings"))
    codebooks = train(rows)
    found = staged(coded(rows, codebooks), "codes")
    # One row a label; whether it is broadcast is decided by its measured size.
    per_label = found.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return found.join(per_label, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id",
        hexadecimal(F.col("code")).alias("code"),
        "error",
        "label_error",
        F.lit(digest(codebooks)).alias("codebooks_sha256"),
    )


def _nearest_sql(codebook: str) -> str:
    return f"""
  SELECT row_no, part, arg_min(entry, far * 64 + entry) AS entry, min(far) AS far FROM (
    SELECT row_no, part, entry, sum((x - y) * (x - y))::BIGINT AS far
    FROM pieces JOIN {codebook} USING (part, pos) GROUP BY row_no, part, entry
  ) GROUP BY row_no, part"""


def _moved_sql(codebook: str, nearest: str) -> str:
    return f"""
  SELECT part, entry, pos, coalesce(mean, y) AS y FROM {codebook} LEFT JOIN (
    SELECT part, entry, pos, floor(sum(x)::DOUBLE / count(*))::BIGINT AS mean
    FROM {nearest} JOIN pieces USING (row_no, part) GROUP BY part, entry, pos
  ) USING (part, entry, pos)"""


OP12_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row_no, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
long AS (SELECT row_no, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS place, len(v) // 16 AS width FROM kept),
pieces AS (SELECT row_no, place // width AS part, place % width AS pos, x FROM long),
start AS (SELECT part, row_no - 1 AS entry, pos, x AS y FROM pieces WHERE row_no <= 64),
near_a AS ({_nearest_sql("start")}),
book_a AS ({_moved_sql("start", "near_a")}),
near_b AS ({_nearest_sql("book_a")}),
book_b AS ({_moved_sql("book_a", "near_b")}),
near_c AS ({_nearest_sql("book_b")}),
codes AS (
  SELECT row_no, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error
  FROM near_c GROUP BY row_no
),
digest AS (
  SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book_b
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (row_no), digest
"""
