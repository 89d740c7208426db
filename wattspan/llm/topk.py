"""Exact top-k inner products by KD-trees, one tree per shard of the vectors.

A shard's vectors are split at medians of their widest component down to small
leaves; every node keeps the tight box around its vectors. No vector of a box
can score more against a query than the sum over components of the larger of
query * low and query * high. A query walks a tree best box first and stops when
the best box left cannot reach its k-th score. The k-th scores come with it: a
first pass over the query's own shard gives each query k candidates, and their
k-th score prunes every other shard from the start.

Vectors are dealt to shards, and queries to blocks, by hash; the numbers of both
follow the row counts. A task has one shard and one block of queries, so the
stated query set meets all rows in pieces of bounded size. Every task returns k
rows per query at most.

Nulls: vectors that are null or hold null or non-finite components take no part,
nor do rows without an id; vectors of another length than the query's are not
comparable and meet no query of it. Equal scores go to the smaller id. Repeated
ids are one row: the first of their distinct vectors. Fewer than k candidates
give all. Empty tables give an empty result. Further columns play no part.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspan.llm.staging import chunks_for, staged, table

SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
LEAF = 64
K = 5
RESULT = "query_id bigint, vec_id bigint, score bigint"


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as a whole number."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def complete(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    x_finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(vector.isNotNull() & x_finite, F.lit(False))


class Tree:
    """Boxes of a KD-tree over integer vectors, and the order of rows in its leaves."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.low, self.high, self.span, self.children = [], [], [], []
        order = np.lexsort((ids,))
        self.order = order
        stack = [(0, len(ids), -1, 0)]
        while stack:
            lo, hi, parent, side = stack.pop()
            rows = order[lo:hi]
            part = vectors[rows]
            node = len(self.span)
            low, high = part.min(axis=0), part.max(axis=0)
            self.low.append(low)
            self.high.append(high)
            self.span.append((lo, hi))
            self.children.append([-1, -1])
            if parent >= 0:
                self.children[parent][side] = node
            axis = int(np.argmax(high - low))
            if hi - lo > leaf and high[axis] > low[axis]:
                middle = (hi - lo) // 2
                order[lo:hi] = rows[np.argpartition(part[:, axis], middle)]
                stack.append((lo, lo + middle, node, 0))
                stack.append((lo + middle, hi, node, 1))
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.ids, self.vectors = ids[order], vectors[order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The highest score each box allows each query."""
        up, down = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
        return up @ self.high.T.astype(float) + down @ self.low.T.astype(float)

    def search(self, query: np.ndarray, bounds: np.ndarray, k: int, worst: int, own: int):
        """Up to k (score, id) above or equal to ``worst``, best first; ``own`` is passed over."""
        found_score, found_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heappop(queue)
            if -bound < worst:
                break
            left, right = self.children[node]
            if left >= 0:
                for child in (left, right):
                    if bounds[child] >= worst:
                        heappush(queue, (-bounds[child], child))
                continue
            lo, hi = self.span[node]
            score = self.vectors[lo:hi] @ query
            near = np.flatnonzero(score >= worst)
            ids = self.ids[lo:hi][near]
            found_score = np.concatenate([found_score, score[near][ids != own]])
            found_id = np.concatenate([found_id, ids[ids != own]])
            if len(found_id) > k:
                order = np.lexsort((found_id, -found_score))[:k]
                found_score, found_id = found_score[order], found_id[order]
            if len(found_id) == k:
                worst = max(worst, int(found_score.min()))
        return found_score, found_id


LOWEST = -(2**62)


def searched(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The best k of the vectors for every query, no worse than the score it comes with."""
    out = [[], [], []]
    sizes = vectors["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    ids = vectors["vec_id"].to_numpy()
    query_ids, worst = queries["query_id"].to_numpy(), queries["worst"].to_numpy()
    query_sizes = queries["q"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        rows, of = np.flatnonzero(sizes == size), np.flatnonzero(query_sizes == size)
        if not len(of):
            continue
        part = np.array(vectors["v"].take(pa.array(rows)).to_pylist(), np.int64).reshape(-1, size)
        asked = np.array(queries["q"].take(pa.array(of)).to_pylist(), np.int64).reshape(-1, size)
        tree = Tree(ids[rows], part)
        bounds = tree.bounds(asked.astype(float))
        for at, row in enumerate(of):
            score, found = tree.search(asked[at], bounds[at], k, worst[row], query_ids[row])
            out[0].append(np.full(len(found), query_ids[row]))
            out[1].append(found)
            out[2].append(score)
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def best(found: DataFrame, k: int) -> DataFrame:
    """Per query the k best of the rows its tasks returned, as an array, best first."""
    ranked = F.array_sort(
        F.collect_set(F.struct((-F.col("score")).alias("minus"), F.col("vec_id").alias("vec_id")))
    )
    return found.groupBy("query_id").agg(F.slice(ranked, 1, k).alias("best"))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id and score of every query's k best other vectors.

    ``vectors`` has vec_id and v, an array of whole numbers; ``is_query`` picks the queries.
    """
    one = vectors.where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("v").alias("v"))
    one = staged(one, "vectors")
    shards = chunks_for(one.count(), shard_rows)
    dealt = one.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    queries = dealt.where(is_query).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("shard").alias("home")
    )
    blocks = chunks_for(queries.count(), block_queries)
    block = F.pmod(F.xxhash64(F.lit(3), "query_id"), F.lit(blocks)).cast("int")

    def pass_over(asked: DataFrame, shard: Column) -> DataFrame:
        asked = asked.select(
            shard.alias("shard"), block.alias("block"), "query_id", "q", "worst"
        )
        rows = dealt.select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "v"
        )
        return (
            rows.groupBy("shard", "block")
            .cogroup(asked.groupBy("shard", "block"))
            .applyInArrow(lambda left, right: searched(left, right, k), RESULT)
        )

    at_home = queries.withColumn("worst", F.lit(LOWEST))
    first = staged(best(pass_over(at_home, F.col("home")), k), "home-best")
    known = queries.join(first, "query_id", "left").select(
        "query_id",
        "q",
        F.when(F.size("best") >= k, -F.element_at("best", k)["minus"])
        .otherwise(F.lit(LOWEST))
        .alias("worst"),
        F.explode(
            F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home"))
        ).alias("other"),
    )
    others = pass_over(known, F.col("other"))
    own = first.select("query_id", F.explode("best").alias("b")).select(
        "query_id", F.col("b.vec_id").alias("vec_id"), (-F.col("b.minus")).alias("score")
    )
    return best(own.unionByName(others), k).select(
        "query_id", F.posexplode("best").alias("at", "b")
    ).select(
        "query_id",
        (F.col("at") + 1).alias("rank"),
        F.col("b.vec_id").alias("vec_id"),
        (-F.col("b.minus")).alias("score"),
    )


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors for every fiftieth, among all others."""
    vectors = table(spark, sf_dir, "embeddings").where(complete(F.col("embedding")))
    return top_k(
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            whole_numbers(F.col("embedding")).alias("v"),
        ),
        F.col("vec_id") % 50 == 0,
    )


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
