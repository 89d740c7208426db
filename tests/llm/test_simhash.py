from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wattspan.llm import simhash
from wattspan.llm.components import components


def slow_print(text, n):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else (
        [b" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def slow_classes(prints, linked):
    """Smallest place reachable from each place."""
    root = list(range(len(prints)))

    def of(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if linked(prints[i], prints[j]):
                a, b = sorted((of(i), of(j)))
                root[b] = a
    return [of(i) for i in range(len(prints))]


@pytest.mark.parametrize("m", [5, 6])
def test_words_within_two_bits_share_an_anchor(m):
    rng = np.random.default_rng(m)
    bits = 2**m
    values = rng.integers(0, 2**63, 200, dtype=np.uint64) >> np.uint64(64 - bits if bits < 64 else 0)
    values[0] = 0
    other = values.copy()
    for k in range(2):
        other ^= np.uint64(1) << rng.integers(0, bits, 200, dtype=np.uint64)
    index, anchor = simhash.anchors(np.r_[values, other], m)
    of = [set(anchor[index == i].tolist()) for i in range(400)]
    assert all(of[i] & of[i + 200] for i in range(200))
    assert max(map(len, of)) == bits // 2 + 1
    assert all(int(a ^ v).bit_count() <= 2 for i, v in enumerate(values.tolist()) for a in of[i])


def test_links_join_what_brute_force_joins(spark):
    rng = random.Random(1)
    prints = {0}
    for _ in range(60):
        at = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):
            prints.add(at)
            for _ in range(rng.randint(1, 3)):
                at ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    got = {r["node"]: r["root"] for r in components(simhash.near_links(df)).collect()}
    want = slow_classes(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    classes = {}
    for x, c in zip(signed, want):
        classes.setdefault(c, set()).add(x)
    for members in classes.values():
        assert {got.get(x, x) for x in members} == {min(members)}


def test_long_chain_is_one_component(spark):
    links = spark.range(1, 400).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    got = components(links.union(links).union(spark.sql("SELECT 7L, 7L"))).collect()
    assert len(got) == 400 and {r["root"] for r in got} == {0}
    assert components(links.where("false")).count() == 0


def check(docs, words=3):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    prints = [slow_print(t, words) for _, t in rows]
    classes = slow_classes(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), c in zip(rows, classes):
        least.setdefault(c, []).append(i)
    least = {c: min((x for x in ids if x is not None), default=None) for c, ids in least.items()}
    want = sorted(((i, np.uint64(p).view(np.int64).item(), least[c])
                   for (i, _), p, c in zip(rows, prints, classes)), key=str)
    got = simhash.classes(docs, words).select("doc_id", "fp", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_equals_brute_force(small):
    check(small)


def test_odd_rows(nasty, nothing):
    check(nasty)
    assert simhash.classes(nothing, 3).count() == 0


def test_one_of_each_group_equals_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for k in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(600)]
        rows.append((100 * k, " ".join(words)))
        for c in range(1, k % 4 + 1):  # copies with one word or two changed, and exact ones
            copy = list(words)
            for _ in range(c % 3):
                copy[rng.randrange(600)] = "changed"
            rows.append((100 * k + c, " ".join(copy)))
    rows += [(3, "\n"), (50, rows[0][1])]
    classes = slow_classes([slow_print(t, 3) for _, t in rows], lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), c in zip(rows, classes):
        least[c] = min(i, least.get(c, i))
    assert 40 < len(least) < len(rows) - 30
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect()) == sorted(least.values())


def test_one_of_odd_rows(nasty, nothing):
    out = simhash.one_of_each(nasty)
    assert out.dtypes == nasty.dtypes
    texts = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(texts) == len(set(texts))
    # All texts without words are one group, and its first document stays.
    assert [i for i, t in texts if not (t or "").strip()] == [1]
    assert simhash.one_of_each(nothing).count() == 0


def test_rows_that_repeat_are_one(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "one text of many").otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("text"),
        F.create_map(F.lit("k"), F.col("id")).alias("row"),
    )
    out = simhash.one_of_each(rows)
    assert out.dtypes == rows.dtypes and out.where("doc_id = 7").count() == 1


def test_a_very_large_star_is_one_component(spark):
    links = spark.range(1, 200_000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    got = components(links)
    assert got.count() == 200_000 and got.where("root <> 0").count() == 0
