from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.llm import decontaminate as d


def words(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def planted(spark):
    """Items, and documents with whole, substituted, cut and no passages of them."""
    rng = random.Random(4)
    items = {i: words(rng, n) for i, n in enumerate([40, 15, 200, 9, 30, 3])}
    docs, dirty = [], set()
    for k in range(120):
        body = words(rng, rng.randint(0, 150))
        if k % 3 == 0:
            item = items[k // 3 % 5]
            passage = list(item)
            if k % 2:  # a tenth of the words is substituted
                for _ in range(len(passage) // 10):
                    passage[rng.randrange(len(passage))] = "changed"
            if k % 4 == 0 and len(item) > 30:
                passage = passage[5:30]
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() if k % 5 == 0 else w for w in passage]
            dirty.add(k)
        docs.append((k, ", ".join(body) if k % 7 == 0 else " ".join(body)))
    table = spark.createDataFrame([(i, " ".join(w) + ".") for i, w in items.items()], "item_id bigint, text string")
    return spark.createDataFrame(docs, "doc_id bigint, text string"), table, dirty


def slow(docs, items):
    """Every (document, item) that agree long enough on some diagonal, whatever windows see."""
    out = set()
    for i, text in docs:
        a = d.words_of(text or "")
        for item, t in items:
            b = d.words_of(t or "")
            for shift in range(-len(b) + 1, len(a)):
                lo, hi = max(0, shift), min(len(a), shift + len(b))
                equal = a[lo:hi] == b[lo - shift : hi - shift]
                if len(b) >= d.MIN_RUN:
                    x, y = d.best_stretch(equal)
                    good = y - x >= d.MIN_RUN
                else:
                    good = d.LEAST_ITEM <= len(b) == len(equal) and equal.sum() * 5 >= 4 * len(b)
                if good:
                    out.add((i, item))
    return out


def test_masks_see_every_accepted_stretch():
    """The highest sum of a stretch that no mask sees, by its length: below zero from 13 words on.

    Goes through all stretches, of any arrangement, by the last ten words they end in.
    """
    masks = [(len(m), int(m, 2)) for m in d.MASKS]
    width = max(n for n, _ in masks)
    best = {1: 1}  # a leading 1 would be needed for shorter ones; zeros before the first word see nothing
    for length in range(2, 400):
        after = {}
        for bits, total in best.items():
            for match in (0, 1):
                now = (bits << 1 | match) & (1 << width) - 1
                if any(length >= n and now & m == m for n, m in masks):
                    continue
                after[now] = max(after.get(now, -(10**6)), total + (1 if match else -d.PENALTY))
        best = after
        if length >= d.MIN_RUN:
            assert max((t for b, t in best.items() if b & 1), default=-1) < 0, length


@pytest.mark.parametrize("n", range(6, 21))
def test_substitutions_at_any_places(n):
    """Every placement of the allowed substitutions leaves a window of the item that is hit."""
    words = np.arange(1, n + 1, dtype=np.uint32) * 7919
    wanted = [(number, int(p), int(h)) for number, at, found in d.item_windows(words) for p, h in zip(at, found)]
    used = sorted({number for number, _, _ in wanted})
    for places in itertools.combinations(range(n), n // 5):
        if n >= d.MIN_RUN and {0, n - 1} & set(places):
            continue  # a stretch runs from a match to a match
        doc = words.copy()
        doc[list(places)] = 5
        own = {(k, int(p), int(h)) for k in used for p, h in enumerate(d.window_hashes(doc, d.EVERY_MASK[k], k))}
        assert own.intersection(wanted), places


def test_every_fifth_word_substituted(spark):
    rng = random.Random(9)
    items = [(i, words(rng, n)) for i, n in enumerate([50, 100, 200, 6, 8, 12])]
    docs = []
    for i, item in items:
        for phase in range(5):
            passage = [f"x{k}" if k % 5 == phase and len(item) // 5 > k // 5 else w for k, w in enumerate(item)]
            docs.append((10 * i + phase, " ".join(words(rng, 30) + passage + words(rng, 30))))
    found = d.overlaps(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id bigint, text string"),
    ).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(k, k // 10) for k, _ in docs}


def test_planted_passages_and_brute_force(planted):
    docs, items, dirty = planted
    got = d.overlaps(docs, items).collect()
    assert {r["doc_id"] for r in got} == dirty
    rows = [[tuple(r) for r in t.collect()] for t in (docs, items)]
    assert {(r["doc_id"], r["item_id"]) for r in got} == slow(*rows)
    assert all(r["matches"] >= 0.8 * r["length"] for r in got)
    assert {r["doc_id"] for r in d.clean(docs, items).collect()} == set(range(120)) - dirty


def test_benchmark_in_the_given_documents(spark, small):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    texts = [r["text"] for r in items.collect()]
    holding = {r["doc_id"] for r in small.collect() if any(t in r["text"] for t in texts)}
    assert holding and {r["doc_id"] for r in d.overlaps(small, items).collect()} == holding


def test_seed_hides_substitutions():
    a = np.arange(100, 140, dtype=np.uint32)
    b = a.copy()
    b[[2]] = 7  # the place that 1101111 ignores
    assert d.window_hashes(a, d.MASKS[0], 0)[0] == d.window_hashes(b, d.MASKS[0], 0)[0]
    assert d.window_hashes(a, "111", 4)[0] != d.window_hashes(b, "111", 4)[0]


def test_best_stretch():
    assert d.best_stretch(np.array([True] * 5 + [False] + [True] * 7)) == (0, 13)
    assert d.best_stretch(np.array([True] * 3 + [False] + [True] * 7)) == (0, 11)
    assert d.best_stretch(np.array([False, True, False, False] + [True] * 6 + [False])) == (4, 10)
    assert d.best_stretch(np.array([False, False])) == (0, 0)


def test_odd_rows(spark, nasty, nothing):
    items = spark.createDataFrame(
        [(1, "word5 other5 line 5 word6 other6 line 6 word7 other7 line 7 word8 other8"), (2, None), (3, ""),
         (None, "a line that several of these documents hold"), (4, "tiny item")], "item_id bigint, text string"
    ).withColumn("row", F.lit(1))
    got = {(r["doc_id"], r["item_id"]) for r in d.overlaps(nasty, items).collect()}
    assert got == {(3, 1), (None, None), (4, None), (5, None), (8, None)}
    out = d.clean(nasty, items)
    assert out.dtypes == nasty.dtypes
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [1, 2, 6, 7, None]
    assert d.overlaps(nothing, items).count() == 0 and d.clean(nothing, items).count() == 0
    assert d.overlaps(nasty, items.where("false")).count() == 0
    assert d.clean(nasty, items.where("false")).count() == nasty.count()


def test_passage_in_very_many_documents(spark, planted):
    _, items, _ = planted
    passage = items.where("item_id = 0").first()["text"]
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("own "), "id", F.lit(" " + passage)).alias("text"))
    assert d.overlaps(docs, items).count() == 2000
