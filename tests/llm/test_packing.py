from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from wattspan.llm import packing

CAPACITIES = (16, 32, 64)


def laws(rows, capacities):
    bins = defaultdict(list)
    for r in rows:
        bins[r["bin_id"], r["capacity"]].append((r["offset"], r["length"]))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), parts in bins.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert capacity == min(c for c in capacities if c >= end)


def test_best_fit_fills_and_shrinks():
    lengths = sorted([60, 30, 30, 20, 14, 10, 6, 4, 2, 2, 1])
    bins, offsets, capacity = packing.best_fit(lengths, CAPACITIES)
    used = np.bincount(bins, lengths)
    assert all(used[b] <= c for b, c in zip(bins, capacity))
    assert used.sum() / sum({b: c for b, c in zip(bins, capacity)}.values()) > 0.9


@pytest.mark.parametrize("seed", range(5))
def test_any_lengths(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.randint(1, 64) for _ in range(rng.randint(0, 400)))
    bins, offsets, capacity = packing.best_fit(lengths, CAPACITIES)
    rows = [dict(bin_id=b, offset=o, length=n, capacity=c) for b, o, n, c in zip(bins, offsets, lengths, capacity)]
    laws(rows, CAPACITIES)
    if len(lengths) > 200:
        assert sum(lengths) / sum({b: c for b, c in zip(bins, capacity)}.values()) > 0.95


def test_whole_texts_round_trip(spark, small, nasty):
    for docs in (small, nasty.where("doc_id IS NULL OR doc_id NOT IN (4)")):
        packed = packing.pack_texts(docs, (256, 1024, 4096)).cache()
        rows = packed.collect()
        laws(rows, (256, 1024, 4096))
        whole = defaultdict(int)
        for r in rows:
            whole[r["doc_id"]] += r["length"]
        want = defaultdict(int)
        for r in docs.collect():
            want[r["doc_id"]] += len((r["text"] or "").encode()) + 1
        assert whole == want
    content = {r["bin_id"]: bytes(r["content"]) for r in packing.sequences(small, packing.pack_texts(small)).collect()}
    texts = {r["doc_id"]: (r["text"] or "").encode() + b"\0" for r in small.collect()}
    parts = defaultdict(dict)
    for r in packing.pack_texts(small).collect():
        parts[r["doc_id"]][r["start"]] = content[r["bin_id"]][r["offset"] : r["offset"] + r["length"]]
    assert {i: b"".join(p[k] for k in sorted(p)) for i, p in parts.items()} == texts


def test_repeated_rows_and_nothing(nasty, nothing):
    rows = packing.pack_texts(nasty).collect()
    laws(rows, packing.CAPACITIES)
    assert sum(r["length"] for r in rows) == sum(len((r["text"] or "").encode()) + 1 for r in nasty.collect())
    assert packing.pack_texts(nothing).count() == 0


def test_many_groups(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('x', cast(id % 97 AS int)) AS text")
    text = packing.text_of()
    length = packing.F.octet_length(text).cast("long") + 1
    found = packing.pieces(docs, length, 256, packing.F.xxhash64("doc_id").alias("dealt"))
    rows = packing.pack(found, (64, 128, 256), group=2500).collect()
    assert len(rows) == 20_000 and len({r["bin_id"] >> 32 for r in rows}) == 8
    laws(rows, (64, 128, 256))


def test_a_text_that_a_third_of_the_rows_repeat_fills_no_group(spark, monkeypatch):
    docs = spark.range(9000).selectExpr(
        "IF(id % 3 = 0, 7, id) AS doc_id", "IF(id % 3 = 0, 'again', repeat('x', cast(id % 97 AS int))) AS text")
    text = packing.text_of()
    length = packing.F.octet_length(text).cast("long") + 1
    monkeypatch.setattr(packing, "COPIES", 16)
    found = packing.pieces(docs, length, 256, packing.F.xxhash64("doc_id", text).alias("dealt"))
    rows = packing.pack(found, (64, 128, 256), group=500).collect()
    laws(rows, (64, 128, 256))
    groups = defaultdict(int)
    for r in rows:
        groups[r["bin_id"] >> 32] += 1
    assert sum(groups.values()) == 9000 and len(groups) == 18 and max(groups.values()) < 800
