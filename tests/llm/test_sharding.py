from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from wattspan.llm import sharding


def laws(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    if rows:
        assert set(counts) <= set(range(shards))
        sizes = [counts.get(s, 0) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


@pytest.mark.parametrize("shards", [1, 7, 16])
def test_counts_slots_and_order(small, shards):
    rows = sharding.interleave(small, shards).collect()
    assert len(rows) == small.count()
    laws(rows, shards)
    # Brute force: sort by a point of each row's share of its source, cut evenly.
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["stratum"]].append(r["share"])
    for shares in by_source.values():
        n = len(shares)
        point = min(shares) * n
        assert 0 <= point <= 1 and sorted(shares) == pytest.approx([(i + point) / n for i in range(n)])
    in_place = [r["share"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert in_place == sorted(in_place)


def test_every_shard_has_the_mixture(spark):
    docs = spark.range(9000).selectExpr(
        "id AS doc_id", "concat('t', id) AS text",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 9) END AS source")
    rows = sharding.interleave(docs, 12).collect()
    laws(rows, 12)
    whole = Counter(r["stratum"] for r in rows)
    held = Counter((r["shard"], r["stratum"]) for r in rows)
    assert all(abs(held[s, source] - n / 12) <= 2 for source, n in whole.items() for s in range(12))


def test_equal_rows_and_many_small_sources(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 100)
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 4)
    docs = spark.range(6000).selectExpr(
        "IF(id % 3 = 0, 7, id) AS doc_id", "IF(id % 3 = 0, 'again', concat('t', id)) AS text",
        "IF(id % 3 = 0, 'hot', concat('s', id)) AS source")
    rows = sharding.interleave(docs, 8).collect()
    assert len(rows) == 6000
    laws(rows, 8)
    hot = Counter(r["shard"] for r in rows if r["doc_id"] == 7 and r["stratum"] == "=hot")
    assert sum(hot.values()) == 2000 and max(hot.values()) - min(hot.values()) < 60
    alone = [r["share"] for r in rows if r["stratum"] != "=hot"]
    assert len(set(alone)) > 3900 and abs(sum(alone) / 4000 - 0.5) < 0.02
    # One counted row while ranks are taken, runs of copies afterwards.
    counted = sharding.described(docs, 7).groupBy("dealt").count()
    assert counted.count() == 4001


def test_same_rows_same_shards(small):
    a = {tuple(r) for r in sharding.interleave(small).collect()}
    b = {tuple(r) for r in sharding.interleave(small.repartition(3)).collect()}
    assert a == b


def test_odd_rows(nasty, nothing):
    rows = sharding.interleave(nasty, 5).collect()
    assert len(rows) == nasty.count()
    laws(rows, 5)
    assert {r["size"] for r in rows if r["doc_id"] == 6} == {1}
    assert sharding.interleave(nothing, 5).count() == 0
