from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.llm import importance


def runs(text, longest):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(f.encode()) for f in found]


def slow(docs, target, longest=1, buckets=10_000, least=20, percent=10):
    """(doc_id, n_features, weight, score, drawn) by plain counting."""
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for count, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for crc in runs(text, longest)[1]:
                count[crc % buckets] += 1
    S, T = int(s.sum()), int(t.sum())
    gain = [math.floor(1000 * math.log((int(b) + 1) * (S + buckets) / ((int(a) + 1) * (T + buckets)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text in docs:
        n, crcs = runs(text, longest)
        weight = sum(gain[c % buckets] for c in crcs) // len(crcs) if crcs else 0
        name = "" if doc_id is None else str(doc_id)
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, n, len(crcs), weight, score))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = able[: percent * len(able) // 100]
    return [x[:1] + x[2:] for x in out], [(x[0], x[4], i + 1) for i, x in enumerate(drawn)]


def check(got, docs, target, **options):
    rows, drawn = slow(docs, target, **options)
    def key(x):
        return (x[0] is None, x)
    plain = [tuple(r)[:4] for r in got]
    assert sorted(plain, key=str) == sorted(rows, key=str)
    found = sorted((r["rank"], r["doc_id"], r["score"]) for r in got if r["rank"] is not None)
    assert [(i, s, r) for r, i, s in found] == drawn


@pytest.mark.parametrize("longest, known", [(1, 200_000), (2, 200_000), (3, 5)])
def test_equals_plain_counting(spark, monkeypatch, small, longest, known):
    monkeypatch.setattr(importance.Dictionary.__init__, "__defaults__", (known,))
    docs = [tuple(r) for r in small.select("doc_id", "text").collect()]
    target = [r[0] for r in small.where("doc_id % 7 = 0").select("text").collect()]
    wanted = small.where("doc_id % 7 = 0")
    got = importance.resampled(small.repartition(5), wanted, longest, buckets=997).collect()
    check(got, docs, target, longest=longest, buckets=997)


def test_the_dictionary_learns_and_is_bounded():
    words = importance.Dictionary(known=1500)
    rng = random.Random(1)
    for _ in range(20):
        texts = [" ".join(f"w{rng.randint(0, 3000)}é" for _ in range(400)).encode() for _ in range(5)]
        texts += [b"", b"x" * 1000]
        counts, ends, found = importance.bucketed(texts, words, 1, 10_000)
        want = [[c % 10_000 for c in runs(t.decode(), 1)[1]] for t in texts]
        assert counts.tolist() == [len(w) for w in want]
        assert [x.tolist() for x in np.split(found, ends[:-1])] == want
    assert 0 < words.held <= 1500


def test_crc_of_joined_words():
    rng = random.Random(2)
    parts = [(rng.randbytes(rng.randint(0, 300)), rng.randbytes(rng.randint(0, 70_000))) for _ in range(50)]
    numbers = [np.array(x) for x in zip(*((zlib.crc32(a), len(a), zlib.crc32(b), len(b)) for a, b in parts))]
    crc, size = importance.Crc.run(numbers[0], numbers[1], numbers[2].astype(np.uint32), numbers[3])
    assert crc.tolist() == [zlib.crc32(a + b" " + b) for a, b in parts]
    assert size.tolist() == [len(a) + 1 + len(b) for a, b in parts]


def test_odd_rows_and_empty_tables(spark, nasty, nothing):
    target = nasty.where("doc_id = 8")
    rows = [tuple(r) for r in nasty.select("doc_id", "text").collect()]
    got = importance.resampled(nasty, target, least=1, percent=50).collect()
    check(got, rows, [r[0] for r in target.select("text").collect()], least=1, percent=50)
    assert importance.resampled(nothing, target).count() == 0
    check(importance.resampled(nasty, nothing).collect(), rows, [])


def test_equal_rows_are_ranked_in_many_partitions(spark):
    text = " ".join(["same"] * 30)
    docs = spark.range(0, 3000, 1, 3).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit(text).alias("text")
    )
    found = importance.resampled(docs, docs.limit(1), percent=100)
    ranks = [r["rank"] for r in found.orderBy(F.desc("score"), "doc_id").collect()]
    assert sorted(ranks) == list(range(1, 3001))
    rows = found.select(F.spark_partition_id().alias("p"), "doc_id").where("doc_id = 7").groupBy("p").count().collect()
    assert max(r["count"] for r in rows) < 1000  # a third of the rows is one id of one score
