from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.llm import codes


def plain(x, book):
    far = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    return far.argmin(axis=1), far.min(axis=1)


@pytest.mark.parametrize("rows, entries, width, spread", [
    (3000, 64, 4, 200), (500, 64, 3, 2), (400, 5, 1, 3), (300, 1, 2, 9), (800, 200, 4, 30), (200, 64, 2, codes.LARGEST),
])
def test_nearest_entries_are_exact(rows, entries, width, spread):
    # A small spread makes equal entries and many ties; more than 64 entries take several masks.
    rng = np.random.default_rng(rows)
    x, book = (rng.integers(-spread, spread + 1, (n, width)) for n in (rows, entries))
    code, far = codes.assigned(x, book)
    want, least = plain(x, book)
    assert (code == want).all() and (far == least).all()


def test_boxes_leave_few_entries():
    rng = np.random.default_rng(1)
    x, book = (np.floor(rng.normal(0, 32, (n, 4))).astype(np.int64) for n in (2000, 64))
    slices = codes.Slices(book)
    radius = np.sqrt(slices.initial(x)).astype(np.int64) + 1
    held = np.unpackbits(slices.within(x, radius).view(np.uint8)).sum() / len(x)
    assert 1 <= held < 16


def slow(vectors, parts, entries, rounds):
    """Codes and errors by plain search; ``vectors`` is sorted by id."""
    v = np.array(vectors).reshape(len(vectors), parts, -1)
    book = v[:entries].transpose(1, 0, 2).copy()
    for r in range(rounds + 1):
        found = [plain(v[:, p], book[p]) for p in range(parts)]
        if r < rounds:
            for p, (code, _) in enumerate(found):
                for e in np.unique(code):
                    book[p, e] = v[code == e, p].sum(axis=0) // (code == e).sum()
    return np.stack([c for c, _ in found], axis=1), sum(f for _, f in found), book


def test_training_equals_plain_search(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(0, 0.2, (400, 12)).astype(np.float32)
    df = spark.createDataFrame(
        [(i, v.tolist(), i % 3) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>, label int"
    ).repartition(6)
    rows = codes.usable(df, parts=4)
    books = codes.train(rows, parts=4, entries=16)
    want, error, book = slow(np.floor(vectors.astype(float) * 256).astype(np.int64), 4, 16, 2)
    assert (books == book).all()
    got = sorted(tuple(r) for r in codes.coded(rows, books).select("vec_id", "code", "error").collect())
    assert got == [(i, want[i].tolist(), error[i]) for i in range(400)]
    back = codes.coded(rows, books).withColumn("v", codes.decoded(books)).first()
    assert back["v"] == [x for p, e in enumerate(back["code"]) for x in books[p, e].tolist()]


def test_odd_vectors(spark):
    rows = [
        (3, [0.5, 0.25], 1), (1, [0.1, 0.2], None), (1, [0.1, 0.3], None), (1, [0.1, 0.2], None), (2, None, 1),
        (4, [None, 1.0], 1), (5, [math.nan, 1.0], 1), (6, [math.inf, 0.0], 1), (7, [], 1), (None, [1.0, 1.0], 2),
        (8, [1.0, 2.0, 3.0], 1), (9, [1.0, 2.0, 3.0, 4.0], 1), (10, [3e38, -3e38], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns(
        {c: F.lit("own") for c in ("v", "code", "error", "_label", "cell")}
    )
    kept = codes.usable(df, parts=2)
    books = codes.train(kept, parts=2, entries=3)
    found = codes.coded(kept, books)
    assert sorted(str(r["vec_id"]) for r in found.collect()) == ["1", "1", "1", "10", "3", "None"]
    assert books.shape == (2, 3, 1)  # the ids 1, 3 and 10
    nothing = codes.usable(df.where("false"), parts=2)
    assert codes.coded(nothing, codes.train(nothing, parts=2)).count() == 0


def test_query_sums_errors_by_label(spark):
    rows = codes.op12_vector_codes(spark, "/root/testdata/sf0.001").collect()
    labels = dict(map(tuple, spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "label").collect()))
    sums = {}
    for r in rows:
        sums[labels[r["vec_id"]]] = sums.get(labels[r["vec_id"]], 0) + r["error"]
    assert all(r["label_error"] == sums[labels[r["vec_id"]]] and len(r["code"]) == 32 for r in rows)
    assert len(rows) == len(labels)
