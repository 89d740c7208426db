from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from wattspan.llm import lines

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans(lines.UPPER, lines.UPPER.lower())
LAST = 2**63 - 1


def kept(rows):
    """(id, text) -> kept text of every row, the plain way."""
    def keys(text):
        return [x.strip(SPACE).translate(LOWER) for x in (text or "").split("\n")]

    holders = defaultdict(set)
    for i, text in rows:
        for k in keys(text):
            holders[k].add(LAST if i is None else i)
    out = []
    for i, text in rows:
        own = LAST if i is None else i
        parts = zip((text or "").split("\n"), keys(text))
        stay = [x for x, k in parts if len(k) < 10 or min(holders[k]) == own]
        out.append((i, len((text or "").split("\n")), len((text or "").split("\n")) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def found(docs):
    text = lines.kept_text(F.coalesce("text", F.lit("")), F.col("keep"))
    n = F.size(lines.split_lines(F.coalesce("text", F.lit(""))))
    rows = lines.with_bitmaps(docs).select("doc_id", n, "n_dropped", text).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_equals_brute_force(small):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    assert found(small) == kept(rows)


def test_odd_rows(nasty, nothing):
    rows = [tuple(r) for r in nasty.select("doc_id", "text").collect()]
    assert found(nasty) == kept(rows)
    assert found(nothing) == []


def test_columns_pass_through(nasty):
    out = lines.deduplicated(nasty)
    assert out.columns == nasty.columns and out.dtypes == nasty.dtypes
    rows = out.collect()
    assert len(rows) == nasty.count()
    assert all(r["keep"] == "own keep" and r["whole"] == "own whole" for r in rows)


def test_line_in_many_documents_and_many_lines_in_one(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") == 5, F.repeat(F.lit("one very common line\n"), 5000))
        .otherwise(F.concat(F.lit("one very common line\nown line of "), "id", F.lit("!!!!!!!!!!")))
        .alias("text"),
    )
    dropped = lines.with_bitmaps(docs).groupBy("n_dropped").count().collect()
    assert {r["n_dropped"]: r["count"] for r in dropped} == {0: 1, 1: 2998, 5000: 1}


def test_main_path_is_native(small):
    plan = lines.with_bitmaps(small)._jdf.queryExecution().optimizedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_registered_query(spark):
    got = lines.op1_line_dedup(spark, "/root/testdata/sf0.001").collect()
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = kept([tuple(r) for r in source.collect()])
    digest = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in want}
    assert {r[0]: tuple(r[1:4]) for r in got} == digest
