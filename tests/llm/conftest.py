from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DATA = "/root/testdata"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside or return.
CLASHING = ["row", "keep", "n_dropped", "fp", "prints", "first", "shard", "length", "start", "score",
            "found", "pos", "h", "id", "whole", "again", "entities", "kind", "statistics", "label"]


@pytest.fixture(scope="session")
def small(spark):
    """The documents of the smallest tables."""
    return spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def nasty(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing columns."""
    line = "a line that several of these documents hold"
    long_text = "\n".join(f"word{i % 7919} other{i % 31} line {i}" for i in range(20_000))
    rows = [
        (None, None, None, None, None),
        (None, f"{line}\nwithout an id", "en", "a", 3),
        (1, "", "en", None, 0),
        (2, " \t\n\x0b\x0c\r ", None, "a", 7),
        (3, long_text, "en", "a", len(long_text)),
        (4, f"{line}\nfourth", "en", "b", 1),
        (4, f"{line}\nfourth", "en", "b", 1),
        (4, f"{line}\nanother text of the same id", "en", "b", 1),
        (5, f"  {line.upper()}\t\n\nfifth <|endoftext|> ñandú straße 😀", "es", "b", None),
        (6, None, "de", "c", 0),
        (7, "x" * 50_000, "de", "c", 50_000),
        (8, f"{line}\n{line}\n{line}", "en", "c", 1),
    ]
    out = spark.createDataFrame(rows, COLUMNS)
    return out.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.fixture(scope="session")
def nothing(nasty):
    return nasty.where("false")
