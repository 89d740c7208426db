"""Quality of documents by boosted trees over statistics of their whole texts.

The trees are fitted on a sample of at most about ``SAMPLE`` labelled rows, taken by a
hash of the id, whose statistics are computed on Spark and gathered; every
document is then scored where it lies, without a shuffle. Labels come only from
rows outside the held-out fold; labels, language, source and id are no
statistics.

Nulls: a null text is an empty one, a null label teaches nothing. An empty text
has all statistics 0 and gets a score like any other. Without labels, or with
one class only, every score is the prior. Repeated rows get equal scores.
Further columns play no part; ``keep_good`` returns the columns it got.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspan.llm import boost
from wattspan.llm.staging import held_out, id_or_last, table, text_of

#: Labelled rows to fit on, about; the only bound on what is learned from.
SAMPLE = 20_000
FOLDS, FOLD = 4, 2
ACCEPTED = 0.7

# Groups of bytes whose shares are statistics.
GROUPS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t",
    "line": b"\n",
    "stop": b".",
    "comma": b",",
    "shout": b"!",
    "ask": b"?",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "quote": b"\"'():;-",
    "control": bytes([*range(9), *range(11, 32), 127]),
    "wide": bytes(range(128, 256)),
}
SHARES = np.zeros((256, len(GROUPS)))
for _k, _group in enumerate(GROUPS.values()):
    SHARES[list(_group), _k] = 1.0


def statistics(text: str) -> np.ndarray:
    """Statistics of one text: sizes, shares of byte groups, words, lines and repeats."""
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, w, k = max(1, len(raw)), max(1, len(words)), max(1, len(lines))
    often = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    line_often = Counter(lines)
    lengths = sum(map(len, words))
    return np.concatenate([
        [
            np.log1p(len(raw)),
            np.log1p(len(words)),
            np.log1p(len(lines)),
            lengths / w,
            max(map(len, words), default=0),
            len(often) / w,
            pairs / max(1, len(words) - 1),
            max(often.values(), default=0) / w,
            len(line_often) / k,
            max(line_often.values(), default=0) / k,
            len(words) / k,
            sum(map(str.isupper, words)) / w,
            sum(map(str.isalpha, words)) / w,
            sum(len(x) == 1 for x in words) / w,
        ],
        counts @ SHARES / n,
    ])


def table_of(texts) -> np.ndarray:
    rows = [statistics(x) for x in texts]
    return np.stack(rows) if rows else np.zeros((0, len(statistics(""))))


def statistics_of(docs: DataFrame, *others: str | Column) -> DataFrame:
    """The statistics of every text as an array, beside the named columns."""

    @F.pandas_udf("array<double>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series(list(table_of(texts)))

    return docs.select(*others, found(text_of()).alias("statistics"))


def sample(labels: DataFrame, label: str, folds: int, fold: int, bound: int = SAMPLE) -> DataFrame:
    """About ``bound`` labelled ids outside the fold (all, if there are fewer), by their hash."""
    usable = labels.where(~held_out("doc_id", folds, fold)).select(
        "doc_id", F.col(label).cast("int").alias("label")
    )
    # Labels that repeat count once, so that the share taken is one of different rows.
    usable = usable.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).distinct()
    share = bound / max(1, usable.count())
    place = F.xxhash64(F.lit(11), id_or_last()).cast("double") / 2.0**64 + 0.5
    return usable.where(place < share)


def sampled(docs: DataFrame, few: DataFrame) -> DataFrame:
    """doc_id, label and a text of the sampled ids: one row for an id and label, however many
    rows repeat the id (the first of its texts in their order, if there are several)."""
    # The sample is bounded, so it may be broadcast; an id's rows become one in every task.
    found = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> boost.Trees:
    """Trees fitted on a bounded sample of the labelled documents outside the held-out fold."""
    few = sample(labels, "quality", FOLDS, FOLD, bound)
    rows = statistics_of(sampled(docs, few), "doc_id", "label").toPandas()
    # A fixed order, so that sums, and with them the trees, come out the same.
    rows = rows.assign(_first=[tuple(x) for x in rows["statistics"]]).sort_values(
        ["doc_id", "label", "_first"]
    )
    x = np.stack(list(rows["statistics"])) if len(rows) else table_of([])
    return boost.fit(x, rows["label"].to_numpy())


def scored(docs: DataFrame, model: boost.Trees, *others: str | Column) -> DataFrame:
    """The named columns and the score of every document."""

    @F.pandas_udf("double")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series(boost.score(model, table_of(part)))

    return docs.select(*others, judged(text_of()).alias("score"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model, "doc_id").select(
        "doc_id",
        held_out("doc_id", FOLDS, FOLD).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPTED).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is accepted, with the columns they came with."""
    model = fit(docs, labels)
    whole = F.struct("*").alias("_llm_row")
    found = scored(docs, model, whole)
    return found.where(F.col("score") >= ACCEPTED).select("_llm_row.*")
