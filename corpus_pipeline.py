"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattspan.llm import decontaminate, lines, packing, quality, simhash
from wattspan.llm.staging import staged, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels of these documents, accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one holds; none is dropped as a whole."""
    return lines.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints: three-word shingles, two bits."""
    return simhash.one_of_each(docs, words=3, threshold=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bin, offset and capacity of every piece of the documents that are left."""
    return packing.pack_texts(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

# The classifier, the fingerprints and the packing have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before kept, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
