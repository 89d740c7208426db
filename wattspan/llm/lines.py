"""Lines that several documents share, kept in the first of them only.

Every line of at least ``min_length`` code points (after folding) becomes a row
of hash, document and position; texts stay where they are. Rows are
range-partitioned by hash with a secondary sort by document and position, and a
running minimum streams over each hash: a row whose document is not the first is
a repeat. The result is a bitmap per document that drops anything, one bit per
line (1: keep), in 64-bit words up to the last word that drops a line; a
document without a bitmap, and every line behind it, is kept.

A line found in a third of all documents would be one run of rows. So the first
pass ranges over (hash, slice), where the slice comes from the document and the
position: every slice drops its repeats and passes on the lines of its first
document only. The second pass, over the hash alone, sees at most one document
per slice.

Nulls: a null text is one empty line; a null id counts as one document behind
all others. Rows that repeat an id and a text share a bitmap; rows that repeat
an id with another text belong to the same document and have bitmaps of their
own. An empty table gives an empty result. Further columns pass through; one that
is named like a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wattspan.llm.staging import id_or_last, staged, table, text_of

# White space that is stripped, and letters that are folded.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MIN_LENGTH = 10
#: Parts that the rows of one line are dealt to.
SLICES = 64
#: Lines of a document that fall into the same slice.
SLICE_LINES = 1024
ROW, DOC = "_llm_row", "_llm_doc"


def folded(line: Column) -> Column:
    """A line stripped of white space at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACE))
    plain = F.octet_length(bare) == F.length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def identified(docs: DataFrame) -> DataFrame:
    """Documents with the id they are compared by and a hash that tells rows apart."""
    return docs.withColumns({DOC: id_or_last(), ROW: F.xxhash64(id_or_last(), text_of())})


def line_rows(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Hash (128 bits), document, row and position of every line that is long enough."""
    lines = identified(docs).select(
        DOC, ROW, F.posexplode(split_lines(text_of())).alias("pos", "line")
    )
    keyed = lines.select(DOC, ROW, "pos", folded(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_length).select(
        F.xxhash64("key").alias("h"),
        F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
        DOC,
        ROW,
        "pos",
    )


def first_seen(rows: DataFrame, keys: list[str], ranged: list[str]) -> DataFrame:
    """Rows with the first document of their key, by a running minimum over sorted rows."""
    run = (
        Window.partitionBy(*keys)
        .orderBy(DOC, "pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.repartitionByRange(*ranged).withColumn("_first", F.min(DOC).over(run))


def repeated_lines(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Document, row and position of every line that an earlier document holds."""
    found = staged(line_rows(docs, min_length), "lines")
    sliced = found.withColumn(
        "slice", F.pmod(F.xxhash64(DOC, F.floor(F.col("pos") / SLICE_LINES)), F.lit(SLICES))
    )
    local = staged(first_seen(sliced, ["h", "h2", "slice"], ["h", "slice"]), "slices")
    here = local.where(F.col("_first") < F.col(DOC))
    passed = local.where(F.col("_first") == F.col(DOC)).drop("_first", "slice")
    there = first_seen(passed, ["h", "h2"], ["h"]).where(F.col("_first") < F.col(DOC))
    return here.select(DOC, ROW, "pos").union(there.select(DOC, ROW, "pos"))


def keep_bitmaps(repeats: DataFrame) -> DataFrame:
    """Row and bitmap of every document that loses a line, and how many it loses.

    Repeated rows of the input give each position several times; bits are or-ed.
    """
    words = repeats.groupBy(DOC, ROW, F.floor(F.col("pos") / 64).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")
    )
    by_row = words.groupBy(DOC, ROW).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("_drop"),
        F.max("word").alias("_last"),
        F.sum(F.bit_count("bits")).alias("n_dropped"),
    )
    kept = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_last")),
        lambda w: F.bitwise_not(F.coalesce(F.try_element_at("_drop", w), F.lit(0).cast("long"))),
    )
    return by_row.select(DOC, ROW, kept.alias("keep"), "n_dropped")


def with_bitmaps(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Documents with ``keep`` (null: keep all lines) and ``n_dropped``."""
    bitmaps = keep_bitmaps(repeated_lines(docs, min_length))
    docs = identified(docs.drop("keep", "n_dropped"))
    joined = docs.join(bitmaps.hint("shuffle_hash"), [DOC, ROW], "left").drop(DOC, ROW)
    return joined.withColumn("n_dropped", F.coalesce("n_dropped", F.lit(0).cast("long")))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines whose bit is set, joined again."""

    def stays(_, i):
        word = F.get(keep, F.floor(i / 64).cast("int"))
        return word.isNull() | (F.getbit(word, i % 64) == 1)

    return F.when(keep.isNull(), text).otherwise(
        F.array_join(F.filter(split_lines(text), stays), "\n")
    )


def deduplicated(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Documents with their kept lines as text and, if they have it, its length as n_chars.

    A document that keeps no line stays, with an empty text.
    """
    rest = F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")]).alias("_llm_rest")
    found = with_bitmaps(docs.select("doc_id", "text", rest), min_length).withColumn(
        "text", kept_text(F.col("text"), F.col("keep"))
    )
    length = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("_llm_rest.n_chars"))

    def column(name: str) -> Column:
        if name == "n_chars":
            return length.cast(docs.schema[name].dataType).alias(name)
        return F.col(name if name in ("doc_id", "text") else f"_llm_rest.`{name}`")

    return found.select(*map(column, docs.columns))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, dropped lines and the digest of the rest, for every document."""
    docs = with_bitmaps(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = text_of()
    return docs.select(
        "doc_id",
        F.size(split_lines(text)).cast("long").alias("n_lines"),
        "n_dropped",
        F.sha2(kept_text(text, F.col("keep")), 256).alias("kept_sha256"),
    )


OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, p - 1 AS pos, parts[p] AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
       unnest(range(1, len(parts) + 1)) AS u(p)
),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{UPPER}', '{UPPER.lower()}') AS key
  FROM lines
),
firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= {MIN_LENGTH} GROUP BY key
),
judged AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(f.first_doc < k.doc_id, false) AS dropped
  FROM keyed k LEFT JOIN firsts f ON k.key = f.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), ''))
         AS kept_sha256
FROM judged GROUP BY doc_id
"""
