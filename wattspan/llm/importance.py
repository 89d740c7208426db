"""Importance resampling towards a target: hashed word features, gains, a Gumbel draw.

Words lie between delimiters. An Aho-Corasick automaton holds words with a
delimiter at either end; each carries its CRC and its length. One scan over a
block of texts emits these payloads in the order of the words. The CRC of a run of
words follows from the payloads of its neighbours (a CRC is linear: appending n
bytes multiplies by a fixed matrix), so runs are never built as strings. CRC
modulo the number of buckets is a feature's bucket, for counting and for scoring.

The dictionary of a worker starts empty and learns from what it scans, up to
``KNOWN`` words: words that the automaton does not hold are found as gaps between
what it emits, get their CRC from their bytes, and join the dictionary before a
later block. Results do not depend on what it holds.

Every text is scanned once: its buckets are kept as numbers, counted per
partition and summed (one row per bucket and partition is shuffled), and scored by
the gains of all buckets. Only tables of one row per bucket, per whole score and per
partition reach the driver; none grows with the rows. The draw needs the order of
the best rows: they are range-partitioned by score, id and place, so that no
score and no repeated row is hot, and ranks are places within a partition plus the
rows of those before.

Nulls: a null text is an empty one without features and with weight 0; a null id
counts as an empty one and comes after all others of its score. Repeated rows are
rows of their own with equal scores and different ranks. Words and texts may be of
any length. An empty table gives an empty result; without target texts all counts
of the target are 0. Further columns play no part.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspan.llm.staging import id_or_last, partitions, staged, table, text_of, worker_store

BUCKETS, WORDS_IN_A_RUN = 10_000, 1
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024

#: Words a worker's dictionary holds, and the longest of them.
KNOWN, KNOWN_LENGTH = 200_000, 64
#: Bytes of texts scanned at once; a longer text is a block of its own.
BLOCK = 4 << 20

# Bytes of words after lower-casing; all others are delimiters.
WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
SPACE = 32
FOLDED = bytes(b if b in WORD_BYTES else SPACE for b in (bytes([x]).lower()[0] for x in range(256)))


def _appending() -> list[np.ndarray]:
    """By k: what 2^k appended zero bytes make of a CRC, as one table of 256 for each of its bytes."""
    columns = [0xEDB88320] + [1 << (i - 1) for i in range(1, 32)]

    def times(matrix: Sequence[int], value: int) -> int:
        out = 0
        for i in range(32):
            if value >> i & 1:
                out ^= matrix[i]
        return out

    for _ in range(3):  # one bit, two, four, eight
        columns = [times(columns, c) for c in columns]
    found = []
    for _ in range(31):
        tables = [[times(columns, b << 8 * at) for b in range(256)] for at in range(4)]
        found.append(np.array(tables, np.uint32))
        columns = [times(columns, c) for c in columns]
    return found


class Crc:
    """CRC of joined strings from the CRCs and lengths of their parts."""

    tables: list[np.ndarray] = []
    space = np.uint32(zlib.crc32(b" "))

    @classmethod
    def appended(cls, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        """What the CRCs become once ``size`` bytes follow, without these bytes' own CRC."""
        if not cls.tables:
            cls.tables = _appending()
        crc, size = crc.astype(np.uint32), size.copy()
        for step in cls.tables:
            odd = np.flatnonzero(size & 1)
            c = crc[odd]
            crc[odd] = step[0][c & 255] ^ step[1][c >> 8 & 255] ^ step[2][c >> 16 & 255] ^ step[3][c >> 24]
            size >>= 1
            if not size.any():
                break
        return crc

    @classmethod
    def run(cls, crc: np.ndarray, size: np.ndarray, word: np.ndarray, length: np.ndarray):
        """CRC and size of runs (``crc``, ``size``), each followed by a space and a word."""
        spaced = cls.appended(np.full(len(word), cls.space), length) ^ word
        return cls.appended(crc, length + 1) ^ spaced, size + length + 1


class Dictionary:
    """An automaton of delimited words whose payload is length * 2^32 + CRC."""

    def __init__(self, known: int = KNOWN):
        self.automaton, self.ready = ahocorasick.Automaton(), False
        self.new: dict[bytes, int] = {}
        self.known, self.held = known, 0

    def learn(self) -> None:
        """Take in the new words, once they are many enough to be worth a new automaton."""
        if len(self.new) < max(500, self.held // 4):
            return
        for word, payload in self.new.items():
            if self.held >= self.known:
                break
            self.automaton.add_word(f" {word.decode('latin-1')} ", payload)
            self.held += 1
        self.new.clear()
        self.automaton.make_automaton()
        self.ready = True

    def scan(self, folded: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and payload of every word; ``folded`` begins and ends with a delimiter."""
        delimits = np.frombuffer(folded, np.uint8) == SPACE
        starts = np.flatnonzero(delimits[:-1] & ~delimits[1:]) + 1
        ends = np.flatnonzero(~delimits[:-1] & delimits[1:]) + 1
        payload = np.full(len(starts), -1, np.int64)
        if self.ready:
            # Bytes as characters of their own, so that places are those of the bytes.
            emitted = np.fromiter(
                chain.from_iterable(self.automaton.iter(folded.decode("latin-1"))), np.int64
            ).reshape(-1, 2)
            payload[np.searchsorted(ends, emitted[:, 0])] = emitted[:, 1]
        full = self.held >= self.known
        for at in np.flatnonzero(payload < 0).tolist():
            word = folded[starts[at] : ends[at]]
            known = self.new.get(word)
            if known is None:
                known = len(word) << 32 | zlib.crc32(word)
                if len(word) <= KNOWN_LENGTH and not full:
                    self.new[word] = known
            payload[at] = known
        self.learn()
        return starts, payload


def blocks_of(texts: list[bytes], size: int = BLOCK) -> Iterator[list[bytes]]:
    block, held = [], 0
    for text in texts:
        if block and held + len(text) > size:
            yield block
            block, held = [], 0
        block.append(text)
        held += len(text) + 1
    if block:
        yield block


def bucketed(texts: list[bytes], words: Dictionary, longest: int, buckets: int):
    """Words, and the buckets of all runs of up to ``longest`` words, of every text."""
    folded = b" ".join([b"", *texts, b""]).translate(FOLDED)
    begins = np.cumsum([1, *(len(x) + 1 for x in texts)])
    starts, payload = words.scan(folded)
    text_of_word = np.searchsorted(begins, starts, "right") - 1
    word, length = (payload & 0xFFFFFFFF).astype(np.uint32), payload >> 32
    crc, size = word, length
    owners, found = [text_of_word], [crc % np.uint32(buckets)]
    for more in range(1, longest):
        if len(crc) < 2:
            break
        crc, size = Crc.run(crc[:-1], size[:-1], word[more:], length[more:])
        same = text_of_word[:-more] == text_of_word[more:]
        owners.append(text_of_word[:-more][same])
        found.append((crc % np.uint32(buckets))[same])
    n_words = np.bincount(text_of_word, minlength=len(texts))
    owner, found = np.concatenate(owners), np.concatenate(found)
    if longest > 1:
        order = np.argsort(owner, kind="stable")
        owner, found = owner[order], found[order]
    ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
    return n_words, ends, found


def features(
    docs: DataFrame, longest: int = WORDS_IN_A_RUN, buckets: int = BUCKETS, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The kept columns, ``n_words``, ``n_features`` and ``buckets`` (32-bit numbers) of every text."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_store("words of importance").setdefault("words", Dictionary())
        for batch in rows:
            n_words, n_features, found = [], [], []
            for block in blocks_of(batch.column(batch.num_columns - 1).to_pylist()):
                counts, ends, numbers = bucketed(block, words, longest, buckets)
                sizes = np.diff(ends, prepend=0)
                raw = numbers.astype("<u4").tobytes()
                found += [raw[4 * (e - s) : 4 * e] for e, s in zip(ends.tolist(), sizes.tolist())]
                n_words.append(counts)
                n_features.append(sizes)
            numbers = [np.concatenate([*x, np.zeros(0, np.int64)]) for x in (n_words, n_features)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(x.astype(np.int64)) for x in numbers), pa.array(found, pa.binary())],
                names=[*keep, "n_words", "n_features", "buckets"],
            )

    kept = docs.select(*keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + [
        "n_words bigint, n_features bigint, buckets binary"
    ])
    return docs.select(*keep, text_of().cast("binary").alias("_text")).mapInArrow(batches, schema)


def numbers_in(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All bucket numbers of a batch's first column, and where each row's end."""
    rows = batch.column(0).to_pylist()
    return np.frombuffer(b"".join(rows), "<u4"), np.cumsum([0, *map(len, rows)]) // 4


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows lie in each bucket."""

    def counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in rows:
            total += np.bincount(numbers_in(batch)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    summed = found.select("buckets").mapInArrow(counted, "bucket bigint, n bigint")
    total = np.zeros(buckets, np.int64)
    for row in summed.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        total[row["bucket"]] = row["n"]
    return total


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of every bucket's share of the target over its share of the source."""
    k, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_s + k) / ((s + 1) * (all_t + k))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def weight(gains: np.ndarray) -> Column:
    """The floored mean of the gains of a row's ``buckets``; 0 without any."""

    @F.arrow_udf("bigint")
    def weighed(part: pa.Array) -> pa.Array:
        numbers, ends = numbers_in(pa.RecordBatch.from_arrays([part], names=["b"]))
        upto = np.concatenate([[0], np.cumsum(gains[numbers])])[ends]
        return pa.array(np.diff(upto) // np.maximum(np.diff(ends), 1))

    return weighed("buckets")


def noise(seed: int = SEED) -> Column:
    """The Gumbel noise of an id, in thousandths."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    share = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share))).cast("long")


def ranked(rows: DataFrame, usable: Column, percent: int = PERCENT) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3, ... for the ``percent`` of the usable rows with the highest
    ``score``, equal scores by ``doc_id``; null for all others.

    ``rows`` is a written table, whose column ``at`` tells repeated rows apart.
    """
    spark = rows.sparkSession
    # Scores are whole numbers within the range of the logarithms of counts, some 100,000 at most.
    levels = rows.where(usable).groupBy("score").count().collect()
    drawn = percent * sum(x["count"] for x in levels) // 100
    cut, upto = None, 0
    for level in sorted(levels, key=lambda x: -x["score"]):
        if upto >= drawn:
            break
        cut, upto = level["score"], upto + level["count"]
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return rows.select("*", none).drop("at")
    best = usable & (F.col("score") >= cut)
    order = [F.desc("score"), id_or_last(), F.col("at")]
    placed = staged(
        rows.where(best)
        .repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()),
        "placed",
    )
    # The upper bits of such an id are the partition, the lower 33 the place in it.
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit(2**33 - 1))
    before, offsets = 0, {}
    for row in placed.groupBy(part.alias("part")).count().orderBy("part").collect():
        offsets[row["part"]] = before
        before += row["count"]
    known = F.array(*[F.lit(offsets.get(k, 0)).cast("long") for k in range(max(offsets) + 1)])
    rank = F.element_at(known, (part + 1).cast("int")) + place + 1
    there = placed.withColumn("rank", F.when(rank <= drawn, rank))
    rest = rows.where(~F.coalesce(best, F.lit(False))).select("*", none)
    return there.unionByName(rest).drop("at")


def resampled(
    docs: DataFrame, target: DataFrame, longest: int = WORDS_IN_A_RUN, buckets: int = BUCKETS,
    least: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; those drawn have a rank.

    ``docs`` has doc_id and text, ``target`` a text column.
    """
    found = staged(features(docs, longest, buckets), "features")
    wanted = features(target.select("text"), longest, buckets, keep=())
    gains = gains_of(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
    rows = found.select("doc_id", "n_words", "n_features", weight(gains).alias("weight"))
    rows = rows.withColumn("score", F.col("weight") + noise(seed))
    rows = staged(rows.withColumn("at", F.monotonically_increasing_id()), "scored")
    return ranked(rows, F.col("n_words") >= least, percent).drop("n_words")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampled(docs, table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH step AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)
),
texts AS (
  SELECT doc_id, text, true AS own FROM documents
  UNION ALL SELECT NULL, text, false FROM benchmark
),
numbered AS (
  SELECT *, row_number() OVER () AS row_no,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM texts
),
long AS (SELECT row_no, own, unnest(words) AS word FROM numbered),
hashed AS (
  SELECT word,
         xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(octet_length(encode(word))), lambda i:
             ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, step.t[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM long), step
),
found AS (SELECT row_no, own, bucket FROM long JOIN hashed USING (word)),
per_bucket AS (
  SELECT b AS bucket, count(*) FILTER (WHERE own) AS s, count(*) FILTER (WHERE own = false) AS t
  FROM range(10000) AS r(b) LEFT JOIN found ON bucket = b GROUP BY b
),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))::DOUBLE
                               / ((s + 1) * (sum(t) OVER () + 10000))::DOUBLE))::BIGINT AS gain
  FROM per_bucket
),
weights AS (
  SELECT row_no, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM found JOIN gains USING (bucket) WHERE own GROUP BY row_no
),
scored AS (
  SELECT n.row_no, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((
           ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE
         ) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM numbered n LEFT JOIN weights w ON n.row_no = w.row_no WHERE n.own
),
ranks AS (
  SELECT row_no, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranks USING (row_no)
"""
