"""Toxicity of documents after undoing disguises of their words.

Noisy channel: disguised text is what a channel made of plain text by writing
letters as look-alikes, setting characters between them, or repeating them. A
disguised stretch becomes a lattice of what each character may stand for, with
the channel's cost; the Viterbi path through it under a character language
model is the restored text. The model's counts of letter triples cover all
documents; they are summed on Spark, and their number is that of the alphabet's
triples, whatever the corpus. Stretches are found by scanning whole texts;
plain words pass as they are.

The restored text is scored by words that toxic documents hold more often than
others. A word's occurrences count once per preceding word, so that a passage
that is copied a thousand times is seen once. Trees over a document's strongest
words turn this into a probability; they are fitted on documents that the
words they see were not drawn from.

Learning uses at most about ``SAMPLE`` labelled documents outside the held-out
fold. Labels, language, source and id are no inputs of a score.

Nulls: a null text is an empty one, a null label teaches nothing. An empty text
gets a score like any other. Without labels, or with one class only, every
score is the prior. Repeated rows get equal scores. Further columns play no
part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattspan.llm import boost
from wattspan.llm.quality import sample, sampled
from wattspan.llm.staging import held_out, staged, table, text_of

#: Labelled documents to learn from, about.
SAMPLE = 12_000
FOLDS, FOLD = 5, 0
#: Letters of a word's beginning, which is counted like a word of its own.
START = 4

# The alphabet: 0 is a break between words, then a-z, the small letters of Latin-1, any other.
LETTERS = {chr(c): k + 1 for k, c in enumerate([*range(97, 123), *(c for c in range(223, 256) if c != 247)])}
OTHER = len(LETTERS) + 1
SIZE = OTHER + 1
SYMBOL = np.zeros(0x250, np.int32)
SYMBOL[[c for c in range(0x250) if chr(c).isalpha()]] = OTHER
for _c, _k in LETTERS.items():
    SYMBOL[ord(_c)] = _k
SHOWN = {k: c for c, k in LETTERS.items()} | {0: " "}

# Which letters a character may be drawn for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c", "*": "aeiou", "#": "h",
}
FILLERS = " .-_*'~"
# Costs of the channel, in natural logarithms.
DRAWN, ANY, FILLED, REPEATED, LOST = 0.7, 2.0, 0.4, 0.3, 7.0
# A letter written twice, which plain words of the corpus do as well.
DOUBLED = 5.0
# A break written as a space, as another filler, or in place of a look-alike.
SPACED, PARTED, BROKEN = 1.0, 2.0, 6.0

_MARKS = re.escape("".join(LOOKALIKES).replace("*", "")) + re.escape(".-_*'~")
_LETTER, _TOKEN = r"[^\W\d_]", rf"[\w{_MARKS}]"
_SINGLE = rf"(?:{_LETTER}|[0-9@$!|+])"
#: Stretches to restore, beside anything that is no part of a word: single letters or look-alikes in
#: a row, and tokens in which a letter has a mark beside it or comes twice.
DISGUISED = re.compile(
    rf"(?<![\w@$|+]){_SINGLE}(?:[ .\-_*]{{1,3}}{_SINGLE}){{2,}}(?![\w@$|+])"
    rf"|(?<!{_TOKEN}){_TOKEN}*?(?:{_LETTER}[{_MARKS}]{{1,3}}{_LETTER}|[0-9@$!|+]{{1,2}}{_LETTER}"
    rf"|{_LETTER}[0-9@$+|#*]{{1,4}}(?!{_TOKEN})|({_LETTER})\1){_TOKEN}*"
)
#: Marks that end or begin a stretch as they do plain words.
OUTSIDE = ".!'~-_("
WORDS = re.compile(rf"{_LETTER}+")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def symbols_of(points: np.ndarray) -> np.ndarray:
    """The alphabet's symbols of code points; what is no letter is a break, in any script."""
    out = SYMBOL[np.minimum(points, len(SYMBOL) - 1)]
    high = points >= len(SYMBOL)
    if high.any():
        values, places = np.unique(points[high], return_inverse=True)
        out[high] = np.array([OTHER if chr(v).isalpha() else 0 for v in values], np.int32)[places]
    return out


class Model:
    """Costs of letter triples: -log P(symbol | the two before it)."""

    def __init__(self, counts: np.ndarray, weight: float = 5.0):
        triples = counts.reshape(SIZE, SIZE, SIZE).astype(float)
        pairs = triples.sum(axis=0)
        backed = (pairs + 0.1) / (pairs.sum(axis=1, keepdims=True) + 0.1 * SIZE)
        before = triples.sum(axis=2, keepdims=True)
        self.cost = -np.log((triples + weight * backed[None]) / (before + weight))
        self.rows: dict[tuple[int, int], list[float]] = {}

    def after(self, p: int, q: int) -> list[float]:
        """Costs of every symbol after p and q."""
        found = self.rows.get((p, q))
        if found is None:
            found = self.rows[p, q] = self.cost[p, q].tolist()
        return found


def choices(char: str, previous: str, often: bool) -> list[tuple[int, float]]:
    """What a character may stand for: (symbol, channel's cost); -1 stands for nothing.

    ``often`` says whether it comes three times in a row and more.
    """
    if char.isalpha():
        own = LETTERS.get(char, OTHER)
        return [(own, 0.0), (-1, REPEATED if often else DOUBLED)] if char == previous else [(own, 0.0)]
    found = [(LETTERS[c], ANY if char == "*" else DRAWN) for c in LOOKALIKES.get(char, "")]
    if char in FILLERS or char.isspace():
        return [*found, (-1, FILLED), (0, SPACED if char.isspace() else PARTED)]
    return [*found, (-1, LOST), (0, BROKEN)]


def decode(stretch: str, model: Model) -> str:
    """The cheapest plain text of a stretch; states are the two symbols written last."""
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    previous = ""
    for at, char in enumerate(stretch):
        found: dict[tuple[int, int], tuple[float, tuple]] = {}
        options = choices(char, previous, char * 3 in stretch[max(0, at - 2) : at + 3])
        for (p, q), (cost, path) in states.items():
            after = model.after(p, q)
            for symbol, price in options:
                if symbol < 0 or symbol == 0 == q:
                    state, total, way = (p, q), cost + price, path
                else:
                    state, total = (q, symbol), cost + price + after[symbol]
                    way = (path, char if symbol == OTHER else SHOWN[symbol])
                if state not in found or total < found[state][0]:
                    found[state] = (total, way)
        states, previous = found, char
    _, path = min(
        (cost + (model.after(p, q)[0] if q else 0.0), n, path)
        for n, ((p, q), (cost, path)) in enumerate(states.items())
    )[1:]
    out = []
    while path:
        path, shown = path
        out.append(shown)
    return "".join(reversed(out))


def restored(text: str, model: Model, known: dict[str, str]) -> str:
    """The lower-cased text with its disguised stretches in plain letters."""
    def plain(match: re.Match) -> str:
        token = match.group(0)
        out = known.get(token)
        if out is None:
            if len(known) >= 100_000:
                known.clear()
            behind = token.rstrip(OUTSIDE)
            stretch = behind.lstrip(OUTSIDE)
            # Figures in a row are no word.
            word = sum(map(str.isalpha, stretch)) > (" " in stretch)
            middle = decode(stretch, model) if word else stretch
            out = known[token] = (
                behind[: len(behind) - len(stretch)] + middle + token[len(behind) :]
            )
        return out

    return DISGUISED.sub(plain, text.lower())


def triple_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter triples over all documents; at most SIZE^3 of them reach the driver."""

    def of(text: str) -> np.ndarray:
        total = np.zeros(SIZE**3, np.int64)
        points = code_points(text)
        for at in range(0, len(points), 1 << 20):
            symbols = symbols_of(points[at : at + (1 << 20) + 2])
            symbols = symbols[(symbols > 0) | np.r_[True, symbols[:-1] > 0]]
            index = (symbols[:-2] * SIZE + symbols[1:-1]) * SIZE + symbols[2:]
            total += np.bincount(index, minlength=SIZE**3)
        return total

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, size = np.zeros(SIZE**3, np.int64), [], 0
        for batch in found:
            for text in batch.column(0).to_pylist():
                waiting.append(text.lower())
                size += len(text)
                if size > 1 << 19:
                    total += of("\n".join(["", *waiting, ""]))
                    waiting, size = [], 0
        total += of("\n".join(["", *waiting, ""]))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["t", "n"])

    rows = (
        docs.select(text_of().alias("text"))
        .mapInArrow(batches, "t bigint, n bigint")
        .groupBy("t")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    out = np.zeros(SIZE**3, np.int64)
    out[rows["t"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def restore(docs: DataFrame, model: Model, *others) -> DataFrame:
    """The named columns and ``restored``, the text in plain lower-case letters."""

    @F.pandas_udf("string")
    def plain(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, str] = {}
        for part in texts:
            yield part.map(lambda x: restored(x, model, known))

    return docs.select(*others, plain(text_of()).alias("restored"))


def start(word: str) -> str:
    """The key that words with the same beginning share."""
    return word[:START] + "-"


def word_counts(learned: DataFrame) -> DataFrame:
    """Per word or beginning: in how many contexts toxic and other documents of either half
    hold it."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for text, half, label in zip(*(c.to_pylist() for c in batch.columns)):
                words = WORDS.findall(text)
                pairs = set(zip(["", *words], words))
                pairs = list(pairs | {(b, start(w)) for b, w in pairs if len(w) > START})
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w for _, w in pairs], pa.string()),
                        pa.array([b for b, _ in pairs], pa.string()),
                        pa.array([2 * half + label] * len(pairs), pa.int32()),
                    ],
                    names=["word", "before", "kind"],
                )

    kinds = learned.select("restored", "half", "label").mapInArrow(
        batches, "word string, before string, kind int"
    )
    once = kinds.groupBy("word", F.xxhash64("before").alias("before"), "kind").agg(F.lit(1))
    return once.groupBy("word").agg(
        *[F.sum((F.col("kind") == k).cast("long")).alias(f"n{k}") for k in range(4)]
    )


def weights(toxic: pd.Series, other: pd.Series, totals: tuple[int, int]) -> pd.Series:
    """How much more often toxic documents hold a word, less for words seen seldom."""
    odds = np.log((toxic + 0.5) / (totals[0] + 1)) - np.log((other + 0.5) / (totals[1] + 1))
    return odds * toxic / (toxic + 4)


def features(text: str, lexicon: dict[str, float]) -> np.ndarray:
    """Statistics of the lexicon's words in a restored text."""
    words = WORDS.findall(text)
    keys = set(words)
    keys |= {start(w) for w in keys if len(w) > START}
    found = sorted((lexicon[w] for w in lexicon.keys() & keys), reverse=True)
    first, second, third = [*found, 0.0, 0.0, 0.0][:3]
    n = 1 + len(words)
    return np.array(
        [first, second, third, sum(found), len(found), sum(found) / np.log(n + 1), np.log(n)]
    )


def lexicons(counts: DataFrame) -> tuple[dict, dict, dict]:
    """Words and weights from the first half, the second half, and both."""
    counts = staged(counts, "word-counts")
    total = counts.agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(4)]).first()
    if total.n0 is None:
        return {}, {}, {}
    toxic, other = F.col("n1") + F.col("n3"), F.col("n0") + F.col("n2")
    share = (total.n1 + total.n3 + 1) / (total.n0 + total.n2 + 1)
    # Words of the sample's toxic documents; no weight depends on their order.
    words = counts.where((toxic >= 2) & (toxic > 3 * share * other)).toPandas()

    def of(halves: tuple[int, ...]) -> dict:
        t, o = sum(words[f"n{2 * h + 1}"] for h in halves), sum(words[f"n{2 * h}"] for h in halves)
        sums = tuple(sum(total[2 * h + k] for h in halves) for k in (1, 0))
        w = weights(t, o, sums)
        return {a: float(b) for a, b in zip(words["word"], w) if b > 1}

    return of((0,)), of((1,)), of((0, 1))


def fit(docs: DataFrame, labels: DataFrame, model: Model) -> tuple[dict, boost.Trees]:
    """The lexicon and the trees, from a bounded sample of the labelled documents."""
    learned = sampled(docs, sample(labels, "toxic", FOLDS, FOLD, SAMPLE))
    # Equal texts lie in the same half.
    half = F.pmod(F.xxhash64(text_of()), F.lit(2)).cast("int").alias("half")
    learned = staged(restore(learned, model, "doc_id", half, "label"), "restored")
    first, second, both = lexicons(word_counts(learned))

    @F.pandas_udf("array<double>")
    def crossed(texts: pd.Series, half: pd.Series) -> pd.Series:
        return pd.Series([features(x, first if h else second) for x, h in zip(texts, half)])

    rows = learned.select("doc_id", "label", crossed("restored", "half").alias("x")).toPandas()
    rows = rows.assign(_x=[tuple(x) for x in rows["x"]]).sort_values(["doc_id", "label", "_x"])
    x = np.stack(list(rows["x"])) if len(rows) else np.zeros((0, len(features("", {}))))
    return both, boost.fit(x, rows["label"].to_numpy(), trees=40, depth=3, least=5)


def scored(docs: DataFrame, model: Model, lexicon: dict, trees: boost.Trees, *others) -> DataFrame:
    """The named columns and the score of every document's restored text."""

    @F.pandas_udf("double")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, str] = {}
        for part in texts:
            x = [features(restored(t, model, known), lexicon) for t in part]
            yield pd.Series(boost.score(trees, np.stack(x)) if x else [], dtype=float)

    return docs.select(*others, judged(text_of()).alias("score"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = Model(triple_counts(docs))
    lexicon, trees = fit(docs, table(spark, sf_dir, "labels"), model)
    return scored(docs, model, lexicon, trees, "doc_id").select(
        "doc_id",
        held_out("doc_id", FOLDS, FOLD).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
