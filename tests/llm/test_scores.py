"""The two classifiers: trees, disguised words, held-out accuracy, odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.llm import boost, quality, toxicity
from wattspan.llm.staging import held_out


def test_trees_learn_a_rule_and_walk_like_plain_code():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(int)
    model = boost.fit(x[:2000], y[:2000])
    p = boost.score(model, x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.95

    def walked(row):
        raw = model.prior
        for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
            k = 0
            while k < len(feature):
                k = 2 * k + 1 + int(row[feature[k]] > cut[k])
            raw += leaf[k - len(feature)]
        return 1 / (1 + np.exp(-raw))

    assert p[:50] == pytest.approx([walked(r) for r in x[2000:2050]])


def test_trees_without_two_classes():
    assert boost.score(boost.fit(np.zeros((0, 3)), []), np.zeros((2, 3))) == pytest.approx([0.5, 0.5])
    one = boost.score(boost.fit(np.ones((9, 3)), np.ones(9)), np.zeros((1, 3)))
    assert one[0] > 0.9 and len(boost.score(boost.fit(np.ones((9, 3)), np.ones(9)), np.zeros((0, 3)))) == 0


@pytest.fixture(scope="module")
def letters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return toxicity.Model(toxicity.triple_counts(docs))


@pytest.mark.parametrize("disguised, plain", [
    ("m0r0n", "moron"), ("1d10t", "idiot"), ("5tup1d", "stupid"), ("s t u p i d", "stupid"), ("l.o.s.e.r", "loser"),
    ("stuuuupid", "stupid"), ("$cum", "scum"), ("st*pid", "stupid"), ("tr@sh", "trash"), ("w0rthl355", "worthless"),
    ("d-i-s-g-u-s-t-i-n-g", "disgusting"), ("P4TH3T1C", "pathetic"), ("you are a c l o w n.", "you are a clown."),
    ("ki11", "kill"), ("a$$hole", "asshole"), ("1 d 1 0 t", "idiot"), ("i d 1 o t", "idiot"), ("iddiot", "idiot"),
    ('"1d10t"', '"idiot"'), ("you,1diot", "you,idiot"), ("[1diot]", "[idiot]"), ("\u201c1diot\u201d", "\u201cidiot\u201d"),
    ("1diot!", "idiot!"), ("well \u2014 1diot", "well \u2014 idiot"), ("1 2 3 and 4 5 6", "1 2 3 and 4 5 6"),
    ("a book, all of it", "a book, all of it"), ("Still!", "still!"), ("bitterness", "bitterness"),
    ("Plain words stay, 12 of them.", "plain words stay, 12 of them."), ("", ""),
])
def test_disguises(letters, disguised, plain):
    assert toxicity.restored(disguised, letters, {}) == plain


def test_triples_are_counted_over_all_rows(spark):
    docs = spark.createDataFrame([("abc",), ("ABC abc",), (None,), ("a" * 2_000_000,)], "text string")
    counts = toxicity.triple_counts(docs).reshape((toxicity.SIZE,) * 3)
    assert counts[1, 2, 3] == 3 and counts[0, 1, 2] == 3 and counts[1, 1, 1] == 1_999_998


def accuracy(spark, rows, label):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    pairs = [(r["predicted"], r[label]) for r in rows.where("held_out").join(labels, "doc_id").collect()]
    by_class = [np.mean([p == y for p, y in pairs if y == c]) for c in (0, 1)]
    return len(pairs), by_class


def test_quality_on_held_out_rows(spark):
    rows = quality.op10_quality(spark, "/root/testdata/sf0.01")
    n, (bad, good) = accuracy(spark, rows, "quality")
    assert rows.count() == 1000 and n > 50 and bad > 0.9 and good > 0.9


def test_toxicity_on_held_out_rows(spark):
    rows = toxicity.op3_toxicity(spark, "/root/testdata/sf0.01")
    n, (clean, toxic) = accuracy(spark, rows, "toxic")
    # Eight languages' worth of words from 41 toxic documents: most, not all, are known.
    assert rows.count() == 1000 and n > 50 and clean > 0.95 and toxic > 0.6


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("quality", F.when(held_out("doc_id", 4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.fit(docs, x) for x in (labels, flipped))
    assert a.prior == b.prior and (a.leaf == b.leaf).all()


def test_an_id_that_many_rows_repeat_is_learned_from_once(spark):
    docs = spark.range(900).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(900).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    few = quality.sample(labels, "quality", 4, 2)
    rows = quality.sampled(docs, few)
    assert rows.where("doc_id = 7").count() == few.where("doc_id = 7").count() <= 1
    assert rows.count() == rows.select("doc_id").distinct().count()


def test_odd_rows(spark, nasty, nothing, letters):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (4, 1, 1), (5, None, None), (None, 1, 1), (8, 0, 0), (8, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    model = quality.fit(nasty, labels)
    scores = [r["score"] for r in quality.scored(nasty, model, "doc_id").collect()]
    assert len(scores) == nasty.count() and all(0 <= x <= 1 for x in scores)
    kept = quality.keep_good(nasty, labels)
    assert kept.dtypes == nasty.dtypes
    assert quality.keep_good(nothing, labels).count() == 0 and quality.keep_good(nasty, labels.where("false")).dtypes == nasty.dtypes
    lexicon, trees = toxicity.fit(nasty, labels, letters)
    scores = [r["score"] for r in toxicity.scored(nasty, letters, lexicon, trees, "doc_id").collect()]
    assert len(scores) == nasty.count() and all(0 <= x <= 1 for x in scores)
    for docs, some in ((nothing, labels), (nasty, labels.where("false"))):
        model = quality.fit(docs, some)
        assert {r["score"] for r in quality.scored(nasty, model).collect()} == {0.5}
        assert quality.scored(nothing, model).count() == 0
        lexicon, trees = toxicity.fit(docs, some, letters)
        assert lexicon == {} and {r["score"] for r in toxicity.scored(nasty, letters, lexicon, trees).collect()} == {0.5}
    assert toxicity.triple_counts(nothing).sum() == 0
