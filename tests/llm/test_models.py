"""Classifiers: held-out accuracy, rules of the sample, odd rows."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridspark.llm import quality, toxicity
from gridspark.llm._text import parquet

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(spark):
    return parquet(spark, SF, "documents"), parquet(spark, SF, "labels")


def area(scores, labels):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    ones = labels == 1
    return (rank[ones].mean() - (ones.sum() - 1) / 2) / (~ones).sum()


def test_toxicity_held_out(labelled):
    docs, labels = labelled
    out = toxicity.classify(docs, labels).toPandas()
    assert len(out) == docs.count() and out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all()
    both = out[out.held_out].merge(labels.toPandas(), on="doc_id")
    assert area(both.score.to_numpy(), both.toxic.to_numpy()) > 0.9
    assert both[both.predicted == 1].toxic.mean() > 0.85


def test_only_the_text_enters_a_score(labelled):
    docs, labels = labelled
    model, cuts = toxicity.fit_on(docs, labels, rows=60)
    some = docs.limit(50)
    a = toxicity.score(some, model, cuts).toPandas().score
    b = toxicity.score(some.selectExpr("doc_id + 7 as doc_id", "'xx' as lang", "text"), model, cuts).toPandas().score
    assert (a == b).all()


def test_toxicity_odd_rows(spark, make_docs, hard_rows):
    docs = make_docs(hard_rows + [(200 + i, f"you idiot number {i}") for i in range(20)] + [(300 + i, f"dear reader {i}") for i in range(20)])
    labels = spark.createDataFrame([(200 + i, 1) for i in range(20)] + [(300 + i, 0) for i in range(20)] + [(None, 1), (5, None), (9999, 1)],
                                   "doc_id long, toxic int")
    model, cuts = toxicity.fit_on(docs, labels)
    out = toxicity.score(docs, model, cuts)
    assert out.count() == docs.count()
    got = {r["doc_id"]: r["predicted"] for r in out.collect()}
    assert all(got[200 + i] == 1 and got[300 + i] == 0 for i in range(20))
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()}.isdisjoint(range(200, 220))
    assert toxicity.fit_on(docs, labels.where("false")) == (None, {})
    assert toxicity.classify(docs, labels.where("false")).where("score <> 0").count() == 0
    assert toxicity.classify(make_docs([]), labels).count() == 0


def test_a_long_text_scores_like_its_words(spark):
    model = toxicity.fit([(toxicity.word_ids(*toxicity.utf8(__import__("pyarrow").array([t])))[0], y)
                          for t, y in [("bad bad word", 1), ("fine good word", 0)] * 4], least_steps=50)
    import pyarrow as pa

    long = "fine word " * 40_000 + "bad " + "good " * 40_000
    assert math.isclose(*toxicity.scores(model, pa.array([long, "fine word fine word bad good good good"])), abs_tol=0.2)
    assert toxicity.scores(model, pa.array(["", None]))[0] == toxicity.scores(model, pa.array(["", None]))[1]


def test_thresholds_come_from_rows_left_out_of_the_fit_and_decide(spark, make_docs, monkeypatch):
    seen = []

    class Half:
        """A model that knows the toxic texts but scores them low."""
        def score(self, ids, first):
            return np.array([0.2 if b - a == 3 + toxicity.PADS else 0.1 for a, b in zip(first, first[1:])])

    monkeypatch.setattr(toxicity, "fit", lambda texts, **options: seen.append(len(texts)) or Half())
    docs = make_docs([(i, "three short words" if i % 2 else "two words") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    fitted = docs.where(~toxicity.held_out() & ~toxicity.calibrates()).count()
    model, cuts = toxicity.fit_on(docs, labels)
    assert seen == [fitted] and fitted < docs.where(~toxicity.held_out()).count() and math.isclose(cuts["en"], 0.15)
    assert toxicity.fit_on(docs, labels, max_bytes=300)[0] and seen[1] < seen[0]
    assert toxicity.cuts_by_language(["a"] * 6 + ["b"], np.array([.1, .1, .1, .2, .2, .2, .2]), np.array([0, 0, 0, 1, 1, 1, 1]))["b"] < 0.2


def test_drop_by_the_threshold_of_the_language(spark, make_docs, monkeypatch):
    model = toxicity.fit([(toxicity.word_ids(*toxicity.utf8(pa.array([t])))[0], y)
                          for t, y in [("bad bad word", 1), ("fine good word", 0)] * 4], least_steps=50)
    texts = ["bad bad word", "fine good word", "bad fine word"]
    docs = make_docs(list(enumerate(texts)))
    scores = toxicity.scores(model, pa.array(texts))
    assert scores[1] < scores[0]
    low, high = (docs.transform(toxicity.drop_toxic, model, thresholds={"en": t}) for t in (scores[1], 1.0))
    assert low.count() == 0 and high.count() == 3
    assert docs.transform(toxicity.drop_toxic, model, thresholds={"de": 0.0}).count() == int((scores < toxicity.CUT).sum())


def test_rows_beyond_the_drivers_are_learned_too(spark):
    """Of 6 600 texts of class 0 those with the highest hashes hold a word of class 1 that only the word before it takes back."""
    ids = spark.range(22_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"))
    late = F.xxhash64("doc_id") > F.lit(int(0.93 * 2 ** 64) - 2 ** 63)
    text = F.when(F.col("doc_id") % 2 == 1, "you idiot").when(late, "zounds dear idiot").otherwise("dear reader")
    docs = ids.select("doc_id", "lang", text.alias("text"))
    labels = ids.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")).where("toxic = 0 or doc_id % 20 = 1")
    model, cuts = toxicity.fit_on(docs, labels)
    mild, toxic, plain = toxicity.scores(model, pa.array(["zounds dear idiot", "you idiot", "dear reader"]))
    assert mild < 0.1 and plain < 0.1 and toxic > 0.9 and mild < cuts["en"] < toxic
    assert model.seen is None


def test_cuts_over_all_rows_are_those_of_one_scan(spark):
    rng = np.random.default_rng(1)
    rows = [([None, "a", "b", "c"][rng.integers(4)], int(rng.random() < 0.3), float(np.round(rng.random(), 2))) for _ in range(2000)]
    rows += [("d", 1, 0.5), ("e", 0, 0.25)] + [("f", i % 2, i / 10) for i in range(6)]
    langs, marks, scores = zip(*rows)
    frame = spark.createDataFrame(rows, "lang string, _label long, score double").repartition(5)
    assert toxicity.cuts_on(frame) == toxicity.cuts_by_language(list(langs), np.array(scores), np.array(marks))
    assert toxicity.cuts_on(frame.where("false")) == {}


def test_maxima_by_blocks_are_those_of_whole_texts(monkeypatch):
    texts = [toxicity.word_ids(*toxicity.utf8(pa.array([t])))[0] for t in ("one two three four five six seven", "", "eight", "a b " * 9)]
    model = toxicity.fit([(t, i % 2) for i, t in enumerate(texts)], least_steps=5)
    sizes = np.array([len(t) for t in texts])
    whole = model.peaks(np.concatenate(texts), np.cumsum(sizes), sizes)
    monkeypatch.setattr(toxicity, "LEARN_WORDS", 4)
    blocks = model.peaks(np.concatenate(texts), np.cumsum(sizes), sizes)
    assert (whole[0] == blocks[0]).all() and np.allclose(whole[1], blocks[1])


def test_best_cut():
    assert toxicity.best_cut(np.array([0.9, 0.8, 0.2, 0.1]), np.array([1, 1, 0, 0])) == 0.5
    assert toxicity.best_cut(np.array([0.9]), np.array([1])) == toxicity.CUT


def test_quality_held_out(labelled):
    docs, labels = labelled
    out = quality.classify(docs, labels).toPandas()
    assert len(out) == docs.count() and out.expected_grade.between(0, 2).all()
    both = out[out.held_out].merge(labels.toPandas(), on="doc_id")
    assert area(both["tail"].to_numpy(), both.quality.to_numpy()) > 0.97
    assert both[both.quality == 1].selected.mean() > 0.98 and both[both.quality == 0].selected.mean() < 0.2


def test_quality_odd_rows(spark, make_docs, hard_rows):
    docs = make_docs(hard_rows)
    ratings = spark.createDataFrame([(5, 1, 0), (7, 1, 1), (4, 0, 0), (8, 0, None), (None, 1, 0), (12, None, 1)],
                                    "doc_id long, quality int, toxic int")
    out = quality.classify(docs, ratings)
    assert out.count() == len(hard_rows) and out.where("expected_grade is null").count() == 0
    none = quality.classify(docs, ratings.where("false")).collect()
    assert all(r["selected"] == 1 and r["tail"] is None for r in none)
    assert quality.classify(make_docs([]), ratings).count() == 0
    model = quality.fit([(np.array([1]), np.ones(1), 0), (np.array([2]), np.ones(1), 1), (np.array([3]), np.ones(1), 2)] * 20, 3)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(np.array([model.weights[1], model.weights[2], model.weights[3]]))
    assert tails.sum(axis=1).round().tolist() == [0, 1, 2]
