"""Quality and language classifiers: held-out accuracy on the tables, awkward rows, missing classes."""

import pytest
from pyspark.sql import functions as F

from courtside.llm import catalog, language, quality
from courtside.llm.compression import Sizes


@pytest.fixture(scope="module")
def folder(sf_dir):
    return sf_dir.replace("sf0.001", "sf0.01")


def test_quality_on_the_held_out_fold(spark, folder):
    got = catalog.QUERIES["op3_quality_classifier"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = got.where("held_out").join(labels, "doc_id").collect()
    good = [r.predicted for r in held if r.quality == 1]
    bad = [r.predicted for r in held if r.quality == 0]
    assert sum(good) >= 0.97 * len(good)
    assert sum(bad) <= 0.4 * len(bad)
    assert got.where("score < 0 OR score > 1 OR score IS NULL").isEmpty()
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_quality_of_awkward_rows(spark, odd_docs, odd_rows):
    marks = spark.createDataFrame([(i, i % 2) for i in range(1, 13)] + [(None, 1), (50, 0), (4, None), (5, 7)], "doc_id long, quality int")
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    model = quality.fit(odd_docs, marks)
    got = quality.score(odd_docs, model, ["doc_id", "row"]).collect()
    assert sorted(r.row for r in got) == list(range(len(odd_rows)))
    assert all(0 <= r.score <= 1 for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(odd_rows[r.row][1] or "", r.score) == r.score
    assert quality.score(odd_docs.limit(0), model, ["doc_id"]).collect() == []


def test_quality_without_labels_or_with_one_class(spark, odd_docs):
    none = quality.fit(odd_docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(odd_docs, none, ["row"]).collect()} == {0.5}
    ones = quality.fit(odd_docs, spark.createDataFrame([(i, 1) for i in range(4, 12)], "doc_id long, quality int"))
    assert all(r.score > 0.5 for r in quality.score(odd_docs, ones, ["row"]).collect())


def test_language_on_the_held_out_fold(spark, folder):
    got = catalog.QUERIES["op6_language_id"](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(docs, "doc_id")
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.95
    assert got.where("score < 0 OR score > 1 OR score IS NULL").isEmpty()


def test_language_of_awkward_rows(odd_docs, odd_rows, spark):
    train = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), (None, "en"), ("text", None), ("123", "xx")] * 3, "text string, lang string"
    )
    model = language.fit(train)
    assert sorted(model) == ["de", "en"]
    got = language.predict(odd_docs, model, ["doc_id", "row"]).collect()
    assert sorted(r.row for r in got) == list(range(len(odd_rows)))
    for r in got:
        text = odd_rows[r.row][1] or ""
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, text)))
        assert 0 <= r.score <= 1 and not (r.accepted and r.lang_pred == "und")
    nothing = language.fit(train.limit(0))
    assert nothing == {} and {r.lang_pred for r in language.predict(odd_docs, nothing, ["row"]).collect()} == {"und"}


def test_narrow_margins_are_not_accepted(spark):
    model = {"a": b"same words here", "b": b"same words here"}
    docs = spark.createDataFrame([(1, "same words")], "doc_id long, text string")
    row = language.predict(docs, model, ["doc_id"]).first()
    assert (row.lang_pred, row.score, row.accepted) == ("a", 0.0, False)


def test_sizes_use_the_dictionary_in_every_piece():
    words = " ".join(f"word{i}" for i in range(2000)).encode()
    assert Sizes(words)(words) < Sizes()(words)


def test_language_learns_from_different_texts(spark):
    names = ["alpha beta", "gamma delta", "omega sigma", "theta kappa", "lambda rho"]
    train = spark.createDataFrame([(t, "en") for t in names] * 300 + [(None, "en"), ("12", "en")], "text string, lang string")
    model = language.fit(train)
    assert sorted(model["en"].decode().split()) == sorted(" ".join(names).split())
