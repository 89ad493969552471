import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareflow.llm.language import Model, Settings, buckets, held_out, mixture, predictions, train
from tests.conftest import SMALL

SYLLABLES = {"xa": "ka lo mi ta ru".split(), "xb": "sch ein ung tze ach".split(), "xc": "eau oui ment tre que".split()}


def text(lang, n, pick):
    return " ".join("".join(pick.choices(SYLLABLES[lang], k=pick.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    pick, settings = random.Random(1), Settings()
    counts = np.full((1 << settings.bits, 3), settings.smoothing)
    for i, lang in enumerate(sorted(SYLLABLES)):
        counts[:, i] += np.bincount(buckets(text(lang, 20_000, pick), settings.bits), minlength=1 << settings.bits)
    return Model(sorted(SYLLABLES), (counts / counts.sum(axis=0)).astype(np.float32))


def test_proportions(model):
    """A mixture's parts are found, and no language is added to a text of one."""
    pick, settings = random.Random(2), Settings()
    count = np.bincount(buckets(text("xa", 300, pick), settings.bits))
    seen = np.flatnonzero(count)
    assert mixture(count[seen], model.chance[seen], settings).tolist() == [1, 0, 0]
    mixed = f"{text('xb', 300, pick)} {text('xc', 100, pick)}"
    count = np.bincount(buckets(mixed, settings.bits))
    seen = np.flatnonzero(count)
    parts = mixture(count[seen], model.chance[seen], settings)
    letters = len(mixed)
    share = len(mixed.encode().rsplit(b" ", 100)[0]) / letters
    assert parts[0] == 0 and abs(parts[1] - share) < 0.05
    assert model.predict(mixed, settings)[0] == "xb"


def test_texts_without_letters(model):
    for nothing in (None, "", " 123 !?\n", "½ 😀"):
        assert model.predict(nothing, Settings()) == ("und", 0.0)
    assert model.predict("日本", Settings())[0] in model.languages
    assert model.predict("a", Settings())[0] in model.languages
    assert Model([], np.zeros((4, 0))).predict("abc", Settings()) == ("und", 0.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = predictions(docs).join(docs.select("doc_id", "lang", "text"), "doc_id")
    tested = rows.filter("held_out and lang is not null and length(text) > 20 and lang_pred <> 'und'")
    right, n = tested.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right >= 0.95
    assert rows.filter("not score between 0 and 1").isEmpty()


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = [(i, "kalo mitaru " * 9, "xa") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wrong = docs.withColumn("lang", F.when(held_out(5), "zz").otherwise(F.col("lang")))
    assert not docs.filter(held_out(5)).isEmpty()
    assert train(wrong).languages == ["xa"]


def test_odd_rows(odd, none):
    rows = predictions(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[4]["lang_pred"] == by_id[5]["lang_pred"] == by_id[12]["lang_pred"] == "und"
    assert all(r["held_out"] is not None and 0 <= r["score"] <= 1 for r in rows)
    assert not by_id[None]["held_out"]
    assert predictions(none).count() == 0
    unlabelled = predictions(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}
