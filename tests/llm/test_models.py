"""Language id and the quality classifier: held-out accuracy and edges."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from enrichlab.llm import language_id, quality_classifier
from enrichlab.llm.queries import QUERIES
from tests.llm.conftest import EDGES

SF = "/root/testdata/sf0.01"


def test_codewords_differ():
    for k in (2, 3, 4, 6, 9, 20):
        code = language_id.codewords(k)
        assert set(np.unique(code)) == {-1, 1} and len({tuple(r) for r in code}) == k
        assert all(abs(c.sum()) < k for c in code.T)


def test_a_wrong_bit_is_corrected():
    code = language_id.codewords(5)
    langs = list("abcde")
    model = language_id.LanguageModel(langs, code, np.zeros((1, 1)), np.full(code.shape, 1 / code.shape[1]))
    for i in range(5):
        for wrong in range(code.shape[1]):
            margin = 4 * code[i].copy()
            margin[wrong] *= -1
            model.margins = lambda _, m=margin: m
            assert model.predict("x")[0] == langs[i]


def test_language_held_out(spark):
    rows = QUERIES["op7_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)


def test_language_of_edges(edges, nothing):
    model = language_id.learn(edges, F.lit(True))
    rows = language_id.identify(edges, model).collect()
    assert len(rows) == len(EDGES) and {r.lang_pred for r in rows if r.doc_id in (2, 3, 7)} == {"und"}
    empty = language_id.learn(nothing, F.lit(True))
    assert empty.langs == [] and {r.lang_pred for r in language_id.identify(edges, empty).collect()} == {"und"}
    assert language_id.identify(nothing, model).count() == 0


def test_quality_held_out(spark):
    rows = QUERIES["op9_quality_classifier"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for r in rows)
    good, bad = ([r.score for r in rows if r.held_out and r.quality == q] for q in (1, 0))
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc >= 0.95 and np.mean([g >= 0.7 for g in good]) >= 0.95


def test_training_does_not_depend_on_partitions(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    a = quality_classifier.train(docs, labels, F.lit(True))
    assert np.array_equal(a, quality_classifier.train(docs.repartition(7), labels.repartition(3), F.lit(True)))


def test_ftrl_learns_and_l1_zeroes():
    model, rng = quality_classifier.Ftrl(50), np.random.default_rng(1)
    for _ in range(600):
        y = int(rng.random() < 0.5)
        at = np.array([0, 10 + y, 20 + int(rng.integers(20))])
        model.update(at, np.ones(3), y)
    w = model.weights()
    assert w[11] > 1 > -1 > w[10] and (w[45:] == 0).all()


def test_classifier_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (3, None), (77, 1), (8, 0), (8, 7)], "doc_id long, quality int")
    weights = quality_classifier.train(edges, labels, F.lit(True))
    rows = quality_classifier.score(edges, weights).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 7)}) == 1
    none = quality_classifier.train(nothing, labels, F.lit(True))
    assert {r.score for r in quality_classifier.score(edges, none).collect()} == {0.5}
    assert quality_classifier.score(nothing, weights).count() == 0


def test_many_dirty_tags_are_bounded(spark):
    rows = [(i, ("the old house by the sea and the wind" if i % 2 else "das alte haus an der see und der wind") + f" {i}", "en" if i % 2 else "de") for i in range(60)]
    rows += [(1000 + i, f"noise {i}", f"tag{i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs, F.lit(True), max_langs=2)
    assert model.langs == ["de", "en"]
    assert len(language_id.learn(docs, F.lit(True)).langs) == 52


def test_references_of_rare_languages_stay_on_the_cluster(spark):
    from enrichlab.llm import quality_rules

    rows = [(f"word{i % 7} and the text number {i}", "en") for i in range(2500)] + [("rare words", f"tag{i}") for i in range(2)] + [("einige worte hier", "de")] * 5
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert [r["lang"] for r in quality_rules.language_references(docs, "text", "lang", 5)] == ["de", "en"]
