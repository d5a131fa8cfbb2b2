import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language, quality
from tests.llm.helpers import ODD, odd_documents

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet")


def test_language_of_held_out_documents(spark, docs):
    held = F.pmod(F.xxhash64("text"), F.lit(3)) == 1
    model = language.train(docs.where(~held), per_language=100)
    assert model.languages == ["de", "en", "es", "fr"] and 0 <= model.reject_below <= 1
    got = language.identify(docs.where(held), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    again = language.identify(docs.where(held), language.train(docs.where(~held).repartition(3), per_language=100))
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in again.collect()) == sorted((r.doc_id, r.lang_pred, r.score) for r in got)


def test_language_of_odd_rows(spark, docs):
    model = language.train(docs, per_language=20)
    rows = language.identify(odd_documents(spark), model).collect()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert len(rows) == len(ODD) + 2
    for i in (0, 1, 2, 3, 6):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert by[4].lang_pred == by[5].lang_pred and by[4].score == by[5].score and by[7].lang_pred in model.languages
    assert all(0 <= r.score <= 1 for r in rows)
    nobody = language.train(docs.where("lang is null"))
    assert {r.lang_pred for r in language.identify(odd_documents(spark), nobody).collect()} == {"und"}
    assert language.identify(odd_documents(spark).limit(0), model).count() == 0


def test_rejection_is_calibrated():
    """Noise in the labels of one language lowers its probabilities and raises the threshold."""
    rng = np.random.default_rng(0)
    rows = []
    for k in range(600):
        lang = "ab"[k % 2]
        text = " ".join(rng.choice(["kola", "mira", "tona"] if lang == "a" else ["kelo", "wedu", "jipo"], 20))
        if k % 5 == 0:
            lang = "ab"[(k + 1) % 2]
        rows.append((lang, *language.counts_of(text)))
    noisy = language.fit(rows, epochs=4)
    assert noisy.reject_below > 0.5
    _, score = noisy.predict("kola mira tona " * 5)
    assert 0.6 < score < 0.97


def test_subwords_do_not_depend_on_chunks(monkeypatch):
    text = "Les mots d'une phrase très longue, répétée. " * 40
    whole = language.counts_of(text)
    monkeypatch.setattr(language, "CHUNK", 37)
    parts = language.counts_of(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_quality_of_held_out_documents(spark, docs):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    model = quality.train(docs, labels.where(~held))
    got = quality.scored(docs, model).join(labels.where(held), "doc_id").collect()
    right = [(r.score >= 0.3) == (r.quality == 1) for r in got]
    clean = [r.score >= 0.3 for r in got if r.quality == 1]
    assert np.mean(right) > 0.95 and np.mean(clean) > 0.97


def test_votes_equal_their_definition(spark, docs):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    model = quality.train(docs, labels, per_label=40)
    texts = docs.limit(30).toArrow().column("text").combine_chunks()
    terms = np.concatenate([t for _, t in quality.term_counts(texts)])
    x = model.project(terms).astype(np.float64)
    for row, score in zip(x, model.score(terms)):
        near = model.vectors @ row
        best = np.argsort(-near)[: quality.NEIGHBOURS]
        w = np.maximum(near[best], 1e-6) ** 4
        assert score == pytest.approx((w * model.labels[best]).sum() / w.sum(), abs=1e-3)


def test_quality_of_odd_rows(spark, docs):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    model = quality.train(docs, labels.unionByName(labels.limit(3)).unionByName(spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")), per_label=60)
    odd = odd_documents(spark)
    rows = quality.scored(odd, model).collect()
    assert len(rows) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[0] == by[1] and by[4] == by[5]
    kept = quality.kept(odd, model, 0.3)
    assert kept.columns == odd.columns and kept.count() == sum(r.score >= 0.3 for r in rows)
    blank = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.scored(odd, blank).collect()} == {0.5}
    assert quality.scored(odd.limit(0), model).count() == 0
