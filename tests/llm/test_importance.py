"""Importance resampling: weights, draws and odd input."""

import numpy as np
import pytest

from aerocast.llm import importance as im
from tests.llm.awkward import documents, empty_documents


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(9)
    words = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(800):
        picked = rng.choice(words, int(rng.integers(5, 120))).tolist()
        junk = i % 8 == 0
        if junk:
            picked = [w.upper() + "!!" for w in picked] if i % 16 else [picked[0]] * len(picked)
        rows.append((i, " ".join(picked), int(not junk)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(4)


def test_junk_goes_and_clean_texts_stay(corpus):
    labels = corpus.select("doc_id", "quality").filter("doc_id % 3 = 0")
    out = im.resample(corpus, im.fit_ratios(corpus, labels)).join(corpus.select("doc_id", "quality"), "doc_id").toPandas()
    assert out[out.quality == 1].selected.mean() > 0.99
    assert out[out.quality == 0].selected.mean() < 0.05


def test_the_draw_is_of_the_size_and_repeatable(corpus):
    ratios = im.fit_ratios(corpus, corpus.select("doc_id", "quality"))
    for k in (0, 1, 250, 800, 900):
        out = im.resample(corpus, ratios, k)
        assert out.filter("selected").count() == min(k, 800)
    one = im.resample(corpus, ratios, 250).filter("selected").select("doc_id")
    two = im.resample(corpus.repartition(9), ratios, 250).filter("selected").select("doc_id")
    assert one.exceptAll(two).isEmpty()
    kept = im.keep_selected(corpus, ratios, 250)
    assert kept.columns == corpus.columns and kept.select("doc_id").exceptAll(one).isEmpty() and kept.count() == 250


def test_noise_is_gumbel():
    ratios = im.Ratios(np.zeros(im.BUCKETS))
    noise = ratios.keys(np.zeros(20000), np.arange(20000))
    assert noise.mean() == pytest.approx(0.5772, abs=0.05) and noise.std() == pytest.approx(np.pi / np.sqrt(6), abs=0.05)


@pytest.mark.parametrize("k", [1, 2, 17, 499, 500])
def test_kth_largest(spark, k):
    values = np.round(np.random.default_rng(k).normal(size=500) ** 3, 2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert im.kth_largest(df, "v", k) in (sorted(values)[-k], float("-inf") if k == 500 else None)


def test_no_labels_and_odd_rows(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    ratios = im.fit_ratios(docs, none)
    assert not ratios.logs.any()
    out = im.resample(docs, ratios)
    assert out.count() == docs.count() and out.filter("selected").count() == docs.count()
    good = spark.createDataFrame([(5, 1), (6, 1), (None, 1), (3, None), (9, 0)], "doc_id long, quality int")
    ratios = im.fit_ratios(docs, good)
    scored = im.resample(docs, ratios).toPandas()
    assert scored.log_weight.notna().all() and (scored[scored.doc_id.isin([0, 1, 2])].log_weight == 0).all()
    assert im.keep_selected(docs, ratios).columns == docs.columns
    empty = empty_documents(spark)
    assert im.resample(empty, im.fit_ratios(empty, good)).count() == 0
    assert im.keep_selected(empty, ratios).count() == 0
