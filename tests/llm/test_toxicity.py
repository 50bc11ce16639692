"""Factorization machine: learning, folds and odd input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerocast.llm import toxicity as tx
from tests.llm.awkward import TEXTS, documents, empty_documents


@pytest.fixture(scope="module")
def corpus(spark):
    """Insults make a text toxic; a mild word does so only beside a group word."""
    rng = np.random.default_rng(5)
    filler = [f"word{i}" for i in range(400)]
    rows = []
    for i in range(900):
        words = rng.choice(filler, 30).tolist()
        kind = i % 6
        if kind == 0:
            words.insert(3, "Nastyish,")
        if kind in (1, 2):
            words.insert(5, "mild")
        if kind in (2, 3):
            words.insert(9, "people!")
        rows.append((i, " ".join(words), int(kind in (0, 2))))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)


def test_learns_words_and_pairs(corpus):
    machine = tx.train_toxicity(corpus.select("doc_id", "text"), corpus.select("doc_id", "toxic"))
    scored = tx.score_toxicity(corpus, machine).join(corpus.select("doc_id", "toxic"), "doc_id")
    held = scored.filter(tx.is_held_out(F.col("doc_id"))).toPandas()
    assert 120 < len(held) < 240 and (held.predicted == held.toxic).mean() > 0.95
    assert held.score.between(0, 1).all()


def test_beginnings_stand_for_other_endings(spark, corpus):
    machine = tx.train_toxicity(corpus.select("doc_id", "text"), corpus.select("doc_id", "toxic"))
    assert machine.score([b"quite nastyishly said", b"quite nicely said"])[0] > 0.5


def test_held_out_rows_and_labels_do_not_count(corpus):
    """Labels of the held-out fold can be anything without changing a score."""
    labels = corpus.select("doc_id", "toxic")
    wrong = labels.withColumn("toxic", F.when(tx.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (tx.train_toxicity(corpus.select("doc_id", "text"), x) for x in (labels, wrong))
    assert (one.terms == two.terms).all() and np.allclose(one.weights, two.weights) and one.bias == two.bias
    ids = [r[0] for r in labels.filter(tx.is_held_out(F.col("doc_id"))).select("doc_id").collect()]
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in ids)


def test_sample_is_bounded_and_repeatable(corpus):
    some = tx.labelled_sample(corpus, "toxic", 40)
    again = tx.labelled_sample(corpus.repartition(7), "toxic", 40)
    assert some.groupBy("label").count().filter("count <> 40").isEmpty()
    assert some.exceptAll(again).isEmpty()


def test_odd_rows(spark, corpus):
    machine = tx.train_toxicity(corpus.select("doc_id", "text"), corpus.select("doc_id", "toxic"))
    docs = documents(spark)
    scored = tx.score_toxicity(docs, machine).toPandas()
    assert len(scored) == len(TEXTS) + 3 and scored.score.notna().all()
    assert scored[scored.doc_id.isin([0, 1, 2])].score.nunique() == 1
    kept = tx.drop_toxic(docs, machine)
    assert kept.columns == docs.columns and kept.count() == (scored.predicted == 0).sum()
    assert tx.score_toxicity(empty_documents(spark), machine).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1), (2, None), (None, 1)]])
def test_one_class_or_no_labels(spark, labels):
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = tx.train_toxicity(documents(spark), table)
    assert len(set(machine.score([b"a", b"b c", None]).round(9))) == 1


def test_learns_pairs_of_terms_that_tell_nothing_alone(spark):
    """Toxic if an insult and a group word are both there or both missing: no single term tells the classes apart."""
    rng = np.random.default_rng(1)
    filler, rows = [f"word{i}" for i in range(400)], []
    for i in range(4000):
        words, (one, two) = rng.choice(filler, 30).tolist(), rng.integers(0, 2, 2).tolist()
        words += ["dirt"] * one + ["people"] * two
        rows.append((i, " ".join(rng.permutation(words)), int(one == two)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    machine = tx.train_toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    scored = tx.score_toxicity(docs, machine).join(docs.select("doc_id", "toxic"), "doc_id")
    held = scored.filter(tx.is_held_out(F.col("doc_id"))).toPandas()
    assert len(held) > 700 and (held.predicted == held.toxic).mean() > 0.95


def test_score_is_a_double_loop_over_pairs(corpus):
    machine = tx.train_toxicity(corpus.select("doc_id", "text"), corpus.select("doc_id", "toxic"))
    texts = [r["text"].encode() for r in corpus.limit(20).collect()]
    for found, got in zip(tx.term_sets(texts), machine.score(texts)):
        at = [i for i, t in enumerate(machine.terms) if t in found]
        margin = machine.bias + sum(machine.weights[i] for i in at)
        margin += sum(machine.factors[i] @ machine.factors[j] for n, i in enumerate(at) for j in at[n + 1 :])
        assert got == pytest.approx(1 / (1 + np.exp(-margin)))


def test_pairs_against_plain_counts():
    """The pairs found are those of a plain loop over all pairs of common terms."""
    rng = np.random.default_rng(3)
    rows = [np.flatnonzero(rng.random(700) < 0.08).astype(np.int32) for _ in range(600)]
    rows = [np.unique(np.append(r, [3, 650] if i % 4 == 0 else [])).astype(np.int32) for i, r in enumerate(rows)]
    labels, chances = np.array([float(i % 4 == 0) for i in range(600)]), np.full(600, 0.25)
    sets, bound, want = [set(r.tolist()) for r in rows], 0, set()
    common = [t for t in range(700) if sum(t in s for s in sets) >= 12]
    bound = 2 * np.log(len(common) * (len(common) - 1) // 2 / tx.PAIR_CHANCE)
    for n, a in enumerate(common):
        with_a = [i for i, s in enumerate(sets) if a in s]
        for b in common[n + 1 :]:
            both = [i for i in with_a if b in sets[i]]
            if len(both) >= 12 and sum(labels[both] - 0.25) ** 2 >= bound * len(both) * 0.1875:
                want |= {a, b}
    assert {3, 650} <= want and tx.pair_terms(rows, labels, chances).tolist() == sorted(want)
