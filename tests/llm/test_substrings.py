"""Substring dedup against a walk over all windows."""

import numpy as np
import pytest

from aerocast.llm import substrings as ss
from tests.llm.awkward import BASE, TEXTS, documents, empty_documents


def walked(texts, length=20):
    """(words, removed, kept) of texts in the order of their ids."""
    seen, out = set(), []
    for text in texts:
        words = (text or "").encode().split()
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                gone[i : i + length] = True
            seen.add(window)
        out.append((len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return out


def check(spark, texts, parts=5, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    got = ss.remove_repeats(df, **options).toPandas().sort_values("doc_id")
    want = walked(texts, options.get("length", 20))
    assert list(zip(got.n_words, got.n_removed, got.text)) == want
    return sum(w[1] for w in want)


@pytest.mark.parametrize("seed,vocabulary", [(0, 4000), (1, 40), (2, 3)])
def test_shared_passages(spark, seed, vocabulary):
    rng = np.random.default_rng(seed)
    words = [f"v{i}" for i in range(vocabulary)]
    passages = [rng.choice(words, n).tolist() for n in (19, 20, 21, 35, 80, 200)]
    texts = []
    for _ in range(120):
        text = rng.choice(words, int(rng.integers(0, 150))).tolist()
        for at in rng.integers(0, len(passages), int(rng.integers(0, 4))):
            begin, end = sorted(rng.integers(0, len(passages[at]) + 1, 2)) if rng.random() < 0.5 else (0, len(passages[at]))
            place = int(rng.integers(0, len(text) + 1))
            text[place:place] = passages[at][begin:end]
        texts.append(" ".join(text))
    texts += texts[:10]
    assert check(spark, texts) > 1000


def test_repeats_inside_one_text_and_overlaps(spark):
    one = " ".join(f"a{i}" for i in range(30))
    texts = [f"{one} {one}", "b " + one, one + " c", "x " * 100, "x " * 21, "x " * 19]
    assert check(spark, texts, parts=2) > 0


def test_other_lengths(spark):
    texts = ["a b c d e f g h", "x c d e f y", "c d e", "a b c d e f g h"]
    assert check(spark, texts, length=3, seed=2) == 4 + 3 + 8
    assert check(spark, texts, length=4, seed=4) == 4 + 8


def test_odd_rows(spark):
    docs = documents(spark)
    out = ss.remove_repeats(docs).toPandas()
    assert len(out) == docs.count()
    by_id = out[out.doc_id.notna()].drop_duplicates().sort_values("doc_id")
    assert list(zip(by_id.n_words, by_id.n_removed, by_id.text)) == walked(TEXTS)
    assert out[out.doc_id.isna()].text.tolist() == ["a text without an id"]
    assert ss.remove_repeats(empty_documents(spark)).count() == 0


def test_texts_that_share_an_id(spark):
    """They are documents of their own, in one order; a passage of all stays in the first alone."""
    whole = " ".join(f"u{i}" for i in range(5000))
    rows = [(7, "short"), (7, whole), (7, BASE + " tail"), (7, BASE + " tail"), (2, BASE), (None, BASE), (9, None), (9, BASE + " nine")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, number int").repartition(3)
    out = [(r.doc_id, r.n_words, r.n_removed) for r in ss.remove_repeats(docs).collect()]
    n = len(BASE.split())
    want = [(7, 1, 0), (7, 5000, 0), (7, n + 1, n), (7, n + 1, n), (2, n, 0), (None, n, 0), (9, 0, 0), (9, n + 1, n)]
    assert sorted(out, key=repr) == sorted(want, key=repr)
    replaced = ss.replace_texts(docs)
    assert replaced.schema == docs.schema
    texts = sorted(((r.doc_id, r.text) for r in replaced.collect()), key=repr)
    want = [(7, "short"), (7, whole), (7, "tail"), (7, "tail"), (2, BASE), (None, BASE), (9, None), (9, "nine")]
    assert texts == sorted(want, key=repr)


def test_replaced_texts_keep_all_else(spark):
    docs = documents(spark, repeat_rows=False)
    out = ss.replace_texts(docs)
    assert out.schema == docs.schema
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    for i, (_, removed, kept) in enumerate(walked(TEXTS)):
        assert texts[i] == (kept if removed else TEXTS[i])
