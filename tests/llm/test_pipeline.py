"""Pipeline: every stage on what the one before kept, against brute force."""

import numpy as np
import pytest

import corpus_pipeline
from aerocast.llm.importance import fit_ratios, resample
from aerocast.llm.toxicity import train_toxicity
from tests.llm.awkward import documents, empty_documents
from tests.llm.test_bagminhash import groups
from tests.llm.test_substrings import walked


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean, junk and toxic texts, near copies and a shared passage, beside awkward rows."""
    rng = np.random.default_rng(12)
    words = [f"word{i}" for i in range(500)]
    passage = " ".join(f"shared{i}" for i in range(60))
    rows, labels = [], []
    for i in range(600):
        picked = rng.choice(words, int(rng.integers(40, 120))).tolist()
        junk, toxic = i % 9 == 0, i % 7 == 3
        if toxic:
            picked[5:5] = ["horrible-insult", "vile-insult"]
        if junk:
            picked = [w.upper() + "!!" for w in picked]
        text = " ".join(picked)
        if i % 10 == 4:
            text = f"{text} {passage}"
        if i % 11 == 5 and rows:
            text = rows[-3][1] + " tail"
            junk, toxic = labels[-3][1] == 0, labels[-3][2] == 1
        rows.append((1000 + i, text))
        labels.append((1000 + i, int(not junk), int(toxic)))
    odd = documents(spark)
    extra = odd.drop("doc_id", "text").distinct().limit(1).collect()[0]
    more = spark.createDataFrame([(*r, *extra) for r in rows], odd.schema)
    path = str(tmp_path_factory.mktemp("tables"))
    odd.unionByName(more).write.parquet(f"{path}/documents.parquet")
    marked = [*labels, (3, 1, 0), (5, 1, 0), (6, None, None), (None, 1, 0)]
    spark.createDataFrame(marked, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, {i: (q, t) for i, q, t in labels}


def test_stages(spark, folder):
    path, marks = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "toxicity", "near_duplicates", "substrings", "packing"]

    clean = steps["quality"](spark, docs, path)
    drawn = resample(docs, fit_ratios(docs, labels)).filter("selected")
    assert clean.columns == docs.columns
    assert sorted(str(r[0]) for r in clean.select("doc_id").collect()) == sorted(str(r[0]) for r in drawn.select("doc_id").collect())
    kept = {r[0] for r in clean.select("doc_id").collect()}
    good = [i for i, (q, _) in marks.items() if q]
    assert sum(i in kept for i in good) > 0.98 * len(good)
    assert sum(i in kept for i, (q, _) in marks.items() if not q) == 0

    civil = steps["toxicity"](spark, clean, path)
    machine = train_toxicity(clean, labels)
    rows = clean.collect()
    scores = machine.score([None if r["text"] is None else r["text"].encode() for r in rows])
    assert sorted(str(r["doc_id"]) for r, s in zip(rows, scores) if s < 0.5) == sorted(str(r[0]) for r in civil.select("doc_id").collect())
    left = {r[0] for r in civil.select("doc_id").collect()}
    assert not any(i in left for i, (_, t) in marks.items() if t)

    single = steps["near_duplicates"](spark, civil, path)
    before = sorted({(r["doc_id"], r["text"]) for r in civil.collect() if r["doc_id"] is not None}, key=lambda r: r[0])
    first = groups([t for _, t in before])
    want = {before[c][0] for c in set(first)}
    assert {r[0] for r in single.select("doc_id").collect() if r[0] is not None} == want
    assert single.schema == civil.schema

    cut = steps["substrings"](spark, single, path)
    rows = sorted([(r["doc_id"], r["text"]) for r in single.collect() if r["doc_id"] is not None], key=lambda r: r[0])
    rows = list(dict.fromkeys(rows))
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect()}
    for (i, text), (_, removed, joined) in zip(rows, walked([t for _, t in rows])):
        assert texts[i][0] == (joined if removed else text)
        assert texts[i][1] == (None if texts[i][0] is None else str(len(texts[i][0])))
    assert any(n for _, n, _ in walked([t for _, t in rows]))

    packed = steps["packing"](spark, cut, path).toPandas()
    assert set(packed.doc_id.dropna()) == {r[0] for r in cut.select("doc_id").collect() if r[0] is not None}


def test_run_equals_the_stages_in_turn(spark, folder):
    path, _ = folder
    out = corpus_pipeline.run(spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    digests = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert out.select(digests).exceptAll(docs.select(digests)).isEmpty() and out.count() == docs.count() > 0


def test_empty_documents(spark, folder, tmp_path):
    path, _ = folder
    docs = empty_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        assert docs.count() == 0, name
