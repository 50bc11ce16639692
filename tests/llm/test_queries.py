"""Registered queries on the smallest tables: SQL where there is one, contracts where there is none."""

import base64
import hashlib
import math
import zlib
from collections import Counter
from pathlib import Path

import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from __spark_entry__ import oracle_sql, queries
from aerocast.llm.queries import ORACLE, QUERIES
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def texts():
    frame = pd.read_parquet(f"{SF}/documents.parquet")
    return dict(zip(frame.doc_id, frame.text))


def run(spark, name):
    return QUERIES[name](spark, SF).toPandas()


def test_all_are_registered():
    assert set(QUERIES) < set(queries()) and set(ORACLE) <= set(oracle_sql()) and "pipeline" in queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    ok, note = compare(QUERIES[name](spark, SF), connect(SF), ORACLE[name])
    assert ok, note


def test_packing(spark, texts):
    out = run(spark, "op1_harmonic_packing")
    assert set(out.doc_id) == set(texts)
    assert (out.groupby("doc_id").length.sum() == out.groupby("doc_id").doc_tokens.first()).all()
    fills = out.groupby("sequence_id").length.sum()
    assert sum(1024 - n for n in fills if n & (n - 1)) < 0.02 * fills.sum()


def test_encoding(spark, texts):
    raw = Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in run(spark, "op2_two_tier_bpe").itertuples():
        ids, text = known.encode_ordinary(texts[r.doc_id]), texts[r.doc_id].encode()
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(text).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_toxicity(spark, texts):
    out = run(spark, "op3_toxicity_machine")
    assert set(out.doc_id) == set(texts) and out.score.between(0, 1).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    assert (out.predicted == (out.score >= 0.5)).all()


def test_shards(spark, texts):
    out = run(spark, "op4_kd_shards")
    assert sorted(out["shard"].unique()) == list(range(40)) and len(out) == len(texts)
    assert (out["size"] == [len(texts[i].encode()) + 16 for i in out.doc_id]).all()


def test_language_model(spark, texts):
    out = run(spark, "op7_log_bilinear").set_index("doc_id")
    lowered = {i: [w.translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))) for w in t.encode().split()] + [None] for i, t in texts.items()}
    train = Counter(w for i, ws in lowered.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    total, distinct = sum(train.values()), len(train)
    for i, ws in lowered.items():
        r = out.loc[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(w in train for w in ws), total)
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in ws))
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2) and r.score < 0


def test_quality(spark, texts):
    out = run(spark, "op10_importance_resampling")
    labels = pd.read_parquet(f"{SF}/labels.parquet").merge(out, on="doc_id")
    assert set(out.doc_id) == set(texts) and labels[labels.quality == 1].kept.mean() > 0.95


def test_alignment(spark, texts):
    out = run(spark, "op11_token_alignment").set_index("doc_id")
    assert set(out.index) == set(texts) and (out.n_links >= out.n_best).all() and (out.count_sum >= out.n_links).all()
    left = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    given_back = out[out.n_a > 0]
    assert len(given_back) > 0.9 * len(out)
    for i, r in given_back.iterrows():
        assert r.n_a == len(left.encode(" " + texts[i], add_special_tokens=False).ids) and r.n_links == r.n_a + r.n_b - r.n_groups
