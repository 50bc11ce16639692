"""Packing: classes, placement and digests."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aerocast.llm import packing
from aerocast.session import materialise
from tests.llm.awkward import TEXTS, documents, empty_documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def packed(spark):
    return packing.pack_documents(documents(spark), RANKS, public_tokenizers.PATTERN).toPandas()


def test_every_rest_is_cut_into_class_lengths():
    lengths, plans = set(packing.class_lengths()), packing.cuts_of_rest()
    assert all(sum(p) == n and set(p) <= lengths for n, p in enumerate(plans))
    assert max(map(len, plans)) <= 5
    assert sum(1024 // s - 1 for s in lengths) <= 4650


def test_ids_are_those_of_the_tokenizer(packed):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc_id, text in enumerate(TEXTS):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        rows = packed[packed.doc_id == doc_id].drop_duplicates(["start", "length"]).sort_values("start")
        assert (rows.doc_tokens == len(ids)).all() and rows.length.sum() == len(ids)
        assert rows.start.tolist() == [0, *np.cumsum(rows.length)[:-1]]
        for r in rows.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


def test_very_long_blanks(spark):
    text = "a" + " " * 1_200_000 + "b"
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = packing.cut_documents(df, RANKS, public_tokenizers.PATTERN).toPandas().sort_values("start")
    assert rows.doc_tokens.unique().tolist() == [len(want)]
    assert rows.ids_crc32.tolist() == [zlib.crc32(want[s : s + n].tobytes()) for s, n in zip(rows.start, rows.length)]


def test_added_tokens_in_texts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, added = Tokenizer.from_file(path), packing.added_tokens(path)
    assert added == {"<|endoftext|>": 50256}
    texts = []
    for token in added:
        texts += [token, f"{token} start", f"in the {token} middle", f"end {token}", f"{token}{token} twice{token}", token[:-1], f"a{token}\n\n b"]
    texts.append("x" + " " * 1_200_000 + "<|endoftext|> y<|endoftext|>")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.cut_documents(df, RANKS, public_tokenizers.PATTERN, added=added).toPandas()
    for doc_id, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        mine = rows[rows.doc_id == doc_id].sort_values("start")
        assert mine.doc_tokens.unique().tolist() == [len(ids)]
        assert mine.ids_crc32.tolist() == [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(mine.start, mine.length)]


def test_sequences_are_gapless_and_full(packed):
    assert len(packed[packed.doc_id == 5]) == 3 * len(packed[packed.doc_id == 6])
    assert packed.doc_id.isna().sum() > 0
    fills = []
    for _, rows in packed.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length)[:-1]]
        fills.append(rows.length.sum())
    assert max(fills) <= 1024
    assert sum(1024 - n for n in fills if n & (n - 1)) <= 0.02 * sum(fills) + 1024


def test_many_documents_waste_little(spark):
    lengths = np.random.default_rng(3).integers(1, 5000, 800).tolist()
    rows = [(i, s, c, 0, n) for i, n in enumerate(lengths) for s, c in zip(np.cumsum([0, *_cut(n)]).tolist(), _cut(n))]
    pieces = materialise(spark.createDataFrame(rows, packing.PIECES.replace("ids_crc32 long, doc_tokens", "ids_crc32 long, doc_tokens")), "pieces")
    out = packing.harmonic_pack(pieces).toPandas()
    fills = out.groupby("sequence_id").length.sum()
    assert len(out) == len(rows) and out.groupby(["sequence_id", "offset"]).size().max() == 1
    assert sum(1024 - n for n in fills if n & (n - 1)) < 0.005 * fills.sum()


def _cut(n):
    return [1024] * (n // 1024) + list(packing.cuts_of_rest()[n % 1024])


def test_token_arrays_of_sequences(spark):
    pieces = materialise(packing.cut_documents(documents(spark), RANKS, public_tokenizers.PATTERN, keep_ids=True), "pieces")
    arrays = packing.sequences(packing.harmonic_pack(pieces)).toPandas()
    sizes = arrays.ids.map(len)
    assert sizes.isin([1024, *(2**i for i in range(10))]).all()
    assert sum(sizes) >= pieces.selectExpr("sum(length)").first()[0]


def test_empty_table(spark):
    assert packing.pack_documents(empty_documents(spark), RANKS, public_tokenizers.PATTERN).count() == 0
