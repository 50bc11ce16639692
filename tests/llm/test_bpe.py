"""Two-tier BPE against tiktoken, and back."""

import base64

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from aerocast.llm import bpe
from tests.llm.awkward import TEXTS, documents, empty_documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def raw():
    with open(RANKS, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def known(raw):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_the_hash_is_minimal_and_perfect(raw):
    coder, words = bpe.encoder(raw, PATTERN), list(bpe.read_ranks(raw))
    assert sorted(coder.whole.key_at.tolist()) == list(range(len(words)))
    assert coder.whole.candidates(words) == list(range(len(words)))


def test_all_characters(raw, known):
    coder = bpe.encoder(raw, PATTERN)
    points = [i for i in range(0, 0x30000, 7) if not 0xD800 <= i < 0xE000]
    texts = [f"x{chr(i)}y 1{chr(i)}2 {chr(i)}{chr(i)}  {chr(i)}!" for i in points]
    assert [x.tolist() for x in coder.encode(texts)] == [known.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text(raw, known, text):
    (ids,) = bpe.encoder(raw, PATTERN).encode([text])
    assert ids.tolist() == known.encode_ordinary(text)
    assert b"".join(bpe.token_bytes(raw)[i] for i in ids) == text.encode()


def test_documents_round_trip(spark, known):
    encoded = bpe.encode_documents(documents(spark), RANKS, PATTERN)
    rows = bpe.decode_documents(encoded, RANKS).collect()
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        text = "a text without an id" if r["doc_id"] is None else TEXTS[r["doc_id"]] or ""
        assert r["ids"] == known.encode_ordinary(text)
        assert bytes(r["decoded"]).decode() == text


def test_small_memory_changes_nothing(raw, known, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 3)
    coder = bpe.Encoder(raw, PATTERN)
    for text in TEXTS[3:]:
        assert coder.encode([text])[0].tolist() == known.encode_ordinary(text)


def test_empty_table(spark):
    assert bpe.decode_documents(bpe.encode_documents(empty_documents(spark), RANKS, PATTERN), RANKS).count() == 0
