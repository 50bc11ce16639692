"""Alignment against a plain loop over tokens, and its sums against all pairs of documents."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from aerocast.llm.alignment import align_corpus, align_documents
from tests.llm.awkward import TEXTS, documents, empty_documents

LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EXTRA = [
    "a <|endoftext|> b<|endoftext|><|endoftext|>",
    "<s> </s> <unk> <0x41> plain",
    "a lower one eighth block ▁ in it",
    "line\n\n\n  two\r\n\ttabs\x00zero",
    " starts with a blank",
    "ภาษาไทย \U0001f468‍\U0001f469‍\U0001f467 é ﬁ",
    "12345 67 8 9,000.00 don't can't we'll",
]
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def libraries():
    left = Tokenizer.from_file(LEFT)
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=RIGHT)


def stand_ins():
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def slow_alignment(libraries, text):
    """Tokens, groups and links of one text by comparing byte ranges."""
    left, right = libraries
    if not text:
        return [], [], [], []
    of = stand_ins()
    a = [(i, bytes(of[c] for c in left.id_to_token(i))) for i in left.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in right.encode(text):
        piece = right.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if right.is_byte(i) else piece.replace("▁", " ").encode()))
    wanted = (" " + text).encode()
    if b"".join(t for _, t in a) != wanted or b"".join(t for _, t in b) != wanted:
        return [], [], [], []
    spans = []
    for tokens in (a, b):
        at, out = 0, []
        for i, t in tokens:
            out.append((i, at, at + len(t)))
            at += len(t)
        spans.append(out)
    ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
    groups, begin = [], 0
    for end in ends:
        inside = [",".join(str(i) for i, s, e in side if begin < e <= end) for side in spans]
        groups.append("|".join(inside))
        begin = end
    links, j = [], 0
    for i, s, e in spans[0]:
        while j and spans[1][j - 1][2] > s:
            j -= 1
        while j < len(spans[1]) and spans[1][j][1] < e:
            if spans[1][j][2] > s:
                links.append((i, spans[1][j][0]))
            j += 1
    return a, b, groups, links


def expected(libraries, rows):
    aligned = [(doc_id, *slow_alignment(libraries, text)) for doc_id, text in rows]
    held = Counter(pair for *_, links in aligned for pair in set(links))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for doc_id, a, b, groups, links in aligned:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(held[x] == most[x[0]] for x in links)
        out.append((doc_id, len(a), len(b), len(groups), len(links), digest, best, sum(held[x] for x in links)))
    return sorted(out, key=repr)


def short(rows):
    """The slow loop compares byte ranges; the longest texts are cut for it alone."""
    return [(i, t if t is None else t[:3000]) for i, t in rows]


def test_every_column(spark, libraries):
    rows = short(list(enumerate(TEXTS + EXTRA)) + [(None, "no id here"), (3, "another text of id 3"), (3, "another text of id 3")])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for block in (1_000_000, 40):
        out = align_corpus(docs, LEFT, RIGHT, PATTERN, block=block).collect()
        assert sorted((tuple(r) for r in out), key=repr) == expected(libraries, rows)


def test_extra_columns_long_texts_and_no_rows(spark):
    out = align_corpus(documents(spark), LEFT, RIGHT, PATTERN)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert out.count() == documents(spark).count() and out.filter("n_links > 60000").count() >= 2
    assert align_corpus(empty_documents(spark), LEFT, RIGHT, PATTERN).count() == 0


def test_pairs_add_up(spark):
    for r in align_documents(documents(spark), LEFT, RIGHT, PATTERN).collect():
        assert sum(r.times) == r.n_links == max(0, r.n_a + r.n_b - r.n_groups) and len(set(r.pairs)) == len(r.pairs)
