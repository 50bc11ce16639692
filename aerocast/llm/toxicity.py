"""Toxicity by a factorization machine over hashed terms.

A text is the set of its lower-case words, split at white space and ASCII punctuation, and of their
beginnings of four and five bytes, which stand for inflected forms; all are hashed to 64 bits. The
machine adds a bias, a weight per term and, for every pair of terms in a text, the
inner product of their factors, so that terms can be toxic together that are not so alone.

The machine learns every term that tells the classes apart alone, and every common term of a pair
that tells apart what a first machine over the former leaves open. No number of terms is set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocast.llm.words import PUNCTUATION, SPACE, Words, chunks, hash_spans, mix, slices, split_words
from aerocast.session import materialise

#: Most labelled rows of each class that the fit reads: those with the smallest hashes of their id.
SAMPLE_PER_CLASS = 4000
#: Terms need this chi-square against the label (one in a thousand by chance) and this many texts.
LEAST_CHI_SQUARE = 10.83
LEAST_TEXTS = 3
#: Share of the texts of the fit that hold a pair of terms for the pair to be tested.
PAIR_SHARE = 0.02
#: Chance that any pair is taken without a cause, and terms whose pairs are tested at once.
PAIR_CHANCE = 0.001
PAIR_BLOCK = 512
FACTORS = 8
EPOCHS = 60
FOLDS = 5
SEPARATORS = SPACE | PUNCTUATION
BEGINNINGS = (4, 5)


def is_held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text divisible by the number of folds."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def term_hashes(words: Words) -> Iterator[np.ndarray]:
    """Arrays of one term hash per word: the word itself, then its beginnings, salted by their length."""
    yield words.hashes()
    for n in BEGINNINGS:
        yield mix(hash_spans(words.data, words.starts, np.minimum(words.starts + n, words.ends)) + np.uint64(n))


def term_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """Sorted distinct term hashes of each text."""
    out = []
    for part in chunks(texts):
        words = split_words(texts[part], SEPARATORS, lower=True)
        kinds = list(term_hashes(words))
        out += [np.unique(np.concatenate([h[a:b] for h in kinds])) for a, b in zip(words.first[:-1], words.first[1:])]
    return out


def labelled_sample(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """A bounded, repeatable sample of labelled ids outside the held-out fold.

    Labels other than 0 and 1 and null ids are not used; an id with both labels counts as 1.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    zero, one = (known.filter(F.col("label") == v).orderBy(*order).limit(per_class) for v in (0, 1))
    return zero.unionByName(one)


@dataclass
class Machine:
    """Terms by hash, their weights and factors."""

    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        """Probability of label 1 for each whole text."""
        out = np.empty(len(texts))
        for part in chunks(texts):
            words = split_words(texts[part], SEPARATORS, lower=True)
            n = part.stop - part.start
            found = [np.zeros(0, np.int64)]
            for hashes in term_hashes(words) if len(self.terms) else ():
                at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
                hit = np.flatnonzero(self.terms[at] == hashes)
                owner = np.searchsorted(words.first, hit, side="right") - 1
                found.append(owner * len(self.terms) + at[hit])
            text, term = np.divmod(np.unique(np.concatenate(found)), max(1, len(self.terms)))
            out[part] = 1 / (1 + np.exp(-np.clip(self._margins(text, term, n), -50, 50)))
        return out

    def _margins(self, text: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        margin = self.bias + np.bincount(text, self.weights[term], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f]
            margin += 0.5 * (np.bincount(text, v, n) ** 2 - np.bincount(text, v * v, n))
        return margin


def fit_machine(terms: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, share_of_ones: float) -> Machine:
    """Logistic loss by AdaGrad over texts given as places in ``terms``.

    ``share_of_ones`` is that of all labelled rows; it corrects the bias for the sample's own share.
    With one class or no rows the machine gives that share, or almost 0, to every text.
    """
    none, labels = np.zeros(0), np.asarray(labels, float)
    if not len(labels) or labels.min() == labels.max():
        share = min(max(share_of_ones, 1e-6), 1 - 1e-6)
        return Machine(none.astype(np.uint64), none, np.zeros((0, FACTORS)), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(11)
    weights, factors = np.zeros(len(terms)), rng.normal(0, 0.01, (len(terms), FACTORS))
    share = labels.mean()
    bias = float(np.log(share / (1 - share)))
    sums = [1e-8, np.full(len(terms), 1e-8), np.full(factors.shape, 1e-8)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for begin in range(0, len(order), 64):
            batch = order[begin : begin + 64]
            text = np.repeat(np.arange(len(batch)), [len(rows[i]) for i in batch])
            term = np.concatenate([rows[i] for i in batch]).astype(np.int64)
            v = factors[term]
            total = np.zeros((len(batch), FACTORS))
            np.add.at(total, text, v)
            square = np.bincount(text, (v * v).sum(1), len(batch))
            margin = bias + np.bincount(text, weights[term], len(batch)) + 0.5 * ((total**2).sum(1) - square)
            slope = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels[batch]) / len(batch)
            used, place = np.unique(term, return_inverse=True)
            by_weight = np.bincount(place, slope[text], len(used)) + 1e-4 * weights[used]
            by_factor = np.zeros((len(used), FACTORS))
            np.add.at(by_factor, place, slope[text][:, None] * (total[text] - v))
            by_factor += 1e-4 * factors[used]
            sums[0] += slope.sum() ** 2
            sums[1][used] += by_weight**2
            sums[2][used] += by_factor**2
            bias -= 0.1 * slope.sum() / np.sqrt(sums[0])
            weights[used] -= 0.2 * by_weight / np.sqrt(sums[1][used])
            factors[used] -= 0.05 * by_factor / np.sqrt(sums[2][used])
    true = min(max(share_of_ones, 1e-6), 1 - 1e-6)
    bias += float(np.log(true / (1 - true)) - np.log(share / (1 - share)))
    return Machine(terms, weights, factors, bias)


def choose_terms(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the terms that tell the classes of ``terms, label`` apart, and of the common ones, and which do the former."""
    total = sets.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
    if not total["n"] or total["ones"] in (0, total["n"]):
        return np.zeros(0, np.uint64), np.zeros(0, bool)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.frombuffer(t, np.int64) for t in batch.column(0).to_pylist()]
            labels = np.repeat(batch.column(1).to_numpy(), [len(t) for t in found])
            terms, index = np.unique(np.concatenate(found), return_inverse=True)
            ones, both = (np.bincount(index, w, len(terms)).astype(np.int64) for w in (labels, None))
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(ones), pa.array(both)], names=["term", "ones", "n"])

    counted = sets.select("terms", "label").mapInArrow(count, "term long, ones long, n long")
    counted = counted.groupBy("term").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"))
    share = total["ones"] / total["n"]
    spread = F.col("n") * F.lit(share * (1 - share)) * (1 - F.col("n") / F.lit(total["n"]))
    chi = F.when(spread > 0, (F.col("ones") - F.col("n") * F.lit(share)) ** 2 / spread)
    counted = counted.filter(F.col("n") >= LEAST_TEXTS).withColumn("told", F.coalesce(chi >= LEAST_CHI_SQUARE, F.lit(False)))
    found = counted.filter(F.col("told") | (F.col("n") >= F.lit(PAIR_SHARE * total["n"]))).select("term", "told").toArrow()
    terms, told = (found.column(c).to_numpy() for c in ("term", "told"))
    order = np.argsort(terms.view(np.uint64))
    return terms.view(np.uint64)[order], told[order]


def pair_terms(rows: list[np.ndarray], labels: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Sorted places of the terms that are in a pair that tells apart what the chances of label 1 leave open.

    A pair's labels are compared with the sum of their chances; the normal bound is such that among
    all pairs one is taken without a cause with PAIR_CHANCE at most.
    """
    n = len(rows)
    flat, text = np.concatenate(rows).astype(np.int64), np.repeat(np.arange(n), [len(r) for r in rows])
    common, place = np.unique(flat, return_inverse=True)
    kept = np.bincount(place, minlength=len(common)) >= PAIR_SHARE * n
    at = (np.cumsum(kept) - 1)[place]
    text, at, common = text[kept[place]], at[kept[place]], common[kept]
    order = np.argsort(at, kind="stable")
    text, at = text[order], at[order]
    borders = np.searchsorted(at, np.arange(0, len(common) + PAIR_BLOCK, PAIR_BLOCK))
    bound = 2 * np.log(max(1, len(common) * (len(common) - 1) // 2) / PAIR_CHANCE)
    rest, spread = (labels - chances).astype(np.float32), np.maximum(chances * (1 - chances), 0.01).astype(np.float32)

    def block(i: int) -> np.ndarray:
        out = np.zeros((n, min(PAIR_BLOCK, len(common) - i * PAIR_BLOCK)), np.float32)
        out[text[borders[i] : borders[i + 1]], at[borders[i] : borders[i + 1]] - i * PAIR_BLOCK] = 1
        return out

    telling = np.zeros(len(common), bool)
    for i in range(len(borders) - 1):
        one = block(i)
        sums = [one.T.copy(), one.T * rest, one.T * spread]
        for j in range(i, len(borders) - 1):
            two = one if i == j else block(j)
            times, left, variance = (x @ two for x in sums)
            hit = (times >= PAIR_SHARE * n) & (left * left >= bound * variance)
            if i == j:
                np.fill_diagonal(hit, False)
            telling[i * PAIR_BLOCK : i * PAIR_BLOCK + len(hit)] |= hit.any(1)
            telling[j * PAIR_BLOCK : j * PAIR_BLOCK + hit.shape[1]] |= hit.any(0)
    return common[telling]


def fit_with_pairs(terms: np.ndarray, told: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, share_of_ones: float) -> Machine:
    """A machine over the terms told apart alone, then one over these and the terms of telling pairs."""

    def fit(used: np.ndarray, share: float) -> tuple[Machine, list[np.ndarray]]:
        place = np.where(used, np.cumsum(used) - 1, -1)
        of_used = [place[r][used[r]] for r in rows]
        return fit_machine(terms[used], of_used, labels, share), of_used

    labels = np.asarray(labels, float)
    if not len(labels) or labels.min() == labels.max():
        return fit_machine(terms, rows, labels, share_of_ones)
    alone, of_used = fit(told, labels.mean())
    text = np.repeat(np.arange(len(rows)), [len(r) for r in of_used])
    margins = alone._margins(text, np.concatenate(of_used).astype(np.int64), len(rows))
    used = told.copy()
    used[pair_terms(rows, labels, 1 / (1 + np.exp(-np.clip(margins, -50, 50))))] = True
    return fit(used, share_of_ones)[0]


def train_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Machine:
    """Fit on at most ``per_class`` labelled texts of each class, whole texts, held-out rows excluded.

    Term sets stay on the executors; the driver gets the terms that tell classes apart and the common
    ones and, for every text of the sample, the places of those it has. Texts with equal term sets count once, as 1 if any is.
    """
    eligible = labels.filter(F.col("toxic").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    share = eligible.agg(F.avg("toxic")).first()[0] or 0.0
    sample = F.broadcast(labelled_sample(labels, "toxic", per_class))  # two times per_class ids at most

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [t.tobytes() for t in term_sets(batch.column(1).cast(pa.binary()).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["label", "terms"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = texts.join(sample, "doc_id").dropDuplicates(["doc_id"]).select("label", "text")
    distinct = chosen.mapInArrow(sets, "label int, terms binary").groupBy("terms").agg(F.max("label").alias("label"))
    distinct = materialise(distinct, "term-sets")
    terms, told = choose_terms(distinct)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.frombuffer(t, np.uint64) for t in batch.column(0).to_pylist()]
            rows = [np.searchsorted(terms, t[np.isin(t, terms)]).astype(np.int32).tobytes() for t in found]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1)], names=["places", "label"])

    rows = distinct.select("terms", "label").mapInArrow(places, "places binary, label int").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["places"])))
    places_of_rows = [np.frombuffer(r["places"], np.int32) for r in rows]
    return fit_with_pairs(terms, told, places_of_rows, np.array([r["label"] for r in rows]), share)


def score_toxicity(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text; null and empty texts get the bias alone.

    Repeated rows get equal scores, an empty table gives no rows, and only ``doc_id`` and ``text``
    are read: labels, language, source and id never enter a score.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = model.value.score(batch.column(1).cast(pa.binary()).to_pylist())
            columns = [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(score, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows whose text is not predicted toxic, with all their columns.

    Null and empty texts are judged by the bias alone, repeated rows alike; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)
    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(names.index("text")).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array(model.value.score(texts) < 0.5))

    return docs.mapInArrow(keep, docs.schema)
