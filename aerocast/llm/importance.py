"""Quality by importance resampling: target against raw n-gram models, sampled by Gumbel top-k.

A text is a bag of hashed n-grams: its words, and runs of one to three word forms, where a form
tells letters, case, digits, symbols and repetition of the word before. Two generative models
give each n-gram a probability, one from texts labelled good and one from all texts. As the four
kinds of n-grams overlap, the log weight of a text is the mean over the kinds of the summed log
ratios. Adding Gumbel noise to the log weights
and keeping the k largest draws k documents without replacement in proportion to the weights. Unless it is
given, k is the sum of the weights, each counted with 1 at most: the number of documents that the
target model explains at least as well as the raw one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocast.llm.words import PUNCTUATION, SPACE, chunks, mix, slices, split_words
from aerocast.session import materialise

BUCKETS = 1 << 14
#: Words, and runs of one, two and three forms.
KINDS = 4
#: Most texts labelled good that the target model reads: those with the smallest hashes of their id.
TARGET_TEXTS = 20_000
SMOOTHING = 0.5
#: Strength of the raw model as the prior of the target model, in n-grams per bucket: few target
#: texts leave the ratios near one instead of making them extreme.
PRIOR = 4.0
SEED = 20240917
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_LOWER = ~(_UPPER | _DIGIT | PUNCTUATION | SPACE)


def ngrams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of every n-gram of whole texts."""
    words = split_words(texts)
    if not len(words.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, owner = words.hashes(), words.text_of
    counts = [np.add.reduceat(kind[words.data].astype(np.int32), words.starts) for kind in (_UPPER, _LOWER, _DIGIT, PUNCTUATION)]
    upper, lower, digit, symbol = (np.minimum(c, most) for c, most in zip(counts, (2, 1, 1, 3)))
    same_text = np.concatenate(([False], owner[1:] == owner[:-1]))
    again = same_text & np.concatenate(([False], hashes[1:] == hashes[:-1]))
    form = (1 + upper + 4 * lower + 8 * digit + 16 * symbol + 64 * again).astype(np.uint64)

    def before(values: np.ndarray) -> np.ndarray:
        return np.where(same_text, np.concatenate((values[:1], values[:-1])), np.uint64(0))

    one = before(form)
    two = before(one)
    wide = np.uint64(256)
    runs = [form, form + wide * one + np.uint64(1 << 32), form + wide * (one + wide * two) + np.uint64(2 << 32)]
    kinds = [hashes, *(mix(r + np.uint64(SEED)) for r in runs)]
    buckets = np.concatenate([(k >> np.uint64(50)).astype(np.int64) for k in kinds])
    return buckets, np.tile(owner, len(kinds))


@dataclass
class Ratios:
    """Log ratio of target to raw for every bucket, and the noise seed."""

    logs: np.ndarray
    seed: int = SEED

    def log_weights(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for part in chunks(texts):
            buckets, owner = ngrams(texts[part])
            out[part] = np.bincount(owner, self.logs[buckets], part.stop - part.start) / KINDS
        return out

    def keys(self, log_weights: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Log weight plus Gumbel noise that depends on the id and the seed alone."""
        scrambled = mix(ids.astype(np.int64).view(np.uint64) + mix(np.full(len(ids), self.seed, np.uint64)))
        uniform = ((scrambled >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        return log_weights - np.log(-np.log(uniform))


def fit_ratios(docs: DataFrame, labels: DataFrame, target_texts: int = TARGET_TEXTS) -> Ratios:
    """Count n-grams of all texts, and of at most ``target_texts`` labelled good, in one scan.

    The driver receives one row per bucket. Without texts labelled good every ratio is one.
    """
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
    good = good.select(F.col("doc_id").cast("long").alias("_id")).distinct()
    good = good.orderBy(F.xxhash64("_id"), "_id").limit(target_texts).withColumn("_good", F.lit(True))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    # At most target_texts ids.
    marked = texts.join(F.broadcast(good), "_id", "left").select("_text", F.coalesce("_good", F.lit(False)).alias("_good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches):
            texts = batch.column(0).cast(pa.binary()).to_pylist()
            is_good = batch.column(1).to_numpy(zero_copy_only=False)
            for part in chunks(texts):
                buckets, owner = ngrams(texts[part])
                raw += np.bincount(buckets, minlength=BUCKETS)
                target += np.bincount(buckets[is_good[part][owner]], minlength=BUCKETS)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])

    counted = marked.mapInArrow(count, "bucket long, raw long, target long")
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in rows:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not target.any():
        return Ratios(np.zeros(BUCKETS))
    share = (raw + SMOOTHING) / (raw.sum() + SMOOTHING * BUCKETS)
    prior = PRIOR * BUCKETS
    return Ratios(np.log((target + prior * share) / (target.sum() + prior)) - np.log(share))


def _keyed(docs: DataFrame, ratios: Ratios) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(ratios)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column(0).fill_null(0).to_numpy()
            weights = model.value.log_weights(batch.column(1).cast(pa.binary()).to_pylist())
            columns = [batch.column(0), pa.array(weights), pa.array(model.value.keys(weights, ids))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "log_weight", "sample_key"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(score, "doc_id long, log_weight double, sample_key double")


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The exact k-th largest value, by narrowing a histogram; only one bin's border rows reach the driver.

    Below 1 every value is larger, beyond the number of rows every value counts.
    """
    span = values.agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count(column).alias("n")).first()
    if k < 1 or not span["n"]:
        return float("inf")
    if k >= span["n"]:
        return float("-inf")
    low, high, left, bins = span["low"], span["high"], k, 4096
    here = values.select(F.col(column).alias("_v"))
    while low < high:
        width = (high - low) / bins
        if low + width <= low:
            break
        inside = here.filter(F.col("_v").between(low, high))
        place = F.least(F.floor((F.col("_v") - low) / width), F.lit(bins - 1)).cast("int")
        sums = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
        for row in sums.orderBy(F.col("bin").desc()).collect():
            if left <= row["n"]:
                low, high = row["low"], row["high"]
                break
            left -= row["n"]
    return high


def resample(docs: DataFrame, ratios: Ratios, k: int | None = None) -> DataFrame:
    """``doc_id, log_weight, sample_key, selected``: a draw of ``k`` of all documents.

    Whole texts are scored; a null or empty text has weight one, a null id the noise of id 0.
    Rows with equal keys (repeated rows) are kept or left together, so the draw can exceed its
    size by such ties. An empty table gives no rows; other columns are dropped.
    """
    keyed = materialise(_keyed(docs, ratios), "keyed")
    if k is None:
        k = round(keyed.agg(F.sum(F.least(F.lit(1.0), F.exp("log_weight")))).first()[0] or 0)
    least = kth_largest(keyed, "sample_key", k)
    return keyed.withColumn("selected", F.col("sample_key") >= F.lit(least))


def keep_selected(docs: DataFrame, ratios: Ratios, k: int | None = None) -> DataFrame:
    """The drawn rows with all their columns; texts are scored again where they are, not joined.

    Nulls, empty texts, ties and repeated rows are as in ``resample``; an empty table gives no rows.
    """
    drawn = resample(docs, ratios, k)
    least = drawn.filter("selected").agg(F.min("sample_key")).first()[0]
    least = float("inf") if least is None else least
    model, names = docs.sparkSession.sparkContext.broadcast(ratios), docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column(names.index("doc_id")).cast(pa.int64()).fill_null(0).to_numpy()
            weights = model.value.log_weights(batch.column(names.index("text")).cast(pa.binary()).to_pylist())
            yield batch.filter(pa.array(model.value.keys(weights, ids) >= least))

    return docs.mapInArrow(keep, docs.schema)
