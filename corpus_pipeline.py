"""Training-data pipeline over ``documents``: stages that each read what the one before kept.

Quality and toxicity reject documents, near-duplicates leave one document of each group, substring
dedup cuts repeated passages out of texts, and packing lays the rest into sequences. The models of
the first two stages learn from ``labels`` and from the documents that reach them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm.bagminhash import drop_near_duplicates
from aerocast.llm.importance import fit_ratios, keep_selected
from aerocast.llm.packing import added_tokens, pack_documents
from aerocast.llm.substrings import replace_texts
from aerocast.llm.toxicity import drop_toxic, train_toxicity
from aerocast.session import materialise


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling; the others are rejected.

    Null and empty texts have a weight of one and stay unless the draw is smaller than the table; rows that repeat a
    document share its key and its fate. An empty table gives no rows, and without labels every document stays.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_selected(docs, fit_ratios(docs, labels))


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic.

    Each row is judged by its own text: null and empty texts by the bias alone, long ones as wholes, repeated rows alike.
    An empty table gives no rows; without labels of both kinds nothing is rejected.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, train_toxicity(docs, labels))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates.

    Rows without an id or without words stay. Rows that repeat the document kept stay as well, and texts that share
    an id are judged one by one (see ``drop_near_duplicates``).
    """
    return drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that start earlier elsewhere; ``n_chars`` follows the text.

    Null, empty and short texts and rows without an id are left as they are (see ``replace_texts``).
    """
    cut = replace_texts(docs)
    if "n_chars" not in cut.columns:
        return cut
    kind = dict(cut.dtypes)["n_chars"]
    return cut.withColumn("n_chars", F.char_length("text").cast(kind))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts and their places in sequences.

    A null or empty text is one piece with the end id; repeated rows are packed like any others. An empty table gives
    no rows.
    """
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added=added)


STAGES = [
    ("quality", keep_quality),
    ("toxicity", keep_civil),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("substrings", cut_repeats),
    ("packing", pack),
]

#: Trained models, signatures and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
