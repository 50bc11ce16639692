"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.llm import bagminhash
from aerocast.llm.alignment import align_corpus
from aerocast.llm.blocksearch import search
from aerocast.llm.bpe import decode_documents, encode_documents
from aerocast.llm.covertree import near_duplicates
from aerocast.llm.fmindex import find_leaks
from aerocast.llm.importance import fit_ratios, resample
from aerocast.llm.kdshard import shard_documents
from aerocast.llm.logbilinear import score_documents, train_language_model
from aerocast.llm.packing import added_tokens, pack_documents
from aerocast.llm.prefixtrie import prefix_trie, rebuilt_sequences
from aerocast.llm.substrings import remove_repeats
from aerocast.llm.toxicity import is_held_out, score_toxicity, train_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return pack_documents(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, added=added)


def op2_two_tier_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_documents(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    both = decode_documents(encoded, ranks)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_toxicity_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    machine = train_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, machine)
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"))


def op5_bag_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_seed_and_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_documents(docs, *train_language_model(docs))


def op8_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return resample(docs, fit_ratios(docs, labels)).withColumnRenamed("selected", "kept")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_corpus(_table(spark, sf_dir, "documents"), left, right, public_tokenizers.PATTERN)


def op12_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_of_five = F.expr("conv_id - conv_id % 5")
    taken = F.crc32(F.col("conv_id").cast("string")) % 9
    return prefix_trie(rebuilt_sequences(_table(spark, sf_dir, "conversations"), first_of_five, taken, most=8))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_two_tier_bpe": op2_two_tier_bpe,
    "op3_toxicity_machine": op3_toxicity_machine,
    "op4_kd_shards": op4_kd_shards,
    "op5_bag_min_hash": op5_bag_min_hash,
    "op6_seed_and_extend": op6_seed_and_extend,
    "op7_log_bilinear": op7_log_bilinear,
    "op8_block_search": op8_block_search,
    "op9_cover_tree": op9_cover_tree,
    "op10_importance_resampling": op10_importance_resampling,
    "op11_token_alignment": op11_token_alignment,
    "op12_fm_index": op12_fm_index,
    "op13_prefix_trie": op13_prefix_trie,
}

_USABLE = """SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0"""

_WORDS = r"""words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents)"""

_REACH = """reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)"""

ORACLE: dict[str, str] = {
    "op5_bag_min_hash": f"""WITH RECURSIVE {_WORDS},
shingles AS (
  SELECT doc_id, s, count(*) AS n FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) < 5 THEN [w] ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS s
    FROM words WHERE len(w) > 0) GROUP BY ALL),
sizes AS (SELECT doc_id, sum(n) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
near AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE common.n / (x.n + y.n - common.n) >= 0.8),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
{_REACH}
SELECT d.doc_id, least(d.doc_id, coalesce(b, d.doc_id)) AS class_id, d.doc_id = least(d.doc_id, coalesce(b, d.doc_id)) AS kept
FROM documents d LEFT JOIN least ON a = d.doc_id""",
    "op6_seed_and_extend": f"""WITH {_WORDS},
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)),
later AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM places ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT words.doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)""",
    "op8_block_search": f"""WITH usable AS ({_USABLE}),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op9_cover_tree": f"""WITH RECURSIVE usable AS ({_USABLE}),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.93),
{_REACH},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(counts.n, 0) AS n_links, least(e.vec_id, coalesce(least.b, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(least.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counts ON counts.a = e.vec_id LEFT JOIN least ON least.a = e.vec_id""",
}

_PLAIN_WORDS = r"""list_filter(string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

ORACLE["op12_fm_index"] = f"""WITH words AS (SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, len(w) AS n, array_to_string(w, ' ') AS key FROM items WHERE len(w) BETWEEN 1 AND 9
  UNION SELECT item_id, 10, array_to_string(w[i:i + 9], ' ') FROM (SELECT *, unnest(range(1, len(w) - 8)) AS i FROM items)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes),
found AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n) WHERE array_to_string(w[i:i + n - 1], ' ') = key),
hit AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS i FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT words.doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

# The checksum of a decimal id, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
  list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)),
  lambda c, x: list_reduce(list_prepend(xor(c, x), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, b: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))))"""

ORACLE["op13_prefix_trie"] = f"""WITH turns AS (
  SELECT conv_id, list(t ORDER BY turn NULLS FIRST, md5(concat(strlen(t.role), ':', t.role, t.text))) AS own
  FROM (SELECT conv_id, turn, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
taken AS (SELECT *, CAST({_CRC32} % 9 AS BIGINT) AS h FROM turns),
built AS (
  SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS t
  FROM taken c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 5),
prefixes AS (SELECT conv_id, d, t[1:d] AS p, len(t) = d AS last FROM (SELECT *, unnest(range(0, len(t) + 1)) AS d FROM built)),
nodes AS (
  SELECT p, any_value(d) AS depth, min(conv_id) AS least, count(*) AS n,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends FROM prefixes GROUP BY p),
above AS (SELECT c.least, c.depth, u.least AS parent FROM nodes c JOIN nodes u ON c.depth > 0 AND u.depth = c.depth - 1 AND u.p = c.p[1:c.depth - 1]),
kids AS (SELECT parent AS least, depth - 1 AS depth, count(*) AS n FROM above GROUP BY ALL),
sized AS (
  SELECT nodes.*, coalesce(kids.n, 0) AS n_children, CASE WHEN nodes.depth = 0 THEN 0 ELSE (nodes.n - 1) * strlen(nodes.p[nodes.depth].text) END AS own
  FROM nodes LEFT JOIN kids USING (least, depth)),
below AS (
  SELECT t.p[1:a] AS p, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM sized) t GROUP BY 1)
SELECT least AS conv_id, depth, parent AS parent_conv_id, n AS n_convs, n_children, n_leaves, saved AS saved_tokens, ends AS ends_sha256
FROM sized JOIN below USING (p) LEFT JOIN above USING (least, depth)"""
