"""The registered queries opN_<name> and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm._spark import table
from kinweave.llm.ann import nearest_neighbours
from kinweave.llm.bpe import bpe_encode
from kinweave.llm.chat import rotate_perspectives
from kinweave.llm.decontaminate import contamination
from kinweave.llm.language_id import fit_language_id, identify_language
from kinweave.llm.licenses import license_scan
from kinweave.llm.lm import katz_scores
from kinweave.llm.near_dedup import near_duplicates
from kinweave.llm.suffix_dedup import remove_repeats
from kinweave.llm.toxicity import fit_toxicity, score_toxicity


def remainder(n: int) -> Column:
    """crc32 of doc_id as text, modulo n; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def held_out(n: int, which: int) -> Column:
    return F.coalesce(remainder(n) == which, F.lit(False)).alias("held_out")


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest_neighbours(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op2_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = katz_scores(table(spark, sf_dir, "documents"), remainder(7) != 2)
    return found.select("doc_id", (~F.col("train") & F.col("doc_id").isNotNull()).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language_id(docs.where(remainder(4) != 2))
    return identify_language(docs, model).select("doc_id", held_out(4, 2), "lang_pred", "score")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), ("ids_sha256", "decoded_sha256"))


def op6_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(table(spark, sf_dir, "conversations"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrase_starts").cast("long").alias("n_base"),
        F.try_element_at("phrase_starts", F.lit(1)).alias("first_word"),
        F.try_element_at("phrase_starts", F.lit(-1)).alias("last_word"),
        F.array_join("phrase_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "repeats")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), train=remainder(5) != 0)
    return score_toxicity(docs, model).select("doc_id", held_out(5, 0), "score", "predicted")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), "contaminated")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_nearest_neighbours, op2_katz_lm, op3_language_id, op4_near_dedup, op5_byte_bpe, op6_chat_perspectives, op7_license_scan, op8_suffix_dedup, op9_toxicity, op10_decontaminate)
}

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP4 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, p.b FROM r JOIN p ON p.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
SELECT s.doc_id, len(s) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""

_OP10 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
k AS (SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS g FROM (SELECT item_id, w, least(13, len(w)) AS l, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT l FROM k),
g AS (SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS g FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, n WHERE len(w) >= l)),
h AS (SELECT DISTINCT doc_id, i, k.l AS l, item_id FROM g JOIN k ON k.l = g.l AND k.g = g.g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM h) GROUP BY 1),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM h) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)
"""

#: SQL equivalents; the learned, approximate and byte-wise operators have none.
ORACLE_SQL: dict[str, str] = {"op4_near_dedup": _OP4, "op10_decontaminate": _OP10}
