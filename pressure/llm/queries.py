"""Queries over the operators, each over its whole table, and the SQL that some are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressure.llm import ann, bpe, caps, extraction, licenses, minhash, packing, quality, rules, sharding, structure, toxicity, trie
from pressure.llm.common import table

# The rank file of the byte-level vocabulary.
VOCABULARY = "byte_bpe_50k.tiktoken"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), bpe.read_vocabulary(vocabulary_path()))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), 40)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op7_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extraction_report(table(spark, sf_dir, "pages"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.repair_report(table(spark, sf_dir, "conversations"))


def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_report(table(spark, sf_dir, "documents"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict:
    return {
        "op1_bpe": op1_bpe,
        "op2_quality": op2_quality,
        "op3_sharding": op3_sharding,
        "op4_packing": op4_packing,
        "op5_minhash": op5_minhash,
        "op6_ann": op6_ann,
        "op7_caps": op7_caps,
        "op8_extraction": op8_extraction,
        "op9_licenses": op9_licenses,
        "op10_toxicity": op10_toxicity,
        "op11_structure": op11_structure,
        "op12_rules": op12_rules,
        "op13_trie": op13_trie,
    }


# Links of every pair, and the smallest id that each node reaches over them; `node` and `link` are given before.
_REACHED = """
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
walk(id, root) AS (SELECT id, id FROM node UNION SELECT w.id, l.b FROM walk w JOIN both_ways l ON l.a = w.root),
reached AS (SELECT id, min(root) AS component_id FROM walk GROUP BY id)"""

NEAR_DUPLICATE_TEXTS = f"""
WITH RECURSIVE words AS (
  SELECT doc_id AS id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT id, CASE WHEN len(w) < 5 THEN w ELSE w[i:i + 4] END AS s
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)),
node AS (SELECT w.id, count(s.id) AS n FROM words w LEFT JOIN shingle s USING (id) GROUP BY w.id),
met AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM shingle x JOIN shingle y ON x.s = y.s AND x.id < y.id GROUP BY ALL),
link AS (SELECT a, b FROM met JOIN node x ON x.id = a JOIN node y ON y.id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
{_REACHED}
SELECT id AS doc_id, n AS n_shingles, component_id, id = component_id AS kept FROM node JOIN reached USING (id)
"""

NEAR_DUPLICATE_VECTORS = f"""
WITH RECURSIVE node AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings),
fit AS (
  SELECT id, label, v FROM node
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS (
  SELECT x.id AS a, y.id AS b FROM fit x JOIN fit y ON x.label = y.label AND x.id < y.id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
{_REACHED},
linked AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM node JOIN reached USING (id) LEFT JOIN linked USING (id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_minhash": NEAR_DUPLICATE_TEXTS,
        "op7_caps": NEAR_DUPLICATE_VECTORS,
        "op9_licenses": licenses.oracle_sql(),
        "op12_rules": rules.oracle_sql(),
    }
