"""The pN_ queries over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.llm import defects, docs, encode, leaks, near, personal, pieces, residue, secrets
from lathework.plans.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects.find_defects(table(spark, sf_dir, "qa_pairs"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "qa_pairs")).select("pair_id", "field", "line_no").distinct()


def p2_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(table(spark, sf_dir, "qa_pairs"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = docs.find_documented(table(spark, sf_dir, "extraction_results"), with_code=False)
    return pairs.where(~F.col("inherited")).select("result_id", "example_no", "line_no", "func_name")


def p3_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.find_documented(table(spark, sf_dir, "extraction_results"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.find_personal(table(spark, sf_dir, "qa_pairs")).select("pair_id", "field", "kind").distinct()


def p4_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.replace_personal(table(spark, sf_dir, "qa_pairs"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces.split_items(table(spark, sf_dir, "chunks"))
    return cut.where((F.col("pieces") > 1) & (F.col("piece_no") == 0)).select("chunk_key")


def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.split_items(table(spark, sf_dir, "chunks"))


def p5_rejoined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every oversized text put together again from its pieces, for comparison with the table."""
    cut = pieces.split_items(table(spark, sf_dir, "chunks")).where(F.col("pieces") > 1)
    fresh = F.when(F.col("piece_no") == 0, F.col("text")).otherwise(F.expr(f"substring(text, {pieces.OVERLAP + 1})"))
    parts = F.sort_array(F.collect_list(F.struct("piece_no", fresh.alias("part"))))
    whole = F.array_join(F.transform(parts, lambda p: p["part"]), "")
    return cut.groupBy("chunk_key").agg(F.md5(whole.cast("binary")).alias("digest"), F.length(whole).cast("bigint").alias("n_chars"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.group_pairs(table(spark, sf_dir, "qa_pairs"))


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.groups(table(spark, sf_dir, "qa_pairs")).select(F.col("id").alias("pair_id"), F.col("group").alias("group_id"), "links")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_texts(table(spark, sf_dir, "documents"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.find_residue(table(spark, sf_dir, "documents")).select("doc_id")


QUERIES: dict[str, Query] = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p2_redacted": p2_redacted,
    "p3_found": p3_found,
    "p3_pairs": p3_pairs,
    "p4_found": p4_found,
    "p4_replaced": p4_replaced,
    "p5_found": p5_found,
    "p5_pieces": p5_pieces,
    "p5_rejoined": p5_rejoined,
    "p6_found": p6_found,
    "p6_groups": p6_groups,
    "p7_ids": p7_ids,
    "p8_found": p8_found,
    "p9_found": p9_found,
}

P8_SQL = r"""
WITH runs AS (
  SELECT side, id, array_to_string(w[i:i + 12], ' ') AS run
  FROM (
    SELECT side, id, w, unnest(range(1, len(w) - 11)) AS i
    FROM (
      SELECT 0 AS side, doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents
      UNION ALL
      SELECT 1 AS side, item_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark
    ) WHERE len(w) >= 13
  )
)
SELECT DISTINCT d.id AS doc_id, b.id AS item_id
FROM runs d JOIN runs b ON d.run = b.run WHERE d.side = 0 AND b.side = 1
"""

ORACLE: dict[str, str] = {
    "p5_found": "SELECT chunk_key FROM chunks WHERE length(text) > 4096",
    "p5_rejoined": "SELECT chunk_key, md5(text) AS digest, length(text) AS n_chars FROM chunks WHERE length(text) > 4096",
    "p8_found": P8_SQL,
}
