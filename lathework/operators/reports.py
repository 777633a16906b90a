"""Counts and statistics of datasets, extractions, crawls and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathework.functions.text import Name, or_empty


def length_stats(df: DataFrame, instruction: str = "instruction", output: str = "output") -> DataFrame:
    """One row: least, greatest and mean (rounded down) lengths."""
    parts = []
    for name, c in (("instruction", instruction), ("output", output)):
        n = F.length(or_empty(df[c])).cast("bigint")
        parts += [F.min(n).alias(f"{name}_min"), F.max(n).alias(f"{name}_max"), F.floor(F.avg(n)).alias(f"{name}_mean")]
    return df.agg(*parts)


def per_source(df: DataFrame, source: str = "source") -> DataFrame:
    """(source, rows) with the total under a null source."""
    return df.select(df[source].alias("source")).rollup("source").agg(F.count("*").alias("rows"), F.grouping("source").cast("int").alias("is_total"))


def dataset_meta(df: DataFrame, url: str = "url", key: Column | None = None) -> DataFrame:
    """One row: the number of samples, of different urls, and a digest of the content that order doesn't change."""
    digest = F.hex(F.bit_xor(F.xxhash64(F.to_json(F.struct(*[df[c] for c in df.columns])))))
    return df.agg(F.count("*").alias("num_samples"), F.count_distinct(df[url]).alias("num_urls"), digest.alias("content_hash"))


def category_counts(df: DataFrame, category: str = "category") -> DataFrame:
    return df.groupBy(df[category].alias("category")).agg(F.count("*").alias("rows")).orderBy("category")


def extraction_stats(chunks: DataFrame, documents: DataFrame, text: str = "text") -> DataFrame:
    """One row: documents, sections, chunks, chunks a document and characters."""
    one = chunks.agg(F.count_distinct("doc_id", "section_no").alias("sections"), F.count("*").alias("chunks"))
    two = documents.agg(F.count("*").alias("documents"), F.coalesce(F.sum(F.length(documents[text])), F.lit(0)).cast("bigint").alias("characters"))
    return two.crossJoin(one).withColumn("chunks_per_document", F.col("chunks") / F.greatest(F.col("documents"), F.lit(1)))  # one row each


def crawl_stats(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row: pages with and without content, and bytes."""
    size = F.octet_length(or_empty(pages[html]))
    return pages.agg(F.count_if(size > 0).alias("pages"), F.count_if(size == 0).alias("failed"), F.sum(size).cast("bigint").alias("bytes"))


def log_metrics(log: Name) -> list[Column]:
    """First and last loss, last evaluation loss, last step, and whether a log tells of completion."""
    text = or_empty(log)
    last = lambda pattern: F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(-1))
    first = lambda pattern: F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(1))
    loss = r"(?<!eval_)loss['\"]?\s*[:=]\s*([0-9.]+)"
    return [
        first(loss).cast("double").alias("first_loss"), last(loss).cast("double").alias("last_loss"), last(r"eval_loss['\"]?\s*[:=]\s*([0-9.]+)").cast("double").alias("eval_loss"),
        last(r"(\d+)/\d+ \[").cast("int").alias("step"), text.rlike("(?i)training (?:completed|complete|finished)").alias("completed"),
    ]


def latest_checkpoint(paths: DataFrame, path: str = "path") -> DataFrame:
    """One row: the path of the greatest number behind its last hyphen; a name without one counts as 0."""
    number = F.coalesce(F.regexp_extract(paths[path], r"-(\d+)$", 1).try_cast("bigint"), F.lit(0))
    return paths.agg(F.max_by(paths[path], F.struct(number, paths[path])).alias("path"), F.max(number).alias("step"))


def numbered(df: DataFrame, group: str, *orders: str) -> DataFrame:
    """``df`` with ``n``, the number of a row within its group from 1; a group is sorted in one task, on disk if need be."""
    return df.withColumn("n", F.row_number().over(Window.partitionBy(group).orderBy(*orders)))
