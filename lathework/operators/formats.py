"""Samples in the common training layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.text import Name, or_empty

SYSTEM = "You are a helpful assistant for infrastructure and programming questions."


def alpaca(df: DataFrame) -> DataFrame:
    return df.select(*[or_empty(df[c]).alias(c) for c in ("instruction", "input", "output")])


def _turn(first: str, who: str, second: str, what: Column) -> Column:
    return F.struct(F.lit(who).alias(first), what.alias(second))


def asked(instruction: Name, extra: Name, between: str = "\n\n") -> Column:
    """The question with its input behind it, where there is one."""
    return F.when(or_empty(extra) != "", F.concat(or_empty(instruction), F.lit(between), or_empty(extra))).otherwise(or_empty(instruction))


def sharegpt(instruction: Name = "instruction", extra: Name | None = "input", output: Name = "output") -> Column:
    """Two turns; without ``extra`` the input is left out."""
    human = asked(instruction, extra) if extra is not None else or_empty(instruction)
    return F.array(_turn("from", "human", "value", human), _turn("from", "gpt", "value", or_empty(output)))


def chatml(instruction: Name = "instruction", extra: Name = "input", output: Name = "output", system: str = SYSTEM) -> Column:
    """System, user (with the input as context) and assistant."""
    return F.array(
        _turn("role", "system", "content", F.lit(system)), _turn("role", "user", "content", asked(instruction, extra, "\n\nContext: ")), _turn("role", "assistant", "content", or_empty(output))
    )


def completion(instruction: Name = "instruction", output: Name = "output") -> Column:
    return F.concat(F.lit("### Instruction:\n"), or_empty(instruction), F.lit("\n\n### Response:\n"), or_empty(output), F.lit("\n"))


def supervision(df: DataFrame, doc_id: str, chunk_id: str, url: str) -> DataFrame:
    """Samples with where they come from."""
    origin = F.struct(df[doc_id].alias("doc_id"), df[chunk_id].alias("chunk_id"), df[url].alias("source_url"))
    return df.select("instruction", "input", "output", origin.alias("_meta"))


def dpo(df: DataFrame) -> DataFrame:
    return df.select("prompt", "chosen", "rejected")


def orpo(df: DataFrame) -> DataFrame:
    return df.select(F.col("prompt").alias("instruction"), "chosen", "rejected")


def rlhf(df: DataFrame) -> DataFrame:
    return df.select("prompt", F.array("chosen", "rejected").alias("responses"), F.array(F.lit(0), F.lit(1)).alias("ranking"))


def full(df: DataFrame) -> DataFrame:
    """All fields of a pair as they are."""
    return df.select("instruction", "input", "output", "source", "source_type", "score", "tags", "url", "collected_at", "metadata")
