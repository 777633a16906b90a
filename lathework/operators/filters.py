"""Predicates of the cleaning stages, and the reason columns they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.text import Name, col, or_empty, strip, word_count


def long_enough(output: Name, least: int = 50) -> Column:
    return F.length(strip(or_empty(output))) >= least


def quality_reason(instruction: Name, output: Name, bounds: tuple[int, int, int, int] = (10, 500, 50, 10_000)) -> Column:
    """The first length rule a sample breaks, or null."""
    ins, out = F.length(or_empty(instruction)), F.length(or_empty(output))
    return (
        F.when(ins < bounds[0], "short_instruction").when(ins > bounds[1], "long_instruction").when(out < bounds[2], "short_output").when(out > bounds[3], "long_output")
    )


def grounded(output: Name, words: int = 5) -> Column:
    """No angle-bracket pair anywhere, and at least ``words`` words."""
    text = or_empty(output)
    return ~(F.contains(text, F.lit("<")) & F.contains(text, F.lit(">"))) & (word_count(text) >= words)


def required(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is null."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & df[c].isNotNull()
    return df.where(keep)


def from_raw(df: DataFrame, question: str = "question", prompt: str = "prompt", context: str = "context", answer: str = "answer", response: str = "response") -> DataFrame:
    """Samples from loosely named records; both sides must be there. Columns that are missing count as null."""
    have = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    out = df.select(
        F.coalesce(have(question), have(prompt), F.lit("")).alias("instruction"), F.coalesce(have(context), F.lit("")).alias("input"), F.coalesce(have(answer), have(response), F.lit("")).alias("output")
    )
    return out.where((F.col("instruction") != "") & (F.col("output") != ""))


def public_function(name: Name, source: Name, least: int = 50) -> Column:
    return ~col(name).startswith("_") & (col(name) != "main") & (F.length(col(source)) >= least)


# Files that source trees skip.
SKIPPED_FILES = ("__init__.py", "conftest.py", "conf.py", "setup.py")


def wanted_file(path: Name, source_type: str = "python") -> Column:
    """Whether a file of a source tree is read."""
    name = F.regexp_extract(or_empty(path), r"([^/]*)$", 1)
    endings = {"python": r"\.py$", "rst": r"\.rst$", "markdown": r"\.(md|markdown)$", "mixed": r"\.(py|rst|md)$"}.get(source_type, r"\.py$")
    keep = name.rlike(endings) & ~name.isin(*SKIPPED_FILES)
    return keep if source_type == "python" else keep & ~F.contains(F.lower(name), F.lit("test"))
