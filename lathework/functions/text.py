"""Text columns: normalising, counting, trimming; all built-ins, all null-safe."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Every character that Python's ``\s`` matches, as a class that Java and RE2 read alike.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

#: The same characters, for trimming.
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

Name = str | Column


def col(c: Name) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Name) -> Column:
    """The text without white space at its ends (any Unicode space)."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def normalize(c: Name) -> Column:
    """Lower case, ends stripped, every run of white space one space."""
    return F.regexp_replace(strip(F.lower(col(c))), f"{WS}+", " ")


def or_empty(c: Name) -> Column:
    return F.coalesce(col(c), F.lit(""))


def token_count(c: Name) -> Column:
    """A quarter of the characters, at least 1; null counts as empty."""
    return F.greatest(F.lit(1), F.floor(F.length(or_empty(c)) / 4)).cast("bigint")


def word_count(c: Name) -> Column:
    """Words between white space; null and blank texts have none."""
    return F.size(F.filter(F.split(or_empty(c), f"{WS}+"), lambda w: w != "")).cast("bigint")


def lines(c: Name) -> Column:
    return F.split(or_empty(c), "\n", -1)


def headings(c: Name) -> Column:
    """Titles of lines that begin with ``#``, in order; those within code count too."""
    marked = F.filter(lines(c), lambda x: strip(x).startswith("#"))
    return F.transform(marked, lambda x: strip(F.regexp_replace(strip(x), "^#+", "")))


def truncate(c: Name, most: int, tail: str) -> Column:
    """The first ``most`` characters and ``tail``, where the text is longer."""
    return F.when(F.length(col(c)) > most, F.concat(F.substring(col(c), 1, most), F.lit(tail))).otherwise(col(c))


def ansi_clean(c: Name) -> Column:
    """The text without terminal escape sequences."""
    plain = F.regexp_replace(col(c), r"\x1b\[[0-9;?]*[ -/]*[@-~]", "")
    return F.regexp_replace(plain, r"\x1b[@-Z\\-_]", "")


def contains_any(c: Name, *parts: str) -> Column:
    out = F.lit(False)
    for part in parts:
        out = out | F.contains(col(c), F.lit(part))
    return out


def sentences(c: Name, pattern: str, more_than: int = 20) -> Column:
    """Stripped sentences of more than ``more_than`` characters."""
    parts = F.transform(F.split(or_empty(c), pattern, -1), strip)
    return F.filter(parts, lambda s: F.length(s) > more_than)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once, also where it is used for every element of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def most_frequent(array: Column) -> Column:
    """How often the most frequent element of an array occurs; 0 for an empty one.

    Sorted once and folded in one pass, so a long text costs n log n.
    """
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("top"))

    def step(acc: Column, x: Column) -> Column:
        run = F.when(acc["last"] == x, acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(acc["top"], run).alias("top"))

    return F.aggregate(F.sort_array(array), start, step, lambda acc: acc["top"])


def repeated_phrases(c: Name, size: int = 30) -> Column:
    """The multiplicity of the most frequent window of ``size`` characters, half a window apart."""
    half = size // 2

    def count(t: Column) -> Column:
        # pieces of half a window, read once; a window is a piece and the next
        pieces = F.regexp_extract_all(t, F.lit(f"(?s).{{{half}}}"), F.lit(0))
        wanted = F.ceil((F.length(t) - size) / half).cast("int")
        pairs = let(pieces, lambda p: F.zip_with(F.slice(p, 1, wanted), F.slice(p, 2, wanted), lambda x, y: F.concat(x, y)))
        return F.when(F.length(t) <= size, F.lit(0)).otherwise(most_frequent(pairs))

    return let(normalize(or_empty(c)), count).cast("bigint")


def has_repeated_sentences(c: Name, threshold: int = 3) -> Column:
    """Whether a sentence of more than 20 characters occurs ``threshold`` times or more."""
    kept = sentences(c, "[.!?]+")
    return (F.size(kept) >= 2) & (most_frequent(F.transform(kept, normalize)) >= threshold)


def repetition_ratio(c: Name) -> Column:
    """Per cent of sentences that repeat another; 0 for texts under 100 characters."""
    kept = F.transform(sentences(c, "[.!?]"), lambda s: F.lower(s))
    ratio = (F.lit(1.0) - F.size(F.array_distinct(kept)) / F.size(kept)) * 100
    return F.when((F.length(or_empty(c)) < 100) | (F.size(kept) < 2), F.lit(0.0)).otherwise(ratio)
