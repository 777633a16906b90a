"""Source code as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lathework.functions.text import Name, col, let, lines, or_empty, strip

FENCE = "`" * 3


def clean_code(c: Name) -> Column:
    """Code without the comments and blank lines it begins with; all-comment code stays, stripped."""
    rows = F.transform(lines(c), lambda x: strip(x))
    first = F.array_position(F.transform(rows, lambda x: ~(x.startswith("#") | (x == ""))), F.lit(True))
    kept = F.slice(lines(c), F.greatest(first, F.lit(1)).cast("int"), F.size(rows))
    return strip(F.array_join(kept, "\n"))


def dedent(c: Name) -> Column:
    """Code without the indent that all its lines share; shorter lines are stripped."""
    indents = F.transform(F.filter(lines(c), lambda x: strip(x) != ""), lambda x: F.length(x) - F.length(F.regexp_replace(x, r"^\s+", "")))

    def cut(least: Column) -> Column:
        rows = F.transform(lines(c), lambda x: F.when(F.length(x) > least, F.substr(x, least + 1)).otherwise(strip(x)))
        return F.when(least.isNull(), or_empty(c)).otherwise(F.array_join(rows, "\n"))

    return strip(let(F.array_min(indents), cut))


def rst_title(c: Name) -> Column:
    """The first line that is underlined; empty where none is."""
    here = lines(c)
    under = F.slice(here, 2, F.size(here))
    marked = F.zip_with(
        here, under, lambda a, b: F.when((strip(a) != "") & b.isNotNull() & (b != "") & strip(b).rlike("^[=~^-]*$"), strip(a))
    )
    return F.coalesce(F.get(F.filter(marked, lambda x: x.isNotNull()), F.lit(0)), F.lit(""))


def code_description(c: Name) -> Column:
    """The first line of a module's documentation, else of its first comment; null where it begins otherwise."""
    doc = lambda q: F.regexp_extract(col(c), rf"(?s)^{q}(.*?){q}", 1)
    has = lambda q: col(c).rlike(rf"(?s)^{q}.*?{q}")
    first = lambda x: F.split(strip(x), "\n")[0]
    comment = F.regexp_extract(col(c), r"^#\s*([^\n]+)", 1)
    return F.when(has('"""'), first(doc('"""'))).when(has("'''"), first(doc("'''"))).when(comment != "", strip(comment))


def docstring_prefix(c: Name) -> Column:
    """What stands in the triple quotes a file begins with, stripped; empty where it doesn't."""
    return strip(F.regexp_extract(or_empty(c), r'(?s)^"""(.*?)"""', 1))


def markdown_blocks(c: Name, more_than: int = 20) -> Column:
    """(context, code) of Python blocks; the context is the line before."""
    pattern = rf"(?:^|\n)([^\n]*)\n{FENCE}(?:python|py)\n((?s:.*?)){FENCE}"
    text = or_empty(c)
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("context"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("code"))
    clean = F.transform(pairs, lambda p: F.struct(strip(p["context"]).alias("context"), strip(p["code"]).alias("code")))
    return F.filter(clean, lambda p: F.length(p["code"]) > more_than)


def fenced_python(c: Name, more_than: int = 50) -> Column:
    """All fenced Python code of more than ``more_than`` characters."""
    found = F.regexp_extract_all(or_empty(c), F.lit(rf"(?s){FENCE}python\n(.*?){FENCE}"), F.lit(1))
    return F.filter(F.transform(found, strip), lambda x: F.length(x) > more_than)
