"""Training samples from source files: Python, reStructuredText and Markdown."""

from __future__ import annotations

import ast
import re
import warnings
from collections.abc import Callable, Iterator
from itertools import accumulate
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions import code as code_functions
from lathework.functions import titles
from lathework.functions.batches import map_columns
from lathework.functions.text import or_empty, strip, truncate
from lathework.operators.filters import public_function


def parse(source: str | None) -> ast.Module | None:
    """The tree of a Python file; None for a file that doesn't parse."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            return ast.parse(source or "")
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return None


def functions_of(source: str | None, tree: ast.Module | None = None) -> Iterator[tuple[str, str | None, str, list[str], bool]]:
    """(name, documentation, source, arguments, private) of all plain functions, level by level.

    Nested functions and methods are in, asynchronous ones aren't; a file that doesn't parse has none.
    """
    tree = tree or parse(source)
    for node in ast.walk(tree) if tree else ():
        if isinstance(node, ast.FunctionDef):
            text = ast.get_source_segment(source, node) or ""
            yield node.name, ast.get_docstring(node), text, [a.arg for a in node.args.args], node.name.startswith("_")


_FUNCTION = "fn_no int, name string, docstring string, source string, args array<string>, is_private boolean"


def function_table(df: DataFrame, key: str, source: str) -> DataFrame:
    """(key, fn_no, name, docstring, source, args, is_private) of all functions of all files."""
    kind = df.schema[key].dataType.simpleString()

    def make() -> Callable[..., tuple]:
        def work(keys: list, texts: list) -> tuple:
            rows = [(k, n, *f) for k, t in zip(keys, texts) for n, f in enumerate(functions_of(t))]
            return tuple(map(list, zip(*rows))) if rows else ([],) * 7

        return work

    return map_columns(df, [key, source], make, f"key {kind}, {_FUNCTION}")


def parsed_files(df: DataFrame, key: str, path: str, source: str) -> DataFrame:
    """(key, path, source, docstring, functions) of the files that parse, each parsed once."""
    kind = df.schema[key].dataType.simpleString()
    names = [field.split()[0] for field in _FUNCTION.split(", ")]

    def make() -> Callable[..., tuple]:
        def work(keys: list, paths: list, texts: list) -> tuple:
            rows = []
            for k, p, t in zip(keys, paths, texts):
                if (tree := parse(t)) is not None:
                    found = [dict(zip(names, (n, *f))) for n, f in enumerate(functions_of(t, tree))]
                    rows.append((k, p, t, ast.get_docstring(tree), found))
            return tuple(map(list, zip(*rows))) if rows else ([],) * 5

        return work

    functions = ", ".join(field.replace(" ", ":", 1) for field in _FUNCTION.split(", "))
    return map_columns(df, [key, path, source], make, f"key {kind}, path string, source string, docstring string, functions array<struct<{functions}>>")


def _sample(kind: str, part: Column, instruction: Column, output: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), part.cast("int").alias("part"), instruction.alias("instruction"), output.alias("output"))


def _numbered(kind: str, asked: Column, output: Column) -> Column:
    return F.transform(asked, lambda q, i: _sample(kind, i, q, output))


def python_samples(df: DataFrame, key: str = "key", path: str = "path", source: str = "source", least: int = 50, most: int = 10_000, whole: bool = True, functions: bool = True) -> DataFrame:
    """(key, kind, part, instruction, input, output) of Python files.

    Up to two samples of the whole file (without its head of comments, and only if it is not cut),
    and one of every public function. Init files and short ones give none; nor do files that don't
    parse. The key must tell files apart. Every file is parsed once, without a shuffle.
    """
    files = df.select(df[key].alias("key"), df[path].alias("path"), df[source].alias("source"))
    files = files.where(~F.coalesce(F.col("path"), F.lit("")).rlike(r"(^|/)__init__\.py$") & (F.length(strip(or_empty("source"))) >= least))
    told = parsed_files(files, "key", "path", "source").withColumn("clean", truncate(code_functions.clean_code("source"), most, "\n# ... (truncated)"))
    none = F.array().cast("array<struct<kind:string,part:int,instruction:string,output:string>>")
    asked = F.slice(titles.python_instructions("path", "docstring"), 1, 2)
    of_file = F.when(F.length("clean").between(least, most), _numbered("file", asked, F.col("clean"))).otherwise(none) if whole else none
    public = F.filter("functions", lambda f: public_function(f["name"], f["source"], least))
    one = lambda f: titles.python_instructions(F.concat(f["name"], F.lit(".py")), f["docstring"], F.translate(f["name"], "_", " "))[0]
    of_functions = F.transform(public, lambda f: _sample("function", f["fn_no"], one(f), f["source"])) if functions else none
    return told.select("key", F.explode(F.concat(of_file, of_functions)).alias("x")).select("key", "x.kind", "x.part", "x.instruction", F.lit("").alias("input"), "x.output")


def cluster_samples(df: DataFrame, key: str = "key", path: str = "path", source: str = "source") -> DataFrame:
    """As :func:`python_samples`, with the phrasings of cluster clients: all functions whatever
    their length, and two questions for every documented file."""
    files = df.select(df[key].alias("key"), df[path].alias("path"), df[source].alias("source"))
    told = parsed_files(files, "key", "path", "source").withColumn("clean", code_functions.clean_code("source"))
    none = F.array().cast("array<struct<kind:string,part:int,instruction:string,output:string>>")
    long = F.length("clean") >= 50
    whole = F.when(long, _numbered("file", titles.cluster_instructions("path", "docstring"), F.col("clean"))).otherwise(none)
    doc = F.lower(strip(F.split(or_empty("docstring"), "\n")[0]))
    first = _sample("question", F.lit(0), F.concat(F.lit("How can I "), doc, F.lit("?")), F.col("clean"))
    second = _sample("question", F.lit(1), F.concat(F.lit("What does "), titles.stem("path"), F.lit(" do?")), F.col("docstring"))
    questions = F.when(long & (or_empty("docstring") != ""), F.array(first, second)).otherwise(none)
    public = F.filter("functions", lambda f: ~f["is_private"] & (f["name"] != "main"))
    one = F.transform(public, lambda f: _sample("function", f["fn_no"], titles.function_instructions(f["name"], f["docstring"])[0], f["source"]))
    return told.select("key", F.explode(F.concat(whole, questions, one)).alias("x")).select("key", "x.kind", "x.part", "x.instruction", F.lit("").alias("input"), "x.output")


def test_samples(df: DataFrame, key: str = "key", path: str = "path", source: str = "source", least: int = 50) -> DataFrame:
    """Two samples of every test file, by built-ins alone."""
    text = or_empty(df[source])
    asked = titles.test_instructions(code_functions.docstring_prefix(text), titles.stem(df[path]))
    rows = df.where(F.length(strip(text)) >= least).select(df[key].alias("key"), F.posexplode(asked).alias("part", "instruction"), F.lit("").alias("input"), df[source].alias("output"))
    return rows


# Words one of which a literal block must hold to count as Python.
PYTHON_SIGNS = ("def ", "import ", "class ", "pytest", "assert")
_DIRECTIVE = re.compile(r"\.\.\s+(?:code-block|code)::\s*python\s*$")


def _block(lines: list[str], at: int, indent: int) -> tuple[list[str], int]:
    """The lines from ``at`` on that are blank or indented by ``indent`` at least."""
    out = []
    while at < len(lines) and (not lines[at].strip() or len(lines[at]) - len(lines[at].lstrip()) >= indent):
        out.append(lines[at])
        at += 1
    return out, at


def _dedent(lines: list[str]) -> str:
    filled = [x for x in lines if x.strip()]
    least = min((len(x) - len(x.lstrip()) for x in filled), default=0)
    return "\n".join(x[least:] if len(x) > least else x.strip() for x in lines).strip()


def rst_blocks(content: str | None, more_than: int = 20) -> list[tuple[str, str]]:
    """(context, code) of a reStructuredText file: Python directives, then literal blocks that look like Python.

    Read line by line, in time proportional to the text; the context is the line two above the
    directive, or what stands before the double colon.
    """
    lines = (content or "").split("\n")
    directives, literals = [], []
    at = 0
    while at < len(lines):
        line = lines[at]
        if _DIRECTIVE.match(line) and at >= 2 and not lines[at - 1].strip():
            held, after = _block(lines, at + 1, 1)
            text = _dedent(held)
            if len(text) > more_than:
                directives.append((lines[at - 2].strip(), text))
            at = max(after, at + 1)
            continue
        if line.rstrip().endswith("::") and at + 1 < len(lines) and not lines[at + 1].strip():
            held, after = _block(lines, at + 2, 4)
            raw = "\n".join(held)
            if any(s in raw for s in PYTHON_SIGNS):
                text = _dedent(held)
                if len(text) > more_than:
                    literals.append((line.rstrip()[:-2].strip(), text))
            at = max(after, at + 1)
            continue
        at += 1
    return directives + literals


def rst_table(df: DataFrame, key: str, source: str, *more: str) -> DataFrame:
    """(key, block_no, context, code) of reStructuredText files, with the columns ``more`` (strings) of the file."""
    kind = df.schema[key].dataType.simpleString()

    def make() -> Callable[..., tuple]:
        def work(keys: list, texts: list, *others: list) -> tuple:
            rows = [(k, n, *b, *o) for k, t, *o in zip(keys, texts, *others) for n, b in enumerate(rst_blocks(t))]
            return tuple(map(list, zip(*rows))) if rows else ([],) * (4 + len(more))

        return work

    return map_columns(df, [key, source, *more], make, ", ".join([f"key {kind}, block_no int, context string, code string", *[f"{c} string" for c in more]]))


def rst_samples(df: DataFrame, key: str = "key", source: str = "source", least: int = 50) -> DataFrame:
    """Up to two samples of every Python block of a reStructuredText file."""
    files = df.select(df[key].alias("key"), df[source].alias("source"), code_functions.rst_title(df[source]).alias("title"))
    blocks = rst_table(files, "key", "source", "title").where(F.length("code") >= least)
    asked = titles.rst_instructions("context", "title")
    return blocks.select("key", "block_no", F.posexplode(asked).alias("part", "instruction"), F.lit("").alias("input"), F.col("code").alias("output"))


def markdown_table(df: DataFrame, key: str, source: str) -> DataFrame:
    """(key, block_no, context, code) of the Python blocks of Markdown files, by built-ins alone."""
    cut = df.select(df[key].alias("key"), F.posexplode(code_functions.markdown_blocks(df[source])).alias("block_no", "x"))
    return cut.select("key", "block_no", "x.context", "x.code")


def markdown_samples(df: DataFrame, key: str = "key", path: str = "path", source: str = "source", least: int = 50) -> DataFrame:
    """One sample of every Python block of a Markdown file."""
    cut = df.select(df[key].alias("key"), df[path].alias("path"), F.posexplode(code_functions.markdown_blocks(df[source])).alias("block_no", "x"))
    blocks = cut.where(F.length("x.code") >= least)
    return blocks.select("key", "block_no", titles.markdown_instruction(F.col("x.context"), F.col("path")).alias("instruction"), F.lit("").alias("input"), F.col("x.code").alias("output"))


_DEFINED = re.compile(r"(def|class) (\w*)")


def _part_of(line: str) -> str | None:
    """The name of the part that a line begins, None where it goes on with the one before."""
    if line.startswith(("import ", "from ")):
        return "Imports"
    m = _DEFINED.match(line)
    if not m:
        return None
    kind = "function" if m[1] == "def" else "class"
    return (f"Define {m[2]}()" if kind == "function" else f"Define {m[2]} class") if m[2] else f"Define {kind}"


def code_sections(code: str | None) -> list[tuple[str, str]]:
    """(name, code) of a file's parts: imports in a row, functions and classes at the margin, what stands before as ``Setup``."""
    lines = (code or "").split("\n")
    parts = [_part_of(line) for line in lines]
    current = list(accumulate(parts, lambda name, new: new or name, initial="Setup"))
    cuts = [at for at, name in enumerate(parts) if name and not name == current[at] == "Imports"]
    starts = cuts if cuts[:1] == [0] else [0, *cuts]
    return [(current[a + 1], "\n".join(lines[a:b])) for a, b in zip(starts, [*starts[1:], len(lines)])]


def code_section_table(df: DataFrame, key: str, source: str) -> DataFrame:
    """(key, section_no, name, code) of all files."""
    kind = df.schema[key].dataType.simpleString()

    def make() -> Callable[..., tuple]:
        def work(keys: list, texts: list) -> tuple:
            rows = [(k, n, *s) for k, t in zip(keys, texts) for n, s in enumerate(code_sections(t))]
            return tuple(map(list, zip(*rows))) if rows else ([],) * 4

        return work

    return map_columns(df, [key, source], make, f"key {kind}, section_no int, name string, code string")


def file_stem(path: str) -> str:
    return PurePosixPath(path).stem
