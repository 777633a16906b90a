"""Markdown cut into sections, and sections into chunks of bounded size."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate
from operator import xor

from pyspark.sql import DataFrame

from lathework.functions.batches import map_columns
from lathework.functions.keys import uuid5

FENCE = "`" * 3
MAX_TOKENS, MIN_TOKENS = 1024, 512


def sections_of(markdown: str | None) -> list[tuple[str, str]]:
    """(title, content) by lines that begin with ``#``; code fences are not respected.

    What stands before the first heading is called ``intro``; headings without a line below give nothing.
    """
    lines = (markdown or "").splitlines()
    heads = [at for at, line in enumerate(lines) if line.lstrip().startswith("#")]
    spans = zip([-1, *heads], [*heads, len(lines)])
    return [("intro" if head < 0 else lines[head].lstrip().lstrip("#").strip(), "\n".join(lines[head + 1 : stop])) for head, stop in spans if stop - head > 1]


def _whole_until(lines: list[str]) -> list[bool]:
    """Of every line whether a chunk may end behind it: no code fence is open, and no table.

    A fence is open behind an odd number of its marks; a table behind a row that stands in no fence,
    up to the next blank line.
    """
    bare = [line.strip() for line in lines]
    fenced = list(accumulate((x.startswith(FENCE) for x in bare), xor))
    rows = accumulate((at if x.startswith("|") and not inside else -1 for at, (x, inside) in enumerate(zip(bare, fenced))), max)
    blanks = accumulate((-1 if x else at for at, x in enumerate(bare)), max)
    return [not inside and row <= blank for inside, row, blank in zip(fenced, rows, blanks)]


def chunks_of(content: str, most: int = MAX_TOKENS, least: int = MIN_TOKENS, lossless: bool = False) -> list[str]:
    """Runs of lines of about ``most`` tokens (four characters each), never ended within a code fence or a table.

    A rest under ``least`` tokens is dropped unless it is the only chunk; ``lossless`` keeps it. The
    length of a run is a difference of two running sums, so a section is read once.
    """
    lines = content.splitlines()
    ends = list(accumulate((len(line) + 1 for line in lines), initial=0))
    tokens = lambda a, b: max(1, (ends[b] - ends[a] - 1) // 4)
    out, start = [], 0
    for stop, whole in enumerate(_whole_until(lines), 1):
        if whole and tokens(start, stop) >= most:
            out.append("\n".join(lines[start:stop]))
            start = stop
    if start < len(lines) and (not out or lossless or tokens(start, len(lines)) >= least):
        out.append("\n".join(lines[start:]))
    return out


def split_sections(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, section_no, section_title, content); null and empty texts give no rows."""
    kind = df.schema[id_column].dataType.simpleString()

    def make() -> Callable[..., tuple]:
        def work(keys: list, texts: list) -> tuple:
            rows = [(k, n, *s) for k, t in zip(keys, texts) for n, s in enumerate(sections_of(t))]
            return tuple(map(list, zip(*rows))) if rows else ([],) * 4

        return work

    return map_columns(df, [id_column, text_column], make, f"doc_id {kind}, section_no int, section_title string, content string")


def split_chunks(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", most: int = MAX_TOKENS, least: int = MIN_TOKENS, lossless: bool = False) -> DataFrame:
    """(doc_id, section_no, section, chunk_no, chunk_id, text) of all documents.

    The chunk id is made of document, section title and number, so sections of one title share
    ids; :func:`lathework.operators.dedup.last_per_key` keeps the last of them, as files would.
    """
    kind = df.schema[id_column].dataType.simpleString()

    def make() -> Callable[..., tuple]:
        def work(keys: list, texts: list) -> tuple:
            rows = [(k, n, title, i, c) for k, t in zip(keys, texts) for n, (title, body) in enumerate(sections_of(t)) for i, c in enumerate(chunks_of(body, most, least, lossless))]
            return tuple(map(list, zip(*rows))) if rows else ([],) * 5

        return work

    cut = map_columns(df, [id_column, text_column], make, f"doc_id {kind}, section_no int, section string, chunk_no int, text string")
    return cut.withColumn("chunk_id", uuid5("doc_id", "section", "chunk_no"))


def running_sections(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, line_no, section_no, line): every line with the number of headings up to it, counted in one pass over a document, without a shuffle."""
    kind = df.schema[id_column].dataType.simpleString()

    def make() -> Callable[..., tuple]:
        def work(keys: list, texts: list) -> tuple:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for key, text in zip(keys, texts):
                lines = (text or "").split("\n")
                counts = accumulate(line.lstrip(" ").startswith("#") for line in lines)
                for column, values in zip(out, ([key] * len(lines), range(len(lines)), map(int, counts), lines)):
                    column += values
            return out

        return work

    return map_columns(df, [id_column, text_column], make, f"doc_id {kind}, line_no int, section_no bigint, line string")
