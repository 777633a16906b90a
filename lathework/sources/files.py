"""Readers and writers of the pipeline's file layouts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lathework.operators.filters import wanted_file
from lathework.operators.formats import alpaca, sharegpt
from lathework.session import cut_lineage

SAMPLE = "instruction string, input string, output string"
_NAME = r"([^/]*)$"
_STEM = r"([^/]*?)(?:\.[^./]*)?$"


def _stem(path: Column) -> Column:
    return F.regexp_extract(path, _STEM, 1)


def html_dir(spark: SparkSession, path: str) -> DataFrame:
    """(path, basename, html) of all ``*.html`` below a folder."""
    read = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.html")
    return read.select(F.col("_metadata.file_path").alias("path"), _stem(F.col("_metadata.file_path")).alias("basename"), F.col("value").alias("html"))


def sidecars(spark: SparkSession, path: str) -> DataFrame:
    """(basename, url, title) of the JSON files beside pages."""
    read = spark.read.schema("url string, title string, filename string").json(path, multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    return read.select(_stem(F.col("_metadata.file_path")).alias("basename"), "url", "title")


def pages_with_meta(pages: DataFrame, meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages with their url and title, and the pages that have none."""
    return pages.join(meta, "basename"), pages.join(meta, "basename", "left_anti")


def json_documents(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """One JSON object or list a file, with the file's name."""
    return spark.read.schema(schema).json(path, multiLine=True, pathGlobFilter="*.json").withColumn("file_name", F.col("_metadata.file_name"))


def json_lines(spark: SparkSession, path: str, schema: str | StructType = SAMPLE) -> DataFrame:
    """One JSON object a line; a path that doesn't exist raises."""
    return spark.read.schema(schema).json(path)


def combine(spark: SparkSession, folder: str, pattern: str = "*_alpaca.json") -> DataFrame:
    """(file_name, position, instruction, input, output) of all datasets of a folder, unreadable files skipped.

    Order by the file's name and the position in it is explicit, since files are read in parallel.
    """
    whole = spark.read.option("ignoreCorruptFiles", True).text(folder, wholetext=True, pathGlobFilter=pattern)
    listed = F.from_json("value", f"array<struct<{SAMPLE.replace(' string', ':string')}>>")
    cut = whole.select(F.col("_metadata.file_name").alias("file_name"), F.posexplode(listed).alias("position", "x"))
    return cut.select("file_name", "position", F.coalesce("x.instruction", F.lit("")).alias("instruction"), F.coalesce("x.input", F.lit("")).alias("input"), F.coalesce("x.output", F.lit("")).alias("output"))


def code_tree(spark: SparkSession, path: str, source_type: str = "python", subfolders: bool = True) -> DataFrame:
    """(path, source) of the source files of a tree, by its kind."""
    globs = {"python": "*.py", "rst": "*.rst", "markdown": "*.{md,markdown}", "mixed": "*.{py,rst,md}"}
    read = spark.read.text(path, wholetext=True, recursiveFileLookup=subfolders, pathGlobFilter=globs.get(source_type, "*.py"))
    found = read.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("source"))
    return found.where(wanted_file("path", source_type))


def git_source(spark: SparkSession, name: str, paths: list[str], source_type: str = "python") -> DataFrame:
    """(source_name, path, source) of several folders of one repository; folders that are missing are skipped."""
    return git_result(spark, name, paths, source_type).where("error IS NULL").drop("error")


def git_result(spark: SparkSession, name: str, paths: list[str], source_type: str = "python") -> DataFrame:
    """(source_name, path, source, error): the files, and one row with the error of every folder that is missing."""
    out = spark.createDataFrame([], "path string, source string, error string")
    for path in paths:
        try:
            one = code_tree(spark, path, source_type).withColumn("error", F.lit(None).cast("string"))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            one = spark.createDataFrame([(path, None, f"no folder {path}")], "path string, source string, error string")
        out = out.unionByName(one)
    return out.select(F.lit(name).alias("source_name"), "path", "source", "error")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of all files below a folder."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return read.select("path", F.sha2("content", 256).alias("sha256"))


# --- Writers ----------------------------------------------------------------------------------


def write_lines(df: DataFrame, path: str) -> None:
    """JSON lines, UTF-8, in parallel."""
    df.write.mode("overwrite").json(path)


def write_array(df: DataFrame, path: str, order: list[Column] | None = None, files: int = 1) -> None:
    """JSON lists in text files, one by default, with the rows in ``order``.

    Rows are streamed, so no list is ever held in memory; one file is one task, and ``files`` makes
    as many in parallel, each a list of its own, in the order of their names. An empty table makes
    an empty list.
    """
    columns = [df[c] for c in df.columns]
    if order:
        df = df.repartitionByRange(files, *order).sortWithinPartitions(*order) if files > 1 else df.repartition(1).sortWithinPartitions(*order)
    else:
        df = df.repartition(files)
    rows = df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "[\n"
        for batch in batches:
            out = []
            for row in batch.column(0).to_pylist():
                out.append(mark + row)
                mark = ","
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})
        yield pa.RecordBatch.from_pydict({"value": pa.array(["[\n]" if mark != "," else "]"], pa.string())})

    rows.mapInArrow(lists, "value string").write.mode("overwrite").text(path)


def write_text(df: DataFrame, path: str, column: str = "text") -> None:
    df.select(F.concat(F.coalesce(df[column], F.lit("")), F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def write_collected(df: DataFrame, folder: str, name: str, layout: str = "alpaca") -> str:
    """A collector's pairs in a layout, under ``<folder>/<name>_<layout>``; the path."""
    path = f"{folder}/{name}_{layout}"
    if layout == "alpaca":
        write_lines(alpaca(df), path)
    elif layout == "sharegpt":
        write_lines(df.select(sharegpt().alias("conversations")), path)
    elif layout == "full":
        write_lines(df, path)
    else:
        raise ValueError(f"no layout {layout}")
    return path


def write_by_key(df: DataFrame, path: str, key: str) -> None:
    """Parquet in folders by a column of few values."""
    df.write.mode("overwrite").partitionBy(key).parquet(path)


def write_files(df: DataFrame, folder: str, name: Column, content: Column, order: Column) -> DataFrame:
    """(name) of the files that are written, one a name, in parallel.

    Of several rows of one name the last by ``order`` is kept, as when files overwrite each other.
    A file is written under a name of its own and moved, so a task that is repeated does no harm.
    Rows with a null name or content write none. ``folder`` is any place that the workers share.
    """
    rows = df.select(name.alias("name"), content.alias("content"), order.alias("order")).where("name IS NOT NULL AND content IS NOT NULL")
    last = rows.groupBy("name").agg(F.max_by("content", F.struct("order", "content")).alias("content"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (LocalFileSystem(), folder)
        made: set[str] = set()
        for batch in batches:
            for file, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = f"{root}/{file}"
                parent = target.rpartition("/")[0]
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                fresh = f"{parent}/.{uuid.uuid4().hex}"
                with system.open_output_stream(fresh) as out:
                    out.write(text.encode("utf-8", "replace"))
                system.move(fresh, target)
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])

    return cut_lineage(last.select("name", "content").mapInArrow(write, "name string"))


def write_meta(meta: DataFrame, path: str) -> None:
    """One row of facts about a dataset as one JSON file."""
    meta.coalesce(1).write.mode("overwrite").json(path)
