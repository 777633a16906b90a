"""Question-site and code-host records as data sources, over recorded answers of their interfaces.

A fixture folder has one JSON file a tag (or repository) and page, ``<key>.<page>.json`` with a list
``items`` and ``has_more``; a fetcher for the network can take its place in a subclass.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lathework.session import broadcast_small

QUESTION = (
    "question struct<question_id:bigint,title:string,body:string,score:int,tags:array<string>,link:string>, "
    "answers array<struct<answer_id:bigint,body:string,score:int,is_accepted:boolean>>, tag string"
)
ISSUE = (
    "repo string, issue struct<number:bigint,title:string,body:string,html_url:string,comments:int,is_pull:boolean>, "
    "comments array<struct<seq:int,body:string,reactions:map<string,int>>>"
)

DISCUSSION = "repo string, discussion struct<title:string,body:string,url:string,category:string,answer:struct<body:string,upvoteCount:int>>"
CODE = "repo string, path string, content string, html_url string"


class KeyPartition(InputPartition):
    """All pages of one tag or repository."""


class PagesReader(DataSourceReader):
    """Reads pages of a key until one says there are no more, or the page limit is reached."""

    def __init__(self, schema, options: dict) -> None:
        self.schema = schema
        self.folder = options["path"]
        self.keys = [k for k in options.get("keys", "").split(",") if k]
        self.most_pages = int(options.get("pages", 5))
        self.least_score = int(options.get("min_score", 0))

    def place(self) -> tuple[FileSystem, str]:
        """The file system and path of the folder, which may be any that the workers share."""
        return FileSystem.from_uri(self.folder) if ":" in self.folder else (LocalFileSystem(), self.folder)

    def partitions(self) -> list[InputPartition]:
        system, root = self.place()
        found = self.keys or sorted({re.sub(r"\.\d+\.json$", "", f.base_name) for f in system.get_file_info(FileSelector(root)) if f.base_name.endswith(".json")})
        return [KeyPartition(k) for k in found]

    def pages(self, key: str) -> Iterator[dict]:
        system, root = self.place()
        for page in range(1, self.most_pages + 1):
            path = f"{root}/{key}.{page}.json"
            if system.get_file_info(path).type != FileType.File:
                return
            with system.open_input_stream(path) as raw:
                found = json.loads(raw.read())
            yield found
            if not found.get("has_more"):
                return


class QuestionReader(PagesReader):
    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for page in self.pages(partition.value):
            for item in page.get("items", []):
                if (item.get("score") or 0) < self.least_score:
                    continue
                question = (item.get("question_id"), item.get("title"), item.get("body"), item.get("score"), item.get("tags") or [], item.get("link"))
                answers = [(a.get("answer_id"), a.get("body"), a.get("score"), bool(a.get("is_accepted"))) for a in item.get("answers", [])]
                yield question, answers, partition.value


class IssueReader(PagesReader):
    def read(self, partition: InputPartition) -> Iterator[tuple]:
        repo = partition.value.replace("__", "/")
        for page in self.pages(partition.value):
            for item in page.get("items", []):
                if item.get("pull_request") is not None or not item.get("comments"):
                    continue
                issue = (item.get("number"), item.get("title"), item.get("body"), item.get("html_url"), len(item["comments"]), False)
                comments = [(n, c.get("body"), {k: v for k, v in (c.get("reactions") or {}).items() if isinstance(v, int)}) for n, c in enumerate(item["comments"])]
                yield repo, issue, comments


class DiscussionReader(PagesReader):
    """Discussions as they are, answered or not."""

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        repo = partition.value.replace("__", "/")
        for page in self.pages(partition.value):
            for item in page.get("items", []):
                category, answer = item.get("category"), item.get("answer")
                told = (answer.get("body"), answer.get("upvoteCount")) if answer else None
                yield repo, (item.get("title"), item.get("body"), item.get("url"), category.get("name") if isinstance(category, dict) else category, told)


#: Folders in which a repository's examples are looked for.
EXAMPLE_FOLDERS = ("examples", "docs/examples", "samples", "demo")


class CodeReader(PagesReader):
    """Python files of the example folders."""

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        repo = partition.value.replace("__", "/")
        for page in self.pages(partition.value):
            for item in page.get("items", []):
                path = item.get("path") or ""
                if path.endswith(".py") and path.rpartition("/")[0] in EXAMPLE_FOLDERS:
                    yield repo, path, item.get("content"), item.get("html_url")


class SearchReader(PagesReader):
    """Repositories found by a query, a page of answers after the other."""

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for number, page in enumerate(self.pages(partition.value)):
            for at, item in enumerate(page.get("items", [])):
                yield partition.value, number, at, item.get("full_name"), item.get("stargazers_count")


class Recorded(DataSource):
    """A data source over recorded answers, with its schema and reader."""

    made: type[PagesReader]
    columns = ""

    def schema(self) -> str:
        return self.columns

    def reader(self, schema) -> DataSourceReader:
        return self.made(schema, self.options)


class QuestionSource(Recorded):
    """``spark.read.format("qa_site").option("path", ...).load()``, a partition a tag."""

    made, columns = QuestionReader, QUESTION

    @classmethod
    def name(cls) -> str:
        return "qa_site"


class IssueSource(Recorded):
    """``spark.read.format("code_host").option("path", ...).load()``, a partition a repository."""

    made, columns = IssueReader, ISSUE

    @classmethod
    def name(cls) -> str:
        return "code_host"


class DiscussionSource(Recorded):
    """Discussions of repositories."""

    made, columns = DiscussionReader, DISCUSSION

    @classmethod
    def name(cls) -> str:
        return "code_host_discussions"


class CodeSource(Recorded):
    """Example files of repositories."""

    made, columns = CodeReader, CODE

    @classmethod
    def name(cls) -> str:
        return "code_host_examples"


class SearchSource(Recorded):
    """Answers to searches for repositories, a partition a query."""

    made, columns = SearchReader, "query string, page int, position int, full_name string, stars bigint"

    @classmethod
    def name(cls) -> str:
        return "code_host_search"


def register(spark) -> None:
    for source in (QuestionSource, IssueSource, DiscussionSource, CodeSource, SearchSource):
        spark.dataSource.register(source)


def found_repositories(found: DataFrame, queries: DataFrame, least_stars: int = 0, most: int = 100) -> DataFrame:
    """(query, full_name, stars): up to ``most`` repositories a query that no query before has found.

    ``queries`` has (query, query_no). A name counts for the first query that has it, and there
    where it stands first; then the first ``most`` of every query by page and position are kept.
    """
    rows = found.where((F.col("stars") >= least_stars) & F.col("full_name").isNotNull()).join(broadcast_small(queries), "query")
    first = rows.groupBy("full_name").agg(F.min(F.struct("query_no", "page", "position", "query", "stars")).alias("x")).select("full_name", "x.*")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("page", "position", "full_name"))
    return first.withColumn("n", rank).where(F.col("n") <= most).select("query", "full_name", "stars")
