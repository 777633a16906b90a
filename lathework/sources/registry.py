"""Collectors by name: where records come from, and how they become pairs."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions.keys import pair_key
from lathework.operators.dedup import first_per_key, top_per_group
from lathework.operators.linkgraph import crawl
from lathework.operators.qa import best_answers, best_comments, from_code, from_discussions, from_issues, from_pages, from_questions
from lathework.sources import api, files

_COLLECTORS: dict[str, type[Collector]] = {}


class Collector(ABC):
    """A plug-in: raw records, their transformation, and what its options are."""

    description = ""
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()

    def __init__(self, **options: str) -> None:
        self.options = options
        missing = [k for k in self.required if k not in options]
        if missing:
            raise ValueError(f"missing options: {', '.join(missing)}")

    @abstractmethod
    def raw(self, spark: SparkSession) -> DataFrame: ...

    @abstractmethod
    def transform(self, raw: DataFrame) -> DataFrame: ...

    def order(self, pairs: DataFrame):
        return F.col("source")

    def run(self, spark: SparkSession, limit: int = 0) -> DataFrame:
        """Pairs without repeats, the first of each kept; ``limit`` counts raw records, 0 is none."""
        raw = self.raw(spark)
        pairs = self.transform(raw.limit(limit) if limit else raw)
        return first_per_key(pairs, pair_key("instruction", "output"), "source")


def collector(name: str) -> Callable[[type[Collector]], type[Collector]]:
    """Register a collector; a name can be taken once."""

    def add(cls: type[Collector]) -> type[Collector]:
        if name in _COLLECTORS:
            raise ValueError(f"collector {name} exists")
        _COLLECTORS[name] = cls
        return cls

    return add


def names() -> list[str]:
    return sorted(_COLLECTORS)


def create(name: str, **options: str) -> Collector:
    if name not in _COLLECTORS:
        raise KeyError(f"no collector {name}; there are {', '.join(names())}")
    return _COLLECTORS[name](**options)


def describe(spark: SparkSession) -> DataFrame:
    """(name, description, required, optional) of all collectors."""
    rows = [(n, c.description, list(c.required), list(c.optional)) for n, c in sorted(_COLLECTORS.items())]
    return spark.createDataFrame(rows, "name string, description string, required array<string>, optional array<string>")


@collector("stackoverflow")
class QuestionSite(Collector):
    description = "Questions with their best answer"
    required = ("path",)
    optional = ("keys", "pages", "min_score", "max_per_tag")

    def raw(self, spark: SparkSession) -> DataFrame:
        api.register(spark)
        return spark.read.format("qa_site").options(**{k: v for k, v in self.options.items() if k != "max_per_tag"}).load()

    def transform(self, raw: DataFrame) -> DataFrame:
        rows = raw.select("question", "tag", F.explode("answers").alias("answer")).select("question", "tag", F.col("question.question_id").alias("question_id"), "answer.*")
        best = best_answers(rows)
        made = best.select("question", "tag", F.struct("answer_id", "body", "score", "is_accepted").alias("answer"))
        if most := int(self.options.get("max_per_tag", 0)):  # of the questions that have an answer
            made = top_per_group(made, "tag", most, F.col("question.score").desc(), F.col("question.question_id"))
        return from_questions(made)


@collector("github")
class CodeHost(Collector):
    """``kind`` is ``issues``, ``discussions`` or ``examples``."""

    description = "Issues with their best comment, answered discussions, or example files"
    required = ("path",)
    optional = ("keys", "pages", "kind")

    def raw(self, spark: SparkSession) -> DataFrame:
        api.register(spark)
        kind = self.options.get("kind", "issues")
        name = {"issues": "code_host", "discussions": "code_host_discussions", "examples": "code_host_examples"}[kind]
        return spark.read.format(name).options(**{k: v for k, v in self.options.items() if k != "kind"}).load()

    def transform(self, raw: DataFrame) -> DataFrame:
        kind = self.options.get("kind", "issues")
        if kind == "discussions":
            return from_discussions(raw)
        if kind == "examples":
            return from_code(raw)
        keyed = raw.withColumn("issue_id", F.concat_ws("#", "repo", F.col("issue.number").cast("string")))
        rows = keyed.select("repo", "issue", "issue_id", F.explode("comments").alias("c")).select("repo", "issue", "issue_id", "c.seq", "c.body", "c.reactions")
        best = best_comments(rows)
        return from_issues(best.select("repo", "issue", F.struct("body", "reactions").alias("solution")))


@collector("web")
class Web(Collector):
    """``path`` holds recorded pages (url, html) as Parquet, ``urls`` the starts, by commas."""

    description = "Pages that are reached from given ones"
    required = ("path", "urls")
    optional = ("max_pages", "max_depth", "pattern")

    def raw(self, spark: SparkSession) -> DataFrame:
        starts = spark.createDataFrame([(u,) for u in self.options["urls"].split(",")], "url string")
        o = self.options
        return crawl(spark.read.parquet(o["path"]), starts, int(o.get("max_pages", 100)), int(o.get("max_depth", 3)), o.get("pattern"))

    def transform(self, raw: DataFrame) -> DataFrame:
        return from_pages(raw)


@collector("jsonl")
class Lines(Collector):
    description = "Pairs that were collected before"
    required = ("path",)

    def raw(self, spark: SparkSession) -> DataFrame:
        return files.json_lines(spark, self.options["path"], files.SAMPLE + ", source string")

    def transform(self, raw: DataFrame) -> DataFrame:
        return raw.where(F.col("instruction").isNotNull() & F.col("output").isNotNull())
