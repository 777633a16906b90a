"""Records of question sites, code hosts and crawled pages as question-answer pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathework.functions.code import FENCE, code_description
from lathework.functions.keys import url_hash
from lathework.functions.text import Name, col, or_empty, truncate
from lathework.functions.titles import title_to_explain, title_to_question
from lathework.functions.web import clean_html, tags_of

QA_COLUMNS = ("instruction", "input", "output", "source", "source_type", "score", "tags", "url", "metadata")


def best_answers(answers: DataFrame, question: str = "question_id", order: str = "answer_id", score: str = "score", accepted: str = "is_accepted") -> DataFrame:
    """One answer a question: the first accepted one with a score from 0, else the one of most votes if that is from 0.

    Found by an aggregation that combines before the shuffle; ties go to the least ``order``.
    """
    points = F.coalesce(answers[score], F.lit(0))
    good = F.coalesce(answers[accepted], F.lit(False)) & (points >= 0)
    rank = F.struct(F.when(good, 0).otherwise(1), F.when(good, F.lit(0)).otherwise(-points), answers[order])
    best = answers.where(points >= 0).groupBy(answers[question]).agg(F.min_by(F.struct(*[answers[c] for c in answers.columns]), rank).alias("x"))
    return best.select("x.*")


def comment_score(reactions: Column, body: Column) -> Column:
    """Points of a comment by its reactions, and one for length."""
    n = lambda k: F.coalesce(F.try_element_at(reactions, F.lit(k)), F.lit(0))
    return n("+1") * 2 + n("heart") * 2 + n("hooray") + n("rocket") - n("-1") * 2 + F.when(F.length(or_empty(body)) > 200, 1).otherwise(0)


def best_comments(comments: DataFrame, issue: str = "issue_id", order: str = "seq") -> DataFrame:
    """The comment of most points of every issue, the first of ties; none where all have -1 or less."""
    scored = comments.withColumn("points", comment_score(comments["reactions"], comments["body"])).where(F.col("points") > -1)
    best = scored.groupBy(issue).agg(F.max_by(F.struct(*[F.col(c) for c in scored.columns]), F.struct(F.col("points"), -F.col(order))).alias("x"))
    return best.select("x.*")


def _text_map(**values: Column) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(k) for k in values]), F.array(*[v.cast("string") for v in values.values()]))


def from_questions(df: DataFrame) -> DataFrame:
    """Pairs of (question, answer, tag) records of a question site; answers under 100 characters are left out."""
    q, a = df["question"], df["answer"]
    body, answer = clean_html(q["body"]), clean_html(a["body"])
    out = df.select(
        title_to_question(or_empty(q["title"])).alias("instruction"), F.when(F.length(body) > 50, body).otherwise("").alias("input"), answer.alias("output"),
        F.concat(F.lit("stackoverflow:"), q["question_id"].cast("string")).alias("source"), F.lit("stackoverflow").alias("source_type"), F.coalesce(a["score"], F.lit(0)).cast("int").alias("score"),
        F.coalesce(q["tags"], F.array().cast("array<string>")).alias("tags"), or_empty(q["link"]).alias("url"),
        _text_map(question_score=q["score"], answer_score=a["score"], is_accepted=a["is_accepted"], primary_tag=df["tag"]).alias("metadata"),
    )
    return out.where(F.length("output") >= 100)


def from_issues(df: DataFrame) -> DataFrame:
    """Pairs of (repo, issue, solution) records."""
    issue, solution, repo = df["issue"], df["solution"], df["repo"]
    out = df.select(
        or_empty(issue["title"]).alias("instruction"), truncate(or_empty(issue["body"]), 500, "...").alias("input"), or_empty(solution["body"]).alias("output"),
        F.concat(F.lit("github:"), repo, F.lit(":"), issue["number"].cast("string")).alias("source"), F.lit("github").alias("source_type"),
        F.coalesce(F.try_element_at(solution["reactions"], F.lit("+1")), F.lit(0)).cast("int").alias("score"), F.array(F.split(repo, "/")[0]).alias("tags"), or_empty(issue["html_url"]).alias("url"),
        _text_map(repo=repo, issue_number=issue["number"]).alias("metadata"),
    )
    return out.where(F.length("output") >= 100)


def from_discussions(df: DataFrame) -> DataFrame:
    """Pairs of (repo, discussion) records that have an answer."""
    talk, repo = df["discussion"], df["repo"]
    out = df.where(talk["answer"]["body"].isNotNull()).select(
        or_empty(talk["title"]).alias("instruction"), truncate(or_empty(talk["body"]), 500, "...").alias("input"), or_empty(talk["answer"]["body"]).alias("output"),
        F.concat(F.lit("github:"), repo, F.lit(":discussion")).alias("source"), F.lit("github").alias("source_type"), F.coalesce(talk["answer"]["upvoteCount"], F.lit(0)).cast("int").alias("score"),
        F.array(F.split(repo, "/")[0], F.lit("discussion")).alias("tags"), or_empty(talk["url"]).alias("url"), _text_map(repo=repo, category=talk["category"]).alias("metadata"),
    )
    return out.where(F.length("output") >= 100)


def from_code(df: DataFrame) -> DataFrame:
    """Pairs of (repo, path, content, html_url) records of example files."""
    content, repo = or_empty(df["content"]), df["repo"]
    name = F.regexp_extract(or_empty(df["path"]), r"([^/]*)$", 1)
    told = F.coalesce(F.nullif(code_description(content), F.lit("")), F.concat(F.lit("Example from "), repo, F.lit(": "), name))
    out = df.where(F.length(content).between(50, 10_000)).select(
        F.concat(F.lit("Show me a Python example for "), told).alias("instruction"), F.lit("").alias("input"), F.concat(F.lit(f"{FENCE}python\n"), content, F.lit(f"\n{FENCE}")).alias("output"),
        F.concat(F.lit("github:"), repo, F.lit(":"), df["path"]).alias("source"), F.lit("github").alias("source_type"), F.lit(0).alias("score"), F.array(F.split(repo, "/")[0], F.lit("example")).alias("tags"),
        or_empty(df["html_url"]).alias("url"), _text_map(repo=repo, path=df["path"]).alias("metadata"),
    )
    return out


def page_answer(content: Name, blocks: Name) -> Column:
    """The first 2,000 characters of a page and up to three of its code blocks."""
    kept = F.filter(F.slice(F.coalesce(col(blocks), F.array().cast("array<struct<language:string,code:string>>")), 1, 3), lambda b: or_empty(b["code"]) != "")
    shown = F.transform(kept, lambda b: F.concat(F.lit(f"\n{FENCE}"), or_empty(b["language"]), F.lit("\n"), b["code"], F.lit(f"\n{FENCE}\n")))
    tail = F.when(F.size(F.coalesce(col(blocks), F.array().cast("array<struct<language:string,code:string>>"))) > 0, F.concat(F.lit("\n\nExample code:\n"), F.array_join(shown, ""))).otherwise("")
    return F.concat(F.substring(or_empty(content), 1, 2000), tail)


def from_pages(df: DataFrame) -> DataFrame:
    """Pairs of crawled pages (url, domain, depth, title, content, code_blocks) with an answer from 200 characters."""
    kept = df.where((or_empty(df["title"]) != "") & (or_empty(df["content"]) != ""))
    out = kept.select(
        title_to_explain(kept["title"]).alias("instruction"), F.lit("").alias("input"), page_answer(kept["content"], kept["code_blocks"]).alias("output"),
        F.concat(F.lit("web:"), url_hash(kept["url"])).alias("source"), F.lit("web").alias("source_type"), F.lit(0).alias("score"), tags_of(kept["url"], kept["content"]).alias("tags"), kept["url"].alias("url"),
        _text_map(domain=kept["domain"], depth=kept["depth"], code_blocks=F.size(kept["code_blocks"])).alias("metadata"),
    )
    return out.where(F.length("output") >= 200)


def turns_to_samples(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, instruction, input, output): every user turn with the assistant turn right behind it."""
    w = Window.partitionBy(conversation).orderBy(turn, or_empty("role"), or_empty(text))
    rows = df.select(conversation, turn, F.lower(df[role]).alias("role"), text).withColumn("_next", F.lead(F.struct("role", F.col(text))).over(w))
    system = F.first(F.when(F.col("role") == "system", F.col(text)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_system", system)
    return rows.where((F.col("role") == "user") & (F.col("_next.role") == "assistant")).select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), or_empty(text).alias("instruction"), or_empty("_system").alias("input"), or_empty(F.col(f"_next.{text}")).alias("output")
    )
