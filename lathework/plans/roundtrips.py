"""Sources and sinks over the test tables: what is written is read again and compared with the table."""

from __future__ import annotations

import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework import config
from lathework.functions import text as tx
from lathework.functions import titles
from lathework.functions import web
from lathework.operators import augment, dedup, evaluate, linkgraph, reports
from lathework.plans import sqlparts as q
from lathework.plans.catalog import ORACLE, domains, named, results, samples, source_files
from lathework.plans.tables import table
from lathework.session import shared_folder
from lathework.sources import api, files, registry


def _digest(c: str) -> Column:
    return F.md5(F.col(c).cast("binary"))


def _below(path: str, folder: str) -> Column:
    """A path without the folder it is below and what stands before that."""
    return F.regexp_extract(F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), f".*{folder.rpartition('/')[2]}/(.*)$", 1)


# --- Files ------------------------------------------------------------------------------------


def _page_files(spark: SparkSession, sf_dir: str) -> str:
    rows, folder = table(spark, sf_dir, "pages"), shared_folder(spark, "pages")
    files.write_files(rows, folder, F.concat(rows["page_id"].cast("string"), F.lit(".html")), rows["html"], rows["page_id"])
    return folder


@named("src_html_dir", "SELECT CAST(page_id AS VARCHAR) AS basename, md5(html) AS digest FROM pages WHERE html <> ''")
def src_html_dir(spark, sf_dir):
    return files.html_dir(spark, _page_files(spark, sf_dir)).where("html <> ''").select("basename", _digest("html").alias("digest"))


@named("src_sidecar", f"SELECT CAST(page_id AS VARCHAR) AS basename, url, {q.strip(chr(114) + 'egexp_extract(html, ' + repr('(?is)<title[^>]*>(.*?)</title>') + ', 1)')} AS title FROM pages WHERE html <> '' AND url IS NOT NULL")
def src_sidecar(spark, sf_dir):
    rows, folder = table(spark, sf_dir, "pages"), _page_files(spark, sf_dir)
    beside = F.to_json(F.struct("url", web.html_title("html").alias("title"), F.concat(F.col("page_id").cast("string"), F.lit(".html")).alias("filename")))
    files.write_files(rows.where("url IS NOT NULL"), folder, F.concat(rows["page_id"].cast("string"), F.lit(".json")), beside, rows["page_id"])
    found, _ = files.pages_with_meta(files.html_dir(spark, folder).where("html <> ''"), files.sidecars(spark, folder))
    return found.select("basename", "url", "title")


@named("src_md_json", "SELECT doc_id, url, title, md5(text) AS digest FROM documents")
def src_md_json(spark, sf_dir):
    rows, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "markdown")
    made = F.to_json(F.struct("doc_id", "url", "title", tx.headings("text").alias("headings"), F.col("text").alias("markdown")))
    files.write_files(rows, folder, F.concat(rows["doc_id"].cast("string"), F.lit(".json")), made, rows["doc_id"])
    read = files.json_documents(spark, folder, "doc_id bigint, url string, title string, headings array<string>, markdown string")
    return read.select("doc_id", "url", "title", _digest("markdown").alias("digest"))


_LAST_CHUNK = "SELECT chunk_id, chunk_key, md5(text) AS digest FROM chunks c WHERE chunk_key = (SELECT max(chunk_key) FROM chunks d WHERE d.chunk_id = c.chunk_id)"


def _chunk_files(spark: SparkSession, sf_dir: str) -> str:
    rows, folder = table(spark, sf_dir, "chunks"), shared_folder(spark, "chunks")
    files.write_files(rows, folder, F.concat(rows["chunk_id"], F.lit(".json")), F.to_json(F.struct("chunk_id", "chunk_key", "doc_id", "section", "text")), rows["chunk_key"])
    return folder


@named("src_chunk_json", _LAST_CHUNK)
def src_chunk_json(spark, sf_dir):
    read = files.json_documents(spark, _chunk_files(spark, sf_dir), "chunk_id string, chunk_key bigint, text string")
    return read.select("chunk_id", "chunk_key", _digest("text").alias("digest"))


@named("sink_per_row_file", "SELECT DISTINCT chunk_id || '.json' AS file_name FROM chunks WHERE chunk_id IS NOT NULL")
def sink_per_row_file(spark, sf_dir):
    return spark.read.format("binaryFile").load(_chunk_files(spark, sf_dir)).select(F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"))


_ALPACA = "SELECT coalesce(instruction, '') AS instruction, coalesce(input, '') AS input, coalesce(output, '') AS output FROM qa_pairs"


def _lines(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_folder(spark, "lines")
    files.write_lines(samples(spark, sf_dir).select("instruction", "input", "output"), folder)
    return folder


@named("src_jsonl", _ALPACA)
def src_jsonl(spark, sf_dir):
    return files.json_lines(spark, _lines(spark, sf_dir))


@named("sink_jsonl", "SELECT count(*) AS lines FROM qa_pairs")
def sink_jsonl(spark, sf_dir):
    return spark.read.text(_lines(spark, sf_dir)).agg(F.count("*").alias("lines"))


@named("src_json_array", _ALPACA)
def src_json_array(spark, sf_dir):
    folder = shared_folder(spark, "lists")
    files.write_array(samples(spark, sf_dir).select("instruction", "input", "output", "seq"), folder, [F.col("seq")], files=4)
    return spark.read.schema(files.SAMPLE).json(folder, multiLine=True)


@named("sink_json_array", "SELECT row_number() OVER (ORDER BY pair_id) - 1 AS position, pair_id AS seq, md5(coalesce(output, '')) AS digest FROM qa_pairs")
def sink_json_array(spark, sf_dir):
    folder = shared_folder(spark, "list")
    files.write_array(samples(spark, sf_dir).select("seq", "output"), folder, [F.col("seq")])
    whole = spark.read.text(folder, wholetext=True).select(F.posexplode(F.from_json("value", "array<struct<seq:bigint,output:string>>")).alias("position", "x"))
    return whole.select(F.col("position").cast("bigint").alias("position"), "x.seq", F.md5(F.col("x.output").cast("binary")).alias("digest"))


def _example_files(spark: SparkSession, sf_dir: str) -> str:
    rows, folder = table(spark, sf_dir, "extraction_results"), shared_folder(spark, "examples")
    made = F.to_json(F.transform("examples", lambda x: F.struct(x["instruction"].alias("instruction"), x["input"].alias("input"), x["output"].alias("output"))))
    files.write_files(rows, folder, F.concat(F.lpad(rows["result_id"].cast("string"), 8, "0"), F.lit("_alpaca.json")), made, rows["result_id"])
    return folder


_COMBINED = """SELECT lpad(CAST(result_id AS VARCHAR), 8, '0') || '_alpaca.json' AS file_name, CAST(i - 1 AS INT) AS position, coalesce(examples[i].instruction, '') AS instruction, md5(coalesce(examples[i].output, '')) AS digest
  FROM (SELECT result_id, examples, unnest(range(1, len(examples) + 1)) AS i FROM extraction_results)"""


@named("src_glob_combine", _COMBINED)
def src_glob_combine(spark, sf_dir):
    return files.combine(spark, _example_files(spark, sf_dir)).select("file_name", "position", "instruction", _digest("output").alias("digest"))


@named("sort_files", f"SELECT file_name, position, row_number() OVER (ORDER BY file_name, position) AS n FROM ({_COMBINED})")
def sort_files(spark, sf_dir):
    from pyspark.sql import Window

    read = files.combine(spark, _example_files(spark, sf_dir)).select("file_name", "position")
    return read.withColumn("n", F.row_number().over(Window.orderBy("file_name", "position")).cast("bigint"))


def _tree(spark: SparkSession, sf_dir: str) -> str:
    rows, folder = table(spark, sf_dir, "extraction_results"), shared_folder(spark, "tree")
    cut = rows.select("result_id", F.posexplode("examples").alias("no", "x"))
    files.write_files(cut, folder, F.concat_ws("/", cut["result_id"].cast("string"), "x.path"), F.nullif(F.col("x.output"), F.lit("")), cut["no"])
    return folder


_TREE = """SELECT path, md5(source) AS digest FROM (SELECT result_id || '/' || examples[i].path AS path, examples[i].output AS source, row_number() OVER (PARTITION BY result_id, examples[i].path ORDER BY i DESC) AS n
    FROM (SELECT result_id, examples, unnest(range(1, len(examples) + 1)) AS i FROM extraction_results) WHERE examples[i].output <> '')
  WHERE n = 1 AND regexp_matches(path, '\\.py$') AND regexp_extract(path, '([^/]*)$', 1) NOT IN ('__init__.py', 'conftest.py', 'conf.py', 'setup.py')"""


@named("src_code_tree", _TREE)
def src_code_tree(spark, sf_dir):
    folder = _tree(spark, sf_dir)
    return files.code_tree(spark, folder).select(_below("path", folder).alias("path"), _digest("source").alias("digest"))


@named("src_git_source", f"SELECT path, digest, NULL AS error FROM ({_TREE}) UNION ALL SELECT 'none', NULL, 'no folder'")
def src_git_source(spark, sf_dir):
    folder = _tree(spark, sf_dir)
    read = files.git_result(spark, "tree", [folder, f"{folder}/none"])
    return read.select(_below("path", folder).alias("path"), _digest("source").alias("digest"), F.substring("error", 1, 9).alias("error"))


@named("sink_text", "SELECT count(*) FILTER (text <> '') AS texts, CAST(sum(length(text)) AS BIGINT) AS characters FROM chunks")
def sink_text(spark, sf_dir):
    folder = shared_folder(spark, "text")
    rows = table(spark, sf_dir, "chunks").where("text <> ''")
    files.write_text(rows.select(F.concat(F.col("text"), F.lit("\x1d")).alias("text")), folder)
    read = spark.read.option("lineSep", "\x1d").text(folder)
    plain = read.select(F.regexp_replace("value", r"\A\n+|\n+\z", "").alias("value"))
    whole = rows.select(F.regexp_replace("text", r"\A\n+|\n+\z", "").alias("t"), "text").agg(F.sum(F.length("text") - F.length("t")).alias("cut"))
    return plain.where("value <> ''").agg(F.count("*").alias("texts"), F.sum(F.length("value")).alias("n")).crossJoin(whole).select("texts", (F.col("n") + F.col("cut")).cast("bigint").alias("characters"))  # one row each


@named("sink_collector", "SELECT 'alpaca' AS layout, count(*) AS rows, CAST(sum(length(coalesce(output, ''))) AS BIGINT) AS characters FROM qa_pairs UNION ALL SELECT 'sharegpt', count(*), CAST(sum(length(coalesce(output, ''))) AS BIGINT) FROM qa_pairs UNION ALL SELECT 'full', count(*), CAST(sum(length(coalesce(output, ''))) AS BIGINT) FROM qa_pairs")
def sink_collector(spark, sf_dir):
    rows, folder = samples(spark, sf_dir), shared_folder(spark, "collected")
    out = None
    for layout, schema, value in (
        ("alpaca", files.SAMPLE, F.col("output")),
        ("sharegpt", "conversations array<struct<from:string,value:string>>", F.try_element_at("conversations", F.lit(2))["value"]),
        ("full", files.SAMPLE + ", seq bigint, source string", F.col("output")),
    ):
        read = files.json_lines(spark, files.write_collected(rows, folder, "qa", layout), schema)
        one = read.agg(F.count("*").alias("rows"), F.sum(F.length(value)).cast("bigint").alias("characters")).select(F.lit(layout).alias("layout"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@named("sink_examples", "SELECT coalesce(examples[i].instruction, '') AS instruction, md5(coalesce(examples[i].output, '')) AS digest FROM (SELECT examples, unnest(range(1, len(examples) + 1)) AS i FROM extraction_results)")
def sink_examples(spark, sf_dir):
    rows = table(spark, sf_dir, "extraction_results").select(F.explode("examples").alias("x")).select("x.instruction", "x.input", "x.output")
    read = files.json_lines(spark, files.write_collected(rows, shared_folder(spark, "extracted"), "tree"))
    return read.select("instruction", _digest("output").alias("digest"))


@named("sink_meta", "SELECT count(*) AS num_samples, count(DISTINCT url) AS num_urls FROM qa_pairs")
def sink_meta(spark, sf_dir):
    folder = shared_folder(spark, "meta")
    files.write_meta(reports.dataset_meta(table(spark, sf_dir, "qa_pairs").select("instruction", "output", "url")), folder)
    return spark.read.schema("num_samples bigint, num_urls bigint").json(folder)


@named("sink_report_md")
def sink_report_md(spark, sf_dir):
    paired, folder = evaluate.pair_models(results(spark, sf_dir)), shared_folder(spark, "report")
    evaluate.write_report(evaluate.markdown_report(evaluate.by_category(paired), evaluate.summary(paired)), folder)
    return spark.read.text(folder).select(F.col("value").alias("line"))


# --- Recorded answers of interfaces -----------------------------------------------------------


def _recorded(df: DataFrame, key: Column, item: Column, name: str) -> str:
    """Pages of a hundred items a key, in the layout of recorded answers."""
    from pyspark.sql import Window

    folder = shared_folder(df.sparkSession, name)
    rows = df.select(key.alias("key"), df["pair_id"], item.alias("item"))
    placed = rows.withColumn("page", F.floor((F.row_number().over(Window.partitionBy("key").orderBy("pair_id")) - 1) / 100).cast("int") + 1)
    pages = placed.groupBy("key", "page").agg(F.sort_array(F.collect_list(F.struct("pair_id", "item"))).alias("items"))  # a hundred at most
    made = F.to_json(F.struct(F.transform("items", lambda x: x["item"]).alias("items"), F.lit(True).alias("has_more")))
    files.write_files(pages, folder, F.concat("key", F.lit("."), F.col("page").cast("string"), F.lit(".json")), made, F.col("page"))
    return folder


def _tag(of: int, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.pmod("pair_id", F.lit(of)).cast("string"))


def _question_pages(spark: SparkSession, sf_dir: str) -> str:
    answers = F.array(F.struct(F.col("pair_id").alias("answer_id"), F.col("output").alias("body"), F.col("score"), F.lit(True).alias("is_accepted")))
    item = F.struct(F.col("pair_id").alias("question_id"), F.col("instruction").alias("title"), F.col("input").alias("body"), "score", "tags", F.col("url").alias("link"), answers.alias("answers"))
    return _recorded(table(spark, sf_dir, "qa_pairs"), _tag(5, "tag"), item, "questions")


@named("src_qa_api", "SELECT pair_id AS question_id, 'tag' || (pair_id % 5) AS tag, instruction AS title, score FROM qa_pairs WHERE coalesce(score, 0) >= 1")
def src_qa_api(spark, sf_dir):
    api.register(spark)
    read = spark.read.format("qa_site").options(path=_question_pages(spark, sf_dir), pages="1000000", min_score="1").load()
    return read.select("question.question_id", "tag", "question.title", "question.score")


@named("collector_questions")
def collector_questions(spark, sf_dir):
    return registry.create("stackoverflow", path=_question_pages(spark, sf_dir), pages="1000000").run(spark).select("instruction", "output", "source", "score")


def _issue_pages(spark: SparkSession, sf_dir: str) -> str:
    comment = F.struct(F.col("output").alias("body"), F.struct(F.lit(1).alias("heart")).alias("reactions"))
    pull = F.when(F.col("pair_id") % 7 == 0, F.struct(F.col("url").alias("url")))
    item = F.struct(F.col("pair_id").alias("number"), F.col("instruction").alias("title"), F.col("input").alias("body"), F.col("url").alias("html_url"), pull.alias("pull_request"), F.array(comment).alias("comments"))
    return _recorded(table(spark, sf_dir, "qa_pairs"), _tag(3, "org__repo"), item, "issues")


@named("src_codehost_api", "SELECT 'org/repo' || (pair_id % 3) AS repo, pair_id AS number, instruction AS title FROM qa_pairs WHERE pair_id % 7 <> 0")
def src_codehost_api(spark, sf_dir):
    api.register(spark)
    read = spark.read.format("code_host").options(path=_issue_pages(spark, sf_dir), pages="1000000").load()
    return read.select("repo", "issue.number", "issue.title")


_ISSUES = """SELECT coalesce(instruction, '') AS instruction, CASE WHEN length(input) > 500 THEN substring(input, 1, 500) || '...' ELSE coalesce(input, '') END AS input, output, 'github:org/repo' || (pair_id % 3) || ':' || pair_id AS source
  FROM qa_pairs WHERE pair_id % 7 <> 0 AND length(output) >= 100"""


@named("fmt_qa_issue", _ISSUES)
def fmt_qa_issue(spark, sf_dir):
    host = registry.create("github", path=_issue_pages(spark, sf_dir), pages="1000000")
    return host.transform(host.raw(spark)).select("instruction", "input", "output", "source")


@named("join_issue_comment", _ISSUES.replace("SELECT coalesce(instruction, '') AS instruction", "SELECT pair_id AS number, coalesce(instruction, '') AS instruction"))
def join_issue_comment(spark, sf_dir):
    host = registry.create("github", path=_issue_pages(spark, sf_dir), pages="1000000")
    return host.transform(host.raw(spark)).select(F.try_element_at("metadata", F.lit("issue_number")).cast("bigint").alias("number"), "instruction", "input", "output", "source")


@named("fmt_qa_question", f"SELECT 'stackoverflow:' || pair_id AS source, greatest(0, coalesce(score, 0)) AS score FROM qa_pairs WHERE coalesce(score, 0) >= 0 AND output IS NOT NULL AND NOT regexp_matches(output, '[<&]') AND length({q.strip('output')}) >= 100")
def fmt_qa_question(spark, sf_dir):
    site = registry.create("stackoverflow", path=_question_pages(spark, sf_dir), pages="1000000", min_score="-1000000000")
    plain = site.raw(spark).where(~F.exists("answers", lambda a: a["body"].rlike("[<&]")))
    return site.transform(plain).select("source", "score")


@named("src_codehost_discussions", "SELECT 'org/repo' || (pair_id % 2) AS repo, instruction AS title, output AS answer FROM qa_pairs")
def src_codehost_discussions(spark, sf_dir):
    api.register(spark)
    read = spark.read.format("code_host_discussions").options(path=_discussion_pages(spark, sf_dir), pages="1000000").load()
    return read.select("repo", "discussion.title", F.col("discussion.answer.body").alias("answer"))


def _discussion_pages(spark: SparkSession, sf_dir: str) -> str:
    answer = F.when(F.col("output").isNotNull(), F.struct(F.col("output").alias("body"), F.col("score").alias("upvoteCount")))
    category = F.struct(F.col("source_type").alias("name"))
    item = F.struct(F.col("instruction").alias("title"), F.col("input").alias("body"), "url", category.alias("category"), answer.alias("answer"))
    return _recorded(table(spark, sf_dir, "qa_pairs"), _tag(2, "org__repo"), item, "discussions")


@named("fmt_qa_discussion", "SELECT coalesce(instruction, '') AS instruction, output, 'github:org/repo' || (pair_id % 2) || ':discussion' AS source, coalesce(score, 0) AS score FROM qa_pairs WHERE length(output) >= 100")
def fmt_qa_discussion(spark, sf_dir):
    host = registry.create("github", path=_discussion_pages(spark, sf_dir), pages="1000000", kind="discussions")
    return host.transform(host.raw(spark)).select("instruction", "output", "source", "score")


@named("flt_answered", "SELECT count(*) AS answered FROM qa_pairs WHERE length(output) >= 100")
def flt_answered(spark, sf_dir):
    return fmt_qa_discussion(spark, sf_dir).agg(F.count("*").alias("answered"))


@named("flt_not_pr", "SELECT count(*) AS issues FROM qa_pairs WHERE pair_id % 7 <> 0")
def flt_not_pr(spark, sf_dir):
    return src_codehost_api(spark, sf_dir).agg(F.count("*").alias("issues"))


def _code_pages(spark: SparkSession, sf_dir: str) -> str:
    rows = table(spark, sf_dir, "extraction_results").select("result_id", F.posexplode("examples").alias("no", "x"))
    name = F.regexp_extract("x.path", r"([^/]*)$", 1)
    rows = rows.select((F.col("result_id") * 1_000_000 + F.col("no")).alias("pair_id"), F.concat(F.element_at(F.array(*map(F.lit, (*api.EXAMPLE_FOLDERS, "src"))), F.pmod(F.col("no"), F.lit(5)) + 1), F.lit("/"), name).alias("path"), F.col("x.output").alias("content"))
    return _recorded(rows, _tag(4, "org__repo"), F.struct("path", "content", F.col("path").alias("html_url")), "code")


_CODE = """(SELECT result_id * 1000000 + i - 1 AS k, ['examples', 'docs/examples', 'samples', 'demo', 'src'][(i - 1) % 5 + 1] || '/' || regexp_extract(examples[i].path, '([^/]*)$', 1) AS path, examples[i].output AS content
  FROM (SELECT result_id, examples, unnest(range(1, len(examples) + 1)) AS i FROM extraction_results) WHERE (i - 1) % 5 < 4 AND examples[i].path LIKE '%.py')"""


@named("src_codehost_examples", f"SELECT 'org/repo' || (k % 4) AS repo, path, md5(content) AS digest FROM {_CODE}")
def src_codehost_examples(spark, sf_dir):
    api.register(spark)
    read = spark.read.format("code_host_examples").options(path=_code_pages(spark, sf_dir), pages="1000000").load()
    return read.select("repo", "path", _digest("content").alias("digest"))


@named("fmt_qa_code", f"SELECT 'github:org/repo' || (k % 4) || ':' || path AS source, md5('```python' || chr(10) || content || chr(10) || '```') AS digest FROM {_CODE} WHERE length(content) BETWEEN 50 AND 10000")
def fmt_qa_code(spark, sf_dir):
    host = registry.create("github", path=_code_pages(spark, sf_dir), pages="1000000", kind="examples")
    return host.transform(host.raw(spark)).select("source", _digest("output").alias("digest"))


@named(
    "src_repo_search",
    """WITH found AS (SELECT pair_id % 6 AS query_no, pair_id, source AS full_name, first_value(score) OVER (PARTITION BY source ORDER BY pair_id % 6, pair_id) AS stars FROM qa_pairs WHERE source IS NOT NULL AND coalesce(score, 0) >= 3),
       once AS (SELECT full_name, min(struct_pack(a := query_no, b := pair_id)) AS x, any_value(stars) AS stars FROM found GROUP BY full_name)
       SELECT 'query' || x.a AS query, full_name, CAST(stars AS BIGINT) AS stars FROM (SELECT *, row_number() OVER (PARTITION BY x.a ORDER BY x.b) AS n FROM once) WHERE n <= 40""",
)
def src_repo_search(spark, sf_dir):
    api.register(spark)
    folder = _recorded(table(spark, sf_dir, "qa_pairs"), _tag(6, "query"), F.struct(F.col("source").alias("full_name"), F.col("score").alias("stargazers_count")), "search")
    found = spark.read.format("code_host_search").options(path=folder, pages="1000000").load()
    queries = spark.createDataFrame([(f"query{n}", n) for n in range(6)], "query string, query_no int")
    return api.found_repositories(found, queries, 3, 40)


# --- Pages, contexts and templates ------------------------------------------------------------


@named("src_web_crawl")
def src_web_crawl(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    starts = pages.where("url IS NOT NULL").groupBy(web.netloc("url").alias("host")).agg(F.min(web.normalize_url("url")).alias("url"))
    return linkgraph.crawl(pages, starts, most_pages=50).select("start", "url", "domain", "depth", "title", F.md5(F.col("content").cast("binary")).alias("digest"))


@named(
    "src_websearch",
    """WITH found AS (SELECT title, min(struct_pack(d := doc_id, a := substring(coalesce(text, ''), 1, 80), r := lang)) AS x FROM documents WHERE title IS NOT NULL GROUP BY title)
       SELECT doc_id, nullif(array_to_string(list_filter([x.a, x.r], lambda v: v IS NOT NULL AND v <> ''), chr(10)), '') AS context FROM documents LEFT JOIN found USING (title)""",
)
def src_websearch(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    least = rows.where("title IS NOT NULL").groupBy("title").agg(F.min(F.struct("doc_id", F.substring(tx.or_empty("text"), 1, 80).alias("abstract"), "lang")).alias("x"))
    found = least.select(F.col("title").alias("query"), "x.abstract", F.array("x.lang").alias("related"))
    return augment.with_context(rows, found, "title").select("doc_id", "context")


@named("src_templates")
def src_templates(spark, sf_dir):
    return augment.template_pairs(spark)


@named("limit_n", "SELECT pair_id FROM qa_pairs ORDER BY pair_id LIMIT 25")
def limit_n(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").select("pair_id").orderBy("pair_id").limit(25)


@named("fn_content_select")
def fn_content_select(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", web.content_select("html").alias("content"))


@named("join_neardup_window")
def join_neardup_window(spark, sf_dir):
    return dedup.near_recent(samples(spark, sf_dir)).select("seq")


# --- Settings, registry and sets --------------------------------------------------------------


@named(
    "src_config",
    "SELECT * FROM (VALUES ('deduplication.max_repetition', '4'), ('deduplication.similarity_threshold', '0.5'), ('full_name', 'mine-2'), ('sources', 'b')) AS t(setting, value)",
)
def src_config(spark, sf_dir):
    """A file, a profile over it, and the environment over both; a disabled source is left out."""
    with tempfile.TemporaryDirectory() as folder:  # the driver's own settings, as a user has them
        path = Path(folder, "run.yaml")
        path.write_text("name: given\nversion: '2'\nsources: [{name: a, enabled: true}, {name: b}]\ndeduplication: {max_repetition: 3}\nprofiles: {strict: {deduplication: {max_repetition: 4}, sources: [{name: a, enabled: false}]}}\n")
        made = config.load(path, "strict", {"LATHEWORK_NAME": "mine", "LATHEWORK_SIMILARITY": "0.5"})
    d = made.deduplication
    rows = [("full_name", made.full_name), ("deduplication.max_repetition", str(d.max_repetition)), ("deduplication.similarity_threshold", str(d.similarity_threshold)), ("sources", ",".join(s["name"] for s in made.enabled_sources()))]
    return spark.createDataFrame(rows, "setting string, value string")


@named("src_env", "SELECT * FROM (VALUES ('LATHEWORK_NAME', 'file'), ('LATHEWORK_VERSION', 'process')) AS t(variable, value)")
def src_env(spark, sf_dir):
    """Settings of a file stand behind those of the process."""
    with tempfile.TemporaryDirectory() as folder:
        Path(folder, ".env").write_text("# note\nLATHEWORK_NAME = file\nLATHEWORK_VERSION=file\nno setting\n")
        read = config.env_file(Path(folder, ".env"), {"LATHEWORK_VERSION": "process"})
    return spark.createDataFrame(sorted(read.items()), "variable string, value string")


@named("flt_enabled", "SELECT * FROM (VALUES ('guides'), ('issues')) AS t(source)")
def flt_enabled(spark, sf_dir):
    """Sources that are not switched off."""
    made = config.Config(sources=({"name": "guides"}, {"name": "pages", "enabled": False}, {"name": "issues", "enabled": True}))
    return spark.createDataFrame([(s["name"],) for s in made.enabled_sources()], "source string")


@named("collector_registry", "SELECT * FROM (VALUES ('github', 1), ('jsonl', 1), ('stackoverflow', 1), ('web', 2)) AS t(name, needed)")
def collector_registry(spark, sf_dir):
    return registry.describe(spark).select("name", F.size("required").alias("needed"))


@named("join_domain_pattern", "SELECT d AS domain, count(*) AS pairs FROM (SELECT ['python', 'kubernetes', 'security', 'docker', 'none'][CAST(pair_id % 5 AS INT) + 1] AS d FROM qa_pairs) WHERE d <> 'none' GROUP BY d")
def join_domain_pattern(spark, sf_dir):
    return augment.preference_pairs(domains(spark, sf_dir), "seq").groupBy("domain").agg(F.count("*").alias("pairs"))


@named("set_patterns_concat", "SELECT * FROM (VALUES ('docker', 1), ('kubernetes', 3), ('python', 5), ('security', 3)) AS t(domain, patterns)")
def set_patterns_concat(spark, sf_dir):
    return augment.patterns(spark).groupBy("domain").agg(F.count("*").cast("int").alias("patterns"))


@named("st_crawl_resume", ORACLE["crawl_resume"])
def st_crawl_resume(spark, sf_dir):
    """What is still to visit where all recorded pages were."""
    pages = table(spark, sf_dir, "pages")
    visited = pages.select(web.normalize_url("url").alias("url")).distinct()
    return linkgraph.resume(linkgraph.page_links(pages), visited)


@named("src_crawl_bfs", ORACLE["link_bfs"])
def src_crawl_bfs(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    starts = pages.where("url IS NOT NULL").groupBy(web.netloc("url").alias("host")).agg(F.min(web.normalize_url("url")).alias("url"))
    return linkgraph.reachable(linkgraph.page_links(pages), starts)


@named("topk_instructions", f"WITH {q.FILES} SELECT key, len(list_filter(['Write a Python example for ' || key], lambda x: x IS NOT NULL)) AS first FROM files")
def topk_instructions(spark, sf_dir):
    return source_files(spark, sf_dir).select("key", F.size(titles.python_instructions("path", F.lit(""), most=1)).cast("bigint").alias("first"))
