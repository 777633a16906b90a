"""Every named query over the test tables, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions import code, keys, titles, web
from lathework.functions import text as tx
from lathework.operators import augment, dedup, evaluate, extract, filters, formats, linkgraph, qa, reports, sections
from lathework.operators.components import components
from lathework.plans import sqlparts as q
from lathework.plans.tables import spread, table
from lathework.session import broadcast_small
from lathework.sources import files
from lathework.streaming import monitor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def named(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def simple(name: str, source: str, key: str, sql: str, **columns: Callable[[], object]) -> None:
    """A query of scalar columns over one table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, source).select(key, *[make().alias(c) for c, make in columns.items()])

    QUERIES[name] = run
    ORACLE[name] = sql


# --- Views ------------------------------------------------------------------------------------


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(table(spark, sf_dir, "qa_pairs"))
    return rows.select(rows["pair_id"].alias("seq"), *[tx.or_empty(c).alias(c) for c in ("instruction", "input", "output")], "source")


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "extraction_results").select("result_id", F.posexplode("examples").alias("no", "x"))
    return rows.select((F.col("result_id") * 1_000_000 + F.col("no")).alias("key"), "x.path", F.col("x.output").alias("source"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of two stand-in models to the evaluation items, with their scores."""
    items = table(spark, sf_dir, "benchmark")
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), F.col("text").alias("other"))
    rows = items.join(texts, "item_id", "left")
    made = rows.select(
        F.col("item_id").alias("question_id"), "category", F.col("expected_keywords").alias("keywords"),
        F.explode(F.array(F.struct(F.lit("base").alias("model"), F.col("other").alias("response")), F.struct(F.lit("tuned").alias("model"), F.col("text").alias("response")))).alias("x"),
    )
    return made.select("question_id", "category", "keywords", "x.model", "x.response").withColumn("score", evaluate.score("response", "keywords"))


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.select(rows["user_id"].cast("string").alias("run_id"), "ts", F.floor(rows["value"] / 50).cast("bigint").alias("step"))


PROGRESS_SQL = "SELECT CAST(user_id AS VARCHAR) AS run_id, ts, CAST(floor(value / 50) AS BIGINT) AS step FROM events"

# --- Scalars: text and keys -------------------------------------------------------------------

simple("fn_normalize_text", "documents", "doc_id", f"SELECT doc_id, {q.norm('text')} AS norm FROM documents", norm=lambda: tx.normalize("text"))
simple("fn_hash_norm", "qa_pairs", "pair_id", f"SELECT pair_id, md5({q.norm(q.text('output'))}) AS hash FROM qa_pairs", hash=lambda: keys.hash_normalized("output"))
simple("fn_unique_id", "qa_pairs", "pair_id", "SELECT pair_id, md5(coalesce(instruction, '') || ':' || coalesce(output, '')) AS uid FROM qa_pairs", uid=lambda: keys.pair_key("instruction", "output"))
simple("fn_legacy_key", "qa_pairs", "pair_id", "SELECT pair_id, md5(coalesce(instruction, '') || coalesce(output, '')) AS uid FROM qa_pairs", uid=lambda: keys.plain_pair_key("instruction", "output"))
simple("fn_order_hash", "qa_pairs", "pair_id", "SELECT pair_id, sha256(coalesce(instruction, '') || coalesce(output, '')) AS digest FROM qa_pairs", digest=lambda: keys.order_key("instruction", "output"))
simple("fn_doc_id", "pages", "page_id", "SELECT page_id, substring(sha256(url), 1, 12) AS doc_id FROM pages", doc_id=lambda: keys.document_id("url"))
simple("fn_page_file", "pages", "page_id", "SELECT page_id, sha256(url) || '.html' AS file FROM pages", file=lambda: keys.page_file("url"))
simple("fn_url_hash", "pages", "page_id", "SELECT page_id, substring(md5(url), 1, 12) AS hash FROM pages", hash=lambda: keys.url_hash("url"))
simple(
    "fn_uuid5", "chunks", "chunk_key",
    """SELECT chunk_key, substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-5' || substring(h, 14, 3) || '-' ||
       printf('%02x', (('0x' || substring(h, 17, 2))::INT & 63) | 128) || substring(h, 19, 2) || '-' || substring(h, 21, 12) AS uid
       FROM (SELECT chunk_key, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(concat_ws('-', CAST(doc_id AS VARCHAR), coalesce(section, ''), '0'))) AS h FROM chunks)""",
    uid=lambda: keys.uuid5("doc_id", tx.or_empty("section"), F.lit(0)),
)
simple("fn_token_count", "documents", "doc_id", "SELECT doc_id, greatest(1, length(coalesce(text, '')) // 4) AS tokens FROM documents", tokens=lambda: tx.token_count("text"))
simple("fn_case_len", "documents", "doc_id", f"SELECT doc_id, {q.words('text')} AS words FROM documents", words=lambda: tx.word_count("text"))
simple("fn_normalize_url", "pages", "page_id", "SELECT page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '/$', '') AS url FROM pages", url=lambda: web.normalize_url("url"))
simple("fn_netloc", "pages", "page_id", f"SELECT page_id, {q.netloc('url')} AS host FROM pages", host=lambda: web.netloc("url"))
simple(
    "fn_title_html", "pages", "page_id", f"SELECT page_id, {q.strip(chr(114) + 'egexp_extract(html, ' + repr('(?is)<title[^>]*>(.*?)</title>') + ', 1)')} AS title FROM pages", title=lambda: web.html_title("html")
)
simple(
    "fn_title_fallback", "pages", "page_id",
    f"""SELECT page_id, coalesce(nullif({q.strip("regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g')")}, ''), {q.strip("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}) AS title FROM pages""",
    title=lambda: F.coalesce(F.nullif(tx.strip(F.regexp_replace(F.regexp_extract("html", r"(?is)<h1[^>]*>(.*?)</h1>", 1), "<[^>]+>", "")), F.lit("")), web.html_title("html")),
)
simple(
    "fn_headings", "documents", "doc_id",
    f"""SELECT doc_id, list_transform(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: starts_with({q.strip('x')}, '#')), lambda x: {q.strip(f"regexp_replace({q.strip('x')}, '^#+', '')")}) AS headings FROM documents""",
    headings=lambda: tx.headings("text"),
)
simple("fn_truncate_body", "qa_pairs", "pair_id", "SELECT pair_id, CASE WHEN length(output) > 500 THEN substring(output, 1, 500) || '...' ELSE output END AS body FROM qa_pairs", body=lambda: tx.truncate("output", 500, "..."))
simple(
    "fn_ansi_clean", "documents", "doc_id", r"SELECT doc_id, regexp_replace(regexp_replace(text, '\x1b\[[0-9;?]*[ -/]*[@-~]', '', 'g'), '\x1b[@-Z\\\-_]', '', 'g') AS text FROM documents", text=lambda: tx.ansi_clean("text")
)
simple(
    "fn_title_to_question", "documents", "doc_id",
    f"""SELECT doc_id, CASE WHEN t LIKE '%?' THEN t WHEN regexp_matches(t, '(?i)^(How do I |How to |What is |Why does |Can I |Should I |Is it possible to )') THEN t || '?' ELSE 'How do I ' || lower(t) || '?' END AS question
        FROM (SELECT doc_id, {q.strip('title')} AS t FROM documents)""",
    question=lambda: titles.title_to_question("title"),
)
simple(
    "fn_title_to_explain", "documents", "doc_id",
    f"""SELECT doc_id, CASE WHEN t = '' THEN 'Explain this concept' WHEN t LIKE '%?' THEN t WHEN regexp_matches(lower(t), 'how to|how do|getting started|tutorial|guide') THEN t || '?' ELSE 'Explain ' || lower(t) END AS instruction
        FROM (SELECT doc_id, regexp_replace({q.strip('title')}, '{tx.WS}*[-|—]{tx.WS}*.*$', '') AS t FROM documents)""",
    instruction=lambda: titles.title_to_explain("title"),
)
simple(
    "fn_detect_language", "pages", "page_id",
    """SELECT page_id, CASE WHEN regexp_matches(c, 'python|py') THEN 'python' WHEN regexp_matches(c, 'javascript|js') THEN 'javascript' WHEN regexp_matches(c, 'typescript|ts') THEN 'typescript'
         WHEN regexp_matches(c, 'bash|shell|sh') THEN 'bash' WHEN regexp_matches(c, 'yaml|yml') THEN 'yaml' WHEN regexp_matches(c, 'json') THEN 'json' WHEN regexp_matches(c, '\\bgo\\b|golang') THEN 'go'
         WHEN regexp_matches(c, 'rust') THEN 'rust' WHEN regexp_matches(c, '\\bjava\\b') THEN 'java' WHEN regexp_matches(c, '\\bsql\\b') THEN 'sql' WHEN regexp_matches(c, '\\bhcl\\b|terraform') THEN 'hcl'
         WHEN starts_with(b, '#!/') OR starts_with(b, '$') THEN 'bash' WHEN regexp_matches(b, 'def |import ') THEN 'python' WHEN regexp_matches(b, 'function |const |let ') THEN 'javascript' ELSE 'text' END AS language
       FROM (SELECT page_id, lower(regexp_extract(coalesce(html, ''), '<code class="([^"]*)"', 1)) AS c, regexp_extract(coalesce(html, ''), '(?s)<code[^>]*>([^<]*)', 1) AS b FROM pages)""".replace("\\\\b", "\\b"),
    language=lambda: web.detect_language(F.regexp_extract(tx.or_empty("html"), '<code class="([^"]*)"', 1), F.regexp_extract(tx.or_empty("html"), "(?s)<code[^>]*>([^<]*)", 1)),
)
_TAG_SQL = "CASE " + " ".join(f"WHEN regexp_matches({q.netloc('url')}, '{'|'.join(p)}') THEN '{t}'" for t, p in web.DOMAIN_TAGS) + " END"
simple(
    "fn_extract_tags", "documents", "doc_id",
    f"""SELECT doc_id, list_slice(list_filter(all_tags, lambda x, i: list_position(all_tags, x) = i), 1, 5) AS tags FROM (
          SELECT doc_id, list_filter([{_TAG_SQL}, {', '.join(f"CASE WHEN contains(lower(coalesce(text, '')), '{k}') THEN '{k}' END" for k in web.KEYWORDS)}], lambda x: x IS NOT NULL) AS all_tags FROM documents)""",
    tags=lambda: web.tags_of("url", "text"),
)
simple("fn_prompt_fill", "chunks", "chunk_key", "SELECT chunk_key, 'Read: <' || coalesce(text, '') || '> and ask.' AS prompt FROM chunks", prompt=lambda: titles.chunk_prompt("Read: <{chunk}> and ask.", "text"))
simple(
    "fn_web_prompt", "qa_pairs", "pair_id",
    "SELECT pair_id, CASE WHEN coalesce(input, '') = '' THEN coalesce(instruction, '') ELSE 'Based on this information:' || chr(10) || chr(10) || input || chr(10) || chr(10) || 'Answer the question: ' || coalesce(instruction, '') END AS prompt FROM qa_pairs",
    prompt=lambda: titles.web_prompt("instruction", "input"),
)
simple(
    "fn_alpaca_prompt", "qa_pairs", "pair_id",
    "SELECT pair_id, '### Instruction:' || chr(10) || coalesce(instruction, '') || chr(10) || chr(10) || CASE WHEN coalesce(input, '') <> '' THEN '### Input:' || chr(10) || input || chr(10) || chr(10) ELSE '' END || '### Response:' || chr(10) || coalesce(output, '') || '</s>' AS prompt FROM qa_pairs",
    prompt=lambda: titles.alpaca_prompt("instruction", "input", "output", "</s>"),
)
simple(
    "fn_vary_instruction", "qa_pairs", "pair_id",
    f"""SELECT pair_id, CASE {q.pick('pair_id', 'vary', 5)} WHEN 1 THEN 'How do I ' || t || '?' WHEN 2 THEN 'What''s the best way to ' || t || '?' WHEN 3 THEN 'Can you show me how to ' || t || '?' WHEN 4 THEN 'I need to ' || t ELSE 'Help me ' || t END AS instruction
        FROM (SELECT pair_id, regexp_replace(lower(coalesce(instruction, '')), '^({'|'.join(titles.PREFIXES)})', '') AS t FROM qa_pairs)""",
    instruction=lambda: titles.vary_instruction("instruction", "pair_id"),
)
simple(
    "fn_model_family", "qa_pairs", "pair_id",
    "SELECT pair_id, CASE WHEN contains(m, 'deepseek') THEN 'deepseek' WHEN contains(m, 'gemma') THEN 'gemma' WHEN contains(m, 'qwen') THEN 'qwen' WHEN contains(m, 'llama') OR contains(m, 'mistral') THEN 'llama' ELSE 'phi' END AS family FROM (SELECT pair_id, lower(coalesce(source, '')) AS m FROM qa_pairs)",
    family=lambda: titles.model_family("source"),
)
simple(
    "fn_error_reason", "qa_pairs", "pair_id", "SELECT pair_id, CASE " + " ".join(f"WHEN contains(coalesce(output, ''), '{n}') THEN '{r.replace(chr(39), chr(39) * 2)}'" for n, r in augment.ERRORS) + " ELSE 'the code expects something else than it got' END AS reason FROM qa_pairs",
    reason=lambda: augment.error_reason("output"),
)
simple(
    "split_train_val", "qa_pairs", "pair_id", f"SELECT pair_id, {q.pick('pair_id', 'split', 10000)} <= 500 AS validation FROM qa_pairs", validation=lambda: keys.in_validation("pair_id", 0.05)
)
simple("rep_phrases", "documents", "doc_id", f"SELECT doc_id, {q.phrases('text')} AS repeats FROM documents", repeats=lambda: tx.repeated_phrases("text"))
simple("rep_sentences", "documents", "doc_id", f"SELECT doc_id, {q.repeats('text')} AS repetitive FROM documents", repetitive=lambda: tx.has_repeated_sentences("text"))
simple(
    "rep_ratio", "documents", "doc_id",
    f"""SELECT doc_id, CASE WHEN length(coalesce(text, '')) < 100 OR len(s) < 2 THEN 0.0 ELSE round((1.0 - CAST(len(list_distinct(s)) AS DOUBLE) / len(s)) * 100, 6) END AS ratio
        FROM (SELECT doc_id, text, list_transform({q.sentences('text', '[.!?]')}, lambda s: lower(s)) AS s FROM documents)""",
    ratio=lambda: F.round(tx.repetition_ratio("text"), 6),
)


@named("fn_row_key", "SELECT count(*) AS distinct_rows FROM (SELECT DISTINCT instruction, input, output FROM qa_pairs)")
def fn_row_key(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").select("instruction", "input", "output").distinct().agg(F.count("*").alias("distinct_rows"))


@named("fn_urljoin", f"WITH {q.LINKS} SELECT src, dst FROM links WHERE dst LIKE 'http%'")
def fn_urljoin(spark, sf_dir):
    return linkgraph.page_links(table(spark, sf_dir, "pages"))


def _clean_html_sql(x: str) -> str:
    """The steps of :func:`web.clean_html` over the entities that the pages have."""
    line = "' || chr(10) || '"
    for entity, sign in (("&copy;", "©"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{sign}')"
    for pattern, new in (
        ("(?s)<pre><code[^>]*>(.*?)</code></pre>", f"```{line}\\1{line}```"), ("<code>(.*?)</code>", "`\\1`"), ("(?s)<li>(.*?)</li>", f"- \\1{line}"), ("</?[ou]l>", ""), ("(?s)<p>(.*?)</p>", f"\\1{line}{line}"),
        ("<br\\s*/?>", line), ('<a href="([^"]*)"[^>]*>(.*?)</a>', "[\\2](\\1)"), ("<h1>(.*?)</h1>", f"# \\1{line}"), ("<h2>(.*?)</h2>", f"## \\1{line}"), ("<h3>(.*?)</h3>", f"### \\1{line}"), ("<[^>]+>", ""), ("\\n{3,}", f"{line}{line}"),
    ):
        x = f"regexp_replace({x}, '{pattern}', '{new}', 'g')"
    return f"coalesce({q.strip(x)}, '')"


@named("fn_clean_html", f"SELECT page_id, {_clean_html_sql('html')} AS text FROM pages")
def fn_clean_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", web.clean_html("html").alias("text"))


@named("fn_clean_page")
def fn_clean_page(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", web.cleaned_markdown("html").alias("markdown"))


@named("fn_html_to_md")
def fn_html_to_md(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", web.html_to_markdown("html").alias("markdown"))


@named("fn_sha256_file", f"WITH {q.FILES} SELECT key, sha256(source) AS digest FROM files WHERE source IS NOT NULL")
def fn_sha256_file(spark, sf_dir):
    return source_files(spark, sf_dir).where("source IS NOT NULL").select("key", F.sha2(F.col("source").cast("binary"), 256).alias("digest"))


# --- Scalars: code ----------------------------------------------------------------------------


def over_files(name: str, sql: str | None, **columns) -> None:
    def run(spark, sf_dir):
        return source_files(spark, sf_dir).select("key", *[make().alias(c) for c, make in columns.items()])

    QUERIES[name] = run
    if sql:
        ORACLE[name] = f"WITH {q.FILES} {sql}"


_LINES = "string_split(coalesce(source, ''), chr(10))"
over_files(
    "fn_clean_code",
    f"""SELECT key, {q.strip("array_to_string(list_slice(l, greatest(1, coalesce(list_position(list_transform(l, lambda x: NOT (starts_with(" + q.strip('x') + ", '#') OR " + q.strip('x') + " = '')), true), 0)), len(l)), chr(10))")} AS code FROM (SELECT key, {_LINES} AS l FROM files)""",
    code=lambda: code.clean_code("source"),
)
over_files("fn_truncate_code", "SELECT key, CASE WHEN length(source) > 1000 THEN substring(source, 1, 1000) || chr(10) || '# ... (truncated)' ELSE source END AS code FROM files", code=lambda: tx.truncate("source", 1000, "\n# ... (truncated)"))
_INDENT = "length(x) - length(regexp_replace(x, '^\\s+', ''))"
over_files(
    "fn_dedent",
    f"""SELECT key, {q.strip(f"CASE WHEN m IS NULL THEN coalesce(source, '') ELSE array_to_string(list_transform(l, lambda x: CASE WHEN length(x) > m THEN substring(x, m + 1) ELSE {q.strip('x')} END), chr(10)) END")} AS code
        FROM (SELECT key, source, l, list_min(list_transform(list_filter(l, lambda x: {q.strip('x')} <> ''), lambda x: {_INDENT})) AS m FROM (SELECT key, source, {_LINES} AS l FROM files))""",
    code=lambda: code.dedent("source"))
over_files(
    "fn_rst_title",
    f"""SELECT key, coalesce(list_filter(list_transform(range(1, len(l)), lambda i: CASE WHEN {q.strip('l[i]')} <> '' AND l[i + 1] <> '' AND regexp_matches({q.strip('l[i + 1]')}, '^[=~^-]*$') THEN {q.strip('l[i]')} END), lambda x: x IS NOT NULL)[1], '') AS title FROM (SELECT key, {_LINES} AS l FROM files)""",
    title=lambda: code.rst_title("source"))
_DOC = lambda mark: f"regexp_extract(source, '(?s)^{mark}(.*?){mark}', 1)"
_HAS = lambda mark: f"regexp_matches(source, '(?s)^{mark}.*?{mark}')"
_TRIPLE, _SINGLE = '"' * 3, "''" * 3
over_files(
    "fn_code_description",
    f"SELECT key, CASE WHEN {_HAS(_TRIPLE)} THEN string_split({q.strip(_DOC(_TRIPLE))}, chr(10))[1] WHEN {_HAS(_SINGLE)} THEN string_split({q.strip(_DOC(_SINGLE))}, chr(10))[1] WHEN regexp_extract(source, '^#\\s*([^\\n]+)', 1) <> '' THEN {q.strip(chr(114) + "egexp_extract(source, '^#" + chr(92) + "s*([^" + chr(92) + "n]+)', 1)")} END AS description FROM files",
    description=lambda: code.code_description("source"))
over_files("fn_docstring_prefix", f"""SELECT key, {q.strip("regexp_extract(coalesce(source, ''), '(?s)^" + '"""' + "(.*?)" + '"""' + "', 1)")} AS doc FROM files""", doc=lambda: code.docstring_prefix("source"))
_STEM = "translate(regexp_replace(regexp_extract(coalesce(path, ''), '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1'), '_-', '  ')"
over_files(
    "fn_instr_python", f"SELECT key, ['Write a Python example for ' || s, 'Show me Python code for ' || s] AS instructions FROM (SELECT key, {_STEM} AS s FROM files)", instructions=lambda: titles.python_instructions("path", F.lit(""))
)
over_files(
    "fn_instr_k8s", f"SELECT key, ['Write a Python example for Kubernetes ' || s, 'Show me Python code for ' || s || ' in Kubernetes'] AS instructions FROM (SELECT key, {_STEM} AS s FROM files)",
    instructions=lambda: titles.cluster_instructions("path", F.lit("")),
)
over_files(
    "fn_instr_func", f"SELECT key, ['Create a Python function called ' || s || ' for Kubernetes', 'Show me how to implement ' || replace(s, '_', ' ') || ' in Python for Kubernetes'] AS instructions FROM (SELECT key, coalesce(path, '') AS s FROM files)",
    instructions=lambda: titles.function_instructions("path", F.lit("")),
)
over_files("fn_instr_pytest", f"SELECT key, list_slice(list_concat(CASE WHEN s <> '' THEN ['Give me an example of ' || lower(s) || ' with pytest'] ELSE [] END, ['Write a pytest test example', 'Show me pytest best practices']), 1, 2) AS instructions FROM (SELECT key, {_STEM} AS s FROM files)", instructions=lambda: titles.test_instructions(F.lit(""), titles.stem("path")))
over_files("fn_instr_rst", f"SELECT key, CASE WHEN s <> '' THEN ['Give me an example of ' || lower(s)] ELSE []::VARCHAR[] END AS instructions FROM (SELECT key, {_STEM} AS s FROM files)", instructions=lambda: titles.rst_instructions(F.lit(""), titles.stem("path")))
over_files("fn_instr_md", "SELECT key, 'Show me this Python example: ' || regexp_replace(regexp_extract(coalesce(path, ''), '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1') AS instruction FROM files", instruction=lambda: titles.markdown_instruction(F.lit(""), "path"))
over_files("flt_file_skip", "SELECT key, regexp_matches(n, '\\.py$') AND n NOT IN ('__init__.py', 'conftest.py', 'conf.py', 'setup.py') AS wanted FROM (SELECT key, regexp_extract(coalesce(path, ''), '([^/]*)$', 1) AS n FROM files)", wanted=lambda: filters.wanted_file("path"))


@named("fn_explanation", f"WITH {q.FILES} SELECT key, CASE WHEN len(n) > 0 THEN chr(10) || chr(10) || '**What happens here:** ' || array_to_string(n, ' ') ELSE '' END AS note FROM (SELECT key, list_filter([{', '.join(f'CASE WHEN contains(coalesce(source, {chr(39) * 2}), {chr(39)}{s}{chr(39)}) THEN {chr(39)}{n.replace(chr(39), chr(39) * 2)}{chr(39)} END' for s, n in augment.NOTES)}], lambda x: x IS NOT NULL) AS n FROM files)")
def fn_explanation(spark, sf_dir):
    return source_files(spark, sf_dir).select("key", augment.explanation("source").alias("note"))


@named("fn_json_array_extract", "SELECT pair_id, CAST(0 AS INT) AS no, instruction, input, output FROM qa_pairs")
def fn_json_array_extract(spark, sf_dir):
    rows = table(spark, sf_dir, "qa_pairs")
    reply = F.concat(F.lit("Here it is:\n[\n"), F.to_json(F.struct("instruction", "input", "output")), F.lit("]\nDone."))
    return rows.select("pair_id", F.posexplode(augment.reply_samples(reply)).alias("no", "x")).select("pair_id", "no", "x.instruction", "x.input", "x.output")


# --- Table-generating -------------------------------------------------------------------------


#: Where Python ends lines, as one pattern.
_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_SECTIONS = f"""marked AS (
    SELECT doc_id, i, l[i] AS line, starts_with({q.strip('l[i]')}, '#') AS head, sum(CASE WHEN starts_with({q.strip('l[i]')}, '#') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS s
    FROM (SELECT doc_id, l, unnest(range(1, CASE WHEN l[len(l)] = '' THEN len(l) ELSE len(l) + 1 END)) AS i FROM (SELECT doc_id, regexp_split_to_array(text, '{_BREAK}') AS l FROM documents WHERE text <> ''))),
  sections AS (
    SELECT doc_id, s, coalesce(max(CASE WHEN head THEN {q.strip("regexp_replace(" + q.strip('line') + ", '^#+', '')")} END), 'intro') AS section_title, string_agg(line, chr(10) ORDER BY i) FILTER (NOT head) AS content
    FROM marked GROUP BY doc_id, s HAVING count(*) FILTER (NOT head) > 0)"""


@named("gen_sections", f"WITH {_SECTIONS} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INT) AS section_no, section_title, content FROM sections")
def gen_sections(spark, sf_dir):
    return sections.split_sections(table(spark, sf_dir, "documents"))


@named(
    "win_running_section",
    """SELECT doc_id, i - 1 AS line_no, len(list_filter(list_slice(l, 1, i), lambda x: starts_with(ltrim(x, ' '), '#'))) AS section_no, l[i] AS line
       FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))""",
)
def win_running_section(spark, sf_dir):
    return sections.running_sections(table(spark, sf_dir, "documents"))


_CHUNKS = f"""{_SECTIONS},
  named AS (SELECT doc_id, s, section_title, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INT) AS section_no FROM sections),
  held AS (SELECT doc_id, s, line, row_number() OVER (PARTITION BY doc_id, s ORDER BY i) AS n, count(*) OVER (PARTITION BY doc_id, s) AS c FROM marked WHERE NOT head),
  bare AS (
    SELECT doc_id, s, n, line, {q.strip('line')} AS x, sum(length(line) + 1) OVER w AS stop, sum(CASE WHEN starts_with({q.strip('line')}, '```') THEN 1 ELSE 0 END) OVER w % 2 AS fenced
    FROM held WHERE NOT (n = c AND line = '') WINDOW w AS (PARTITION BY doc_id, s ORDER BY n)),
  free AS (SELECT *, fenced = 0 AND max(CASE WHEN starts_with(x, '|') AND fenced = 0 THEN n ELSE 0 END) OVER w <= max(CASE WHEN x = '' THEN n ELSE 0 END) OVER w AS whole FROM bare WINDOW w AS (PARTITION BY doc_id, s ORDER BY n)),
  cuts AS (
    SELECT doc_id, s, CAST(0 AS BIGINT) AS a, CAST(0 AS BIGINT) AS pos FROM (SELECT DISTINCT doc_id, s FROM free)
    UNION ALL
    SELECT c.doc_id, c.s, x.a, x.pos FROM cuts c, LATERAL (SELECT min(n) AS a, CAST(min(stop) AS BIGINT) AS pos FROM free f WHERE f.doc_id = c.doc_id AND f.s = c.s AND f.n > c.a AND whole AND (stop - c.pos - 1) // 4 >= 1024) x WHERE x.a IS NOT NULL),
  parts AS (
    SELECT doc_id, s, chunk_no, string_agg(line, chr(10) ORDER BY n) AS text FROM (
      SELECT f.*, (SELECT count(*) FROM cuts c WHERE c.doc_id = f.doc_id AND c.s = f.s AND c.a > 0 AND c.a < f.n) AS chunk_no FROM free f) GROUP BY doc_id, s, chunk_no),
  chunked AS (
    SELECT p.doc_id, n.section_no, n.section_title AS section, CAST(p.chunk_no AS INT) AS chunk_no, p.text
    FROM parts p JOIN named n ON n.doc_id = p.doc_id AND n.s = p.s
    WHERE p.chunk_no = 0 OR greatest(1, length(p.text) // 4) >= 512 OR p.chunk_no < (SELECT count(*) FROM cuts c WHERE c.doc_id = p.doc_id AND c.s = p.s AND c.a > 0))"""
_UUID = """substring(h, 1, 8) || '-' || substring(h, 9, 4) || '-5' || substring(h, 14, 3) || '-' || printf('%02x', (('0x' || substring(h, 17, 2))::INT & 63) | 128) || substring(h, 19, 2) || '-' || substring(h, 21, 12)"""


@named(
    "gen_chunks",
    f"WITH RECURSIVE {_CHUNKS} SELECT doc_id, section_no, section, chunk_no, text, {_UUID} AS chunk_id FROM (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(concat_ws('-', CAST(doc_id AS VARCHAR), section, CAST(chunk_no AS VARCHAR)))) AS h FROM chunked)",
)
def gen_chunks(spark, sf_dir):
    return sections.split_chunks(table(spark, sf_dir, "documents"))


@named("win_chunk_index", f"WITH RECURSIVE {_CHUNKS} SELECT doc_id, section_no, max(chunk_no) AS last_chunk, count(*) AS chunks FROM chunked GROUP BY ALL")
def win_chunk_index(spark, sf_dir):
    return gen_chunks(spark, sf_dir).groupBy("doc_id", "section_no").agg(F.max("chunk_no").alias("last_chunk"), F.count("*").alias("chunks"))


@named("dedup_last", "SELECT chunk_id, max(chunk_key) AS chunk_key FROM chunks GROUP BY chunk_id")
def dedup_last(spark, sf_dir):
    rows = table(spark, sf_dir, "chunks").select("chunk_id", "chunk_key")
    return dedup.last_per_key(rows, rows["chunk_id"], "chunk_key")


@named("gen_functions")
def gen_functions(spark, sf_dir):
    return extract.function_table(source_files(spark, sf_dir).where("path LIKE '%.py'"), "key", "source")


@named("gen_py_examples")
def gen_py_examples(spark, sf_dir):
    return extract.python_samples(source_files(spark, sf_dir).where("path LIKE '%.py'"))


@named("gen_py_examples_k8s")
def gen_py_examples_k8s(spark, sf_dir):
    return extract.cluster_samples(source_files(spark, sf_dir).where("path LIKE '%.py'"))


_DOC_LINE = q.strip("regexp_replace(" + q.strip("regexp_extract(coalesce(source, ''), '(?s)^" + _TRIPLE + "(.*?)" + _TRIPLE + "', 1)") + f", '{tx.WS}+', ' ', 'g')")


@named(
    "gen_py_examples_pytest",
    f"""WITH {q.FILES}, asked AS (
          SELECT key, source, list_slice(list_concat(CASE WHEN doc <> '' THEN ['Write pytest code to ' || lower(doc), 'Show me how to ' || lower(doc) || ' in pytest'] ELSE [] END,
            CASE WHEN s <> '' THEN ['Give me an example of ' || lower(s) || ' with pytest'] ELSE [] END, ['Write a pytest test example', 'Show me pytest best practices']), 1, 2) AS a
          FROM (SELECT key, source, {_STEM} AS s, {_DOC_LINE} AS doc FROM files WHERE path LIKE '%.py' AND length({q.strip(q.text('source'))}) >= 50))
        SELECT key, CAST(i - 1 AS INT) AS part, a[i] AS instruction, '' AS input, source AS output FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM asked)""",
)
def gen_py_examples_pytest(spark, sf_dir):
    return extract.test_samples(source_files(spark, sf_dir).where("path LIKE '%.py'"))


def rst_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as reStructuredText: their fenced Python code under directives, and literal blocks for the rest."""
    fence = "`" * 3
    parts = F.split(F.replace(tx.or_empty("text"), F.lit("\r\n"), F.lit("\n")), fence, -1)

    def part(x: Column, i: Column) -> Column:
        python = x.rlike(r"^(?:python|py)\n")
        body = F.regexp_replace(x, r"^[^\n]*\n", "")
        block = F.concat(F.when(python, "\n.. code-block:: python\n\n").otherwise("::\n\n"), F.regexp_replace(body, r"(?m)^(?=.)", "    "))
        return F.when(i % 2 == 1, block).otherwise(x)

    rows = table(spark, sf_dir, "documents")
    title = F.when(tx.or_empty("title") != "", F.concat("title", F.lit("\n"), F.repeat(F.lit("="), F.length("title")), F.lit("\n\n"))).otherwise("")
    return rows.select(F.col("doc_id").alias("key"), F.concat(F.col("doc_id").cast("string"), F.lit(".rst")).alias("path"), F.concat(title, F.array_join(F.transform(parts, part), "")).alias("source"))


@named("gen_rst_blocks")
def gen_rst_blocks(spark, sf_dir):
    return extract.rst_table(rst_files(spark, sf_dir), "key", "source")


@named("gen_rst_examples")
def gen_rst_examples(spark, sf_dir):
    return extract.rst_samples(rst_files(spark, sf_dir))


_FENCE = "`" * 3
_MD = f"(?:^|\\n)([^\\n]*)\\n{_FENCE}(?:python|py)\\n((?s:.*?)){_FENCE}"


@named(
    "gen_md_blocks",
    f"""SELECT key, i AS block_no, context, code FROM (
          SELECT doc_id AS key, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS i, context, code FROM (
            SELECT doc_id, n, {q.strip('c[n]')} AS context, {q.strip('b[n]')} AS code FROM (
              SELECT doc_id, c, b, unnest(range(1, len(b) + 1)) AS n FROM (
                SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_MD}', 1) AS c, regexp_extract_all(coalesce(text, ''), '{_MD}', 2) AS b FROM documents)))
          WHERE length(code) > 20)""",
)
def gen_md_blocks(spark, sf_dir):
    return extract.markdown_table(table(spark, sf_dir, "documents"), "doc_id", "text")


@named(
    "gen_md_examples",
    f"""SELECT key, block_no, CASE WHEN told <> '' THEN 'Write Python code that ' || lower(told) ELSE 'Show me this Python example: ' || base END AS instruction, '' AS input, code AS output FROM (
          SELECT b.key, b.block_no, {q.strip("regexp_replace(b.context, '[#*`]', '', 'g')")} AS told, regexp_replace(regexp_extract(coalesce(d.title, ''), '([^/]*)$', 1), '(.)\\.[^.]*$', '\\1') AS base, b.code
          FROM ({ORACLE['gen_md_blocks']}) b JOIN documents d ON d.doc_id = b.key WHERE length(b.code) >= 50)""",
)
def gen_md_examples(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return extract.markdown_samples(rows, "doc_id", "title", "text")


@named("gen_md_code_legacy", f"SELECT doc_id, list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '(?s){_FENCE}python\\n(.*?){_FENCE}', 1), lambda x: {q.strip('x')}), lambda x: length(x) > 50) AS blocks FROM documents")
def gen_md_code_legacy(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", code.fenced_python("text").alias("blocks"))


@named("gen_code_blocks_html", "SELECT page_id, n - 1 AS block_no, b[n] AS code FROM (SELECT page_id, b, unnest(range(1, len(b) + 1)) AS n FROM (SELECT page_id, list_filter(regexp_extract_all(coalesce(html, ''), '(?s)<code[^>]*>([^<]*)</code>', 1), lambda x: length(x) > 20) AS b FROM pages))")
def gen_code_blocks_html(spark, sf_dir):
    blocks = F.filter(F.regexp_extract_all(tx.or_empty("html"), F.lit(r"(?s)<code[^>]*>([^<]*)</code>"), 1), lambda x: F.length(x) > 20)
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(blocks).alias("block_no", "code"))


@named("gen_links", """SELECT page_id, unnest(list_distinct(regexp_extract_all(coalesce(html, ''), '(?i)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1))) AS href FROM pages""")
def gen_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(web.links_of("html")).alias("href"))


@named(
    "gen_llm_samples",
    f"""SELECT 'What does this say: ' || coalesce(list_filter(list_transform(regexp_split_to_array(text, '{_BREAK}'), lambda x: {q.strip('x')}), lambda x: x <> '')[1], '') AS instruction, '' AS input, {q.strip('text')} AS output, chunk_id
        FROM chunks WHERE text IS NOT NULL""",
)
def gen_llm_samples(spark, sf_dir):
    chunks = table(spark, sf_dir, "chunks").select("doc_id", "chunk_id", "url", "text").where("text IS NOT NULL")
    ask = augment.with_failover([augment.stub_provider])
    return augment.supervision(chunks, titles.chunk_prompt("{chunk}", "text"), ask).select("instruction", "input", "output", F.col("_meta.chunk_id").alias("chunk_id"))


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _literals(texts) -> str:
    return "[" + ", ".join(map(_literal, texts)) + "]"


def _notes_sql(x: str) -> str:
    found = "list_filter([" + ", ".join(f"CASE WHEN contains({x}, {_literal(sign)}) THEN {_literal(note)} END" for sign, note in augment.NOTES) + "], lambda n: n IS NOT NULL)"
    return f"CASE WHEN len({found}) > 0 THEN chr(10) || chr(10) || '**What happens here:** ' || array_to_string({found}, ' ') ELSE '' END"


def _styles_sql() -> str:
    choice = lambda options, seed: f"{_literals(options)}[{q.pick('key', seed, len(options))}]"
    block = "'```python' || chr(10) || code || chr(10) || '```'"
    two = "chr(10) || chr(10)"
    told = f"CASE WHEN {q.pick('key', 'explain', 10)} <= 7 THEN {_notes_sql('code')} ELSE '' END"
    hint = f"CASE WHEN {q.pick('key', 'hint', 10)} <= 5 THEN {two} || '**Tip:** ' || {choice(augment.TIPS['python'], 'tip')} ELSE '' END"
    end = choice(augment.CLOSINGS, "closing")
    outputs = {
        "conversational": f"{choice(augment.OPENERS, 'opener')} || {choice(augment.INTRODUCTIONS, 'intro')} || {two} || {block} || {told} || {hint} || CASE WHEN {end} <> '' THEN {two} || {end} ELSE '' END",
        "tutorial": f"'## ' || task || {two} || '### Step 1: the code' || {two} || {block} || {_notes_sql('code')} || {two} || '### Step 2: try it' || {two} || 'Run it and compare the result with what you expect.'",
        "quick_ref": block,
    }
    rows = " UNION ALL ".join(f"SELECT key, task, '{style}' AS style, {output} AS output FROM samples" for style, output in outputs.items())
    bare = f"regexp_replace(lower(task), '^({'|'.join(titles.PREFIXES)})', '')"
    varied = f"CASE {q.pick('name', 'vary', 5)} WHEN 1 THEN 'How do I ' || t || '?' WHEN 2 THEN 'What''s the best way to ' || t || '?' WHEN 3 THEN 'Can you show me how to ' || t || '?' WHEN 4 THEN 'I need to ' || t ELSE 'Help me ' || t END"
    return f"""WITH samples AS (SELECT pair_id AS key, coalesce(instruction, '') AS task, coalesce(output, '') AS code FROM qa_pairs)
        SELECT key, style, {varied} AS instruction, '' AS input, output, 'python' AS domain FROM (SELECT *, key || ':' || style AS name, {bare} AS t FROM ({rows}))"""


@named("gen_styles", _styles_sql())
def gen_styles(spark, sf_dir):
    return augment.styles(samples(spark, sf_dir), "seq")


_PART = "CASE WHEN regexp_matches(x, '^(import |from )') THEN 'Imports' WHEN regexp_matches(x, '^def \\w') THEN 'Define ' || regexp_extract(x, '^def (\\w*)', 1) || '()' WHEN starts_with(x, 'def ') THEN 'Define function' WHEN regexp_matches(x, '^class \\w') THEN 'Define ' || regexp_extract(x, '^class (\\w*)', 1) || ' class' WHEN starts_with(x, 'class ') THEN 'Define class' END"


@named(
    "gen_code_sections",
    f"""WITH {q.FILES}, split AS (SELECT key, string_split(coalesce(source, ''), chr(10)) AS l FROM files WHERE path LIKE '%.py'),
        lines AS (SELECT key, i, l[i] AS x FROM (SELECT key, l, unnest(range(1, len(l) + 1)) AS i FROM split)),
        named AS (SELECT *, {_PART} AS part FROM lines),
        marked AS (SELECT *, part IS NOT NULL AND NOT (part = 'Imports' AND coalesce(last_value(part IGNORE NULLS) OVER (PARTITION BY key ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'Setup') = 'Imports') AS cut FROM named),
        placed AS (SELECT *, sum(CASE WHEN cut OR i = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY i) AS n FROM marked)
        SELECT key, CAST(n - 1 AS INT) AS section_no, coalesce(max(CASE WHEN cut THEN part END), 'Setup') AS name, string_agg(x, chr(10) ORDER BY i) AS code FROM placed GROUP BY key, n""",
)
def gen_code_sections(spark, sf_dir):
    return extract.code_section_table(source_files(spark, sf_dir).where("path LIKE '%.py'"), "key", "source")


def domains(spark, sf_dir):
    domain = F.element_at(F.array(*[F.lit(x) for x in ("python", "kubernetes", "security", "docker", "none")]), (F.pmod("seq", F.lit(5)) + 1).cast("int"))
    return samples(spark, sf_dir).withColumn("domain", domain)


_PATTERNS = ", ".join("(" + ", ".join([*map(_literal, p), str(sorted(x for x in augment.PATTERNS if x[-1] == p[-1]).index(p))]) + ")" for p in augment.PATTERNS)
_PATTERNS = f"patterns AS (SELECT * FROM (VALUES {_PATTERNS}) AS t(prompt, chosen, rejected, category, severity, domain, no))"


@named(
    "gen_dpo_random",
    f"""WITH {_PATTERNS}, records AS (
          SELECT pair_id AS key, coalesce(instruction, '') AS prompt, ['python', 'kubernetes', 'security', 'docker', 'none'][CAST(pair_id % 5 AS INT) + 1] AS domain, ('0x' || substring(md5('pattern' || CAST(pair_id AS VARCHAR)), 1, 8))::BIGINT AS digest FROM qa_pairs)
        SELECT r.key, r.domain, r.prompt, p.chosen, p.rejected, p.category, p.severity FROM records r JOIN patterns p ON p.domain = r.domain AND p.no = r.digest % (SELECT count(*) FROM patterns x WHERE x.domain = r.domain)""",
)
def gen_dpo_random(spark, sf_dir):
    return augment.preference_pairs(domains(spark, sf_dir), "seq")


@named("gen_dpo_static", f"WITH {_PATTERNS} SELECT prompt, chosen, rejected, category, severity, domain FROM patterns")
def gen_dpo_static(spark, sf_dir):
    return augment.patterns(spark)


# --- Filters ----------------------------------------------------------------------------------


@named("flt_short_output", f"SELECT pair_id FROM qa_pairs WHERE length({q.strip(q.text('output'))}) >= 50")
def flt_short_output(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").where(filters.long_enough("output")).select("pair_id")


_REASON = "CASE WHEN length(coalesce(instruction, '')) < 10 THEN 'short_instruction' WHEN length(coalesce(instruction, '')) > 500 THEN 'long_instruction' WHEN length(coalesce(output, '')) < 50 THEN 'short_output' WHEN length(coalesce(output, '')) > 10000 THEN 'long_output' END"


@named("flt_quality_len", f"SELECT coalesce({_REASON}, 'kept') AS reason, count(*) AS n FROM qa_pairs GROUP BY 1")
def flt_quality_len(spark, sf_dir):
    reason = F.coalesce(filters.quality_reason("instruction", "output"), F.lit("kept"))
    return table(spark, sf_dir, "qa_pairs").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@named("flt_grounded", f"SELECT pair_id FROM qa_pairs WHERE NOT (contains(coalesce(output, ''), '<') AND contains(coalesce(output, ''), '>')) AND {q.words('output')} >= 5")
def flt_grounded(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").where(filters.grounded("output")).select("pair_id")


@named("flt_required_keys", "SELECT pair_id FROM qa_pairs WHERE instruction IS NOT NULL AND output IS NOT NULL")
def flt_required_keys(spark, sf_dir):
    return filters.required(table(spark, sf_dir, "qa_pairs"), "instruction", "output").select("pair_id")


@named("flt_nonempty_pair", "SELECT coalesce(instruction, '') AS instruction, coalesce(input, '') AS input, coalesce(output, '') AS output FROM qa_pairs WHERE coalesce(instruction, '') <> '' AND coalesce(output, '') <> ''")
def flt_nonempty_pair(spark, sf_dir):
    rows = table(spark, sf_dir, "qa_pairs").select(F.col("instruction").alias("prompt"), F.col("input").alias("context"), F.col("output").alias("response"))
    return filters.from_raw(rows)


@named("flt_min_score", "SELECT pair_id FROM qa_pairs WHERE score >= 10")
def flt_min_score(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").where("score >= 10").select("pair_id")


@named("flt_answer_100", "SELECT pair_id FROM qa_pairs WHERE length(output) >= 100")
def flt_answer_100(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").where(F.length("output") >= 100).select("pair_id")


@named("flt_input_50", "SELECT pair_id, CASE WHEN length(input) > 50 THEN input ELSE '' END AS input FROM qa_pairs")
def flt_input_50(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").select("pair_id", F.when(F.length("input") > 50, F.col("input")).otherwise("").alias("input"))


@named("flt_code_len", f"WITH {q.FILES} SELECT key FROM files WHERE length(source) BETWEEN 50 AND 10000")
def flt_code_len(spark, sf_dir):
    return source_files(spark, sf_dir).where(F.length("source").between(50, 10_000)).select("key")


@named("flt_should_follow", f"SELECT page_id FROM pages WHERE {q.netloc('url')} = {q.netloc('lower(url)')} AND NOT regexp_matches(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1)), '\\.(pdf|png|jpg|gif|css|js|zip)$')")
def flt_should_follow(spark, sf_dir):
    return table(spark, sf_dir, "pages").where(web.should_follow("url", web.netloc(F.lower("url")))).select("page_id")


@named("flt_public_func")
def flt_public_func(spark, sf_dir):
    return gen_functions(spark, sf_dir).where(filters.public_function("name", "source")).select("key", "fn_no", "name")


# --- Joins and sets ---------------------------------------------------------------------------


@named("join_quality_labels", "SELECT d.doc_id, coalesce(l.quality, 0) AS quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def join_quality_labels(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", F.coalesce("quality", F.lit(0)).alias("quality"), "toxic")


@named("join_chunk_prov", "SELECT c.chunk_key, d.doc_id, d.source, d.lang FROM chunks c JOIN documents d ON c.doc_id = d.doc_id")
def join_chunk_prov(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return table(spark, sf_dir, "chunks").select("chunk_key", "doc_id").join(docs, "doc_id").select("chunk_key", "doc_id", "source", "lang")


@named("join_visited_anti", "SELECT DISTINCT url FROM documents d WHERE url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM chunks c WHERE c.url = d.url)")
def join_visited_anti(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("url").where("url IS NOT NULL").distinct().join(table(spark, sf_dir, "chunks").select("url"), "url", "left_anti")


@named("join_domain_practice", "SELECT seq, CASE seq % 5 WHEN 0 THEN 3 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 2 ELSE 0 END AS tips FROM (SELECT pair_id AS seq FROM qa_pairs)")
def join_domain_practice(spark, sf_dir):
    tips = spark.createDataFrame([(d, len(t)) for d, t in augment.TIPS.items()], "domain string, tips int")
    return domains(spark, sf_dir).select("seq", "domain").join(broadcast_small(tips), "domain", "left").select("seq", F.coalesce("tips", F.lit(0)).alias("tips"))


@named("set_union_all", "SELECT source, count(*) AS n FROM (SELECT source FROM qa_pairs UNION ALL SELECT source FROM documents) GROUP BY source")
def set_union_all(spark, sf_dir):
    both = table(spark, sf_dir, "qa_pairs").select("source").unionByName(table(spark, sf_dir, "documents").select("source"))
    return both.groupBy("source").agg(F.count("*").alias("n"))


@named("set_union_distinct", "SELECT url FROM documents UNION SELECT url FROM pages")
def set_union_distinct(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("url").unionByName(table(spark, sf_dir, "pages").select("url")).distinct()


@named("set_except", "SELECT item_id, list_filter(expected_keywords, lambda k: contains(lower(coalesce(text, '')), lower(k))) AS found, list_filter(expected_keywords, lambda k: NOT contains(lower(coalesce(text, '')), lower(k))) AS missing FROM benchmark")
def set_except(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", evaluate.found_terms("text", "expected_keywords").alias("found"), evaluate.missing_terms("text", "expected_keywords").alias("missing"))


@named("distinct_urls", "SELECT count(DISTINCT url) AS urls FROM qa_pairs")
def distinct_urls(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").agg(F.count_distinct("url").alias("urls"))


# --- Duplicates -------------------------------------------------------------------------------


@named("dedup_exact_first", "SELECT min(pair_id) AS pair_id FROM qa_pairs GROUP BY md5(coalesce(instruction, '') || ':' || coalesce(output, ''))")
def dedup_exact_first(spark, sf_dir):
    rows = table(spark, sf_dir, "qa_pairs").select("pair_id", "instruction", "output")
    return dedup.first_per_key(rows, keys.pair_key("instruction", "output"), "pair_id").select("pair_id")


@named("dedup_legacy", "SELECT min(pair_id) AS pair_id FROM qa_pairs GROUP BY md5(coalesce(instruction, '') || coalesce(output, ''))")
def dedup_legacy(spark, sf_dir):
    rows = table(spark, sf_dir, "qa_pairs").select("pair_id", "instruction", "output")
    return dedup.first_per_key(rows, keys.plain_pair_key("instruction", "output"), "pair_id").select("pair_id")


@named("dedup_rows", "SELECT min(pair_id) AS pair_id FROM qa_pairs GROUP BY instruction, input, output")
def dedup_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "qa_pairs")
    return rows.groupBy("instruction", "input", "output").agg(F.min("pair_id").alias("pair_id")).select("pair_id")


_JUDGE = f"""WITH RECURSIVE rows AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY seq) AS rn FROM (
    SELECT seq, dense_rank() OVER (ORDER BY li) AS l, dense_rank() OVER (ORDER BY ro) AS r, repeats FROM (
      SELECT pair_id AS seq, md5({q.norm("coalesce(instruction, '') || ' ' || coalesce(input, '')")}) AS li, md5({q.norm(q.text('output'))}) AS ro, {q.phrases('output')} > 3 OR {q.repeats('output')} AS repeats
      FROM qa_pairs WHERE length({q.strip(q.text('output'))}) >= 50))),
walk AS (
  SELECT 0::BIGINT AS rn, 0::BIGINT AS seq, []::BIGINT[] AS ls, []::BIGINT[] AS rs, '' AS reason
  UNION ALL
  SELECT x.rn, x.seq, CASE WHEN x.reason = 'kept' THEN list_append(w.ls, x.l) ELSE w.ls END, CASE WHEN x.reason = 'kept' THEN list_append(w.rs, x.r) ELSE w.rs END, x.reason
  FROM walk w, LATERAL (
    SELECT rows.rn, rows.seq, rows.l, rows.r, CASE WHEN list_contains(w.ls, rows.l) THEN 'duplicate_instruction' WHEN list_contains(w.rs, rows.r) THEN 'duplicate_output' WHEN rows.repeats THEN 'repetitive_output' ELSE 'kept' END AS reason
    FROM rows WHERE rows.rn = w.rn + 1) x),
judged AS (
  SELECT seq, reason FROM walk WHERE rn > 0
  UNION ALL SELECT pair_id, 'short_output' FROM qa_pairs WHERE length({q.strip(q.text('output'))}) < 50)
"""


@named("dedup_dual_greedy", f"{_JUDGE} SELECT seq FROM judged WHERE reason = 'kept'")
def dedup_dual_greedy(spark, sf_dir):
    return dedup.dual_greedy(samples(spark, sf_dir)).select("seq")


@named("dedup_dual_stats", f"{_JUDGE} SELECT reason, count(*) AS rows FROM judged GROUP BY reason")
def dedup_dual_stats(spark, sf_dir):
    return dedup.reason_counts(dedup.judge(samples(spark, sf_dir))).select("reason", "rows")


@named("dedup_fast", f"{_JUDGE.replace(f' OR {q.repeats(chr(111) + 'utput')} AS repeats', ' AS repeats')} SELECT seq, reason FROM judged")
def dedup_fast(spark, sf_dir):
    return dedup.judge(samples(spark, sf_dir), sentence_rule=False)


@named("dedup_near")
def dedup_near(spark, sf_dir):
    return dedup.legacy_keep(samples(spark, sf_dir)).select("seq")


@named("components_of_copies", """SELECT pair_id AS node, min(pair_id) OVER (PARTITION BY instruction, output) AS component FROM qa_pairs
       WHERE instruction IS NOT NULL AND output IS NOT NULL QUALIFY count(*) OVER (PARTITION BY instruction, output) > 1""")
def components_of_copies(spark, sf_dir):
    rows = table(spark, sf_dir, "qa_pairs").where("instruction IS NOT NULL AND output IS NOT NULL")
    least = rows.groupBy("instruction", "output").agg(F.min("pair_id").alias("a"), F.count("*").alias("n")).where("n > 1")
    edges = rows.join(least, ["instruction", "output"]).where("a <> pair_id").select("a", F.col("pair_id").alias("b"))
    return components(edges)


# --- Aggregations, windows, sorts -------------------------------------------------------------


@named("agg_dataset_meta", "SELECT count(*) AS num_samples, count(DISTINCT url) AS num_urls FROM qa_pairs")
def agg_dataset_meta(spark, sf_dir):
    return reports.dataset_meta(table(spark, sf_dir, "qa_pairs").select("instruction", "output", "url")).select("num_samples", "num_urls")


@named("agg_by_source", "SELECT source, count(*) AS rows, CAST(grouping(source) AS INT) AS is_total FROM qa_pairs GROUP BY ROLLUP (source)")
def agg_by_source(spark, sf_dir):
    return reports.per_source(table(spark, sf_dir, "qa_pairs"))


@named("agg_len_stats", """SELECT min(length(coalesce(instruction, ''))) AS instruction_min, max(length(coalesce(instruction, ''))) AS instruction_max, CAST(floor(avg(length(coalesce(instruction, '')))) AS BIGINT) AS instruction_mean,
   min(length(coalesce(output, ''))) AS output_min, max(length(coalesce(output, ''))) AS output_max, CAST(floor(avg(length(coalesce(output, '')))) AS BIGINT) AS output_mean FROM qa_pairs""")
def agg_len_stats(spark, sf_dir):
    return reports.length_stats(table(spark, sf_dir, "qa_pairs"))


@named("agg_category_counts", "SELECT category, count(*) AS rows FROM benchmark GROUP BY category")
def agg_category_counts(spark, sf_dir):
    return reports.category_counts(table(spark, sf_dir, "benchmark"))


@named("agg_crawl_stats", "SELECT count(*) FILTER (strlen(coalesce(html, '')) > 0) AS pages, count(*) FILTER (strlen(coalesce(html, '')) = 0) AS failed, CAST(sum(strlen(coalesce(html, ''))) AS BIGINT) AS bytes FROM pages")
def agg_crawl_stats(spark, sf_dir):
    return reports.crawl_stats(table(spark, sf_dir, "pages"))


@named(
    "agg_extract_stats",
    f"""WITH RECURSIVE {_CHUNKS} SELECT documents, characters, sections, chunks, chunks / greatest(documents, 1) AS chunks_per_document FROM
        (SELECT count(*) AS documents, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS characters FROM documents), (SELECT count(DISTINCT (doc_id, section_no)) AS sections, count(*) AS chunks FROM chunked)""",
)
def agg_extract_stats(spark, sf_dir):
    return reports.extraction_stats(gen_chunks(spark, sf_dir), table(spark, sf_dir, "documents"))


@named(
    "agg_log_metrics",
    """SELECT user_id, arg_min(floor(value), (ts, event_id)) AS first_loss, arg_max(floor(value), (ts, event_id)) AS last_loss, CAST(NULL AS DOUBLE) AS eval_loss, CAST(NULL AS INT) AS step, false AS completed FROM events GROUP BY user_id""",
)
def agg_log_metrics(spark, sf_dir):
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", "value"))), lambda x: F.concat(F.lit("loss: "), F.floor(x["value"]).cast("string")))).alias("log"))
    return rows.select("user_id", *reports.log_metrics("log"))


@named(
    "agg_best_answer",
    """SELECT o_orderkey AS question_id, l_linenumber AS answer_id FROM (
         SELECT o.o_orderkey, l.l_linenumber, row_number() OVER (PARTITION BY o.o_orderkey ORDER BY CASE WHEN l.l_linestatus = 'F' AND CAST(l.l_quantity AS INT) - 20 >= 0 THEN 0 ELSE 1 END,
           CASE WHEN l.l_linestatus = 'F' AND CAST(l.l_quantity AS INT) - 20 >= 0 THEN 0 ELSE -(CAST(l.l_quantity AS INT) - 20) END, l.l_linenumber) AS n
         FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE CAST(l.l_quantity AS INT) - 20 >= 0) WHERE n = 1""",
)
def agg_best_answer(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    answers = items.select(items["l_orderkey"].alias("question_id"), items["l_linenumber"].alias("answer_id"), (items["l_quantity"].cast("int") - 20).alias("score"), (items["l_linestatus"] == "F").alias("is_accepted"))
    asked = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("question_id"))
    return qa.best_answers(answers).join(asked, "question_id").select("question_id", "answer_id")


@named(
    "topk_per_tag",
    """SELECT source, pair_id FROM (SELECT source, pair_id, row_number() OVER (PARTITION BY source ORDER BY score DESC NULLS LAST, pair_id) AS n FROM qa_pairs) WHERE n <= 3""",
)
def topk_per_tag(spark, sf_dir):
    rows = table(spark, sf_dir, "qa_pairs").select("source", "pair_id", "score")
    return dedup.top_per_group(rows, "source", 3, F.col("score").desc_nulls_last(), F.col("pair_id")).select("source", "pair_id")


@named("sort_hash", "SELECT pair_id, sha256(coalesce(instruction, '') || coalesce(output, '')) AS digest FROM qa_pairs")
def sort_hash(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").select("pair_id", keys.order_key("instruction", "output").alias("digest")).orderBy("digest", "pair_id")


@named("latest_checkpoint", "SELECT 'run/checkpoint-' || max(doc_id) AS path, max(doc_id) AS step FROM documents")
def latest_checkpoint(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("run/checkpoint-"), F.col("doc_id").cast("string")).alias("path"))
    return reports.latest_checkpoint(rows)


@named("win_delta_step", f"SELECT run_id, ts, step, step - coalesce(lag(step) OVER (PARTITION BY run_id ORDER BY ts, step), 0) AS delta FROM ({PROGRESS_SQL})")
def win_delta_step(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("run_id").orderBy("ts", "step")
    return progress(spark, sf_dir).withColumn("delta", F.col("step") - F.coalesce(F.lag("step").over(w), F.lit(0)))


# --- Formats ----------------------------------------------------------------------------------

_HUMAN = "CASE WHEN coalesce(input, '') <> '' THEN coalesce(instruction, '') || chr(10) || chr(10) || input ELSE coalesce(instruction, '') END"


@named("fmt_alpaca", "SELECT coalesce(instruction, '') AS instruction, coalesce(input, '') AS input, coalesce(output, '') AS output FROM qa_pairs")
def fmt_alpaca(spark, sf_dir):
    return formats.alpaca(table(spark, sf_dir, "qa_pairs"))


@named("fmt_sharegpt", f"SELECT pair_id, [{{'from': 'human', 'value': {_HUMAN}}}, {{'from': 'gpt', 'value': coalesce(output, '')}}] AS conversations FROM qa_pairs")
def fmt_sharegpt(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").select("pair_id", formats.sharegpt().alias("conversations"))


@named("fmt_sharegpt_noinput", "SELECT pair_id, [{'from': 'human', 'value': coalesce(instruction, '')}, {'from': 'gpt', 'value': coalesce(output, '')}] AS conversations FROM qa_pairs")
def fmt_sharegpt_noinput(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").select("pair_id", formats.sharegpt(extra=None).alias("conversations"))


@named("fmt_chatml", f"SELECT pair_id, [{{'role': 'system', 'content': '{formats.SYSTEM}'}}, {{'role': 'user', 'content': CASE WHEN coalesce(input, '') <> '' THEN coalesce(instruction, '') || chr(10) || chr(10) || 'Context: ' || input ELSE coalesce(instruction, '') END}}, {{'role': 'assistant', 'content': coalesce(output, '')}}] AS messages FROM qa_pairs")
def fmt_chatml(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").select("pair_id", formats.chatml().alias("messages"))


@named("fmt_completion", "SELECT pair_id, '### Instruction:' || chr(10) || coalesce(instruction, '') || chr(10) || chr(10) || '### Response:' || chr(10) || coalesce(output, '') || chr(10) AS text FROM qa_pairs")
def fmt_completion(spark, sf_dir):
    return table(spark, sf_dir, "qa_pairs").select("pair_id", formats.completion().alias("text"))


def _preferences(spark, sf_dir):
    rows = table(spark, sf_dir, "qa_pairs")
    return rows.select(rows["instruction"].alias("prompt"), rows["output"].alias("chosen"), rows["input"].alias("rejected"))


@named("fmt_dpo", "SELECT instruction AS prompt, output AS chosen, input AS rejected FROM qa_pairs")
def fmt_dpo(spark, sf_dir):
    return formats.dpo(_preferences(spark, sf_dir))


@named("fmt_orpo", "SELECT instruction, output AS chosen, input AS rejected FROM qa_pairs")
def fmt_orpo(spark, sf_dir):
    return formats.orpo(_preferences(spark, sf_dir))


@named("fmt_rlhf", "SELECT instruction AS prompt, [output, input] AS responses, [0, 1] AS ranking FROM qa_pairs")
def fmt_rlhf(spark, sf_dir):
    return formats.rlhf(_preferences(spark, sf_dir))


@named("fmt_supervision", "SELECT section AS instruction, '' AS input, text AS output, {'doc_id': doc_id, 'chunk_id': chunk_id, 'source_url': url} AS _meta FROM chunks")
def fmt_supervision(spark, sf_dir):
    rows = table(spark, sf_dir, "chunks").withColumns({"instruction": F.col("section"), "input": F.lit(""), "output": F.col("text")})
    return formats.supervision(rows, "doc_id", "chunk_id", "url").select("instruction", "input", "output", "_meta")


@named(
    "fmt_turns",
    """SELECT conv_id, turn, coalesce(text, '') AS instruction, coalesce(system, '') AS input, coalesce(answer, '') AS output FROM (
         SELECT conv_id, turn, lower(role) AS role, text, lead(lower(role)) OVER w AS next, lead(text) OVER w AS answer, first_value(CASE WHEN lower(role) = 'system' THEN text END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS system
         FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, coalesce(role, ''), coalesce(text, ''))) WHERE role = 'user' AND next = 'assistant'""",
)
def fmt_turns(spark, sf_dir):
    return qa.turns_to_samples(table(spark, sf_dir, "conversations"))


@named("fmt_qa_page")
def fmt_qa_page(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    crawled = rows.select(
        "url", web.netloc("url").alias("domain"), F.lit(0).alias("depth"), web.html_title("html").alias("title"), web.content_select("html").alias("content"),
        F.transform(web.code_blocks_of("html"), lambda b: F.struct(web.detect_language(b["classes"], b["code"]).alias("language"), b["code"].alias("code"))).alias("code_blocks"),
    )
    return qa.from_pages(crawled).select("instruction", "output", "source", "tags", "url")


# --- Evaluation -------------------------------------------------------------------------------

_KW = "len(list_filter(expected_keywords, lambda k: contains(lower(coalesce(response, '')), lower(k))))"
_RESP = "resp AS (SELECT b.item_id AS question_id, b.category, b.expected_keywords, m.model, CASE m.model WHEN 'base' THEN d.text ELSE b.text END AS response FROM benchmark b LEFT JOIN documents d ON d.doc_id = b.item_id, (VALUES ('base'), ('tuned')) m(model))"
_SENT = q.sentences("response", "[.!?]")
_COV = f"CASE WHEN coalesce(response, '') = '' THEN 0.0 ELSE coalesce({_KW} / nullif(CAST(len(expected_keywords) AS DOUBLE), 0), 0.0) END"
_RATIO = f"CASE WHEN length(coalesce(response, '')) < 100 OR len({_SENT}) < 2 THEN 0.0 ELSE (1.0 - CAST(len(list_distinct(list_transform({_SENT}, lambda s: lower(s)))) AS DOUBLE) / len({_SENT})) * 100 END"
_CODE = f"(contains(coalesce(response, ''), '{_FENCE}') OR contains(coalesce(response, ''), 'def ') OR contains(coalesce(response, ''), 'import '))"
_SCORED = f"""{_RESP}, scored AS (SELECT *, CASE WHEN response IS NULL OR starts_with(response, 'Error:') THEN 0 ELSE CAST(round_even(
   least(40.0, ({_COV}) * 100 * 0.4) + CASE WHEN {_CODE} THEN 30 ELSE 0 END + CASE WHEN length(response) > 200 THEN 20 ELSE 0 END + CASE WHEN {_RATIO} < 20 THEN 10 ELSE 0 END, 0) AS INT) END AS score FROM resp)"""
_PAIRED = f"{_SCORED}, paired AS (SELECT b.question_id, b.category, b.score AS base, t.score AS tuned, t.score - b.score AS diff FROM scored b JOIN scored t USING (question_id) WHERE b.model = 'base' AND t.model = 'tuned')"


@named("ev_keyword_cov", f"WITH {_RESP} SELECT question_id, model, round(({_COV}) * 100, 6) AS coverage FROM resp")
def ev_keyword_cov(spark, sf_dir):
    return results(spark, sf_dir).select("question_id", "model", F.round(evaluate.keyword_coverage("response", "keywords"), 6).alias("coverage"))


@named("ev_term_cov", f"WITH {_RESP} SELECT question_id, model, round({_COV}, 6) AS coverage, list_filter(expected_keywords, lambda k: NOT contains(lower(coalesce(response, '')), lower(k))) AS missing FROM resp")
def ev_term_cov(spark, sf_dir):
    return results(spark, sf_dir).select("question_id", "model", F.round(evaluate.coverage("response", "keywords"), 6).alias("coverage"), evaluate.missing_terms("response", "keywords").alias("missing"))


@named("ev_concept_pattern", f"WITH {_RESP} SELECT question_id, model, (CASE WHEN regexp_matches(coalesce(response, ''), '(?i)def |resource') THEN 0.5 ELSE 0.0 END) + (CASE WHEN regexp_matches(coalesce(response, ''), '(?i)\\d+ (ms|seconds)') THEN 0.5 ELSE 0.0 END) AS patterns FROM resp")
def ev_concept_pattern(spark, sf_dir):
    wanted = F.array(F.lit("def |resource"), F.lit(r"\d+ (ms|seconds)"))
    return results(spark, sf_dir).select("question_id", "model", evaluate.pattern_coverage("response", wanted).alias("patterns"))


@named("ev_has_code", f"WITH {_RESP} SELECT question_id, model, {_CODE} AS has_code FROM resp")
def ev_has_code(spark, sf_dir):
    return results(spark, sf_dir).select("question_id", "model", evaluate.has_code("response").alias("has_code"))


@named("ev_score", f"WITH {_SCORED} SELECT question_id, model, score FROM scored")
def ev_score(spark, sf_dir):
    return results(spark, sf_dir).select("question_id", "model", "score")


@named("ev_winner", f"WITH {_PAIRED} SELECT question_id, CASE WHEN tuned > base THEN 'finetuned' WHEN base > tuned THEN 'base' ELSE 'tie' END AS winner FROM paired")
def ev_winner(spark, sf_dir):
    return evaluate.pair_models(results(spark, sf_dir)).select("question_id", evaluate.winner("base", "tuned").alias("winner"))


@named("ev_status", f"WITH {_PAIRED} SELECT question_id, CASE WHEN diff > 10 THEN 'Improved' WHEN diff < -10 THEN 'Regressed' ELSE 'Similar' END AS status FROM paired")
def ev_status(spark, sf_dir):
    return evaluate.pair_models(results(spark, sf_dir)).select("question_id", evaluate.status("diff").alias("status"))


@named("ev_loss_improve", "SELECT doc_id, CASE WHEN p < 10 THEN 'little' WHEN p <= 80 THEN 'good' ELSE 'too much' END AS band FROM (SELECT doc_id, (n_chars - 500.0) * 100 / nullif(n_chars, 0) AS p FROM documents) WHERE p IS NOT NULL")
def ev_loss_improve(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", evaluate.loss_improvement(F.col("n_chars").cast("double"), F.lit(500.0)).alias("p")).where("p IS NOT NULL")
    return rows.select("doc_id", evaluate.loss_band("p").alias("band"))


@named("join_models", f"WITH {_PAIRED} SELECT question_id, category, base, tuned, diff FROM paired")
def join_models(spark, sf_dir):
    return evaluate.pair_models(results(spark, sf_dir))


@named("agg_eval_avg", f"WITH {_PAIRED} SELECT count(*) AS questions, round(avg(base), 6) AS base_mean, round(avg(tuned), 6) AS tuned_mean, count(*) FILTER (diff > 5) AS improved, count(*) FILTER (diff < -5) AS regressed, round(avg(tuned) - avg(base), 6) AS gain FROM paired")
def agg_eval_avg(spark, sf_dir):
    one = evaluate.summary(evaluate.pair_models(results(spark, sf_dir)))
    return one.select("questions", F.round("base_mean", 6).alias("base_mean"), F.round("tuned_mean", 6).alias("tuned_mean"), "improved", "regressed", F.round("gain", 6).alias("gain"))


@named("agg_wins", f"WITH {_PAIRED} SELECT count(*) FILTER (diff > 0) AS tuned_wins, count(*) FILTER (diff < 0) AS base_wins, count(*) FILTER (diff = 0) AS ties FROM paired")
def agg_wins(spark, sf_dir):
    return evaluate.summary(evaluate.pair_models(results(spark, sf_dir))).select("tuned_wins", "base_wins", "ties")


@named("agg_eval_category", f"WITH {_PAIRED} SELECT category, round(avg(base), 6) AS base_mean, round(avg(tuned), 6) AS tuned_mean, round(avg(diff), 6) AS diff_mean, CASE WHEN avg(diff) > 5 THEN 'up' WHEN avg(diff) < -5 THEN 'down' ELSE 'same' END AS flag FROM paired GROUP BY category")
def agg_eval_category(spark, sf_dir):
    rows = evaluate.by_category(evaluate.pair_models(results(spark, sf_dir)))
    return rows.select("category", *[F.round(c, 6).alias(c) for c in ("base_mean", "tuned_mean", "diff_mean")], "flag")


@named("agg_eval_argmax", f"WITH {_PAIRED}, c AS (SELECT category, avg(tuned) AS t, avg(diff) AS d FROM paired GROUP BY category) SELECT (SELECT category FROM c ORDER BY t DESC, category DESC LIMIT 1) AS best, (SELECT category FROM c ORDER BY d DESC, category DESC LIMIT 1) AS most_improved")
def agg_eval_argmax(spark, sf_dir):
    return evaluate.best_categories(evaluate.by_category(evaluate.pair_models(results(spark, sf_dir))))


@named("topk_improved", f"WITH {_PAIRED} SELECT question_id, diff FROM paired ORDER BY diff DESC, question_id LIMIT 3")
def topk_improved(spark, sf_dir):
    return evaluate.top_improved(evaluate.pair_models(results(spark, sf_dir))).select("question_id", "diff")


@named("agg_eval_summary", f"WITH {_PAIRED} SELECT round(CASE WHEN avg(base) > 0 THEN (avg(tuned) - avg(base)) * 100 / avg(base) ELSE 0 END, 6) AS gain_percent FROM paired")
def agg_eval_summary(spark, sf_dir):
    return evaluate.summary(evaluate.pair_models(results(spark, sf_dir))).select(F.round("gain_percent", 6).alias("gain_percent"))


# --- State and graphs -------------------------------------------------------------------------


@named(
    "st_stall",
    f"""WITH p AS ({PROGRESS_SQL}), m AS (SELECT *, CAST(step <> coalesce(lag(step) OVER w, 0) AS INT) AS moved FROM p WINDOW w AS (PARTITION BY run_id ORDER BY ts, step)),
        i AS (SELECT *, sum(moved) OVER (PARTITION BY run_id ORDER BY ts, step ROWS UNBOUNDED PRECEDING) AS island FROM m)
        SELECT run_id, ts, step, CAST(row_number() OVER (PARTITION BY run_id, island ORDER BY ts, step) - max(moved) OVER (PARTITION BY run_id, island) AS INT) AS unchanged,
          row_number() OVER (PARTITION BY run_id, island ORDER BY ts, step) - max(moved) OVER (PARTITION BY run_id, island) >= 2 AS stalled FROM i""",
)
def st_stall(spark, sf_dir):
    return monitor.stalls(progress(spark, sf_dir), checks=2)


@named(
    "st_hang_delta",
    f"SELECT run_id, ts, step AS hangs, step > coalesce(max(step) OVER (PARTITION BY run_id ORDER BY ts, step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS alarm FROM ({PROGRESS_SQL})",
)
def st_hang_delta(spark, sf_dir):
    return monitor.hangs(progress(spark, sf_dir), count="step")


@named("st_recovery_level", "SELECT run_id, ts, attempt, least(attempt - 1, 3) AS level, attempt >= 5 AS give_up FROM (SELECT CAST(user_id AS VARCHAR) AS run_id, ts, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts) AS INT) AS attempt FROM events WHERE event_type = 'error')")
def st_recovery_level(spark, sf_dir):
    rows = table(spark, sf_dir, "events").where("event_type = 'error'").select(F.col("user_id").cast("string").alias("run_id"), "ts")
    return monitor.recovery(rows)


@named(
    "st_progress",
    f"SELECT run_id, step, step * 100.0 / 1000 AS percent, greatest(1000 - step, 0) AS remaining, greatest(1000 - step, 0) * 15.0 AS eta_seconds FROM (SELECT run_id, arg_max(step, (ts, step)) AS step FROM ({PROGRESS_SQL}) GROUP BY run_id)",
)
def st_progress(spark, sf_dir):
    rows = monitor.latest_progress(progress(spark, sf_dir), 1000)
    return rows.select("run_id", "step", F.col("percent").cast("double").alias("percent"), "remaining", F.col("eta_seconds").cast("double").alias("eta_seconds"))


@named("st_completion", "SELECT event_id FROM events WHERE regexp_matches(event_type, '(?i)purchase')")
def st_completion(spark, sf_dir):
    return monitor.completions(table(spark, sf_dir, "events"), "event_type", "(?i)purchase").select("event_id")


_STARTS = f"starts AS (SELECT min({q.normalize_url('url')}) AS url FROM pages WHERE url IS NOT NULL GROUP BY {q.netloc('url')})"


@named(
    "link_bfs",
    f"""WITH RECURSIVE {q.LINKS}, {_STARTS}, e AS (SELECT src, dst FROM links WHERE dst LIKE 'http%' AND {q.netloc('src')} = {q.netloc('dst')}),
       r(url, depth) AS (SELECT url, 0 FROM starts UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON r.url = e.src WHERE r.depth < 4)
       SELECT url, min(depth) AS depth FROM r GROUP BY url""",
)
def link_bfs(spark, sf_dir):
    """What the least url of every host reaches over the links of the pages."""
    pages = table(spark, sf_dir, "pages")
    starts = pages.where("url IS NOT NULL").groupBy(web.netloc("url").alias("host")).agg(F.min(web.normalize_url("url")).alias("url"))
    return linkgraph.reachable(linkgraph.page_links(pages), starts)


@named(
    "link_bfs_across",
    f"""WITH RECURSIVE {q.LINKS}, {_STARTS}, e AS (SELECT src, dst FROM links WHERE dst LIKE 'http%'),
       r(url, depth) AS (SELECT url, 0 FROM starts UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON r.url = e.src WHERE r.depth < 4)
       SELECT url, min(depth) AS depth FROM r GROUP BY url""",
)
def link_bfs_across(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    starts = pages.where("url IS NOT NULL").groupBy(web.netloc("url").alias("host")).agg(F.min(web.normalize_url("url")).alias("url"))
    return linkgraph.reachable(linkgraph.page_links(pages), starts, same_host=False)


@named("crawl_resume", f"WITH {q.LINKS} SELECT DISTINCT dst AS url FROM links WHERE dst LIKE 'http%' AND src IN (SELECT {q.normalize_url('url')} FROM pages) AND dst NOT IN (SELECT {q.normalize_url('url')} FROM pages WHERE url IS NOT NULL)")
def crawl_resume(spark, sf_dir):
    links = linkgraph.page_links(table(spark, sf_dir, "pages"))
    visited = table(spark, sf_dir, "pages").select(web.normalize_url("url").alias("url")).distinct()
    return linkgraph.resume(links, visited)


@named("windowed_events", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY ALL")
def windowed_events(spark, sf_dir):
    return monitor.windowed_counts(table(spark, sf_dir, "events"))


# --- More of the inventory --------------------------------------------------------------------


@named("fn_main_content")
def fn_main_content(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", web.main_content("html").alias("content"))


@named("fn_page_answer", "SELECT doc_id, substring(coalesce(text, ''), 1, 2000) AS answer FROM documents")
def fn_page_answer(spark, sf_dir):
    none = F.array().cast("array<struct<language:string,code:string>>")
    return table(spark, sf_dir, "documents").select("doc_id", qa.page_answer("text", none).alias("answer"))


@named("flt_web_200", "SELECT doc_id FROM documents WHERE coalesce(title, '') <> '' AND length(text) >= 200")
def flt_web_200(spark, sf_dir):
    return table(spark, sf_dir, "documents").where((tx.or_empty("title") != "") & (F.length("text") >= 200)).select("doc_id")


@named("flt_allowed_url", f"SELECT DISTINCT url FROM documents d WHERE {q.netloc('url')} = (SELECT min({q.netloc('url')}) FROM documents) AND NOT EXISTS (SELECT 1 FROM chunks c WHERE c.url = d.url) AND NOT regexp_matches(url, '^[a-z]+://[^/]*/guide/')")
def flt_allowed_url(spark, sf_dir):
    urls = table(spark, sf_dir, "documents").select("url").where("url IS NOT NULL").distinct()
    host = urls.agg(F.min(web.netloc("url"))).first()[0]
    rules = spark.createDataFrame([(host, "/guide/")], "host string, prefix string")
    return linkgraph.allowed(urls, table(spark, sf_dir, "chunks").select("url"), rules, host).select("url")


@named("join_page_meta", "SELECT p.page_id, d.doc_id, d.title FROM pages p JOIN documents d ON p.url = d.url")
def join_page_meta(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("basename"))
    found, _ = files.pages_with_meta(pages, table(spark, sf_dir, "documents").select(F.col("url").alias("basename"), "doc_id", "title"))
    return found.select("page_id", "doc_id", "title")


@named("join_q_answer", ORACLE["agg_best_answer"].replace("SELECT o_orderkey AS question_id", "SELECT o_custkey AS asker, o_orderkey AS question_id").replace("SELECT o.o_orderkey,", "SELECT o.o_custkey, o.o_orderkey,"))
def join_q_answer(spark, sf_dir):
    asked = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("question_id"), F.col("o_custkey").alias("asker"))
    return agg_best_answer(spark, sf_dir).join(asked, "question_id").select("asker", "question_id", "answer_id")


@named(
    "agg_best_comment",
    """SELECT issue_id, seq, points FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY points DESC, seq) AS n FROM (
         SELECT user_id AS issue_id, event_id AS seq, CAST((CAST(floor(value) AS INT) % 5) * 2 - (CAST(floor(value) AS INT) % 3) * 2 AS INT) AS points FROM events) WHERE points > -1) WHERE n = 1""",
)
def agg_best_comment(spark, sf_dir):
    n = F.floor("value").cast("int")
    reactions = F.create_map(F.lit("+1"), n % 5, F.lit("-1"), n % 3)
    comments = table(spark, sf_dir, "events").select(F.col("user_id").alias("issue_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("body"), reactions.alias("reactions"))
    return qa.best_comments(comments).select("issue_id", "seq", "points")


@named("agg_reason_counts", f"{_JUDGE}, total AS (SELECT count(*) AS n, count(*) FILTER (reason = 'kept') AS k FROM judged) SELECT reason, count(*) AS rows, round((any_value(n) - any_value(k)) * 100.0 / any_value(n), 6) AS reduction FROM judged, total GROUP BY reason")
def agg_reason_counts(spark, sf_dir):
    return dedup.reason_counts(dedup.judge(samples(spark, sf_dir))).select("reason", "rows", F.round("reduction", 6).alias("reduction"))


@named("distinct_repos", "SELECT source, min(pair_id) AS pair_id FROM qa_pairs GROUP BY source")
def distinct_repos(spark, sf_dir):
    rows = table(spark, sf_dir, "qa_pairs").select("source", "pair_id")
    return dedup.first_per_key(rows, F.col("source"), "pair_id")


@named("join_repo_anti", "SELECT DISTINCT source FROM qa_pairs q WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE 'web:' || d.source = q.source)")
def join_repo_anti(spark, sf_dir):
    have = table(spark, sf_dir, "documents").select(F.concat(F.lit("web:"), "source").alias("source"))
    return table(spark, sf_dir, "qa_pairs").select("source").distinct().join(have, "source", "left_anti")


@named("topk_per_query", "SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS n FROM documents WHERE lang IS NOT NULL) WHERE n <= 2")
def topk_per_query(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").where("lang IS NOT NULL").select("lang", "doc_id", "n_chars")
    return dedup.top_per_group(rows, "lang", 2, F.col("n_chars").desc(), F.col("doc_id")).select("lang", "doc_id")


@named("fmt_full", "SELECT instruction, input, output, source, source_type, score, tags, url, collected_at, list_sort(map_entries(metadata)) AS metadata FROM qa_pairs")
def fmt_full(spark, sf_dir):
    return formats.full(table(spark, sf_dir, "qa_pairs")).withColumn("metadata", F.array_sort(F.map_entries("metadata")))


@named("win_seq", "SELECT source, pair_id, row_number() OVER (PARTITION BY source ORDER BY pair_id) AS n FROM qa_pairs")
def win_seq(spark, sf_dir):
    return reports.numbered(table(spark, sf_dir, "qa_pairs").select("source", "pair_id"), "source", "pair_id")


@named("sort_improvement", f"WITH {_PAIRED} SELECT question_id, diff FROM paired ORDER BY diff DESC, question_id")
def sort_improvement(spark, sf_dir):
    return evaluate.pair_models(results(spark, sf_dir)).select("question_id", "diff").orderBy(F.col("diff").desc(), "question_id")


# --- Flagship ---------------------------------------------------------------------------------


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicate the samples by both keys, and count what was kept and dropped, by source and reason."""
    rows = samples(spark, sf_dir)
    judged = dedup.judge(rows)
    return judged.join(rows.select("seq", "source"), "seq").groupBy("source", "reason").agg(F.count("*").alias("rows")).orderBy("source", "reason")


QUERIES["flagship"] = flagship
ORACLE["flagship"] = f"{_JUDGE} SELECT q.source, j.reason, count(*) AS rows FROM judged j JOIN qa_pairs q ON q.pair_id = j.seq GROUP BY ALL"
