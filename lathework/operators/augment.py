"""Samples in several styles, preference pairs, and replies of a language model."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lathework.functions.code import FENCE
from lathework.functions.keys import pick
from lathework.functions.text import Name, col, or_empty, strip
from lathework.functions.titles import vary_instruction
from lathework.session import broadcast_small

# Texts of this library, by style and domain.
OPENERS = ("Happy to help with that. ", "Here is how I would approach it. ", "This comes up often. ", "Let's keep it small and clear. ")
INTRODUCTIONS = ("The code below does it:", "A working version looks like this:", "Start from this:", "This is enough for most cases:")
CLOSINGS = ("Adapt the names to your setup.", "Run it once against a test system first.", "Tell me if your case differs.", "")
TIPS = {
    "python": ("Keep functions short and give them types.", "Let a context manager close what you open.", "Log what failed together with its input."),
    "kubernetes": ("Set requests and limits on every container.", "Use a readiness probe before you route traffic.", "Keep secrets out of manifests."),
    "security": ("Never log a credential.", "Give each service its own least-privileged account."),
    "docker": ("Pin the base image by digest.", "Run as a user other than root."),
}
NOTES = (
    ("with ", "The context manager cleans up even when an error occurs."), ("try:", "The try block keeps a failure from ending the run."), ("@", "The decorator adds behaviour without touching the body."),
    ("async ", "The coroutine leaves the loop free while it waits."), ("yield", "The generator holds one item at a time."),
)
ERRORS = (
    ("ApiException", "the cluster's interface refused the request"), ("ConnectionError", "the service could not be reached"), ("TimeoutError", "the call took longer than allowed"),
    ("KeyError", "the mapping has no such key"), ("AttributeError", "the object has no such attribute"), ("TypeError", "a value has another type than expected"), ("ImportError", "the module is not installed here"),
)
PATTERNS = (
    ("Open a file and read it", "with open(path) as file:\n    text = file.read()", "file = open(path)\ntext = file.read()", "resources", "medium", "python"),
    ("Give a function a list to collect into", "def collect(item, into=None):\n    into = [] if into is None else into\n    into.append(item)\n    return into", "def collect(item, into=[]):\n    into.append(item)\n    return into", "defaults", "high", "python"),
    ("Catch an error of a request", "try:\n    send()\nexcept ConnectionError as error:\n    log.warning(error)", "try:\n    send()\nexcept:\n    pass", "errors", "high", "python"),
    ("Join many strings", "text = ''.join(parts)", "text = ''\nfor part in parts:\n    text += part", "speed", "low", "python"),
    ("Compare with nothing", "if value is None:\n    return", "if value == None:\n    return", "style", "low", "python"),
    ("Limit what a container may use", "resources:\n  limits:\n    memory: 256Mi\n    cpu: 500m", "resources: {}", "limits", "high", "kubernetes"),
    ("Run a container as a plain user", "securityContext:\n  runAsNonRoot: true", "securityContext:\n  privileged: true", "rights", "high", "kubernetes"),
    ("Name the image of a deployment", "image: registry.example/app@sha256:0f3a", "image: registry.example/app:latest", "images", "medium", "kubernetes"),
    ("Pass a value to a query", "cursor.execute('SELECT * FROM t WHERE id = %s', (key,))", "cursor.execute('SELECT * FROM t WHERE id = ' + key)", "injection", "high", "security"),
    ("Read a credential", "token = os.environ['TOKEN']", "token = 'written in the file'", "secrets", "critical", "security"),
    ("Start a command with arguments", "subprocess.run(['ls', folder], check=True)", "os.system('ls ' + folder)", "injection", "high", "security"),
    ("Build a small image", "FROM python:3.12-slim\nRUN pip install --no-cache-dir app", "FROM ubuntu\nRUN apt-get update && apt-get install -y everything", "images", "medium", "docker"),
)


def _choice(options: Sequence[str], key: Column, seed: str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in options]), pick(key, seed, len(options)))


def explanation(code: Name) -> Column:
    """Notes on constructs that a code holds, in a fixed order; empty where it holds none."""
    notes = F.filter(F.array(*[F.when(F.contains(or_empty(code), F.lit(sign)), F.lit(note)) for sign, note in NOTES]), lambda x: x.isNotNull())
    return F.when(F.size(notes) > 0, F.concat(F.lit("\n\n**What happens here:** "), F.array_join(notes, " "))).otherwise("")


def error_reason(message: Name) -> Column:
    """Why an error occurs, by the first known name in its message."""
    out = None
    for name, reason in ERRORS:
        test = F.contains(or_empty(message), F.lit(name))
        out = F.when(test, reason) if out is None else out.when(test, reason)
    return out.otherwise("the code expects something else than it got")


def conversational(code: Name, key: Column, domain: Column) -> Column:
    """An answer in an engineer's voice; what varies is drawn from the record's key."""
    tip = None
    for name, tips in TIPS.items():
        tip = F.when(domain == name, _choice(tips, key, "tip")) if tip is None else tip.when(domain == name, _choice(tips, key, "tip"))
    told = F.when(pick(key, "explain", 10) <= 7, explanation(code)).otherwise("")
    hint = F.when((pick(key, "hint", 10) <= 5) & tip.isNotNull(), F.concat(F.lit("\n\n**Tip:** "), tip)).otherwise("")
    end = _choice(CLOSINGS, key, "closing")
    return F.concat(
        _choice(OPENERS, key, "opener"), _choice(INTRODUCTIONS, key, "intro"), F.lit(f"\n\n{FENCE}python\n"), or_empty(code), F.lit(f"\n{FENCE}"), told, hint, F.when(end != "", F.concat(F.lit("\n\n"), end)).otherwise("")
    )


def tutorial(task: Name, code: Name) -> Column:
    """An answer in steps."""
    return F.concat(F.lit("## "), or_empty(task), F.lit(f"\n\n### Step 1: the code\n\n{FENCE}python\n"), or_empty(code), F.lit(f"\n{FENCE}"), explanation(code), F.lit("\n\n### Step 2: try it\n\nRun it and compare the result with what you expect."))


def debugging(task: Name, error: Name, code: Name) -> Column:
    """An answer that explains an error before the fix."""
    return F.concat(F.lit("The error means that "), error_reason(error), F.lit(f".\n\n**Fix for:** "), or_empty(task), F.lit(f"\n\n{FENCE}python\n"), or_empty(code), F.lit(f"\n{FENCE}"))


def comparison(task: Name, good: Name, bad: Name) -> Column:
    """An answer that sets a good way against a bad one."""
    return F.concat(
        F.lit("**"), or_empty(task), F.lit(f"**\n\nAvoid:\n\n{FENCE}python\n"), or_empty(bad), F.lit(f"\n{FENCE}\n\nPrefer:\n\n{FENCE}python\n"), or_empty(good), F.lit(f"\n{FENCE}")
    )


STYLES = ("conversational", "tutorial", "quick_ref")


def styles(df: DataFrame, key: str = "key", domain: str = "python") -> DataFrame:
    """(key, style, instruction, input, output, domain): every sample in three styles."""
    k = df[key].cast("string")
    answers = F.array(
        F.struct(F.lit("conversational").alias("style"), conversational(df["output"], k, F.lit(domain)).alias("output")),
        F.struct(F.lit("tutorial").alias("style"), tutorial(df["instruction"], df["output"]).alias("output")),
        F.struct(F.lit("quick_ref").alias("style"), F.concat(F.lit(f"{FENCE}python\n"), or_empty(df["output"]), F.lit(f"\n{FENCE}")).alias("output")),
    )
    made = df.select(df[key].alias("key"), df["instruction"], F.explode(answers).alias("x")).select("key", "instruction", "x.style", "x.output")
    varied = vary_instruction("instruction", F.concat_ws(":", "key", "style"))
    return made.select("key", "style", varied.alias("instruction"), F.lit("").alias("input"), "output", F.lit(domain).alias("domain"))


def patterns(spark: SparkSession) -> DataFrame:
    """Preference patterns of this library: (prompt, chosen, rejected, category, severity, domain)."""
    return spark.createDataFrame(PATTERNS, "prompt string, chosen string, rejected string, category string, severity string, domain string")


def preference_pairs(df: DataFrame, key: str = "key", domain: str = "domain") -> DataFrame:
    """One pattern of its domain for every record that has one, drawn from the key."""
    spark = df.sparkSession
    known = patterns(spark).groupBy("domain").agg(F.sort_array(F.collect_list(F.struct("prompt", "chosen", "rejected", "category", "severity"))).alias("all"))
    joined = df.select(df[key].alias("key"), df[domain].alias("domain"), df["instruction"]).join(broadcast_small(known), "domain")
    digest = F.conv(F.substring(F.md5(F.concat(F.lit("pattern"), F.col("key").cast("string")).cast("binary")), 1, 8), 16, 10).cast("bigint")
    chosen = F.get(F.col("all"), F.pmod(digest, F.size("all")).cast("int"))
    return joined.select("key", "domain", F.col("instruction").alias("prompt"), chosen["chosen"].alias("chosen"), chosen["rejected"].alias("rejected"), chosen["category"].alias("category"), chosen["severity"].alias("severity"))


REPLY = "array<struct<instruction:string,input:string,output:string>>"


def reply_samples(reply: Name) -> Column:
    """The samples of a model's reply: the JSON list in it, fenced or amid prose; else an empty list."""
    text = strip(or_empty(reply))
    bare = strip(F.regexp_replace(F.regexp_replace(text, rf"^{FENCE}(?:json)?\n?", ""), rf"\n?{FENCE}$", ""))
    text = F.when(text.startswith(FENCE), bare).otherwise(text)
    found = F.regexp_extract(text, r"(\[[\s\S]*\])", 1)
    parsed = F.from_json(found, REPLY, {"mode": "PERMISSIVE"})
    return F.coalesce(parsed, F.array().cast(REPLY))


Provider = Callable[[pd.Series], pd.Series]


def with_failover(providers: Sequence[Provider]) -> Callable[[Column], Column]:
    """A column function that asks providers in order, a batch at a time; the first that doesn't raise answers.

    The last error is raised where all fail. Without any, ValueError.
    """
    if not providers:
        raise ValueError("no provider")

    @F.pandas_udf(StringType())
    def ask(prompt: pd.Series) -> pd.Series:
        error: Exception | None = None
        for provider in providers:
            try:
                return provider(prompt)
            except Exception as raised:  # noqa: BLE001
                error = raised
        raise error

    return ask


def stub_provider(prompt: pd.Series) -> pd.Series:
    """A deterministic stand-in for a model: one sample that asks for the prompt's first line and quotes it whole."""
    import json

    def reply(text: str | None) -> str:
        first = next((x.strip() for x in (text or "").splitlines() if x.strip()), "")
        return json.dumps([{"instruction": f"What does this say: {first}", "input": "", "output": (text or "").strip()}])

    return prompt.map(reply)


def with_context(df: DataFrame, found: DataFrame, query: str, most: int = 3) -> DataFrame:
    """``df`` with ``context``: the abstract and up to ``most`` related texts found for a query, a line each.

    ``found`` has (query, abstract, related array<string>), one row a query; where nothing was found
    for it, or only empty texts, the context is null.
    """
    lines = F.concat(F.array("abstract"), F.slice(F.coalesce("related", F.array().cast("array<string>")), 1, most))
    text = F.nullif(F.array_join(F.filter(lines, lambda x: x.isNotNull() & (x != "")), "\n"), F.lit(""))
    return df.join(found.select(F.col("query").alias("_query"), text.alias("context")), df[query] == F.col("_query"), "left").drop("_query")


#: Questions and answers of the library's own, by domain.
TEMPLATES = (
    ("containers", "How do I keep a container image small?", "Build in one stage and copy only the result into a second, slim one. Put the steps that change least first, so that their layers are reused, and delete package caches in the step that fills them."),
    ("containers", "Why does my container stop at once?", "A container lives as long as its first process. If that goes to the background or ends with an error, the container ends too: start the program in the foreground and read its log for the exit code."),
    ("clusters", "How do I roll back a bad rollout?", "Look at the history of the deployment, pick the last revision that worked and undo to it. The old pods come up before the new ones are removed, provided that readiness checks are set."),
    ("infrastructure", "Where should the state of an infrastructure tool live?", "In a remote store with locking and versions, never in the repository. Everyone then plans against the same state, two runs can not write at once, and a broken state can be restored."),
    ("pipelines", "How do I make a slow pipeline faster?", "Measure the stages first. Cache dependencies by the digest of their lock file, run independent jobs side by side, and stop early on the checks that fail most often."),
)


def template_pairs(spark: SparkSession, score: int = 100) -> DataFrame:
    """(instruction, input, output, source, source_type, score, tags) of the library's templates."""
    rows = [(question, "", answer, f"template:{domain}:{n}", "template", score, [domain]) for n, (domain, question, answer) in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "instruction string, input string, output string, source string, source_type string, score int, tags array<string>")


def supervision(chunks: DataFrame, prompt: Column, ask: Callable[[Column], Column]) -> DataFrame:
    """Samples of all chunks (doc_id, chunk_id, url, text), with where they come from.

    Replies without an instruction or an output are left out; a missing input is empty.
    """
    asked = chunks.select("doc_id", "chunk_id", "url", ask(prompt).alias("reply"))
    rows = asked.select("doc_id", "chunk_id", "url", F.explode(reply_samples("reply")).alias("x"))
    rows = rows.where(F.col("x.instruction").isNotNull() & F.col("x.output").isNotNull())
    origin = F.struct("doc_id", "chunk_id", F.col("url").alias("source_url"))
    return rows.select("x.instruction", or_empty("x.input").alias("input"), "x.output", origin.alias("_meta"))


def with_columns(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "col")]
