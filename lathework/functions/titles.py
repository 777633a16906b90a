"""Instructions made from titles, file names and documentation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lathework.functions.keys import pick
from lathework.functions.text import WS, Name, col, or_empty, strip

# Beginnings of questions, of how-to titles, and prefixes that a variation drops.
STARTERS = ("How do I ", "How to ", "What is ", "Why does ", "Can I ", "Should I ", "Is it possible to ")
HOW_TITLES = ("how to", "how do", "getting started", "tutorial", "guide")
PREFIXES = ("write python code that ", "create a python function called ", "show me how to ", "how do i ", "write a python example for ")


def title_to_question(c: Name) -> Column:
    """A title as a question; one that ends with a question mark stays."""
    title = strip(c)
    asked = title.rlike("(?i)^(" + "|".join(STARTERS) + ")")
    return F.when(title.endswith("?"), title).when(asked, F.concat(title, F.lit("?"))).otherwise(F.concat(F.lit("How do I "), F.lower(title), F.lit("?")))


def title_to_explain(c: Name) -> Column:
    """A page title as a request, cut at its first hyphen, dash or bar."""
    title = F.regexp_replace(strip(c), rf"(?d){WS}*[-|—]{WS}*.*$", "")
    how = F.lower(title).rlike("|".join(HOW_TITLES))
    return (
        F.when(title == "", "Explain this concept").when(title.endswith("?"), title).when(how, F.concat(title, F.lit("?"))).otherwise(F.concat(F.lit("Explain "), F.lower(title)))
    )


def _some(*options: Column) -> Column:
    return F.filter(F.array(*options), lambda x: x.isNotNull())


def _say(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def stem(name: Name) -> Column:
    """A file name without folder and last ending, its joints as spaces."""
    base = F.regexp_extract(or_empty(name), r"([^/]*)$", 1)
    return F.translate(F.regexp_replace(base, r"(?<=.)\.[^.]*$", ""), "_-", "  ")


# Fixed values, down to the end of the module: the phrasings of instructions.


def python_instructions(filename: Name, doc: Name, context: Name | None = None, most: int = 3) -> Column:
    """Up to ``most`` instructions for a Python file or function."""
    base = stem(filename)
    first = F.when(or_empty(doc) != "", F.lower(strip(F.split(or_empty(doc), "\n")[0])))
    told = F.when(or_empty(context) != "", or_empty(context)) if context is not None else F.lit(None).cast("string")
    options = _some(
        _say("Write Python code that ", first), _say("Show me how to ", first), _say("Create a Python script to ", first), _say("Write a Python example for ", base), _say("Show me Python code for ", base),
        _say("Write Python code for ", told),
    )
    return F.slice(options, 1, most)


def cluster_instructions(filename: Name, doc: Name) -> Column:
    """Up to five instructions for an example of a cluster client."""
    base = stem(filename)
    whole = F.when(or_empty(doc) != "", F.lower(strip(F.regexp_replace(or_empty(doc), "\n", " "))))
    return _some(
        _say("Write Python code that ", whole), _say("Show me how to ", whole, " using the Kubernetes Python client"), _say("Create a Python script to ", whole),
        _say("Write a Python example for Kubernetes ", base), _say("Show me Python code for ", base, " in Kubernetes"),
    )


def function_instructions(name: Name, doc: Name) -> Column:
    """Up to three instructions for a function of a cluster client."""
    clean = F.regexp_replace(or_empty(name), "_", " ")
    told = F.when(or_empty(doc) != "", F.lower(or_empty(doc)))
    return _some(
        _say("Write a Python function to ", told), _say("Create a Python function called ", or_empty(name), " for Kubernetes"), _say("Show me how to implement ", clean, " in Python for Kubernetes")
    )


def _one_line(c: Name) -> Column:
    return strip(F.regexp_replace(strip(or_empty(c)), f"{WS}+", " "))


def test_instructions(context: Name, title: Name) -> Column:
    """Two instructions for an example of tests."""
    told = F.when(_one_line(context) != "", F.lower(_one_line(context)))
    named = F.when(or_empty(title) != "", F.regexp_replace(F.lower(or_empty(title)), "_", " "))
    options = _some(
        _say("Write pytest code to ", told), _say("Show me how to ", told, " in pytest"), _say("Give me an example of ", named, " with pytest"), F.lit("Write a pytest test example"), F.lit("Show me pytest best practices")
    )
    return F.slice(options, 1, 2)


def rst_instructions(context: Name, title: Name) -> Column:
    """Up to two instructions for a block of a reStructuredText file."""
    told = F.when(_one_line(context) != "", F.lower(_one_line(context)))
    named = F.when(or_empty(title) != "", F.lower(or_empty(title)))
    return F.slice(_some(_say("Write code to ", told), _say("Show me how to ", told), _say("Give me an example of ", named)), 1, 2)


def markdown_instruction(context: Name, filename: Name) -> Column:
    """The instruction for a block of a Markdown file."""
    told = strip(F.regexp_replace(or_empty(context), "[#*`]", ""))
    base = F.regexp_replace(F.regexp_extract(or_empty(filename), r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    return F.when(told != "", _say("Write Python code that ", F.lower(told))).otherwise(_say("Show me this Python example: ", base))


def vary_instruction(instruction: Name, key: Name, seed: str = "vary") -> Column:
    """One of five phrasings of a task, drawn from the record's key."""
    task = F.regexp_replace(F.lower(or_empty(instruction)), "^(" + "|".join(PREFIXES) + ")", "")
    phrasings = F.array(_say("How do I ", task, "?"), _say("What's the best way to ", task, "?"), _say("Can you show me how to ", task, "?"), _say("I need to ", task), _say("Help me ", task))
    return F.element_at(phrasings, pick(key, seed, 5))


def chunk_prompt(template: str, chunk: Name) -> Column:
    """A template with its ``{chunk}`` filled."""
    before, _, after = template.partition("{chunk}")
    return _say(before, or_empty(chunk), after)


def web_prompt(question: Name, context: Name) -> Column:
    """A question with what was found on the web before it, where anything was."""
    found = or_empty(context)
    return F.when(found == "", or_empty(question)).otherwise(_say("Based on this information:\n\n", found, "\n\nAnswer the question: ", or_empty(question)))


def alpaca_prompt(instruction: Name, extra: Name, output: Name, end: str = "") -> Column:
    """The training text of a sample, with its input where there is one."""
    head = _say("### Instruction:\n", or_empty(instruction), "\n\n")
    given = F.when(or_empty(extra) != "", _say("### Input:\n", or_empty(extra), "\n\n")).otherwise("")
    return _say(head, given, "### Response:\n", or_empty(output), end)


def model_family(c: Name) -> Column:
    """The family of a base model by its name."""
    low = F.lower(or_empty(c))
    has = lambda x: F.contains(low, F.lit(x))
    return (
        F.when(has("deepseek"), "deepseek").when(has("gemma"), "gemma").when(has("qwen"), "qwen").when(has("llama") | has("mistral"), "llama").otherwise("phi")
    )


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "col")]
