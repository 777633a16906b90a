"""Problem 3: functions paired with their documentation."""

from __future__ import annotations

import ast
import inspect
import re
import warnings
from bisect import bisect_right
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.batches import map_columns
from lathework.session import cut_lineage

MIN_WORDS = 5


@dataclass(slots=True)
class Function:
    """A function or method with what its language holds as its documentation."""

    name: str
    line: int
    start: int
    end: int
    doc: str | None
    owner: str = ""


@dataclass(slots=True)
class Source:
    """The functions of a file, its classes, and their bases with the module each is taken from, if one."""

    functions: list[Function] = field(default_factory=list)
    classes: list[str] = field(default_factory=list)
    bases: list[tuple[str, str, str]] = field(default_factory=list)


class Lines:
    """Numbers of lines, which end at a line feed, by offset."""

    def __init__(self, text: str) -> None:
        self.starts = [0, *(m.end() for m in re.finditer("\n", text))]

    def number(self, at: int) -> int:
        return bisect_right(self.starts, at)


# --- Python -----------------------------------------------------------------------------------


def python_source(text: str) -> Source:
    """Functions of a Python file; none if it isn't valid Python 3."""
    out = Source()
    text = text.removeprefix("﻿")
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(text)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return out
    # The parser also ends lines at lone carriage returns (and takes form feeds for blanks).
    begins = [0, *(m.end() for m in re.finditer(r"\r\n|\r|\n", text))]
    lines = Lines(text)
    imported: dict[str, tuple[str, str]] = {}
    walk: list[tuple[ast.AST, str]] = [(tree, "")]
    while walk:
        node, owner = walk.pop()
        for child in ast.iter_child_nodes(node):
            inside = owner
            if isinstance(child, ast.ClassDef):
                inside = child.name
                out.classes.append(child.name)
                out.bases += [(child.name, *base) for b in child.bases if (base := _python_base(b))]
            elif isinstance(child, ast.ImportFrom):
                imported.update({a.asname or a.name: ((child.module or "").rpartition(".")[2] or a.name, a.name) for a in child.names})
            elif isinstance(child, ast.Import):
                imported.update({a.asname or a.name.partition(".")[0]: (a.name.rpartition(".")[2], "") for a in child.names})
            elif isinstance(child, (ast.FunctionDef, ast.AsyncFunctionDef)):
                doc = ast.get_docstring(child, clean=False)
                start, end = begins[child.lineno - 1], begins[child.end_lineno] if child.end_lineno < len(begins) else len(text)
                line = lines.number(start)
                method = owner if isinstance(node, ast.ClassDef) else ""
                out.functions.append(Function(child.name, line, start, end, inspect.cleandoc(doc) if doc is not None else None, method))
                inside = ""
            walk.append((child, inside))
    out.bases = [(name, *_imported(base, module, imported)) for name, base, module in out.bases]
    return out


def _python_base(node: ast.AST) -> tuple[str, str] | None:
    """The name of a base class and what stands before its dot."""
    if isinstance(node, ast.Subscript):
        node = node.value
    if isinstance(node, ast.Name):
        return node.id, ""
    if isinstance(node, ast.Attribute):
        return node.attr, ast.unparse(node.value)
    return None


def _imported(base: str, module: str, imported: dict[str, tuple[str, str]]) -> tuple[str, str]:
    """A base by its own name, with the last part of the module it is imported from."""
    if module:
        known = imported.get(module)
        return base, (known[1] or known[0]) if known else module.rpartition(".")[2]
    if base in imported:
        of, name = imported[base]
        return name or base, of
    return base, ""


# --- JavaScript -------------------------------------------------------------------------------

_JS_TOKEN = re.compile(
    r"""(?P<space>[\s﻿]+)
      | (?P<block>/\*[\s\S]*?(?:\*/|\Z))
      | (?P<line>//[^\n]*|\#![^\n]*)
      | (?P<string>"(?:[^"\\\n]|\\[\s\S])*"?|'(?:[^'\\\n]|\\[\s\S])*'?)
      | (?P<name>\#?[^\W\d][\w$]*|\#?\$[\w$]*|\#?_[\w$]*)
      | (?P<number>\d[\w.]*)
      | (?P<mark>=>|\.\.\.|[\s\S])
    """,
    re.VERBOSE,
)
_JS_REGEX = re.compile(r"/(?:[^/\\\[\n]|\\.|\[(?:[^\]\\\n]|\\.)*\])+/\w*")
#: Words and marks after which a slash begins a regular expression.
_BEFORE_REGEX = frozenset("( , = : [ ! & | ? { } ; + - * % < > ~ ^ => ... return typeof case in of delete void throw new do else instanceof yield await".split())
_NOT_METHODS = frozenset("if for while switch catch with return function super await typeof new do else try finally throw yield delete void in of case".split())
_MODIFIERS = frozenset("static async get set public private protected readonly override abstract *".split())


@dataclass(slots=True)
class Token:
    kind: str
    text: str
    at: int
    end: int


def _template_end(text: str, at: int) -> int:
    """The end of the template literal that begins at ``at``, with all that is nested in it."""
    at += 1
    n = len(text)
    stack = ["`"]
    while at < n and stack:
        c = text[at]
        if c == "\\":
            at += 2
            continue
        if stack[-1] == "`":
            if c == "`":
                stack.pop()
            elif c == "$" and text.startswith("${", at):
                stack.append("{")
                at += 1
        elif c == "`":
            stack.append("`")
        elif c == "{":
            stack.append("{")
        elif c == "}":
            stack.pop()
        elif c in "\"'":
            close = re.compile(rf"(?:[^{c}\\\n]|\\[\s\S])*{c}?").match(text, at + 1)
            at = close.end() - 1
        at += 1
    return at


def js_tokens(text: str) -> list[Token]:
    """All tokens but white space; comments are kept."""
    out: list[Token] = []
    before = ""
    at, n = 0, len(text)
    while at < n:
        c = text[at]
        if c == "`":
            end = _template_end(text, at)
            out.append(Token("string", "`", at, end))
            before, at = "`", end
            continue
        m = None
        if c == "/" and text[at + 1 : at + 2] not in ("/", "*") and (not before or before in _BEFORE_REGEX):
            m = _JS_REGEX.match(text, at)
            if m:
                out.append(Token("string", "/", at, m.end()))
                before, at = "/", m.end()
                continue
        m = _JS_TOKEN.match(text, at)
        kind = m.lastgroup
        if kind != "space":
            word = m[0]
            out.append(Token(kind, word, at, m.end()))
            if kind not in ("block", "line"):
                before = word if kind in ("name", "mark") else '"'
        at = m.end()
    return out


def _doc_above(text: str, tokens: list[Token], at: int) -> str | None:
    """The ``/** */`` block directly above the token at ``at``, without its frame."""
    if at == 0:
        return None
    block = tokens[at - 1]
    if block.kind != "block" or not block.text.startswith("/**") or len(block.text) < 5 or block.text.startswith("/***"):
        return None
    if text.count("\n", block.end, tokens[at].at) > 1:
        return None
    body = block.text[3:].removesuffix("*/")
    return "\n".join(re.sub(r"^[ \t]*\*(?!/) ?", "", line.rstrip("\r")) for line in body.split("\n")).strip()


_JS_IMPORT = re.compile(
    r"""\bimport\s+(?P<one>[\w$]+)?\s*,?\s*(?:\{(?P<many>[^{}]*)\}|\*\s*as\s+(?P<all>[\w$]+))?\s*from\s*["'](?P<from>[^"'\n]+)["']
      | \b(?:const|let|var)\s+(?:(?P<own>[\w$]+)|\{(?P<parts>[^{}]*)\})\s*=\s*require\(\s*["'](?P<of>[^"'\n]+)["']\s*\)""",
    re.VERBOSE,
)


def _js_imports(text: str) -> dict[str, tuple[str, str]]:
    out: dict[str, tuple[str, str]] = {}
    for m in _JS_IMPORT.finditer(text):
        module = re.sub(r"(?:/index)?(?:\.\w+)?$", "", m["from"] or m["of"]).rpartition("/")[2]
        for name in (m["one"], m["all"], m["own"]):
            if name:
                out[name] = (module, "")
        for part in (m["many"] or m["parts"] or "").split(","):
            given, _, alias = (x.strip() for x in re.sub(r"\s+as\s+|:", "=", part).partition("="))
            if given:
                out[alias or given] = (module, given)
    return out


def js_source(text: str) -> Source:
    """Named functions, methods and arrow functions of a JavaScript file."""
    out = Source()
    imported = _js_imports(text) if "extends" in text else {}
    everything = js_tokens(text)
    real = [i for i, t in enumerate(everything) if t.kind not in ("block", "line")]
    tokens = [everything[i] for i in real]
    lines = Lines(text)
    n = len(tokens)
    closing = _closings(tokens)

    def word(i: int) -> str:
        return tokens[i].text if 0 <= i < n else ""

    def add(name_at: int, start_at: int, body_at: int, owner: str = "") -> None:
        token = tokens[name_at]
        end = closing.get(body_at)
        stop = tokens[end].end if end is not None else len(text)
        doc = _doc_above(text, everything, real[start_at])
        out.functions.append(Function(token.text, lines.number(token.at), tokens[start_at].at, stop, doc, owner))

    def function_value(i: int) -> int | None:
        """Where the body of the function that begins at ``i`` starts, if one does."""
        if word(i) == "async" and word(i + 1) in ("function", "(") or word(i) == "async" and word(i + 2) == "=>":
            i += 1
        if word(i) == "function":
            j = i + 1 + (word(i + 1) == "*")
            j += tokens[j].kind == "name" if j < n else 0
            if word(j) == "(" and j in closing:
                return closing[j] + 1
            return None
        if word(i) == "(" and i in closing and word(closing[i] + 1) == "=>":
            return closing[i] + 2
        if i < n and tokens[i].kind == "name" and word(i + 1) == "=>":
            return i + 2
        return None

    # What every open brace is: the body of a class (with its name), an object, or a block.
    frames: list[tuple[str, str]] = []
    class_at: dict[int, str] = {}
    for i in range(n):
        t = tokens[i]
        if t.text == "class" and t.kind == "name" and word(i - 1) != ".":
            name = word(i + 1) if i + 1 < n and tokens[i + 1].kind == "name" and word(i + 1) != "extends" else ""
            j = i + 1
            while j < n and word(j) != "{":
                if word(j) == "(" and j in closing:
                    j = closing[j]
                j += 1
            if j < n:
                class_at[j] = name or (word(i - 2) if word(i - 1) == "=" else "")
                out.classes.append(class_at[j])
                if word(j - 1) != "extends" and any(word(k) == "extends" for k in range(i + 1, j)):
                    out.bases.append((class_at[j], *_imported(word(j - 1), word(j - 3) if word(j - 2) == "." else "", imported)))
        if t.text == "{":
            before = word(i - 1)
            if i in class_at:
                frames.append(("class", class_at[i]))
            elif before in ("=", "(", ",", ":", "[", "return", "?", "...", "default"):
                frames.append(("object", ""))
            else:
                frames.append(("block", ""))
            continue
        if t.text == "}":
            if frames:
                frames.pop()
            continue
        kind, owner = frames[-1] if frames else ("block", "")
        if t.text == "function" and t.kind == "name" and word(i - 1) != ".":
            j = i + 1 + (word(i + 1) == "*")
            if j < n and tokens[j].kind == "name" and word(j + 1) == "(" and j + 1 in closing:
                start = i
                while word(start - 1) in ("async", "default", "export"):
                    start -= 1
                if word(start - 1) not in ("=", ":"):
                    add(j, start, closing[j + 1] + 1)
            continue
        if t.kind == "name" and word(i + 1) == "=" and word(i + 2) != "=":
            body = function_value(i + 2)
            if body is not None:
                start = i
                while word(start - 1) == "." or word(start - 1) in ("const", "let", "var", "export", "static", "default"):
                    start -= 2 if word(start - 1) == "." else 1
                add(i, start, body, owner if kind == "class" else "")
                continue
        if kind == "object" and t.kind in ("name", "string") and word(i + 1) == ":" and word(i - 1) in ("{", ","):
            body = function_value(i + 2)
            if body is not None and t.kind == "name":
                add(i, i, body)
                continue
        if kind in ("class", "object") and t.kind == "name" and word(i + 1) == "(" and i + 1 in closing:
            if t.text in _NOT_METHODS or word(closing[i + 1] + 1) != "{":
                continue
            start = i
            while word(start - 1) in _MODIFIERS:
                start -= 1
            if word(start - 1) in ("{", "}", ";", ",") or kind == "class" and _new_line(text, tokens, start):
                add(i, start, closing[i + 1] + 1, owner)
    return out


def _new_line(text: str, tokens: list[Token], at: int) -> bool:
    return at > 0 and "\n" in text[tokens[at - 1].end : tokens[at].at] and tokens[at - 1].text not in (".", "=", "+", "&", "|", "?", ":")


def _closings(tokens: list[Token]) -> dict[int, int]:
    """For every opening bracket the place of its closing one."""
    pairs = {"(": ")", "[": "]", "{": "}"}
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    for i, t in enumerate(tokens):
        if t.kind != "mark":
            continue
        if t.text in pairs:
            stack.append((pairs[t.text], i))
        elif t.text in ")]}" and stack and stack[-1][0] == t.text:
            out[stack.pop()[1]] = i
    return out


# --- Go ---------------------------------------------------------------------------------------

_GO_SKIP = re.compile(r"/\*[\s\S]*?(?:\*/|\Z)|//[^\n]*|`[^`]*(?:`|\Z)|\"(?:[^\"\\\n]|\\.)*\"?|'(?:[^'\\\n]|\\.)*'?")
_GO_FUNC = re.compile(r"^func[ \t]+(?:\((?P<on>[^()]*)\)[ \t]*)?(?P<name>[^\W\d]\w*)[ \t]*[\[(]", re.M)
_GO_EMBED = re.compile(r"^type[ \t]+(\w+)[ \t]+struct[ \t]*\{([^}]*)\}", re.M)
_NOT_NEWLINE = re.compile(r"[^\n]")


def go_source(text: str) -> Source:
    """Functions and methods of a Go file."""
    out = Source()
    lines = Lines(text)
    comments: dict[int, tuple[int, str]] = {}  # by its last line: its first line and its text
    parts, last = [], 0
    for m in _GO_SKIP.finditer(text):
        parts += [text[last : m.start()], _NOT_NEWLINE.sub(" ", m[0])]
        last = m.end()
        if m[0].startswith(("//", "/*")):
            line_start = text.rfind("\n", 0, m.start()) + 1
            if not text[line_start : m.start()].strip():
                comments[lines.number(m.end() - 1)] = (lines.number(m.start()), m[0])
    code = "".join([*parts, text[last:]])
    for m in _GO_EMBED.finditer(code):
        out.classes.append(m[1])
        out.bases += [(m[1], base, package) for package, base in re.findall(r"^\s*\*?(?:(\w+)\.)?(\w+)\s*$", m[2], re.M)]
    found = list(_GO_FUNC.finditer(code))
    for m in found:
        line = lines.number(m.start())
        texts, above = [], line - 1
        while above in comments:
            first, comment = comments[above]
            if comment.startswith("/*"):
                body = comment[2:].removesuffix("*/")
                texts.append("\n".join(re.sub(r"^[ \t]*\* ?", "", x.rstrip("\r")) for x in body.split("\n")).strip("\n"))
            elif not comment.startswith("//go:"):
                texts.append(comment[2:].removeprefix(" ").rstrip("\r"))
            else:
                texts.append(None)
            above = first - 1
        kept = [t for t in reversed(texts) if t is not None]
        end = code.find("\n}", m.end())
        owner = re.sub(r"\[.*", "", (m["on"] or "").split("*")[-1].split(" ")[-1])
        out.functions.append(
            Function(m["name"], lines.number(m.start("name")), m.start(), end + 2 if end >= 0 else len(text), "\n".join(kept) if kept else None, owner)
        )
    return out


LANGUAGES: dict[str, Callable[[str], Source]] = {
    "py": python_source, "pyi": python_source, "js": js_source, "mjs": js_source, "cjs": js_source, "jsx": js_source, "go": go_source,
}

# --- What documentation says --------------------------------------------------------------------

# Names of the sections about parameters, results and examples, and stand-ins.
SECTIONS = "args arguments parameters params param keyword arguments keyword args other parameters returns return yields yield example examples usage"
_SECTION = re.compile(
    r"^(?P<in>[ \t]*)(?:#+ |\*\*|:)?(?:args|arguments|parameters|params|keyword arg(?:ument)?s|other parameters|returns?|yields?|examples?|usage)"
    r"(?:\*\*)?[ \t]*:?:?(?:\*\*)?[ \t]*(?P<rest>[^\n]*)$",
    re.I,
)
_FIELD = re.compile(r"^[ \t]*[:@](?:param|parameter|arg|argument|key|keyword|kwarg|type|returns?|rtype|yields?|ytype|example|prop|property)\b", re.I)
_TAG = re.compile(r"^[ \t]*(?:@\w+|:\w[^:\n]*:)")
_UNDERLINE = re.compile(r"^[ \t]*[-=~^]{3,}[ \t]*$")
STAND_INS = frozenset(
    "todo|fixme|tbd|xxx|n/a|na|none|undocumented|docstring|description|see above|see below|see code|placeholder|no description|no docs|"
    "missing docstring|add description|add docs|document me|document this|to do|write me|fill in|stub|dummy|wip|temp|tmp|ditto|same as above|"
    "todo document|todo document this|todo add docstring|todo add documentation|not documented|no documentation|documentation missing|"
    "description goes here|add documentation here|short description here|no documentation available yet sorry".split("|")
)
_INHERIT = re.compile(r"\{@inheritdoc\}|@inheritdoc\b|:inheritdoc:|\binherit(?:ed)? doc(?:s|string|umentation)?\b", re.I)
_STAND_IN_START = re.compile(r"^(?:todo|fixme|tbd|xxx)\b", re.I)


def description(doc: str) -> str:
    """Documentation without its parameter, result and example sections."""
    kept: list[str] = []
    lines = doc.split("\n")
    at, n = 0, len(lines)
    while at < n:
        line = lines[at]
        if line.lstrip().startswith(">>>"):
            while at < n and lines[at].strip():
                at += 1
            continue
        if _FIELD.match(line):
            deep = len(line) - len(line.lstrip())
            at += 1
            jsdoc = line.lstrip().startswith("@")
            while at < n and not _TAG.match(lines[at]):
                inner = len(lines[at]) - len(lines[at].lstrip())
                if not jsdoc and lines[at].strip() and inner <= deep or not jsdoc and not lines[at].strip():
                    break
                at += 1
            continue
        m = _SECTION.match(line)
        underlined = at + 1 < n and bool(_UNDERLINE.match(lines[at + 1]))
        if m and (not m["rest"] or ":" in line[: len(line) - len(m["rest"])]) or m and underlined:
            deep = len(m["in"])
            at += 1 + underlined
            while at < n:
                body = lines[at]
                inner = len(body) - len(body.lstrip())
                if underlined:
                    if at + 1 < n and _UNDERLINE.match(lines[at + 1]):
                        break
                elif body.strip() and inner <= deep:
                    break
                at += 1
            continue
        kept.append(line)
        at += 1
    return "\n".join(kept).strip()


_WORDS = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def words_beyond(text: str, name: str) -> int:
    """Words of a description beyond the function's name, written whole or in its parts."""
    whole = name.strip("_#$").lower()
    parts = {p.lower() for p in _NAME_PARTS.findall(name)}
    parts |= {p for p in whole.split("_") if p}
    tokens = re.findall(r"\w+", text)
    count = 0
    for token in tokens:
        low = token.lower()
        if low.strip("_") == whole or low in parts:
            continue
        count += 1
    return count


def is_meaningful(doc: str | None, name: str, least: int = MIN_WORDS) -> bool:
    """Whether documentation says something of its own."""
    if not doc:
        return False
    text = description(doc)
    bare = " ".join(_WORDS.findall(text.lower()))
    if not bare or bare in STAND_INS or text.strip().lower() in STAND_INS:
        return False
    if _STAND_IN_START.match(text) and words_beyond(text, name) <= least + 3:
        return False
    return words_beyond(text, name) >= least


# --- Parsing a run ------------------------------------------------------------------------------


def waits(doc: str | None, name: str) -> bool:
    """Whether a method has no words of its own: no meaningful comment, or one that only says that it inherits."""
    if not is_meaningful(doc, name):
        return True
    return bool(_INHERIT.search(doc)) and len(_INHERIT.sub("", doc).split()) < MIN_WORDS


def parse_files(df: DataFrame, id_column: str, examples_column: str, source_column: str, with_code: bool) -> DataFrame:
    """One row a source file, with its functions, classes and bases, each file parsed once.

    Without ``with_code`` neither code nor the comments of plain functions are kept.
    """
    kind = df.schema[id_column].dataType.simpleString()
    if source_column not in df.columns:
        df = df.withColumn(source_column, F.lit(None).cast("string"))

    def make() -> Callable[..., tuple]:
        def work(keys: list, names: list, runs: list) -> tuple:
            rows = []
            for key, name, examples in zip(keys, names, runs):
                for number, example in enumerate(examples or []):
                    if not example or not example["output"] or not example["path"]:
                        continue
                    parse = LANGUAGES.get(example["path"].rpartition(".")[2].lower())
                    if not parse:
                        continue
                    text = example["output"]
                    source = parse(text)
                    functions = []
                    for f in sorted(source.functions, key=lambda f: f.start):
                        waiting = waits(f.doc, f.name)
                        if waiting and not f.owner:
                            continue
                        kept = not waiting and (with_code or f.owner)
                        functions.append(
                            {
                                "line_no": f.line, "func_name": f.name, "owner": f.owner, "waiting": waiting, "documentation": f.doc if kept else None,
                                "description": description(f.doc) if kept else None, "code": text[f.start : f.end] if with_code else None,
                            }
                        )
                    bases = [{"owner": a, "at": n, "base": b, "module": c} for n, (a, b, c) in enumerate(source.bases)]
                    rows.append((key, name if name is not None else f"#{key}", number, example["path"], functions, source.classes, bases))
            return tuple(map(list, zip(*rows))) if rows else ([],) * 7

        return work

    schema = (
        f"result_id {kind}, source string, example_no int, path string, "
        "functions array<struct<line_no:int,func_name:string,owner:string,waiting:boolean,documentation:string,description:string,code:string>>, "
        "classes array<string>, bases array<struct<owner:string,at:int,base:string,module:string>>"
    )
    return map_columns(df, [id_column, source_column, examples_column], make, schema)


# --- Inherited documentation ------------------------------------------------------------------

METHOD = ["source", "path", "owner", "func_name"]
#: Tables of the hierarchy of up to so many rows (counted first) are broadcast to joins.
BROADCAST_ROWS = 100_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def hierarchy(files: DataFrame) -> DataFrame:
    """(source, path, owner, at, to_path, to_owner): every class with the classes it is derived from.

    A base is a class of the same file, or else, where it is imported, one of a file or folder of the
    module's name, or else, where it is not, one of that name anywhere in the source; of several the
    one of the least path. Every join has one row a name on its right side, so names that many
    files share make no product.
    """
    classes = files.select("source", "path", F.explode("classes").alias("owner")).distinct()
    wanted = files.select("source", "path", F.explode("bases").alias("b")).select("source", "path", "b.*").where("base <> ''").distinct()
    stem = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    folders = F.transform(F.slice(F.split("path", "/"), 1, F.greatest(F.size(F.split("path", "/")) - 1, F.lit(0))), lambda x: F.struct(F.lit(1).alias("rank"), x.alias("module")))
    places = F.concat(F.array(F.struct(F.lit(0).alias("rank"), stem.alias("module"))), folders)
    by_module = classes.select("source", "path", "owner", F.explode(places).alias("m")).groupBy("source", F.col("m.module").alias("module"), F.col("owner").alias("base"))
    by_module = by_module.agg(F.min(F.struct("m.rank", "path"))["path"].alias("by_module"))
    anywhere = classes.groupBy("source", F.col("owner").alias("base")).agg(F.min("path").alias("anywhere"))
    same = classes.select("source", "path", F.col("owner").alias("base"), F.col("path").alias("same"))
    joined = wanted.join(same, ["source", "path", "base"], "left").join(by_module, ["source", "module", "base"], "left").join(anywhere, ["source", "base"], "left")
    to = F.when(F.col("module") == "", F.coalesce("same", "anywhere")).otherwise(F.col("by_module"))
    return joined.select("source", "path", "owner", "at", to.alias("to_path"), F.col("base").alias("to_owner")).where("to_path is not null")


def resolve_inherited(files: DataFrame) -> DataFrame:
    """(source, path, owner, func_name, documentation, description) of methods that get a base's documentation.

    Methods without words of their own are joined to the classes above theirs, one step up the
    hierarchy a round, until no class is left; the nearest documented method of the name wins, the
    first base of several. A class is passed once on a way up, so cycles end.
    """
    methods = files.select("result_id", "source", "path", "example_no", F.explode("functions").alias("f")).select("result_id", "source", "path", "example_no", "f.*").where("owner <> ''")
    edges = cut_lineage(hierarchy(files))
    waiting = methods.where("waiting").select(*METHOD).distinct()
    ways = waiting.join(edges.select("source", "path", "owner").distinct(), ["source", "path", "owner"], "left_semi")
    schema = "source string, path string, owner string, func_name string, documentation string, description string"
    if not ways.limit(1).count():
        return files.sparkSession.createDataFrame([], schema)
    known = methods.where(~F.col("waiting")).groupBy(*METHOD).agg(F.min_by(F.struct("documentation", "description"), F.struct("result_id", "example_no", "line_no")).alias("text"))
    known = cut_lineage(known.select("source", F.col("path").alias("to_path"), F.col("owner").alias("to_owner"), "func_name", "text"))
    known, steps = _small(known), _small(edges.select("source", F.col("path").alias("at_path"), F.col("owner").alias("at_owner"), "at", "to_path", "to_owner"))
    place = lambda path, owner: F.concat_ws("\n", path, owner)
    now = ways.select(*METHOD, F.col("path").alias("at_path"), F.col("owner").alias("at_owner"), F.array().cast("array<int>").alias("way"), F.array(place("path", "owner")).alias("seen"))
    out = None
    while True:
        up = now.join(steps, ["source", "at_path", "at_owner"]).where(~F.array_contains("seen", place(F.col("to_path"), F.col("to_owner"))))
        up = up.select(*METHOD, "to_path", "to_owner", F.concat("way", F.array("at")).alias("way"), F.concat("seen", F.array(place(F.col("to_path"), F.col("to_owner")))).alias("seen"))
        up = up.groupBy(*METHOD, "to_path", "to_owner").agg(F.min(F.struct("way", "seen")).alias("w")).select(*METHOD, "to_path", "to_owner", "w.*")
        up = cut_lineage(up.join(known, ["source", "to_path", "to_owner", "func_name"], "left"))
        found = up.where("text is not null").groupBy(*METHOD).agg(F.min_by("text", "way").alias("text")).select(*METHOD, "text.*")
        out = found if out is None else out.unionByName(found)
        now = up.where("text is null").join(found.select(*METHOD), METHOD, "left_anti")
        now = now.select(*METHOD, F.col("to_path").alias("at_path"), F.col("to_owner").alias("at_owner"), "way", "seen")
        if not now.limit(1).count():
            return cut_lineage(out)


def find_documented(df: DataFrame, id_column: str = "result_id", examples_column: str = "examples", source_column: str = "source_name", with_code: bool = True) -> DataFrame:
    """Code and description of every function with a meaningful documentation comment.

    Columns: ``result_id``, ``example_no`` (from 0), ``path``, ``line_no`` (from 1, where the name
    stands), ``func_name``, ``inherited`` (the text comes from an overridden method), ``description``
    (without parameter, result and example sections), ``documentation`` (whole), ``code``; without
    ``with_code`` the last three aren't filled.

    Files are Python (parsed by the standard parser; invalid files give nothing), JavaScript and Go
    (tokenised, so text in strings and comments is no code); others give none. Documentation is
    dropped if it is blank, a stand-in or has under five words beyond the function's name. A method
    without such documentation, or whose comment only says that it inherits, gets that of the
    nearest documented method it overrides: classes of all files and runs of one source are joined
    to their bases (see :func:`hierarchy`) until nothing changes; what stays unresolved is dropped.
    Null and empty ``examples``, null structs, outputs and paths give no rows; a null source (or
    no such column) makes every run one of its own; repeated runs come out repeated; empty tables give none; other columns are not read.
    """
    files = cut_lineage(parse_files(df, id_column, examples_column, source_column, with_code))
    functions = files.select("result_id", "source", "path", "example_no", F.explode("functions").alias("f")).select("result_id", "source", "path", "example_no", "f.*")
    resolved = resolve_inherited(files).select(*METHOD, F.struct("documentation", "description").alias("above"))
    joined = functions.join(_small(resolved), METHOD, "left").where(~F.col("waiting") | F.col("above").isNotNull())
    pick = lambda name: F.when(F.col("waiting"), F.col("above")[name]).otherwise(F.col(name)).alias(name) if with_code else F.lit(None).cast("string").alias(name)
    return joined.select("result_id", "example_no", "path", "line_no", "func_name", F.col("waiting").alias("inherited"), pick("description"), pick("documentation"), "code")
