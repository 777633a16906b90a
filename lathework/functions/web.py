"""Urls and HTML as columns."""

from __future__ import annotations

import html as _html
import re
from html.parser import HTMLParser
from urllib.parse import urljoin as _urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lathework.functions.text import Name, col, strip

# Resources that are no pages, and languages with the patterns of their class names.
SKIPPED = ("pdf", "png", "jpg", "gif", "css", "js", "zip")
LANGUAGE_CLASSES = (
    ("python", "python|py"), ("javascript", "javascript|js"), ("typescript", "typescript|ts"), ("bash", "bash|shell|sh"), ("yaml", "yaml|yml"), ("json", "json"),
    ("go", r"\bgo\b|golang"), ("rust", "rust"), ("java", r"\bjava\b"), ("sql", r"\bsql\b"), ("hcl", r"\bhcl\b|terraform"),
)
DOMAIN_TAGS = (
    ("kubernetes", ("kubernetes", "k8s")), ("docker", ("docker",)), ("terraform", ("terraform", "hashicorp")), ("ansible", ("ansible",)), ("python", ("python",)), ("flask", ("flask",)), ("fastapi", ("fastapi",)),
)
KEYWORDS = ("kubernetes", "docker", "terraform", "ansible", "python", "flask", "fastapi", "aws", "gcp", "azure", "ci/cd", "devops", "api", "microservices")


def normalize_url(c: Name) -> Column:
    """Without fragment and without one slash at the end; the query stays as it is."""
    return F.regexp_replace(F.regexp_replace(col(c), "#.*$", ""), "/$", "")


def netloc(c: Name) -> Column:
    """Host with user and port, as it stands; empty where there is none."""
    return F.regexp_extract(col(c), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path_of(c: Name) -> Column:
    return F.regexp_extract(col(c), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def should_follow(url: Name, domain: Name, pattern: str | None = None) -> Column:
    """Same host, no skipped resource, and the pattern where one is given."""
    keep = (netloc(url) == col(domain)) & ~F.lower(path_of(url)).rlike(r"\.(" + "|".join(SKIPPED) + ")$")
    return keep & col(url).rlike(pattern) if pattern else keep


@F.pandas_udf(StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(_html.unescape, na_action="ignore")


def unescape(c: Name) -> Column:
    """Entities decoded, by the standard table; texts without an ampersand stay on the JVM's side as they are."""
    return F.when(F.contains(col(c), F.lit("&")), _unescape(F.when(F.contains(col(c), F.lit("&")), col(c)))).otherwise(col(c))


def urljoin(base: Name, link: Name) -> Column:
    """A link against the page it stands on; null where either is or where it can't be parsed.

    Whole urls and links from the root of a plain base need no resolving of dots and are made by
    built-ins; all other forms go to the standard parser.
    """
    a, b = col(base), col(link)
    plain = b.rlike(r"^/(?!/)[A-Za-z0-9_~/-]*$") & a.rlike(r"^https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s\[\]]*)?$") & ~F.contains(b, F.lit("//"))
    whole = b.rlike(r"^https?://[A-Za-z0-9.-]+(?::[0-9]+)?/[A-Za-z0-9_~/-]*$") & a.rlike(r"^https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s\[\]]*)?$") & ~F.substring(b, 9, 1 << 30).rlike("//")
    host = F.regexp_extract(a, r"^(https?://[^/?#]*)", 1)
    built = F.when(plain, F.concat(host, b)).when(whole, b)
    rest = built.isNull()
    return F.coalesce(built, _urljoin_udf(F.when(rest, a), F.when(rest, b)))


@F.pandas_udf(StringType())
def _urljoin_udf(base: pd.Series, link: pd.Series) -> pd.Series:

    def join(a, b):
        try:
            return _urljoin(a, b)
        except ValueError:
            return None

    return pd.Series([join(a, b) if isinstance(a, str) and isinstance(b, str) else None for a, b in zip(base, link)], dtype=object)


def html_title(c: Name) -> Column:
    """The first title's text, stripped; empty where there is none."""
    return strip(F.regexp_extract(col(c), r"(?is)<title[^>]*>(.*?)</title>", 1))


def clean_html(c: Name, decoded: bool = False) -> Column:
    """HTML of an answer as light Markdown.

    In this order: entities, code blocks, code, list items, paragraphs, breaks, links, headings, all
    other tags, blank lines. Entities come first, so an escaped tag is dropped like a real one.
    """
    text = col(c) if decoded else unescape(col(c))
    for pattern, new in (
        (r"(?s)<pre><code[^>]*>(.*?)</code></pre>", "```\n$1\n```"), (r"(?d)<code>(.*?)</code>", "`$1`"), (r"(?s)<li>(.*?)</li>", "- $1\n"), (r"</?[ou]l>", ""), (r"(?s)<p>(.*?)</p>", "$1\n\n"),
        (r"<br\s*/?>", "\n"), (r'(?d)<a href="([^"]*)"[^>]*>(.*?)</a>', "[$2]($1)"), (r"(?d)<h1>(.*?)</h1>", "# $1\n"), (r"(?d)<h2>(.*?)</h2>", "## $1\n"), (r"(?d)<h3>(.*?)</h3>", "### $1\n"),
        (r"<[^>]+>", ""), (r"\n{3,}", "\n\n"),
    ):
        text = F.regexp_replace(text, pattern, new)
    return F.coalesce(strip(text), F.lit(""))


def links_of(c: Name) -> Column:
    """Targets of all anchors of a page, distinct."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), 1))


def code_blocks_of(c: Name, more_than: int = 20) -> Column:
    """(classes, code) of the code elements of a page with over ``more_than`` characters, tags and common entities resolved."""
    pattern = r"(?is)<code\b([^>]*)>(.*?)</code>"
    text = F.coalesce(col(c), F.lit(""))
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("a"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("b"))

    def plain(x: Column) -> Column:
        x = F.regexp_replace(x, "<[^>]+>", "")
        for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
            x = F.replace(x, F.lit(entity), F.lit(sign))
        return x

    made = F.transform(pairs, lambda p: F.struct(F.regexp_extract(p["a"], r"""(?i)class\s*=\s*["']([^"']*)""", 1).alias("classes"), plain(p["b"]).alias("code")))
    return F.filter(made, lambda b: F.length(b["code"]) > more_than)


def detect_language(classes: Name, code: Name) -> Column:
    """The language of a code block by its class names, else by its content, else ``text``."""
    low, body = F.lower(F.coalesce(col(classes), F.lit(""))), F.coalesce(col(code), F.lit(""))
    out = None
    for name, pattern in LANGUAGE_CLASSES:
        test = low.rlike(pattern)
        out = F.when(test, name) if out is None else out.when(test, name)
    has = lambda *parts: body.rlike("|".join(parts))
    return (
        out.when(body.startswith("#!/") | body.startswith("$"), "bash")
        .when(has("def ", "import "), "python")
        .when(has("function ", "const ", "let "), "javascript")
        .when(strip(body).startswith("{") & strip(body).endswith("}"), "json")
        .otherwise("text")
    )


def tags_of(url: Name, content: Name, most: int = 5) -> Column:
    """The tag of the host and keywords of the content, at most ``most``, without repeats."""
    host, low = netloc(url), F.lower(F.coalesce(col(content), F.lit("")))
    first = None
    for tag, parts in DOMAIN_TAGS:
        test = F.coalesce(host.rlike("|".join(parts)), F.lit(False))
        first = F.when(test, tag) if first is None else first.when(test, tag)
    found = [F.when(F.contains(low, F.lit(k)), F.lit(k)) for k in KEYWORDS]
    return F.slice(F.array_distinct(F.filter(F.array(first, *found), lambda x: x.isNotNull())), 1, most)


# --- HTML to Markdown -------------------------------------------------------------------------

#: What Markdown leaves out, and what the cleaning of a page leaves out besides.
SCRIPTS = frozenset({"script", "style"})
FURNITURE = SCRIPTS | {"noscript", "template", "nav", "footer", "aside", "form", "iframe", "svg", "head"}
FURNITURE_CLASSES = frozenset({"ad", "ads", "advert", "advertisement", "sidebar", "menu", "breadcrumb"})
_BLOCKS = frozenset("p div section article main table tr ul ol blockquote header figure dl".split())
#: A dropped element that is never closed ends where one of these begins.
_NEXT = _BLOCKS | {"body", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "hr"}
_IN_HEAD = frozenset("title meta link base script style noscript template".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SPACES = re.compile(r"\s+")


class _Markdown(HTMLParser):
    """Writes Markdown; ``unclosed`` has the ordinals of start tags that no end tag closes."""

    def __init__(self, dropped: frozenset, classes: frozenset, unclosed: frozenset) -> None:
        super().__init__(convert_charrefs=True)
        self.dropped, self.classes, self.unclosed = dropped, classes, unclosed
        self.out: list[str] = []
        self.ordinal = 0
        self.inside = ""  # the dropped element that is open, its start tag's ordinal and its depth
        self.began = self.depth = 0
        self.pre = 0
        self.link: list[str] = []

    def _drops(self, tag, attrs) -> bool:
        if tag in self.dropped:
            return True
        return bool(self.classes) and tag not in _VOID and not self.classes.isdisjoint((dict(attrs).get("class") or "").lower().split())

    def handle_starttag(self, tag, attrs):
        self.ordinal += 1
        if self.inside:
            ends = self.inside == "head" and tag not in _IN_HEAD or self.began in self.unclosed and tag in _NEXT
            if not ends:
                self.depth += tag == self.inside
                return
            self.inside = ""
        if self._drops(tag, attrs):
            self.inside, self.began, self.depth = tag, self.ordinal, 1
            return
        given = dict(attrs)
        if len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "pre":
            self.pre += 1
            self.out.append("\n\n```\n")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "br":
            self.out.append("\n")
        elif tag == "li":
            self.out.append("\n* ")
        elif tag == "a":
            self.link.append(given.get("href") or "")
            self.out.append("[")
        elif tag in _BLOCKS:
            self.out.append("\n\n")

    def handle_startendtag(self, tag, attrs):
        if tag in _VOID or not self._drops(tag, attrs):
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.inside:
            self.depth -= tag == self.inside
            if not self.depth:
                self.inside = ""
            return
        if tag == "pre" and self.pre:
            self.pre -= 1
            self.out.append("\n```\n\n")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "a" and self.link:
            self.out.append(f"]({self.link.pop()})")
        elif tag in _BLOCKS or len(tag) == 2 and tag[0] == "h":
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.inside:
            self.out.append(data if self.pre else _SPACES.sub(" ", data))


def plain_markdown_of(page: str | None, dropped: frozenset = SCRIPTS, classes: frozenset = frozenset()) -> str:
    """A page as Markdown without the elements ``dropped`` and those of ``classes``.

    Broken markup is read as far as it goes; a dropped element that is never closed ends at the
    next block, a head at the first element that can't be in one.
    """
    if not page:
        return ""
    unclosed: frozenset = frozenset()
    while True:
        parser = _Markdown(dropped, classes, unclosed)
        try:
            parser.feed(page)
            parser.close()
        except (AssertionError, ValueError):
            pass
        if not parser.inside or parser.inside in SCRIPTS or parser.began in unclosed:
            break
        unclosed |= {parser.began}
    lines = [line.strip() if not line.startswith("    ") else line.rstrip() for line in "".join(parser.out).split("\n")]
    kept: list[str] = []
    for line in lines:
        if line.strip() or kept and kept[-1].strip():
            kept.append(line)
    return "\n".join(kept).strip()


def markdown_of(page: str | None) -> str:
    """A page as Markdown without scripts, styles, navigation, forms, footers and advertisements."""
    return plain_markdown_of(page, FURNITURE, FURNITURE_CLASSES)


# Where pages keep their content, in the order of trust, as tags or marks in a start tag.
_CONTENT = [
    re.compile(rf"(?is)<({tag})\b{mark}[^>]*>")
    for tag, mark in (
        ("article", ""), ("main", ""), (r"\w+", r"""(?=[^>]*\bclass\s*=\s*["'][^"']*(?<![\w-])(?:content|documentation|doc-content)(?![\w-]))"""),
        (r"\w+", r"""(?=[^>]*\bid\s*=\s*["']content["'])"""), (r"\w+", r"""(?=[^>]*\brole\s*=\s*["']main["'])"""),
    )
]


def _element(page: str, start: re.Match) -> str:
    """What is inside the element of a start tag, up to the end tag of its depth or the end of the page."""
    tag, depth = start[1], 1
    for m in re.compile(rf"(?is)<(/?){re.escape(tag)}\b[^>]*>").finditer(page, start.end()):
        depth += -1 if m[1] else 1
        if not depth:
            return page[start.end() : m.start()]
    return page[start.end() :]


def content_of(page: str | None, least: int = 100) -> str:
    """The main content of a page as Markdown: the first trusted element with over ``least`` characters, else the whole page."""
    for pattern in _CONTENT:
        m = pattern.search(page or "")
        if m and len(text := markdown_of(_element(page, m))) > least:
            return text
    return markdown_of(page)


def selected_of(page: str | None, least: int = 100, most: int = 5000) -> str:
    """As :func:`content_of`; where no element is trusted, the first ``most`` characters of the page."""
    for pattern in _CONTENT:
        m = pattern.search(page or "")
        if m and len(text := markdown_of(_element(page, m))) > least:
            return text
    return markdown_of(page)[:most]


@F.pandas_udf(StringType())
def main_content(page: pd.Series) -> pd.Series:
    return page.map(content_of)


@F.pandas_udf(StringType())
def content_select(page: pd.Series) -> pd.Series:
    return page.map(selected_of)


@F.pandas_udf(StringType())
def html_to_markdown(page: pd.Series) -> pd.Series:
    return page.map(plain_markdown_of)


@F.pandas_udf(StringType())
def cleaned_markdown(page: pd.Series) -> pd.Series:
    return page.map(markdown_of)
