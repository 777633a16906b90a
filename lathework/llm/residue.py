"""Problem 9: template residue, filler, error pages and demands for scripts in place of content."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from lathework.functions.batches import map_columns
from lathework.llm.residue_seeds import FILLER, MARKS, NOTATIONS, NOTICES, PROSE, SLOT_FRAMES, SLOT_NAMES

GRAM = 4
BITS = 18
SMOOTH = 0.02
#: Windows of at most this many characters; a line is one window or several.
WINDOW = 160
#: Mean log-likelihood ratio per gram from which a window counts as residue.
THRESHOLD = 0.35
#: Share of the content's characters that must be residue for a document to be excluded.
COVERAGE = 0.5
#: Longest line that can be page furniture.
FURNITURE_MOST = 120

_K = np.uint32(2654435761)


def _grams(codes: np.ndarray) -> np.ndarray:
    """Table places of all character n-grams of a text given as code points."""
    n = len(codes) - GRAM + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint32)
    total = np.zeros(n, dtype=np.uint32)
    with np.errstate(over="ignore"):
        for i in range(GRAM):
            total = (total ^ codes[i : i + n]) * _K
            total ^= total >> np.uint32(15)
    return total >> np.uint32(32 - BITS)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


_NOT_LETTER = re.compile(r"[\W\d_]+")


def _plain(text: str) -> str:
    """Letters in lower case with single spaces; a space at both ends."""
    return " " + _NOT_LETTER.sub(" ", text.lower()).strip() + " "


def _model(text: str) -> np.ndarray:
    """Smoothed log-probabilities of a character n-gram model, one per hashed place."""
    counts = np.zeros(1 << BITS, dtype=np.float64)
    for line in text.strip().splitlines():
        np.add.at(counts, _grams(_codes(_plain(_CODE.sub(_code_word, line)))), 1.0)
    return np.log(counts + SMOOTH) - np.log(counts.sum() + SMOOTH * len(counts))


@lru_cache(maxsize=1)
def models() -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood ratios of notices and of filler against natural prose."""
    prose = _model(PROSE)
    return tuple(
        np.clip(np.where(own == own.min(), np.minimum(0.0, own - prose), own - prose), -3.0, 3.0).astype(np.float32)
        for own in (_model(NOTICES), _model(FILLER))
    )


# Slot notations of common template languages. A slot holds a name, not prose.
SLOTS = re.compile(
    r"""\{\{[^{}\n]+\}\}          # {{ name }}
      | \[\[[^\[\]\n]+\]\]        # [[ name ]]
      | <%[^%\n]+%>               # <%= name %>
      | \{%[^%\n]+%\}             # {% name %}
      | @@\w+@@                   # @@name@@
      | \$\{[^{}\n]+\}            # ${name}
      | \#\{[^{}\n]+\}            # #{name}
      | %%[A-Za-z_]\w{1,40}%%          # %%name%%
      | (?<![\w%])%[A-Z][A-Z_]{2,40}%(?!\w)         # %NAME%
      | (?<!\w)__[A-Z][A-Z0-9_]{1,40}__(?!\w)       # __NAME__
      | (?<![A-Za-z])XXX[A-Z_]{2,40}XXX(?![A-Za-z]) # XXXNAMEXXX
      | \[(?:INSERT|Insert|insert|YOUR|Your|your|ADD|Add|ENTER|Enter|REPLACE|Replace)\ [^\[\]\n]+\](?!\()
      | (?<![\]\w!])\[[A-Z][A-Z0-9_]*(?:[ _-][A-Z0-9_]+){0,4}\](?![(\[:\w])  # [NAME]
      | <(?:your|insert|enter|replace|add|my)[-_ ][^<>\n]+>
      | <[a-z][a-z0-9]*(?:[-_ ][a-z0-9]+)*[-_ ](?:goes[-_ ]here|here|placeholder)>
      | <[A-Z][A-Z0-9]*(?:[_-][A-Z0-9]+)*>(?!</)
    """,
    re.VERBOSE,
)
_SLOT_SIGN = re.compile(r"[{\[<@#%]|__|XXX")
# Bracketed capitals that are no slots.
NO_SLOTS = frozenset("NOTE TIP WARNING CAUTION IMPORTANT INFO DEBUG ERROR FATAL TRACE WARN OK X TOC DRAFT WIP RFC DONE SKIP PASS FAIL EOF B I P A UL LI BR HR EM TD TR TH".split())

_FENCE = re.compile(r"^[ \t]{0,3}(```+|~~~+)[^\n]*\n.*?(?:^[ \t]{0,3}\1[^\n]*$|\Z)", re.M | re.S)
_INLINE = re.compile(r"(`+)(?!`)(?:(?!\n\s*\n).)+?(?<!`)\1(?!`)", re.S)
_INDENTED = re.compile(r"^(?: {4,}|\t).*$", re.M)
_HTML_CODE = re.compile(r"<(pre|code|script|style|noscript)\b.*?</\1>", re.S | re.I)


def prose_of(text: str) -> str:
    """The text without code: fenced and indented blocks, code spans and code elements."""
    text = text.replace("\r\n", "\n")
    if "```" in text or "~~~" in text:
        text = _FENCE.sub("\n", text)
    if "    " in text or "\t" in text:
        text = _INDENTED.sub("", text)
    if "`" in text:
        text = _INLINE.sub(" ", text)
    if "</" in text:
        text = _HTML_CODE.sub(" ", text)
    return text


_RUNS = re.compile(r"\b((?i:insert|your|add|enter|replace|goes|here|placeholder))\b|([a-zß-öø-ÿ]+)|([A-ZÀ-ÖØ-Þ]+)|(\d+)")
SLOT_GRAM = 3
#: Grams of the shape in a window, and the mean log-likelihood ratio from which a window can be a slot.
SLOT_WINDOW, SLOT_LEAST = 5, 0.5


def shape_of(line: str) -> str:
    """A line with every run of small letters, capitals or digits as one sign, words that ask for a text as another, and its marks as they are."""
    return _RUNS.sub(lambda m: "Y" if m[1] else "a" if m[2] else "A" if m[3] else "0", line)


def slot_examples() -> list[str]:
    """Lines with slots: every notation, name and frame, in turn."""
    out = []
    for i, notation in enumerate(NOTATIONS):
        for k, name in enumerate(SLOT_NAMES):
            words = name.replace("_", " ")
            forms = {"n": name, "w": words, "U": name.upper(), "W": words.upper(), "T": words.title()}
            slot = re.sub("%([nwUWT])", lambda m: forms[m[1]], notation)
            out.append(SLOT_FRAMES[(i + k) % len(SLOT_FRAMES)].replace("%s", slot))
    return out


@lru_cache(maxsize=1)
def slot_model() -> dict[str, float]:
    """Log-likelihood ratios of character n-grams of shapes: slots against prose and its other marks."""
    counts: list[dict[str, float]] = []
    for lines in (slot_examples(), (MARKS + PROSE).strip().splitlines()):
        own: dict[str, float] = {}
        for line in lines:
            shape = f" {shape_of(line)} "
            for i in range(len(shape) - SLOT_GRAM + 1):
                gram = shape[i : i + SLOT_GRAM]
                own[gram] = own.get(gram, 0.0) + 1.0
        counts.append(own)
    slots, others = counts
    grams = {*slots, *others}
    n, m = sum(slots.values()) + 0.2 * len(grams), sum(others.values()) + 0.2 * len(grams)
    return {g: math.log((slots.get(g, 0.0) + 0.2) / n) - math.log((others.get(g, 0.0) + 0.2) / m) for g in grams}


def slot_likeness(line: str) -> float:
    """The greatest mean log-likelihood ratio of a window of a line's shape; unknown grams say nothing."""
    model = slot_model()
    shape = f" {shape_of(line)} "
    ratios = [model.get(shape[i : i + SLOT_GRAM], 0.0) for i in range(len(shape) - SLOT_GRAM + 1)]
    best = total = sum(ratios[:SLOT_WINDOW])
    for i in range(SLOT_WINDOW, len(ratios)):
        total += ratios[i] - ratios[i - SLOT_WINDOW]
        best = max(best, total)
    return best / min(SLOT_WINDOW, max(1, len(ratios)))


def slot_coverage(prose: str) -> float:
    """The share of prose and headings that unfilled template slots make up; 0 where there is none.

    Windows of lines that the n-gram model finds more like slots than like prose are checked by
    the notations of slots.
    """
    if not _SLOT_SIGN.search(prose):
        return 0.0
    length = 0
    for line in prose.split("\n"):
        if _SLOT_SIGN.search(line) and slot_likeness(line) >= SLOT_LEAST:
            length += sum(len(m[0]) for m in SLOTS.finditer(line) if m[0].strip("[]<>") not in NO_SLOTS)
    return length / max(1, len(prose.strip()))


# Words of navigation, footers and consent bars.
FURNITURE_WORDS = frozenset(
    "home docs doc blog search privacy terms status contact support about login sign in up menu navigation skip to content "
    "main top back next previous edit this page on cookie cookies settings imprint legal help faq careers press news "
    "community forum all rights reserved copyright share follow us subscribe newsletter language english deutsch "
    "français español table of contents download pricing products api changelog releases toggle sidebar close open rss "
    "sitemap accessibility feedback report an issue suggest edits was helpful yes no last updated".split()
)
_CRUMBS = re.compile(r"^(?:[^.!?\s]|[.!?](?=\w)|\s(?![>»›|/·•→])){1,40}(?:\s+(?:[>»›|/·•→]|&gt;)\s+[^.!?>|]{1,60}){1,8}$")
_RIGHTS = re.compile(r"^\s*(?:©|\(c\)|copyright\b)", re.I)
_HEADING_SIGNS = re.compile(r"^[\s#>*=_\-|:.]+|[\s#*=_\-|:]+$")


def is_furniture(line: str) -> bool:
    """Whether a line is navigation, a trail of crumbs or a footer."""
    if len(line) > FURNITURE_MOST or not line:
        return False
    if _RIGHTS.match(line):
        return True
    words = re.findall(r"[^\W\d_]+", line.lower())
    if words and len(words) <= 12 and sum(w in FURNITURE_WORDS for w in words) >= 0.9 * len(words):
        return True
    return bool(_CRUMBS.match(line)) and ("`" not in line) and not line.startswith("|")


#: Words of letters alone, with marks around them; names, paths, numbers and hosts are skipped.
_LETTERS = re.compile(r"(?<!\S)[(\[\"'“‘*>«¿¡]*([^\W\d_]+(?:['’][^\W\d_]+)?)[\])\"'”’*.,;:!?…»]*(?!\S)")
#: Numbers of errors of the web that begin a line or follow a word for them are words of notices;
#: the models know them by one name each.
_CODE = re.compile(r"(?:(?<![\s\S])|(?<=(?i:http|rror|reur|hler|atus|code)[\s:]))(?:(4)(?:0\d|1[0-8]|2[2-9])|(5)(?:0\d|1[01]))(?![\w,-]|\.\d)")
CODE_WORDS = {"4": "errcodefour", "5": "errcodefive"}
_LIST_SPLIT = re.compile(r"\s*[|>›»·•/]\s*")


def _code_word(m: re.Match) -> str:
    return CODE_WORDS[m[1] or m[2]]


class Scorer:
    """Coverage of the content of documents by residue windows."""

    def __init__(self) -> None:
        self.notice, self.filler = models()

    def means(self, plain: list[str]) -> np.ndarray:
        """Of every window the mean log-likelihood ratio per gram, by the likelier residue model."""
        lengths = np.array([len(p) for p in plain])
        places = _grams(_codes("".join(plain)))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        stops = np.minimum(ends - GRAM + 1, len(places))
        best = np.full(len(plain), -9.0)
        for model in (self.notice, self.filler):
            sums = np.concatenate(([0.0], np.cumsum(model[places], dtype=np.float64)))
            best = np.maximum(best, (sums[stops] - sums[starts]) / (stops - starts))
        return best

    def coverages(self, lines: list[str | int], owners: list[int], count: int) -> np.ndarray:
        """Per document, the share of its characters in windows more like residue than prose.

        ``lines`` are the prose lines of all documents of a batch, ``owners`` their documents;
        a number stands for that many characters of code.
        """
        plain, own, size = [], [], []
        total, residue = np.zeros(count), np.zeros(count)
        for line, owner in zip(lines, owners):
            if isinstance(line, int):
                total[owner] += line
                continue
            text = " " + " ".join(_LETTERS.findall(_CODE.sub(_code_word, line).lower())) + " "
            if len(text) < 6:
                continue
            whole = len(text)
            for start in range(0, whole, WINDOW):
                part = text[start : start + WINDOW + GRAM - 1]
                if len(part) < GRAM or (start and len(part) < 2 * GRAM):
                    continue
                plain.append(part)
                own.append(owner)
                size.append(len(line) * min(WINDOW, whole - start) / whole)
        if plain:
            sizes, places = np.array(size), np.array(own)
            np.add.at(total, places, sizes)
            np.add.at(residue, places, np.where(self.means(plain) >= THRESHOLD, sizes, 0.0))
        return residue / np.maximum(total, 1)


_BLANK = re.compile(r"[\s​‌‍⁠­﻿]*")


_SENTENCE_SIGN = re.compile(r"[.!?:;,`=(]")
_FENCE_LINE = re.compile(r"\s{0,3}(?:```|~~~)")


def _is_link(line: str) -> bool:
    """Whether a line reads like one entry of a menu: up to four words, no mark of a sentence."""
    return len(line) <= 48 and len(line.split()) <= 4 and not _SENTENCE_SIGN.search(line)


def _is_menu(line: str) -> bool:
    """Whether a line is a row of many menu entries."""
    parts = [p for p in _LIST_SPLIT.split(line) if p]
    return len(parts) >= 4 and all(map(_is_link, parts))


def content_lines(text: str) -> list[str | int]:
    """The prose lines of a text, and for code, tables and lists of settings their lengths.

    Headings count only where nothing else stands. Page furniture is left out: rows of links,
    trails, footers, and menus of at least four short lines in a row.
    """
    out: list[str | int] = []
    headings: list[str] = []
    menu: list[str] = []
    fenced = False
    code = 0
    raw = text.splitlines()
    for at, line in enumerate(raw):
        if _FENCE_LINE.match(line):
            fenced = not fenced
            continue
        if fenced or line.startswith(("    ", "\t", "|")):
            code += len(line)
            continue
        bare = _HEADING_SIGNS.sub("", line)
        if not bare:
            continue
        heading = line.lstrip().startswith("#") or (at + 1 < len(raw) and raw[at + 1][:3] in ("===", "---"))
        if heading:
            headings.append(bare)
            continue
        if _is_link(bare):
            menu.append(bare)
            continue
        if len(menu) < 4:
            out += [x for x in menu if not is_furniture(x)]
        menu = []
        if not (len(bare) <= FURNITURE_MOST and is_furniture(bare)) and not _is_menu(bare):
            out.append(bare)
    if len(menu) < 4:
        out += [x for x in menu if not is_furniture(x)]
    if code:
        out.append(code)
    return out or headings


def find_residue(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids of the documents to exclude, with the kind of residue and its coverage.

    Columns: ``doc_id``, ``kind`` (``slot`` or ``residue``), ``coverage``. Character n-gram models of
    notices (error pages, demands for scripts), filler and natural prose score windows of every
    line by their likelihood ratio; a document whose windows of residue cover at least half of its
    content is residue. A document with an unfilled template slot in prose or headings is a
    ``slot``: a model of the shapes of slots against prose and its marks finds windows, the
    notations of slots check them, and any coverage counts. Slots in code and page furniture around the content don't count. Null, empty and
    blank texts give no rows; repeated rows come out repeated; other columns are not read.
    """
    kind = df.schema[id_column].dataType.simpleString()

    def make() -> Callable[..., tuple]:
        scorer = Scorer()

        def work(keys: list, texts: list) -> tuple:
            lines, owners, slots, shares = [], [], [], []
            for at, text in enumerate(texts):
                if not text or _BLANK.fullmatch(text):
                    continue
                if share := slot_coverage(prose_of(text)):
                    slots.append(at)
                    shares.append(share)
                    continue
                own = content_lines(text)
                lines += own
                owners += [at] * len(own)
            cover = scorer.coverages(lines, owners, len(texts))
            flagged = np.flatnonzero(cover >= COVERAGE).tolist()
            ids = [keys[i] for i in slots] + [keys[i] for i in flagged]
            kinds = ["slot"] * len(slots) + ["residue"] * len(flagged)
            return ids, kinds, shares + [float(cover[i]) for i in flagged]

        return work

    return map_columns(df, [id_column, text_column], make, f"doc_id {kind}, kind string, coverage double")


def exclude_residue(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``df`` without the documents that :func:`find_residue` names; all columns are kept."""
    bad = find_residue(df, id_column, text_column).select("doc_id").distinct()
    return df.join(bad, df[id_column] == bad["doc_id"], "left_anti")
