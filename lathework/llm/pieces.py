"""Problem 5: oversized items cut at natural boundaries by dynamic programming."""

from __future__ import annotations

import math
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from lathework.functions.batches import map_columns

LIMIT = 4096
OVERLAP = 200

#: Boundaries and what a cut there costs, from the most natural on; a cut falls behind the match.
BOUNDARIES = (
    (re.compile(r"\n(?=#{1,6} )"), 0.0),
    (re.compile(r"\n[ \t\r]*\n+"), 0.0),
    (re.compile(r"\n(?=[^\s\w]*(?:[-*+•]|\d+[.)])\s)"), 1.0),
    (re.compile(r"\n"), 1.5),
    (re.compile(r"[.!?…]+[\"'”’)\]]*\s+|[。！？।॥؟۔]+"), 2.0),
)
WEAKER = (
    (re.compile(r"[;:,]\s+|[、，；：،]"), 5.0),
    (re.compile(r"\s+"), 8.0),
)
FORCED = 60.0
#: Characters a piece should not be cut before: marks that belong to the character before them.
_JOINED = re.compile(r"[̀-ͯ҃-ःऺ-़ा-ॏั-ฺ็-๎‌‍︀-️⃐-⃿\U0001F3FB-\U0001F3FF]")
#: Without a boundary for this many characters, weaker ones are taken in.
SPARSE = 700
FORCED_STEP = 50
BALANCE = 40.0
PIECE = 10.0


def boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a cut may fall, in order, with their penalties; 0 and the end are in."""
    n = len(text)
    cost: dict[int, float] = {}
    for pattern, penalty in BOUNDARIES:
        for m in pattern.finditer(text):
            cost.setdefault(m.end(), penalty)
    cost[0] = 0.0
    for pattern, penalty in WEAKER:
        marks = sorted({*cost, n})
        for a, b in zip(marks, marks[1:]):
            if b - a > SPARSE:
                for m in pattern.finditer(text, a, b):
                    cost.setdefault(m.end(), penalty)
    marks = sorted({*cost, n})
    for a, b in zip(marks, marks[1:]):
        if b - a > SPARSE:
            for at in range(a + FORCED_STEP, b, FORCED_STEP):
                while at < b and _JOINED.match(text, at):
                    at += 1
                cost.setdefault(at, FORCED)
    cost[n] = 0.0
    positions = np.array(sorted(p for p in cost if p <= n))
    return positions, np.array([cost[p] for p in positions.tolist()])


def cut_points(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[int]:
    """Where the new text of every piece ends; the last is the text's length.

    Over the boundary positions, ``best[j]`` is the least cost of cutting the text up to j: the
    penalty of the cut, a cost per piece, and the square of the piece's distance from an even size,
    over all earlier boundaries i from which the piece (with its overlap) stays under the limit.
    """
    n = len(text)
    if n <= limit:
        return [n]
    places, penalty = boundaries(text)
    step = limit - overlap
    pieces = 1 + math.ceil((n - limit) / step)
    even = (n + (pieces - 1) * overlap) / pieces / limit
    best = np.full(len(places), np.inf)
    came = np.zeros(len(places), dtype=np.int64)
    best[0] = 0.0
    first = np.searchsorted(places, places - step)
    begins = np.searchsorted(places, places - limit)
    for j in range(1, len(places)):
        low = int(min(first[j], begins[j])) if begins[j] == 0 else int(first[j])
        sizes = places[j] - places[low:j] + np.where(np.arange(low, j) > 0, overlap, 0)
        cost = best[low:j] + PIECE + BALANCE * (sizes / limit - even) ** 2
        cost[sizes > limit] = np.inf
        if low == 0 and places[j] < overlap:
            cost[0] = np.inf  # the next piece could not begin with so many characters of it
        at = int(cost.argmin())
        best[j] = cost[at] + penalty[j]
        came[j] = low + at
    out, j = [], len(places) - 1
    if not np.isfinite(best[j]):  # no boundary fits: even cuts
        return [min(n, limit + k * step) for k in range(pieces)]
    while j > 0:
        out.append(int(places[j]))
        j = int(came[j])
    return out[::-1]


def pieces_of(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, str]]:
    """(start, piece) of every piece in order."""
    out, start = [], 0
    for end in cut_points(text, limit, overlap):
        begin = max(0, start - overlap) if out else 0
        out.append((begin, text[begin:end]))
        start = end
    return out


def split_items(
    df: DataFrame,
    id_column: str = "chunk_key",
    text_column: str = "text",
    carry: tuple[str, ...] = ("section",),
    limit: int = LIMIT,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Every item as ordered pieces of at most ``limit`` characters (code points).

    Columns: the id and ``carry`` columns (same for all pieces), ``piece_no`` from 0, ``pieces``,
    ``start`` (offset of the piece in the text), ``text``. Each piece after the first begins with
    the last ``overlap`` characters of the one before, so the text is the first piece and the
    others without their first ``overlap`` characters. Texts under the limit, null, empty and blank
    ones come out whole as one piece. Repeated rows come out repeated. Long texts are handled in
    time proportional to their length. Raises ValueError unless 0 <= 2 * overlap < limit.
    """
    if not 0 <= 2 * overlap < limit:
        raise ValueError("overlap must be under half the limit")
    kinds = [f"{c} {df.schema[c].dataType.simpleString()}" for c in (id_column, *carry)]

    def make() -> Callable[..., tuple]:
        def work(*columns: list) -> tuple:
            *kept, texts = columns
            rows: list[int] = []
            numbers, counts, starts, parts = [], [], [], []
            for at, text in enumerate(texts):
                found = pieces_of(text, limit, overlap) if text else [(0, text)]
                for number, (start, part) in enumerate(found):
                    rows.append(at)
                    numbers.append(number)
                    counts.append(len(found))
                    starts.append(start)
                    parts.append(part)
            return *[[column[r] for r in rows] for column in kept], numbers, counts, starts, parts

        return work

    schema = ", ".join([*kinds, "piece_no int, pieces int, start int, text string"])
    return map_columns(df, [id_column, *carry, text_column], make, schema)
