"""Problem 8: evaluation passages inside training text, by winnowed fingerprints."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.batches import map_columns
from lathework.llm.words import WordNumbers, numbers, run_hashes, words_of

SHARED_WORDS = 13
GRAM = 6
#: Evaluation sets up to this many words (8 bytes each, and 24 a fingerprint) are broadcast as arrays;
#: larger ones are joined to the corpus by a shuffle on the fingerprint.
BROADCAST_WORDS = 4_000_000
#: Bits of the filter of item fingerprints that goes before that shuffle, as a power of two. A fuller
#: filter lets more corpus fingerprints through and loses none.
FILTER_BITS = 26
#: Parts that the corpus side of a fingerprint is spread over in the join.
SPREAD = 8


def window_of(shared_words: int, gram: int) -> int:
    """Grams in a window such that any run of ``shared_words`` holds a whole window."""
    if not 1 <= gram <= shared_words:
        raise ValueError("gram must lie between 1 and shared_words")
    return shared_words - gram + 1


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the kept fingerprints: the least hash of every window, the rightmost of ties.

    A text of fewer grams than one window keeps none, since it can't hold a long enough run.
    """
    n = len(grams) - window + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    spans = np.lib.stride_tricks.sliding_window_view(grams, window)[:, ::-1]
    return np.unique(np.arange(n) + window - 1 - spans.argmin(axis=1))


def run_at(a: np.ndarray, i: int, b: np.ndarray, j: int) -> tuple[int, int]:
    """The maximal equal run through a[i] and b[j]: its start in ``a`` and its length."""
    back = min(i, j)
    left = a[i - back : i][::-1] != b[j - back : j][::-1]
    before = int(left.argmax()) if left.any() else back
    ahead = min(len(a) - i, len(b) - j)
    right = a[i : i + ahead] != b[j : j + ahead]
    after = int(right.argmax()) if right.any() else ahead
    return i - before, before + after


class Items:
    """Evaluation items with their winnowed fingerprints, sorted for search."""

    def __init__(self, ids: list, texts: list, shared_words: int, gram: int) -> None:
        table = WordNumbers()
        self.shared, self.gram, self.window = shared_words, gram, window_of(shared_words, gram)
        self.ids = ids
        self.words = [numbers(words_of(t), table) for t in texts]
        marks, owners, places = [], [], []
        for owner, values in enumerate(self.words):
            grams = run_hashes(values, gram)
            kept = winnow(grams, self.window)
            marks.append(grams[kept])
            owners.append(np.full(len(kept), owner))
            places.append(kept)
        joined = np.concatenate(marks) if marks else np.empty(0, dtype=np.uint64)
        order = joined.argsort(kind="stable")
        self.marks = joined[order]
        self.owners = np.concatenate(owners)[order] if marks else np.empty(0, dtype=np.int64)
        self.places = np.concatenate(places)[order] if marks else np.empty(0, dtype=np.int64)

    def hits(self, values: np.ndarray, grams: np.ndarray, kept: np.ndarray) -> set[int]:
        """Indices of the items that share a long enough run with one text."""
        marks = grams[kept]
        low = np.searchsorted(self.marks, marks, "left")
        high = np.searchsorted(self.marks, marks, "right")
        found: set[int] = set()
        for at in np.flatnonzero(high > low):
            for k in range(low[at], high[at]):
                owner = int(self.owners[k])
                if owner not in found:
                    _, length = run_at(values, int(kept[at]), self.words[owner], int(self.places[k]))
                    if length >= self.shared:
                        found.add(owner)
        return found


def find_leaks(
    documents: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    shared_words: int = SHARED_WORDS,
    gram: int = GRAM,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """(doc_id, item_id) of every document and item that share ``shared_words`` consecutive words.

    Winnowing: the least hash of every window of ``shared_words - gram + 1`` grams is kept on both
    sides, so any run that is long enough shares a kept fingerprint; each equal fingerprint is
    extended word by word to both sides and counts only if the whole run is long enough. No run is
    missed, none is reported by chance (words are compared by 64-bit numbers). Words are compared
    without case; marks and spacing don't matter.

    Null, empty and short texts give no rows; repeated rows give one row per id pair; empty tables
    give none; other columns are not read. Where the evaluation set is under ``broadcast_words``
    words (counted first, as words of any script), its arrays are built once and broadcast, and the
    corpus is read once without a shuffle; beyond that both sides are joined by fingerprint, after a
    filter of the items' fingerprints has kept the corpus fingerprints that can match.
    """
    count = F.regexp_count(F.coalesce(items[text], F.lit("")), F.lit(r"[\p{L}\p{N}_]+"))
    size = items.select(F.sum(count.cast("bigint"))).first()[0] or 0
    if size <= broadcast_words:
        return _by_broadcast(documents, items, doc_id, item_id, text, shared_words, gram)
    return _by_join(documents, items, doc_id, item_id, text, shared_words, gram)


def _by_broadcast(documents, items, doc_id, item_id, text, shared_words, gram) -> DataFrame:
    spark = documents.sparkSession
    rows = items.select(items[item_id], items[text]).distinct().collect()  # size was checked
    shared = spark.sparkContext.broadcast(Items([r[0] for r in rows], [r[1] for r in rows], shared_words, gram))
    kinds = [d.schema[c].dataType.simpleString() for d, c in ((documents, doc_id), (items, item_id))]

    def make() -> Callable[..., tuple]:
        known = shared.value
        ids = known.ids
        table = WordNumbers()

        def work(keys: list, bodies: list) -> tuple:
            owners, values = [], []
            for at, body in enumerate(bodies):
                words = words_of(body)
                if len(words) >= shared_words:
                    owners.append(at)
                    values.append(numbers(words, table))
            if not owners:
                return [], []
            # One pass over all texts of the batch; a run never crosses two of them, since each
            # text has its own slice of the grams.
            out_doc, out_item = [], []
            flat = np.concatenate(values)
            grams = run_hashes(flat, gram)
            start = 0
            ends = np.cumsum([len(v) for v in values])
            likely = _members(grams, known.marks)
            for at, own, end in zip(owners, values, ends):
                stop = int(end) - gram + 1
                if likely[start:stop].any():
                    part = grams[start:stop]
                    for item in sorted(known.hits(own, part, winnow(part, known.window))):
                        out_doc.append(keys[at])
                        out_item.append(ids[item])
                start = int(end)
            return out_doc, out_item

        return work

    found = map_columns(documents, [doc_id, text], make, f"doc_id {kinds[0]}, item_id {kinds[1]}")
    return found.distinct()


def _members(values: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``marks``."""
    if len(marks) == 0:
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(marks, values)
    at[at == len(marks)] = 0
    return marks[at] == values


def _places(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places of every fingerprint in the filter."""
    shift, mask = np.uint64(64 - FILTER_BITS), np.uint64((1 << FILTER_BITS) - 1)
    return (marks >> shift).astype(np.int64), (marks & mask).astype(np.int64)


BLOCK = 1 << 16


def filter_of(items: DataFrame, text: str, shared_words: int, gram: int) -> np.ndarray:
    """A bitmap of fixed size with two bits of every kept fingerprint of the items.

    Every task marks its own input in a bitmap and sends the blocks that aren't empty; blocks are
    joined in two steps, per block and part of the tasks, then per block. What reaches the driver is
    one bitmap, for any input.
    """
    window = window_of(shared_words, gram)

    def mark(batches):
        table = WordNumbers()
        seen = np.zeros(1 << FILTER_BITS, dtype=bool)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                grams = run_hashes(numbers(words_of(body), table), gram)
                for places in _places(grams[winnow(grams, window)]):
                    seen[places] = True
        from pyspark import TaskContext

        packed = np.packbits(seen).reshape(-1, BLOCK)
        full = np.flatnonzero(packed.any(axis=1))
        part = TaskContext.get().partitionId() % 64
        blocks = {"block": pa.array(full, pa.int32()), "part": pa.array([part] * len(full), pa.int32()), "bits": pa.array([packed[i].tobytes() for i in full], pa.binary())}
        yield pa.RecordBatch.from_pydict(blocks)

    def add(frame):
        import pandas as pd

        total = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in frame["bits"]], axis=0)
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "part": [frame["part"].iloc[0]], "bits": [total.tobytes()]})

    schema = "block int, part int, bits binary"
    sent = items.select(text).mapInArrow(mark, schema)
    joined = sent.groupBy("block", "part").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema)
    out = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8).reshape(-1, BLOCK)
    for row in joined.select("block", "bits").toLocalIterator():
        out[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _set(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 == 1


def fingerprints(
    df: DataFrame, id_column: str, text: str, shared_words: int, gram: int, name: str, wanted=None
) -> DataFrame:
    """(mark, <name>, before, after): every kept fingerprint with the words on both sides of it.

    ``before`` holds up to ``shared_words`` word numbers left of the gram, nearest first;
    ``after`` as many from its first word on. That is all an extension to the needed length asks.
    With ``wanted``, a broadcast of :func:`filter_of`, only those are made whose bits it has.
    """
    kind = df.schema[id_column].dataType.simpleString()
    window = window_of(shared_words, gram)

    def make() -> Callable[..., tuple]:
        table = WordNumbers()
        bits = wanted.value if wanted else None

        def work(keys: list, bodies: list) -> tuple:
            marks, ids, before, after = [], [], [], []
            for key, body in zip(keys, bodies):
                values = numbers(words_of(body), table)
                grams = run_hashes(values, gram)
                signed = values.view(np.int64)
                kept = winnow(grams, window)
                if bits is not None:
                    one, two = _places(grams[kept])
                    kept = kept[_set(bits, one) & _set(bits, two)]
                for at in kept:
                    marks.append(int(grams[at].view(np.int64)))
                    ids.append(key)
                    before.append(signed[max(0, at - shared_words) : at][::-1])
                    after.append(signed[at : at + shared_words])
            return marks, ids, before, after

        return work

    schema = f"mark bigint, {name} {kind}, before_{name} array<bigint>, after_{name} array<bigint>"
    return map_columns(df, [id_column, text], make, schema)


def _by_join(documents, items, doc_id, item_id, text, shared_words, gram) -> DataFrame:
    wanted = documents.sparkSession.sparkContext.broadcast(filter_of(items, text, shared_words, gram))
    left = fingerprints(documents, doc_id, text, shared_words, gram, "doc_id", wanted)
    right = fingerprints(items, item_id, text, shared_words, gram, "item_id")
    # a frequent passage is spread over tasks by its documents, the items repeated to match
    left = left.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)).cast("int"))
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))

    def equal_from_start(a: str, b: str):
        same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
        first_gap = F.array_position(same, F.lit(False))
        return F.when(first_gap > 0, first_gap - 1).otherwise(F.least(F.size(a), F.size(b)).cast("bigint"))

    length = equal_from_start("before_doc_id", "before_item_id") + equal_from_start("after_doc_id", "after_item_id")
    return left.join(right, ["mark", "part"]).where(length >= shared_words).select("doc_id", "item_id").distinct()
