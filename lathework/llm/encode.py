"""Problem 7: the whole corpus as token ids of a public byte-level BPE tokenizer."""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lathework.functions.batches import map_columns

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# The published split pattern of the vocabulary, and Unicode's White_Space property.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = r"\t-\r \x85\xa0  -     　"

#: A space-delimited run with the one space before it. Every alternative of SPLIT that takes
#: other characters than white space keeps inside such a run, so runs encode independently.
RUNS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

#: Words up to this many bytes scan a rank array; longer ones keep their ranks in a heap, which
#: gives the same merges in n log n.
SHORT_WORD = 96
NO_RANK = 1 << 60


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """The rank table of a ``.tiktoken`` file: base64 of the bytes, a space, the rank."""
    return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, raw.splitlines()) if word}


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one word by a contiguous array of part boundaries and adjacent ranks.

    ``cuts`` holds the start of every part (and the end), ``pair[i]`` the rank of parts i and i+1
    joined. The least rank is sought by a scan (the leftmost of ties), its inner boundary deleted,
    and the ranks of both neighbours refreshed.
    """
    cuts = list(range(len(word) + 1))
    get = ranks.get
    pair = [get(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
    while pair:
        least = min(pair)
        if least == NO_RANK:
            break
        at = pair.index(least)
        del cuts[at + 1]
        del pair[at]
        if at < len(pair):
            pair[at] = get(word[cuts[at] : cuts[at + 2]], NO_RANK)
        if at:
            pair[at - 1] = get(word[cuts[at - 1] : cuts[at + 1]], NO_RANK)
    return [ranks[word[a:b]] for a, b in zip(cuts, cuts[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for long words: candidate pairs in a heap by (rank, position)."""
    n = len(word)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, left, end = heapq.heappop(heap)
        if not alive[left]:
            continue
        right = after[left]
        if right >= n or after[right] != end:
            continue
        alive[right] = False
        after[left] = end
        if end < n:
            before[end] = left
            if (r := ranks.get(word[left : after[end]])) is not None:
                heapq.heappush(heap, (r, left, after[end]))
        if (prior := before[left]) >= 0 and (r := ranks.get(word[prior:end])) is not None:
            heapq.heappush(heap, (r, prior, end))
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at : after[at]]])
        at = after[at]
    return out


class RunIds(dict):
    """Ids of runs, filled on demand; emptied when it has grown to ``most`` entries."""

    def __init__(self, ranks: dict[bytes, int], most: int = 200_000) -> None:
        import regex

        super().__init__()
        self.ranks, self.most, self.words = ranks, most, {}
        self.split = regex.compile(SPLIT).findall

    def encode_word(self, word: str) -> tuple[int, ...]:
        found = self.words.get(word)
        if found is None:
            raw = word.encode("utf-8", "replace")
            whole = self.ranks.get(raw)
            if whole is not None:
                found = (whole,)
            else:
                found = tuple((merge_short if len(raw) <= SHORT_WORD else merge_long)(raw, self.ranks))
            if len(raw) <= SHORT_WORD:
                if len(self.words) >= self.most:
                    self.words.clear()
                self.words[word] = found
        return found

    def __missing__(self, run: str) -> tuple[int, ...]:
        ids = tuple(chain.from_iterable(map(self.encode_word, self.split(run))))
        if len(run) <= SHORT_WORD:
            if len(self) >= self.most:
                self.clear()
            self[run] = ids
        return ids


@lru_cache(maxsize=2)
def _table(raw: bytes) -> RunIds:
    return RunIds(parse_ranks(raw))


def encoder(raw: bytes) -> Callable[[str | None], list[int]]:
    """A plain function from text to ids, for tests and small uses."""
    table = _table(raw)
    return lambda text: list(chain.from_iterable(map(table.__getitem__, RUNS.findall(text)))) if text else []


def encode_texts(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", ranks_path: str = DEFAULT_RANKS
) -> DataFrame:
    """One row per row of ``df``: its id and the token ids of its text, without special tokens.

    Columns: ``doc_id`` (as ``id_column``'s type, null kept), ``ids`` array<int>. Null and empty
    texts give an empty list; strings of special tokens are ordinary text. Repeated rows come out
    repeated; an empty table gives none; other columns are not read. The vocabulary (50 thousand
    entries, under 1 MB, fixed) is read on the driver and broadcast, so executors need no copy of
    the file. No shuffle; memory is bound by one batch of rows and a cache of 200,000 short runs.
    """
    spark = df.sparkSession
    with open(ranks_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    kind = df.schema[id_column].dataType.simpleString()

    def make() -> Callable[..., tuple]:
        ids_of, runs = _table(shared.value).__getitem__, RUNS.findall

        def work(keys: list, texts: list) -> tuple:
            offsets, parts, total = [0], [], 0
            for text in texts:
                if text:
                    ids = np.fromiter(chain.from_iterable(map(ids_of, runs(text))), dtype=np.int32)
                    parts.append(ids)
                    total += len(ids)
                offsets.append(total)
            flat = np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            return keys, lists.cast(pa.list_(pa.field("element", pa.int32())))

        return work

    return map_columns(df, [id_column, text_column], make, f"doc_id {kind}, ids array<int>")
