"""Problem 6: groups of near-duplicate records, by consistent weighted sampling of their shingles."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.batches import map_columns
from lathework.llm.words import WordNumbers, run_hashes, scatter, words_of
from lathework.operators.components import components
from lathework.session import cut_lineage

# --- Parameters -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """How records are compared.

    ``shingle`` words make a shingle; records are alike above ``threshold`` of plain Jaccard
    similarity. ``bands`` of ``rows`` samples make the candidates. TF-IDF weights for sampling are
    scaled to ``levels`` steps from 1 to ``skew``, so a pair of plain similarity j has a weighted one
    of at least j / skew whatever its common part and its term frequencies: 0.55 at 0.6, which meets
    in a band with a chance of 1 - (1 - 0.55^3)^32, over 0.997.
    The two rows of the sketch of document frequencies have one cell a record or more, from ``bins``
    to ``most_bins``; ``pool`` rows of random parameters are shared by all shingles. Buckets of up to
    ``all_pairs`` records compare all pairs; larger ones go the way of :func:`bridges`. Up to
    ``broadcast_rows`` ids or keys (8 bytes each, counted first) are broadcast, beyond that they are
    joined by a shuffle. ``bits`` is the length of the parity bitmap by which pairs that can't be
    alike are left out.
    """

    shingle: int = 5
    threshold: float = 0.8
    bands: int = 32
    rows: int = 3
    skew: float = 1.09
    levels: int = 8
    bins: int = 1 << 18
    most_bins: int = 1 << 22
    pool: int = 8192
    bits: int = 512
    all_pairs: int = 64
    broadcast_rows: int = 1_000_000
    seed: int = 20240607


#: Problem 6 asks for three words and 0.6.
PAIRS = Settings(shingle=3, threshold=0.6)
#: Cells of the sketch in one row, and parts that tasks are counted in, before those are summed.
BLOCK, PARTS = 1 << 16, 320

# --- Shingles ---------------------------------------------------------------------------------


def shingles_of(texts: list[str], k: int, table: WordNumbers) -> list[tuple[np.ndarray, np.ndarray]]:
    """The sorted distinct shingle hashes of every text and how often each stands in it."""
    words = [words_of(t) for t in texts]
    sizes = [len(w) for w in words]
    flat = np.fromiter(map(table.__getitem__, chain.from_iterable(words)), dtype=np.uint64, count=sum(sizes))
    grams = run_hashes(flat, k)
    out, start = [], 0
    for size in sizes:
        out.append(np.unique(grams[start : max(start, start + size - k + 1)], return_counts=True))
        start += size
    return out


def _bins(hashes: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bins - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def document_counts(rows: DataFrame, text: str, s: Settings, bins: int) -> tuple[np.ndarray, int]:
    """A count-min sketch of the document frequencies of all shingles, and the number of records.

    Every task counts its whole input into two rows of ``bins`` cells and sends blocks of them;
    blocks are summed in two steps, first per block and part of the tasks, then per block. What
    reaches the driver is the sketch itself, of fixed size (2 * bins cells), for any input.
    """
    k = s.shingle

    def count(batches):
        table = WordNumbers()
        cells = np.zeros(2 * bins, dtype=np.int64)
        total = 0
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            total += len(texts)
            hashes = np.concatenate([*(h for h, _ in shingles_of(texts, k, table)), np.empty(0, dtype=np.uint64)])
            one, two = _bins(hashes, bins)
            cells += np.bincount(np.concatenate([one, two + bins]), minlength=2 * bins)
        if total:
            from pyspark import TaskContext

            part = TaskContext.get().partitionId() % PARTS
            blocks = [cells[i : i + BLOCK].astype("<i8").tobytes() for i in range(0, 2 * bins, BLOCK)]
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([*range(len(blocks)), -1], pa.int32()), "part": pa.array([part] * (len(blocks) + 1), pa.int32()), "cells": pa.array([*blocks, np.array([total], "<i8").tobytes()], pa.binary())}
            )

    def add(frame):
        import pandas as pd

        total = np.sum([np.frombuffer(c, "<i8") for c in frame["cells"]], axis=0)
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "part": [frame["part"].iloc[0]], "cells": [total.astype("<i8").tobytes()]})

    schema = "block int, part int, cells binary"
    sent = rows.select(text).mapInArrow(count, schema)
    first = sent.groupBy("block", "part").applyInPandas(add, schema)
    second = first.groupBy("block").applyInPandas(add, schema)
    out, total = np.zeros(2 * bins, dtype=np.int64), 0
    for row in second.select("block", "cells").collect():
        if row["block"] < 0:
            total = int(np.frombuffer(row["cells"], "<i8")[0])
        else:
            at = row["block"] * BLOCK
            out[at : at + BLOCK] = np.frombuffer(row["cells"], "<i8")
    return out, total


class Weights:
    """TF-IDF weights of shingles in steps, from the sketch.

    What is kept and sent is one byte a cell: the step of its inverse document frequency, from 0
    for what all records share to 255 for what one record has.
    """

    def __init__(self, cells: np.ndarray, total: int, bins: int, s: Settings) -> None:
        top = np.log(total + 1.0) or 1.0
        steps = np.clip(np.rint(255 * np.log((total + 1) / np.maximum(cells, 1)) / top), 0, 255).astype(np.uint8)
        self.bins, self.one, self.two, self.levels, self.skew = bins, steps[:bins], steps[bins:], s.levels, s.skew

    def levels_of(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The step of (1 + ln tf) idf of every shingle, 0 .. levels - 1."""
        one, two = _bins(hashes, self.bins)
        idf = np.maximum(self.one[one], self.two[two])  # by the smaller count
        scaled = (1.0 + np.log(counts)) * idf * (self.levels / 256.0)
        return np.minimum(scaled, self.levels - 1).astype(np.int64)

    def of(self, levels: np.ndarray) -> np.ndarray:
        return 1.0 + (self.skew - 1.0) / max(1, self.levels - 1) * levels


class Sampler:
    """Improved consistent weighted sampling: two records draw the same with the chance of their
    weighted Jaccard similarity.

    For a shingle of weight w and hash k, with r, c ~ Gamma(2, 1) and b ~ U(0, 1) fixed by both,
    t = floor(ln w / r + b), ln y = r (t - b), ln a = ln c - ln y - r; the sample is the shingle
    of the least a, with its t. The random parameters come from a pool of rows that hashes share, and
    weights come in steps, so ln a and t are tables by row and step, made once a worker.
    """

    def __init__(self, s: Settings) -> None:
        rng = np.random.default_rng(s.seed)
        draws = s.bands * s.rows
        shape = (s.pool, 1, draws)
        r = rng.gamma(2.0, 1.0, shape).astype(np.float32)
        c = np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32)
        b = rng.uniform(0.0, 1.0, shape).astype(np.float32)
        log = np.log(np.linspace(1.0, s.skew, s.levels, dtype=np.float32))[None, :, None]
        t = np.floor(log / r + b)
        self.a = (c - r * (t - b + 1.0)).reshape(-1, draws)
        self.t = t.astype(np.int8 if t.max() < 128 else np.int64).reshape(-1, draws)
        self.bands, self.rows, self.levels = s.bands, s.rows, s.levels
        self.pool = np.uint64(s.pool)
        self.columns = np.arange(draws)
        self.salt = scatter(np.arange(1, s.bands + 1, dtype=np.uint64))

    def bands_of(self, hashes: np.ndarray, levels: np.ndarray, sizes: list[int]) -> np.ndarray:
        """A key for every band (columns) of every record (rows); records of ``sizes`` follow each other."""
        at = ((hashes >> np.uint64(7)) % self.pool).astype(np.int64) * self.levels + levels
        least = np.empty((len(sizes), len(self.columns)), dtype=np.int64)
        start = 0
        for row, size in enumerate(sizes):
            least[row] = self.a[at[start : start + size]].argmin(axis=0)
            least[row] += start
            start += size
        t = self.t[at[least], self.columns].astype(np.int64)
        with np.errstate(over="ignore"):
            draws = scatter(hashes[least] ^ scatter(t.view(np.uint64))).reshape(len(sizes), self.bands, self.rows)
            key = np.broadcast_to(self.salt, (len(sizes), self.bands))
            for i in range(self.rows):
                key = scatter(key * np.uint64(31) + draws[:, :, i])
        return key.view(np.int64)


@lru_cache(maxsize=2)
def sampler_of(s: Settings) -> Sampler:
    return Sampler(s)


def parity(hashes: np.ndarray, sizes: list[int], bits: int) -> list[bytes]:
    """Of every record a bitmap with the parity of the number of hashes at every place.

    Two bitmaps differ in at most as many places as their sets differ in elements.
    """
    places = ((hashes >> np.uint64(17)) & np.uint64(bits - 1)).astype(np.int64)
    counts = np.bincount(np.repeat(np.arange(len(sizes)) * bits, sizes) + places, minlength=len(sizes) * bits)
    whole = np.packbits((counts & 1).astype(np.uint8)).tobytes()
    return [whole[i : i + bits // 8] for i in range(0, len(whole), bits // 8)]


# --- Candidates and links ---------------------------------------------------------------------


def signatures(rows: DataFrame, s: Settings, shared) -> DataFrame:
    """(id, n, parity, bands) of every record that has a shingle; ``n`` counts its distinct ones."""

    def make() -> Callable[..., tuple]:
        table, sampler, weights = WordNumbers(), sampler_of(s), shared.value

        def some(ids: list, texts: list) -> tuple:
            sets = [(key, *x) for key, x in zip(ids, shingles_of(texts, s.shingle, table)) if len(x[0]) and key is not None]
            if not sets:
                return [], [], [], np.empty(0, dtype=np.int64)
            kept, sizes = [x[0] for x in sets], [len(x[1]) for x in sets]
            hashes, counts = np.concatenate([x[1] for x in sets]), np.concatenate([x[2] for x in sets])
            return kept, sizes, parity(hashes, sizes, s.bits), sampler.bands_of(hashes, weights.levels_of(hashes, counts), sizes).reshape(-1)

        def work(ids: list, texts: list) -> tuple:
            parts = [some(ids[i : i + 1000], texts[i : i + 1000]) for i in range(0, len(ids), 1000)]
            kept, sizes, maps = ([x for p in parts for x in p[n]] for n in range(3))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1) * s.bands, pa.int32()), pa.array(np.concatenate([p[3] for p in parts]), pa.int64()))
            return kept, sizes, maps, lists.cast(pa.list_(pa.field("element", pa.int64())))

        return work

    return map_columns(rows, ["id", "text"], make, "id bigint, n int, parity binary, bands array<bigint>")


def _among(df: DataFrame, keys: DataFrame, column: str, s: Settings, how: str = "left_semi") -> DataFrame:
    """``df`` joined to ``keys`` (few columns of 8 bytes), which are broadcast only if counted to be few."""
    return df.join(F.broadcast(keys) if keys.count() <= s.broadcast_rows else keys, column, how)


def _possible(pairs: DataFrame, signed: DataFrame, s: Settings) -> DataFrame:
    """The pairs that can be alike by their sizes and bitmaps; no pair above the threshold is lost.

    Above a similarity t, sets of x and y elements differ in fewer than (x + y) (1 - t) / (1 + t).
    """
    small = signed.select("id", "n", "parity")
    for side in ("a", "b"):
        pairs = pairs.join(small.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("parity").alias(f"parity_{side}")), side)

    def make() -> Callable[..., tuple]:
        share = (1.0 - s.threshold) / (1.0 + s.threshold)

        def work(left: list, right: list, n_left: list, n_right: list, of_left: list, of_right: list) -> tuple:
            x = np.frombuffer(b"".join(of_left), np.uint8).reshape(len(left), -1)
            y = np.frombuffer(b"".join(of_right), np.uint8).reshape(len(left), -1)
            apart = np.maximum(np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64), np.abs(np.subtract(n_left, n_right)))
            keep = np.flatnonzero(apart < share * np.add(n_left, n_right) + 1e-9)
            return [left[i] for i in keep], [right[i] for i in keep]

        return work

    return map_columns(pairs, ["a", "b", "n_a", "n_b", "parity_a", "parity_b"], make, "a bigint, b bigint")


def _verify(pairs: DataFrame, rows: DataFrame, signed: DataFrame, s: Settings, shared) -> DataFrame:
    """(a, b, jaccard, weighted) of the pairs that are alike.

    Weighted similarity goes first: over the threshold it is at least threshold / skew. Plain
    similarity, as the groups are defined by it, decides.
    """
    pairs = cut_lineage(_possible(pairs, signed, s))
    ids = cut_lineage(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
    texts = _among(rows, ids, "id", s)

    def make_sets() -> Callable[..., tuple]:
        table, weights = WordNumbers(), shared.value

        def work(keys: list, bodies: list) -> tuple:
            sets = shingles_of(bodies, s.shingle, table)
            return keys, [h.tobytes() for h, _ in sets], [weights.levels_of(h, c).astype(np.uint8).tobytes() for h, c in sets]

        return work

    sets = cut_lineage(map_columns(texts, ["id", "text"], make_sets, "id bigint, shingles binary, levels binary").dropDuplicates(["id"]))
    both = pairs
    for side in ("a", "b"):
        both = both.join(sets.select(F.col("id").alias(side), F.col("shingles").alias(f"of_{side}"), F.col("levels").alias(f"levels_{side}")), side)

    def make() -> Callable[..., tuple]:
        weights = shared.value

        def work(left: list, right: list, of_left: list, of_right: list, levels_left: list, levels_right: list) -> tuple:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for a, b, x, y, v, w in zip(left, right, of_left, of_right, levels_left, levels_right):
                one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                heavy, light = weights.of(np.frombuffer(v, np.uint8)), weights.of(np.frombuffer(w, np.uint8))
                common, i, j = np.intersect1d(one, two, assume_unique=True, return_indices=True)
                least = np.minimum(heavy[i], light[j]).sum()
                weighted = float(least / (heavy.sum() + light.sum() - least))
                union = len(one) + len(two) - len(common)
                if weighted >= s.threshold / s.skew - 1e-9 and len(common) > s.threshold * union:
                    for column, value in zip(out, (a, b, len(common) / union, weighted)):
                        column.append(value)
            return out

        return work

    columns = ["a", "b", "of_a", "of_b", "levels_a", "levels_b"]
    return cut_lineage(map_columns(both, columns, make, "a bigint, b bigint, jaccard double, weighted double"))


def digests(rows: DataFrame, s: Settings) -> DataFrame:
    """(id, copy, enough): a digest of every text, and whether it has the words of a shingle; written once."""
    word, other = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
    enough = F.col("text").rlike(f"(?:{word}+{other}+){{{s.shingle - 1}}}{word}")
    return cut_lineage(rows.where("id is not null").select("id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("copy"), enough.alias("enough")))


def bridges(rows: DataFrame, s: Settings = PAIRS, copies: DataFrame | None = None) -> DataFrame:
    """(a, b, jaccard, weighted): links of alike texts, by their least ids, that join all of a group.

    ``rows`` has ``id`` and ``text``, ``copies`` their :func:`digests` where they are made already. Every link is of two texts that are alike, and any two texts
    that are alike and meet in a bucket are joined by a chain of them. They are not all links of a
    group, whose number grows with its square: :func:`degrees` counts those.

    Copies are collapsed first, by their digests, so a text that holds a third of all rows is one
    record from there on. A bucket of up to three is known from its count, least, greatest and
    exclusive-or of ids, without its members being gathered; buckets of up to ``all_pairs`` join
    their members; larger buckets link every member to the least one, and then, once components are
    known, go through :func:`_across`.
    """
    spark = rows.sparkSession
    copies = digests(rows, s) if copies is None else copies
    bins = min(s.most_bins, max(s.bins, 1 << copies.count().bit_length()))
    shared = spark.sparkContext.broadcast(Weights(*document_counts(rows, "text", s, bins), bins, s))
    many = copies.groupBy("copy").agg(F.min("id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("copy", "rep")
    others = cut_lineage(copies.join(many, "copy").where("id <> rep").select("id").distinct())
    signed = cut_lineage(_among(signatures(rows, s, shared), others, "id", s, "left_anti"))
    entries = signed.select("id", F.explode("bands").alias("key"))
    buckets = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"), F.expr("bit_xor(id)").alias("x"))
    buckets = cut_lineage(buckets.where("n > 1 AND a <> b"))
    ends = F.struct("a", "b")
    middle = F.col("x").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("b"))
    threes = F.array(ends, F.struct("a", middle.alias("b")), F.struct(middle.alias("a"), "b"))
    few = buckets.where("n <= 3").select(F.inline(F.when(F.col("n") == 2, F.array(ends)).otherwise(threes)))
    members = cut_lineage(_among(entries, buckets.where("n > 3").select("key", "n", "a"), "key", s, "inner"))
    small = members.where(F.col("n") <= s.all_pairs).select("key", "id")
    some = small.join(small.select("key", F.col("id").alias("other")), "key").where("id < other").select(F.col("id").alias("a"), F.col("other").alias("b"))
    hot = members.where(F.col("n") > s.all_pairs)
    star = hot.where("id <> a").select("a", F.col("id").alias("b"))
    pairs = few.where("a < b").unionByName(some).unionByName(star).distinct()
    found = _verify(pairs, rows, signed, s, shared)
    rest = _across(hot, found, rows, s, shared) if hot.limit(1).count() else None
    if rest is not None:
        found = cut_lineage(found.unionByName(_verify(rest, rows, signed, s, shared)).distinct())
    return found


def _across(hot: DataFrame, found: DataFrame, rows: DataFrame, s: Settings, shared) -> DataFrame | None:
    """Pairs of different components within hot buckets that can be alike, exactly.

    One side are the members outside a bucket's largest component. Two sets above a similarity t
    share an element among the first n - ceil(t n) + 1 of each in any fixed order; ordered from the
    rarest, the boilerplate that made the bucket hot comes last, so unlike texts don't meet.
    """
    known = components(found)
    placed = cut_lineage(hot.join(known, hot["id"] == known["node"], "left").select("key", "id", F.coalesce("component", "id").alias("component")))
    sizes = placed.groupBy("key", "component").count()
    largest = sizes.groupBy("key").agg(F.max_by("component", F.struct("count", "component")).alias("largest"))
    rest = cut_lineage(placed.join(largest, "key").where("component <> largest").select("key", "id").distinct())
    if not rest.limit(1).count():
        return None
    near = _among(placed, rest.select("key").distinct(), "key", s).select("id", "component").distinct()
    near = cut_lineage(near)

    def make() -> Callable[..., tuple]:
        table, weights = WordNumbers(), shared.value

        def work(keys: list, bodies: list) -> tuple:
            ids, sizes, marks = [], [], []
            for key, (hashes, counts) in zip(keys, shingles_of(bodies, s.shingle, table)):
                n = len(hashes)
                # without term frequencies: the order must be the same in all texts
                order = np.lexsort((hashes, -weights.levels_of(hashes, np.ones(n))))
                first = hashes[order[: n - math.ceil(s.threshold * n) + 1]]
                ids += [key] * len(first)
                sizes += [n] * len(first)
                marks.append(first)
            return ids, sizes, np.concatenate([*marks, np.empty(0, np.uint64)]).view(np.int64).tolist()

        return work

    texts = _among(rows, near.select("id"), "id", s)
    marks = map_columns(texts, ["id", "text"], make, "id bigint, n int, mark bigint").dropDuplicates(["id", "mark"])
    marks = cut_lineage(marks.join(near, "id"))
    left = _among(marks, rest.select("id").distinct(), "id", s).select(F.col("id").alias("x"), F.col("component").alias("of_x"), F.col("n").alias("n_x"), "mark")
    joined = left.join(marks, "mark").where(F.col("of_x") != F.col("component")).where(F.least("n", "n_x") > s.threshold * F.greatest("n", "n_x"))
    return joined.select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct()


def _alike(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Whether each two of some shingle sets are alike, by products of blocks of their incidence."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    owner = np.repeat(np.arange(n), sizes)
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1  # others are in no intersection
    number = np.cumsum(shared) - 1
    keep = shared[place]
    owner, column = owner[keep], number[place[keep]]
    common = np.zeros((n, n), dtype=np.int64)
    for start in range(0, int(shared.sum()), 8192):
        part = (column >= start) & (column < start + 8192)
        block = np.zeros((n, 8192), dtype=np.float32)
        block[owner[part], column[part] - start] = 1.0
        common += np.rint(block @ block.T).astype(np.int64)
    return common > threshold * (sizes[:, None] + sizes[None, :] - common)


def degrees(rows: DataFrame, found: DataFrame, marked: DataFrame, s: Settings, block: int = 256) -> DataFrame:
    """(rep, links): with how many other distinct texts each text is alike, counted over all pairs.

    ``found`` has the links that made the components ``marked``. All texts that are alike with one are
    in its component. Where every pair of a component is a link already, it is counted from those;
    of other components the members are compared block by block, all pairs of two blocks in a task.
    """
    sizes = marked.groupBy("component").agg(F.count("*").alias("n"))
    ends = found.select("a", "b").distinct()
    edges = ends.join(marked.select(F.col("node").alias("a"), "component"), "a")
    sizes = sizes.join(edges.groupBy("component").agg(F.count("*").alias("edges")), "component")
    sizes = cut_lineage(sizes)
    full = F.col("edges") * 2 == F.col("n") * (F.col("n") - 1)
    whole = marked.join(sizes.where(full), "component").select(F.col("node").alias("rep"), (F.col("n") - 1).alias("links"))
    open_ = marked.join(sizes.where(~full), "component")
    blocks = F.ceil(F.col("n") / block).cast("int")
    placed = open_.select(F.col("node").alias("id"), "component", blocks.alias("blocks"))
    placed = cut_lineage(placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    texts = rows.join(placed.select("id"), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))

    def make_sets() -> Callable[..., tuple]:
        table = WordNumbers()
        return lambda keys, bodies: (keys, [h.tobytes() for h, _ in shingles_of(bodies, s.shingle, table)])

    sets = map_columns(texts, ["id", "text"], make_sets, "id bigint, shingles binary")
    members = placed.join(cut_lineage(sets), "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.select("component", "id", "block", "shingles", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))

    def compare(frame):
        import pandas as pd

        alike = _alike([np.frombuffer(x, np.uint64) for x in frame["shingles"]], s.threshold)
        np.fill_diagonal(alike, False)
        if frame["one"].iloc[0] != frame["two"].iloc[0]:  # pairs within a block are counted in its own group
            at = frame["block"].to_numpy()
            alike &= at[:, None] != at[None, :]
        return pd.DataFrame({"rep": frame["id"], "links": alike.sum(axis=1).astype(np.int64)})

    counted = members.groupBy("component", "one", "two").applyInPandas(lambda f: compare(f), "rep bigint, links bigint")
    return whole.unionByName(counted.groupBy("rep").agg(F.sum("links").alias("links")))


def prepare(df: DataFrame, id_column: str, columns: tuple[str, ...]) -> DataFrame:
    """(id, text): the columns of a record joined by a space, null as empty."""
    parts = [F.coalesce(df[c], F.lit("")) for c in columns]
    return df.select(df[id_column].cast("bigint").alias("id"), F.concat_ws(" ", *parts).alias("text"))


def groups(df: DataFrame, id_column: str = "pair_id", columns: tuple[str, ...] = ("instruction", "output"), s: Settings = PAIRS, counted: bool = True) -> DataFrame:
    """(id, group, links) of every record with a near duplicate; the group is its least id.

    ``links`` is the number of different texts its text is alike with, see :func:`degrees`; without ``counted``
    it is null, and the count is not made. Groups are chains of alike
    records; exact copies belong to one group. Records with fewer words than a shingle have nothing
    to share and are in no group, nor are null ids. Ties, repeated rows and empty tables are fine;
    other columns are not read. Ids must tell rows apart; rows of one id count as one record.
    """
    rows = prepare(df, id_column, columns)
    copies = digests(rows, s)
    found = bridges(rows, s, copies)
    copies = copies.where("enough").select("id", "copy")
    reps = copies.groupBy("copy").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    marked = components(found)
    labelled = reps.join(marked, reps["rep"] == marked["node"], "left")
    if counted:
        labelled = labelled.join(degrees(rows, found, marked, s), "rep", "left")
    else:
        labelled = labelled.withColumn("links", F.lit(None).cast("bigint"))
    labelled = labelled.where((F.col("n") > 1) | F.col("component").isNotNull())
    labelled = labelled.select("copy", F.coalesce("component", "rep").alias("group"), (F.coalesce("links", F.lit(0)) if counted else F.col("links")).alias("links"))
    return copies.join(labelled, "copy").select("id", "group", "links")


def group_pairs(df: DataFrame, id_column: str = "pair_id", columns: tuple[str, ...] = ("instruction", "output"), s: Settings = PAIRS) -> DataFrame:
    """(pair_a, pair_b) of all pairs within a group, the smaller id first; see :func:`groups`."""
    members = cut_lineage(groups(df, id_column, columns, s, counted=False).select("id", "group").distinct())
    other = members.select(F.col("id").alias("pair_b"), "group")
    return members.join(other, "group").where("id < pair_b").select(F.col("id").alias("pair_a"), "pair_b")
