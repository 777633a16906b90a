"""Duplicates: by one key, by whole rows, by two keys in order, and by similarity to recent rows."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathework.functions.batches import map_columns
from lathework.functions.keys import hash_normalized
from lathework.functions.text import has_repeated_sentences, or_empty, repeated_phrases
from lathework.operators.filters import long_enough
from lathework.session import cut_lineage


def last_per_key(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The last row of every key, as when files of one name overwrite each other."""
    whole = F.struct(*[df[c] for c in df.columns])
    packed = df.select(key.alias("_key"), df[order].alias("_order"), F.xxhash64(F.to_json(whole)).alias("_tie"), whole.alias("_row"))
    best = packed.groupBy("_key").agg(F.max_by("_row", F.struct("_order", "_tie")).alias("_row"))
    return best.select(*[F.col("_row")[c].alias(c) for c in df.columns])


def first_per_key(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of every key by ``order``; ties go to the least row digest.

    The winner is found by an aggregation that combines before the shuffle, so a key that holds a
    third of all rows costs one row a task, and no window gathers it. Rows of a null key count as
    one key. Columns stay as they are.
    """
    whole = F.struct(*[df[c] for c in df.columns])
    packed = df.select(key.alias("_key"), df[order].alias("_order"), F.xxhash64(F.to_json(whole)).alias("_tie"), whole.alias("_row"))
    best = packed.groupBy("_key").agg(F.min_by("_row", F.struct("_order", "_tie")).alias("_row"))
    return best.select(*[F.col("_row")[c].alias(c) for c in df.columns])


# --- Two keys, in order -----------------------------------------------------------------------


def greedy_matching(edges: DataFrame, finish_rows: int = 100_000, rounds: int = 60) -> DataFrame:
    """(left, right, seq) of the edges that a pass in order of ``seq`` keeps.

    An edge is kept if neither of its ends is taken by an edge kept before. Every round keeps the
    edges that come first at both of their ends, and drops all that touch them; each of the steps
    is an aggregation with map-side combine or an equi-join, and every round is written. What is
    left below ``finish_rows`` is finished by one ordered pass in one task, so a chain of edges that
    would take half its length in rounds ends at once. A rest that is larger after ``rounds`` rounds
    is made of long chains; it is passed over in the order of ``seq`` by slices of ``finish_rows``
    edges, each against the ends that are taken so far.
    """
    left = cut_lineage(edges.groupBy("left", "right").agg(F.min("seq").alias("seq")))
    kept: DataFrame | None = None
    for _ in range(rounds):
        n = left.count()
        if n == 0:
            return kept if kept is not None else left
        if n <= finish_rows:
            last = _finish(left)
            return last if kept is None else kept.unionByName(last)
        # one row an end: an end that holds a third of all edges is its first edge from here on
        first = left.groupBy("left").agg(F.min_by(F.struct("right", "seq"), "seq").alias("x")).select("left", "x.*")
        by_right = left.groupBy("right").agg(F.min("seq").alias("first_right"))
        now = cut_lineage(first.join(by_right, "right").where("seq = first_right").select("left", "right", "seq"))
        kept = now if kept is None else kept.unionByName(now)
        rest = left.join(now.select("left"), "left", "left_anti").join(now.select("right"), "right", "left_anti")
        left = cut_lineage(rest.select("left", "right", "seq"))
    n = left.count()
    parts = max(1, -(-n // finish_rows))
    rest = cut_lineage(left.repartitionByRange(parts, "seq").withColumn("slice", F.spark_partition_id()))
    for part in range(parts):
        own = rest.where(F.col("slice") == part).drop("slice")
        if part:
            own = own.join(kept.select("left"), "left", "left_anti").join(kept.select("right"), "right", "left_anti")
        last = cut_lineage(_finish(own))
        kept = last if kept is None else kept.unionByName(last)
    return kept if kept is not None else left


def _finish(edges: DataFrame) -> DataFrame:
    """The ordered pass over a rest of proven size."""

    def walk(frame):
        frame = frame.sort_values("seq", kind="stable")
        lefts, rights, keep = set(), set(), []
        for a, b in zip(frame["left"], frame["right"]):
            good = a not in lefts and b not in rights
            keep.append(good)
            if good:
                lefts.add(a)
                rights.add(b)
        return frame[keep][["left", "right", "seq"]]

    rest = edges.select("left", "right", "seq")
    return rest.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(lambda f: walk(f), rest.schema)


def judge(
    df: DataFrame, order: str = "seq", instruction: str = "instruction", extra: str = "input", output: str = "output", least: int = 50, most_repeats: int = 3, sentence_rule: bool = True
) -> DataFrame:
    """(seq, reason) of every row: ``kept`` or why it is dropped.

    In order of ``seq``: a short output, an instruction (with input) that a kept row before has, an
    output that a kept row before has, repeated phrases or sentences; else the row is kept. Rows
    are compared by digests of normalised text. ``seq`` must be unique; nulls count as empty text.
    """
    rows = df.select(
        df[order].alias("seq"),
        long_enough(df[output], least).alias("long"),
        hash_normalized(F.concat(or_empty(df[instruction]), F.lit(" "), or_empty(df[extra]))).alias("left"),
        hash_normalized(df[output]).alias("right"),
        ((repeated_phrases(df[output]) > most_repeats) | (has_repeated_sentences(df[output], most_repeats) if sentence_rule else F.lit(False))).alias("repeats"),
    )
    rows = cut_lineage(rows)
    kept = greedy_matching(rows.where("long AND NOT repeats").select("left", "right", "seq"))
    kept = cut_lineage(kept)
    by_left = kept.select("left", F.col("seq").alias("left_seq"))
    by_right = kept.select("right", F.col("seq").alias("right_seq"))
    judged = rows.join(by_left, "left", "left").join(by_right, "right", "left")
    reason = (
        F.when(~F.col("long"), "short_output").when(F.col("left_seq") < F.col("seq"), "duplicate_instruction").when(F.col("right_seq") < F.col("seq"), "duplicate_output")
        .when(F.col("repeats"), "repetitive_output").otherwise("kept")
    )
    return judged.select("seq", reason.alias("reason"))


def dual_greedy(df: DataFrame, order: str = "seq", **options) -> DataFrame:
    """The rows that :func:`judge` keeps."""
    kept = judge(df, order, **options).where("reason = 'kept'").select(F.col("seq").alias("_seq"))
    return df.join(kept, df[order] == kept["_seq"], "left_semi")


def reason_counts(judged: DataFrame) -> DataFrame:
    """(reason, rows, reduction) with the share of rows dropped over all reasons, in per cent."""
    counts = judged.groupBy("reason").agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows").alias("n"), F.sum(F.when(F.col("reason") == "kept", F.col("rows")).otherwise(0)).alias("kept"))
    share = F.coalesce(F.try_divide(F.col("n") - F.col("kept"), F.col("n")) * 100, F.lit(0.0))
    return counts.crossJoin(F.broadcast(total.select(share.alias("reduction"))))  # one row


# --- Similar to recent rows -------------------------------------------------------------------

#: Rows that are passed over in order by one task.
BLOCK_ROWS = 2_000


class _Grams:
    """Counts of characters and of runs of three, by which most texts are known not to be similar.

    A ratio above t of two texts of S characters together means over t S / 2 matched characters in
    B blocks. Between two blocks a character is left over, so B is at most (1 - t) S + 1. Every
    block but one at the start of both texts also begins from a character that the matcher does not
    take for popular (in a kept text of 200 or more: over one in a hundred), and no place is in two
    blocks, so B is at most one more than what the texts share of those. A block of n characters has
    n - 2 runs of three, so the common runs are over t S / 2 - 2 B. What shares a place, or a
    popular character counted as another, can only raise a count.
    """

    CHARS, RUNS, MOST = 128, 2048, 65_535

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold

    def of(self, text: str) -> tuple:
        """Counts of characters, of those that are not popular, and of runs of three."""
        return tuple(x[0] for x in self.many([text]))

    def many(self, texts: list[str]) -> tuple:
        """The same of several texts, a row each; counts end at ``MOST``."""
        import numpy as np

        n = len(texts)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        row = np.repeat(np.arange(n), sizes)
        # a column a character: those of ASCII, then the others that there are
        others, where = np.unique(codes[codes >= self.CHARS], return_inverse=True)
        column = codes.astype(np.int64)
        column[codes >= self.CHARS] = self.CHARS + where
        wide = self.CHARS + len(others)
        counts = np.bincount(row * wide + column, minlength=n * wide).reshape(n, wide)
        most = np.where(sizes >= 200, sizes // 100 + 1, sizes)
        rare = self._folded(np.where(counts > most[:, None], 0, counts), others)
        starts = np.ones(len(codes), dtype=bool)  # the last two places of a text begin no run
        ends = np.cumsum(sizes)
        starts[ends[sizes > 0] - 1] = starts[ends[sizes > 1] - 2] = False
        at = np.flatnonzero(starts)
        runs = np.empty(0, dtype=np.int64)
        if len(at):
            runs = ((codes[at] * np.uint32(961) + codes[at + 1] * np.uint32(31) + codes[at + 2]) * np.uint32(2_654_435_761) >> np.uint32(21)).astype(np.int64)
        runs = np.bincount(row[at] * self.RUNS + runs, minlength=n * self.RUNS).reshape(n, self.RUNS)
        return self._folded(counts, others), rare, np.minimum(runs, self.MOST).astype(np.uint16)

    def _folded(self, counts, others):
        """Counts by the place of a character among ``CHARS``."""
        import numpy as np

        out = counts[:, : self.CHARS].copy()
        if len(others):
            np.add.at(out.T, others % self.CHARS, counts[:, self.CHARS :].T)
        return np.minimum(out, self.MOST).astype(np.uint16)

    def similar(self, length: int, grams: tuple, kept: list) -> list[int]:
        """Places in ``kept`` of (length, grams) that can be similar, the last first."""
        import numpy as np

        sizes = np.array([*[k[0] for k in kept], length])
        return self.pairs(sizes, *[np.stack([*[k[1][i] for k in kept], grams[i]]) for i in range(3)], len(kept)).get(0, [])

    def pairs(self, sizes, chars, rare, runs, known: int) -> dict[int, list[int]]:
        """For every text after the first ``known``, from 0 on, the places of those before it that can be similar, the last first."""
        import numpy as np

        t = self.threshold
        own, old = (2 * np.minimum(sizes[known:, None], sizes) > t * (sizes[known:, None] + sizes) - 1e-6).nonzero()
        before = old < own + known
        own, old = own[before] + known, old[before]

        def shared(counts, step: int):
            out = np.empty(len(own), dtype=np.int64)
            for i in range(0, len(own), step):  # what is taken stays in the cache
                least = np.minimum(counts.take(own[i : i + step], axis=0), counts.take(old[i : i + step], axis=0))
                # at most the shorter length; longer texts than MOST are never told apart by counts
                out[i : i + step] = np.add.reduce(least, axis=1, dtype=np.uint16)
            return out

        def lengths():
            least = np.minimum(sizes[own], sizes[old])
            return least, sizes[own] + sizes[old], least > self.MOST

        _, total, long = lengths()
        good = (2 * shared(chars, 512) > t * total - 1e-6) | long
        own, old = own[good], old[good]
        least, total, long = lengths()
        need = t * total / 2 - 2 * (np.minimum((1 - t) * total, shared(rare, 512)) + 1) - 1e-6
        good = (need < least) | long  # there are no more runs than that
        own, old, need, long = own[good], old[good], need[good], long[good]
        good = (shared(runs, 64) > need) | long
        out: dict[int, list[int]] = {}
        for x, y in zip((own[good] - known).tolist()[::-1], old[good].tolist()[::-1]):
            out.setdefault(x, []).append(y)
        return out


class _Recent:
    """The last kept texts, which begin with the (order, text) of ``before``."""

    def __init__(self, threshold: float, window: int, before: list) -> None:
        self.grams, self.window, self.keys = _Grams(threshold), window, set()
        self.kept: list = before[-window:] if window else []
        self.matchers: list = [None] * len(self.kept)
        self.counts = self._counted([text for _, text in self.kept])

    def _counted(self, texts: list[str]) -> list:
        """Lengths and counts, a row a text."""
        import numpy as np

        return [np.array([len(t) for t in texts], dtype=np.int64), *self.grams.many(texts)]

    def keep(self, rows: list) -> list[bool]:
        """Which of the next (order, key, text) are kept: those of a new key that are similar to none."""
        import numpy as np

        known = len(self.kept)
        texts, matchers = self.kept + [(at, text) for at, _, text in rows], self.matchers + [None] * len(rows)
        counts, possible = self.counts, {}
        if self.window:
            counts = [np.concatenate(x) for x in zip(counts, self._counted([text for _, _, text in rows]))]
            possible = self.grams.pairs(*counts, known)
        good, places = [True] * known, list(range(known))  # places are those of the kept
        for n, (_, key, text) in enumerate(rows):
            first = places[-self.window] if self.window and len(places) >= self.window else 0
            old = [i for i in possible.get(n, ()) if i >= first and good[i]]
            good.append((key is None or key not in self.keys) and not self._similar(text, old, texts, matchers))
            if good[-1]:
                places.append(known + n)
                if key is not None:
                    self.keys.add(key)
        last = places[-self.window :] if self.window else []
        self.kept, self.matchers, self.counts = [texts[i] for i in last], [matchers[i] for i in last], [x[last] for x in counts]
        return good[known:]

    def _similar(self, text: str, places: list[int], texts: list, matchers: list) -> bool:
        t = self.grams.threshold
        if t < 1 and any(texts[i][1] == text for i in places):
            return True
        for i in places:
            old = texts[i][1]
            if matchers[i] is None:
                matchers[i] = (SequenceMatcher(None), _masks(old))
                matchers[i][0].set_seq2(old)
            matcher, masks = matchers[i]
            # matched characters are a common subsequence
            if 2 * _common(masks, len(old), text) > t * (len(old) + len(text)):
                matcher.set_seq1(text)
                if matcher.ratio() > t:
                    return True
        return False


def _masks(text: str) -> dict[str, int]:
    """The places of every character of a text, as bits."""
    out: dict[str, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << i
    return out


def _common(masks: dict[str, int], size: int, text: str) -> int:
    """Length of the longest common subsequence of a text with one of ``size`` characters, in bits."""
    full = (1 << size) - 1
    row = full
    for c in text:
        hit = row & masks.get(c, 0)
        row = (row + hit | row - hit) & full
    return size - row.bit_count()


def _pass_over(rows, before: list, threshold: float, window: int) -> tuple[list, list]:
    """The ordered pass over one block: which rows are kept, and the last texts kept in it.

    ``rows`` are (order, key, text, seen) of one group; ``seen`` tells that a row of the key is kept
    before the block. ``before`` are (order, text) of the last kept before it.
    """
    recent, out, tail = _Recent(threshold, window, before), [], []
    rows = sorted(rows, key=lambda r: r[0])
    for part in _parts([(at, key, text) for at, key, text, seen in rows if not seen]):
        for (at, _, text), good in zip(part, recent.keep(part)):
            out.append((at, good))
            if good:
                tail.append((at, text))
    return out + [(at, False) for at, _, _, seen in rows if seen], tail[-window:] if window else []


def _parts(rows: list, most: int = 128, chars: int = 1_000_000):
    """Rows whose texts are counted at once."""
    part, size = [], 0
    for row in rows:
        if part and (len(part) == most or size + len(row[2]) > chars):
            yield part
            part, size = [], 0
        part.append(row)
        size += len(row[2])
    if part:
        yield part


def _windows(window: int):
    """Makes the fold of blocks in order to (block, order) of the last kept before each."""

    def make():
        kept, last = [], None

        def fold(blocks, firsts, lasts, tails):
            nonlocal kept, last
            out = [], []
            for block, first, end, tail in zip(blocks, firsts, lasts, tails):
                if first == last:
                    out[0].extend([block] * len(kept))
                    out[1].extend(kept)
                kept, last = ((kept if end == last else []) + (tail or []))[-window:] if window else [], end
            return out

        return fold

    return make


def near_recent(
    df: DataFrame, order: str = "seq", output: str = "output", threshold: float = 0.85, window: int = 100, key: Column | None = None, skip: Column | None = None, block_rows: int = BLOCK_ROWS, group: str | None = None
) -> DataFrame:
    """Rows that are kept by one pass in order, as if one task made it.

    A row is dropped if ``skip`` holds, or a row kept before has its ``key``, or its output (in lower
    case) has a similarity above ``threshold`` to one of the last ``window`` kept outputs before.

    What is kept depends on what was kept. The rows are cut in blocks by ``order``; every block is
    passed over at once, at first after what a pass over the last rows of the block before keeps, and as
    if the first row of every key was kept. From what the blocks have kept follows what is kept before
    each; blocks for which that is not what they were given are passed over again, until nothing
    changes. After n rounds the first n blocks are right whatever was assumed, and mostly one round
    does for nearly all, since what is in the window after twice its rows seldom depends on rows before
    them; blocks that keep nothing hand on what they were given. No task ever sees more than a block
    and a window. ``group`` names a column whose values are passed over apart; a large
    one goes over many blocks. ``order`` must be unique; null outputs count as empty; null keys are
    no keys.
    """
    kind = df.schema[order].dataType.simpleString()
    apart = or_empty(df[group].cast("string")) if group else F.lit("")
    candidates = df if skip is None else df.where(~F.coalesce(skip, F.lit(False)))
    packed = cut_lineage(candidates.select(df[order].alias("at"), apart.alias("grp"), (key if key is not None else F.lit(None)).cast("string").alias("key"), F.lower(or_empty(df[output])).alias("text")))
    parts = max(1, -(-packed.count() // block_rows))
    rows = cut_lineage(packed.repartitionByRange(parts, "grp", "at").withColumn("block", F.spark_partition_id()))
    twice = rows.where("key IS NOT NULL").groupBy("grp", "key").agg(F.count("*").alias("n"), F.min("at").alias("least")).where("n > 1").select("grp", "key", "least")
    doubtful = cut_lineage(rows.select("block", "at", "grp", "key").join(twice, ["grp", "key"]))
    # a row for every row, with its text if it is one of the last kept, and one for every block
    result = f"block int, at {kind}, kept boolean, text string, given string, first string, last string"

    def walk(frame, state):
        import pandas as pd

        given, seen = state["given"].iloc[0], set(state["seen"].iloc[0])
        before = list(zip(state["ats"].iloc[0], state["texts"].iloc[0]))
        made, tail, name, first = [], [], None, frame["grp"].min()
        frame["seen"] = frame["at"].isin(seen)
        for name, part in frame.groupby("grp"):  # in order
            own, tail = _pass_over(part[["at", "key", "text", "seen"]].itertuples(index=False, name=None), before if name == first else [], threshold, window)
            made += own
        texts, n = dict(tail), len(made)
        out = pd.DataFrame({"block": int(frame["block"].iloc[0]), "at": [a for a, _ in made] + [None], "kept": [k for _, k in made] + [None], "text": [texts.get(a) for a, _ in made] + [None], "given": [None] * n + [given], "first": [None] * n + [first], "last": [None] * n + [name]})
        return out.astype({"at": frame["at"].dtype.name.replace("int64", "Int64"), "kept": "boolean"})

    def states(recent: DataFrame, marked: DataFrame, blocks: DataFrame) -> DataFrame:
        """(block, ats, texts, seen, given) of every block: the last kept before it, and its rows of keys kept before it."""
        none = F.array().cast(f"array<struct<at:{kind},text:string>>")
        out = blocks.join(marked.groupBy("block").agg(F.sort_array(F.collect_list("at")).alias("seen")), "block", "left")
        out = out.join(recent, "block", "left").withColumn("recent", F.coalesce("recent", none))
        out = out.select("block", F.col("recent")["at"].alias("ats"), F.col("recent")["text"].alias("texts"), F.coalesce("seen", F.array().cast(f"array<{kind}>")).alias("seen"))
        return out.withColumn("given", F.md5(F.to_json(F.struct("ats", "seen")).cast("binary")))

    def ends(frame):
        """What is kept of the last group of the last rows of a block, for the block after it."""
        import pandas as pd

        last = frame[frame["grp"] == frame["grp"].max()]
        tail = _pass_over(last[["at", "key", "text", "seen"]].itertuples(index=False, name=None), [], threshold, window)[1]
        return pd.DataFrame({"block": int(frame["block"].iloc[0]) + 1, "first": last["grp"].iloc[0], "at": [a for a, _ in tail], "text": [t for _, t in tail]}).astype({"at": frame["at"].dtype, "block": "int32"})

    def guess() -> DataFrame:
        """(block, recent) of what is likely to be kept before every block."""
        back = Window.partitionBy("block").orderBy(F.desc("grp"), F.desc("at"))
        late = rows.withColumn("back", F.row_number().over(back)).where(F.col("back") <= 2 * window + 10).drop("back")
        late = late.join(doubtful.where("at > least").select("at", F.lit(True).alias("seen")), "at", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
        kept = late.groupBy("block").applyInPandas(lambda f: ends(f), f"block int, first string, at {kind}, text string")
        return kept.join(blocks, ["block", "first"]).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "text"))).alias("recent"))

    blocks = cut_lineage(rows.groupBy("block").agg(F.min("grp").alias("first")))
    done: DataFrame | None = None
    while True:
        if done is None:
            state = states(guess(), doubtful.where("at > least"), blocks)
        else:
            first = done.where("kept").join(doubtful.select("at", "grp", "key"), "at").groupBy("grp", "key").agg(F.min("block").alias("before"))
            marked = doubtful.join(first, ["grp", "key"]).where("before < block")
            tails = done.where("text IS NOT NULL").select("block", "at", "text")
            given = done.where("given IS NOT NULL").select("block", "first", "last", "given")
            chain = given.join(tails.groupBy("block").agg(F.sort_array(F.collect_list("at")).alias("tail")), "block", "left")
            chain = chain.repartition(1).sortWithinPartitions("block")  # a short row a block
            windows = map_columns(chain, ["block", "first", "last", "tail"], _windows(window), f"block int, at {kind}")
            recent = windows.join(tails.drop("block"), "at").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "text"))).alias("recent"))
            old = given.select("block", F.col("given").alias("old"))
            state = cut_lineage(states(recent, marked, blocks).join(old, "block").where("given <> old").drop("old"))
            if not state.limit(1).count():
                break
        now = rows if done is None else rows.join(state.select("block"), "block", "left_semi")
        fresh = now.groupBy("block").cogroup(state.groupBy("block")).applyInPandas(lambda a, b: walk(a, b), result)
        done = cut_lineage(fresh if done is None else done.join(state.select("block"), "block", "left_anti").unionByName(fresh))
    kept = done.where("kept").select(F.col("at").alias("_at"))
    return df.join(kept, df[order] == kept["_at"], "left_semi")


def legacy_keep(df: DataFrame, order: str = "seq", threshold: float = 0.85, window: int = 100, repeats: int = 3, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows that the one-pass deduplication keeps: no row kept before has the same normalised
    instruction, input and output, no sentence of the output repeats ``repeats`` times, and the output
    is not similar to one of the last ``window`` kept."""
    whole = hash_normalized(F.concat_ws(" ", or_empty(df["instruction"]), or_empty(df["input"]), or_empty(df["output"])))
    return near_recent(df, order, "output", threshold, window, whole, has_repeated_sentences(df["output"], repeats), block_rows)


def top_per_group(df: DataFrame, group: str, k: int, *orders: Column) -> DataFrame:
    """The first ``k`` rows of every group; the limit is pushed below the sort by the engine."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*orders))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
