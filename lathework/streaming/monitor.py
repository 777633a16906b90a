"""Detectors over the progress of long runs, as streams with state and as batch twins."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STALL_CHECKS = 5
PROGRESS = "run_id string, ts timestamp, step bigint"


def stalls(progress: DataFrame, run: str = "run_id", ts: str = "ts", step: str = "step", checks: int = STALL_CHECKS) -> DataFrame:
    """(run_id, ts, step, unchanged, stalled): how many checks in a row have not changed the step.

    A run begins at step 0, so a first check at 0 counts. Windows are by run; order within a run is
    by time and step.
    """
    w = Window.partitionBy("run_id").orderBy("ts", "step")
    rows = progress.select(progress[run].alias("run_id"), progress[ts].alias("ts"), F.coalesce(progress[step], F.lit(0)).alias("step"))
    moved = rows.withColumn("moved", (F.col("step") != F.coalesce(F.lag("step").over(w), F.lit(0))).cast("int"))
    island = moved.withColumn("island", F.sum("moved").over(w))
    inner = Window.partitionBy("run_id", "island").orderBy("ts", "step")
    count = F.row_number().over(inner) - F.max("moved").over(Window.partitionBy("run_id", "island"))
    return island.withColumn("unchanged", count.cast("int")).select("run_id", "ts", "step", "unchanged", (F.col("unchanged") >= checks).alias("stalled"))


def stream_stalls(progress: DataFrame, checks: int = STALL_CHECKS) -> DataFrame:
    """The streaming twin of :func:`stalls` over (run_id, ts, step): state is the last step and a count.

    Rows of a batch are taken in the order of time and step within each run.
    """

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, count = state.get if state.exists else (0, 0)
        held = pd.concat(list(frames)).sort_values(["ts", "step"], kind="stable")
        out = []
        for ts, step in zip(held["ts"], held["step"].fillna(0).astype("int64")):
            count = count + 1 if step == last else 0
            last = int(step)
            out.append((key[0], ts, last, count, count >= checks))
        state.update((last, count))
        yield pd.DataFrame(out, columns=["run_id", "ts", "step", "unchanged", "stalled"])

    return progress.groupBy("run_id").applyInPandasWithState(
        advance, "run_id string, ts timestamp, step bigint, unchanged int, stalled boolean", "last bigint, count int", "append", "NoTimeout"
    )


def hangs(counts: DataFrame, run: str = "run_id", ts: str = "ts", count: str = "hangs") -> DataFrame:
    """(run_id, ts, hangs, alarm): an alarm whenever a cumulative count exceeds its highest value so far.

    The high-water mark stays after a recovery, so a count that is reported again doesn't alarm again.
    """
    w = Window.partitionBy("run_id").orderBy("ts", "hangs").rowsBetween(Window.unboundedPreceding, -1)
    rows = counts.select(counts[run].alias("run_id"), counts[ts].alias("ts"), F.coalesce(counts[count], F.lit(0)).alias("hangs"))
    return rows.withColumn("alarm", F.col("hangs") > F.coalesce(F.max("hangs").over(w), F.lit(0)))


def stream_hangs(counts: DataFrame) -> DataFrame:
    """The streaming twin of :func:`hangs` over (run_id, ts, hangs)."""

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        (top,) = state.get if state.exists else (0,)
        held = pd.concat(list(frames)).sort_values(["ts", "hangs"], kind="stable")
        out = []
        for ts, n in zip(held["ts"], held["hangs"].fillna(0).astype("int64")):
            out.append((key[0], ts, int(n), n > top))
            top = max(top, int(n))
        state.update((top,))
        yield pd.DataFrame(out, columns=["run_id", "ts", "hangs", "alarm"])

    return counts.groupBy("run_id").applyInPandasWithState(advance, "run_id string, ts timestamp, hangs bigint, alarm boolean", "top bigint", "append", "NoTimeout")


def recovery(failures: DataFrame, run: str = "run_id", ts: str = "ts", most: int = 5) -> DataFrame:
    """(run_id, ts, attempt, level, give_up): the recovery level of every failure of a run."""
    w = Window.partitionBy("run_id").orderBy("ts")
    rows = failures.select(failures[run].alias("run_id"), failures[ts].alias("ts")).withColumn("attempt", F.row_number().over(w))
    return rows.withColumn("level", F.least(F.col("attempt") - 1, F.lit(3))).withColumn("give_up", F.col("attempt") >= most)


def latest_progress(progress: DataFrame, total: Column | int, seconds_a_step: float = 15.0, run: str = "run_id", ts: str = "ts", step: str = "step") -> DataFrame:
    """(run_id, step, percent, remaining, eta_seconds) of the last check of every run."""
    total = F.lit(total) if isinstance(total, int) else total
    last = progress.groupBy(progress[run].alias("run_id")).agg(F.max_by(progress[step], F.struct(progress[ts], progress[step])).alias("step"))
    left = F.greatest(total - F.col("step"), F.lit(0))
    return last.select("run_id", "step", F.coalesce(F.try_divide(F.col("step") * 100.0, total), F.lit(0.0)).alias("percent"), left.alias("remaining"), (left * seconds_a_step).alias("eta_seconds"))


def completions(lines: DataFrame, line: str = "line", pattern: str = r"(?i)training (?:completed|complete|finished)") -> DataFrame:
    """Lines of a log that tell of completion; works on a stream as on a table."""
    return lines.where(lines[line].rlike(pattern))


def health(hang: Column, exited: Column, stalled: Column) -> Column:
    """The first of the detectors that fires: hang, exit, stall; else healthy."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(yes(hang), "hang").when(yes(exited), "exited").when(yes(stalled), "stalled").otherwise("healthy")


def windowed_counts(events: DataFrame, ts: str = "ts", kind: str = "event_type", width: str = "1 day", late: str = "2 days") -> DataFrame:
    """(window_start, event_type, events): tumbling counts with a watermark, beyond what runs need."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), F.col(kind).alias("event_type")).agg(F.count("*").alias("events")).select(F.col("w.start").alias("window_start"), "event_type", "events")
