"""The stages of a dataset build, in order, with a log."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.config import Config
from lathework.functions.keys import order_key
from lathework.operators.dedup import dual_greedy, near_recent
from lathework.operators.extract import markdown_samples, python_samples, rst_samples
from lathework.operators.filters import quality_reason
from lathework.operators.formats import alpaca, chatml, sharegpt
from lathework.sources import registry
from lathework.sources.files import git_source

SAMPLE_COLUMNS = ("seq", "instruction", "input", "output", "source")


@dataclass
class Run:
    """What stages hand on."""

    spark: SparkSession
    config: Config
    frames: dict[str, DataFrame] = field(default_factory=dict)


def collect(run: Run) -> str:
    """Pairs of all enabled sources that name a ``collector`` (with its ``options`` and ``limit``)."""
    named = [s for s in run.config.enabled_sources() if "collector" in s]
    for source in named:
        pairs = registry.create(source["collector"], **{k: str(v) for k, v in source.get("options", {}).items()}).run(run.spark, int(source.get("limit", 0)))
        pairs = pairs.select(F.lit(source["name"]).alias("source"), F.col("source").alias("place"), "instruction", "input", "output")
        run.frames["more"] = run.frames["more"].unionByName(pairs, allowMissingColumns=True) if "more" in run.frames else pairs
    return f"{len(named)} collectors"


def extract(run: Run) -> str:
    """Samples of all enabled sources that are trees (each with ``name``, ``paths`` and ``type``)."""
    parts = []
    e = run.config.extraction
    for source in run.config.enabled_sources():
        if "collector" in source:
            continue
        kind = source.get("type", "python")
        files = git_source(run.spark, source["name"], list(source.get("paths", [])), kind).withColumnRenamed("path", "key")
        files = files.withColumn("path", F.col("key"))
        if kind == "python":
            found = python_samples(files, least=e.min_length, most=e.max_length, whole=e.include_full_files, functions=e.include_functions)
        else:
            found = rst_samples(files, least=e.min_length) if kind == "rst" else markdown_samples(files, least=e.min_length)
        part = F.col("part") if "part" in found.columns else F.col("block_no")
        parts.append(found.select(F.lit(source["name"]).alias("source"), F.concat_ws(":", "key", part.cast("string")).alias("place"), "instruction", "input", "output"))
    if not parts:
        if "more" not in run.frames:
            raise ValueError("no enabled source")
        run.frames["samples"] = run.frames.pop("more")
        return "collected alone"
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    run.frames["samples"] = out
    return f"{len(parts)} sources"


def combine(run: Run) -> str:
    """Samples numbered in the order of source and place, with those given from outside behind them."""
    samples = run.frames["samples"]
    if "more" in run.frames:
        samples = samples.unionByName(run.frames["more"], allowMissingColumns=True)
    run.frames["combined"] = samples.withColumn("seq", F.concat_ws("\x1f", F.coalesce("source", F.lit("")), F.coalesce("place", F.lit("")), F.hex(F.xxhash64("instruction", "output"))))
    return "combined"


def quality(run: Run) -> str:
    """Samples whose lengths are within bounds."""
    q = run.config.quality
    reason = quality_reason("instruction", "output", (q.min_instruction_length, q.max_instruction_length, q.min_output_length, q.max_output_length))
    run.frames["combined"] = run.frames["combined"].where(reason.isNull())
    return "bounded"


def dedupe(run: Run) -> str:
    d = run.config.deduplication
    if not d.enabled:
        run.frames["deduped"] = run.frames["combined"]
        return "off"
    kept = dual_greedy(run.frames["combined"], least=d.min_output_length, most_repeats=d.max_repetition)
    run.frames["deduped"] = near_recent(kept, threshold=d.similarity_threshold) if d.remove_similar else kept
    return "deduplicated"


def assemble(run: Run) -> str:
    """The dataset in its layout, ordered by digest."""
    rows = run.frames["deduped"].orderBy(order_key("instruction", "output"), "seq")
    layout = run.config.output_format
    if layout == "sharegpt":
        run.frames["dataset"] = rows.select(sharegpt().alias("conversations"))
    elif layout == "chatml":
        run.frames["dataset"] = rows.select(chatml().alias("messages"))
    else:
        run.frames["dataset"] = alpaca(rows)
    return layout


STAGES: dict[str, Callable[[Run], str]] = {"extract": extract, "combine": combine, "quality": quality, "dedupe": dedupe, "assemble": assemble}
#: With the stage that only runs where a source names a collector.
ALL_STAGES = {"collect": collect} | STAGES
LOG = "stage string, success boolean, duration double, message string"


def run_stages(run: Run, only: Iterable[str] | None = None, skip: Iterable[str] = ()) -> DataFrame:
    """Run stages in order and stop at the first failure; the log as a table."""
    unknown = {*(only or ()), *skip} - ALL_STAGES.keys()
    if unknown:
        raise KeyError(f"no stage {', '.join(sorted(unknown))}")
    log = []
    for name, stage in ALL_STAGES.items():
        if only is not None and name not in only or name in skip:
            continue
        if name == "collect" and not any("collector" in s for s in run.config.enabled_sources()):
            continue  # nothing to collect, no line in the log
        began = time.time()
        try:
            message = stage(run)
            log.append((name, True, time.time() - began, message))
        except Exception as error:  # noqa: BLE001
            log.append((name, False, time.time() - began, str(error)[:500]))
            break
    return run.spark.createDataFrame(log, LOG)
