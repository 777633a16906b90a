"""``python -m lathework.cli``: list collectors, run them, run the stages."""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields, is_dataclass

from lathework import config
from lathework.plans import runner
from lathework.sources import registry
from lathework.sources.files import write_collected, write_lines


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lathework")
    parser.add_argument("names", nargs="*", help="collectors to run")
    parser.add_argument("--list", action="store_true", help="collectors and what they need")
    parser.add_argument("--all", action="store_true", help="run all collectors of the configuration")
    parser.add_argument("--config", help="a YAML file; its sources with a collector can be run by name, or its stages by --stages")
    parser.add_argument("--profile", help="a profile of the configuration")
    parser.add_argument("--env", default=".env", help="a file of KEY=value lines behind the environment")
    parser.add_argument("--stages", help="stages to run, by commas, or 'all'")
    parser.add_argument("--help-config", action="store_true", help="options of every collector and settings of the configuration")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--limit", type=int, default=0)
    parser.add_argument("--format", default="full", choices=["alpaca", "sharegpt", "full"])
    parser.add_argument("--out", default="collected")
    given = parser.parse_args(argv)
    if given.help_config:
        print(help_config())
        return 0
    if given.list or not (given.names or given.all or given.stages):
        for name in registry.names():
            cls = registry._COLLECTORS[name]
            print(f"{name}: {cls.description} (needs {', '.join(cls.required) or 'nothing'})")
        return 0
    from lathework.session import get_spark

    settings = config.load(given.config, given.profile, config.env_file(given.env))
    if given.stages:
        spark = get_spark()
        run = runner.Run(spark, settings)
        log = runner.run_stages(run, None if given.stages == "all" else given.stages.split(",")).collect()
        for row in log:
            print(f"{row['stage']}: {'done' if row['success'] else 'failed'} in {row['duration']:.1f} s, {row['message']}")
        if "dataset" in run.frames:
            write_lines(run.frames["dataset"], f"{given.out}/{settings.full_name}")
        return 0 if all(row["success"] for row in log) else 1
    options = dict(o.split("=", 1) for o in given.option)
    wanted = [(s["name"], s["collector"], {k: str(v) for k, v in s.get("options", {}).items()}) for s in settings.enabled_sources() if "collector" in s]
    by_name = {name: (collector, own) for name, collector, own in wanted}
    jobs = wanted if given.all else [(n, *by_name.get(n, (n, {}))) for n in given.names]
    spark = get_spark()
    for name, collector, own in jobs:
        print(write_collected(registry.create(collector, **(own | options)).run(spark, given.limit), given.out, name, given.format))
    return 0


def help_config() -> str:
    """The options of every collector, the settings of the configuration with their defaults, and the environment."""
    lines = ["collectors:"]
    for name in registry.names():
        cls = registry._COLLECTORS[name]
        lines.append(f"  {name}: {', '.join([*(f'{o} (needed)' for o in cls.required), *cls.optional])}")
    lines.append("settings:")
    for field in fields(config.Config):
        value = getattr(config.Config(), field.name)
        lines += [f"  {field.name}.{f.name}: {getattr(value, f.name)}" for f in fields(value)] if is_dataclass(value) else [f"  {field.name}: {value}"]
    lines.append("environment:")
    lines += [f"  {variable}: {place}" for variable, (place, _) in config.ENVIRONMENT.items()]
    return "\n".join(lines)


if __name__ == "__main__":
    sys.exit(main())
