"""Run one stage, or all of them in order.

    spark-submit basketry/jobs/run_stage.py clean --base URI \\
        --events CSV --properties CSV [CSV ...] --categories CSV
    spark-submit basketry/jobs/run_stage.py generate|assemble|rank|serve|evaluate --base URI

Settings come from a JSON file ({"als": {"factors": 64}}) and from --set als.factors=64,
which goes before the file.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

if __package__ in (None, ""):  # started as a script, from whatever folder
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from basketry.plans.stages import Settings, Stages  # noqa: E402
from basketry.session import build_session, ship_package  # noqa: E402

ORDER = ("clean", "generate", "assemble", "rank", "serve", "evaluate")


def read_settings(path: str | None, changes: list[str]) -> Settings:
    values: dict[str, dict[str, object]] = json.loads(Path(path).read_text()) if path else {}
    for change in changes:
        name, _, value = change.partition("=")
        group, _, key = name.partition(".")
        if not key or not value:
            raise ValueError(f"not of the form group.name=value: {change}")
        values.setdefault(group, {})[key] = json.loads(value)
    return Settings.of(values)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("stage", choices=(*ORDER, "all"))
    parser.add_argument("--base", required=True, help="folder of the published tables")
    parser.add_argument("--events", help="CSV of raw events")
    parser.add_argument("--properties", nargs="+", help="CSV extracts of item properties")
    parser.add_argument("--categories", help="CSV of the category tree")
    parser.add_argument("--settings", help="JSON file of settings")
    parser.add_argument("--set", action="append", default=[], metavar="GROUP.NAME=VALUE")
    args = parser.parse_args(argv)
    settings = read_settings(args.settings, args.set)
    spark = build_session(f"basketry-{args.stage}")
    ship_package(spark)
    stages = Stages(spark, args.base, settings)
    for name in ORDER if args.stage == "all" else (args.stage,):
        if name == "clean":
            if not (args.events and args.properties and args.categories):
                parser.error("clean needs --events, --properties and --categories")
            report = stages.clean(args.events, args.properties, args.categories)
        else:
            report = getattr(stages, name)()
        report.show(truncate=False)


if __name__ == "__main__":
    main()
