"""``python -m mergewell run [--from S] [--to S] [--force S,...]``, ``stage S``, ``status`` and ``stages``.

Settings come from ``MERGEWELL_*`` in the environment and from ``--set name=value``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from mergewell.plans import stages
from mergewell.plans.settings import Settings
from mergewell.sources import storage


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="mergewell", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "stage", "status", "stages"):
        p = commands.add_parser(name)
        p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE")
        p.add_argument("--log")
        if name == "run":
            p.add_argument("--from", dest="start")
            p.add_argument("--to", dest="end")
        if name == "stage":
            p.add_argument("name", choices=stages.STAGES)
        if name in ("run", "stage"):
            p.add_argument("--force", default="")
    args = parser.parse_args(argv)
    if args.command == "stages":
        print("\n".join(f"{k} {name}" for k, name in enumerate(stages.STAGES, 1)))
        return 0
    env = {f"MERGEWELL_{k.upper()}": v for k, v in (x.split("=", 1) for x in args.set)}
    import os

    settings = Settings.of(dict(os.environ) | env)
    if args.command == "run":
        stages.stage_range(args.start, args.end)
    storage.log_to(args.log)
    run = stages.Run(SparkSession.builder.appName("mergewell").getOrCreate(), settings, tuple(x for x in getattr(args, "force", "").split(",") if x))
    if args.command == "status":
        found = stages.status(run)
        print(json.dumps(found, indent=2))
        return 0 if all(x == "done" for names in found.values() for x in names.values()) else 1
    out = stages.run_all(run, args.start, args.end) if args.command == "run" else stages.run_stage(run, args.name)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
