"""Command line.

    python -m glosswright query NAME DATA_DIR [OUT_DIR]   run a registered query
        --queries MODULE                                  of this module instead, as glosswright.llm.catalog
    python -m glosswright run RUNS_DIR [STAGE ...]        run all stages, or the named ones
        --settings FILE --catalog FILE.jsonl --transcripts DIR --services MODULE:NAME --run-id ID
        --talk-prompt FILE --edit-prompt FILE             templates in JSON or YAML
    python -m glosswright list                            names of the queries
    python -m glosswright status RUNS_DIR                 the newest run and its stages
"""

from __future__ import annotations

import argparse
import dataclasses
import importlib
import json
import sys

from glosswright.plans.config import STAGES, PromptTemplate, Settings
from glosswright.plans.pipeline import Manifest, Run, run_stages
from glosswright.plans.stages import Services, staged, with_templates


def run_command(args: argparse.Namespace, parser: argparse.ArgumentParser) -> int:
    from pyspark.sql import SparkSession

    if set(args.stages) - set(STAGES):
        parser.error(f"the stages are {', '.join(STAGES)}")
    if bool(args.catalog) != bool(args.transcripts):
        parser.error("--catalog and --transcripts belong together")
    settings, services = Settings.load(args.settings) if args.settings else Settings(), Services()
    if args.services:
        module, _, name = args.services.partition(":")
        services = getattr(importlib.import_module(module), name or "SERVICES")
    given = {n: PromptTemplate.load(f) for n, f in (("talk", args.talk_prompt), ("edit", args.edit_prompt)) if f}
    services = with_templates(services, **given)
    if args.catalog:
        services = dataclasses.replace(services, **staged(args.catalog, args.transcripts))
    spark = SparkSession.builder.appName("glosswright").getOrCreate()
    run = Run.resolve(args.runs, settings, args.run_id)
    manifest = Manifest(spark, f"{run.root}/{run.run_id}/manifest")
    print(json.dumps(run_stages(spark, run, manifest, names=tuple(n for n in STAGES if n in args.stages) or STAGES, services=services), indent=2))
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="glosswright")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("query")
    run.add_argument("name")
    run.add_argument("data")
    run.add_argument("out", nargs="?")
    listing = commands.add_parser("list")
    for command in (run, listing):
        command.add_argument("--queries", default="glosswright.catalog")
    commands.add_parser("status").add_argument("runs")
    stages = commands.add_parser("run")
    stages.add_argument("runs")
    stages.add_argument("stages", nargs="*", metavar="STAGE", help=", ".join(STAGES))
    for option in ("--settings", "--catalog", "--transcripts", "--services", "--run-id", "--talk-prompt", "--edit-prompt"):
        stages.add_argument(option)
    args = parser.parse_args(argv)
    if args.command == "run":
        return run_command(args, parser)
    if args.command in ("list", "query"):
        queries = importlib.import_module(args.queries).queries()
    if args.command == "list":
        print("\n".join(sorted(queries)))
        return 0
    if args.command == "status":
        record = Run.find(args.runs)
        print(json.dumps(record, indent=2) if record else "no run yet")
        return 0 if record else 1
    if args.name not in queries:
        parser.error(f"no query {args.name} in {args.queries}; see list")
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("glosswright").getOrCreate()
    result = queries[args.name](spark, args.data)
    if args.out:
        result.write.mode("overwrite").parquet(args.out)
    else:
        result.show(20, truncate=60)
    return 0


if __name__ == "__main__":
    sys.exit(main())
