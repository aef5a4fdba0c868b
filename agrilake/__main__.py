"""Command line: ``python -m agrilake run|status --root <lake> ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from agrilake.config import LakeConfig
from agrilake.plans.jobs import run_all
from agrilake.session import configure
from agrilake.sources.metadata import MetadataStore


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="agrilake")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="ingest landed payloads, refine all layers, load the warehouse")
    run.add_argument("--root", required=True)
    run.add_argument("--weather-landing", required=True)
    run.add_argument("--crop-landing", required=True)
    run.add_argument("--strict", action="store_true", help="fail when crop statistics fail")
    status = commands.add_parser("status", help="state of the pipelines and the last runs")
    status.add_argument("--root", required=True)
    given = parser.parse_args(arguments)

    spark = configure(SparkSession.builder.appName("agrilake")).getOrCreate()
    if given.command == "run":
        config = LakeConfig(given.root, strict=given.strict)
        result = run_all(spark, config, given.weather_landing, given.crop_landing)
    else:
        result = MetadataStore(spark, LakeConfig(given.root).metadata_root).status()
    print(json.dumps(result, indent=2, default=str))


if __name__ == "__main__":
    main()
