"""python -m branchwise.cli validate | prepare | run [--model m] [--resume] [--wait seconds] --config file"""

from __future__ import annotations

import argparse
import importlib
import sys

from branchwise.control import config as cfg, run as runs
from branchwise.sources.articles import SnapshotMismatch
from branchwise.sources.ontology import OntologyError


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("classify").config("spark.sql.session.timeZone", "UTC").config("spark.speculation", "false").getOrCreate()


def main(argv: list[str] | None = None, spark=None) -> int:
    parser = argparse.ArgumentParser(prog="classify", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("validate", "prepare", "run"):
        command = commands.add_parser(name)
        command.add_argument("--config", required=True)
        if name == "run":
            command.add_argument("--model")
            command.add_argument("--resume", action="store_true")
            command.add_argument("--wait", type=float, default=0.0, help="seconds to wait while other runs hold all calls of a hosted model")
            command.add_argument("--adapters", help="module:function that makes an adapter of a model's name and configuration")
    args = parser.parse_args(argv)
    try:
        config = cfg.load(args.config)
        checked = runs.validate(config)
        if args.command == "validate":
            from branchwise.control.files import Files
            from branchwise.sources.articles import verify_snapshot

            spark = spark or _session()  # for its file systems alone; no job runs
            verify_snapshot(Files(spark, config.dataset.file), config.dataset.file, config.dataset.file_sha256)
            print(f"valid: ontology {checked.ontology_hash}, models {', '.join(config.enabled())}")
            return 0
        prepared = runs.prepare(spark or _session(), checked)
        if args.command == "prepare":
            print(f"identity {prepared.digest}, sample {prepared.sample_hash} of {prepared.sample_size} in {prepared.sample_path}")
            return 0
        registry = runs.models.offline
        if args.adapters:
            module, _, function = args.adapters.partition(":")
            registry = getattr(importlib.import_module(module), function)
        folder = runs.run(spark or _session(), prepared, registry, args.model, args.resume, args.wait)
        print(folder.root)
        return 0
    except (cfg.ConfigError, OntologyError, SnapshotMismatch, FileNotFoundError, LookupError) as e:
        print(f"classify {args.command}: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
