"""The jobs from a shell: ``spark-submit ... seamark/__main__.py ingest --input-dir s3a://raw --output-dir s3a://bronze``.

Flags are the settings' names with hyphens; settings without a flag come from environment variables and a file
(``--config`` or CONFIG_FILE). The counters are printed as one line of JSON. Exit codes: 0, 2 where there was nothing to do,
1 for bad settings and, in health, for a query that isn't well.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
import typing
from collections.abc import Mapping

from pyspark.sql import SparkSession

from seamark.jobs import decode, ingest, listen
from seamark.jobs.config import ListenConfig, DecodeConfig, IngestConfig, load, read
from seamark.streaming import status

JOBS = {"ingest": (IngestConfig, ingest.run), "decode": (DecodeConfig, decode.run), "listen": (ListenConfig, listen.run)}
NOTHING = 2


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="seamark", description="AIS lines to tables")
    jobs = top.add_subparsers(dest="job", required=True)
    for name, (kind, _) in JOBS.items():
        job = jobs.add_parser(name, help=kind.__doc__)
        job.add_argument("--config", help="a flat TOML file of settings")
        hints = typing.get_type_hints(kind)
        for field in dataclasses.fields(kind):
            flag = "--" + field.name.replace("_", "-")
            # a flag alone switches on; a tuple's values are joined by commas
            job.add_argument(flag, dest=f"set_{field.name}", **({"nargs": "?", "const": "true"} if hints[field.name] is bool else {}))
    health = jobs.add_parser("health", help="whether the queries of a status file are well")
    health.add_argument("--status-file", required=True)
    health.add_argument("--stale-seconds", type=int, default=60)
    return top


def settings(arguments: argparse.Namespace, environ: Mapping[str, str] | None = None):
    kind = JOBS[arguments.job][0]
    hints = typing.get_type_hints(kind)
    given = {name.removeprefix("set_"): read(hints[name.removeprefix("set_")], text) for name, text in vars(arguments).items() if name.startswith("set_") and text is not None}
    return load(kind, given, environ, arguments.config)


def main(arguments: list[str] | None = None, spark: SparkSession | None = None, environ: Mapping[str, str] | None = None) -> int:
    found = parser().parse_args(arguments)
    if found.job == "health":
        told = status.problems(found.status_file, 1000 * found.stale_seconds)
        print("\n".join(told) or "well")
        return 1 if told else 0
    try:
        config = settings(found, environ)
    except (ValueError, OSError) as wrong:
        print(f"seamark: {wrong}", file=sys.stderr)
        return 1
    spark = spark or SparkSession.builder.appName(f"seamark {found.job}").getOrCreate()
    counters = JOBS[found.job][1](spark, config)
    print(json.dumps(counters))
    idle = {"ingest": "files", "decode": "partitions"}.get(found.job)
    return NOTHING if idle and not counters[idle] else 0


if __name__ == "__main__":
    sys.exit(main())
