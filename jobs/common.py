"""What the jobs share: command line, config file, log."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession


def default_config(job: str) -> dict:
    """The config file that lies beside the job."""
    return json.loads((Path(__file__).parent / f"{job}.json").read_text())


def read_config(spark: SparkSession, path: str, job: str) -> dict:
    """The job's defaults with what a JSON file, anywhere, puts in their place;
    names that the defaults lack are an error."""
    given = json.loads(spark.read.text(path, wholetext=True).first()["value"])
    known = default_config(job)
    if odd := sorted(set(given) - set(known)):
        raise ValueError(f"{path}: unknown settings: {', '.join(odd)}")
    return known | given


def command_line(job: str, doc: str, paths: dict[str, str], run: Callable, argv: list[str] | None = None) -> None:
    """Parse plain path arguments, make a session, run and stop it."""
    parser = argparse.ArgumentParser(prog=job, description=doc)
    for name, words in paths.items():
        parser.add_argument(f"--{name}", required=True, help=words)
    parser.add_argument("--config", help="JSON file with settings that differ from the defaults")
    args = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    builder = SparkSession.builder.appName(job)
    spark = builder.getOrCreate()
    try:
        config = read_config(spark, args["config"], job) if args["config"] else default_config(job)
        run(spark, *(args[name] for name in paths), config)
    finally:
        spark.stop()
