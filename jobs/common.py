"""What the jobs share: strict configurations, the command line and logging."""

from __future__ import annotations

import argparse
import logging
import sys
import tomllib
from collections.abc import Callable
from dataclasses import fields
from typing import TypeVar

from pyspark.sql import SparkSession

C = TypeVar("C")


def config(spark: SparkSession, kind: type[C], path: str | None) -> C:
    """The record of a TOML file, which Spark reads as it may be remote; without one the defaults. Unknown keys are an error."""
    text = spark.read.text(path, wholetext=True).first() if path else None
    record = tomllib.loads(text["value"]) if text else {}
    if unknown := set(record) - {f.name for f in fields(kind)}:
        raise ValueError(f"unknown keys in {path}: {', '.join(sorted(unknown))}")
    return kind(**record)


def main(about: str, places: dict[str, str], work: Callable[..., object], argv: list[str] | None = None) -> int:
    """The command line of a job: its places as options and a configuration. It alone creates and stops a session."""
    parser = argparse.ArgumentParser(description=about)
    for name, text in places.items():
        parser.add_argument(f"--{name}", required=True, help=text)
    parser.add_argument("--config", help="TOML file of the job's parameters")
    args = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s", stream=sys.stderr)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName(about).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        work(spark, **args)
    finally:
        spark.stop()
    return 0
