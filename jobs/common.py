"""What the jobs share: configuration, the session of a command line, logging, columns."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenspark.spec import ScreenSpec, load_spec

log = logging.getLogger("jobs")


@dataclass(frozen=True)
class Config:
    """The triage thresholds, and for each input table its columns as SQL expressions."""

    spec: ScreenSpec
    columns: dict[str, dict[str, str]]
    options: dict


def load_config(path: str | Path) -> Config:
    """A YAML file with the sections ``columns``, ``options`` and ``spec``."""
    content = yaml.safe_load(Path(path).read_text())
    return Config(load_spec(str(path)), content["columns"], content.get("options") or {})


def columns_of(table: DataFrame, columns: dict[str, str]) -> DataFrame:
    return table.select(*(F.expr(sql).alias(name) for name, sql in columns.items()))


def count_of(table: DataFrame) -> int:
    """Rows of a table that is stored; Spark takes them from the footers of the files."""
    return table.count()


def main(run: Callable[..., DataFrame], inputs: list[str], config: Path, words: list[str] | None = None) -> None:
    """The command line of a job: a path for each input, one for the output, the configuration."""
    parser = argparse.ArgumentParser(description=run.__doc__)
    for name in inputs:
        parser.add_argument(f"--{name}", required=True, help=f"path of the {name} table")
    parser.add_argument("--out", required=True, help="folder of the job's tables")
    parser.add_argument("--config", default=str(config), help="YAML file")
    given = parser.parse_args(words)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(run.__module__).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, {name: getattr(given, name) for name in inputs}, given.out, load_config(given.config))
    finally:
        spark.stop()
