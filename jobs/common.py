"""What the jobs share: config files, a log, the command line."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable

from pyspark.sql import SparkSession

LOG = logging.getLogger("tessera.jobs")


def config_file(spark: SparkSession, path: str, defaults: dict) -> dict:
    """A JSON object, read through Spark, so that it may be remote, over the defaults; unknown names are errors."""
    given = json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    if unknown := set(given) - set(defaults):
        raise ValueError(f"{path}: unknown settings {sorted(unknown)}; known are {sorted(defaults)}")
    return defaults | given


def main(run: Callable[..., dict], defaults: dict, paths: dict[str, str], argv: list[str] | None = None) -> None:
    """Reads --config and the paths, makes a session, runs, and stops the session."""
    parser = argparse.ArgumentParser(description=run.__doc__)
    parser.add_argument("--config", help="JSON file; every setting has a default")
    for name, help_ in paths.items():
        parser.add_argument(f"--{name}", required=True, help=help_)
    args = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(run.__name__).getOrCreate()
    try:
        config = config_file(spark, args["config"], defaults) if args["config"] else defaults
        done = run(spark, config=config, **{n: args[n] for n in paths})
        LOG.info("done: %s", json.dumps(done, sort_keys=True))
    finally:
        spark.stop()
