"""What the jobs share: settings from a JSON file over defaults, the command line, and the log."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable

from pyspark.sql import SparkSession


def read_settings(spark: SparkSession, path: str | None, defaults: dict) -> dict:
    """``defaults`` with what the JSON file at ``path`` sets, read by Spark as it may be remote; unknown names are an error."""
    given = json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())) if path else {}
    if unknown := set(given) - set(defaults):
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return {**defaults, **given}


def main(run: Callable, paths: list[str], about: str) -> None:
    """Parse the command line, and run in a session of its own."""
    parser = argparse.ArgumentParser(description=about)
    for p in paths:
        parser.add_argument(p)
    parser.add_argument("--config", help="JSON file of settings")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    from corvane.session import session, ship

    spark = ship(session(app__name="corvane-job"))
    try:
        run(spark, *[getattr(args, p) for p in paths], config=args.config)
    finally:
        spark.stop()
