"""Command line: ``python -m epiframe drop-episodes DATASET --episodes "[3, 5]" [--out FOLDER]``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from epiframe.operators import dataset


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m epiframe", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    drop = commands.add_parser("drop-episodes", help="write a dataset without some of its episodes, in its layout and under new numbers")
    drop.add_argument("dataset")
    drop.add_argument("--episodes", required=True, help="a JSON list of episode numbers")
    drop.add_argument("--out", help="a new folder; the dataset's with -kept after it, if not given")
    args = parser.parse_args(argv)
    out = args.out or f"{args.dataset.rstrip('/')}-kept"
    n = dataset.drop_episodes(SparkSession.builder.appName("epiframe").getOrCreate(), args.dataset, out, json.loads(args.episodes))
    print(f"{n} episodes in {out}")


if __name__ == "__main__":
    main()
