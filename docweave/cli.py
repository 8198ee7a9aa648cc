"""python -m docweave.cli list | run NAME --data DIR [--out DIR]: named queries over a folder of tables."""

from __future__ import annotations

import argparse
import re

from pyspark.sql import SparkSession

from docweave.plans import named


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    listing = commands.add_parser("list")
    listing.add_argument("pattern", nargs="?", default=".*")
    runner = commands.add_parser("run")
    runner.add_argument("name")
    runner.add_argument("--data", required=True)
    runner.add_argument("--out")
    args = parser.parse_args(argv)
    known = named.queries()
    if args.command == "list":
        print(*(n for n in sorted(known) if re.fullmatch(args.pattern, n)), sep="\n")
        return 0
    if args.name not in known:
        parser.error(f"no query {args.name}")
    df = known[args.name](SparkSession.builder.getOrCreate(), args.data)
    if args.out:
        df.write.parquet(args.out)
    else:
        df.show(50, truncate=80)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
