"""Command line: scrape, info, count."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from papyrine import plans, storage
from papyrine.config import get_settings
from papyrine.logs import setup_logging
from papyrine.sources import REGISTRY


def scrape(spark: SparkSession, source: str, query: str, max_results: int = 100, date_from: str | None = None, date_to: str | None = None, output: str | None = None, say=print, **more: str) -> int:
    """Run sources one after another and append what they give; returns the number of documents."""
    settings = get_settings()
    setup_logging(settings.log_level)
    total = 0
    for name in plans.resolve(source):
        docs = plans.search(spark, name, query, max_results, date_from, date_to, **plans.options(name, settings), **more).cache()
        try:
            if docs.isEmpty():
                say(f"{name}: no results")
                continue
            path = output or storage.default_output_path(settings.output_dir, name)
            n = storage.append_documents(path, docs)
        finally:
            docs.unpersist()
        total += n
        say(f"{name}: {n} documents appended to {path}")
    say(f"{total} documents in all")
    return total


def info(say=print) -> None:
    """Settings and sources; of keys only whether they are set."""
    s = get_settings()
    say(f"output directory: {s.output_dir}\nlog level: {s.log_level}\nNCBI e-mail: {s.ncbi_email}")
    for label, is_set in (("NCBI key", s.ncbi_api_key), ("USPTO key", s.uspto_api_key), ("EPO key and secret", s.epo_key and s.epo_secret), ("search API key", s.serpapi_key)):
        say(f"{label}: {'set' if is_set else 'not set'}")
    say("sources: " + ", ".join(REGISTRY))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("papyrine")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("scrape", help="search sources and append documents")
    run.add_argument("-s", "--source", required=True, help="a name, names with commas, or 'all'")
    run.add_argument("-q", "--query", required=True)
    run.add_argument("-n", "--max-results", type=int, default=100, help="for each source")
    run.add_argument("--date-from", help="YYYY-MM-DD")
    run.add_argument("--date-to", help="YYYY-MM-DD")
    run.add_argument("-o", "--output", help="one target for all sources")
    sub.add_parser("info", help="show settings and sources")
    sub.add_parser("count", help="count stored documents").add_argument("file")
    args = parser.parse_args(argv)
    if args.command == "info":
        info()
        return 0
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "count":
        if not storage.exists(spark, args.file):
            parser.error(f"no such path: {args.file}")
        print(f"{storage.count_documents(spark, args.file)} documents in {args.file}")
        return 0
    try:
        scrape(spark, args.source, args.query, args.max_results, args.date_from, args.date_to, args.output)
    except plans.UnknownSource as e:
        parser.error(str(e))
    return 0


if __name__ == "__main__":
    sys.exit(main())
