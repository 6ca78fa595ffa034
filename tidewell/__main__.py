"""Command line: publish and clean up landed batches, run the jobs."""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

from .logs import configure
from .settings import settings


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidewell", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    publish = commands.add_parser("publish", help="send ready batches to a folder")
    publish.add_argument("destination", type=Path)
    publish.add_argument("--once", action="store_true", help="one cycle, then stop")
    publish.add_argument("--dry-run", action="store_true", help="validate only")
    cleanup = commands.add_parser("cleanup", help="list or remove old staging and archived folders")
    cleanup.add_argument("--apply", action="store_true")
    for name, text in (("ingest", "landed batches into raw_events"), ("validate", "raw events through the contract"), ("windows", "refresh the post windows")):
        job = commands.add_parser(name, help=text)
        job.add_argument("tables", help="the store's folder")
        if name == "ingest":
            job.add_argument("ready", help="the folder of committed batches")
            job.add_argument("--fair", action="store_true", help="take batches in turn from each log partition")
        if name == "validate":
            job.add_argument("--rebuild", action="store_true")
    return parser.parse_args(argv)


class FolderRemote:
    """A plain folder as a publishing destination."""

    def __init__(self, root: Path):
        self.root = root

    def read(self, path: str) -> bytes | None:
        file = self.root / path.lstrip("/")
        return file.read_bytes() if file.exists() else None

    def write(self, path: str, body: bytes, overwrite: bool) -> None:
        file = self.root / path.lstrip("/")
        file.parent.mkdir(parents=True, exist_ok=True)
        with open(file, "wb" if overwrite else "xb") as f:
            f.write(body)


def main(argv: list[str] | None = None) -> int:
    args, own = _arguments(argv), settings()
    configure(own.log_level, sys.stderr)
    if args.command in ("publish", "cleanup"):
        from .sources.landing import Landing, Publisher, single_writer

        landing = Landing(own.landing_root, min_free_mb=own.min_free_mb)
        if args.command == "cleanup":
            for path in landing.cleanup(apply=args.apply):
                print(path)
            return 0
        with single_writer(landing.root / ".publisher.lock"):
            publisher = Publisher(landing, FolderRemote(args.destination), "", own.uploads_per_cycle, args.dry_run)
            while True:
                for name in publisher.cycle():
                    print(name)
                if args.once:
                    return 0
                time.sleep(own.upload_poll_seconds)
    from pyspark.sql import SparkSession

    from .plans import jobs
    from .plans.store import Store

    spark = SparkSession.builder.appName("tidewell").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    store = Store(spark, args.tables)
    if args.command == "ingest":
        print(jobs.ingest(store, args.ready, topic=own.log_topic, fair=args.fair))
    elif args.command == "validate":
        jobs.validate_contract(store, rebuild=args.rebuild)
    else:
        print(jobs.refresh_windows(store))
    return 0


if __name__ == "__main__":
    sys.exit(main())
