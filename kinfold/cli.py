"""Command line: version, sources, pipeline, sanctions, media, resolve, api."""

from __future__ import annotations

import argparse
import json

from kinfold import __version__
from kinfold.config import ResolverOptions, Settings
from kinfold.plans.jobs import Registry, orchestrate, run_sources


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kinfold")
    sub = top.add_subparsers(dest="command", required=True)
    sub.add_parser("version")
    p = sub.add_parser("sources")
    for flag in ("sanctions", "media", "all"):
        p.add_argument(f"--{flag}", action="store_true")
    p = sub.add_parser("pipeline")
    p.add_argument("-p", "--parallel", type=int, default=0)
    for flag in ("sanctions", "media", "resolve"):
        p.add_argument(f"--no-{flag}", action="store_true")
    p = sub.add_parser("sanctions")
    p.add_argument("-p", "--parallel", type=int, default=0)
    sub.add_parser("media")
    sub.add_parser("resolve")
    p = sub.add_parser("api")
    p.add_argument("--host", default="0.0.0.0")
    p.add_argument("--port", type=int, default=8000)
    p.add_argument("--prefix", default="", help="path before the routes /meta, /file, /delta/meta and /delta/file")
    p.add_argument("--reload", action="store_true", help="accepted; the server reads its files anew for each request")
    return top


def _resolver(settings: Settings):
    def run():
        from pyspark.sql import SparkSession

        from kinfold.operators.components import clean
        from kinfold.plans.resolve import run_folder

        spark = SparkSession.builder.appName(settings.PROJECT_NAME).config("spark.sql.session.timeZone", "UTC").getOrCreate()
        try:
            return run_folder(spark, settings.processed, settings.output, ResolverOptions(provider=settings.PROVIDER_NAME))
        finally:
            clean(spark)

    return run


def main(argv: list[str] | None = None, registry: Registry | None = None, settings: Settings | None = None, resolver=None) -> object:
    """Run a command; prints its result as JSON and returns it."""
    args = parser().parse_args(argv)
    settings, registry = settings or Settings.from_env(), registry or Registry()
    resolver = resolver or _resolver(settings)
    limit = getattr(args, "parallel", 0) or settings.SANCTIONS_CONCURRENCY
    if args.command == "version":
        got: object = {"project": settings.PROJECT_NAME, "version": __version__}
    elif args.command == "sources":
        got = registry.rows(args.sanctions or args.all, args.media or args.all)
    elif args.command == "pipeline":
        got = orchestrate(registry, resolver, limit, not args.no_sanctions, not args.no_media, not args.no_resolve)
    elif args.command == "sanctions":
        got = run_sources(registry.sanctions, limit)
    elif args.command == "media":
        got = run_sources({"media": registry.media_job} if registry.media_job else {}, 1)
    elif args.command == "resolve":
        got = resolver()
    else:
        from kinfold.service import ExportService, server

        server(ExportService(settings.output_dir, settings.PROVIDER_NAME), args.host, args.port, args.prefix).serve_forever()
        got = None
    print(json.dumps(got, default=str, ensure_ascii=False))
    return got


if __name__ == "__main__":
    main()
