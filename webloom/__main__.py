"""Command line: python -m webloom build|gather; --help lists what each takes."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import SparkSession

from .functions.values import REASON_PAUSE


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="webloom")
    tasks = parser.add_subparsers(dest="task", required=True)
    build = tasks.add_parser("build", help="folders of sites to training examples")
    build.add_argument("root")
    build.add_argument("jsonl")
    build.add_argument("--folders", help="write examples as folders here, too; it is emptied first")
    build.add_argument("--mode", choices=("append", "overwrite", "incremental"), default="incremental")
    build.add_argument("--no-full-page", dest="full_page", action="store_false")
    build.add_argument("--start", type=int, default=1, help="the first site, by name, from 1")
    build.add_argument("--ask", metavar="MODULE:FUNCTION", help="gives a model's answer to a prompt, for the reasoning of full pages")
    build.add_argument("--pause", type=float, default=REASON_PAUSE, help="seconds after each answer")
    gather = tasks.add_parser("gather", help="a list of sites to folders of sites")
    gather.add_argument("target")
    gather.add_argument("--base", required=True, help="where the list's relative urls start")
    gather.add_argument("--list", dest="listing", required=True, metavar="MODULE:FUNCTION", help="gives a page of the list for (start, size)")
    gather.add_argument("--fetch", required=True, metavar="MODULE:FUNCTION", help="gives a Reply for a url")
    gather.add_argument("--start", type=int, default=0)
    gather.add_argument("--size", type=int, default=20)
    gather.add_argument("--most", type=int, help="sites at most")
    gather.add_argument("--again", action="store_true", help="fetch what is there, too")
    gather.add_argument("--fresh", action="store_true", help="empty the target first")
    gather.add_argument("--pause", type=float, default=2.0)
    return parser


def named(place: str | None) -> Callable | None:
    """The function that module:function names."""
    if place is None:
        return None
    module, _, function = place.partition(":")
    return getattr(import_module(module), function)


def main(given: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, int]:
    asked = vars(arguments().parse_args(given))
    spark = spark or SparkSession.builder.appName("webloom").getOrCreate()
    if asked.pop("task") == "build":
        from .plans.build import counted_build

        counts = counted_build(spark, asked.pop("root"), asked.pop("jsonl"), ask=named(asked.pop("ask")), **asked)._asdict()
        done = counts.pop("written") | counts
    else:
        from .plans.gather import gather
        from .sources.paged import PagedList

        spark.dataSource.register(PagedList)
        fetch = named(asked.pop("fetch"))
        options = {"fetch": asked.pop("listing"), "start": asked.pop("start"), "size": asked.pop("size"), "pause": asked["pause"]}
        listing = spark.read.format("paged").options(**options).load()
        done = gather(spark, listing, asked.pop("target"), fetch, asked.pop("base"), **asked)
    print(json.dumps(done))
    return done


if __name__ == "__main__":
    main()
