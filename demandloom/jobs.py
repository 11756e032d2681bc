"""Command line for spark-submit: ``refresh``, ``daily``, ``train`` and ``predict``."""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict

from demandloom import settings as s
from demandloom.plans.daily import refresh_daily
from demandloom.plans.dataset import build_dataset
from demandloom.plans.modelbook import ModelBook
from demandloom.plans.refresh import refresh
from demandloom.plans.select import select
from demandloom.plans.serve import serve
from demandloom.plans.train import train
from demandloom.session import build_session


def _pair(text: str) -> tuple[str, str]:
    key, separator, value = text.partition("=")
    if not separator:
        raise argparse.ArgumentTypeError(f"{text!r} is not key=value")
    return key, value


def main(argv: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="demandloom")
    parser.add_argument("job", choices=["refresh", "daily", "train", "predict"])
    parser.add_argument("--root", help="folder of all tables and models, on shared storage")
    parser.add_argument("--database", help="catalog database of the tables instead of --root")
    parser.add_argument("--artifacts", help="folder of models and data sets (with --database)")
    parser.add_argument("--fmt", default="parquet", help="table format")
    parser.add_argument("--csv", help="transaction feed (refresh, daily)")
    parser.add_argument("--lean", action="store_true", help="refresh without the inner layers")
    parser.add_argument(
        "--exact",
        nargs="?",
        const=True,
        default=False,
        choices=["doubles"],
        help="sums and metrics in hundredths, or exact for any doubles",
    )
    parser.add_argument("--quarantine", action="store_true", help="keep malformed rows of the feed")
    parser.add_argument("--buckets", type=int, help="buckets on the key (with --database)")
    parser.add_argument("--tag", type=_pair, action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--description", help="of the feature table (with --database)")
    parser.add_argument("--threshold", type=float, default=s.TEST_R2_THRESHOLD)
    parser.add_argument("--master", help="only for local runs")
    args = parser.parse_args(argv)
    if bool(args.root) == bool(args.database):
        parser.error("give either --root or --database")
    if args.job == "daily" and not args.root:
        parser.error("daily needs --root")
    if args.database and args.job != "refresh" and not args.artifacts:
        parser.error("--database needs --artifacts for models and data sets")
    if args.job in ("refresh", "daily") and not args.csv:
        parser.error(f"{args.job} needs --csv")

    spark = build_session(master=args.master)
    tables = s.Tables.under(args.root) if args.root else s.Tables.in_database(args.database)
    lifecycle = s.Lifecycle(threshold=args.threshold, tags=dict(args.tag))
    if args.job == "refresh":
        result = refresh(
            spark,
            args.csv,
            tables,
            args.fmt,
            args.buckets,
            dict(args.tag),
            args.lean,
            args.exact,
            args.description,
            args.quarantine,
        )
    elif args.job == "daily":
        result = refresh_daily(spark, args.csv, tables, args.exact)
    else:
        book = ModelBook(spark, tables.models, args.artifacts)
        if args.job == "train":
            data = build_dataset(spark, tables, args.fmt, book.new_dataset_path())
            result = {"run_id": train(data, book, lifecycle, exact=args.exact)}
            book.keep_dataset(data)
        else:
            # The rows and cut points of the training run, whatever was refreshed since.
            with book.dataset() as data:
                selection = select(data, book, lifecycle, args.exact)
                # A rejected candidate sets off no comparison of an older challenger.
                registered = selection.status == "registered"
                outcome = serve(data, book, tables, lifecycle, args.fmt, registered, args.exact)
                result = {"selection": asdict(selection), "outcome": asdict(outcome)}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
