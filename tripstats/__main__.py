"""Command line: `ingest` messages, `fold` partials into totals, `show` a table.

    spark-submit --py-files tripstats.zip tripstats/__main__.py ingest --store S \\
        --hotel-messages H --flight-messages F --hotels HOTELS --flights FLIGHTS
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tripstats.operators.lookup import Dimension
from tripstats.schemas import DEFAULT_CITY, DEFAULT_THRESHOLDS, FLIGHT_SOURCE, HOTEL_SOURCE
from tripstats.session import build_session
from tripstats.sources.dimensions import read_flights, read_hotels
from tripstats.sources.messages import file_messages
from tripstats.sources.store import Store
from tripstats.streaming import Job, fold_all, start


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser("tripstats", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="messages to partial statistics")
    for option in ("--hotel-messages", "--flight-messages", "--hotels", "--flights"):
        ingest.add_argument(option, required=True, help="folder every executor can reach")
    ingest.add_argument("--city", default=DEFAULT_CITY)
    ingest.add_argument("--any-spelling", action="store_true")
    ingest.add_argument("--interval", help="such as '10 seconds'; default: once over all there is")
    ingest.add_argument("--files-per-batch", type=int)
    ingest.add_argument("--clean-source", choices=("delete", "archive"), help="what becomes of files that were read")
    ingest.add_argument("--archive", help="folder for them")
    ingest.add_argument("--hotel-threshold", type=int, default=DEFAULT_THRESHOLDS[HOTEL_SOURCE])
    ingest.add_argument("--flight-threshold", type=int, default=DEFAULT_THRESHOLDS[FLIGHT_SOURCE])

    fold = commands.add_parser("fold", help="partial statistics to totals")
    fold.add_argument("--max-batches", type=int)
    fold.add_argument("--prune", action="store_true", help="drop what totals have consumed")
    fold.add_argument("--keep-batches", type=int, default=0, help="folded batches that pruning leaves whole")

    show = commands.add_parser("show", help="print a table of totals")
    show.add_argument("table")
    show.add_argument("--company")
    show.add_argument("--limit", type=int, help="rows to print; all without it")

    for command in (ingest, fold, show):
        command.add_argument("--store", required=True)
    return parser


def main(arguments: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session()
    store = Store(spark, args.store)
    if args.command == "ingest":
        job = Job(
            store,
            lambda: Dimension.measured(read_hotels(spark, args.hotels), "id_hotel"),
            lambda: Dimension.measured(read_flights(spark, args.flights), "id_voo"),
            args.city,
            args.any_spelling,
            {HOTEL_SOURCE: args.hotel_threshold, FLIGHT_SOURCE: args.flight_threshold},
        )
        options = {"cleanSource": args.clean_source, "sourceArchiveDir": args.archive}
        options = {name: value for name, value in options.items() if value}
        streams = (
            file_messages(spark, folder, args.files_per_batch, **options)
            for folder in (args.hotel_messages, args.flight_messages)
        )
        start(*streams, job, args.interval).awaitTermination()
    elif args.command == "fold":
        version = fold_all(store, args.max_batches)
        print("nothing to fold" if version is None else f"totals version {version}")
        if args.prune:
            store.prune(keep_batches=args.keep_batches)
    else:
        rows = store.stat(args.table, args.company)
        print(*rows.columns, sep="\t")
        for row in (rows if args.limit is None else rows.limit(args.limit)).toLocalIterator():
            print(*row, sep="\t")


if __name__ == "__main__":
    main()
