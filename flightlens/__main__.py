"""Command line: ``spark-submit`` or ``python -m flightlens``.

    ingest   landed payload files -> raw table
    compact  small loads of the raw table -> larger ones
    refresh  raw table -> the three published tables
    update   new loads of the raw table -> stored monthly states
    sweep    removes replaced runs, loads and states
"""

from __future__ import annotations

import argparse
from datetime import UTC, datetime, timedelta

from flightlens.plans.refresh import refresh, sweep_runs
from flightlens.plans.states import States
from flightlens.session import build_session
from flightlens.sources.publish import forget_runs
from flightlens.sources.raw import column_bounds, jdbc_options, partition_options, read_jdbc
from flightlens.sources.rawstore import SMALL_LOAD, RawStore, read_raw
from flightlens.streaming.landing import land_payloads


def _instant(text: str) -> datetime:
    moment = datetime.fromisoformat(text)
    return moment if moment.tzinfo else moment.replace(tzinfo=UTC)


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="flightlens", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest")
    ingest.add_argument("--landed", required=True)
    ingest.add_argument("--raw", required=True)
    ingest.add_argument("--rejects", required=True)
    ingest.add_argument("--checkpoints", required=True)
    ingest.add_argument("--one-per-line", action="store_true")
    ingest.add_argument("--cap", type=int, help="records loaded of each payload; the rest is rejected (default: all)")
    ingest.add_argument("--dedupe", metavar="TIME", help="leave out reports that landed within this time before, such as '2 days'")

    ingest.add_argument("--database", help="also keep the raw table under its name in this database")

    compact = commands.add_parser("compact")
    compact.add_argument("--raw", required=True)
    compact.add_argument("--small", type=int, default=SMALL_LOAD, help="rows below which a load is joined with others")

    renew = commands.add_parser("refresh")
    source = renew.add_mutually_exclusive_group(required=True)
    source.add_argument("--raw", help="Parquet folder")
    source.add_argument("--jdbc-url")
    renew.add_argument("--jdbc-table", default="raw_flights")
    renew.add_argument("--jdbc-driver")
    renew.add_argument("--jdbc-user")
    renew.add_argument("--jdbc-password-file")
    renew.add_argument("--jdbc-partitions", type=int, default=64)
    renew.add_argument("--out", required=True)
    renew.add_argument("--cutoff", type=_instant)
    renew.add_argument("--dedupe", action="store_true")
    renew.add_argument("--database", help="also keep the tables under their names in this database")

    sweep = commands.add_parser("sweep")
    sweep.add_argument("--out", help="folder of published runs")
    sweep.add_argument("--keep", type=int, default=3, help="finished runs that stay")
    sweep.add_argument("--raw", help="raw table whose replaced loads go")
    sweep.add_argument("--states", help="states whose replaced versions go")
    sweep.add_argument("--database", help="database that forgets the removed runs")
    sweep.add_argument("--idle-hours", type=float, default=48, help="at rest for so long, a folder has no reader or writer")

    update = commands.add_parser("update")
    update.add_argument("--raw", required=True)
    update.add_argument("--states", required=True)

    args = parser.parse_args()
    if args.command == "refresh" and args.jdbc_url and args.cutoff is None:
        parser.error("a database needs --cutoff: bounds and rows are one snapshot only with it")
    return args


def main() -> None:
    args = _arguments()
    spark = build_session()
    try:
        if args.command == "ingest":
            landing = land_payloads(
                spark,
                args.landed,
                args.raw,
                args.rejects,
                args.checkpoints,
                one_per_line=args.one_per_line,
                cap=args.cap,
                dedupe=args.dedupe,
            )
            if args.database:
                landing.store.create_view(args.database)
            print(landing.wait())
            if args.database:
                landing.store.create_view(args.database)
            return
        if args.command == "compact":
            entry = RawStore(spark, args.raw).compact(args.small)
            print(f"{entry['loaded']} rows of {len(entry['replaces'])} loads joined" if entry else "nothing to join")
            return
        if args.command == "sweep":
            idle, gone = timedelta(hours=args.idle_hours), []
            if args.out:
                gone += sweep_runs(spark, args.out, args.keep, idle)
                if args.database:
                    forget_runs(spark, args.database, gone)
            if args.raw:
                gone += RawStore(spark, args.raw).sweep(idle)
            if args.states:
                gone += States(spark, args.states).sweep(idle)
            print(f"{len(gone)} folders removed")
            return
        if args.command == "update":
            store = RawStore(spark, args.raw)
            # A plain folder has no log: there the time of arrival tells what is new.
            source = store if store.exists() else read_raw(spark, args.raw)
            months = States(spark, args.states).update(source)
            print(f"states renewed: {', '.join(months) or 'none'}")
            return
        if args.raw:
            raw = read_raw(spark, args.raw, args.cutoff)
        else:
            password = None
            if args.jdbc_password_file:
                with open(args.jdbc_password_file) as secret:
                    password = secret.read().strip()
            options = jdbc_options(
                args.jdbc_url, args.jdbc_table, args.jdbc_driver, args.jdbc_user, password
            )
            lower, upper = column_bounds(spark, options)
            raw = read_jdbc(spark, options, partition_options(lower, upper, args.jdbc_partitions))
        result = refresh(raw, args.out, args.cutoff, args.dedupe, database=args.database)
        for table, rows in result.written.items():
            print(f"{table}: {rows} rows written, {result.quarantined[table]} quarantined")
        for column, values in result.left_out.items():
            if values:
                print(f"{column}: {values} values left out of the means")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
