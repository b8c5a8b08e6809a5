"""Command line: ``python -m barloom <command> …``; ``--help`` lists what each command takes."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import schemas as S
from barloom.plans import serve
from barloom.plans.load import backfill, load_incremental, seed_bars
from barloom.plans.publish import audit_stored, refresh_marts, run_gated, run_summary
from barloom.session import build_session
from barloom.sources import export, footers, payloads, tables
from barloom.streaming.ingest import start_ingest

#: For each command the options it needs, and others it can take. Of ``payloads`` and ``landing`` one is needed where both may be given.
COMMANDS = {
    "land": (["payloads", "landing", "run_date"], []),
    "objects": (["payloads", "bucket", "run_date"], ["source"]),
    "seed": (["root", "bars"], []),
    "load": (["root"], ["payloads", "landing", "run_date", "until", "symbol", "strict"]),
    "gated": (["root"], ["payloads", "landing", "run_date", "until", "symbol", "strict", "full"]),
    "backfill": (["root", "start", "end"], ["payloads", "landing", "run_date", "until", "symbol", "strict"]),
    "stream": (["root", "landing", "checkpoint"], ["strict"]),
    "marts": (["root"], ["full"]),
    "delete": (["root"], ["symbol", "start", "end"]),
    "compact": (["root"], []),
    "export": (["root", "out"], ["symbol"]),
    "changes": (["root", "symbol"], ["limit"]),
    "audit": (["root"], []),
    "profile": (["root"], ["limit"]),
}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    day = dt.date.fromisoformat
    parser = argparse.ArgumentParser(prog="barloom")
    parser.add_argument("command", choices=list(COMMANDS))
    parser.add_argument("--root", help="folder of the tables")
    parser.add_argument("--payloads", help="folder or glob of raw payload files")
    parser.add_argument("--landing", help="folder of landed payloads, by run date and symbol")
    parser.add_argument("--run-date", type=day, help="run date to land, or the first (or only) one to load")
    parser.add_argument("--until", type=day, help="last run date to load")
    parser.add_argument("--bucket", help="root of the object store")
    parser.add_argument("--source", default=S.DEFAULT_SOURCE)
    parser.add_argument("--bars", help="CSV files of bars with a header, without source")
    parser.add_argument("--checkpoint", help="folder of the stream's progress and marks")
    parser.add_argument("--start", type=day)
    parser.add_argument("--end", type=day)
    parser.add_argument("--symbol", help="one symbol; all when left out")
    parser.add_argument("--out", help="snapshot folder of an export")
    parser.add_argument("--limit", type=int, default=30)
    parser.add_argument("--strict", action="store_true", help="fail on entries that cannot be typed")
    parser.add_argument("--full", action="store_true", help="check or rebuild all days, not only changed ones")
    args = parser.parse_args(argv)
    needed, used = COMMANDS[args.command]
    given = {name for name, value in vars(args).items() if name != "command" and value != parser.get_default(name)}
    for name in needed:
        if name not in given:
            parser.error(f"{args.command} requires --{name.replace('_', '-')}")
    for name in sorted(given - {*needed, *used}):
        parser.error(f"{args.command} has no use for --{name.replace('_', '-')}")
    if "payloads" in used and len(given & {"payloads", "landing"}) != 1:
        parser.error(f"{args.command} requires --payloads or --landing")
    if given & {"run_date", "until"} and "payloads" in used and "landing" not in given:
        parser.error("run dates are those of a landing folder")
    if args.command == "delete" and not given & {"symbol", "start", "end"}:
        parser.error("delete requires --symbol, --start or --end")
    return args


def _payloads(spark, args):
    if args.landing is None:
        return payloads.read_payload_files(spark, args.payloads)
    return payloads.read_landing(spark, args.landing, args.run_date, args.until or args.run_date)


def _landed(spark, args):
    return payloads.read_payload_files(spark, args.payloads).withColumn("run_date", F.lit(args.run_date))


def _delete(spark, args) -> tables.Deleted:
    hit = F.lit(True)
    if args.symbol is not None:
        hit = hit & (F.col("symbol") == args.symbol.strip().upper())
    day = F.to_date("ts")
    if args.start is not None:
        hit = hit & (day >= F.lit(args.start))
    if args.end is not None:
        hit = hit & (day <= F.lit(args.end))
    return tables.delete(spark, args.root, tables.BARS, hit)


def main(argv: list[str] | None = None) -> int:
    """Exit code: 1 for a gated run that failed."""
    args = arguments(argv)
    spark = build_session()
    symbols = [args.symbol] if args.symbol else None
    if args.command == "land":
        payloads.land_payloads(_landed(spark, args), args.landing)
    elif args.command == "objects":
        rows = _landed(spark, args).select("value", payloads.payload_symbol().alias("symbol"), F.col("run_date").alias("date"))
        print(payloads.land_in_object_store(rows, "true", args.bucket, args.source))
    elif args.command == "seed":
        schema = T.StructType([f for f in S.BARS.fields if f.name != "source"])
        print(seed_bars(spark, args.root, spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(args.bars)))
    elif args.command == "stream":
        start_ingest(spark, args.landing, args.root, args.checkpoint, args.strict).awaitTermination()
    elif args.command == "marts":
        print(f"days rebuilt: {len(refresh_marts(spark, args.root, args.full))}")
    elif args.command == "delete":
        print(_delete(spark, args))
    elif args.command == "compact":
        print(f"days written: {len(tables.compact(spark, args.root, tables.BARS))}")
    elif args.command == "export":
        print(export.export_snapshot(tables.read_table(spark, args.root, tables.BARS), args.out, args.symbol))
    elif args.command == "changes":
        serve.price_changes(spark, args.root, args.symbol, args.limit).show(args.limit, truncate=False)
    elif args.command == "audit":
        audit_stored(spark, args.root).orderBy("seq").show(truncate=False)
    elif args.command == "profile":
        footers.day_profile(spark, args.root, tables.BARS).orderBy(F.desc(tables.DAY)).show(args.limit, truncate=False)
    elif args.command == "load":
        print(load_incremental(spark, args.root, _payloads(spark, args), args.strict, symbols=symbols))
    elif args.command == "backfill":
        print(backfill(spark, args.root, _payloads(spark, args), args.start, args.end, symbols, args.strict))
    else:
        run = run_gated(spark, args.root, _payloads(spark, args), strict=args.strict, symbols=symbols, full=args.full)
        print(run_summary(spark, run))
        return 0 if run.status == "success" else 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
