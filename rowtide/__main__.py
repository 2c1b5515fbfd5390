"""Command line: ``python -m rowtide <job> …`` or ``spark-submit`` of this file.

  load     CSV files of the shop tables into the lake, once
  show     display shop tables
  insert   one row into a shop table, as column=value
  profile  column types and counts of a Parquet path
  lake     stream the topics of the shop tables into the lake
  monitor  print every change record of the topics, or write them as text
"""

from __future__ import annotations

import argparse
import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from rowtide.functions.typed import quoted
from rowtide.operators.inserts import REASON
from rowtide.operators.profile import display, profile
from rowtide.plans import loads
from rowtide.operators.decode import FAILFAST, PERMISSIVE
from rowtide.plans.lake import QUARANTINE, start_all
from rowtide.plans.monitor import start_printing_monitor, start_text_monitor
from rowtide.session import KAFKA_PACKAGE, S3A_PACKAGE, build_session
from rowtide.sources.connect import s3a_options
from rowtide.sources.files import read_parquet
from rowtide.sources.kafka import kafka_options, kafka_stream
from rowtide.specs import SHOP_TABLES, TableSpec, spec_from_header, topic_of
from rowtide.streaming.lifecycle import await_any, draining, wait_until_ready
from rowtide.streaming.sink import DEFAULT_TRIGGER

# File names of the shop tables.
CSV_FILES = {"albumy": "albumy.csv", "klienci": "klienci.csv", "zamowienia": "zamowienia.csv"}
SEED = "seed"
# Records of a micro-batch at most, so that the first one is not a whole topic.
MAX_OFFSETS = 1_000_000
# How long an interrupted job may take to finish its batch.
DRAIN_SECONDS = 600.0


def stored_spec(table: str) -> TableSpec:
    """The table as it is loaded: integer key, all else text."""
    return spec_from_header(table, SHOP_TABLES[table].columns)


def load(spark: SparkSession, data: str, root: str) -> None:
    files = {table: f"{data}/{name}" for table, name in CSV_FILES.items()}
    done = loads.load_csv_tables(spark, files, root, SEED)
    print("[INFO] All tables loaded." if done else "[INFO] Loaded before, nothing done.")


def show(spark: SparkSession, tables: Sequence[str], root: str, rows: int, out: str | None = None) -> None:
    """Print the first rows in load order; with ``out`` the executors write all of them there as text, a folder per table."""
    for table in tables:
        held = loads.read_in_order(spark, root, stored_spec(table))
        display(held.orderBy(loads.ORDINAL).drop(loads.ORDINAL), table, rows)
        if out:
            in_order = held.repartitionByRange(loads.ORDINAL).sortWithinPartitions(loads.ORDINAL)
            in_order.drop(loads.ORDINAL).write.mode("overwrite").csv(f"{out}/{table}", header=True)
            print(f"[INFO] All rows of {table}: {out}/{table}")


def insert(spark: SparkSession, table: str, values: Mapping[str, str], root: str) -> bool:
    """One typed-in row; False, with a message, when the table refuses it."""
    spec = stored_spec(table)
    unknown = sorted(set(values) - set(spec.columns))
    if unknown:
        print(f"[ERROR] {table} has no columns {unknown}")
        return False
    text = ", ".join(f"{quoted(c)} string" for c in spec.columns)
    row = spark.createDataFrame([tuple(values.get(c) for c in spec.columns)], text)
    refused = loads.insert_rows(spark, root, spec, row, f"insert-{uuid.uuid4().hex}").first()
    print(f"[ERROR] {table}: {refused[REASON]}" if refused else f"[OK] Row added to {table}.")
    return refused is None


def lake(spark: SparkSession, tables: Sequence[str], root: str, source: Mapping, trigger: str, **options) -> None:
    """Run one stream per table until one of them ends; say so once all of them read their topic."""

    def topic_stream(topic: str):
        return kafka_stream(spark, kafka_options(topics=[topic], **source))

    jobs = start_all(topic_stream, [SHOP_TABLES[t] for t in tables], root, trigger=trigger, **options)
    with draining(jobs, DRAIN_SECONDS):
        wait_until_ready(jobs)
        print(f"[INFO] Streams ready: {', '.join(tables)}", flush=True)
        await_any(spark)


def monitor(spark: SparkSession, tables: Sequence[str], source: Mapping, checkpoint: str, trigger: str, out: str | None) -> None:
    """Print every message, or let the executors write them to text files below ``out``."""
    topics = [topic_of(t) for t in tables]
    records = kafka_stream(spark, kafka_options(topics=topics, **source))
    if out:
        job = start_text_monitor(records, topics, out, checkpoint, trigger=trigger)
    else:
        job = start_printing_monitor(records, topics, checkpoint, trigger=trigger)
    with draining([job], DRAIN_SECONDS):
        await_any(spark)


def source_options(args: argparse.Namespace) -> dict:
    """What the stream commands say about their source."""
    return {
        "servers": args.servers,
        "starting": args.starting,
        "fail_on_data_loss": args.fail_on_data_loss,
        "max_offsets_per_trigger": args.max_offsets or None,
        "min_partitions": args.min_partitions,
    }


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rowtide", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = top.add_subparsers(dest="job", required=True)
    names = list(SHOP_TABLES)

    def job(name: str, *, root: bool = True, stream: bool = False, tables: bool = False) -> argparse.ArgumentParser:
        p = jobs.add_parser(name)
        if root:
            p.add_argument("--root", required=True, help="folder of the lake")
        if tables:
            p.add_argument("tables", nargs="*", default=names, metavar="TABLE", help=f"of {', '.join(names)}")
        if stream:
            p.add_argument("--servers", default=os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"))
            p.add_argument("--trigger", default=DEFAULT_TRIGGER)
            p.add_argument("--starting", default="earliest", help="where a new checkpoint starts: earliest, latest or a JSON offset map")
            p.add_argument("--max-offsets", type=int, default=MAX_OFFSETS, help="records of a micro-batch at most; 0 for no bound")
            p.add_argument("--min-partitions", type=int, help="tasks that read the topics, at least")
            p.add_argument("--fail-on-data-loss", action="store_true", help="stop where log segments are gone, instead of going on behind them")
        return p

    job("load").add_argument("--data", default="data", help="folder of the CSV files")
    shown = job("show", tables=True)
    shown.add_argument("--rows", type=int, default=20)
    shown.add_argument("--out", help="folder to which all rows are written")
    put = job("insert")
    put.add_argument("table", choices=names)
    put.add_argument("values", nargs="+", metavar="COLUMN=VALUE")
    job("profile", root=False).add_argument("path")
    sink = job("lake", stream=True, tables=True)
    sink.add_argument("--coerce", action="store_true", help="read text as the declared type")
    sink.add_argument("--keep-meta", action="store_true", help="keep operation, table and delete flag")
    sink.add_argument("--keep-source", action="store_true", help="keep key, topic, partition and offset")
    sink.add_argument("--by-day", action="store_true", help="a partition per day of broker time")
    sink.add_argument("--on-malformed", choices=[PERMISSIVE, FAILFAST, QUARANTINE], default=PERMISSIVE)
    watch = job("monitor", root=False, stream=True, tables=True)
    watch.add_argument("--checkpoint", required=True)
    watch.add_argument("--out", help="folder for text files, instead of printing")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    for table in getattr(args, "tables", ()):
        if table not in SHOP_TABLES:
            print(f"[ERROR] unknown table {table}")
            return 2
    if spark is None:
        packages = [KAFKA_PACKAGE] if hasattr(args, "servers") else []
        if getattr(args, "root", "").startswith("s3a:"):
            packages.append(S3A_PACKAGE)
        conf = s3a_options(os.environ) if S3A_PACKAGE in packages else {}
        spark = build_session(f"rowtide-{args.job}", packages=tuple(packages), conf=conf)
    match args.job:
        case "load":
            load(spark, args.data, args.root)
        case "show":
            show(spark, args.tables, args.root, args.rows, args.out)
        case "insert":
            return 0 if insert(spark, args.table, dict(v.split("=", 1) for v in args.values), args.root) else 1
        case "profile":
            df = read_parquet(spark, args.path)
            profile(df).show(len(df.columns), truncate=False)
        case "lake":
            options = {name: getattr(args, name) for name in ("coerce", "keep_meta", "keep_source", "by_day", "on_malformed")}
            lake(spark, args.tables, args.root, source_options(args), args.trigger, **options)
        case "monitor":
            monitor(spark, args.tables, source_options(args), args.checkpoint, args.trigger, args.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
