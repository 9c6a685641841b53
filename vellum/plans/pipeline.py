"""The text pipeline as a whole: load, resume, correct, write."""

from __future__ import annotations

import argparse
import logging
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions.text import text_stages
from vellum.operators import enrich, recover
from vellum.sources import files
from vellum.sources.storage import Storage
from vellum.streaming import resume

log = logging.getLogger(__name__)

RULES_VERSION = "2"
ROWS_SCHEMA = "row_idx long, date string, text string, original_len int, error string"


def build_stages(
    era: str = "historical", skip_regex: bool = False, make_enricher: Callable[[], enrich.Enricher] | None = None,
    partitions: int | None = None, threads: int = 1,
) -> list[tuple[str, resume.Stage]]:
    """Unicode always; the era's rules unless skipped; an enricher if there is one.

    Nothing of an enricher is imported or called where none is given.
    """
    stages = text_stages(era, skip_regex)
    if make_enricher is not None:
        stages.append(("enrich", lambda df: enrich.enrich_texts(df, make_enricher, partitions=partitions, threads=threads)))
    return stages


def batches(start: int, end: int, every: int) -> list[tuple[int, int]]:
    """Ranges of rows that are committed together; all in one where ``every`` is 0."""
    return [(a, min(a + every, end)) for a in range(start, end, every)] if every > 0 else [(start, end)]


def progress_line(done: int, total: int, seconds: float, before: int, after: int) -> str:
    """What has been done, by how much lengths changed, how fast, and how long the rest will take."""
    rate = done / seconds if seconds > 0 else 0.0
    left = (total - done) / rate if rate > 0 else 0.0
    return f"[{done}/{total}] {before:,} -> {after:,} (delta: {before - after:+,}) | {rate:.1f} rows/s | ETA: {left:.0f}s"


def run(
    spark: SparkSession, source: str, output: str, work: str, era: str = "historical", skip_regex: bool = False,
    rows: str | None = None, make_enricher=None, fresh: bool = False, snapshots: resume.SnapshotSink | None = None,
    checkpoint: int = 0, snapshot_hours: float = 12.0, partitions: int | None = None, threads: int = 1, model: str = "none",
    keep_progress: bool = False, clock: Callable[[], float] = time.monotonic,
) -> DataFrame:
    """Correct a Date,Text CSV and return the written rows.

    Rows that an earlier run with the same settings over the same content committed stay done.
    With ``checkpoint`` so many rows are committed at a time, and after each time the output
    holds what is done so far; without, all pending rows are one commit. Snapshots of the output
    are pushed when an interval is over, and at the end. Progress goes when all is written,
    unless it is to be kept.
    """
    found = files.load_csv(spark, source)
    total, content = found.agg(
        F.count("*"), F.coalesce(F.sum(F.xxhash64("row_idx", "date", "text").cast("decimal(38,0)")), F.lit(0))
    ).first()
    start, end = recover.parse_row_range(rows, total) if rows else (0, None)
    settings = recover.run_config_hash(
        source, era, skip_regex, make_enricher is None, model, start, end, RULES_VERSION, str(total), str(content)
    )
    state, progress = resume.RunState(spark, work), f"{work.rstrip('/')}/rows"
    if fresh:
        state.cleanup()
    state.valid(settings)  # wipes what other settings have left
    state.save(settings, total, start, end)
    committed = lambda: spark.read.schema(ROWS_SCHEMA).parquet(progress)
    spark.createDataFrame([], ROWS_SCHEMA).write.mode("append").parquet(progress)
    wanted = recover.select_rows(found, start, end)
    stages = build_stages(era, skip_regex, make_enricher, partitions, threads)
    schedule = resume.SnapshotSchedule(snapshots, output, snapshot_hours) if snapshots is not None else None
    pending = recover.pending(wanted, committed())
    n_pending, began, done = pending.count(), clock(), 0
    if schedule is not None:
        schedule.tick(began)
    for first, last in batches(start, total if end is None else end, checkpoint):
        part = recover.pending(recover.select_rows(wanted, first, last), committed())
        fixed = resume.apply_stages(files.spread(part), stages)
        if "error" not in fixed.columns:
            fixed = fixed.withColumn("error", F.lit(None).cast("string"))
        fixed.select("row_idx", "date", "text", "original_len", "error").write.mode("append").parquet(progress)
        if checkpoint:
            now = committed().where(F.col("row_idx").between(first, last - 1))
            n, before, after = now.agg(F.count("*"), F.sum("original_len"), F.sum(F.length("text"))).first()
            done += n
            log.info(progress_line(min(done, n_pending), n_pending, clock() - began, before or 0, after or 0))
            files.save_csv(recover.completed_texts(wanted, committed()), output, replace=True)
        if schedule is not None:
            schedule.tick(clock())
    files.save_csv(recover.merge_completed(wanted, committed()), output, replace=True)
    failed = committed().where("error is not null").count()
    log.info("%s rows, %s failed, %.1f s", total, failed, clock() - began)
    if schedule is not None:
        schedule.stop()
    if not keep_progress:
        state.cleanup()
    return files.load_csv(spark, output)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="vellum", description="Correct recognised text in a Date,Text CSV.")
    out.add_argument("--input", required=True)
    out.add_argument("--output")
    out.add_argument("--work", help="where progress is kept")
    out.add_argument("--era", choices=["general", "historical", "modern"], default="historical")
    out.add_argument("--skip-regex", action="store_true")
    out.add_argument("--rows", help="a-b (end excluded) or a single row, from 0")
    out.add_argument("--fresh", action="store_true", help="forget earlier progress")
    out.add_argument("--keep-progress", action="store_true", help="leave progress in place when all is written")
    out.add_argument("--checkpoint", type=int, default=0, help="rows that are committed at a time; 0: all at once")
    out.add_argument("--skip-enrich", action="store_true", help="do not ask a service to correct what rules cannot")
    out.add_argument("--endpoint", help="address of a chat-completion service")
    out.add_argument("--api-key", help="its key; else the environment's or that of a .env file")
    out.add_argument("--model", default="gpt-4o-mini")
    out.add_argument("--prompt", help="a file with the instructions to the service")
    out.add_argument("--rpm", type=float, default=10_000, help="requests a minute, over all workers")
    out.add_argument("--workers", type=int, default=4, help="requests under way in a partition")
    out.add_argument("--partitions", type=int, help="partitions that ask at a time")
    out.add_argument("--snapshots", help="a folder for versioned copies of the output")
    out.add_argument("--hub-repository", help="a dataset repository of the hub for snapshots, instead of a folder")
    out.add_argument("--hub-token", help="its token; else the environment's or that of a .env file")
    out.add_argument("--snapshot-interval", type=float, default=12.0, help="hours between snapshots")
    return out


def enricher_of(spark: SparkSession, args: argparse.Namespace, environment, send=None) -> Callable[[], enrich.Enricher] | None:
    """The enricher that the arguments ask for; None where none is asked for or can be had."""
    if args.skip_enrich:
        return None
    from vellum.operators import client

    storage, more = Storage(spark), {}
    if args.prompt:
        if not storage.exists(args.prompt):
            log.warning("no enrichment: no prompt at %s", args.prompt)
            return None
        more["prompt"] = files.load_prompt(spark, args.prompt)
    settings = client.settings_or_none(args.api_key, args.endpoint, environment, _dotenv(), model=args.model, per_minute=args.rpm, **more)
    partitions = args.partitions or spark.sparkContext.defaultParallelism
    return None if settings is None else client.factory(settings, partitions, **({"send": send} if send else {}))


def _dotenv() -> dict[str, str]:
    from vellum.operators import client

    if not os.path.isfile(".env"):
        return {}
    with open(".env", encoding="utf-8") as f:
        return client.read_dotenv(f.read())


def snapshots_of(spark: SparkSession, args: argparse.Namespace, environment, api=None) -> resume.SnapshotSink | None:
    """The snapshots that the arguments ask for; none, with a warning, where the hub's token lacks."""
    from vellum.operators import client

    if args.hub_repository:
        token = client.chosen(args.hub_token, client.TOKEN_VARIABLE, environment, _dotenv())
        if token:
            return resume.HubSnapshots(spark, args.hub_repository, token, api)
        log.warning("no snapshots: give a token, or set %s", client.TOKEN_VARIABLE)
    return resume.FolderSnapshots(spark, args.snapshots) if args.snapshots else None


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    base = args.input.removesuffix(".csv")
    spark = SparkSession.builder.appName("vellum").getOrCreate()
    written = run(
        spark, args.input, args.output or f"{base}_corrected", args.work or f"{base}_progress", args.era, args.skip_regex, args.rows,
        make_enricher=enricher_of(spark, args, os.environ), fresh=args.fresh, checkpoint=args.checkpoint,
        snapshots=snapshots_of(spark, args, os.environ), snapshot_hours=args.snapshot_interval,
        partitions=args.partitions, threads=args.workers, model=args.model, keep_progress=args.keep_progress,
    )
    print(f"{written.count()} rows")
