"""Reading and writing the file formats of the text pipeline."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CSV_SCHEMA = "Date string, Text string"
#: Files of a table up to which a row for each of them (under 1 kB) is broadcast.
BROADCAST_FILES = 10_000
PROGRESS_SCHEMA = "row_idx long, date string, text string"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="vellum-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Deal rows to all cores where the input comes in fewer pieces than there are cores.

    A small file, or one that cannot be split, is read by one task; work that is heavy for each
    row is then better dealt out. A large input has more pieces than cores and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < 2 * cores else df


def dealt(df: DataFrame, *keys: str, parts: int = 8) -> DataFrame:
    """Deal rows by keys, into so many parts for each piece of the input.

    What is then made of the rows and grouped by these keys, or by more than these, is not dealt out
    again. Parts are small, so that the sorting of a group's many small rows fits in memory.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, parts * df.rdd.getNumPartitions()), *keys)


def with_suffix(df: DataFrame, path: Column, suffix: str) -> DataFrame:
    """Rows whose path ends in a suffix of either case, sorted by path."""
    return df.where(F.lower(path).endswith(suffix)).orderBy(path)


def collect_documents(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """The documents of a folder (one level; suffix as written) or a single file, sorted by path.

    An empty folder or a file of another kind is an error.
    """
    reader = spark.read.format("binaryFile")
    if path.lower().endswith(suffix):
        return reader.load(path)
    found = reader.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "false").load(path).orderBy("path")
    if found.select("path").isEmpty():
        raise ValueError(f"no *{suffix} under {path}")
    return found


def load_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows (row_idx, date, text) of a CSV with the columns Date and Text.

    Quoted fields may span lines; newlines of any kind become LF; a missing or empty text is ''.
    The ordinal counts the records of the files in order. A file whose records may span lines
    is read by one task, so a large table should come in many files.
    """
    read = (
        spark.read.schema(CSV_SCHEMA)
        .options(header=True, multiLine=True, quote='"', escape='"', maxCharsPerColumn=-1, enforceSchema=False)
        .csv(path)
        .select(
            F.col("Date").alias("date"),
            F.regexp_replace(F.coalesce("Text", F.lit("")), "\r\n?", "\n").alias("text"),
            F.col("_metadata.file_path").alias("_file"),
            F.monotonically_increasing_id().alias("_id"),
        )
    )
    # a file of multi-line records is read in one piece, so its ids are consecutive: the ordinal is
    # the distance to its first one, and the records of the files before it
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    of_file = (
        read.groupBy("_file")
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
        .select("_file", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    )
    # one short row for each file: broadcast up to a bound, else left to a join that can be split
    if len(read.inputFiles()) <= BROADCAST_FILES:
        of_file = F.broadcast(of_file)
    return read.join(of_file, "_file").select((F.col("_id") + F.col("_shift")).alias("row_idx"), "date", "text")


def save_csv(rows: DataFrame, path: str, single: bool = False, replace: bool = False) -> None:
    """Write Date and Text, all fields quoted, in order of row_idx; ``single``: as one file.

    Rows are sorted over all files by range, so no task holds them all unless one file is asked
    for. The folder appears whole or not at all; with ``replace`` instead of one already there.
    """
    ordered = rows.orderBy("row_idx") if not single else rows.coalesce(1).sortWithinPartitions("row_idx")
    named = ordered.select(F.col("date").alias("Date"), F.col("text").alias("Text"))
    named.write.mode("overwrite" if replace else "error").options(header=True, quoteAll=True, escape='"').csv(path)


def save_csv_bytes(csv_dir: str, target: str) -> None:
    """Join the parts of a written CSV into one local file whose rows end in CRLF, replaced whole.

    The fields of the parts are quoted throughout, so a newline outside quotes ends a row.
    """
    parts = sorted(p for p in os.listdir(csv_dir) if p.startswith("part-"))
    temporary = f"{target}.tmp"
    with open(temporary, "w", encoding="utf-8", newline="") as out:
        for i, part in enumerate(parts):
            with open(os.path.join(csv_dir, part), encoding="utf-8", newline="") as f:
                quoted, header = False, i > 0
                for line in f:
                    quoted ^= line.count('"') % 2 == 1
                    if header and not quoted:
                        header = False
                        continue
                    out.write(line if quoted else line.rstrip("\n") + "\r\n")
    os.replace(temporary, target)


def save_json(pages: DataFrame, path: str, by: str) -> None:
    """Nested JSON, in a folder for each source."""
    pages.write.partitionBy(by).json(path)


def save_text(rendered: DataFrame, path: str, by: str, text: str = "text") -> None:
    """Rendered page text, in a folder for each source."""
    rendered.select(F.col(text).alias("value"), by).write.partitionBy(by).text(path)


def load_progress(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines progress log; corrupt lines and lines without a key are skipped."""
    return spark.read.schema(PROGRESS_SCHEMA).option("mode", "DROPMALFORMED").json(path).where("row_idx is not null")


def load_prompt(spark: SparkSession, path: str) -> str:
    """A prompt file, stripped; a missing file raises."""
    return spark.read.text(path, wholetext=True).first()["value"].strip()
