"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


#: Rows of an Arrow batch that are turned into Python objects at once.
SLICE_ROWS = 512


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where the session names none, as in a local test, a temporary folder is set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        current = tempfile.mkdtemp(prefix="vellum-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def cut(df: DataFrame) -> DataFrame:
    """Write a DataFrame once to the shared folder and read it back.

    The written table ends the lineage: its rows are computed once, survive the loss of an
    executor, and later readers scan only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/vellum/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._cut_path = path
    made = _MADE.get()
    if made is not None:
        made.append(table)
    return table


_MADE: ContextVar[list | None] = ContextVar("made", default=None)


def cut_alone(make: Callable[[], DataFrame]) -> DataFrame:
    """Make a DataFrame, write it as :func:`cut` does, and delete every table written meanwhile.

    What an operator has written for a lazy result is no longer read once the result itself is
    written; it goes as well if the work fails.
    """
    token = _MADE.set([])
    made, after = _MADE.get(), None
    try:
        after = cut(make())
    finally:
        _MADE.reset(token)
        drop_cut(*(t for t in made if t is not after))
    return after


def drop_cut(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more.

    Only for tables whose every reader has itself been written: what is derived lazily from a
    table needs it for as long as it may be computed again.
    """
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._cut_path)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(names, stem: str) -> str:
    """``stem``, with underscores before it until no name starts with it, whatever the case."""
    taken = [n.lower() for n in names]
    while any(n.startswith(stem.lower()) for n in taken):
        stem = "_" + stem
    return stem


def plain(col: Column | str) -> Column:
    """A text column with null as the empty string."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two columns, ``rk_id`` and ``rk_hash``, that name a row by its id and its text.

    Rows with one id and one text share a key, which is harmless wherever what is looked up
    under the key is a function of the text.
    """
    return [
        F.coalesce(F.col(id_col).cast("string"), F.lit("\x00")).alias("rk_id"),
        F.xxhash64(F.col(text_col)).alias("rk_hash"),
    ]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches in parts of a few rows, so that little of one is held as Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_columns(
    df: DataFrame, fn, inputs: dict[str, str], outputs: dict[str, str], keep: list[str] | None = None
) -> DataFrame:
    """Compute columns in Arrow batches, partition by partition.

    ``inputs`` names the arguments of ``fn`` and the column of each; ``fn`` is called for a few
    rows at a time and gets a list for each argument (texts as UTF-8 bytes) and returns a list for each name in ``outputs``, whose types
    are given as DDL. Columns ``keep`` (all, if None) go along; those that ``outputs`` names are
    replaced. An input that is a kept column, or a field of one (``column.field``), is read from
    there and not sent twice.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in outputs]
    own = unused(keep, "_in_")
    sent = {a: c for a, c in inputs.items() if c not in keep and c.partition(".")[0] not in keep}
    read = df.select(*keep, *(F.col(c).alias(own + a) for a, c in sent.items()))
    schema = T.StructType(
        [T.StructField(c, read.schema[c].dataType, True) for c in keep]
        + [T.StructField(c, T._parse_datatype_string(t), True) for c, t in outputs.items()]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            args = {}
            for a in inputs:
                if a in sent:
                    column = batch.column(own + a)
                else:
                    name, _, field = inputs[a].partition(".")
                    column = pc.struct_field(batch.column(name), field) if field else batch.column(name)
                if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                    column = column.cast(pa.large_binary())
                args[a] = column.to_pylist()
            made = fn(**args)
            columns = [batch.column(c).cast(arrow.field(c).type) for c in keep]
            columns += [pa.array(made[c], arrow.field(c).type) for c in outputs]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return read.mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, where=None) -> DataFrame:
    """Up to ``most`` labelled documents of each class, the first in a hashed order of their ids.

    Only ids and labels are ordered; the two small lists, whose length is the bound, then meet
    the documents. Where an id is repeated, the row with the smallest hash stands for it, so the
    sample is the same in every run.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    if where is not None:
        usable = usable.where(where)
    usable = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    picked = [
        usable.where(F.col("_label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for y in (0, 1)
    ]
    found = docs.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    rest = [c for c in found.columns if c != "doc_id"]
    one = found.groupBy("doc_id").agg(F.min_by(F.struct(*rest), F.xxhash64(*rest)).alias("_one"))
    return one.select("doc_id", *(F.col(f"_one.{c}").alias(c) for c in rest))


def held_out(id_col: str = "doc_id", folds: int = 5):
    """True for the rows whose crc32 of the id as text is divisible by ``folds``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))
