"""From documents to sharded training data, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of ``documents``, extra
ones included, whatever they are called. An empty table passes all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import decontam, mixing, nearjoin, quality, sharding
from vellum.llm.common import cut_alone, drop_cut, table


def _packed(docs: DataFrame, *read: str) -> DataFrame:
    """The columns that an operator reads, and the whole row beside, so that none of its new
    columns can replace one of the row's."""
    return docs.select(*read, F.struct(*docs.columns).alias("_row"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the co-trained quality classifier rejects.

    Null and empty texts are judged like others; without labels of both kinds every row stays;
    repeated rows share their fate.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(_packed(docs), model, keep=["_row"], row="_row")
    return scored.where("quality_keep").select("_row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates.

    Texts without words, null or empty, are one group. Rows that agree in id and text are one.
    """
    return nearjoin.keep_one_of_each(docs).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of any benchmark item, one item or more.

    The flag of op7 asks for two items; a document that holds a single whole item leaks it too.
    Null and empty texts stay, as does every row where the test set is empty.
    """
    found = decontam.find_contamination(_packed(docs, "text"), table(spark, sf_dir, "benchmark"), keep=["_row"])
    return found.where("n_hit = 0").select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources takes it: 0 to 3 times.

    Null and empty texts have no words and are never taken; repeated rows are documents of their
    own; a null source is a source.
    """
    return mixing.mix(docs, F.array("source"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal what is left to 40 shards, by id alone: copies of a document share a shard."""
    return sharding.shard_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

#: No stage before the last can be written in SQL: the first is a trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again.

    What a stage has written for itself goes when its result is written, and that result when
    the next one is.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = cut_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
        if before is not None:
            drop_cut(before)
        before = docs
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
