"""Words are put together where their text was dealt to."""

import duckdb
from oracle import compare

from vellum.plans import registry
from vellum.sources import files


def test_texts_are_dealt_once_and_words_not_at_all(spark):
    df = registry.queries()["words_to_lines"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    before_words = plan[plan.index("Generate") :]
    assert plan.count("Exchange") == before_words.count("Exchange") == 1


def test_many_parts_hold_every_row(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id")
    out = files.dealt(df, "k", parts=3)
    assert out.rdd.getNumPartitions() >= 3 * df.rdd.getNumPartitions()
    assert sorted(r["id"] for r in out.collect()) == list(range(1000))


def test_nulls_and_blank_texts_equal_the_sql(spark, tmp_path):
    texts = ["a b\nc  d\n\ne", None, "", "\n", "x y " * 50, "tail\n" * 30, "  "]
    rows = [(i % 11, t, "en", "s") for i, t in enumerate(texts * 3)][:11]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(con.execute(registry.oracle_sql()["words_to_lines"]).fetchall())
    got = registry.queries()["words_to_lines"](spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["text_sha256"], r["word_count"]) for r in got) == want


def test_the_given_tables_equal_the_sql(spark):
    rows, differences = compare(spark, "words_to_lines", "/root/testdata/sf0.01")
    assert rows and not differences
