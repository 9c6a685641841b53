"""How often the text stages go through a text, and which texts reach Python."""

import re

import pytest
from pyspark.sql import functions as F

from vellum.functions import text as T
from vellum.plans import registry

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["stage_unicode", "pipeline_skip_gpt_historical", "pipeline_skip_gpt_modern"])
def test_characters_are_repaired_once(spark, name):
    assert plan(registry.queries()[name](spark, SF)).count("translate(") == 1


def test_the_unicode_stage_of_a_table_repairs_once(spark):
    stage = T.text_stages()[0][1]
    df = spark.createDataFrame([(1, "cafÃ© e\u0301 ™", "kept"), (2, None, "kept")], "i int, text string, other string")
    done = stage(df)
    assert plan(done).count("translate(") == 1
    assert done.columns == df.columns
    assert [tuple(r) for r in done.orderBy("i").collect()] == [(1, "café é ™", "kept"), (2, None, "kept")]


def test_marks_next_to_unsettled_ones_stay_out_of_python(spark):
    texts = ["â€™ ™ № €", "plain", "Привет", "e\u0301", "\u212b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    needs = [r[0] for r in df.orderBy("i").select(F.col("t").rlike(T.unsettled_class("NFC"))).collect()]
    assert needs == [False, False, False, True, True]


@pytest.mark.parametrize("form", ["NFC", "NFKD"])
def test_grouped_class_holds_the_same_characters(spark, form):
    told = re.sub(r"\\x\{(\w+)\}", lambda m: re.escape(chr(int(m[1], 16))), T.unsettled_characters(form, 16))
    held = re.compile(f"[{told}]")
    codes = [*range(1, 0xD800), *range(0xE000, 0x30000, 3)]
    df = spark.createDataFrame([(c, chr(c)) for c in codes], "i int, t string")
    got = {r["i"] for r in df.where(F.col("t").rlike(T.unsettled_class(form))).collect()}
    assert got == {c for c in codes if held.match(chr(c))}


def test_lines_are_stripped_once(spark):
    calls = plan(spark.range(1).select(T.drop_garbage_lines(F.col("id").cast("string")).alias("x")))
    assert "regexp_extract_all" not in calls and calls.count("trim(") == 1


def test_every_white_space_is_stripped(spark):
    every = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
    df = spark.createDataFrame([(f"{every}a {every}b{every}",), (every,), ("",), ("\u200ba\u180e",), (None,)], "t string")
    want = [None if r["t"] is None else r["t"].strip() for r in df.collect()]
    assert [r[0] for r in df.select(T.strip(F.col("t"))).collect()] == want
