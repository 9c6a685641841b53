import pytest
from pyspark.sql import functions as F

from vellum.llm import urls

CASES = [
    ("http://A.Example.ORG/es/x?y=/z#q", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("http://a.org/x", "a.org", "/x", "org/", "allow"),
    ("http://org/x", "org", "/x", "org/", "allow"),
    ("http://aorg/x", "aorg", "/x", None, None),
    ("http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    ("http://x.com/fr/1", "x.com", "/fr/1", "com/fr/", "allow"),
    ("http://x.org", "x.org", "", None, None),
    ("http://x.com?a=/fr/", "x.com", "", None, None),
    ("ftp://Ünï.com/ÄB#x", "Ünï.com", "/ÄB", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None),
    ("no scheme.org/x", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("http://😀.org/\n?x", "😀.org", "/\n", "org/", "allow"),
]


@pytest.fixture(scope="module")
def model():
    return urls.train()


def test_hosts_paths_and_rules(spark, model):
    df = spark.createDataFrame([(i, c[0], "old") for i, c in enumerate(CASES)], "page_id long, url string, rule string")
    got = {r["page_id"]: r for r in urls.judge_urls(df, model=model).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")


def test_score_is_that_of_the_hashed_grams(spark, model):
    df = spark.createDataFrame([(c[0],) for c in CASES] + [("http://" + "win" * 4000 + "/" + "a" * 9000,)], "url string")
    for r in urls.judge_urls(df, model=model).collect():
        buckets = urls._bucket_list(r["host"], "host") + urls._bucket_list(r["path"], "path")
        assert r["score"] == model.bias + sum(model.weights[b] for b in buckets)


def test_the_model_learns_its_table_and_unseen_hosts(spark, model):
    unseen = [("http://www.mega-casino.test/en/9", "block"), ("https://cheap-meds-pills.test/de/1", "block"), ("https://library.city.test/en/3", "allow"), ("http://www.garden.journal.test/fr/8", "allow")]
    rows = [(u, "block" if y else "allow") for u, y in urls.LABELLED_URLS] + unseen
    got = urls.judge_urls(spark.createDataFrame(rows, "url string, want string"), rules=(), model=model)
    assert got.where(F.col("verdict") != F.col("want")).count() == 0


def test_no_python_in_the_plan(spark, model):
    plan = urls.judge_urls(spark.createDataFrame([("x",)], "url string"), model=model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_clashing_columns_and_repeated_rows(spark, model):
    rows = [("http://a.org/x", "mine", 1, 2, "no")] * 3
    df = spark.createDataFrame(rows, "url string, _host string, _path_codes int, _URL_score int, score string")
    judged = urls.judge_urls(df, model=model)
    assert set(judged.columns) == {*df.columns, "host", "path", "rule", "verdict"}
    got = judged.collect()
    assert len(got) == 3 and all((r["_host"], r["_path_codes"], r["_URL_score"], r["host"]) == ("mine", 1, 2, "a.org") for r in got)
    assert len({tuple(r) for r in got}) == 1


def test_no_pages(spark, model):
    assert urls.judge_urls(spark.createDataFrame([], "url string"), model=model).collect() == []
