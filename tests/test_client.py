"""The enricher that asks a service, without one."""

import logging

import pytest

from vellum.operators import client as K
from vellum.operators import enrich as E
from vellum.plans import pipeline

SETTINGS = K.Settings("secret", "https://service.test/v1/chat", prompt=" Mend it. ")


def test_what_is_needed():
    for key, endpoint in (("", "x"), ("k", "")):
        with pytest.raises(ValueError):
            K.Settings(key, endpoint)
    with pytest.raises(ValueError):
        K.Settings("k", "x", prompt=" ")
    assert "secret" not in repr(SETTINGS)


def test_arguments_go_before_the_environment(caplog):
    env = {K.KEY_VARIABLE: "from env", K.ENDPOINT_VARIABLE: "https://env.test"}
    assert K.settings_or_none("given", None, env).key == "given"
    assert K.settings_or_none(None, "https://given.test", env).endpoint == "https://given.test"
    assert K.settings_or_none(None, None, {}, K.read_dotenv("# x\n\nexport OPENAI_API_KEY='filed'\nENRICH_ENDPOINT=https://f.test")).key == "filed"
    with caplog.at_level(logging.WARNING):
        assert K.settings_or_none(None, None, {}) is None
    assert "no enrichment" in caplog.text


def test_a_request():
    sent = []

    def send(endpoint, headers, body, timeout):
        sent.append((endpoint, headers, body))
        return {"choices": [{"message": {"content": " mended "}}]}

    assert K.ChatClient(SETTINGS, send, count=lambda t: len(t) // 4)("x" * 4000) == " mended "
    endpoint, headers, body = sent[0]
    assert endpoint == "https://service.test/v1/chat" and headers["Authorization"] == "Bearer secret"
    assert body["messages"] == [{"role": "system", "content": "Mend it."}, {"role": "user", "content": "x" * 4000}]
    assert (body["model"], body["temperature"], body["max_tokens"]) == ("gpt-4o-mini", 0.1, 1500)
    assert [K.reply_budget(n) for n in (0, 683, 10_000, 10**6)] == [1024, 1024, 15_000, 16_384]


def test_enrichment_by_a_service(spark):
    def send(endpoint, headers, body, timeout):
        text = body["messages"][1]["content"]
        if "torn" in text:
            raise OSError("service gone")
        return {"choices": [{"message": {"content": None if "none" in text else "" if "short" in text else text.upper()}}]}

    fast = K.Settings("k", "https://s.test", attempts=1, per_minute=6e6)
    rows = [(1, "some text"), (2, "torn"), (3, "none"), (4, "a\n\n" * 9), (5, "short")]
    df = spark.createDataFrame(rows, "row_idx long, text string")
    make = K.factory(fast, 2, send, len)
    got = {r["row_idx"]: (r["text"], r["error"]) for r in E.enrich_texts(df, make, limit=12, threads=3, least_ratio=0.5).collect()}
    assert got[1] == ("SOME TEXT", None) and got[2] == ("torn", "service gone") and got[3] == ("none", None)
    assert got[4] == ("A\n\n" * 9, None) and got[5][0] == "short" and got[5][1].startswith("reply of 0")


def test_the_command_line_chooses_an_enricher(spark, tmp_path):
    args = lambda *more: pipeline.parser().parse_args(["--input", "x.csv", *more])
    env = {K.KEY_VARIABLE: "k", K.ENDPOINT_VARIABLE: "https://s.test"}
    assert pipeline.enricher_of(spark, args("--skip-enrich"), env) is None
    assert pipeline.enricher_of(spark, args(), {}) is None
    assert pipeline.enricher_of(spark, args("--prompt", str(tmp_path / "none.txt")), env) is None
    (tmp_path / "p.txt").write_text("  Do it.\n")
    seen = []

    def send(endpoint, headers, body, timeout):
        seen.append(body)
        return {"choices": [{"message": {"content": "done"}}]}

    make = pipeline.enricher_of(spark, args("--prompt", str(tmp_path / "p.txt"), "--model", "m", "--rpm", "60000000"), env, send)
    assert make()("chunk") == "done" and seen[0]["messages"][0]["content"] == "Do it." and seen[0]["model"] == "m"
    assert args().checkpoint == 0 and args().workers == 4 and args().snapshot_interval == 12.0
