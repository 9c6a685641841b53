import hashlib
import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from vellum.operators import recover as V
from vellum.operators import words as W
from vellum.plans import pipeline
from vellum.sources import files
from vellum.streaming import resume


def test_ranges():
    assert V.parse_page_range("2-4") == (2, 4) and V.parse_page_range("3") == (3, 3)
    assert V.parse_row_range("0-100", 50) == (0, 50) and V.parse_row_range("70-100", 50) == (70, 50)
    assert V.parse_row_range("70", 50) == (70, 71)
    with pytest.raises(ValueError):
        V.parse_row_range("-5", 50)


def test_config_hash(spark):
    want = hashlib.sha256(b"/a|modern|True|False|m|0|None").hexdigest()[:16]
    assert V.run_config_hash("/a", "modern", True, False, "m", 0, None) == want
    assert V.run_config_hash("/a", "modern", True, False, "m", 0, None, "rules 2") != want
    got = spark.range(1).select(V.config_hash(*(F.lit(x) for x in ("/a", "modern", "True", "False", "m", "0")), F.lit(None))).first()[0]
    assert got == want


def test_recorded_nulls_count_as_recorded(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "row_idx long, text string")
    done = spark.createDataFrame([(1, None), (2, "")], "row_idx long, text string")
    got = {r["row_idx"]: (r["text"], r["completed"]) for r in V.merge_completed(rows, done).collect()}
    assert got == {0: ("a", False), 1: (None, True), 2: ("", True)}


def test_last_entry_wins(spark):
    log = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (None, 9, "x")], "row_idx long, seq int, text string")
    assert [r["text"] for r in V.last_wins(log, "row_idx", "seq").collect()] == ["c"]


def test_rate_limit_equals_a_simulation(spark):
    arrivals = [0, 0, 1, 5, 50_000, 50_001, 50_002]
    df = spark.createDataFrame(list(enumerate(arrivals)), "i long, us long")
    got = [r["start_us"] for r in V.rate_limit_starts(df, "us", "i", 10_000, F.lit(0)).orderBy("i").collect()]
    want, free = [], 0
    for a in arrivals:
        want.append(max(a, free))
        free = want[-1] + 6000
    assert got == want


def test_budget_and_retries(spark):
    df = spark.createDataFrame([("x" * n,) for n in (0, 4, 3000, 4000, 12_000, 60_000)], "t string")
    assert [r[0] for r in df.select(V.token_budget(F.col("t"))).collect()] == [1024, 1024, 1125, 1500, 4500, 16384]
    assert spark.range(1).select(V.retry_delays(3)).first()[0] == [2, 4]


def test_words_of_a_block(spark):
    rows = [(1, 1, 1, 2, "b", 90), (1, 1, 1, 1, "a", 80), (1, 1, 1, 3, " ", 99), (1, 1, 2, 4, "c", 0), (1, 1, 2, 5, "d", -1), (1, 0, 5, 6, "first", 50)]
    words = spark.createDataFrame(rows, "k int, block_num int, line_num int, seq int, text string, conf int")
    r = W.lines_to_text(W.words_to_lines(words, ["k"]), ["k"]).first()
    assert (r["text"], r["word_count"], round(r["mean_conf"], 1)) == ("first\na b", 3, 73.3)


def test_csv_edges(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes(b'Date,Text\r\n1,"a ""q"" \\ b"\r\n2,"l1\r\nl2\rl3\nl4"\r\n3,""\r\n4,plain\r\n')
    got = [(r["row_idx"], r["date"], r["text"]) for r in files.load_csv(spark, str(path)).orderBy("row_idx").collect()]
    assert got == [(0, "1", 'a "q" \\ b'), (1, "2", "l1\nl2\nl3\nl4"), (2, "3", ""), (3, "4", "plain")]
    out = str(tmp_path / "out")
    files.save_csv(files.load_csv(spark, str(path)), out, single=True)
    again = [(r["date"], r["text"]) for r in files.load_csv(spark, out).orderBy("row_idx").collect()]
    assert again == [(d, t) for _, d, t in got]
    files.save_csv_bytes(out, str(tmp_path / "one.csv"))
    assert (tmp_path / "one.csv").read_bytes() == b'"Date","Text"\r\n"1","a ""q"" \\ b"\r\n"2","l1\nl2\nl3\nl4"\r\n"3",""\r\n"4","plain"\r\n'


def test_progress_log_skips_what_is_broken(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"row_idx": 1, "date": "d", "text": "t"}\n\nbroken{\n{"date": "x"}\n')
    assert [r["row_idx"] for r in files.load_progress(spark, str(tmp_path / "p.jsonl")).collect()] == [1]


def test_collecting_documents(spark, tmp_path):
    for name in ("b.pdf", "a.pdf", "c.PDF", "d.txt"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.pdf").write_bytes(b"x")
    found = files.collect_documents(spark, str(tmp_path)).select("path").collect()
    assert [os.path.basename(r["path"]) for r in found] == ["a.pdf", "b.pdf"]
    assert files.collect_documents(spark, str(tmp_path / "c.PDF")).count() == 1
    with pytest.raises(ValueError):
        files.collect_documents(spark, str(tmp_path / "sub"), ".doc")


def test_prompt(spark, tmp_path):
    (tmp_path / "p.txt").write_text("  fix the text\n")
    assert files.load_prompt(spark, str(tmp_path / "p.txt")) == "fix the text"
    with pytest.raises(Exception):
        files.load_prompt(spark, str(tmp_path / "none.txt"))


def test_stream_resumes_where_it_stopped(spark, tmp_path):
    source, progress, checkpoint = (str(tmp_path / n) for n in ("in", "progress", "check"))
    rows = spark.createDataFrame([(i, "1890", f"tbe row {i}") for i in range(20)], "row_idx long, date string, text string")
    rows.where("row_idx < 10").coalesce(1).write.parquet(source)
    schema = "row_idx long, date string, text string"
    stages = pipeline.build_stages("historical")
    sink = resume.FolderSnapshots(spark, str(tmp_path / "snap"))
    resume.start(spark, source, schema, progress, checkpoint, stages, sink=sink).awaitTermination(120)
    rows.where("row_idx >= 10").coalesce(1).write.mode("append").parquet(source)
    resume.start(spark, source, schema, progress, checkpoint, stages).awaitTermination(120)
    got = {r["row_idx"]: (r["text"], r["original_len"]) for r in resume.committed(spark, progress).collect()}
    assert got == {i: (f"the row {i}", len(f"tbe row {i}")) for i in range(20)}
    assert len(sink.messages) == 1 and os.path.isdir(tmp_path / "snap" / "v000000")


def test_late_rows_are_counted_up_to_a_bound(spark, tmp_path):
    src = str(tmp_path / "ev")
    spark.sql("select timestamp'2024-01-01 01:00:00' as ts union all select timestamp'2024-01-01 13:00:00'").write.parquet(src)
    counts = resume.late_tolerant_counts(spark.readStream.schema("ts timestamp").parquet(src), "ts")
    q = counts.writeStream.format("memory").queryName("late").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("late").count() == 2


def test_run_state(spark, tmp_path):
    state = resume.RunState(spark, str(tmp_path / "run"))
    assert not state.valid("h")
    state.save("h", 5, 0, None)
    state.save("h", 6, 0, None)
    assert state.valid("h") and json.loads((tmp_path / "run" / "state.json").read_text())["total_rows"] == 6
    assert not state.valid("other") and not (tmp_path / "run").exists()
    state.save("h", 5, 0, None)
    (tmp_path / "run" / "state.json").write_text("{broken")
    (tmp_path / "run" / ".state.json.crc").unlink(missing_ok=True)
    assert not state.valid("h") and not (tmp_path / "run").exists()


def test_run_state_lies_where_the_path_says(spark, tmp_path):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.far.link./in", f"file://{tmp_path}")
    state = resume.RunState(spark, "viewfs://far/in/run")
    state.save("h", 5, 0, None)
    assert state.valid("h") and (tmp_path / "run" / "state.json").exists()
    state.cleanup()
    assert not (tmp_path / "run").exists()


def test_snapshots(spark, tmp_path):
    sink = resume.FolderSnapshots(spark, str(tmp_path / "s"))
    assert not sink.push(str(tmp_path / "missing"))
    (tmp_path / "o.csv").write_text("x")
    schedule = resume.SnapshotSchedule(sink, str(tmp_path / "o.csv"), hours=1)
    assert [schedule.tick(t) for t in (0, 3599, 3600, 3700, 7200)] == [False, False, True, False, True] and schedule.stop()
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.name[0] == "v") == ["v000000", "v000001", "v000002"]
    assert not resume.FolderSnapshots(spark, "nowhere://x/y").push(str(tmp_path / "o.csv"))


class Hub:
    def __init__(self, fails=False):
        self.made, self.files, self.fails = [], [], fails

    def create_repo(self, **how):
        self.made.append(how)

    def upload_file(self, path_or_fileobj, path_in_repo, **how):
        if self.fails:
            raise OSError("hub gone")
        self.files.append((path_in_repo, path_or_fileobj, how["repo_id"], how["commit_message"]))


def test_snapshots_on_a_hub(spark, tmp_path):
    now = lambda: datetime(2024, 3, 1, 9, 5, tzinfo=timezone.utc)
    hub = Hub()
    sink = resume.HubSnapshots(spark, "me/data", "token", hub, now)
    assert not sink.push(str(tmp_path / "missing")) and not hub.made
    out = str(tmp_path / "out")
    files.save_csv(spark.createDataFrame([(0, "d", "a"), (1, "d", "b")], "row_idx long, date string, text string").coalesce(1), out)
    assert sink.push(out) and hub.made == [{"repo_id": "me/data", "repo_type": "dataset", "exist_ok": True}]
    assert hub.files[0][0] == "out/part-00000.csv" and b'"d","a"' in b"".join(f[1] for f in hub.files)
    assert {f[3] for f in hub.files} == {"Snapshot 2024-03-01 09:05 UTC"}
    (tmp_path / "one.csv").write_bytes(b"x\n")
    assert sink.push(str(tmp_path / "one.csv")) and hub.files[-1][:2] == ("one.csv", b"x\n")
    broken = resume.HubSnapshots(spark, "me/data", "token", Hub(fails=True), now)
    assert not broken.push(out) and broken.messages == ["failed: hub gone"]
    with pytest.raises(ValueError):
        resume.HubSnapshots(spark, "me/data", "")


def test_the_command_line_chooses_snapshots(spark, tmp_path):
    args = lambda *more: pipeline.parser().parse_args(["--input", "x.csv", *more])
    assert pipeline.snapshots_of(spark, args(), {}) is None
    assert isinstance(pipeline.snapshots_of(spark, args("--snapshots", str(tmp_path)), {}), resume.FolderSnapshots)
    assert pipeline.snapshots_of(spark, args("--hub-repository", "me/data"), {}) is None
    hub = pipeline.snapshots_of(spark, args("--hub-repository", "me/data"), {"HUGGINGFACE_TOKEN": "t"}, Hub())
    assert isinstance(hub, resume.HubSnapshots) and hub.token == "t"


def csv_of(path, lines):
    path.write_text("Date,Text\n" + "".join(f'{i},"{line}"\n' for i, line in enumerate(lines)))
    return str(path)


def test_pipeline_resumes_and_keeps_rows(spark, tmp_path):
    path = csv_of(tmp_path / "in.csv", [f"tbe line {i} ,here" for i in range(12)])
    work, out = str(tmp_path / "work"), str(tmp_path / "out")
    first = pipeline.run(spark, path, out, work, keep_progress=True)
    assert [r["text"] for r in first.orderBy("row_idx").collect()] == [f"the line {i}, here" for i in range(12)]
    again = pipeline.run(spark, path, str(tmp_path / "out2"), work)
    assert again.count() == 12 and not (tmp_path / "work").exists()
    part = pipeline.run(spark, path, str(tmp_path / "out3"), str(tmp_path / "w3"), rows="2-5", make_enricher=lambda: str.upper)
    assert sorted(r["text"] for r in part.collect()) == [f"THE LINE {i}, HERE" for i in (2, 3, 4)]


def test_a_broken_off_run_goes_on_and_doubles_nothing(spark, tmp_path):
    path = csv_of(tmp_path / "in.csv", [f"line {i}" for i in range(10)])
    work, out, sink = str(tmp_path / "work"), str(tmp_path / "out"), []

    class Broken:
        def push(self, output):
            sink.append(sorted(r["text"] for r in files.load_csv(spark, output).collect()))
            if len(sink) == 2:
                raise KeyboardInterrupt
            return True

    ticks = iter(range(0, 10**6, 3600))
    with pytest.raises(KeyboardInterrupt):
        pipeline.run(spark, path, out, work, checkpoint=3, snapshots=Broken(), snapshot_hours=1, make_enricher=lambda: str.upper, clock=lambda: next(ticks))
    assert [len(s) for s in sink] == [3, 6]  # the output holds what is done so far
    rows = spark.read.parquet(f"{work}/rows")
    assert rows.count() == 6
    rows.write.mode("append").parquet(f"{work}/rows")  # as if a commit had been made twice
    done = pipeline.run(spark, path, out, work, checkpoint=3, make_enricher=lambda: str.lower)
    assert [r["text"] for r in done.orderBy("row_idx").collect()] == [f"LINE {i}" if i < 6 else f"line {i}" for i in range(10)]
    assert not (tmp_path / "work").exists()


def test_changed_content_or_settings_do_not_resume(spark, tmp_path):
    work, out = str(tmp_path / "work"), str(tmp_path / "out")
    path = csv_of(tmp_path / "in.csv", ["old", "rows"])
    pipeline.run(spark, path, out, work, keep_progress=True)
    csv_of(tmp_path / "in.csv", ["new", "rows"])
    assert [r["text"] for r in pipeline.run(spark, path, out, work, keep_progress=True).orderBy("row_idx").collect()] == ["new", "rows"]
    upper = pipeline.run(spark, path, out, work, make_enricher=lambda: str.upper)
    assert [r["text"] for r in upper.orderBy("row_idx").collect()] == ["NEW", "ROWS"]


def test_progress_line():
    assert pipeline.progress_line(20, 50, 4.0, 1200, 1100) == "[20/50] 1,200 -> 1,100 (delta: +100) | 5.0 rows/s | ETA: 6s"
    assert pipeline.batches(0, 7, 3) == [(0, 3), (3, 6), (6, 7)] and pipeline.batches(2, 9, 0) == [(2, 9)]
