"""Queries that must go through every row of a table."""

import hashlib
import random

import duckdb
import pytest

from vellum.plans import registry
from vellum.sources import files


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(
        f"{folder}/documents.parquet"
    )


def test_scan_csv_range_takes_any_ids(spark, tmp_path, monkeypatch):
    rows = [(1000 + 3 * i, f'line "{i}",\n\\ second', f"l{i % 3}", "s") for i in range(400)]
    documents(spark, tmp_path, rows)
    written = []
    save = files.save_csv
    monkeypatch.setattr(files, "save_csv", lambda df, path, **how: (written.append(path), save(df, path, **how)))
    got = registry.queries()["scan_csv_range"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == [(i, rows[i][2], sha(rows[i][1])) for i in range(5, 150)]
    assert files.load_csv(spark, written[0]).count() == len(rows)


LIMIT = 1200


def by_chars(text):
    out = []
    while len(text) > LIMIT:
        at = LIMIT
        for marks in (".!?。！？", " "):
            ends = [i + 1 for i in range(LIMIT * 4 // 5, LIMIT) if text[i] in marks]
            if ends:
                at = ends[-1]
                break
        out.append(text[:at])
        text = text[at:]
    return [*out, text] if text else out


def by_parts(text, sep, smaller):
    """Runs of parts, each of which costs its length and a separator; a part too long alone is cut smaller."""
    out, run = [], []
    for part in text.split(sep):
        if run and sum(len(p) + len(sep) for p in [*run, part]) > LIMIT:
            out.append(sep.join(run))
            run = []
        if len(part) + len(sep) > LIMIT:
            out += smaller(part)
        else:
            run.append(part)
    return [*out, sep.join(run)] if run else out


def by_lines(text):
    return [text] if len(text) <= LIMIT else by_parts(text, "\n", by_chars)


def by_paragraphs(text):
    text = text.replace("\n", "\n\n")
    return [text] if len(text) <= LIMIT else by_parts(text, "\n\n", lambda p: by_parts(p, "\n", by_chars))


CHUNKERS = [("chunk_paragraphs", by_paragraphs), ("chunk_lines", by_lines)]


def expected(rows, chunker):
    return sorted((d, i, sha(c)) for d, t in rows for i, c in enumerate(chunker(t)))


def chunks(spark, name, folder):
    return sorted((r["doc_id"], r["pos"], r["chunk_sha256"]) for r in registry.queries()[name](spark, folder).collect())


@pytest.mark.parametrize("name, chunker", CHUNKERS)
def test_chunks_of_overlong_parts(spark, tmp_path, name, chunker):
    rng = random.Random(7)
    line = lambda n: "".join(rng.choice(["word ", "end. ", "é!", "x" * 9]) for _ in range(n))[: n * 4]
    texts = ["\n".join(line(rng.choice([0, 3, 40, 290, 301, 700, 1500])) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts += ["", "\n", "x" * 5000, *("y" * n for n in range(1197, 1203)), *("a\n" + "z" * n for n in range(1195, 1203))]
    rows = list(enumerate(texts))
    documents(spark, tmp_path, [(d, t, "en", "s") for d, t in rows])
    assert chunks(spark, name, str(tmp_path)) == expected(rows, chunker)


@pytest.mark.parametrize("name, chunker", CHUNKERS)
def test_chunks_of_the_given_tables(spark, name, chunker):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = chunks(spark, name, sf)
    assert got == expected(rows, chunker) and {r[0] for r in got} == {d for d, _ in rows}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert got == sorted(tuple(r) for r in con.execute(registry.oracle_sql()[name]).fetchall())
