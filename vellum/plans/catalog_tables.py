"""Queries over selection, recovery, word tables, layout profiles, chunks and sinks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.operators import chunks as C
from vellum.operators import layout as L
from vellum.operators import raster
from vellum.operators import recover as V
from vellum.operators import words as W
from vellum.plans.registry import query
from vellum.sources import files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- sources and selectors ------------------------------------------------------------------

@query(
    "src_collect_docs",
    "SELECT page_id, url FROM pages WHERE ends_with(lower(regexp_extract(url, '^[^?#]*')), '.html')",
)
def src_collect_docs(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return files.with_suffix(pages.select("page_id", "url"), F.regexp_extract("url", "^[^?#]*", 0), ".html")


@query("sel_page_range", "SELECT conv_id, turn, role FROM conversations WHERE turn BETWEEN 2 AND 4 AND turn <= 3")
def sel_page_range(spark, sf_dir):
    return V.select_pages(table(spark, sf_dir, "conversations"), "2-4", "turn", F.lit(3)).select("conv_id", "turn", "role")


@query("sel_row_range", "SELECT doc_id AS row_idx, sha256(text) AS text_sha256 FROM documents WHERE doc_id >= 10 AND doc_id < 60")
def sel_row_range(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "row_idx")
    start, end = V.parse_row_range("10-60", 1 << 40)
    return V.select_rows(docs, start, end).select("row_idx", F.sha2("text", 256).alias("text_sha256"))


@query(
    "scan_csv_range",
    """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_idx, lang AS date, sha256(text) AS text_sha256
       FROM documents QUALIFY row_idx >= 5 AND row_idx < 150""",
)
def scan_csv_range(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").alias("row_idx"), F.col("lang").alias("date"), "text")
    path = files.scratch(spark, "scan_csv")
    files.save_csv(rows, path)
    read = V.select_rows(files.load_csv(spark, path), 5, 150)
    return read.select("row_idx", "date", F.sha2("text", 256).alias("text_sha256"))


@query(
    "sink_csv_roundtrip",
    "SELECT lang AS date, sha256(concat('\"', text, '\"', chr(10), ' \\x')) AS text_sha256, count(*) AS n FROM documents GROUP BY ALL",
)
def sink_csv_roundtrip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        F.col("doc_id").alias("row_idx"),
        F.col("lang").alias("date"),
        F.concat(F.lit('"'), "text", F.lit('"\n \\x')).alias("text"),
    )
    path = files.scratch(spark, "sink_csv")
    files.save_csv(rows, path)
    return files.load_csv(spark, path).groupBy("date", F.sha2("text", 256).alias("text_sha256")).agg(F.count("*").alias("n"))


@query(
    "progress_last_wins",
    "SELECT user_id AS row_idx, max(event_id) AS seq, max_by(event_type, event_id) AS text FROM events GROUP BY user_id",
)
def progress_last_wins(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("row_idx"), F.col("event_id").alias("seq"), F.col("event_type").alias("text")
    )
    return V.last_wins(log, "row_idx", "seq")


@query(
    "snapshot_cadence",
    """SELECT epoch_us(time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01')) // 1000000 AS bucket_start_s,
       count(*) AS n_events FROM events GROUP BY 1""",
)
def snapshot_cadence(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.window("ts", "12 hours").alias("w"))
        .agg(F.count("*").alias("n_events"))
        .select(F.floor(L.wall_micros(F.col("w.start")) / 1_000_000).alias("bucket_start_s"), "n_events")
    )


@query(
    "state_row",
    """SELECT left(sha256('/in.csv|historical|False|True|none|0|None'), 16) AS config_hash, count(*) AS total_rows,
       0::BIGINT AS row_start, NULL::BIGINT AS row_end, TRUE AS is_dated FROM documents""",
)
def state_row(spark, sf_dir):
    n = table(spark, sf_dir, "documents").agg(F.count("*").alias("total_rows"))
    return n.select(
        F.lit(V.run_config_hash("/in.csv", "historical", False, True, "none", 0, None)).alias("config_hash"),
        "total_rows",
        F.lit(0).cast("long").alias("row_start"),
        F.lit(None).cast("long").alias("row_end"),
        F.current_timestamp().isNotNull().alias("is_dated"),
    )


# --- recovery -------------------------------------------------------------------------------

def _rows(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_idx"), F.col("lang").alias("date"), "text")


def _done(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return labels.select(
        F.col("doc_id").alias("row_idx"), F.when(F.col("toxic") == 1, None).otherwise(F.concat(F.lit("fixed "), "quality")).alias("text")
    )


_DONE_SQL = "SELECT doc_id AS row_idx, CASE WHEN toxic = 1 THEN NULL ELSE concat('fixed ', quality) END AS text FROM labels"


@query("resume_anti_join", "SELECT doc_id AS row_idx, lang AS date FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti_join(spark, sf_dir):
    return V.pending(_rows(spark, sf_dir), _done(spark, sf_dir)).select("row_idx", "date")


@query("semi_join_done", "SELECT doc_id AS row_idx, lang AS date FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi_join_done(spark, sf_dir):
    return V.completed(_rows(spark, sf_dir), _done(spark, sf_dir)).select("row_idx", "date")


@query("join_completed_only", f"SELECT d.doc_id AS row_idx, d.lang AS date, x.text FROM documents d JOIN ({_DONE_SQL}) x ON d.doc_id = x.row_idx")
def join_completed_only(spark, sf_dir):
    return V.completed_texts(_rows(spark, sf_dir), _done(spark, sf_dir))


@query(
    "join_final_fallback",
    f"""SELECT d.doc_id AS row_idx, d.lang AS date, x.row_idx IS NOT NULL AS completed,
        sha256(CASE WHEN x.row_idx IS NOT NULL THEN x.text ELSE d.text END) AS text_sha256
        FROM documents d LEFT JOIN ({_DONE_SQL}) x ON d.doc_id = x.row_idx""",
)
def join_final_fallback(spark, sf_dir):
    merged = V.merge_completed(_rows(spark, sf_dir), _done(spark, sf_dir))
    return merged.select("row_idx", "date", "completed", F.sha2("text", 256).alias("text_sha256"))


@query(
    "failed_keep_original",
    """SELECT doc_id AS row_idx, doc_id % 7 = 0 AS failed,
       sha256(CASE WHEN doc_id % 7 = 0 THEN text ELSE upper(source) END) AS text_sha256 FROM documents""",
)
def failed_keep_original(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tried = docs.withColumn("error", F.when(F.col("doc_id") % 7 == 0, F.lit("unreachable")))
    text = V.with_fallback(F.upper("source"), F.col("error"), F.col("text"))
    return tried.select(
        F.col("doc_id").alias("row_idx"), F.col("error").isNotNull().alias("failed"), F.sha2(text, 256).alias("text_sha256")
    )


@query(
    "checkpoint_batches",
    """SELECT source, batch, count(*) AS n_rows, min(doc_id) AS first_id, max(doc_id) AS last_id FROM (
       SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 10 AS batch FROM documents) GROUP BY source, batch""",
)
def checkpoint_batches(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return V.checkpoint_batches(docs, 10, "doc_id", F.col("source")).groupBy("source", "batch").agg(
        F.count("*").alias("n_rows"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )


@query(
    "len_delta_stats",
    """SELECT lang, count(*) AS n_rows, sum(length(text) - length(replace(text, 'the', '')))::BIGINT AS removed,
       max(length(text) - length(replace(text, 'the', '')))::BIGINT AS most FROM documents GROUP BY lang""",
)
def len_delta_stats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    delta = V.length_delta(F.col("text"), F.replace("text", F.lit("the"), F.lit("")))
    return docs.groupBy("lang").agg(F.count("*").alias("n_rows"), F.sum(delta).alias("removed"), F.max(delta).alias("most"))


@query(
    "config_hash",
    """SELECT doc_id, left(sha256(concat_ws('|', '/in/' || source, lang, CASE WHEN doc_id % 2 = 0 THEN 'True' ELSE 'False' END,
       'True', 'gpt-4o-mini', doc_id, CASE WHEN doc_id % 3 = 0 THEN 'None' ELSE (doc_id + 5)::VARCHAR END)), 16) AS config_hash FROM documents""",
)
def config_hash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        V.config_hash(
            F.concat(F.lit("/in/"), "source"),
            F.col("lang"),
            V.spelled(F.col("doc_id") % 2 == 0),
            V.spelled(F.lit(True)),
            F.lit("gpt-4o-mini"),
            F.col("doc_id").cast("string"),
            F.when(F.col("doc_id") % 3 != 0, (F.col("doc_id") + 5).cast("string")),
        ).alias("config_hash"),
    )


# --- enrichment -----------------------------------------------------------------------------

@query(
    "llm_token_budget",
    """SELECT doc_id, greatest(1024, least(16384, floor(ceil(length(text) / 4) * 3 / 2)))::BIGINT AS max_tokens FROM documents""",
)
def llm_token_budget(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", V.token_budget(F.col("text")).alias("max_tokens"))


@query("llm_retry_schedule", "SELECT k AS attempts, [2 ** i for i in range(1, greatest(k - 1, 1) + 1)]::INTEGER[] AS delays FROM (VALUES (2), (3), (5)) t(k)")
def llm_retry_schedule(spark, sf_dir):
    rows = [spark.range(1).select(F.lit(k).alias("attempts"), V.retry_delays(k).alias("delays")) for k in (2, 3, 5)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "rate_limit_schedule",
    """SELECT event_id, (max(epoch_us(ts) - rn * 6000) OVER (PARTITION BY user_id ORDER BY rn
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + rn * 6000)::BIGINT AS start_us
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS rn FROM events)""",
)
def rate_limit_schedule(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", L.wall_micros(F.col("ts")).alias("us"))
    return V.rate_limit_starts(events, "us", "event_id", 10_000, F.col("user_id")).select("event_id", "start_us")


@query("llm_passthrough", "SELECT doc_id, sha256(replace(text, chr(10), chr(10) || chr(10))) AS text_sha256 FROM documents")
def llm_passthrough(spark, sf_dir):
    parts = C.explode_chunks(_paragraphs(spark, sf_dir), limit=400)
    enriched = C.map_chunks(parts, lambda: lambda chunk: chunk)
    return C.reassemble(enriched, ["doc_id"]).select("doc_id", F.sha2("text", 256).alias("text_sha256"))


def _paragraphs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))


@query("chunk_roundtrip", "SELECT doc_id, sha256(replace(text, chr(10), chr(10) || chr(10))) AS text_sha256, TRUE AS same FROM documents")
def chunk_roundtrip(spark, sf_dir):
    texts = _paragraphs(spark, sf_dir)
    back = C.reassemble(C.explode_chunks(texts, limit=400), ["doc_id"])
    return back.join(texts.withColumnRenamed("text", "whole"), "doc_id").select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"), (F.col("text") == F.col("whole")).alias("same")
    )


#: Characters of the next window of a text: up to the last sentence end in its last fifth, else
#: up to the last space there, else all of it.
_WINDOW_SQL = """CASE WHEN length(rest) <= {limit} THEN length(rest) ELSE {head} + coalesce(
    nullif(length(regexp_extract(substr(rest, {head} + 1, {tail}), '^(?s:.*)[.!?。！？]')), 0),
    nullif(length(regexp_extract(substr(rest, {head} + 1, {tail}), '^(?s:.*) ')), 0), {tail}) END"""


def _window_sql(limit: int) -> str:
    head = limit * 4 // 5
    return _WINDOW_SQL.format(limit=limit, head=head, tail=limit - head)


def _chunk_sql(text: str, sep: str, cost: int, limit: int) -> str:
    """Parts packed into chunks one after the other; parts that are too long alone as windows."""
    return f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, {text} AS t FROM documents
), parts AS (
  SELECT r, i, p[i] AS part, length(p[i]) + {cost} AS size FROM (SELECT r, string_split(t, {sep}) AS p FROM docs WHERE length(t) > {limit}),
  LATERAL unnest(range(1, len(p) + 1)) AS u(i)
), windows AS (
  SELECT r, i, -1 AS j, '' AS chunk, part AS rest FROM parts WHERE size > {limit}
  UNION ALL
  SELECT r, i, j + 1, left(rest, n), substr(rest, n + 1) FROM (SELECT *, {_window_sql(limit)} AS n FROM windows WHERE rest <> '')
), counted AS (
  SELECT p.r, p.i, p.size, coalesce(max(j) + 1, 0) AS n FROM parts p LEFT JOIN windows w ON w.r = p.r AND w.i = p.i GROUP BY ALL
), walk AS (
  SELECT r, i, 0 AS pos, CASE WHEN n > 0 THEN n ELSE 0 END AS closed, CASE WHEN n > 0 THEN 0 ELSE size END AS held FROM counted WHERE i = 1
  UNION ALL
  SELECT r, i, done, CASE WHEN n > 0 THEN done + n ELSE done END, CASE WHEN n > 0 THEN 0 WHEN flush THEN size ELSE held + size END FROM (
    SELECT c.r, c.i, c.n, c.size, w.held, w.held > 0 AND w.held + c.size > {limit} AS flush, w.closed + (w.held > 0 AND w.held + c.size > {limit})::INTEGER AS done
    FROM walk w JOIN counted c ON c.r = w.r AND c.i = w.i + 1)
), cut AS (
  SELECT r, pos, string_agg(part, {sep} ORDER BY i) AS chunk FROM walk JOIN parts USING (r, i) WHERE size <= {limit} GROUP BY r, pos
  UNION ALL
  SELECT r, pos + j, chunk FROM walk JOIN windows USING (r, i) WHERE j >= 0
  UNION ALL
  SELECT r, 0, t FROM docs WHERE length(t) <= {limit}
)
SELECT doc_id, pos::INTEGER AS pos, sha256(chunk) AS chunk_sha256 FROM cut JOIN docs USING (r)"""


def _packed(spark, sf_dir, text, limit, how):
    """Chunks of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    return C.explode_chunks(docs, limit=limit, how=how).select("doc_id", "pos", F.sha2("chunk", 256).alias("chunk_sha256"))


@query("chunk_paragraphs", _chunk_sql("replace(text, chr(10), chr(10) || chr(10))", "chr(10) || chr(10)", 2, 1200))
def chunk_paragraphs(spark, sf_dir):
    return _packed(spark, sf_dir, F.replace("text", F.lit("\n"), F.lit("\n\n")), 1200, C.chunk_text)


@query("chunk_lines", _chunk_sql("text", "chr(10)", 1, 1200))
def chunk_lines(spark, sf_dir):
    return _packed(spark, sf_dir, F.col("text"), 1200, C.chunk_lines)


@query(
    "chunk_chars",
    f"""WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, replace(text, chr(10), ' ') AS t FROM documents),
windows AS (
  SELECT r, -1 AS pos, '' AS chunk, t AS rest FROM docs WHERE length(t) > 400
  UNION ALL
  SELECT r, pos + 1, left(rest, n), substr(rest, n + 1) FROM (SELECT *, {_window_sql(400)} AS n FROM windows WHERE rest <> '')
), cut AS (
  SELECT r, pos, chunk FROM windows WHERE pos >= 0 UNION ALL SELECT r, 0, t FROM docs WHERE length(t) <= 400
)
SELECT doc_id, pos::INTEGER AS pos, length(chunk)::INTEGER AS n_chars, sha256(chunk) AS chunk_sha256 FROM cut JOIN docs USING (r)""",
)
def chunk_chars(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))
    return C.explode_chunks(docs, limit=400, how=C.chunk_chars_rows).select(
        "doc_id", "pos", F.length("chunk").alias("n_chars"), F.sha2("chunk", 256).alias("chunk_sha256")
    )


@query(
    "len_ratio_guard",
    """SELECT doc_id, coalesce(length(text) > 0 AND length(replace(text, 'e', ''))::DOUBLE / length(text) < 0.9, FALSE) AS suspicious FROM documents""",
)
def len_ratio_guard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", V.is_shortened(F.col("text"), F.replace("text", F.lit("e"), F.lit("")), 0.9).alias("suspicious"))


# --- words ----------------------------------------------------------------------------------

def _words(texts):
    """Recognised words made of documents: lines are lines, two to a block; some without confidence."""
    docs = texts.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    words = docs.select("doc_id", "line_no", F.posexplode(F.split("line", " ", -1)).alias("seq", "text"))
    return words.select(
        "doc_id",
        F.floor(F.col("line_no") / 2).cast("int").alias("block_num"),
        (F.col("line_no") % 2).cast("int").alias("line_num"),
        "seq",
        "text",
        ((F.col("doc_id") * 31 + F.col("line_no") * 7 + F.col("seq") * 13) % 102 - 1).cast("int").alias("conf"),
    )


_WORDS_SQL = """
WITH ls AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i - 1 AS line_no, string_split(ls[i], ' ') AS ws FROM ls, LATERAL unnest(range(1, len(ls) + 1)) AS u(i)),
words AS (
  SELECT doc_id, line_no // 2 AS block_num, line_no % 2 AS line_num, j - 1 AS seq, ws[j] AS text,
    (doc_id * 31 + line_no * 7 + (j - 1) * 13) % 102 - 1 AS conf
  FROM l, LATERAL unnest(range(1, len(ws) + 1)) AS u(j)
), usable AS (SELECT * FROM words WHERE trim(text) <> '' AND conf > 0)
"""


@query("word_filter", _WORDS_SQL + "SELECT doc_id, count(*) AS n_words, sum(conf)::BIGINT AS sum_conf FROM usable GROUP BY doc_id")
def word_filter(spark, sf_dir):
    return W.usable_words(_words(table(spark, sf_dir, "documents"))).groupBy("doc_id").agg(
        F.count("*").alias("n_words"), F.sum("conf").cast("long").alias("sum_conf")
    )


_LINES_SQL = """, lines AS (
  SELECT doc_id, block_num, line_num, string_agg(text, ' ' ORDER BY seq) AS line, count(*) AS n_words, sum(conf) AS sum_conf
  FROM usable GROUP BY ALL
)"""


@query(
    "words_to_lines",
    _WORDS_SQL + _LINES_SQL + """
SELECT doc_id, sha256(string_agg(line, chr(10) ORDER BY block_num, line_num)) AS text_sha256, sum(n_words)::BIGINT AS word_count
FROM lines GROUP BY doc_id""",
)
def words_to_lines(spark, sf_dir):
    # a text is smaller than its words, so it is dealt to where its words are put together
    texts = files.dealt(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    text = W.lines_to_text(W.words_to_lines(_words(texts), ["doc_id"]), ["doc_id"])
    return text.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "word_count")


@query(
    "conf_by_group",
    _WORDS_SQL + "SELECT doc_id, block_num::INTEGER AS block_num, count(*) AS word_count, floor(sum(conf) * 1000 / count(*))::BIGINT AS milli_conf FROM usable GROUP BY doc_id, block_num",
)
def conf_by_group(spark, sf_dir):
    used = W.usable_words(_words(table(spark, sf_dir, "documents"))).groupBy("doc_id", "block_num")
    return used.agg(F.count("*").alias("word_count"), F.floor(F.sum("conf") * 1000 / F.count("*")).alias("milli_conf"))


@query(
    "macro_avg_two_level",
    """SELECT o_custkey, round(avg(m) * 100)::BIGINT AS macro_pct, count(*) AS n_orders FROM (
       SELECT o_custkey, o_orderkey, floor(avg(l_quantity)) AS m FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL) GROUP BY o_custkey""",
)
def macro_avg_two_level(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    blocks = joined.groupBy("o_custkey", "o_orderkey").agg(F.floor(F.avg("l_quantity")).cast("double").alias("confidence"))
    columns = W.blocks_to_columns(
        blocks.withColumns({"text": F.lit("x"), "block": F.col("o_orderkey")}), ["o_custkey"]
    )
    return columns.select("o_custkey", F.round(F.col("confidence") * 100).cast("long").alias("macro_pct"), F.col("n_blocks").alias("n_orders"))


@query(
    "block_size_filter",
    """SELECT p_partkey, p_size, p_size >= 15 AND length(p_name) >= 15 AS is_block, p_size >= 10 AND length(p_name) >= 10 AS is_image FROM part""",
)
def block_size_filter(spark, sf_dir):
    size, name = F.col("p_size"), F.length("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", W.large_enough(size, name, 15).alias("is_block"), W.large_enough(size, name, 10).alias("is_image")
    )


@query(
    "assemble_reading_order",
    """SELECT conv_id, sha256(array_to_string([x for x in list_prepend(CASE WHEN conv_id % 3 = 0 THEN 'Header' ELSE '' END,
       list(CASE WHEN turn % 4 = 1 THEN '' ELSE text END ORDER BY turn)) if x <> ''], chr(10) || chr(10))) AS text_sha256
       FROM conversations GROUP BY conv_id""",
)
def assemble_reading_order(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn("t", F.when(F.col("turn") % 4 == 1, "").otherwise(F.col("text")))
    pages = turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "t"))), lambda r: r["t"]).alias("columns"))
    header = F.when(F.col("conv_id") % 3 == 0, "Header").otherwise("")
    return pages.select("conv_id", F.sha2(W.reading_order(header, F.col("columns")), 256).alias("text_sha256"))


@query(
    "page_confidence",
    """SELECT conv_id, round((CASE WHEN conv_id % 3 = 0 THEN 90 ELSE 0 END + sum(length(text) % 100)) / (count(*) + 1) * 10)::BIGINT AS decis
       FROM conversations GROUP BY conv_id""",
)
def page_confidence(spark, sf_dir):
    conf = F.collect_list((F.length("text") % 100).cast("double"))
    pages = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(conf.alias("confs"))
    header = F.when(F.col("conv_id") % 3 == 0, 90.0).otherwise(0.0)
    return pages.select("conv_id", F.round(W.page_confidence(header, F.col("confs")) * 10).cast("long").alias("decis"))


@query("pages_to_doc", "SELECT conv_id, list(text ORDER BY turn, text) AS pages FROM conversations GROUP BY conv_id")
def pages_to_doc(spark, sf_dir):
    return W.pages_to_documents(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


def _page_columns(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id",
        F.struct(F.col("turn").cast("int").alias("index"), F.concat((F.length("text") % 100).cast("string"), F.lit(".0")).alias("confidence"), F.col("text").alias("full_text")).alias("c"),
    )
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("c")).alias("columns"))


@query(
    "sink_txt_render",
    """SELECT conv_id, sha256(concat('===== Page ', conv_id, ' =====', chr(10), chr(10),
       CASE WHEN conv_id % 2 = 0 THEN concat('[HEADER]', chr(10), 'Head', chr(10), chr(10)) ELSE '' END,
       string_agg(concat('--- Column ', turn, ' (confidence: ', length(text) % 100, '.0%) ---', chr(10), text, chr(10), chr(10)), '' ORDER BY turn, length(text) % 100 || '.0', text))) AS text_sha256
       FROM conversations GROUP BY conv_id""",
)
def sink_txt_render(spark, sf_dir):
    header = F.when(F.col("conv_id") % 2 == 0, "Head").otherwise("")
    text = W.page_banner(F.col("conv_id"), header, F.col("columns"))
    return _page_columns(spark, sf_dir).select("conv_id", F.sha2(text, 256).alias("text_sha256"))


@query(
    "sink_json_nested",
    """SELECT conv_id, 'doc' || (conv_id % 5) AS source_pdf, turn::INTEGER AS column_index, (length(text) % 100) || '.0' AS confidence,
       sha256(text) AS text_sha256 FROM conversations""",
)
def sink_json_nested(spark, sf_dir):
    pages = _page_columns(spark, sf_dir)
    path = files.scratch(spark, "sink_json")
    files.save_json(pages.withColumn("source_pdf", F.concat(F.lit("doc"), F.col("conv_id") % 5)), path, "source_pdf")
    read = spark.read.schema(pages.schema.add("source_pdf", "string")).json(path)
    return read.select("conv_id", "source_pdf", F.explode("columns").alias("c")).select(
        "conv_id", "source_pdf", F.col("c.index").alias("column_index"), "c.confidence", F.sha2("c.full_text", 256).alias("text_sha256")
    )


# --- layout ---------------------------------------------------------------------------------

@query(
    "render_scale",
    "SELECT p_partkey, least(600 / 72.0::DOUBLE, 12000.0::DOUBLE / greatest(p_size::DOUBLE, p_retailprice)) AS scale FROM part",
)
def render_scale(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", L.render_scale(F.col("p_size").cast("double"), F.col("p_retailprice"), 600.0).alias("scale"))


@query(
    "sauvola_1d",
    """SELECT event_id, round(value - m * (1 + 0.2 * (s / 127.5 - 1)), 6) > 0 AS paper FROM (SELECT event_id, value,
       avg(value) OVER w AS m, stddev_pop(value) OVER w AS s FROM (SELECT event_id, user_id, round(value)::DOUBLE AS value FROM events)
       WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 25 PRECEDING AND 25 FOLLOWING))""",
)
def sauvola_1d(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(-25, 25)
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.round("value").alias("value"))
    above = F.col("value") - L.sauvola_threshold(F.avg("value").over(w), F.stddev_pop("value").over(w))
    return events.select("event_id", (F.round(above, 6) > 0).alias("paper"))


@query(
    "skew_argmax",
    """WITH p AS (SELECT l_suppkey, l_shipdate::DATE AS y, l_linenumber AS angle, count(*) AS ink FROM lineitem GROUP BY ALL),
       s AS (SELECT l_suppkey, angle, (count(*) * sum(ink * ink) - sum(ink) * sum(ink))::DOUBLE / (count(*) * count(*)) AS score FROM p GROUP BY ALL)
       SELECT l_suppkey, angle FROM s QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY score DESC, angle) = 1""",
)
def skew_argmax(spark, sf_dir):
    profile = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("y"), F.col("l_linenumber").alias("angle")).agg(F.count("*").alias("ink"))
    n, a, b = F.count("*"), F.sum(F.col("ink") * F.col("ink")), F.sum("ink")
    scored = profile.groupBy("l_suppkey", "angle").agg(((n * a - b * b) / (n * n)).alias("score"))
    best = Window.partitionBy("l_suppkey").orderBy(F.col("score").desc(), "angle")
    return scored.withColumn("rn", F.row_number().over(best)).where("rn = 1").select("l_suppkey", "angle")


def _hour():
    """Hour of an event since 2024-01-01; both divisions cut towards zero, as in the SQL."""
    seconds = F.call_function("div", L.wall_micros(F.col("ts")), F.lit(1_000_000)) - 1704067200
    return F.call_function("div", seconds, F.lit(3600))


def _ink(spark, sf_dir):
    """Ink made of events: 20 pages by user, rows by hour of the month."""
    hour = F.floor((L.wall_micros(F.col("ts")) / 1_000_000 - 1704067200) / 3600).cast("int")
    return table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("page"), hour.alias("y"), (F.col("event_id") % 50).cast("int").alias("x"))


_HEIGHT = 744
_PROFILE_SQL = f"""
WITH ink AS (SELECT user_id % 20 AS page, (epoch_us(ts) // 1000000 - 1704067200) // 3600 AS y FROM events),
profile AS (
  SELECT page, pos, count(y) AS ink FROM (SELECT DISTINCT page FROM ink) AS p CROSS JOIN range({_HEIGHT}) AS r(pos)
  LEFT JOIN ink USING (page) WHERE y = pos OR y IS NULL GROUP BY ALL
)""".replace("LEFT JOIN ink USING (page) WHERE y = pos OR y IS NULL", "LEFT JOIN ink i ON i.page = p.page AND i.y = pos").replace("SELECT page, pos, count(y)", "SELECT p.page AS page, pos, count(y)")


def _profile(spark, sf_dir):
    return L.ink_profile(_ink(spark, sf_dir), ["page"], "y", F.lit(_HEIGHT))


@query("proj_profile", _PROFILE_SQL + "SELECT page, pos::INTEGER AS pos, ink FROM profile")
def proj_profile(spark, sf_dir):
    return _profile(spark, sf_dir)


@query(
    "content_bounds",
    _PROFILE_SQL + f""", inked AS (SELECT page, pos FROM profile QUALIFY ink > greatest(max(ink) OVER (PARTITION BY page) * 0.005, 1))
SELECT page, coalesce(greatest(0, min(i.pos) - 20), 0)::INTEGER AS low, coalesce(least({_HEIGHT}, max(i.pos) + 20), {_HEIGHT})::INTEGER AS high
FROM (SELECT DISTINCT page FROM profile) LEFT JOIN inked i USING (page) GROUP BY page""",
)
def content_bounds(spark, sf_dir):
    return L.content_bounds(_profile(spark, sf_dir), ["page"])


_BOX_SQL = _PROFILE_SQL + f""", smooth AS (
  SELECT a.page, a.pos, sum(b.ink) AS total FROM profile a, LATERAL unnest(range(a.pos - 10, a.pos + 10)) AS u(k) JOIN profile b
  ON b.page = a.page AND b.pos = CASE WHEN k < 0 THEN -k - 1 WHEN k >= {_HEIGHT} THEN 2 * {_HEIGHT} - 1 - k ELSE k END
  GROUP BY a.page, a.pos
)"""


@query("box_filter_reflect", _BOX_SQL + "SELECT page, pos::INTEGER AS pos, total::BIGINT AS total FROM smooth")
def box_filter_reflect(spark, sf_dir):
    smooth = L.moving_mean(_profile(spark, sf_dir), ["page"], 20)
    return smooth.select("page", "pos", F.round(F.col("smooth") * 20).cast("long").alias("total"))


@query(
    "header_gap_run",
    _BOX_SQL + f""", top AS (SELECT page, pos, total / 20 AS v FROM smooth WHERE pos < {_HEIGHT // 4}),
quiet AS (SELECT page, pos FROM top QUALIFY v < greatest(quantile_cont(v, 0.5) OVER (PARTITION BY page) * 0.08, 1.0)),
runs AS (SELECT page, min(pos) AS a, max(pos) + 1 AS b, count(*) AS n FROM
  (SELECT *, pos - row_number() OVER (PARTITION BY page ORDER BY pos) AS g FROM quiet) GROUP BY page, g),
best AS (SELECT page, b FROM runs WHERE b > {_HEIGHT // 20} AND n >= 10 QUALIFY row_number() OVER (PARTITION BY page ORDER BY n DESC, a) = 1)
SELECT page, coalesce(b, {_HEIGHT // 12})::INTEGER AS header_end FROM (SELECT DISTINCT page FROM profile) LEFT JOIN best USING (page)""",
)
def header_gap_run(spark, sf_dir):
    smooth = L.moving_mean(_profile(spark, sf_dir), ["page"], 20)
    return L.header_boundary(smooth, ["page"], _HEIGHT)


@query(
    "ruled_vertical_runs",
    """WITH ink AS (SELECT DISTINCT user_id % 4 AS page, event_id % 5 AS x, (epoch_us(ts) // 1000000 - 1704067200) // 3600 AS y FROM events)
SELECT page, x::INTEGER AS x, min(y)::INTEGER AS run_start, (max(y) + 1)::INTEGER AS run_end, count(*) AS run_len FROM
  (SELECT *, y - row_number() OVER (PARTITION BY page, x ORDER BY y) AS g FROM ink) GROUP BY page, x, g HAVING count(*) >= 3""",
)
def ruled_vertical_runs(spark, sf_dir):
    hour = F.floor((L.wall_micros(F.col("ts")) / 1_000_000 - 1704067200) / 3600).cast("int")
    ink = table(spark, sf_dir, "events").select((F.col("user_id") % 4).alias("page"), hour.alias("y"), (F.col("event_id") % 5).cast("int").alias("x"))
    found = L.runs(ink.distinct(), ["page", "x"], F.lit(True), "y").where("run_len >= 3")
    return found.select("page", "x", F.col("run_start").cast("int"), F.col("run_end").cast("int"), "run_len")


@query(
    "profile_local_peaks",
    _PROFILE_SQL + f""", inv AS (SELECT page, pos, 1 - ink::DOUBLE / max(ink) OVER (PARTITION BY page) AS v FROM profile),
peaks AS (SELECT *, lag(v) OVER w AS l, lead(v) OVER w AS r FROM inv WINDOW w AS (PARTITION BY page ORDER BY pos))
SELECT page, pos::INTEGER AS pos FROM peaks WHERE v > l AND v > r AND v >= 0.55 AND pos > {_HEIGHT // 25} AND pos < {_HEIGHT} - {_HEIGHT // 25}
QUALIFY row_number() OVER (PARTITION BY page ORDER BY v DESC, pos) <= 7""",
)
def profile_local_peaks(spark, sf_dir):
    peak = F.max("ink").over(Window.partitionBy("page"))
    inverted = _profile(spark, sf_dir).withColumn("v", 1 - F.col("ink") / peak)
    return L.local_peaks(inverted, ["page"], 0.55, F.lit(_HEIGHT // 25), 7).select("page", "pos")


#: Pages of one user each, on which many hours are empty.
_THIN_SQL = _BOX_SQL.replace("user_id % 20 AS page", "user_id AS page").replace("range(a.pos - 10, a.pos + 10)", "range(a.pos - 2, a.pos + 3)")


@query(
    "column_blocks",
    _THIN_SQL + f""", quiet AS (SELECT page, pos FROM smooth QUALIFY total < max(total) OVER (PARTITION BY page) * 0.02),
gaps AS (SELECT page, min(pos) AS a, max(pos) + 1 AS b FROM (SELECT *, pos - row_number() OVER (PARTITION BY page ORDER BY pos) AS g FROM quiet) GROUP BY page, g),
pages AS (SELECT page, max(total) / 5 AS peak FROM smooth GROUP BY page),
lists AS (SELECT page, peak, coalesce(list([a, b] ORDER BY a) FILTER (b < {_HEIGHT}), []) AS gs FROM pages LEFT JOIN gaps USING (page) GROUP BY page, peak),
folded AS (SELECT page, peak, list_reduce(list_prepend([0]::BIGINT[], gs::BIGINT[][]),
  lambda s, g: CASE WHEN g[2] - g[1] >= 25 AND g[1] > s[1] + 20 THEN list_concat([g[2]], s[2:], [s[1], g[1]]) ELSE s END) AS s FROM lists),
ended AS (SELECT page, CASE WHEN peak < 1 THEN [0, {_HEIGHT}] WHEN {_HEIGHT} > s[1] + 20 THEN list_concat(s[2:], [s[1], {_HEIGHT}])
  WHEN len(s) = 1 THEN [0, {_HEIGHT}] ELSE s[2:] END AS f FROM folded)
SELECT page, ((i - 1) // 2)::INTEGER AS block, f[i]::INTEGER AS y_start, f[i + 1]::INTEGER AS y_end FROM ended, LATERAL unnest(range(1, len(f), 2)) AS u(i)""",
)
def column_blocks(spark, sf_dir):
    # the SQL's joins drop events without a user
    ink = table(spark, sf_dir, "events").where("user_id IS NOT NULL").select(F.col("user_id").alias("page"), _hour().alias("y"))
    return L.blocks_in_columns(ink, ["page"], "y", _HEIGHT).select("page", F.posexplode("blocks").alias("block", "b")).select(
        "page", "block", F.col("b.a").alias("y_start"), F.col("b.b").alias("y_end")
    )


@query("gutter_peaks")
def gutter_peaks(spark, sf_dir):
    """Peaks of the inverted profile by height, distance, prominence and width, page by page."""

    def found(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        profile = rows.sort_values("pos")["ink"].to_numpy()
        at = raster.gutter_peaks(profile)
        return pd.DataFrame({"page": [key[0]] * len(at), "pos": [p for p, _ in at], "milli_drop": [round(d * 1000) for _, d in at]})

    return _profile(spark, sf_dir).groupBy("page").applyInPandas(found, "page long, pos int, milli_drop long")


def _positions(spark, sf_dir):
    """Sorted distinct positions for each order, made of its lines."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set((F.col("l_partkey") % 1000).cast("int"))).alias("a"),
        F.array_sort(F.collect_set((F.col("l_suppkey") * 9 % 1000).cast("int"))).alias("b"),
    )


_POS_SQL = """WITH pos AS (SELECT l_orderkey, list_sort(list_distinct(list((l_partkey % 1000)::INTEGER))) AS a,
  list_sort(list_distinct(list((l_suppkey * 9 % 1000)::INTEGER))) AS b FROM lineitem GROUP BY l_orderkey),
merged AS (SELECT l_orderkey, list_sort(list_distinct(list_concat(a, b))) AS m FROM pos)"""
_FOLD_SQL = """, steps AS (SELECT l_orderkey, list_reduce(list_prepend([]::INTEGER[], [[x] for x in m]),
  lambda kept, x: CASE WHEN len(kept) = 0 OR x[1] - kept[len(kept)] > 20.0 THEN list_concat(kept, x) ELSE kept END) AS k FROM merged)"""


@query("boundary_union", _POS_SQL + "SELECT l_orderkey, m FROM merged")
def boundary_union(spark, sf_dir):
    return _positions(spark, sf_dir).select("l_orderkey", L.union_boundaries(F.col("a"), F.col("b")).alias("m"))


@query("greedy_dedupe", _POS_SQL + _FOLD_SQL + "SELECT l_orderkey, k FROM steps")
def greedy_dedupe(spark, sf_dir):
    merged = _positions(spark, sf_dir).select("l_orderkey", L.union_boundaries(F.col("a"), F.col("b")).alias("m"))
    return merged.select("l_orderkey", L.thin_out(F.col("m"), F.lit(20.0)).alias("k"))


@query(
    "equal_split_fallback",
    _POS_SQL + "SELECT l_orderkey, CASE WHEN len(f) = 0 THEN [100 + 1000 // 6 * i for i in range(1, 6)]::INTEGER[] ELSE f END AS boundaries FROM (SELECT l_orderkey, [x for x in m if x > 700] AS f FROM merged)",
)
def equal_split_fallback(spark, sf_dir):
    merged = _positions(spark, sf_dir).select("l_orderkey", L.union_boundaries(F.col("a"), F.col("b")).alias("m"))
    far = F.filter("m", lambda x: x > 700)
    return merged.select("l_orderkey", L.or_equal_split(far, F.lit(100), F.lit(1000)).alias("boundaries"))


_COLUMNS_SQL = _POS_SQL + _FOLD_SQL + """, e AS (SELECT l_orderkey, list_concat([0], [x for x in k if x > 0], [1000]) AS e FROM steps),
c AS (SELECT l_orderkey, i, e[i] AS x0, e[i + 1] - e[i] AS w FROM e, LATERAL unnest(range(1, len(e))) AS u(i)),
cols AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY i) - 1 AS n, x0 + least(8, w // 20) AS x, w - 2 * least(8, w // 20) AS width FROM c WHERE w >= 70.0)
"""


def _columns(spark, sf_dir):
    merged = _positions(spark, sf_dir).select("l_orderkey", L.union_boundaries(F.col("a"), F.col("b")).alias("m"))
    kept = merged.select("l_orderkey", F.filter(L.thin_out(F.col("m"), F.lit(20.0)), lambda x: x > 0).alias("k"))
    edges = F.concat(F.array(F.lit(0)), F.col("k"), F.array(F.lit(1000)))
    return kept.select("l_orderkey", edges.alias("e")).select("l_orderkey", L.edges_to_columns(F.col("e"), F.lit(70.0)).alias("cols"))


@query("edges_to_columns", _COLUMNS_SQL + "SELECT l_orderkey, n::INTEGER AS column_index, x::INTEGER AS x, width::INTEGER AS width FROM cols")
def edges_to_columns(spark, sf_dir):
    return _columns(spark, sf_dir).select("l_orderkey", F.explode("cols").alias("c")).select(
        "l_orderkey", F.col("c.index").alias("column_index"), "c.x", "c.width"
    )


@query(
    "oversized_columns",
    _COLUMNS_SQL + """, m AS (SELECT l_orderkey, list(width ORDER BY width) AS ws FROM cols GROUP BY l_orderkey)
SELECT l_orderkey, width::INTEGER AS width, count(*) AS n FROM cols JOIN m USING (l_orderkey)
WHERE len(ws) >= 2 AND width > ws[len(ws) // 2 + 1] * 1.7 GROUP BY l_orderkey, width""",
)
def oversized_columns(spark, sf_dir):
    widths = _columns(spark, sf_dir).select("l_orderkey", F.transform("cols", lambda c: c["width"]).alias("ws"))
    return widths.select("l_orderkey", F.explode(L.oversized(F.col("ws"))).alias("width")).groupBy("l_orderkey", "width").agg(F.count("*").alias("n"))


@query(
    "debug_overlay_geometry",
    _COLUMNS_SQL + "SELECT l_orderkey, 'Col ' || n AS label, (x * 2 // 3)::INTEGER AS x0, ((x + width) * 2 // 3)::INTEGER AS x1, 66 AS header_y FROM cols",
)
def debug_overlay_geometry(spark, sf_dir):
    drawn = _columns(spark, sf_dir).select("l_orderkey", L.overlay(F.col("cols"), F.lit(100), F.lit(2000) / F.lit(3000)).alias("o"))
    return drawn.select("l_orderkey", "o.header_y", F.explode("o.boxes").alias("b")).select("l_orderkey", "b.label", "b.x0", "b.x1", "header_y")


@query(
    "gap_sessions",
    """SELECT user_id, session, count(*) AS n, min(event_id) AS first_event FROM (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (
       SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= 1500000000 THEN 1 ELSE 0 END AS n FROM events))
       GROUP BY user_id, session""",
)
def gap_sessions(spark, sf_dir):
    found = L.sessions(table(spark, sf_dir, "events"), "user_id", "ts", 1500)
    return found.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))
