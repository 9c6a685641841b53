"""From scanned documents to page results, behind interfaces for renderer and recogniser."""

from __future__ import annotations

import os
import re
import time
import zlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import correct_page_text, python_round
from vellum.operators import raster, words
from vellum.operators.recover import parse_page_range


class Renderer(Protocol):
    def page_count(self, content: bytes) -> int: ...

    def size(self, content: bytes, page: int) -> tuple[float, float]:
        """Width and height in points."""

    def render(self, content: bytes, page: int, scale: float) -> np.ndarray: ...


class Recogniser(Protocol):
    def words(self, gray: np.ndarray, mode: int, dpi: int) -> list[tuple[int, int, str, int]]:
        """(block_num, line_num, text, confidence) in order of arrival."""


_STREAM = re.compile(rb"<<(?P<dict>(?:(?!stream|endobj).)*?/ObjStm(?:(?!stream|endobj).)*?)>>\s*stream\r?\n(?P<body>.*?)endstream", re.S)
_TREE = re.compile(rb"/Type\s*/Pages\b[^>]*?/Count\s+(\d+)|/Count\s+(\d+)[^>]*?/Type\s*/Pages\b", re.S)
_LEAF = re.compile(rb"/Type\s*/Page(?![A-Za-z])")


def count_pages(content: bytes) -> int:
    """Pages of a PDF, without a reader of PDFs: what the root of its page tree says.

    The root counts all pages, so it is the largest count of a tree node; without one, page
    objects are counted. Objects in compressed streams are looked at as well. A file that is no
    PDF, or one whose objects are encrypted, is an error.
    """
    if not content[:1024].lstrip().startswith(b"%PDF-"):
        raise ValueError("not a PDF")
    parts = [content]
    for m in _STREAM.finditer(content):
        body = m["body"]
        parts.append(zlib.decompressobj().decompress(body) if b"/FlateDecode" in m["dict"] else body)
    counts = [int(a or b) for part in parts for a, b in _TREE.findall(part)]
    pages = max(counts) if counts else sum(len(_LEAF.findall(part)) for part in parts)
    if not pages:
        raise ValueError("no page tree found")
    return pages


def with_page_counts(docs: DataFrame) -> DataFrame:
    """``path`` and ``n_pages`` of each document; null where they cannot be counted."""

    @F.pandas_udf("int")
    def counted(contents: pd.Series) -> pd.Series:
        out = []
        for content in contents:
            try:
                out.append(count_pages(content))
            except (ValueError, TypeError, zlib.error):
                out.append(None)
        return pd.Series(out, dtype="Int32")

    return docs.select("path", counted("content").alias("n_pages"))


WORD_SCHEMA = (
    "source_pdf string, page int, image_width int, image_height int, region int, block int, x int, width int, "
    "y_start int, y_end int, block_y_start int, block_y_end int, seq int, block_num int, line_num int, text string, conf int, "
    "seconds double, error string"
)
HEADER = -1


def scale_of(width: float, height: float, dpi: float, most: float = 12_000) -> float:
    return min(dpi / 72, most / max(width, height))


def recognise(docs: DataFrame, make: Callable[[], tuple[Renderer, Recogniser]], dpi: int = 600, pages: str | None = None) -> DataFrame:
    """A row for each recognised word of each page, and one without text for each region.

    ``docs`` has ``path`` and ``content``. Rendering, layout and recognition of a page happen in
    one task; only words leave it. The header's row has the ``seconds`` that its page took.

    What fails is left out and told, the rest stays: a crop that cannot be recognised has no
    words, a page that cannot be rendered or parted has one row without a region, a document
    whose pages cannot be counted one without a page. Such rows hold the reason in ``error``.
    """
    wanted = parse_page_range(pages) if pages else None
    names = [f.split()[0] for f in WORD_SCHEMA.split(", ")]
    blank = dict.fromkeys(names)

    def told(e: Exception) -> str:
        return f"{type(e).__name__}: {e}"

    def page_rows(name: str, number: int, rgb: np.ndarray, engine: Recogniser) -> list[dict]:
        gray, binary = raster.preprocess(rgb)
        head, columns = raster.segment_columns(binary)
        size = blank | {"source_pdf": name, "page": number, "image_width": rgb.shape[1], "image_height": rgb.shape[0]}
        rows: list[dict] = []

        def region(r: raster.Region, which: int, spans: list[tuple[int, int]], mode: int, least: int) -> None:
            place = size | {"region": which, "x": r.x, "width": r.width, "y_start": r.y_start, "y_end": r.y_end}
            rows.append(place | {"block": -1})
            for b, (a, z) in enumerate(spans):
                crop = gray[r.y_start + a : r.y_start + z, r.x : r.x + r.width]
                if min(crop.shape, default=0) < max(least, 10):
                    continue
                block = place | {"block": b, "block_y_start": r.y_start + a, "block_y_end": r.y_start + z}
                try:
                    found = list(engine.words(crop, mode, dpi))
                except Exception as e:
                    rows.append(block | {"error": told(e)})
                    continue
                for seq, (group, line, text, conf) in enumerate(found):
                    rows.append(block | {"seq": seq, "block_num": group, "line_num": line, "text": text, "conf": int(conf)})

        region(head, HEADER, [(0, head.y_end - head.y_start)], 11, 10)
        for c in columns:
            column = binary[c.y_start : c.y_end, c.x : c.x + c.width]
            region(c, c.index, raster.segment_blocks(column), 4, 15)
        return rows

    def of_document(path: str, content: bytes, renderer: Renderer, engine: Recogniser) -> Iterator[list[dict]]:
        name = os.path.basename(path)
        try:
            count = renderer.page_count(content)
        except Exception as e:
            yield [blank | {"source_pdf": name, "error": told(e)}]
            return
        for number in range(1, count + 1):
            if wanted and not wanted[0] <= number <= wanted[1]:
                continue
            began = time.monotonic()
            try:
                scale = scale_of(*renderer.size(content, number), dpi)
                rows = page_rows(name, number, renderer.render(content, number, scale), engine)
            except Exception as e:
                yield [blank | {"source_pdf": name, "page": number, "error": told(e)}]
                continue
            rows[0]["seconds"] = round(time.monotonic() - began, 1)
            yield rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        renderer, engine = make()
        whole = {n: "Int32" for n in names if n not in ("source_pdf", "text", "seconds", "error")}
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                for rows in of_document(path, content, renderer, engine):
                    yield pd.DataFrame(rows, columns=names).astype(whole | {"seconds": "float64"})

    return docs.select("path", "content").mapInPandas(run, WORD_SCHEMA)


def failures(found: DataFrame) -> DataFrame:
    """What could not be read: document, page, region and block, as far as known, and the reason."""
    return found.where("error is not null").select("source_pdf", "page", "region", "block", "error")


def assemble(found: DataFrame, dpi: int = 600) -> DataFrame:
    """Page results from the rows of :func:`recognise`: header, columns, blocks, texts, confidences.

    A block that could not be recognised is one without words; a page that could not be read at
    all has no result, only a row in :func:`failures`.
    """
    page = ["source_pdf", "page"]
    lines = words.words_to_lines(found.where("text is not null"), [*page, "region", "block"])
    text = words.lines_to_text(lines, [*page, "region", "block"]).select(
        *page, "region", "block", correct_page_text(F.col("text")).alias("text"), "word_count",
        python_round(F.col("mean_conf")).alias("confidence"),
    )
    bounds = found.where("text is not null").groupBy(*page, "region", "block").agg(
        F.first("block_y_start").alias("y_start"), F.first("block_y_end").alias("y_end")
    )
    blocks = text.join(bounds, [*page, "region", "block"])
    regions = found.where("block = -1").select(
        *page, "image_width", "image_height", "region", "seconds", F.struct("x", "width", "y_start", "y_end").alias("bounds")
    )
    kept = blocks.where((F.col("text") != "") | (F.col("region") == HEADER))
    column_blocks = kept.groupBy(*page, "region").agg(
        F.array_sort(F.collect_list(F.struct("block", "text", "confidence", "word_count", "y_start", "y_end"))).alias("b")
    )
    per_region = regions.join(column_blocks, [*page, "region"], "left").withColumn(
        "b", F.coalesce("b", F.array().cast("array<struct<block:int,text:string,confidence:double,word_count:bigint,y_start:int,y_end:int>>"))
    )
    mean = F.when(F.size("b") > 0, F.aggregate("b", F.lit(0.0), lambda s, x: s + x["confidence"]) / F.size("b")).otherwise(0.0)
    described = per_region.withColumn("full_text", F.array_join(F.transform("b", lambda x: x["text"]), "\n\n")).withColumn(
        "confidence", python_round(mean)
    )
    column = F.struct(
        F.col("region").alias("index"),
        F.struct(
            F.col("bounds.x").alias("x"), F.col("bounds.y_start").alias("y"), F.col("bounds.width").alias("width"),
            (F.col("bounds.y_end") - F.col("bounds.y_start")).alias("height"),
        ).alias("bounds"),
        F.transform("b", lambda x: x.dropFields("block")).alias("blocks"),
        "full_text",
        "confidence",
    )
    header = F.struct(
        F.col("full_text").alias("text"), "confidence",
        F.aggregate("b", F.lit(0).cast("long"), lambda s, x: s + x["word_count"]).alias("word_count"), "bounds",
    )
    whole = described.groupBy(*page, "image_width", "image_height").agg(
        F.first(F.when(F.col("region") == HEADER, header), ignorenulls=True).alias("header"),
        F.array_sort(F.collect_list(F.when(F.col("region") != HEADER, column))).alias("columns"),
        F.max("seconds").alias("processing_time_seconds"),
    )
    texts = F.transform("columns", lambda c: c["full_text"])
    confidences = F.transform("columns", lambda c: c["confidence"])
    return whole.select(
        *page,
        "processing_time_seconds",
        F.lit(dpi).alias("resolution_dpi"),
        F.struct(F.col("image_width").alias("width"), F.col("image_height").alias("height")).alias("image_size"),
        "header",
        "columns",
        words.reading_order(F.col("header.text"), texts).alias("full_text"),
        python_round(words.page_confidence(F.col("header.confidence"), confidences)).alias("average_confidence"),
    )


def documents(pages: DataFrame) -> DataFrame:
    """One row for each document with its pages in order."""
    body = [c for c in pages.columns if c != "source_pdf"]
    return pages.groupBy("source_pdf").agg(F.array_sort(F.collect_list(F.struct(*body)), lambda a, b: a["page"] - b["page"]).alias("pages"))


def to_text_rows(documents_or_pages: DataFrame) -> DataFrame:
    """The bridge to the text pipeline: a date from the file name's ISO prefix, and the text."""
    return documents_or_pages.select(
        F.regexp_extract("source_pdf", r"(\d{4}-\d{2}-\d{2})", 1).alias("date"), F.col("full_text").alias("text")
    )
