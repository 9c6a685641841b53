"""Splitting long texts for an enricher, and putting the replies back together.

Every chunk carries the separator that stood before it, so an unchanged text comes back exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CHARS = 12_000
# What ends a sentence.
SENTENCE_ENDS = ".!?。！？"
#: Bytes of text that are turned into Python objects at once, and what a row counts besides its text.
SLICE_BYTES, ROW_BYTES = 4 << 20, 64


def chunk_chars(text: str, limit: int = MAX_CHARS) -> list[str]:
    """Windows of at most ``limit`` characters, cut after a sentence end or a space in the last fifth."""
    out, at = [], 0
    while len(text) - at > limit:
        tail = text[at + int(limit * 0.8) : at + limit]
        ends = [i for i, c in enumerate(tail) if c in SENTENCE_ENDS] or [i for i, c in enumerate(tail) if c == " "]
        size = int(limit * 0.8) + ends[-1] + 1 if ends else limit
        out.append(text[at : at + size])
        at += size
    return [*out, text[at:]] if at < len(text) or not out else out


def chunk_chars_rows(text: str, limit: int = MAX_CHARS) -> list[tuple[str, str]]:
    """:func:`chunk_chars` with the separators, which are empty."""
    return [("", c) for c in chunk_chars(text, limit)]


def _pack(parts: list[str], separator: str, limit: int, split) -> list[tuple[str, str]]:
    """Greedily join parts up to the limit; what is too long alone is split further."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    cost = 0

    def flush() -> None:
        nonlocal cost
        if held:
            out.append((separator if out else "", separator.join(held)))
            held.clear()
            cost = 0

    for part in parts:
        size = len(part) + len(separator)
        if cost + size > limit:
            flush()
        if size > limit:
            first, *rest = split(part)
            out.append((separator if out else first[0], first[1]))
            out.extend(rest)
        else:
            held.append(part)
            cost += size
    flush()
    return out


def chunk_lines(text: str, limit: int = MAX_CHARS) -> list[tuple[str, str]]:
    return _pack(text.split("\n"), "\n", limit, lambda line: [("", c) for c in chunk_chars(line, limit)])


def chunk_text(text: str, limit: int = MAX_CHARS) -> list[tuple[str, str]]:
    """(separator before, chunk) in order: by paragraphs, then lines, then characters."""
    if len(text) <= limit:
        return [("", text)]
    return _pack(text.split("\n\n"), "\n\n", limit, lambda para: chunk_lines(para, limit))


def shifted_separators(chunks: list[tuple[str, str]], oversized_after: list[int]) -> list[str]:
    """Separators as a reassembly sees them that also keeps the one written when a full chunk is
    set aside before an oversized part; everything behind such a place moves by one."""
    out: list[str] = []
    for i, (sep, _) in enumerate(chunks[1:], 1):
        out.append(sep)
        if i in oversized_after:
            out.append(sep)
    return out[: max(0, len(chunks) - 1)]


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of so many bytes of a text column (a longer text is a part of its own)."""
    start = held = 0
    for i, n in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
        cost = (n or 0) + ROW_BYTES
        if held and held + cost > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += cost
    if start < batch.num_rows:
        yield batch.slice(start)


def explode_chunks(df: DataFrame, text: str = "text", limit: int = MAX_CHARS, how=chunk_text) -> DataFrame:
    """A row for each chunk, with ``pos``, ``sep_before`` and ``chunk`` in place of the text; null has none.

    A text is cut once, and little of a batch is held as Python objects at a time.
    """
    keep = [c for c in df.columns if c != text]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                rows, pos, seps, cut = [], [], [], []
                for row, t in enumerate(part.column(text).to_pylist()):
                    if t is None:
                        continue
                    for i, (sep, chunk) in enumerate([("", t)] if len(t) <= limit else how(t, limit)):
                        rows.append(row)
                        pos.append(i)
                        seps.append(sep)
                        cut.append(chunk)
                kind, at = part.schema.field(text).type, pa.array(rows, pa.int64())
                columns = [part.column(c).take(at) for c in keep]
                columns += [pa.array(pos, pa.int32()), pa.array(seps, kind), pa.array(cut, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "pos", "sep_before", "chunk"])

    return df.select(*keep, text).mapInArrow(run, ", ".join([*fields, "pos int", "sep_before string", "chunk string"]))


def reassemble(chunks: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("pos", F.concat("sep_before", "chunk").alias("part"))))
    return chunks.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias(text))


def keep_boundary_space(chunk: str, reply: str) -> str:
    """The reply with the white space around the chunk put back."""
    core = chunk.strip()
    if not core:
        return chunk
    at = chunk.index(core)
    return chunk[:at] + reply.strip() + chunk[at + len(core) :]


def map_chunks(chunks: DataFrame, make_enricher, compat: bool = False, threads: int = 1, least_ratio: float | None = None) -> DataFrame:
    """Replace ``chunk`` by an enricher's reply, in order, partition by partition.

    ``make_enricher`` is called once for each partition; ``threads`` chunks of a partition are
    under way at a time. A failed call keeps the chunk and fills ``error``; so does, if
    ``least_ratio`` is given, a reply of less than that share of the chunk's length. ``compat``
    strips replies without putting the surrounding white space back.
    """

    names = chunks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enrich = make_enricher()

        def one(chunk: str) -> tuple[str, str | None]:
            try:
                reply = enrich(chunk)
            except Exception as e:  # the row keeps its text and the reason
                return chunk, str(e)
            if reply is None:
                return chunk, None
            if least_ratio is not None and len(reply) < least_ratio * len(chunk):
                return chunk, f"reply of {len(reply)} characters for {len(chunk)}"
            return reply.strip() if compat else keep_boundary_space(chunk, reply), None

        with ThreadPoolExecutor(max(1, threads)) as pool:
            for batch in batches:
                for part in slices(batch, "chunk"):
                    replies, kind = list(pool.map(one, part.column("chunk").to_pylist())), part.schema.field("chunk").type
                    columns = [pa.array([r for r, _ in replies], kind) if c == "chunk" else part.column(c) for c in names]
                    columns.append(pa.array([e for _, e in replies], kind))
                    yield pa.RecordBatch.from_arrays(columns, names=[*names, "error"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.schema)
    return chunks.mapInArrow(run, f"{fields}, error string")
