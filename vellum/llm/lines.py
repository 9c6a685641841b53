"""Line dedup across a corpus by a deletion-neighbourhood join, in DataFrame operations only.

Two lines are within one edit if deleting one character at the same place makes them equal
(a substitution), or if deleting one character of the longer gives the shorter (an insertion).
So every line emits hashed keys for its variants with one character deleted, equal variants
meet, and the earliest line of a key is all that the others need: no pairs are listed.

Lines that agree in nothing but chance are spared the variants. An edit leaves the first or the
second half of a line as it was, so only lines whose half meets an equal half go on. It also
leaves all but one block, of about the square root of the line, so only blocks around which two
lines agree emit variants. A variant is hashed in parts (what stands around the block, and what
is left of it), which keeps very long lines cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import cut, plain

_LEAST_BLOCK = 16
#: Line hashes that may be broadcast; more are shuffled.
BROADCAST_HASHES = 1_000_000
_POS = ("_no_id", "_id", "_hash", "_line")


def _half_keys(line: Column, n: Column) -> Column:
    """Keys of the halves of a line as one of length n, and as the longer of lengths n-1 and n."""
    keys = []
    for label in (n, n - 1):
        half = F.floor(label / 2).cast("int")
        keys.append(F.xxhash64(label, F.lit("head"), F.substring(line, F.lit(1), half)))
        keys.append(F.xxhash64(label, F.lit("tail"), F.substring(line, n - (label - half) + 1, label - half)))
    return F.array(*keys)


def _third_keys(line: Column, n: Column) -> Column:
    """Keys of the thirds of a line, for two edits: one of the three is as it was, at most two
    places off. Told for each length that the longer of two lines may have."""
    keys = []
    for label in (n, n + 1, n + 2):
        cuts = [F.floor(label * part / 3).cast("int") for part in range(4)]
        for a, b in zip(cuts, cuts[1:]):
            keys += [
                F.when(a + off >= 0, F.xxhash64(label, a, F.substring(line, a + off + 1, b - a))) for off in range(-2, 3)
            ]
    return F.array_distinct(F.array_compact(F.array(*keys)))


def _position(prefix: str = "") -> Column:
    return F.struct(*(F.col(prefix + c) for c in _POS))


def line_table(docs: DataFrame, id_col: str, text_col: str, max_edits: int, min_near_chars: int = 0) -> DataFrame:
    """One row for each line that is not blank: its place, its hashes and the keys of its parts."""
    rows = docs.select(
        F.col(id_col).isNull().alias("_no_id"),
        F.col(id_col).alias("_id"),
        F.xxhash64(text_col).alias("_hash"),
        F.posexplode(F.split(plain(text_col), "\n", -1)).alias("_line", "text"),
    ).where(F.col("text").rlike(r"\S"))
    n = F.char_length("text")
    parts = {1: _half_keys, 2: _third_keys}.get(max_edits)
    keys = F.when(n >= min_near_chars, parts(F.col("text"), n)) if parts else F.lit(None).cast("array<bigint>")
    return rows.select(
        *_POS, F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), keys.alias("keys")
    )


def _variants(lines: DataFrame) -> DataFrame:
    """Hashed deletion variants of ``text``: columns key, kind ('s', 'd', 'b') and those given.

    's': one character deleted at a place, for substitutions. 'd': the same without the place,
    and 'b': the line itself as what is left of one longer by a character, for insertions.
    """
    n = F.char_length("text")

    def blocks(label: Column) -> Column:
        size = F.greatest(F.lit(_LEAST_BLOCK), F.ceil(F.sqrt(label)).cast("int"))
        starts = F.sequence(F.lit(0), F.floor((label - 1) / size).cast("int"))
        return F.transform(starts, lambda b: F.struct(b.alias("b"), (b * size).alias("at"), size.alias("size")))

    def outer(label: Column, less: Column, start: Column, size: Column) -> Column:
        return F.xxhash64(
            label, start, F.substring("text", F.lit(1), start), F.substring("text", start + size - less + 1, n)
        )

    carried = [c for c in lines.columns if c != "text"]

    def parts(label: Column, less: int) -> DataFrame:
        return lines.withColumn("block", F.explode(blocks(label))).select(
            *carried,
            outer(label, F.lit(less), F.col("block.at"), F.col("block.size")).alias("_outer"),
            F.substring("text", F.col("block.at") + 1, F.col("block.size") - less).alias("_inner"),
            F.lit(less).alias("_less"),
        )

    around = parts(n, 0).unionByName(parts(n + 1, 1))
    agree = (
        around.groupBy("_outer")
        .agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
        .where("low <> high")
        .select("_outer")
    )
    around = cut(around.join(agree, "_outer", "left_semi"))
    inner, p = F.col("_inner"), F.col("_p")
    rest = F.concat(F.substring(inner, F.lit(1), p - 1), F.substring(inner, p + 1, F.char_length(inner)))
    deleted = (
        around.where("_less = 0")
        .withColumn("_p", F.explode(F.sequence(F.lit(1), F.char_length("_inner"))))
        .withColumn("_rest", F.xxhash64("_outer", rest))
    )
    pairs = F.explode(
        F.array(
            F.struct(F.xxhash64("_rest", "_p").alias("key"), F.lit("s").alias("kind")),
            F.struct(F.col("_rest").alias("key"), F.lit("d").alias("kind")),
        )
    )
    own_keys = deleted.select(*carried, pairs.alias("k")).select(*carried, "k.key", "k.kind")
    as_shorter = around.where("_less = 1").select(
        *carried, F.xxhash64("_outer", "_inner").alias("key"), F.lit("b").alias("kind")
    )
    return own_keys.unionByName(as_shorter)


def _variants_of_two(lines: DataFrame) -> DataFrame:
    """Hashed variants of ``text`` for two edits: columns key, kind and those given.

    A line with a mark in place of a substituted character, and without the deleted ones. Kinds
    name what was done to the one line and to the other: 'ss' two marks, 'sd' a mark and a
    deletion against 's' a mark, 'di' a deletion each, 'dd' two deletions against '' none.
    Equal variants of kinds that belong together are within the bound, so no pair is missed and
    none is made up.
    """
    text, n, mark = F.col("text"), F.char_length("text"), F.lit("\U0010ffff")
    carried = [c for c in lines.columns if c != "text"]
    each = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))

    def cut(line: Column, i: Column, put: Column | None = None) -> Column:
        parts = [F.substring(line, F.lit(1), i - 1), *([] if put is None else [put]), F.substring(line, i + 1, F.char_length(line))]
        return F.concat(*parts)

    def told(kind: str, family: str, value: Column) -> Column:
        return F.struct(F.xxhash64(F.lit(family), value).alias("key"), F.lit(kind).alias("kind"))

    def pairs(make) -> Column:
        later = lambda i: F.filter(each, lambda j: j > i)
        return F.flatten(F.transform(each, lambda i: F.transform(later(i), lambda j: make(i, j))))

    def both(i: Column, j: Column) -> Column:
        return F.array(
            told("ss", "marks", cut(cut(text, j, mark), i, mark)),
            told("dd", "two", cut(cut(text, j), i)),
            told("sd", "one", cut(cut(text, j), i, mark)),
            told("sd", "one", cut(cut(text, j, mark), i)),
        )

    def single(i: Column) -> Column:
        return F.array(
            told("ss", "marks", cut(text, i, mark)), told("s", "one", cut(text, i, mark)), told("di", "each", cut(text, i)), told("d", "less", cut(text, i))
        )

    whole = F.array(told("b2", "two", text), told("b", "less", text))
    found = F.concat(F.flatten(pairs(both)), F.flatten(F.transform(each, single)), whole)
    return lines.select(*carried, F.explode(found).alias("k")).select(*carried, "k.key", "k.kind")


#: For two edits: which kind's earliest line a line of a kind may be within the bound of.
_PARTNERS = {"ss": "ss", "di": "di", "dd": "b2", "b2": "dd", "sd": "s", "s": "sd", "d": "b", "b": "d"}


def find_duplicate_lines(
    docs: DataFrame, max_edits: int = 1, id_col: str = "doc_id", text_col: str = "text", min_near_chars: int = 0
) -> DataFrame:
    """Every line that an earlier line equals, or comes within ``max_edits`` (0 to 2) of.

    Earlier: of a smaller document id (null last, then by hash of the text), or higher up in the
    same document. Returns the places ``_no_id, _id, _hash, _line`` (from 0) of such lines, the
    place ``first`` of the earliest line they match, and ``edits`` (0 to 2). Blank lines never
    match. Two edits cost about 2 n^2 variants of each line of n characters of which a third meets
    an equal third elsewhere; one edit costs far fewer, see above. Lines under ``min_near_chars`` characters (none, unless asked for) are compared for
    equality only. Lines are judged on the input: what an earlier line matches itself does not matter. Rows that agree in
    id and text are taken as one document.
    """
    if max_edits not in (0, 1, 2):
        raise ValueError("the edit bound is 0, 1 or 2")
    lines = cut(line_table(docs, id_col, text_col, max_edits, min_near_chars))
    distinct = lines.groupBy("h1", "h2").agg(F.min(_position()).alias("own"), F.count("*").alias("n"))
    found = distinct.where("n > 1").select("h1", "h2", F.col("own").alias("first"), F.lit(0).alias("edits"))
    if max_edits:
        found = found.unionByName(_near(docs, lines, distinct, text_col, max_edits)).groupBy("h1", "h2").agg(
            F.min(F.struct("first", "edits")).alias("x")
        ).select("h1", "h2", "x.first", "x.edits")
    # written first, so that the join reads two plain exchanges and a very common line can be split
    return (
        lines.drop("keys")
        .join(cut(found), ["h1", "h2"])
        .where(F.col("first") < _position())
        .select(*_POS, "first", "edits")
    )


def _near(docs: DataFrame, lines: DataFrame, distinct: DataFrame, text_col: str, max_edits: int) -> DataFrame:
    """(h1, h2, first, edits) for the distinct lines with an earlier line within the bound."""
    keyed = lines.select("h1", F.explode("keys").alias("key"))
    shared = (
        keyed.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("key")
    )
    hopeful = cut(keyed.join(shared, "key", "left_semi").select("h1").distinct())
    if hopeful.count() <= BROADCAST_HASHES:
        hopeful = F.broadcast(hopeful)
    # the texts of these lines alone leave their partition, one for each distinct line
    hopeful_text = cut(
        docs.select(F.explode(F.split(plain(text_col), "\n", -1)).alias("text"))
        .select(F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text")
        .join(hopeful, "h1", "left_semi")
        .distinct()
        .join(distinct.select("h1", "h2", "own"), ["h1", "h2"])
    )
    keys, partners = (_variants(hopeful_text), {"s": "s", "d": "b", "b": "d"}) if max_edits == 1 else (_variants_of_two(hopeful_text), _PARTNERS)
    earliest = [F.min(F.when(F.col("kind") == k, F.col("own"))).alias(f"_{k}") for k in partners]
    best = keys.groupBy("key").agg(*earliest, F.count("*").alias("m")).where("m > 1")
    partner = F.coalesce(*(F.when(F.col("kind") == k, F.col(f"_{other}")) for k, other in partners.items()))
    linked = (
        keys.join(best, "key")
        .withColumn("first", partner)
        .where(F.col("first") < F.col("own"))
        .groupBy("h1", "h2")
        .agg(F.min("first").alias("first"))
    )
    # the hashes may lie: the two lines themselves decide
    earlier = hopeful_text.select(F.col("own").alias("first"), F.col("text").alias("_other"))
    return (
        linked.join(hopeful_text.select("h1", "h2", "text"), ["h1", "h2"])
        .join(earlier, "first")
        .withColumn("edits", F.levenshtein("text", "_other", max_edits))
        .where("edits > 0")
        .select("h1", "h2", "first", "edits")
    )


def dedup_lines(
    docs: DataFrame,
    max_edits: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    min_near_chars: int = 0,
) -> DataFrame:
    """Remove the lines of :func:`find_duplicate_lines` from every text.

    Returns the columns ``keep`` (all, if None), the rest of the text in ``deduped``, and the
    counts ``n_lines``, ``n_removed`` and ``n_near`` (those of them that were edited). Null texts stay
    null, with counts of 0; an empty text is one blank line; repeated rows are treated alike;
    columns of the same names are replaced.
    """
    new = ["deduped", "n_lines", "n_removed", "n_near"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    gone = (
        find_duplicate_lines(docs, max_edits, id_col, text_col, min_near_chars)
        .groupBy("_id", "_hash")
        .agg(F.collect_set("_line").alias("_gone"), F.count_if(F.col("edits") > 0).alias("n_near"), F.count("*").alias("_times"))
        .select(F.col("_id").alias("_gone_id"), F.col("_hash").alias("_gone_hash"), "_gone", (F.col("n_near") * F.size("_gone") / F.col("_times")).cast("long").alias("n_near"))
    )
    # the kept columns go by number, so that none of their names can clash with those used here
    rows = docs.select(
        *(F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)),
        F.col(id_col).alias("_id"),
        F.col(text_col).alias("_text"),
        F.xxhash64(text_col).alias("_hash"),
    )
    joined = rows.join(gone, F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_hash") == F.col("_gone_hash")), "left")
    lines = F.split("_text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    return (
        joined.withColumn("_lines", lines)
        .select(
            *(F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)),
            F.when(F.col("_gone").isNull(), F.col("_text"))
            .otherwise(F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n"))
            .alias("deduped"),
            F.when(F.col("_text").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
            F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        )
    )


ORACLE = """
WITH l AS (
  SELECT doc_id, i AS line_no, ls[i] AS line, doc_id * 1000000 + i AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) AS d,
    LATERAL unnest(range(1, len(ls) + 1)) AS u(i)
), f AS (
  SELECT line, length(line) AS n, min(pos) AS own FROM l
  WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]') GROUP BY line
), k AS (
  SELECT line, n, own, m, left(line, (m // 2)::BIGINT) AS head, right(line, (m - m // 2)::BIGINT) AS tail
  FROM f, LATERAL unnest([n, n - 1]) AS u(m)
), c AS (
  SELECT a.line AS line, b.line AS other, a.n AS n, b.n AS other_n, b.own AS own
  FROM k a JOIN k b ON a.m = b.m AND a.head = b.head AND b.own < a.own
  UNION
  SELECT a.line, b.line, a.n, b.n, b.own FROM k a JOIN k b ON a.m = b.m AND a.tail = b.tail AND b.own < a.own
), near AS (
  SELECT line, min(own) AS own FROM c
  WHERE CASE
    WHEN n = other_n THEN len([i for i in range(1, n + 1) if substr(line, i, 1) <> substr(other, i, 1)]) = 1
    WHEN n = other_n + 1 THEN len([i for i in range(1, n + 1) if substr(line, 1, i - 1) || substr(line, i + 1) = other]) > 0
    WHEN n = other_n - 1 THEN len([i for i in range(1, n + 2) if substr(other, 1, i - 1) || substr(other, i + 1) = line]) > 0
    ELSE false END
  GROUP BY line
), firsts AS (
  SELECT f.line, least(f.own, coalesce(near.own, f.own)) AS first, coalesce(near.own < f.own, false) AS is_near
  FROM f LEFT JOIN near USING (line)
), marked AS (
  SELECT l.*, coalesce(first < pos, false) AS gone, coalesce(first < pos AND is_near, false) AS near
  FROM l LEFT JOIN firsts USING (line)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed,
  count(*) FILTER (near)::BIGINT AS n_near,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
