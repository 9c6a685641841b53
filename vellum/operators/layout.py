"""Page layout from ink profiles: the relational forms.

A profile is dense: (key, pos, ink) with a row for every position. The raster kernels in
``vellum.operators.raster`` compute the same things from pixels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ink_profile(ink: DataFrame, keys: list[str], pos: str, extent: Column) -> DataFrame:
    """Counts of ink by position, with a row for the positions 0 .. extent-1 that have none."""
    counted = ink.groupBy(*keys, F.col(pos).cast("int").alias("pos")).agg(F.count("*").alias("ink"))
    every = ink.select(*keys).distinct().withColumn("pos", F.explode(F.sequence(F.lit(0), extent.cast("int") - 1)))
    return every.join(counted, [*keys, "pos"], "left").withColumn("ink", F.coalesce("ink", F.lit(0)).cast("long"))


def content_bounds(profile: DataFrame, keys: list[str], share: float = 0.005, margin: int = 20) -> DataFrame:
    """First and last position with ink above a share of the peak, widened by a margin.

    Without such ink the whole extent. The far end is the last position plus the margin.
    """
    whole = Window.partitionBy(*keys)
    marked = profile.withColumn("_peak", F.max("ink").over(whole)).withColumn("_size", F.max("pos").over(whole) + 1)
    inked = F.col("ink") > F.greatest(F.col("_peak") * share, F.lit(1))
    return marked.groupBy(*keys, "_size").agg(
        F.min(F.when(inked, F.col("pos"))).alias("_a"), F.max(F.when(inked, F.col("pos"))).alias("_b")
    ).select(
        *keys,
        F.coalesce(F.greatest(F.lit(0), F.col("_a") - margin), F.lit(0)).cast("int").alias("low"),
        F.coalesce(F.least(F.col("_size"), F.col("_b") + margin), F.col("_size")).cast("int").alias("high"),
    )


def moving_mean(profile: DataFrame, keys: list[str], size: int, value: str = "ink") -> DataFrame:
    """Centred mean over ``size`` positions (even sizes lean left), mirrored at both ends."""
    left, right = size // 2, size - size // 2 - 1
    whole = Window.partitionBy(*keys)
    counted = profile.withColumn("_n", F.max("pos").over(whole) + 1)
    mirrored = F.array(
        F.col("pos"),
        F.when(F.col("pos") < left, -F.col("pos") - 1),
        F.when(F.col("pos") >= F.col("_n") - right, 2 * F.col("_n") - 1 - F.col("pos")),
    )
    padded = counted.withColumn("_at", F.explode(F.filter(mirrored, lambda p: p.isNotNull())))
    frame = Window.partitionBy(*keys).orderBy("_at").rowsBetween(-left, right)
    smoothed = padded.withColumn("smooth", F.sum(value).over(frame) / F.lit(size))
    return smoothed.where("_at = pos").drop("_at", "_n")


def runs(df: DataFrame, keys: list[str], flag: Column, pos: str = "pos") -> DataFrame:
    """Maximal runs of positions where ``flag`` holds: run_start, run_end (excluded), run_len."""
    by = Window.partitionBy(*keys).orderBy(pos)
    island = F.col(pos) - F.row_number().over(by)
    return (
        df.where(flag)
        .withColumn("_island", island)
        .groupBy(*keys, "_island")
        .agg(F.min(pos).alias("run_start"), (F.max(pos) + 1).alias("run_end"), F.count("*").alias("run_len"))
        .drop("_island")
    )


def header_boundary(
    smooth: DataFrame, keys: list[str], height: int, share: float = 0.08, least_run: int | None = None
) -> DataFrame:
    """Where the masthead ends: the end of the longest (first, if tied) quiet run in the top quarter.

    Quiet is below ``share`` of the median there; runs need a length that grows with the height.
    """
    top = smooth.where(F.col("pos") < height // 4)
    fallback = height // 12
    if height // 4 < 10:
        return smooth.select(*keys).distinct().withColumn("header_end", F.lit(fallback))
    median = top.groupBy(*keys).agg(F.percentile("smooth", F.lit(0.5)).alias("_median"))
    quiet = F.col("smooth") < F.greatest(F.col("_median") * share, F.lit(1.0))
    found = runs(top.join(median, keys), keys, quiet).where(
        (F.col("run_end") > height // 20) & (F.col("run_len") >= (least_run or max(10, height // 300)))
    )
    best = found.groupBy(*keys).agg(F.max_by("run_end", F.struct("run_len", -F.col("run_start"))).alias("_end"))
    return smooth.select(*keys).distinct().join(best, keys, "left").select(
        *keys, F.coalesce("_end", F.lit(fallback)).cast("int").alias("header_end")
    )


def local_peaks(
    profile: DataFrame, keys: list[str], height: float, edge: Column, most: int, value: str = "v", pos: str = "pos"
) -> DataFrame:
    """Strict local maxima of at least a height, off both edges, the ``most`` highest of each key."""
    by = Window.partitionBy(*keys).orderBy(pos)
    size = F.max(pos).over(Window.partitionBy(*keys)) + 1
    v = F.col(value)
    peaks = (
        profile.withColumn("_l", F.lag(value).over(by))
        .withColumn("_r", F.lead(value).over(by))
        .withColumn("_size", size)
        .where((v > F.col("_l")) & (v > F.col("_r")) & (v >= height) & (F.col(pos) > edge) & (F.col(pos) < F.col("_size") - edge))
    )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(v.desc(), pos))
    return peaks.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_l", "_r", "_size", "_rank")


def union_boundaries(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))


def thin_out(sorted_positions: Column, tolerance: Column) -> Column:
    """Keep a position if it is farther than the tolerance from the last one kept."""
    return F.aggregate(
        sorted_positions,
        F.slice(sorted_positions, 1, 0),
        lambda kept, x: F.when(
            (F.size(kept) == 0) | (x - F.element_at(kept, -1) > tolerance), F.array_append(kept, x)
        ).otherwise(kept),
    )


def or_equal_split(boundaries: Column, left: Column, width: Column, parts: int = 6) -> Column:
    """The boundaries, or those of equal columns where there are none."""
    step = F.floor(width / parts).cast("int")
    equal = F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda i: (left + step * i).cast("int"))
    return F.when(F.size(boundaries) == 0, equal).otherwise(boundaries)


def edges_to_columns(edges: Column, least_width: Column) -> Column:
    """Columns between consecutive edges: thin ones dropped, the rest padded and numbered."""
    pairs = F.zip_with(
        F.slice(edges, F.lit(1), F.size(edges) - 1),
        F.slice(edges, F.lit(2), F.size(edges) - 1),
        lambda a, b: F.struct(a.alias("a"), (b - a).alias("w")),
    )
    wide = F.filter(pairs, lambda p: p["w"] >= least_width)

    def column(p: Column, i: Column) -> Column:
        pad = F.least(F.lit(8), F.floor(p["w"] / 20)).cast("int")
        return F.struct(i.cast("int").alias("index"), (p["a"] + pad).alias("x"), (p["w"] - 2 * pad).alias("width"))

    return F.transform(wide, column)


def oversized(widths: Column, factor: float = 1.7) -> Column:
    """Widths above a factor of the upper median; none where there are fewer than two."""
    middle = F.element_at(F.array_sort(widths), F.floor(F.size(widths) / 2).cast("int") + 1)
    return F.when(F.size(widths) >= 2, F.filter(widths, lambda w: w > middle * factor)).otherwise(F.slice(widths, 1, 0))


def fold_blocks(gaps: Column, height: Column, min_gap: int = 25, min_block: int = 20) -> Column:
    """Blocks between gaps, from the sorted gaps (a, b) of a column that do not reach its end.

    A gap splits if it is long enough and starts far enough behind the block's start, which is
    the end of the last gap that split; the last block needs some length; none: one whole block.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("out"))

    def step(s: Column, g: Column) -> Column:
        splits = (g["b"] - g["a"] >= min_gap) & (g["a"] > s["at"] + min_block)
        grown = F.struct(
            g["b"].alias("at"), F.array_append(s["out"], F.struct(s["at"].alias("a"), g["a"].alias("b"))).alias("out")
        )
        return F.when(splits, grown).otherwise(s)

    folded = F.aggregate(gaps, start, step)
    last = F.when(
        height > folded["at"] + min_block,
        F.array_append(folded["out"], F.struct(folded["at"].alias("a"), height.cast("int").alias("b"))),
    ).otherwise(folded["out"])
    return F.when(F.size(last) == 0, F.array(F.struct(F.lit(0).alias("a"), height.cast("int").alias("b")))).otherwise(last)


def smoothed_steps(ink: DataFrame, keys: list[str], pos: str, height: int, size: int) -> DataFrame:
    """``moving_mean`` of the ink's profile, times ``size``, as steps: run_start, run_end (excluded), total.

    Ink at one position adds to ``size`` totals, so they change only where its reach begins or
    ends: the rows grow with the ink, not with the ``height``, which is ``size`` at least. Where no
    step is, there is no ink; each key has a step, also if its ink is null or off the page.
    """
    left, right = size // 2, size - size // 2 - 1
    on_page = F.when(F.col(pos).between(0, height - 1), F.col(pos)).cast("int")
    cells = ink.groupBy(*keys, on_page.alias("_p")).agg(F.count("*").alias("_n"))
    p, n, none = F.col("_p"), F.col("_n"), F.lit(0).cast("long")

    def change(at: Column, by: Column) -> Column:
        return F.struct(at.alias("run_start"), by.alias("_by"))

    reach = [change(F.greatest(F.lit(0), p - right), n), change(F.least(p + left + 1, F.lit(height)), -n)]
    low, high = F.when(p < left, n).otherwise(none), F.when(p >= height - right, n).otherwise(none)
    mirrored = [
        change(F.lit(0), low), change(F.greatest(left - p, F.lit(0)), -low),
        change(F.least(2 * height - 1 - p - right, F.lit(height)), high),
    ]
    changes = (
        F.when(p.isNull(), F.array(change(F.lit(0), none)))
        .when((p < left) | (p >= height - right), F.array(*reach, *mirrored))
        .otherwise(F.array(*reach))
    )
    by = Window.partitionBy(*keys).orderBy("run_start")
    return (
        cells.select(*keys, F.explode(changes).alias("_c"))
        .select(*keys, "_c.run_start", "_c._by")
        .withColumn("total", F.sum("_by").over(by.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("run_end", F.coalesce(F.lead("run_start").over(by), F.lit(height)))
        .where("run_start < run_end")
        .select(*keys, "run_start", "run_end", "total")
    )


# Gaps lie below one part in so many of a column's peak, and split from so many rows on.
QUIET_PART, MIN_GAP = 50, 25


def blocks_in_columns(ink: DataFrame, keys: list[str], pos: str, height: int, size: int = 5, min_gap: int = MIN_GAP) -> DataFrame:
    """``blocks`` of each column, from its ink by row, smoothed over ``size`` rows.

    A gap is a run of rows below a part of the column's peak that ends before the column does;
    :func:`fold_blocks` decides which gaps split. A column without ink, or under 30 rows, is one
    block.
    """
    whole = F.array(F.struct(F.lit(0).alias("a"), F.lit(height).alias("b")))
    if height < 30:
        return ink.select(*keys).distinct().withColumn("blocks", whole)
    column = Window.partitionBy(*keys)
    before = column.orderBy("run_start").rowsBetween(Window.unboundedPreceding, -1)
    loud = F.col("total") * QUIET_PART >= F.col("_peak")
    # a gap lies between two loud steps, or before the first; shorter ones never split
    gap = F.when(loud & (F.col("run_start") - F.col("_a") >= min_gap), F.struct(F.col("_a").alias("a"), F.col("run_start").alias("b")))
    gaps = (
        smoothed_steps(ink, keys, pos, height, size)
        .withColumn("_peak", F.max("total").over(column))
        .withColumn("_a", F.coalesce(F.max(F.when(loud, F.col("run_end"))).over(before), F.lit(0)))
        .groupBy(*keys)
        .agg(F.max("total").alias("_peak"), F.array_sort(F.collect_list(gap)).alias("_gaps"))
    )
    found = fold_blocks(F.col("_gaps"), F.lit(height), min_gap)
    return gaps.select(*keys, F.when(F.col("_peak") < size, whole).otherwise(found).alias("blocks"))


def wall_micros(ts: Column) -> Column:
    """Microseconds of a timestamp without zone since 1970-01-01."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), ts)


def sessions(df: DataFrame, key: str, ts: str, gap_seconds: int) -> DataFrame:
    """Number the sessions of a key: a new one after a gap of at least so many seconds."""
    by = Window.partitionBy(key).orderBy(ts, "event_id")
    apart = wall_micros(F.col(ts)) - wall_micros(F.lag(ts).over(by)) >= gap_seconds * 1_000_000
    return df.withColumn("_new", F.coalesce(apart, F.lit(False)).cast("int")).withColumn(
        "session", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("_new")


def render_scale(width: Column, height: Column, dpi: float, most: float = 12000.0) -> Column:
    """Pixels per point: the wanted resolution, unless the longer side would exceed the cap."""
    return F.least(F.lit(dpi) / 72.0, F.lit(most) / F.greatest(width, height))


def sauvola_threshold(mean: Column, deviation: Column, k: float = 0.2, half_range: float = 127.5) -> Column:
    return mean * (1 + k * (deviation / half_range - 1))


def overlay(columns: Column, header_end: Column, scale: Column) -> Column:
    """The geometry of a debug overlay: a header line and the column boxes, scaled."""
    scaled = lambda v: F.floor(v * scale).cast("int")
    boxes = F.transform(
        columns,
        lambda c: F.struct(
            F.concat(F.lit("Col "), c["index"].cast("string")).alias("label"),
            scaled(c["x"]).alias("x0"),
            scaled(c["x"] + c["width"]).alias("x1"),
        ),
    )
    return F.struct(scaled(header_end).alias("header_y"), boxes.alias("boxes"))
