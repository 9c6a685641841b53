"""Mixing sources to target weights by minimum-cost flow.

Documents are summed by membership pattern (the set of sources that hold them). A flow network
routes the words of each pattern to the quotas of its sources; the first copy of a pattern's
words is free, and each further copy costs more than the one before, so the mix repeats as
little as its quotas allow. What flows through a pattern is then taken from its documents in a
seeded order.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import cut, plain, unused

MAX_COPIES = 3
#: Patterns that the driver may hold; their number is checked.
MAX_PATTERNS = 100_000
#: Documents of one pattern that a single task may order.
ORDERED_ROWS = 10_000
#: A pattern that lacks more than this share of its flow gets up to so many further documents.
FILL_SHARE, FILL_ROUNDS = 0.0005, 8
_BITS = 10
_NULL, _SET, _SEP, _ESCAPE = "n", "s", "\x1f", "\x1e"


def word_count(text: Column | str) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D."""
    return F.regexp_count(plain(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _token(source: Column) -> Column:
    """A source as part of a pattern; what parts two tokens stands in none of them."""
    said = F.replace(source.cast("string"), F.lit(_ESCAPE), F.lit(_ESCAPE + "0"))
    said = F.replace(said, F.lit(_SEP), F.lit(_ESCAPE + "1"))
    return F.when(source.isNull(), F.lit(_NULL)).otherwise(F.concat(F.lit(_SET), said))


def _unescaped(token: Column) -> Column:
    """The token with its source as it was."""
    return F.replace(F.replace(token, F.lit(_ESCAPE + "1"), F.lit(_SEP)), F.lit(_ESCAPE + "0"), F.lit(_ESCAPE))


def weights_in_order(sources: list[str], cycle: tuple[float, ...] = (5, 2, 1)) -> dict[str, float]:
    """Weights by code point of the source, null last, in a repeating cycle."""
    plain_source = lambda s: s.replace(_ESCAPE + "1", _SEP).replace(_ESCAPE + "0", _ESCAPE)
    ordered = sorted(sources, key=lambda s: (s == _NULL, plain_source(s)))
    return {s: cycle[i % len(cycle)] for i, s in enumerate(ordered)}


def targets(sizes: dict[str, int], weights: dict[str, float], cap: float = MAX_COPIES) -> dict[str, float]:
    """Share all words by weight; what exceeds ``cap`` times a source goes to the others."""
    total, out, free = float(sum(sizes.values())), {}, sorted(sizes)
    while free:
        left = total - sum(out.values())
        share = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / share > cap * sizes[s]]
        if not over:
            out.update({s: left * weights[s] / share for s in free})
            break
        out.update({s: float(cap * sizes[s]) for s in over})
        free = [s for s in free if s not in out]
    return out


class _Network:
    """A flow network on which more arcs can be laid while it already flows."""

    def __init__(self):
        self.arcs: list[list[int]] = []
        self.node: dict = {}
        self.ends: list[int] = []
        self.room: list[int] = []

    def at(self, name) -> int:
        if name not in self.node:
            self.node[name] = len(self.arcs)
            self.arcs.append([])
        return self.node[name]

    def arc(self, a: int, b: int, room: int) -> int:
        """Number of the new arc; the one against it has the next."""
        self.arcs[a].append(len(self.ends))
        self.arcs[b].append(len(self.ends) + 1)
        self.ends += [b, a]
        self.room += [room, 0]
        return len(self.ends) - 2

    def fill(self, start: int, end: int) -> None:
        """Push as much as goes from start to end, by blocking flows over the nearest arcs."""
        arcs, ends, room = self.arcs, self.ends, self.room
        while True:
            level = [-1] * len(arcs)
            level[start] = 0
            queue = deque([start])
            while queue:
                a = queue.popleft()
                for e in arcs[a]:
                    if room[e] and level[ends[e]] < 0:
                        level[ends[e]] = level[a] + 1
                        queue.append(ends[e])
            if level[end] < 0:
                return
            next_arc, path, a = [0] * len(arcs), [], start
            while True:
                if a == end:
                    most = min(room[e] for e in path)
                    for e in path:
                        room[e] -= most
                        room[e ^ 1] += most
                    full = next(i for i, e in enumerate(path) if not room[e])
                    a = ends[path[full] ^ 1]
                    del path[full:]
                while next_arc[a] < len(arcs[a]):
                    e = arcs[a][next_arc[a]]
                    if room[e] and level[ends[e]] == level[a] + 1:
                        break
                    next_arc[a] += 1
                if next_arc[a] < len(arcs[a]):
                    e = arcs[a][next_arc[a]]
                    path.append(e)
                    a = ends[e]
                elif path:
                    level[a] = -1
                    a = ends[path.pop() ^ 1]
                else:
                    break


def route(capacity: dict[tuple[str, ...], int], quota: dict[str, int], copies: int = MAX_COPIES):
    """Words that flow through each pattern of a cheapest of the largest flows: {pattern: words}.

    The r-th copy of a pattern's words costs r(r-1)/2, so costs are convex. Only the arcs from
    the start have a cost, and successive shortest paths, which never come back to the start,
    use them from the cheapest to the dearest: the flow is filled with first copies alone, then
    with second ones laid beside, and so on. Each filling is a largest flow.
    """
    net = _Network()
    start, end = net.at("start"), net.at("end")
    for pattern, words in sorted(capacity.items()):
        for source in pattern:
            net.arc(net.at(("p", pattern)), net.at(("s", source)), copies * words)
    for source, words in sorted(quota.items()):
        net.arc(net.at(("s", source)), end, words)
    laid: dict = defaultdict(list)
    for _ in range(copies):
        for pattern, words in sorted(capacity.items()):
            laid[pattern].append(net.arc(start, net.at(("p", pattern)), words))
        net.fill(start, end)
    return {pattern: sum(net.room[e ^ 1] for e in laid[pattern]) for pattern in capacity}


def _digit(level: int) -> Column:
    """The level-th digit of a row's place in the seeded order."""
    first = 64 // _BITS
    hash_col, shift = ("_u", 64 - _BITS * (level + 1)) if level < first else ("_v", 64 - _BITS * (level - first + 1))
    return F.shiftrightunsigned(F.col(hash_col), shift).bitwiseAND(F.lit((1 << _BITS) - 1))


def plan_mix(
    docs: DataFrame,
    membership: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    cycle: tuple[float, ...] = (5, 2, 1),
    seed: int = 7,
    carry: list[str] | None = None,
) -> DataFrame:
    """How often the mix takes each document.

    ``membership`` is an array of sources for each row. Returns, for each row, the columns
    ``carry`` (the id, if None), ``size`` (words), ``sources`` (tokens of its pattern),
    ``source_size`` and ``target`` (of the first source of its pattern), ``copies`` and
    ``taken``, which is size times copies. A document is taken 0 to 3 times; the words taken
    from a pattern miss its flow by less than the smallest step its documents allow.

    Null and empty texts have size 0 and are never taken; a null source is a source of its own,
    last in order; a row without sources is never taken; repeated rows are documents of their
    own; an empty table gives an empty result. The order depends on the seed, the id and the
    text alone, except among rows that agree in both.

    Only sums by pattern, whose number is checked, reach the driver. Within a pattern the cut
    is found digit by digit of the hashed order, so that no pattern is ever sorted whole.
    """
    tokens = F.array_sort(F.array_distinct(F.transform(membership, _token)))
    rows = cut(
        docs.select(
            *(carry or [id_col]),
            word_count(text_col).alias("size"),
            F.array_join(tokens, _SEP).alias("_pattern"),
            F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("_u"),
            F.monotonically_increasing_id().alias("_row"),
        )
    ).withColumn("_v", F.xxhash64(F.lit(seed), F.col("_row")))
    summed = rows.groupBy("_pattern").agg(F.sum("size").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(summed) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns: name fewer sources")
    capacity = {tuple(r["_pattern"].split(_SEP)): r["words"] for r in summed if r["_pattern"]}
    sizes: dict[str, int] = defaultdict(int)
    for pattern, words in capacity.items():
        for source in pattern:
            sizes[source] += words
    target = targets(dict(sizes), weights_in_order(list(sizes), cycle))
    flow = route(capacity, {s: round(t) for s, t in target.items()})

    spark = docs.sparkSession
    state = {}
    for pattern, words in capacity.items():
        base, rest = divmod(flow[pattern], words) if words else (0, 0)
        state[_SEP.join(pattern)] = {"base": base, "rest": rest, "digits": [], "aim": flow[pattern]}
    rows = rows.join(
        F.broadcast(
            spark.createDataFrame(
                [(_SEP.join(p), int(sizes[p[0]]), float(target[p[0]])) for p in capacity],
                "_pattern string, source_size long, target double",
            )
        ),
        "_pattern",
        "left",
    )
    picked = _pick(rows, state)
    return picked.select(
        *(carry or [id_col]),
        "size",
        F.transform(F.split("_pattern", _SEP), _unescaped).alias("sources"),
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def _pick(rows: DataFrame, state: dict[str, dict]) -> DataFrame:
    """Add ``copies``: the base of the row's pattern, and one more for a seeded part of its rows."""
    spark = rows.sparkSession

    def known(level: int) -> DataFrame:
        return F.broadcast(
            spark.createDataFrame(
                [(p, int(s["base"]), int(s["rest"]), [int(d) for d in s["digits"]]) for p, s in state.items()],
                "_pattern string, _base long, _rest long, _digits array<long>",
            )
        )

    def inside(level: int) -> Column:
        same = F.lit(True)
        for i in range(level):
            same = same & (_digit(i) == F.col("_digits")[i])
        return same

    last = 2 * (64 // _BITS)
    level, open_ = 0, {p for p, s in state.items() if s["rest"] > 0}
    while open_ and level < last:
        cum = Window.partitionBy("_pattern").orderBy("_bin")
        bins = (
            rows.join(known(level), "_pattern")
            .where((F.size("_digits") == level) & (F.col("_rest") > 0) & inside(level))
            .groupBy("_pattern", "_rest", _digit(level).alias("_bin"))
            .agg(F.sum("size").alias("words"), F.count("*").alias("n"))
            .withColumn("upto", F.sum("words").over(cum))
            .where(F.col("upto") > F.col("_rest"))
            .groupBy("_pattern")
            .agg(F.min(F.struct("_bin", "n", "words", "upto")).alias("x"))
        )
        open_ = set()
        for r in bins.collect():
            s = state[r["_pattern"]]
            s["digits"].append(r["x"]["_bin"])
            s["rest"] -= r["x"]["upto"] - r["x"]["words"]
            if r["x"]["n"] > ORDERED_ROWS:
                open_.add(r["_pattern"])
        level += 1
    level = max([1, *(len(s["digits"]) for s in state.values())])
    joined = rows.join(known(level), "_pattern", "left")
    earlier, edge = F.lit(False), F.col("_rest").isNotNull() & (F.size("_digits") > 0)
    for i in range(level):
        here = F.get("_digits", F.lit(i))
        earlier = F.when(here.isNull(), earlier).otherwise(earlier | (edge & (_digit(i) < here)))
        edge = edge & (here.isNull() | (_digit(i) == here))
    staged = joined.withColumn("_edge", F.coalesce(edge, F.lit(False))).withColumn(
        "_extra", F.coalesce(earlier, F.lit(False))
    )
    cum = F.sum("size").over(Window.partitionBy("_pattern").orderBy("_u", "_v").rowsBetween(Window.unboundedPreceding, 0))
    at_edge = staged.where("_edge").withColumn("_extra", cum <= F.col("_rest"))
    marked = cut(staged.where("not _edge").unionByName(at_edge))

    # what a pattern still lacks is met by single documents, each time the one that fits best
    taken = marked.where("_edge and _extra").groupBy("_pattern").agg(F.sum("size").alias("words")).collect()
    short = {p: s["rest"] for p, s in state.items() if s["digits"]}
    for r in taken:
        short[r["_pattern"]] -= r["words"]
    aim = {p: s["aim"] for p, s in state.items()}
    chosen: list[tuple[str, int]] = []
    for _ in range(FILL_ROUNDS):
        lacking = [(p, int(v)) for p, v in short.items() if v > FILL_SHARE * aim[p]]
        if not lacking:
            break
        rest = marked.where("not _extra and size > 0")
        if chosen:
            rest = rest.join(F.broadcast(spark.createDataFrame(chosen, "_pattern string, _row long")), ["_pattern", "_row"], "left_anti")
        miss = F.abs(F.col("size") - F.col("_gap"))
        best = (
            rest.join(F.broadcast(spark.createDataFrame(lacking, "_pattern string, _gap long")), "_pattern")
            .groupBy("_pattern", "_gap")
            .agg(F.min(F.struct(miss.alias("miss"), "_u", "_v", "_row", "size")).alias("x"))
            .where("x.miss < _gap")
            .collect()
        )
        for p in {p for p, _ in lacking} - {r["_pattern"] for r in best}:
            short.pop(p)
        for r in best:
            chosen.append((r["_pattern"], r["x"]["_row"]))
            short[r["_pattern"]] -= r["x"]["size"]
    if chosen:
        ones = F.broadcast(spark.createDataFrame([(p, r, True) for p, r in chosen], "_pattern string, _row long, _one boolean"))
        marked = marked.join(ones, ["_pattern", "_row"], "left").withColumn("_extra", F.col("_extra") | F.coalesce("_one", F.lit(False)))
    copies = F.coalesce(F.col("_base"), F.lit(0)) + F.col("_extra").cast("int")
    return marked.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long"))


def mix(docs: DataFrame, membership: Column, **how) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as :func:`plan_mix` takes it."""
    own = unused(docs.columns, "_mix_")
    row, copies = own + "row", own + "copies"
    numbered = cut(docs.withColumns({own + "members": membership, row: F.monotonically_increasing_id()}))
    plan = plan_mix(numbered, F.col(own + "members"), carry=[row], **how).where("copies > 0").select(row, F.col("copies").alias(copies))
    return (
        numbered.join(plan, row)
        .withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
        .select(*docs.columns)
    )
