"""URL verdicts: rules first, then a logistic regression on hashed character n-grams.

Everything that touches a row is a DataFrame expression. The model is fitted on the driver from
a small table of labelled URLs, and its weights are whole numbers, so a verdict is exact
arithmetic and the same wherever it is computed.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import unused

# The rules (verdict, host and path prefix) of the registered query.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# The labelled URL table: words that stand in hosts of unwanted pages and of wanted ones, as
# they are met on the open web. 1: unwanted.
_UNWANTED = (
    "casino", "onlinecasino", "casinoroyale", "roulette", "slots", "jackpot", "poker", "betting", "sportsbet", "freebet",
    "freespins", "bookmaker", "pills", "pillstore", "viagra", "cialis", "nopharmacy", "cheapmeds", "dietpills", "steroids",
    "xxx", "porn", "sexcam", "adultvideo", "nudes", "escort", "hotsingles", "payday", "fastcash", "quickloan",
    "badcredit", "replica", "fakewatches", "freeiphone", "winprize", "lottery", "getrich", "doublebitcoin", "cryptoprofit", "malware",
    "warez", "crack", "keygen", "torrent", "serials", "spyware", "clickads", "adtracker", "popunder", "adserver",
)
_WANTED = (
    "library", "university", "school", "college", "museum", "theatre", "gallery", "orchestra", "archive", "history",
    "encyclopedia", "dictionary", "science", "research", "institute", "journal", "physics", "biology", "medicine", "hospital",
    "clinic", "health", "news", "dailynews", "weather", "radio", "council", "city", "government", "parliament",
    "court", "police", "travel", "maps", "railway", "airport", "recipes", "kitchen", "garden", "farming",
    "football", "chess", "club", "community", "forum", "software", "opensource", "developer", "books", "publisher",
    "reader", "photo", "music", "film", "nature", "ocean", "forest", "energy", "engineer", "builder",
    "market", "bank", "insurance", "shop", "furniture", "bicycle", "church", "charity", "foundation", "family",
)
_FORMS = ("https://{}.test", "http://www.the-{}.test", "http://{}-site.test", "https://my{}24.test")
_UNWANTED_PATHS = ("/win/bonus", "/free-spins", "/order-pills", "/watch/xxx", "/claim-prize", "/apply-loan", "/crack.exe")
_WANTED_PATHS = ("/about", "/article/history", "/catalogue", "/course/notes", "/minutes.pdf", "/wiki/Main_Page", "/contact")
LABELLED_URLS = tuple(
    (form.format(word) + paths[(i + k) % len(paths)], label)
    for words, paths, label in ((_UNWANTED, _UNWANTED_PATHS, 1), (_WANTED, _WANTED_PATHS, 0))
    for i, word in enumerate(words)
    for k, form in enumerate(_FORMS)
)

#: Paths that say nothing about a page: every labelled host is also seen with each of them.
NEUTRAL_PATHS = ("", "/index.html", "/page/2")
#: Added to the log-odds: unwanted pages are rarer in the wild than in the table, and a host of
#: which nothing is known is allowed.
PRIOR_SHIFT = -1.0
BUCKETS = 16384
SCALE = 1 << 16
GRAMS = (3, 4, 5)
# Multipliers of the n-gram hash, by position, and what tells the parts apart.
FACTORS = (7919, 104729, 1299709, 15485863, 179424673)
SALTS = {"host": 17, "path": 71}
#: What no part of a URL holds, put around each part so that n-grams see its ends.
EDGES = ("\x02", "\x03")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty if it is null or has no ``://``."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    host = F.translate(
        F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return host, F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does.

    A rule fits its host and every subdomain of it if the path starts with the rule's path.
    """
    which, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        rule_host, slash, tail = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + tail)
        which, verdict = F.when(fits, F.lit(rule)).otherwise(which), F.when(fits, F.lit(said)).otherwise(verdict)
    return which, verdict


@dataclass(frozen=True)
class UrlModel:
    """Whole-number weights, one for each hash bucket, and a bias."""

    weights: tuple[int, ...]
    bias: int


def _bucket_list(part: str, kind: str) -> list[int]:
    codes = [ord(c) for c in EDGES[0] + part + EDGES[1]]
    return [
        (sum(codes[i + k] * FACTORS[k] for k in range(n)) + SALTS[kind] * n) % BUCKETS
        for n in GRAMS
        for i in range(len(codes) - n + 1)
    ]


def _parts(url: str) -> tuple[str, str]:
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[cut:]
    return rest[:cut].lower(), path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]


@functools.cache
def train(labelled=LABELLED_URLS, rounds: int = 250, rate: float = 0.5, l2: float = 2e-3) -> UrlModel:
    """Fit the regression by full-batch gradient steps; same table, same model, fitted once."""
    seen = [(_parts(url), label) for url, label in labelled]
    seen += [((host, path), label) for (host, _), label in seen for path in NEUTRAL_PATHS]
    found = [_bucket_list(host, "host") + _bucket_list(path, "path") for (host, path), _ in seen]
    used = sorted({b for buckets in found for b in buckets})
    place = {b: i for i, b in enumerate(used)}
    x = np.zeros((len(seen), len(used)), np.float32)
    y = np.array([label for _, label in seen], np.float32)
    for row, buckets in enumerate(found):
        for b in buckets:
            x[row, place[b]] += 1
    fitted, bias = np.zeros(len(used), np.float32), 0.0
    for _ in range(rounds):
        miss = 1 / (1 + np.exp(-(x @ fitted + np.float32(bias)))) - y
        fitted -= rate * (x.T @ miss / len(y) + l2 * fitted)
        bias -= rate * float(miss.mean())
    w = np.zeros(BUCKETS)
    w[used] = fitted
    return UrlModel(tuple(int(v) for v in np.rint(w * SCALE)), round((bias + PRIOR_SHIFT) * SCALE))


def _add_gram(codes: Column, weights: Column, kind: str, n: int):
    def add(total: Column, i: Column) -> Column:
        mixed = F.lit(SALTS[kind] * n).cast("long")
        for k in range(n):
            mixed = mixed + F.element_at(codes, i + k) * F.lit(FACTORS[k]).cast("long")
        return total + F.element_at(weights, (mixed % BUCKETS + 1).cast("int"))

    return add


def _part_score(codes: Column, kind: str, weights: Column) -> Column:
    total = F.lit(0).cast("long")
    for n in GRAMS:
        places = F.when(F.size(codes) >= n, F.sequence(F.lit(1), F.size(codes) - (n - 1))).otherwise(
            F.array().cast("array<int>")
        )

        total = total + F.aggregate(places, F.lit(0).cast("long"), _add_gram(codes, weights, kind, n))
    return total


def judge_urls(pages: DataFrame, url_col: str = "url", rules=RULES, model: UrlModel | None = None) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` and ``score`` to pages.

    The longest rule that fits decides. Otherwise the regression does: ``block`` if the scaled
    log-odds ``score`` are above 0. A null URL, or one without ``://``, has an empty host and
    path and is judged by the regression like any other. Columns of the same names are
    replaced; repeated rows are judged alike; rows are neither added nor lost.
    """
    model = model or train()
    # one literal, turned into an array once while the plan is made
    weights = F.split(F.lit(",".join(map(str, model.weights))), ",").cast("array<bigint>")
    own = unused(pages.columns, "_url_")
    host, path = split_url(F.col(url_col))
    parted = pages.withColumns({own + "host": host, own + "path": path})
    h, p = F.col(own + "host"), F.col(own + "path")
    for kind in SALTS:
        text = F.concat(F.lit(EDGES[0]), F.col(own + kind), F.lit(EDGES[1]))
        found = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
        parted = parted.withColumn(f"{own}{kind}_codes", F.transform(found, lambda c: F.ascii(c).cast("long")))
    rule, said = match_rule(h, p, rules)
    score = F.lit(model.bias).cast("long")
    for kind in SALTS:
        score = score + _part_score(F.col(f"{own}{kind}_codes"), kind, weights)
    parted = parted.withColumns({own + "score": score, own + "rule": rule, own + "said": said})
    judged = F.coalesce(own + "said", F.when(F.col(own + "score") > 0, F.lit("block")).otherwise(F.lit("allow")))
    new = {"host": h, "path": p, "rule": F.col(own + "rule"), "score": F.col(own + "score"), "verdict": judged}
    return parted.withColumns(new).drop(*(c for c in parted.columns if c.startswith(own)))


def oracle(model: UrlModel | None = None, rules=RULES) -> str:
    """DuckDB SQL of :func:`judge_urls` over the table ``pages``."""
    model = model or train()
    arms = sorted(rules, key=lambda x: (-len(x[1]), x[1]))

    def fits(rule: str) -> str:
        host, slash, tail = rule.partition("/")
        return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + tail}'))"

    def case(value) -> str:
        return "CASE " + " ".join(f"WHEN {fits(r)} THEN '{value(v, r)}'" for v, r in arms) + " END"

    def part(kind: str) -> str:
        sums = []
        for n in GRAMS:
            mixed = " + ".join([str(SALTS[kind] * n), *(f"{kind}_codes[i + {k}] * {FACTORS[k]}" for k in range(n))])
            sums.append(
                f"coalesce(list_sum([w[({mixed}) % {BUCKETS} + 1] for i in range(1, len({kind}_codes) - {n - 2})]), 0)"
            )
        return " + ".join(sums)

    return f"""
WITH rested AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parted AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rested
), coded AS (
  SELECT *, [unicode(c)::BIGINT for c in string_split(chr(2) || host || chr(3), '')] AS host_codes,
    [unicode(c)::BIGINT for c in string_split(chr(2) || path || chr(3), '')] AS path_codes,
    {list(model.weights)}::BIGINT[] AS w
  FROM parted
), scored AS (
  SELECT *, ({part("host")} + {part("path")} + {model.bias})::BIGINT AS score FROM coded
)
SELECT page_id, host, path, {case(lambda v, r: r)} AS rule, score,
  coalesce({case(lambda v, r: v)}, CASE WHEN score > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM scored
"""
