"""URL filter: rules, then exact list membership by a cascade of Bloom
filters, in built-in functions only and without a join per URL.

The *complete key universe* is every host, and every parent domain of one,
that the corpus holds, as far as it can be a domain name (``MAX_DOMAIN``
characters; a list can name no longer one). Level 0 encodes the listed keys;
level 1 the unlisted keys that level 0 takes for listed; level 2 the listed keys
that level 1 takes in, and so on until a level has no false positive left in the
universe.
For any key of the universe the answer is exact: listed if the first level
that does not hold the key has an odd number. Every level hashes with its own
seed, so two keys that collide on one level part on the next.

Building: distinct keys are one grouped aggregate (a hot host is one key),
stored once; each level is one pass over the keys that are left, whose bits
are combined by ``bit_or`` a 64-bit word. What reaches the driver, and every task, is
the filter, a few bits a listed key. ``judge_by_list`` cuts a list whose
filter would take more than ``max_filter_bytes`` into slices by a hash of the key:
each slice has a cascade of its own, and the URLs, with what they are known
to be so far, are written once a slice, so there are never two filters at a time.
Judging a URL is a projection: no shuffle.

Defined cases: a null URL, or one without ``://``, has empty host and path
and is allowed; of a host of any length only the domains of at most
``MAX_DOMAIN`` characters are looked up, so its work grows with its length (its
rule and its host column are those of the whole URL); an empty list, or an empty
table, makes a filter that lists nothing; the list is any column ``listed`` of the
universe (here: by first label, ``LISTED_LABELS``); repeated rows are judged alike; other
columns pass through, columns named like a result are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import lower_ascii, stored

# Rules of the contract: (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Domains that the block list names, by their first label.
LISTED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
MAX_FILTER_BYTES = 8 << 20  # of a level
RESULTS = ("host", "path", "rule", "verdict")
MAX_DOMAIN = 253  # characters of a domain name, by the DNS


def host_of(url: Column) -> Column:
    return _part(url, 1, lower=True)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def _part(url: Column, group: int, lower: bool = False) -> Column:
    at = F.instr(url, "://")
    after = F.substring(url, at + 3, F.length(url))
    got = F.regexp_extract(after, "^([^/?#]*)([^?#]*)", group)
    return F.when(at > 0, lower_ascii(got) if lower else got).otherwise(F.lit(""))


def domains(host: Column) -> Column:
    """The host and its parent domains of at most ``MAX_DOMAIN`` characters,
    longest first."""
    # of a longer host only the end is cut into labels; its first piece is a part of a label, or empty
    tail = F.substring(host, -(MAX_DOMAIN + 1), MAX_DOMAIN + 1)
    pieces = F.split(tail, r"\.")
    labels = F.when(F.length(host) <= MAX_DOMAIN, pieces).otherwise(F.slice(pieces, F.lit(2), F.size(pieces)))
    return F.transform(
        F.filter(F.sequence(F.lit(1), F.size(labels) + 1), lambda i: i <= F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


@dataclass
class Level:
    n_bits: int
    n_hashes: int
    words: list[int] = field(repr=False)


def _places(key: Column, seed: int, n_bits: int, n_hashes: int) -> Column:
    a = F.pmod(F.xxhash64(key, F.lit(2 * seed)), F.lit(n_bits))
    b = F.pmod(F.xxhash64(key, F.lit(2 * seed + 1)), F.lit(n_bits))
    return F.array(*[F.pmod(a + F.lit(j) * b, F.lit(n_bits)) for j in range(n_hashes)])


def _holds(key: Column, seed: int, level: Level) -> Column:
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")
    return F.forall(
        _places(key, seed, level.n_bits, level.n_hashes),
        lambda p: F.getbit(F.get(words, (p / 64).cast("int")), (p % 64).cast("int")) == 1,
    )


def _shape(n: int, n_others: int, seed: int) -> tuple[int, int]:
    """Bits and hashes of a level that holds ``n`` keys against ``n_others``."""
    # the first level is tight where few keys of many are listed; later levels halve
    rate = 0.5 if seed else min(0.5, max(1e-4, math.sqrt(0.5) * n / max(1, n_others)))
    n_bits = max(64, math.ceil(n * math.log2(1 / rate) / math.log(2)))
    return n_bits, min(16, max(1, round(n_bits / max(1, n) * math.log(2))))


def _level(keys: DataFrame, n: int, n_others: int, seed: int, max_bytes: int) -> Level:
    n_bits, n_hashes = _shape(n, n_others, seed)
    if n_bits > 8 * max_bytes:
        raise ValueError(f"a filter of {n} listed keys takes {n_bits // 8} bytes; the bound is {max_bytes}")
    place = F.explode(_places(F.col("key"), seed, n_bits, n_hashes))
    rows = (
        keys.select(place.alias("p"))
        .select((F.col("p") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("mask"))
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .collect()
    )
    words = [0] * ((n_bits + 63) // 64)
    for r in rows:
        words[r.word] = r.mask
    return Level(n_bits, n_hashes, words)


def _cascade(keys: DataFrame, max_filter_bytes: int) -> list[Level]:
    inside, outside = keys.where("listed"), keys.where("not listed")
    levels: list[Level] = []
    n, others = inside.count(), outside.count()
    while n:
        level = _level(inside, n, others, len(levels), max_filter_bytes)
        wrong = outside.where(_holds(F.col("key"), len(levels), level))
        levels.append(level)
        inside, outside, others = wrong, inside, n
        n = inside.count()
    return levels


def build_cascade(keys: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> list[Level]:
    """Levels for ``keys(key, listed)``, the whole universe, keys distinct.
    Raises ``ValueError`` where a level would take more than
    ``max_filter_bytes``; ``judge_by_list`` takes lists of any length."""
    return _cascade(stored(keys.select("key", "listed"), "url-keys"), max_filter_bytes)


def _slice(key: Column, n_slices: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(n_slices))


def listed(key: Column, levels: list[Level]) -> Column:
    """Exact membership of a key of the universe."""
    answer = F.lit(False)
    for seed in range(len(levels) - 1, -1, -1):
        answer = _holds(key, seed, levels[seed]) & ~answer
    return answer


def key_universe(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Every distinct ``key``: hosts of the corpus and their parent domains."""
    hosts = urls.select(host_of(F.col(url_col)).alias("host")).distinct()
    return hosts.select(F.explode(domains(F.col("host"))).alias("key")).distinct()


def _ruled(urls: DataFrame, rules: tuple[tuple[str, str, str], ...], url_col: str) -> DataFrame:
    """``row, host, path, rule, verdict`` of every URL, by the rules alone."""
    kept = [F.col(f"`{c}`") for c in urls.columns if c not in RESULTS or c == url_col]
    url = F.col(url_col)
    rows = urls.select(F.struct(*kept).alias("row"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rows.select("row", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def _result(rows: DataFrame, columns: list[str], blocked: Column) -> DataFrame:
    other = F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(
        *[F.col("row")[c].alias(c) for c in columns if c not in RESULTS],
        "host", "path", "rule", F.coalesce("verdict", other).alias("verdict"),
    )


def judge(
    urls: DataFrame,
    levels: list[Level],
    rules: tuple[tuple[str, str, str], ...] = RULES,
    url_col: str = "url",
) -> DataFrame:
    """``urls`` with ``host, path, rule, verdict``: the longest rule that fits
    decides, else the list: a URL is blocked if its host or a parent domain
    is listed."""
    blocked = F.exists(domains(F.col("host")), lambda key: listed(key, levels))
    return _result(_ruled(urls, rules, url_col), urls.columns, blocked)


def judge_by_list(
    urls: DataFrame,
    keys: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    url_col: str = "url",
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``judge`` by ``keys(key, listed)``, the whole universe, keys distinct,
    whatever the length of the list."""
    keys = stored(keys.select("key", "listed"), "url-keys")
    n = keys.agg(F.count_if("listed").alias("inside"), F.count_if(~F.col("listed")).alias("outside")).first()
    n_bytes = _shape(n.inside, n.outside, 0)[0] / 8
    if n_bytes <= max_filter_bytes:
        return judge(urls, _cascade(keys, max_filter_bytes), rules, url_col)
    n_slices = math.ceil(2 * n_bytes / max_filter_bytes)  # slices are not all alike
    rows = _ruled(urls, rules, url_col).withColumn("blocked", F.lit(False))
    for k in range(n_slices):
        levels = _cascade(keys.where(_slice(F.col("key"), n_slices) == k), max_filter_bytes)
        found = F.exists(domains(F.col("host")), lambda key: (_slice(key, n_slices) == k) & listed(key, levels))
        rows = stored(rows.withColumn("blocked", F.col("blocked") | found), "url-slices")
    return _result(rows, urls.columns, F.col("blocked"))
