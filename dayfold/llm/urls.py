"""URL filters: a blocked Bloom filter of listed keys before an exact hash join.

Listed are canonical URLs and rules. A rule is a host and a path prefix that ends with a slash,
such as ``example.net/en/``; it fits the host, its subdomains and every path that starts with the
prefix, and the longest rule that fits decides. A URL that no rule fits is blocked if its canonical
form is listed, else allowed. Every URL gives a few keys: its canonical form, and each suffix of
its host with each prefix of its path. A key whose bits are all set in its block of the filter is
a possible hit; an equality join with the listed keys removes the false ones.

The filter is a table of blocks of eight 32-bit words, made by one aggregation. It is broadcast
if its files are small and joined by block number otherwise, with the same hits; the list itself
likewise. A null URL or one without ``://`` has an empty host and path, no keys, and is allowed.
Repeated and equal URLs are judged once and all get that verdict. Rows keep their other columns
out of the way: only the URL is looked at. Empty lists and empty tables give no hits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .common import small_side, written

# Bits of the filter per listed key; a block has 256.
BITS_PER_KEY = 16

# One odd multiplier per word of a block, which picks the word's bit; those of the
# split-block filter in the Parquet format.
MULTIPLIERS = (
    0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31,
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``, null where there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    rest = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One form for URLs of the same page; null where the host is empty.

    Host and path without scheme, default port, a leading ``www.`` or ``m.``, fragment, closing
    slash, and without parameters that only tell where a visitor came from.
    """
    name = F.regexp_replace(F.regexp_replace(host(url), r":(80|443)?$", ""), r"^(www|m)\.", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)")))
    page = F.regexp_replace(path(url), r"/+$", "")
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(name != "", F.concat(name, F.coalesce(page, F.lit("")), F.coalesce(tail, F.lit(""))))


def rule_keys(url: Column) -> Column:
    """Every suffix of the host, cut at dots, with every prefix of the path that ends with a slash."""
    parts, pages = F.split(host(url), r"\."), F.split(path(url), "/")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    prefixes = F.when(F.size(pages) > 1, F.transform(
        F.sequence(F.lit(1), F.size(pages) - 1),
        lambda i: F.concat(F.array_join(F.slice(pages, F.lit(1), i), "/"), F.lit("/")),
    )).otherwise(F.array().cast("array<string>"))
    pairs = F.flatten(F.transform(hosts, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    return F.when(host(url) != "", pairs).otherwise(F.array().cast("array<string>"))


def _bit(h: Column, i: int) -> Column:
    """The bit that a key sets in word i, from the low half of its hash."""
    low = h.bitwiseAND(F.lit(0x7FFFFFFF))  # 31 bits, so that the product stays within a long
    return F.shiftright((low * F.lit(MULTIPLIERS[i])).bitwiseAND(F.lit(0xFFFFFFFF)), 27)


def _mask(h: Column, i: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), _bit(h, i).cast("int"))


def _block(h: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h, 32), F.lit(blocks))


def bloom_filter(keys: DataFrame, key: str, bits_per_key: int = BITS_PER_KEY) -> tuple[DataFrame, int]:
    """The blocks that have bits set, as rows of ``block`` and ``w0`` to ``w7``, and their number in all."""
    blocks = max(1, -(-keys.count() * bits_per_key // 256))
    hashed = keys.select(F.xxhash64(key).alias("h"))
    words = [F.bit_or(_mask(F.col("h"), i)).alias(f"w{i}") for i in range(8)]
    return written(hashed.groupBy(_block(F.col("h"), blocks).alias("block")).agg(*words), "bloom"), blocks


def possible(keys: DataFrame, key: str, bloom: tuple[DataFrame, int]) -> DataFrame:
    """Rows whose key may be in the filter: all of those that are, and few others."""
    table, blocks = bloom
    h = F.xxhash64(F.col(f"k.{key}"))
    test = F.col("b.block") == _block(h, blocks)
    for i in range(8):
        test = test & (F.col(f"b.w{i}").bitwiseAND(_mask(h, i)) != 0)
    return keys.alias("k").join(small_side(table).alias("b"), test, "left_semi")


def rules_table(spark, blocked: Sequence[tuple[str, str]], allowed: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules of (host, path) as rows of ``rule`` and ``verdict``."""
    rows = [(h + p, "block") for h, p in blocked] + [(h + p, "allow") for h, p in allowed]
    return spark.createDataFrame(rows, "rule string, verdict string")


def judged(pages: DataFrame, listed: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Distinct URLs with ``host``, ``path``, ``rule``, ``verdict`` and whether they are ``listed``.

    ``listed`` has canonical URLs in ``canonical``, ``rules`` has ``rule`` and ``verdict``.
    """
    # Rules and canonical URLs are told apart by a leading mark, so neither passes for the other.
    entries = listed.filter("canonical IS NOT NULL").select(
        F.concat(F.lit("u "), "canonical").alias("key"), F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict")
    ).distinct().unionByName(rules.select(F.concat(F.lit("r "), "rule").alias("key"), "rule", "verdict").distinct())
    entries = written(entries, "listed")
    bloom = bloom_filter(entries, "key")
    column = F.col("url")
    urls = pages.select(F.col(f"`{url}`").alias("url")).filter("url IS NOT NULL").distinct()
    keys = F.array_compact(F.concat(
        F.array(F.concat(F.lit("u "), canonical(column))), F.transform(rule_keys(column), lambda k: F.concat(F.lit("r "), k))))
    hits = possible(urls.select("url", F.explode(F.array_distinct(keys)).alias("key")), "key", bloom)
    exact = hits.join(small_side(entries), "key")
    longest = F.max(F.when(F.col("rule").isNotNull(), F.struct(
        F.length("rule").alias("n"), F.col("rule"), F.col("verdict"))))
    found = exact.groupBy("url").agg(longest.alias("r"), F.count(F.when(F.col("rule").isNull(), 1)).alias("n"))
    return found.select("url", F.col("r.rule"), F.col("r.verdict"), (F.col("n") > 0).alias("listed"))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: DataFrame, keep: Sequence[str], url: str = "url") -> DataFrame:
    """``keep`` columns of each page with ``host``, ``path``, ``rule``, ``verdict`` and ``listed``."""
    verdicts = judged(pages, listed, rules, url)
    own = pages.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{url}`").alias("u"))
    joined = own.join(verdicts, own["u"] == verdicts["url"], "left")
    on_list = F.coalesce("listed", F.lit(False))
    return joined.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        host(F.col("u")).alias("host"), path(F.col("u")).alias("path"), "rule",
        F.coalesce("verdict", F.when(on_list, "block").otherwise("allow")).alias("verdict"), on_list.alias("listed"),
    )
