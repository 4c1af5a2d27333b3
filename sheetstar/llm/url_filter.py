"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact join for its hits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed rules of the query: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: A block is four 64-bit words; each key sets one bit in each word.
WORDS = 4
BITS_PER_KEY = 16
#: The filter is sent to all tasks only below this size; beyond it, it is joined by block.
BROADCAST_BYTES = 32 << 20
#: Pages with so many links for each paragraph make up the list of the query.
LINKS_PER_PARAGRAPH = 3


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or none."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the host to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, and the path without slashes or ``.html`` at its end.

    Scheme, query and fragment are left out. Empty where there is no host.
    """
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.when(host == "", F.lit("")).otherwise(F.concat(bare, F.regexp_replace(path, r"(\.html)?/*$", "")))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null for none.

    A rule fits its host and all subdomains if the path starts with the rule's. Longest is by the
    length of host and path together; of equal ones the first in text order.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, kind in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One bit for each word of a block, from a second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(WORDS)]


def build_filter(listed: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The filter as a table ``_block, _w0 .. _w3``, and its number of blocks.

    Keys are combined per block before the shuffle, so a key listed often costs nothing more.
    """
    keys = listed.select(F.col(column).alias("_key")).filter("_key is not null and _key <> ''")
    n = keys.agg(F.approx_count_distinct("_key")).first()[0]
    blocks = 1 << max(0, math.ceil(math.log2(max(1, n * BITS_PER_KEY / (64 * WORDS)))))
    made = keys.select(_block(F.col("_key"), blocks).alias("_block"), *[b.alias(f"_b{i}") for i, b in enumerate(_bits(F.col("_key")))])
    return made.groupBy("_block").agg(*[F.bit_or(f"_b{i}").alias(f"_w{i}") for i in range(WORDS)]), blocks


def possible_keys(keys: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """The rows of ``keys`` that the Bloom filter passes: all that the list holds, and few others."""
    bloom, blocks = build_filter(listed, listed_column)
    if blocks * 8 * (WORDS + 1) <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)
    probe = keys.withColumn("_block", _block(F.col(column), blocks))
    passed = probe.join(bloom, "_block")
    for i, bit in enumerate(_bits(F.col(column))):
        passed = passed.filter(F.col(f"_w{i}").bitwiseAND(bit) != 0)
    return passed.filter(F.col(column) != "").select(*[F.col(c) for c in keys.columns])


def listed_keys(keys: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """The rows of ``keys`` (a column of distinct or repeated keys) that the list holds.

    The Bloom filter drops nearly all others before anything of theirs moves; what it lets through
    meets the list in a join on the whole key, which removes false positives. Null and empty keys
    are on no list. Extra columns of ``keys`` stay; those of ``listed`` aren't read.
    """
    passed = possible_keys(keys, column, listed, listed_column)
    exact = listed.select(F.col(listed_column).alias(column)).filter(F.col(column) != "").distinct()
    return passed.join(exact, column, "left_semi")


def judge(pages: DataFrame, listed: DataFrame, listed_column: str = "canonical", rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, canonical`` for every row of ``pages (page_id, url)``.

    The longest rule that fits decides; else the list: ``block`` for a listed canonical URL, ``allow``
    otherwise. Null urls and those without ``://`` have empty host and path, fit no rule and are allowed.
    Repeated rows give repeated rows; other columns of ``pages`` aren't read; empty tables give no rows.
    """
    url = F.col("url")
    seen = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    seen = seen.select("*", canonical(F.col("host"), F.col("path")).alias("canonical"), rule.alias("rule"), verdict.alias("_ruled"))
    # Only keys no rule decides are asked, each once.
    asked = seen.filter("_ruled is null").select("canonical").distinct()
    found = listed_keys(asked, "canonical", listed, listed_column).withColumn("_listed", F.lit(True))
    method = F.when(F.col("_listed"), F.lit("block")).otherwise(F.lit("allow"))
    return seen.join(found, "canonical", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("_ruled", method).alias("verdict"), "canonical"
    )


def _occurrences(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part)))) / len(part)


def listed_pages(pages: DataFrame) -> DataFrame:
    """The list of the query: canonical URLs of link farms, pages whose html has ``LINKS_PER_PARAGRAPH`` links or more a paragraph.

    No URL tells which these are. Every other page of the same canonical URL (another scheme, query,
    ``www.`` or ``m.``) is listed with them. Pages without html or links list nothing.
    """
    url, html = F.col("url"), F.col("html")
    links, paragraphs = _occurrences(html, "<a "), _occurrences(html, "<p>")
    return (
        pages.filter((links > 0) & (links >= LINKS_PER_PARAGRAPH * paragraphs))
        .select(host_of(url).alias("host"), path_of(url).alias("path"))
        .select(canonical(F.col("host"), F.col("path")).alias("canonical"))
    )
