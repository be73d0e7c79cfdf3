"""URL filters: host and path rules, and a list of URLs behind a blocked Bloom filter."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The filter: blocks of 8 words of 32 bits; a URL sets one bit in each word of its block.
BLOCK_WORDS = 8
URLS_PER_BLOCK = 16
# Up to so many blocks (64 bytes a row) the filter is broadcast; a longer list is joined at once.
MAX_BLOCKS = 1 << 18
# Query parameters that do not name a page. Fixed values.
TRACKING = ("utm_[a-z]+", "ref", "fbclid", "gclid")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def url_host(url: Column) -> Column:
    """What is after the first `://` up to `/`, `?` or `#`, A-Z lower-cased; empty without `://`."""
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*+)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to `?` or `#`; empty without `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*+([^?#]*+)", 1)


def canonical_url(url: Column) -> Column:
    """host/path?query: without scheme, `www.`, `m.`, fragment, tracking parameters, closing slash."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_replace(url_host(url), r"\A(?:www|m)\.", "")
    path = F.regexp_replace(url_path(url), r"/+\z", "")
    query = F.regexp_extract(url, r"(?s)\A[^?#]*+\?([^#]*+)", 1)
    parameters = F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike(rf"\A(?:{'|'.join(TRACKING)})(?:=|\z)")
    )
    kept = F.array_join(F.array_sort(parameters), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """STRUCT<rule, verdict> of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda rule: (len(rule.name), rule.name)):
        on_host = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = on_host & F.startswith(path, F.lit(rule.path))
        named = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("bigint"))


def _bit(key: Column, word: int) -> Column:
    """The bit that a key sets in a word of its block."""
    place = F.pmod(F.xxhash64(key, F.lit(word)), F.lit(32).cast("bigint")).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0..w7): the filter as a table, one row for each block that is not empty."""
    words = [F.bit_or(_bit(F.col(key), word)).alias(f"w{word}") for word in range(BLOCK_WORDS)]
    return keys.groupBy(_block(F.col(key), blocks).alias("block")).agg(*words)


def listed_urls(urls: DataFrame, listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Rows of `urls` (key, ...) whose canonical URL `key` is in `listed` (key), all copies.

    A blocked Bloom filter of the list, broadcast while it has at most `max_blocks` blocks, passes
    what may be listed; an exact join takes out its false positives. A longer list goes to the
    exact join at once. Null keys are never listed; the list may repeat keys.
    """
    listed = listed.select("key").where("key IS NOT NULL").distinct()
    blocks = max(1, -(-listed.count() // URLS_PER_BLOCK))
    if blocks <= max_blocks:
        table = F.broadcast(bloom_blocks(listed, "key", blocks))
        possible = urls.withColumn("block", _block(F.col("key"), blocks)).join(table, "block")
        for word in range(BLOCK_WORDS):
            bit = _bit(F.col("key"), word)
            possible = possible.where(F.col(f"w{word}").bitwiseAND(bit) == bit)
        urls = possible.select(*urls.columns)
    return urls.join(listed, "key", "left_semi")


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of `pages` (page_id, url).

    verdict is that of the longest rule that fits; without one, block when the canonical URL is in
    `listed` (key: canonical URLs), else allow. A null url, or one without `://`, has an empty host
    and path, fits no rule and is allowed unless an empty key is listed. Equal rows are all judged.
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    named = pages.select("page_id", "url").withColumns({"host": host, "path": path, "key": canonical_url(F.col("url"))})
    ruled = named.withColumn("match", matching_rule(F.col("host"), F.col("path"), rules))
    # Only URLs without a rule are looked up, each different one once.
    asked = ruled.where("match IS NULL").select("key").distinct()
    hits = listed_urls(asked, listed).withColumn("hit", F.lit(True))
    judged = ruled.join(hits, "key", "left")
    method = F.when(F.col("hit"), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path",
        F.col("match.rule").alias("rule"),
        F.coalesce("match.verdict", method).alias("verdict"),
    )
