"""URL filters: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

The longest rule that fits a page's host (or a parent domain) and path decides. Pages without a rule are looked up in the
list: a blocked Bloom filter (512-bit blocks, eight bits a URL) passes possible hits to an exact hash join, which removes
the false positives. The filter has at most ``MAX_BLOCKS`` blocks whatever the list's length, so its broadcast is bounded;
a longer list only lets more pages through to the join.

Defined results: a null url, or one without ``://``, has empty host and path and is allowed; repeated pages give repeated
rows; nulls and repeats in the list do not matter; an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickweave.llm.common import LOWER, UPPER

MAX_BLOCKS, WORDS, BITS_PER_URL = 1 << 16, 8, 16  # 65,536 blocks of 64 bytes: 4 MiB


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One spelling for the addresses of a page: without ``www.``/``m.``, a final slash, ``.html``, query and fragment."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(/|\.html)$", ""))


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of the rules (``host/path`` to verdict) that fits, or null. The rules are a short parameter."""
    ordered = sorted(rules, key=lambda r: (-len(r), r))
    fits = F.lit(None).cast("string")
    for rule in reversed(ordered):
        name, slash, rest = rule.partition("/")
        fits = F.when(((host == name) | host.endswith("." + name)) & path.startswith(slash + rest), F.lit(rule)).otherwise(fits)
    return fits


def _place(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """A URL's block, and its mask for each word of it: one bit a word, from one 64-bit hash."""
    h, g = F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2))
    return F.pmod(h, F.lit(blocks)).cast("int"), [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(g, 6 * k).bitwiseAND(F.lit(63)).cast("int")) for k in range(WORDS)]


def blocks_for(count: int) -> int:
    blocks = 1
    while blocks * 512 < count * BITS_PER_URL and blocks < MAX_BLOCKS:
        blocks *= 2
    return blocks


def blocked_bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter as rows ``block, m0..m7`` over the one column of ``keys``."""
    block, masks = _place(F.col(keys.columns[0]), blocks)
    return keys.select(block.alias("block"), *[m.alias(f"m{k}") for k, m in enumerate(masks)]).groupBy("block").agg(*[F.bit_or(f"m{k}").alias(f"m{k}") for k in range(WORDS)])


def listed(df: DataFrame, key: str, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits ``df`` into rows whose ``key`` is in the one column of ``listing``, and the others."""
    urls = listing.select(F.col(listing.columns[0]).alias("listed_url")).filter(F.col("listed_url").isNotNull()).distinct()
    blocks = blocks_for(urls.count())
    bloom = blocked_bloom(urls, blocks)
    block, masks = _place(F.col(key), blocks)
    probed = df.join(F.broadcast(bloom), block == F.col("block"), "left")  # at most MAX_BLOCKS rows of 64 bytes
    possible = F.coalesce(F.lit(True), F.lit(True))
    for k, mask in enumerate(masks):
        possible = possible & (F.col(f"m{k}").bitwiseAND(mask) != 0)
    probed = probed.select(*df.columns, F.coalesce(possible, F.lit(False)).alias("possible"))
    hits = probed.filter("possible").drop("possible").join(urls, F.col(key) == F.col("listed_url"), "left")
    inside = hits.filter(F.col("listed_url").isNotNull()).drop("listed_url")
    outside = hits.filter(F.col("listed_url").isNull()).drop("listed_url").unionByName(probed.filter(~F.col("possible")).drop("possible"))
    return inside, outside


def filter_urls(df: DataFrame, rules: dict[str, str], listing: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, canonical_url`` for every page."""
    u = F.col(url).cast("string")
    rows = df.select(F.col(page_id).alias("page_id"), host_of(u).alias("host"), path_of(u).alias("path"))
    rows = rows.select("*", rule_for(F.col("host"), F.col("path"), rules).alias("rule"), canonical(F.col("host"), F.col("path")).alias("canonical_url"))
    ruled = rows.filter(F.col("rule").isNotNull())
    verdicts = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in rules.items()], F.lit(None).cast("string"))
    inside, outside = listed(rows.filter(F.col("rule").isNull()), "canonical_url", listing)
    parts = [ruled.withColumn("verdict", verdicts), inside.withColumn("verdict", F.lit("block")), outside.withColumn("verdict", F.lit("allow"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("page_id", "host", "path", "rule", "verdict", "canonical_url")
