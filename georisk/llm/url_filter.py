"""URL filter: host and path rules first, then a list of canonical URLs.

URLs that no rule decides are looked up in the list.  A blocked Bloom filter
of the listed canonical URLs, one 256-bit block a key with one bit in each of
its eight words, passes the possible hits; only those go through an exact hash
join with the list, which removes the false positives.  The filter is one
aggregation (bitwise or per block) and one broadcast of at most ``max_blocks``
rows, whatever the length of the list: a longer list lets more false positives
through to the join, never a wrong verdict.  All steps are built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|\\z)"
# odd multipliers of the split block filter, one per word
SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query; all empty for null or a URL without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, "^[^?#]*\\?([^#]*)", 1)
    return host, path, query


def canonical_url(url: Column) -> Column:
    """Host without ``www.``, path without closing slashes, query sorted without tracking; null without a host.

    Scheme and fragment don't count.
    """
    host, path, query = split_url(url)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(F.regexp_replace(host, "^www\\.", ""), F.regexp_replace(path, "/+\\z", ""), query))


def rule_of(host: Column, path: Column, rules: list[Rule], what: str) -> Column:
    """``what`` ("name" or "verdict") of the longest rule that fits; null if none does."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.lit(getattr(r, what))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("string")


def _masks(h: Column) -> list[Column]:
    """One bit in each word, from the low half of the hash."""
    low = h.bitwiseAND(F.lit(0x7FFFFFFF))
    bit = [F.shiftrightunsigned((low * F.lit(s)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int") for s in SALTS]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), b) for b in bit]


def _block(h: Column, blocks: int) -> Column:
    return F.shiftrightunsigned(h, 32) % blocks


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """``block, w0 .. w7`` over ``listed(canonical)``: at most ``blocks`` rows."""
    h = F.xxhash64("canonical")
    marked = listed.select(_block(h, blocks).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_masks(h))])
    return marked.groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(len(SALTS))])


def possibly_listed(urls: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """``urls(canonical, ...)`` with ``possible``: false only for URLs that are not listed."""
    h = F.xxhash64("canonical")
    held = [F.coalesce(F.col(f"w{i}").bitwiseAND(m) != 0, F.lit(False)) for i, m in enumerate(_masks(h))]
    possible = F.col("canonical").isNotNull()
    for x in held:
        possible = possible & x
    keyed = urls.withColumn("block", F.coalesce(_block(h, blocks), F.lit(-1).cast("long")))
    return (keyed.join(F.broadcast(bloom), "block", "left")  # at most max_blocks rows of 72 bytes
            .withColumn("possible", possible).drop("block", *[f"w{i}" for i in range(len(SALTS))]))


def judge(urls: DataFrame, listed: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
          listed_verdict: str = "block", other_verdict: str = "allow", keys_per_block: int = 16,
          max_blocks: int = 1 << 16) -> DataFrame:
    """``page_id, url, host, path, rule, listed, verdict`` per row of ``urls``.

    ``listed`` has a column ``url``; its rows are made canonical, null ones and
    those without a host are left out, repeated ones count once.  ``listed`` in
    the result is null where a rule decides, as the list is not asked then.
    Other columns of ``urls`` are not read; repeated rows and null ids stay.
    """
    wanted = cut_lineage(listed.select(canonical_url(F.col("url")).alias("canonical")).filter("canonical is not null").distinct(),
                         "listed")
    n, blocks = wanted.count(), 1
    while blocks < max_blocks and blocks * keys_per_block < n:
        blocks *= 2
    host, path, _ = split_url(F.col("url"))
    rows = (urls.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
            .select("page_id", "url", host.alias("host"), path.alias("path"))
            .select("*", rule_of(F.col("host"), F.col("path"), rules, "name").alias("rule"),
                    rule_of(F.col("host"), F.col("path"), rules, "verdict").alias("ruled")))
    asked = rows.withColumn("canonical", F.when(F.col("rule").isNull(), canonical_url(F.col("url"))))
    probed = possibly_listed(asked, bloom_filter(wanted, blocks), blocks)
    none = probed.filter(~F.col("possible")).withColumn("listed", F.when(F.col("rule").isNull(), F.lit(False)))
    exact = (probed.filter("possible").join(wanted.withColumn("hit", F.lit(True)).hint("shuffle_hash"), "canonical", "left")
             .withColumn("listed", F.coalesce("hit", F.lit(False))))
    columns = ["page_id", "url", "host", "path", "rule", "ruled", "listed"]
    verdict = F.coalesce("ruled", F.when(F.col("listed"), listed_verdict).otherwise(other_verdict))
    return (none.select(columns).unionByName(exact.select(columns))
            .select("page_id", "url", "host", "path", "rule", "listed", verdict.alias("verdict")))


def urls_of_labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``url`` of the pages whose document, the number that ends the path, is labelled toxic or of quality 0."""
    number = F.regexp_extract(split_url(F.col("url"))[1], "/([0-9]{1,18})[^/]*/?\\z", 1)
    bad = labels.filter("toxic = 1 OR quality = 0").select(F.col("doc_id").cast("long").alias("doc")).distinct()
    return (pages.select("url", number.alias("n")).filter("n <> ''").select("url", F.col("n").cast("long").alias("doc"))
            .join(bad, "doc").select("url"))
