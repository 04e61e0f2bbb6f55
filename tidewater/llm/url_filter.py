"""URL filters: blocked Bloom filter of listed canonical URLs, then exact join.

A listing holds canonical ``(host, path)`` prefixes with a verdict.  An entry
fits a URL if the URL's host is the entry's host or a subdomain of it and the
URL's path starts with the entry's path; the longest fitting entry wins.

1. Every distinct (host, path) of the URLs yields its candidate keys: host
   suffixes x path prefixes, only of the shapes (labels, path length) that
   occur in the listing.
2. The candidates look up a blocked Bloom filter: one 64-bit block per key, a
   row per block, ``BITS`` bits set per entry.  Most candidates end here.
3. What passes is joined exactly with the listing, which removes the filter's
   false positives.  The longest match goes back to the URLs by a join.

The filter has about one block per four entries.  It is broadcast only while
it has at most ``max_broadcast_rows`` rows; beyond that the lookup is a shuffle
join on the block number, over distinct candidates.  A host with a third of
all rows collapses in step 1 before any candidate is made.

Defined cases: a null url, or one without ``://``, has host and path ``''`` and
fits no entry; an empty listing fits nothing; repeated rows keep their rows;
repeated entries count once, and of equal entries with different verdicts the
larger (rule, verdict) wins.  Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import lower_ascii
from tidewater.operators.joins import broadcast_if_small

#: Bits set per entry, and entries per 64-bit block.
BITS, PER_BLOCK = 4, 4

LISTING = "host string, path string, rule string, verdict string, tier int"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z
    lower-cased; path: from there up to ``? #`` or the end."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return lower_ascii(host), F.regexp_extract(tail, r"^[^?#]*", 0)


def _block(host: Column, path: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(blocks))


def _mask(host: Column, path: Column) -> Column:
    h = F.xxhash64(path, host, F.lit(1))
    out = F.lit(0).cast("long")
    for k in range(BITS):
        bit = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return out


def bloom_blocks(listing: DataFrame) -> tuple[DataFrame, int]:
    """The filter as rows (block, bits), and its number of blocks."""
    blocks = max(1, listing.count() // PER_BLOCK)
    return (listing.groupBy(_block(F.col("host"), F.col("path"), blocks).alias("block"))
            .agg(F.bit_or(_mask(F.col("host"), F.col("path"))).alias("bits"))), blocks


def _candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Array of (host suffix, path prefix) of the listing's shapes."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    one = [F.when((F.length(host) > 0) & (n >= k) & (F.length(path) >= size), F.struct(
        F.array_join(F.slice(labels, n - k + 1, k), ".").alias("host"),
        F.substring(path, 1, size).alias("path"))) for k, size in shapes]
    return F.array_compact(F.array(*one)) if one else F.array().cast(
        "array<struct<host:string,path:string>>")


def judge(urls: DataFrame, listing: DataFrame, id_col: str, url_col: str,
          default: str = "allow") -> DataFrame:
    """Per row: id, host, path, rule (of tier 0, else null), verdict (the
    rule's, else that of the longest entry of another tier, else ``default``).

    The distinct shapes of the listing reach the driver: at most 127 labels
    times the longest listed path, whatever the listing's size.
    """
    host, path = host_and_path(F.col(url_col))
    rows = urls.select(F.col(id_col), host.alias("host"), path.alias("path"))
    blocks, n_blocks = bloom_blocks(listing)
    shapes = [tuple(r) for r in listing.select(
        F.size(F.split("host", r"\.", -1)), F.length("path")).distinct().collect()]

    cand = (rows.select("host", "path").distinct()
            .select("host", "path", F.explode(_candidates(
                F.col("host"), F.col("path"), sorted(shapes))).alias("c"))
            .select("host", "path", "c.host", "c.path")
            .toDF("host", "path", "c_host", "c_path")
            .withColumn("block", _block(F.col("c_host"), F.col("c_path"), n_blocks)))
    mask = _mask(F.col("c_host"), F.col("c_path"))
    possible = (cand.join(broadcast_if_small(blocks, n_blocks), "block")
                .filter(F.col("bits").bitwiseAND(mask) == mask)
                .drop("block", "bits"))
    exact = listing.select(F.col("host").alias("c_host"), F.col("path").alias("c_path"),
                           "rule", "verdict", "tier")
    size = F.length("c_host") + F.length("c_path")
    fit = F.struct(size.alias("size"), "rule", "verdict")
    best = (possible.join(exact, ["c_host", "c_path"]).groupBy("host", "path")
            .agg(F.max(F.when(F.col("tier") == 0, fit)).alias("by_rule"),
                 F.max(F.when(F.col("tier") != 0, fit)).alias("by_list")))
    return (rows.join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("by_rule.rule").alias("rule"),
                    F.coalesce("by_rule.verdict", "by_list.verdict", F.lit(default))
                    .alias("verdict")))
