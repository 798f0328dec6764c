"""URL filtering by rules and by a list of canonical URLs behind a blocked Bloom filter.

A listed entry is a host with a path prefix, like "spam.example/" or "example.org/shop/", or with a page's whole path, like
"example.org/page.html". Entries and URLs are made canonical alike: no scheme, user, "www.", port, query, fragment or final dot of the host, A-Z
of the host lower-cased, dot segments resolved, and percent-encoded letters, digits, "-", ".", "_" and "~" decoded (other escapes in capitals).
A URL is tried with each suffix of its host and each directory prefix of its path, and the whole path. The filter is built by
aggregation (bitwise or of the entries of each 512-bit block), its size is bounded by a parameter, and only tries that pass it go
to an exact hash join with the list, which removes the false positives: the verdicts don't depend on the filter's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import free

#: (verdict, host and path), as in the queries' contract.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Listed canonical URLs of op7_url_filter.
LISTED = tuple(f"{name}.example.{tld}/" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for tld in ("com", "net", "org"))
#: Bits an entry, and most blocks of 512 bits (64 bytes each).
BITS, BLOCKS = 16, 1 << 20
SALTS = np.array([0x47B6137B44974D91, 0x8824AD5BA2B7289D, 0x705495C72DF1424B, 0x9EFC49475C6BFB31, 0xA2B7289D47B6137B, 0x5C6BFB319EFC4947, 0x2DF1424B70549541, 0x44974D918824AD5B], np.uint64)


def place(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, 8 words) of 64-bit hashes: one bit in each word of one block."""
    h = h.view(np.uint64)
    with np.errstate(over="ignore"):
        words = np.uint64(1) << ((h[:, None] * SALTS) >> np.uint64(58))
    return ((h >> np.uint64(17)) % np.uint64(blocks)).astype(np.int64), words.view(np.int64)


def host_and_path(pages: DataFrame) -> DataFrame:
    """pages with host and path; both empty where url is null or has no "://"."""
    rest = F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumns({"host": F.coalesce(lower, F.lit("")), "path": F.coalesce(path, F.lit(""))})


def canonical_host(host: Column) -> Column:
    """host in lower case (A-Z) without user, "www.", port and final dot."""
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.regexp_replace(lower, r"^(?:[^@]*@)?(?:www\.)?", ""), r"\.?(?::[0-9]*)?$", "")


def canonical_path(path: Column) -> Column:
    """path, which begins with a slash or is empty, with escapes of unreserved characters decoded and dot segments resolved."""

    def decoded(part: Column) -> Column:
        code = F.upper(F.substring(part, 1, 2))
        char = F.char(F.conv(code, 16, 10).cast("long"))
        rest = F.substring(part, 3, 1 << 30)
        return F.when(code.rlike("^[0-9A-F]{2}$"), F.concat(F.when(char.rlike("^[A-Za-z0-9._~-]$"), char).otherwise(F.concat(F.lit("%"), code)), rest)).otherwise(F.concat(F.lit("%"), part))

    plain = F.when(path.contains("%"), F.array_join(F.transform(F.split(path, "%"), lambda x, k: F.when(k == 0, x).otherwise(decoded(x))), "")).otherwise(path)

    def step(out: Column, x: Column) -> Column:
        shorter = F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(1)))  # the empty piece before the first slash stays
        return F.when(x == ".", out).when(x == "..", shorter).otherwise(F.array_append(out, x))

    pieces = F.split(F.concat(plain, F.when(plain.rlike(r"/\.\.?$"), "/").otherwise("")), "/")
    resolved = F.array_join(F.aggregate(pieces, F.array().cast("array<string>"), step), "/")
    return F.when(plain.rlike(r"/\.\.?(?:/|$)"), resolved).otherwise(plain)


def canonical_entry(entry: Column) -> Column:
    """A listed entry in canonical form; one without a path stands for the whole host."""
    bare = F.regexp_replace(F.regexp_replace(entry, "^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"(?s)[?#].*$", "")
    path = F.regexp_extract(bare, "(?s)^[^/]*(/.*)$", 1)
    return F.concat(canonical_host(F.substring_index(bare, "/", 1)), canonical_path(F.when(path == "", "/").otherwise(path)))


def _tries(most_labels: int, most_steps: int):
    """Canonical host suffixes with directory prefixes of host and path, as deep as any listed entry."""
    labels = F.split(canonical_host(F.col("host")), r"\.")
    path = F.col("_u_canonical")
    steps = F.split(path, "/")
    n, m = F.size(labels), F.size(steps)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(most_labels))), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    prefixes = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(m - 1, F.lit(most_steps)))), lambda k: F.concat(F.array_join(F.slice(steps, F.lit(1), k), "/"), F.lit("/")))
    prefixes = F.when(path.rlike("[^/]$"), F.array_append(prefixes, path)).otherwise(prefixes)
    return F.when(F.col("host") != "", F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))))


def listed_pages(pages: DataFrame, listed: DataFrame, bits: int = BITS, most: int = BLOCKS) -> DataFrame:
    """The distinct (host, path) of pages that an entry (column entry) of listed fits."""
    spark = pages.sparkSession
    entries = listed.select(canonical_entry(F.col("entry").cast("string")).alias("entry")).where("entry IS NOT NULL AND NOT startswith(entry, '/')").distinct()
    size = entries.agg(
        F.count("*").alias("n"), F.max(F.size(F.split(F.substring_index("entry", "/", 1), r"\."))).alias("labels"), F.max(F.size(F.split("entry", "/")) - 1).alias("steps")
    ).first()
    blocks = int(min(most, max(1, -(-size["n"] * bits // 512))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block, words = place(b.column(0).to_numpy(zero_copy_only=False), blocks)
            yield pa.RecordBatch.from_arrays([pa.array(block), *(pa.array(words[:, k]) for k in range(8))], ["block", *(f"w{k}" for k in range(8))])

    schema = "block long, " + ", ".join(f"w{k} long" for k in range(8))
    made = entries.select(F.xxhash64("entry").alias("h")).mapInArrow(build, schema).groupBy("block").agg(*(F.bit_or(f"w{k}").alias(f"w{k}") for k in range(8)))
    bloom = np.zeros((blocks, 8), np.int64)
    got = made.toArrow()  # at most `most` rows
    if got.num_rows:
        bloom[got.column("block").to_numpy()] = np.stack([got.column(f"w{k}").to_numpy() for k in range(8)], 1)
    shared = spark.sparkContext.broadcast(bloom)

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = shared.value
        for b in batches:
            block, words = place(b.column("h").to_numpy(zero_copy_only=False), len(bloom))
            hit = ((bloom[block] & words) == words).all(1)
            if hit.any():
                yield b.filter(pa.array(hit))

    urls = pages.select("host", "path").distinct()
    urls = urls.withColumn("_u_canonical", canonical_path(F.col("path")))
    tries = urls.select("host", "path", F.explode(_tries(size["labels"] or 1, max(1, size["steps"] or 1))).alias("entry")).withColumn("h", F.xxhash64("entry"))
    tries = tries.mapInArrow(possible, tries.schema).drop("h")
    return tries.join(entries, "entry", "left_semi").select("host", "path").distinct()


def filtered(pages: DataFrame, listed: DataFrame, rules=RULES, bits: int = BITS, most: int = BLOCKS) -> DataFrame:
    """pages with host, path, rule and verdict.

    The longest rule that fits decides; without one a listed URL is blocked and any other allowed. Null, empty and odd URLs have
    an empty host, which nothing fits: they are allowed. Every row is judged, repeated ones alike, and an empty list blocks
    nothing. Columns of pages with the names of results are replaced.
    """
    own = [x for x in pages.columns if x not in ("host", "path", "rule", "verdict")]
    names = free(own, "_u_")
    urls = host_and_path(pages.select(*own).toDF(*names))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda x: (len(x[1]), x[1])):  # the longest is tried first
        host, slash, rest = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    judged = urls.withColumns({"rule": rule, "_u_rule": verdict})
    hits = listed_pages(judged.where("rule IS NULL AND host <> ''"), listed, bits, most)
    hits = hits.select(F.col("host").alias("_u_host"), F.col("path").alias("_u_path"))
    out = judged.join(hits, (F.col("host") == F.col("_u_host")) & (F.col("path") == F.col("_u_path")) & F.col("rule").isNull(), "left")
    verdict = F.coalesce("_u_rule", F.when(F.col("_u_host").isNotNull(), "block").otherwise("allow"))
    return out.select(*names, "host", "path", "rule", verdict.alias("verdict")).toDF(*own, "host", "path", "rule", "verdict")


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(x,) for x in LISTED], "entry string")
    return filtered(spark.read.parquet(f"{sf_dir}/pages.parquet"), listed).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = r"""
WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS h, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM b),
d AS (SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule,
  regexp_replace(regexp_replace(host, '^([^@]*@)?(www\.)?', ''), '\.?(:[0-9]*)?$', '') AS bare FROM c)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(bare, '^([^.]*\.)*(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm)\.example\.(com|net|org)$') THEN 'block'
    ELSE 'allow' END AS verdict FROM d
"""
