"""Removal of lines that stand on many sites.

For each line hash a HyperLogLog sketch of its sites is built by aggregation (map-side first, so a line that is everywhere
costs each task one row). Lines well above the threshold are taken as they are; for lines near it, within the sketch's error,
the distinct sites are counted exactly. Of a line that counts as boilerplate the first occurrence (lowest doc_id, then lowest
place) stays, so that the words themselves aren't lost; all others go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import SPACES, WORD, documents, free, pinned, small

#: Distinct sites from which a line is boilerplate.
SITES = 3
#: Words beyond which a line is long, and distinct sites from which op2 and the pipeline take a long line as boilerplate.
LONG, LONG_SITES = 50, 2
#: log2 of the sketch's registers, and its relative error (3 standard deviations).
LOG_K = 10
BAND = 3 * 1.04 / (1 << LOG_K) ** 0.5


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """(doc_id, fp, site, at, line hash) of every line that counts; fp tells rows with the same doc_id apart."""
    slim = docs.select("doc_id", F.xxhash64("text").alias("fp"), F.col(site).cast("string").alias("site"), F.col("text").cast("string").alias("text"))
    lines = slim.select("doc_id", "fp", F.coalesce("site", F.lit("")).alias("site"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    # 51 words have 101 characters at least
    long = (F.length("line") > 2 * LONG) & F.when(F.length("line") > 2 * LONG, F.regexp_count("line", F.lit(WORD)) > LONG).otherwise(False)
    return lines.where(F.col("line").rlike(rf"[^{SPACES}]")).select("doc_id", "fp", "site", "at", _key(F.col("line")).alias("line"), long.alias("long"))


def _key(line):
    return F.xxhash64(F.regexp_replace(line, rf"^[{SPACES}]+|[{SPACES}]+$", ""))


def boilerplate(docs: DataFrame, site: str = "source", sites: int = SITES, long_sites: int | None = None) -> DataFrame:
    """(line, first): hash of each line found on at least sites (long lines: long_sites, if given) distinct sites, and its first place (doc_id, fp, at)."""
    need = F.lit(sites) if long_sites is None else F.when(F.col("long"), long_sites).otherwise(sites)
    lines = _lines(docs, site).withColumn("need", need)
    low, high = F.floor(F.greatest(F.lit(1.0), F.col("need") * (1 - BAND) - 1e-6)), F.col("need") * (1 + BAND)
    spread = pinned(
        lines.groupBy("line", "need")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_K))).alias("n"), F.count("*").alias("times"), F.min(F.struct("doc_id", "fp", "at")).alias("first"))
        .where((F.col("n") >= low) & (F.col("times") >= F.col("need")))
    )
    unsure = spread.where(F.col("n") <= high)
    # only lines near the threshold are looked up; their distinct pairs with a site are made map-side first, so a line costs a task one row a site
    near = small(pinned(unsure.select("line", "need")))
    exact = lines.select("line", "site").join(near, "line").distinct().groupBy("line", "need").agg(F.count("*").alias("n")).where(F.col("n") >= F.col("need"))
    return spread.where(F.col("n") > high).select("line", "first").unionAll(unsure.join(exact.select("line"), "line", "left_semi").select("line", "first"))


def deduped(docs: DataFrame, site: str = "source", sites: int = SITES, long_sites: int | None = None) -> DataFrame:
    """docs with boilerplate lines taken out of text, and n_removed (long).

    Lines are compared without the white space around them; lines without a word are never removed. A null text stays null, a
    null site counts as the site ''. Equal rows (same doc_id and text) are treated alike; of rows with the lowest doc_id of a line
    all equal ones keep it. A document may become empty, but no row is dropped. Other columns pass through; n_removed and n_chars
    are set anew, n_chars only where docs has it.
    """
    names = free(docs.columns, "_l_")
    docs, given = docs.toDF(*names), docs.columns
    found = small(pinned(boilerplate(docs, site, sites, long_sites)))
    hits = (
        _lines(docs, site).join(found, "line")
        .where(~(F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.fp") == F.col("fp")) & (F.col("first.at") == F.col("at"))))
        .groupBy(F.col("doc_id").alias("_l_id"), F.col("fp").alias("_l_fp")).agg(F.collect_set("at").alias("_l_at"))
    )
    own = [x for x in names if x != "n_removed"]
    out = docs.withColumn("_l_own", F.xxhash64("text")).join(hits, F.col("doc_id").eqNullSafe(F.col("_l_id")) & (F.col("_l_own") == F.col("_l_fp")), "left")
    # the stretches between removed lines; lines and places are bound once, as a lambda's argument
    parts = F.array(F.struct(F.split("text", "\n").alias("lines"), F.sort_array("_l_at").alias("at")))
    before = lambda x, k: F.coalesce(F.get(x["at"], k - 1), F.lit(-1)) + 1
    stretch = lambda x: lambda k: F.slice(x["lines"], before(x, k) + 1, F.coalesce(F.get(x["at"], k), F.size(x["lines"])) - before(x, k))
    cut = F.get(F.transform(parts, lambda x: F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(x["at"])), stretch(x))), "\n")), F.lit(0))
    out = out.withColumn("text", F.when(F.col("_l_at").isNull(), F.col("text")).otherwise(cut))
    out = out.withColumn("n_removed", F.coalesce(F.size("_l_at"), F.lit(0)).cast("long"))
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*own, "n_removed").toDF(*(g for g in given if g != "n_removed"), "n_removed")


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    return deduped(documents(spark, sf_dir), long_sites=LONG_SITES).select("doc_id", "text", "n_removed")


OP2_SQL = r"""
WITH l AS (SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
k AS (SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS body FROM l),
b AS (SELECT body, min({'d': doc_id, 'i': i}) AS first FROM k WHERE body <> '' GROUP BY body HAVING count(DISTINCT site) >= CASE WHEN len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) > 50 THEN 2 ELSE 3 END),
x AS (SELECT k.doc_id, k.i, k.line, b.body IS NOT NULL AND NOT (b.first.d = k.doc_id AND b.first.i = k.i) AS gone FROM k LEFT JOIN b ON k.body = b.body),
y AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS cut, count(*) FILTER (WHERE gone) AS n FROM x GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN coalesce(y.n, 0) = 0 THEN d.text ELSE y.cut END AS text, coalesce(y.n, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN y ON d.doc_id = y.doc_id
"""
