"""Quality rules with host verdicts, in DataFrame functions only.

Each document has counts over its whole text and a few rules on them. A host's failure rate is the share of its documents that
fail any rule, shrunk by a beta prior that is fitted to all hosts (method of moments); a host whose shrunk rate is too high is
rejected with all its documents, elsewhere each document stands for itself.

Arrays never leave their row: nothing is shuffled but one row for each host and task. Host rows are broadcast only while
their number is below a bound; beyond it the join is an ordinary shuffled one, of which AQE splits hot hosts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import SPACES, documents, materialised, pinned

#: A host is rejected above this shrunk failure rate.
HOST_RATE = 0.5
#: Most hosts that are broadcast (a row has some 100 bytes).
HOSTS = 100_000
#: Prefix of the working columns, so that they don't clash with those of the input.
P = "_q_"


def _counts(docs: DataFrame) -> DataFrame:
    """docs with the counts in columns named with P."""
    c = lambda name: F.col(P + name)
    out = docs.withColumn(P + "text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    out = out.withColumns({
        P + "words": F.array_remove(F.split(c("text"), rf"[{SPACES}]+"), ""),
        P + "lines": F.filter(F.split(c("text"), "\n"), lambda x: x.rlike(rf"[^{SPACES}]")),
        P + "n_symbols": (F.size(F.split(c("text"), r"[#*$%&|<>]")) - 1).cast("long"),
    })
    out = out.withColumns({
        P + "n_words": F.size(c("words")).cast("long"),
        P + "word_chars": F.length(F.array_join(c("words"), "")).cast("long"),
        P + "n_lines": F.size(c("lines")).cast("long"),
        P + "n_dup_lines": (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
        P + "hashes": F.transform(c("words"), lambda w: F.xxhash64(w)),
    })
    window = lambda i: F.xxhash64(*(F.get(c("hashes"), i + k) for k in range(5)))
    out = out.withColumn(P + "windows", F.when(c("n_words") >= 5, F.transform(F.sequence(F.lit(0), c("n_words").cast("int") - 5), window)))
    out = out.withColumn(
        P + "sorted",
        F.when(F.size(F.array_distinct(c("windows"))) < F.size(c("windows")), F.sort_array(F.transform(c("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    twice = lambda x, k: F.coalesce(F.get(c("sorted"), k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(c("sorted"), k + 1)["h"] == x["h"], F.lit(False))
    out = out.withColumn(P + "at", F.sort_array(F.transform(F.filter(c("sorted"), twice), lambda x: x["i"])))
    covered = F.aggregate(
        c("at"), F.struct(F.lit(-5).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(5), i - a["last"])).alias("n")), lambda a: a["n"],
    )
    return out.withColumn(P + "n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))


def judged(docs: DataFrame, host: str = "source", host_rate: float = HOST_RATE, least_words: int = 10, repeated: int = 20, symbols: int = 30, same_lines: int = 60, columns: list[str] | None = None) -> DataFrame:
    """docs (or these of its columns) with the five counts, base_failed, failed, host_rate and kept.

    A document fails with under least_words words, over repeated per cent of its words in five-word windows that are found
    twice, over symbols symbols for 100 words, or over same_lines per cent of its lines equal to an earlier one; kept is false if
    it fails or its host is rejected. Null texts count as empty (no words: they fail); a null host is a host of its own; with one
    host the prior has that host's mean. Repeated rows count each. Columns of docs with the names of results are replaced.
    """
    spark = docs.sparkSession
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    made = [*names, "base_failed", "failed", "host_rate", "kept"]
    own = [x for x in (docs.columns if columns is None else columns) if x not in made]
    c = lambda name: F.col(P + name)
    base = (c("n_words") < least_words) | (100 * c("n_repeat_words") > repeated * c("n_words"))
    failed = base | (100 * c("n_symbols") > symbols * c("n_words")) | (100 * c("n_dup_lines") > same_lines * c("n_lines"))
    counted = _counts(docs)
    # through a generator, which no filter is pushed below: else a filter on the verdict would put the array expressions into each other
    result = F.struct(*(c(x).alias(x) for x in names), base.alias("base_failed"), failed.alias("failed"), F.col(host).alias(P + "host"))
    rows = counted.select(*(F.col(x) for x in own), F.inline(F.array(result)))
    rows = materialised(rows, "quality")  # counted once, for the hosts and for the result

    hosts = pinned(rows.groupBy(P + "host").agg(F.count("*").alias(P + "n"), F.count_if("failed").alias(P + "f")))
    n, f = F.col(P + "n"), F.col(P + "f")
    total = hosts.agg(F.sum(n).alias("n"), F.sum(f).alias("f"), F.count("*").alias("k")).first()
    mean = (total["f"] or 0) / max(1, total["n"] or 0)
    spread = hosts.agg((F.sum(n * (f / n - mean) ** 2)).alias("v")).first()["v"] or 0.0
    noise = mean * (1 - mean) * max(1, total["k"]) / max(1, total["n"] or 0)
    variance = max(spread / max(1, total["n"] or 0) - noise, 1e-9)
    strength = min(1e6, max(1.0, mean * (1 - mean) / variance - 1))
    rates = hosts.select(F.col(P + "host").alias(P + "key"), ((f + mean * strength) / (n + strength)).alias("host_rate"))
    rates = F.broadcast(rates) if total["k"] <= HOSTS else rates
    out = rows.join(rates, F.col(P + "host").eqNullSafe(F.col(P + "key")), "left")
    return out.select(*own, *names, "base_failed", "failed", "host_rate", (~F.col("failed") & (F.col("host_rate") <= host_rate)).alias("kept"))


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged(documents(spark, sf_dir), columns=["doc_id"]).select(*columns)


OP5_SQL = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT *, CASE WHEN len(words) < 5 THEN [] ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')) END AS windows FROM w),
p AS (SELECT doc_id, unnest(windows) AS win, generate_subscripts(windows, 1) AS i FROM g),
q AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM p),
r AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM q WHERE n > 1),
s AS (SELECT doc_id, sum(least(5, coalesce(gap, 5)))::BIGINT AS n_repeat_words FROM r GROUP BY doc_id),
d AS (SELECT g.doc_id, g.source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
        coalesce(s.n_repeat_words, 0)::BIGINT AS n_repeat_words FROM g LEFT JOIN s ON g.doc_id = s.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM d),
f AS (SELECT *, base_failed OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 60 * n_lines AS failed FROM b),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE failed) AS f FROM f GROUP BY source),
m AS (SELECT sum(f) / sum(n) AS mean, sum(n) AS n, count(*) AS k FROM h),
v AS (SELECT any_value(m.mean) AS mean, greatest(sum(h.n * (h.f / h.n - m.mean) ** 2) / any_value(m.n) - any_value(m.mean * (1 - m.mean) * m.k / m.n), 1e-9) AS v FROM h, m),
z AS (SELECT mean, least(1e6, greatest(1.0, mean * (1 - mean) / v - 1)) AS strength FROM v),
rate AS (SELECT h.source, (h.f + z.mean * z.strength) / (h.n + z.strength) AS host_rate FROM h, z)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT failed AND host_rate <= 0.5 AS kept
FROM f JOIN rate ON f.source IS NOT DISTINCT FROM rate.source
"""
