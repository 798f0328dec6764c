"""Benchmark reports: results, routes and latencies of engines side by side; text similarity measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quire.constants import KEPT
from quire.functions.text import collapsed, tokens


def metric(*columns: str) -> Column:
    """The first of the columns that holds a number, as double; empty, nan and other texts are null."""
    value = lambda c: F.when(F.lower(F.col(c).cast("string")) != "nan", F.col(c).cast("string").try_cast("double"))
    return F.coalesce(*(value(c) for c in columns))


def number(value: Column, places: int = 4) -> Column:
    """value with so many places; a dash for null."""
    return F.when(value.isNull(), "—").otherwise(F.format_string(f"%.{places}f", value.cast("double")))


def latest(df: DataFrame, path: str = "path") -> DataFrame:
    """The rows of the file with the last name."""
    last = df.agg(F.max(path)).first()[0]
    return df.where(F.col(path) == last)


def file_latencies(lines: DataFrame) -> DataFrame:
    """(doc_id, parse_duration_s) from log lines (line_no, value): the JSON tail of file_parsed events, the last of each stem."""
    from quire.functions.text import stem

    at = F.instr("value", '{"event"')
    told = F.from_json(F.when(at > 0, F.substring(F.col("value"), at, F.length("value"))), "event string, filename string, parse_duration_s double", {"mode": "PERMISSIVE"})
    rows = lines.withColumn("_e", told).where("_e.event = 'file_parsed' AND _e.filename IS NOT NULL")
    return rows.groupBy(stem(F.col("_e.filename")).alias("doc_id")).agg(F.max_by("_e.parse_duration_s", "line_no").alias("parse_duration_s"))


def comparison(metrics: DataFrame, routes: DataFrame, latencies: DataFrame, engines: list[str], value: str = "ned") -> DataFrame:
    """A row for each document graded under any engine: its metric, route and latency under each.

    Inputs have (engine, doc_id, ...): metrics are joined in full, routes and latencies looked up.
    """
    wide = metrics.groupBy("doc_id").pivot("engine", engines).agg(F.first(value))
    out = wide.select("doc_id", *(F.col(e).alias(f"{value}_{e}") for e in engines))
    for table, col in ((routes, "route"), (latencies, "latency")):
        side = table.groupBy("doc_id").pivot("engine", engines).agg(F.first(col))
        out = out.join(side.select("doc_id", *(F.col(e).alias(f"{col}_{e}") for e in engines)), "doc_id", "left")
    return out


def engine_totals(metrics: DataFrame, routes: DataFrame, latencies: DataFrame, value: str = "ned") -> DataFrame:
    """A row for each engine: mean metric over graded documents, mean and total latency over all lines, promoted over all routed."""
    a = metrics.groupBy("engine").agg(F.count("doc_id").alias("graded"), F.avg(value).alias("mean_metric"))
    b = routes.groupBy("engine").agg(F.count_if(~F.col("route").isin(KEPT, "error")).alias("promoted"), F.count("*").alias("routed"))
    c = latencies.groupBy("engine").agg(F.avg("latency").alias("mean_latency"), F.sum("latency").alias("total_latency"))
    return a.join(b, "engine", "full_outer").join(c, "engine", "full_outer")


def first_route(routes: DataFrame, labels: list[str]) -> DataFrame:
    """(doc_id, route): of the first label, in order, that has one."""
    rank = F.element_at(F.create_map(*(F.lit(x) for k, label in enumerate(labels) for x in (label, k))), F.col("label"))
    return routes.where(F.col("label").isin(*labels) & F.col("route").isNotNull()).groupBy("doc_id").agg(F.min_by("route", rank).alias("route"))


def label_comparison(metrics: DataFrame, routes: DataFrame, labels: list[str], value: str = "ned") -> DataFrame:
    """(doc_id, route, {value}_{label}...): a row for each graded document; the route is of the first label that has one.

    Inputs have (label, doc_id, ...). A label without a metric of the document, and a document without any route, gives null.
    """
    wide = metrics.groupBy("doc_id").pivot("label", labels).agg(F.first(value))
    out = wide.select("doc_id", *(F.col(x).alias(f"{value}_{x}") for x in labels)).join(first_route(routes, labels), "doc_id", "left")
    return out.select("doc_id", "route", *(f"{value}_{x}" for x in labels))


def ned_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length, of texts with collapsed white space; 1 for two empty texts."""
    x, y = collapsed(F.coalesce(a, F.lit(""))), collapsed(F.coalesce(b, F.lit("")))
    longer = F.greatest(F.length(x), F.length(y))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(x, y) / longer)


def word_containment(part: Column, whole: Column) -> Column:
    """Share of the distinct words of part that are in whole; 1 where part has none."""
    words = F.array_distinct(tokens(F.lower(F.coalesce(part, F.lit("")))))
    return F.when(F.size(words) == 0, 1.0).otherwise(F.size(F.array_intersect(words, tokens(F.lower(F.coalesce(whole, F.lit("")))))) / F.size(words))


def unordered_ned(a: Column, b: Column) -> Column:
    """ned_similarity of the texts' sorted words."""
    ordered = lambda t: F.array_join(F.sort_array(tokens(F.coalesce(t, F.lit("")))), " ")
    return ned_similarity(ordered(a), ordered(b))
