"""The whole dataflow: elements, pages, gate, routes, documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quire.constants import Config
from quire.functions.errors import parsed_reply
from quire.operators.quality import gated, with_signals
from quire.operators.render import document_markdown, page_both
from quire.operators.rollup import low_confidence, mean_confidence, page_confidence, route_records, warning_rows
from quire.operators.routing import intents, routed, with_sizes
from quire.sources.shared import materialised

RESULTS = "doc_id string, page_index int, error string, error_kind string, valid_shape boolean, n_engine_elements int, engine_markdown string, engine_passes boolean"


@dataclass
class Parsed:
    """The linked results of a run: pages (records), documents (markdown and confidence), routes, warnings."""

    pages: DataFrame
    documents: DataFrame
    routes: DataFrame
    warnings: DataFrame


def measured_pages(elements: DataFrame, kind: str = "pdf", grades: DataFrame | None = None, layers: DataFrame | None = None, config: Config = Config(), told: dict[str, Column] | None = None) -> DataFrame:
    """A row for each page: markdown, gate decision, and whether its own text passes. One aggregation makes the pages.

    told: grades or layer tokens that follow from a page's keys, as columns (see gated()); what comes from elsewhere is joined as grades, layers.
    """
    within = elements if config.max_pages is None else elements.where(F.col("page_index") < config.max_pages)
    texts = page_both(within).withColumns(told or {})
    pages = gated(texts, grades, layers, config.one_based_grades)
    own = with_signals(pages, "markdown", like="page_text").drop("counts", "signals")
    return own if "kind" in elements.columns else own.withColumn("kind", F.lit(kind))


def page_cap_warnings(elements: DataFrame, most: int) -> DataFrame:
    """Warning rows of the documents that go on after most pages, at the first page that is left out."""
    over = elements.where(F.col("page_index") >= most).groupBy("doc_id").agg(F.min("page_index").alias("page_index"))
    message = F.concat(F.lit("Page "), F.col("page_index").cast("string"), F.lit(f" exceeds the limit of {most} pages"))
    return warning_rows(over, F.lit("page_unparseable"), message, "page", F.col("page_index"))


def read_replies(replies: DataFrame) -> DataFrame:
    """RESULTS rows from engine replies (doc_id, page_index, reply, error, error_kind): parsed, rendered and measured."""
    from quire.operators.render import block, expanded, ordered_join, table_markdown

    got = replies.withColumn("_r", F.when(F.col("reply").isNotNull(), parsed_reply(F.col("reply"))))
    got = got.select(
        "doc_id", "page_index", F.coalesce("error", "_r.error", "_r.value.error").alias("error"), F.coalesce("error_kind", "_r.value.error_kind").alias("error_kind"),
        F.col("_r.value.elements").isNotNull().alias("valid_shape"), F.size(F.coalesce("_r.value.elements", F.array())).alias("n_engine_elements"), F.col("_r.value.elements").alias("_e"),
    )
    parts = got.select("doc_id", "page_index", F.posexplode("_e").alias("seq", "e")).select("doc_id", "page_index", "seq", "e.*")
    rows = expanded(parts).withColumn("_o", F.struct("seq", "sub"))
    table = F.when(F.col("type") == "table", table_markdown(F.col("table.cells"), F.col("table.rows"), F.col("table.cols")))
    rows = rows.withColumn("_md", block(F.col("type"), F.col("text"), F.col("level"), F.lit(None).cast("string"), table))
    md = with_signals(rows.groupBy("doc_id", "page_index").agg(ordered_join("_md", "_o", "\n\n").alias("engine_markdown")), "engine_markdown")
    return got.drop("_e").join(md.select("doc_id", "page_index", "engine_markdown", F.col("passes").alias("engine_passes")), ["doc_id", "page_index"], "left")


def parse_documents(pages: DataFrame, engine: Callable[[DataFrame], DataFrame] | None = None, config: Config = Config()) -> Parsed:
    """Routes measured pages and rolls them up. engine: promoted pages to RESULTS rows; without one every promotion falls back.

    Only promoted pages reach the engine. Its results, and the measured pages, are written to the shared folder at once, so what
    reads the results of a run neither calls the engine again nor measures the pages again.
    """
    planned = materialised(with_sizes(intents(pages, config)).drop("page_text"), "planned-pages")  # the gate has read it; the Markdown stays
    results = pages.sparkSession.createDataFrame([], RESULTS) if engine is None else materialised(engine(planned.where("promote")), "engine-results")
    out = routed(planned, results, config)
    out = out.withColumn("confidence", page_confidence(F.col("route"), F.col("engine_quality_passes"), F.col("vlm_quality_passes")))
    texts = out.select("doc_id", "page_index", F.col("markdown_out").alias("markdown"), "confidence", "n_chars")
    documents = document_markdown(texts, mean_confidence())
    told = warning_rows(out.where("warning IS NOT NULL"), F.col("warning"), F.coalesce("reason", F.lit("")), "page", F.col("page_index"))
    return Parsed(out, documents, route_records(out), told.unionByName(low_confidence(out)))
