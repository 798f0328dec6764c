"""Routes of pages: intent, engine results, fallback, arbitration, budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from quire.constants import KEPT, NO_BUDGET, NO_CONTENT, PRICES, THROTTLED, Config
from quire.functions.text import strip


def blank(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit(""))) == ""


def fast_path(pages: DataFrame) -> DataFrame:
    """(doc_id, all_scans): whether every page of a document is an image without text layer (text_layer_tokens, has_image)."""
    scan = F.coalesce((F.col("text_layer_tokens") == 0) & F.col("has_image"), F.lit(False))
    return pages.groupBy("doc_id").agg(F.every(scan).alias("all_scans"))


def intents(pages: DataFrame, config: Config = Config()) -> DataFrame:
    """pages (kind, markdown, n_elements, decision, and optionally all_scans, escalate) with promote and intent_reason.

    Office and HTML inputs are always kept. Of PDF pages an empty rendering is promoted before the gate is asked; of images one
    without elements. Where escalation is off, what would be promoted is kept with the budget's reason.
    """
    gated, image = F.col("kind").isin("pdf", "image"), F.col("kind") == "image"
    scans = F.col("all_scans") if config.scan_fastpath and "all_scans" in pages.columns else F.lit(False)
    allowed = F.coalesce(F.col("escalate"), F.lit(True)) if "escalate" in pages.columns else F.lit(config.escalate)
    empty = F.when(image, F.col("n_elements") == 0).otherwise(blank(F.col("markdown")))
    wanted = gated & (scans | empty | (F.col("decision.action") == "promote_to_vlm"))
    reason = F.when(gated & (scans | empty), F.lit(NO_CONTENT)).when(gated, F.col("decision.reason"))
    return pages.withColumns({"promote": wanted & allowed, "intent_reason": F.when(wanted & ~allowed, F.lit(NO_BUDGET)).when(wanted, reason)})


def engine_problem(error: Column, valid_shape: Column, n_elements: Column, markdown: Column) -> Column:
    """Why an engine result can't be used: error, shape, empty or blank; null if it can."""
    return F.when(error.isNotNull(), "error").when(~F.coalesce(valid_shape, F.lit(False)), "shape").when(F.coalesce(n_elements, F.lit(0)) == 0, "empty").when(blank(markdown), "blank")


def reverts(fails: Column, fallback: Column, fallback_passes: Column, reason: Column) -> Column:
    """Arbitration: whether the extractor's rendering is taken back. Never for pages promoted for low coverage."""
    return taken_back(fails, ~blank(fallback), fallback_passes, reason)


def taken_back(fails: Column, has_fallback: Column, fallback_passes: Column, reason: Column) -> Column:
    return fails & has_fallback & fallback_passes & ~F.coalesce(reason.startswith("low_coverage:"), F.lit(False))


def with_sizes(pages: DataFrame) -> DataFrame:
    """pages with what routes ask of their Markdown, so that the texts needn't be read or dealt out for it."""
    return pages if "_has_markdown" in pages.columns else pages.withColumns({"_has_markdown": ~blank(F.col("markdown")), "_n_markdown": F.length(F.coalesce("markdown", F.lit("")))})


def routed(pages: DataFrame, results: DataFrame, config: Config = Config()) -> DataFrame:
    """Routes of pages (with intents, passes of the extractor's text) from engine results, as page records.

    results: doc_id, page_index, error, error_kind, valid_shape, n_elements, engine_markdown, engine_passes; a promoted page without
    a result counts as an error. The final text is in markdown_out. Nullable quality columns say which keys a record has.
    """
    e = config.engine
    out = with_sizes(pages).join(results, ["doc_id", "page_index"], "left")
    missing = F.col("valid_shape").isNull() & F.col("error").isNull()
    problem = engine_problem(F.when(missing, F.lit("no result")).otherwise(F.col("error")), F.col("valid_shape"), F.col("n_engine_elements"), F.col("engine_markdown"))
    out = out.withColumn("problem", F.when(F.col("promote"), problem))
    has_fallback = F.col("_has_markdown")
    back = F.lit(config.arbitration) & taken_back(~F.col("engine_passes"), has_fallback, F.col("passes"), F.col("intent_reason"))
    route = (
        F.when(~F.col("promote"), KEPT).when(F.col("problem").isNotNull(), F.when(has_fallback, f"{e}-fallback-docling").otherwise(e))
        .when(back, f"{e}-rejected-kept-docling").otherwise(e)
    )
    used = F.col("promote") & F.col("problem").isNull()
    won = used & (route == e)
    text = F.when(won, F.col("engine_markdown")).otherwise(F.coalesce(F.col("markdown"), F.lit("")))
    reason = F.when(F.col("problem").isNotNull() & (F.col("error_kind") == THROTTLED), F.lit(THROTTLED)).otherwise(F.col("intent_reason"))
    return out.withColumns({
        "route": route, "reason": reason, "markdown_out": text, "n_chars": F.when(won, F.length("engine_markdown")).otherwise(F.col("_n_markdown")), "engine_quality_passes": F.when(used, F.col("engine_passes")),
        "vlm_quality_passes": F.when(used & F.lit(e == "vlm"), F.col("engine_passes")), "docling_quality_passes": F.when(used & F.lit(config.arbitration), F.col("passes")),
        "warning": F.when(F.col("problem").isNotNull(), F.when(F.col("problem") == "shape", "vlm_invalid_shape").otherwise("vlm_fallback_docling")).when(route.endswith("-rejected-kept-docling"), "vlm_rejected_kept_docling").when(F.col("promote"), "vlm_promoted"),
    }).drop("_has_markdown", "_n_markdown")


def table_crops(elements: DataFrame, crops: DataFrame) -> DataFrame:
    """elements with a table's content replaced by a usable crop result (rows, cols, cells), and warning where it isn't usable."""
    got = crops.select("doc_id", "element_id", F.col("content").alias("_crop"), F.lit(True).alias("_asked"))
    out = elements.join(got, ["doc_id", "element_id"], "left")
    usable = (F.col("type") == "table") & F.col("_crop.rows").isNotNull() & F.col("_crop.cols").isNotNull() & F.col("_crop.cells").isNotNull()
    usable = F.coalesce(usable, F.lit(False))
    out = out.withColumns({"warning": F.when((F.col("type") == "table") & F.col("_asked") & ~usable, "vlm_table_fallback"), "content": F.when(usable, F.col("_crop")).otherwise(F.col("content"))})
    return out.drop("_crop", "_asked")


def replaced(elements: DataFrame, promoted: DataFrame, engine_elements: DataFrame) -> DataFrame:
    """elements with those of promoted pages replaced by the engine's, for pages of which it gave any; others keep theirs."""
    key = ["doc_id", "page_index"]
    won = promoted.select(*key).distinct().join(engine_elements.select(*key).distinct(), key, "left_semi")
    return elements.join(won, key, "left_anti").unionByName(engine_elements.join(won, key, "left_semi"), allowMissingColumns=True)


def budgeted(files: DataFrame, budget: float | None, cost: str = "cost", order: str = "file_index") -> DataFrame:
    """files with spent_before, escalate and is_trip, in sequential order: a file may escalate while the spend before it is under budget.

    Costs aren't negative, so the sums over all files before stand for the spend: once at the budget it stays there. The spend is
    a running total in two steps (totals of ranges, then inside them), so no task gets all files. Without a budget all escalate.
    """
    rows = running_total(files, cost, order).withColumnRenamed("_before", "spent_before")
    if budget is None:
        return rows.withColumns({"escalate": F.lit(True), "is_trip": F.lit(False)})
    before, after = F.col("spent_before") < budget, F.col("spent_before") + F.col(cost) >= budget
    return rows.withColumns({"escalate": before, "is_trip": before & after})


def running_total(df: DataFrame, value: str, order: str, ranges: int | None = None) -> DataFrame:
    """df with _before: the sum of value over all rows that come earlier by order (ties by chance of the sort, so order should be unique).

    Rows are dealt by ranges of order; each range's total goes to the driver (a number a range), not the rows.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = df.stat.approxQuantile(order, [k / n for k in range(1, n)], 0.001) if n > 1 else []
    bucket = F.lit(0)
    for k, e in enumerate(sorted(set(edges))):
        bucket = F.when(F.col(order) > e, k + 1).otherwise(bucket)
    rows = df.withColumn("_range", bucket)
    totals, before = {r[0]: r[1] or 0.0 for r in rows.groupBy("_range").agg(F.sum(value)).collect()}, {}
    done = 0.0
    for k in sorted(totals):
        before[k] = done
        done += totals[k]
    if not before:
        return rows.withColumn("_before", F.lit(0.0)).drop("_range")
    start = F.element_at(F.create_map(*(F.lit(x) for k, v in before.items() for x in (k, float(v)))), F.col("_range"))
    w = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_before", start + F.coalesce(F.sum(value).over(w), F.lit(0.0))).drop("_range")


def page_cost(route: Column) -> Column:
    """Price of a page by the engine that its route names."""
    return F.when(route.startswith("vlm"), F.lit(PRICES["vlm"])).when(route.startswith("textract"), F.lit(PRICES["textract"])).otherwise(F.lit(0.0))
