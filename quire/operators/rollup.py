"""Roll-ups: confidence, route records, cost, failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quire.constants import ENGINES, KEPT, LOW_CONFIDENCE, OCR_PAGE, PRICES, REPORT_TOTALS, ROUTES, THROTTLED, TIERS, VLM_CALL
from quire.constants import REPORT_WIDTHS as WIDTHS


def page_confidence(route: Column, engine_passes: Column, vlm_passes: Column) -> Column:
    """The tier of a page. Of an engine's page: by its text's quality, the engine's own flag first; without any, unknown."""
    passes = F.coalesce(engine_passes, vlm_passes)
    return (
        F.when(route == KEPT, TIERS["kept"]).when(route.endswith("-rejected-kept-docling"), TIERS["rejected"]).when(route.endswith("-fallback-docling"), TIERS["fallback"])
        .when(route.isin(*ENGINES), F.when(passes, TIERS["passes"]).when(~passes, TIERS["fails"]).otherwise(TIERS["unknown"])).otherwise(TIERS["unknown"])
    )


def mean_confidence() -> Column:
    """Aggregate: the mean confidence of pages weighed by n_chars; 0 without any characters."""
    weight = F.sum("n_chars")
    mean = F.try_divide(F.sum(F.col("confidence") * F.col("n_chars")), F.nullif(weight.cast("double"), F.lit(0.0)))
    return F.coalesce(mean, F.lit(0.0)).alias("confidence")


def document_confidence(pages: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(doc_id, confidence): see mean_confidence()."""
    return pages.groupBy(*(keys or ["doc_id"])).agg(mean_confidence())


def warning_rows(df: DataFrame, code: Column, message: Column, scope: str, page: Column | None = None, element: Column | None = None) -> DataFrame:
    """(doc_id, scope, page_index, element_id, code, message) for each row of df."""
    none = F.lit(None)
    return df.select("doc_id", F.lit(scope).alias("scope"), (none if page is None else page).cast("int").alias("page_index"), (none if element is None else element).cast("string").alias("element_id"), code.alias("code"), message.alias("message"))


def low_confidence(pages: DataFrame, least: float = LOW_CONFIDENCE) -> DataFrame:
    """Warning rows of the pages below the threshold."""
    message = F.concat(F.lit("page confidence is low on route "), F.col("route"))
    return warning_rows(pages.where(F.col("confidence") < least), F.lit("low_confidence_page"), message, "page", F.col("page_index"))


def route_records(pages: DataFrame) -> DataFrame:
    """A row for each document: route, pages, vlm_pages, throttled_pages, routes, reason, and the seven counts.

    A label outside the vocabulary raises an error. The overall route goes by precedence: an engine's success, then its failures,
    then kept. vlm_pages counts successes and fallbacks of both engines, not rejections.
    """
    n = {r: f"_n{k}" for k, r in enumerate(ROUTES)}
    reason = F.min_by("reason", F.when(F.coalesce(F.col("reason"), F.lit("")) != "", F.col("page_index")))
    out = pages.groupBy("doc_id").agg(
        F.count("*").alias("pages"), *(F.count_if(F.col("route") == r).alias(c) for r, c in n.items()), F.count_if(F.col("reason") == THROTTLED).alias("throttled_pages"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_index", F.coalesce("route", F.lit("null")).alias("route")))), lambda x: x["route"]), ",").alias("routes"), reason.alias("reason"),
    )
    total = sum((F.col(c) for c in n.values()), F.lit(0))
    pages_ok = F.when(total != F.col("pages"), F.raise_error(F.concat(F.lit("unknown route label in "), F.col("doc_id").cast("string"))).cast("long")).otherwise(F.col("pages"))
    any_of = lambda *labels: sum((F.col(n[r]) for r in labels), F.lit(0)) > 0
    failed = lambda e: any_of(f"{e}-fallback-docling", f"{e}-rejected-kept-docling")
    route = F.when(any_of("vlm"), "vlm").when(any_of("textract"), "textract").when(failed("vlm"), "vlm-failed").when(failed("textract"), "textract-failed").otherwise(KEPT)
    engine_pages = sum((F.col(n[f"{e}{s}"]) for e in ENGINES for s in ("", "-fallback-docling")), F.lit(0))
    named = [F.col(c).alias("n_" + r.replace("-", "_")) for r, c in n.items()]
    return out.select("doc_id", route.alias("route"), pages_ok.alias("pages"), engine_pages.alias("vlm_pages"), "throttled_pages", F.when(F.col("routes") == "", "-").otherwise(F.col("routes")).alias("routes"), "reason", *named)


def error_records(failed: DataFrame) -> DataFrame:
    """Route records of documents (doc_id, reason) that gave no pages."""
    zero = F.lit(0).cast("long")
    return failed.select("doc_id", F.lit("error").alias("route"), zero.alias("pages"), zero.alias("vlm_pages"), zero.alias("throttled_pages"), F.lit("-").alias("routes"), F.left(F.col("reason"), F.lit(200)).alias("reason"))


def summary(records: DataFrame) -> DataFrame:
    """One row of counts over route records."""
    by = lambda r: F.count_if(F.col("route") == r)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return records.agg(
        F.count("*").alias("total"), by(KEPT).alias("docling_kept"), by("vlm").alias("used_vlm"), by("textract").alias("used_textract"), by("vlm-failed").alias("vlm_failed"),
        by("textract-failed").alias("textract_failed"), by("error").alias("errors"), total("pages").alias("total_pages"), total("vlm_pages").alias("vlm_pages"), total("throttled_pages").alias("throttled_pages"),
    )


def report_header() -> str:
    """The heads of the report's columns, numbers to the right."""
    heads = {c: "vlm_pg" if c == "vlm_pages" else c for c in WIDTHS}
    return " ".join(heads[c].rjust(w) if c.endswith("pages") else heads[c].ljust(w) for c, w in WIDTHS.items()).rstrip()


def format_lines(records: DataFrame) -> DataFrame:
    """(doc_id, line) of a text report, in fixed widths; the reason comes last and isn't filled up."""
    cut = lambda c: F.left(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(WIDTHS[c]))
    fit = lambda c: F.rpad(cut(c), WIDTHS[c], " ")
    number = lambda c: F.format_string(f"%{WIDTHS[c]}d", F.col(c).cast("long"))
    return records.select("doc_id", F.concat(fit("doc_id"), F.lit(" "), fit("route"), F.lit(" "), number("pages"), F.lit(" "), number("vlm_pages"), F.lit(" "), fit("routes"), F.lit(" "), cut("reason")).alias("line"))


def totals_line(totals: DataFrame) -> DataFrame:
    """(line): the report's footer, from summary()."""
    return totals.select(F.format_string(
        REPORT_TOTALS,
        "total", "total_pages", "used_vlm", "vlm_failed", "used_textract", "textract_failed", "docling_kept", "errors", "vlm_pages", "throttled_pages",
    ).alias("line"))


def cost_summary(files: DataFrame) -> DataFrame:
    """One row: calls and cost of both engines over files (vlm_calls, textract_calls), rounded to 6 places."""
    vlm, ocr = F.coalesce(F.sum("vlm_calls"), F.lit(0)), F.coalesce(F.sum("textract_calls"), F.lit(0))
    return files.agg(
        vlm.alias("vlm_calls"), ocr.alias("textract_calls"), F.round(vlm * F.lit(VLM_CALL), 6).alias("vlm_cost"), F.round(ocr * F.lit(OCR_PAGE), 6).alias("textract_cost"),
        F.round(vlm * F.lit(VLM_CALL) + ocr * F.lit(OCR_PAGE), 6).alias("total_cost"),
    )


def file_cost(vlm_calls: Column, textract_calls: Column) -> Column:
    return F.coalesce(vlm_calls, F.lit(0)) * F.lit(VLM_CALL) + F.coalesce(textract_calls, F.lit(0)) * F.lit(OCR_PAGE)


def preflight(pages: DataFrame, engine: str) -> DataFrame:
    """One row: the cost if every page went to the engine."""
    n = F.coalesce(F.sum("pages"), F.lit(0))
    return pages.agg(n.alias("pages"), F.round(n * F.lit(PRICES[engine]), 6).alias("worst_cost"))


def call_counts(results: DataFrame) -> DataFrame:
    """(doc_id, vlm_calls, textract_calls): replies of each engine (engine, error); an error inside a reply still is one."""
    ok = F.col("error").isNull() | (F.col("error") == "in_reply")
    return results.groupBy("doc_id").agg(F.count_if(ok & (F.col("engine") == "vlm")).alias("vlm_calls"), F.count_if(ok & (F.col("engine") == "textract")).alias("textract_calls"))


def failure_entries(warnings: DataFrame) -> DataFrame:
    """(scope, doc_id, page_index, warnings): a row for each document with warnings of its own, and for each warning of a page.

    Rows are the entries of the two lists of a failure report. A document's warnings are few: its pages' ones are rows by themselves.
    """
    told = F.struct("scope", "code", "message", "page_index", "element_id")
    whole = warnings.where(F.col("scope") == "document").groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_list(told))).alias("warnings"))
    pages = warnings.where(F.col("scope") == "page").select("doc_id", "page_index", F.to_json(F.array(told)).alias("warnings"))
    return whole.select(F.lit("document").alias("scope"), "doc_id", F.lit(None).cast("int").alias("page_index"), "warnings").unionByName(pages.select(F.lit("page").alias("scope"), "doc_id", "page_index", "warnings"))


def failures(warnings: DataFrame) -> DataFrame:
    """One row (document_failures, page_failures): JSON arrays of the warnings by scope, each in order.

    Meant for reports of failures, which are few; the warnings themselves stay a table.
    """
    row = F.struct("doc_id", "page_index", "code", "message")
    kept = lambda scope: F.to_json(F.array_sort(F.collect_list(F.when(F.col("scope") == scope, row))))
    return warnings.agg(kept("document").alias("document_failures"), kept("page").alias("page_failures"))


def file_results(records: DataFrame, calls: DataFrame, documents: DataFrame, warnings: DataFrame) -> DataFrame:
    """A row for each route record, error records among them: success, pages, calls, cost, characters of markdown, warnings.

    A failed document has made no calls that count. What is missing for a document (calls, markdown, warnings) is 0.
    """
    facts = calls.select("doc_id", "vlm_calls", "textract_calls", F.lit(0).alias("chars"), F.lit(0).alias("told"))
    facts = facts.unionByName(documents.select("doc_id", F.lit(0).alias("vlm_calls"), F.lit(0).alias("textract_calls"), F.length("markdown").alias("chars"), F.lit(0).alias("told")))
    facts = facts.unionByName(warnings.select("doc_id", *(F.lit(0).alias(c) for c in ("vlm_calls", "textract_calls", "chars")), F.lit(1).alias("told")))
    per = facts.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in ("vlm_calls", "textract_calls", "chars", "told")))
    ok = F.col("route") != "error"
    out = records.select("doc_id", "route", "pages", "vlm_pages").join(per, "doc_id", "left").withColumns({c: F.when(ok, F.coalesce(c, F.lit(0))).otherwise(0).cast("long") for c in ("vlm_calls", "textract_calls", "chars")})
    return out.select("doc_id", ok.alias("success"), "route", "pages", "vlm_pages", "vlm_calls", "textract_calls", F.round(file_cost(F.col("vlm_calls"), F.col("textract_calls")), 6).alias("cost"), F.col("chars").alias("markdown_chars"), F.coalesce("told", F.lit(0)).cast("long").alias("warning_count"))


def batch_summary(results: DataFrame, engine: str = "vlm") -> DataFrame:
    """One row over file_results(): files, calls, estimated costs, pages, documents by route, cost if every page went to the engine.

    Results that went through routing.budgeted() (file_index, is_trip) tell whether and at which file the budget was reached.
    """
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    vlm, ocr = total("vlm_calls") * F.lit(VLM_CALL), total("textract_calls") * F.lit(OCR_PAGE)
    tripped = F.col("is_trip") if "is_trip" in results.columns else F.lit(False)
    index = F.col("file_index").cast("long") if "is_trip" in results.columns else F.lit(None).cast("long")
    return results.agg(
        F.count("*").alias("total_files"), F.count_if("success").alias("succeeded"), F.count_if(~F.col("success")).alias("failed"), total("vlm_calls").alias("total_vlm_calls"), total("textract_calls").alias("total_textract_calls"),
        F.round(vlm, 6).alias("vlm_cost"), F.round(ocr, 6).alias("textract_cost"), F.round(vlm + ocr, 6).alias("estimated_cost"), F.lit(True).alias("cost_is_estimate"),
        total("pages").alias("total_pages"), total("vlm_pages").alias("vlm_routed_pages"), F.count_if(F.col("route") == "vlm").alias("docs_using_vlm"), F.count_if(F.col("route") == KEPT).alias("docs_docling_kept"),
        F.round(total("pages") * F.lit(PRICES[engine]), 6).alias("worst_cost"), F.coalesce(F.bool_or(tripped), F.lit(False)).alias("budget_exceeded"), F.min(F.when(tripped, index)).alias("budget_tripped_at"),
    )
