"""The one vocabulary module: thresholds, routes, codes and type maps."""

from __future__ import annotations

from dataclasses import dataclass

# quality gate
GARBLED_MOST, WORD_LEAST, CONTENT_LEAST, PRINTABLE_LEAST = 0.20, 2.0, 0.50, 0.90
RUN_MOST = 6  # longest run of one character that passes
RUN_REASON = "repeated_char_run"  # how reasons name that signal
LAYER_TOKENS_LEAST, COVERAGE_LEAST = 30, 0.30
LOW_GRADES = ("poor", "fair")

# routes
KEPT = "docling-kept"
ENGINES = ("vlm", "textract")
ROUTES = (
    "docling-kept", "vlm", "vlm-fallback-docling", "textract", "textract-fallback-docling", "vlm-rejected-kept-docling", "textract-rejected-kept-docling",
)
THROTTLED, NO_CONTENT, NO_BUDGET = "throttled", "no_docling_content", "budget_exhausted_no_escalation"

# confidence
TIERS = {"kept": 0.95, "rejected": 0.70, "fallback": 0.50, "passes": 0.85, "fails": 0.60, "unknown": 0.15}
LOW_CONFIDENCE = (TIERS["fails"] + TIERS["rejected"]) / 2

# cost, in dollars
VLM_CALL = 1700 * 3e-6 + 500 * 15e-6
OCR_PAGE = 0.019
PRICES = {"vlm": VLM_CALL, "textract": OCR_PAGE}

# layout
FULL_WIDTH, COLUMN_TOLERANCE, SCORE_LEAD, UPWARD = 0.85, 0.10, 0.05, 1e-6

# Fixed values, which results and reports depend on: input kinds, element types, error vocabularies, the text report.

KIND_BY_SUFFIX = {
    ".pdf": "pdf", ".png": "image", ".jpg": "image", ".jpeg": "image", ".tif": "image", ".tiff": "image", ".webp": "image",
    ".docx": "docx", ".xlsx": "xlsx", ".xlsm": "xlsx", ".html": "html", ".htm": "html",
}
KIND_BY_MIME = {
    "application/pdf": "pdf",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx",
    "application/vnd.ms-excel.sheet.macroenabled.12": "xlsx",
    "text/html": "html",
    "application/xhtml+xml": "html",
}
MIME_BY_SUFFIX = {
    ".pdf": "application/pdf", ".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".tif": "image/tiff", ".tiff": "image/tiff",
    ".webp": "image/webp", ".html": "text/html", ".htm": "text/html",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", ".xlsm": "application/vnd.ms-excel.sheet.macroenabled.12",
}
LISTED_SUFFIXES = (".pdf", ".png", ".jpg", ".jpeg", ".tif", ".tiff", ".docx", ".xlsx", ".xlsm", ".html", ".htm")
SIDECARS = ("failures.json", "manifest.json")

ELEMENT_TYPES = ("heading", "paragraph", "list", "list_item", "table", "figure", "caption", "code_block", "equation", "footnote", "header", "footer", "page_number")
FURNITURE = ("page_number", "header", "footer")
EXTRACTOR_TYPES = {
    "SectionHeaderItem": "heading", "TextItem": "paragraph", "ListItem": "list_item", "TableItem": "table", "PictureItem": "figure", "CaptionItem": "caption",
    "FootnoteItem": "footnote", "PageHeaderItem": "header", "PageFooterItem": "footer", "FormulaItem": "equation", "CodeItem": "code_block",
}
LAYOUT_TYPES = {
    "LAYOUT_TITLE": "heading", "LAYOUT_SECTION_HEADER": "heading", "LAYOUT_TEXT": "paragraph", "LAYOUT_LIST": "list", "LAYOUT_TABLE": "table",
    "LAYOUT_HEADER": "header", "LAYOUT_FOOTER": "footer", "LAYOUT_PAGE_NUMBER": "page_number", "LAYOUT_FIGURE": "figure",
}
LAYOUT_LEVELS = {"LAYOUT_TITLE": 1, "LAYOUT_SECTION_HEADER": 2}

TRANSIENT_CODES = (
    "ThrottlingException", "Throttling", "TooManyRequestsException", "ProvisionedThroughputExceededException", "ServiceUnavailable",
    "ServiceUnavailableException", "RequestTimeout", "RequestTimeoutException", "InternalServerError", "InternalServerException",
)
PERMANENT_CODES = (
    "AccessDenied", "AccessDeniedException", "UnrecognizedClient", "UnrecognizedClientException", "InvalidSignature", "InvalidSignatureException",
    "ValidationException",
)
TRANSIENT_HINTS = (
    "rate limit", "rate-limit", "ratelimit", "rate_limit", "too many requests", "throttl", "timeout", "timed out", "connection reset", "connection aborted",
    "connection error", "temporarily unavailable", "service unavailable", "serviceunavailable", "provisionedthroughput", "bad gateway", "gateway timeout",
    "internal server error", "502", "503", "504", "overloaded",
)
PERMANENT_HINTS = (
    "invalid api key", "api key not valid", "unauthorized", "forbidden", "permission denied", "accessdenied", "access denied", "authentication",
    "unrecognizedclient", "invalidsignature", "validationexception", "validation error", "not found", "404", "400 bad request", "invalid request",
)
TRANSIENT_STATUS = (408, 425, 429)

REPORT_WIDTHS = {"doc_id": 36, "route": 12, "pages": 5, "vlm_pages": 6, "routes": 22, "reason": 60}
REPORT_TOTALS = (
    "Total: %d docs / %d pages | used VLM: %d | vlm-failed: %d | used Textract: %d | textract-failed: %d | docling-kept: %d | errors: %d | "
    "escalated pages: %d | throttled pages: %d"
)

WARNING_CODES = (
    "input_too_large", "unsupported_type", "unhandled_exception", "docling_failed", "page_unparseable", "vlm_table_fallback", "vlm_promoted",
    "vlm_fallback_docling", "vlm_invalid_shape", "image_unparseable", "low_confidence_page", "vlm_rejected_kept_docling",
)


@dataclass(frozen=True)
class Config:
    """Settings of a run, in place of environment switches."""

    engine: str = "vlm"
    arbitration: bool = False
    scan_fastpath: bool = False
    escalate: bool = True
    budget: float | None = None
    max_input_mb: float = 200
    max_pages: int | None = None
    render_dpi: int = 144
    max_render_mp: float = 40
    one_based_grades: bool = False
