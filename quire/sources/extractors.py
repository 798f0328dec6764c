"""Adapters: what makes element rows of inputs, and what answers for promoted pages.

Extraction and recognition engines are plug-ins. An extractor is a function from a frame (doc_id, path, content) to ELEMENT rows;
an engine one from a frame of promoted pages to RESULT rows. Two extractors are here, for HTML and for plain text.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quire.constants import PERMANENT_CODES, PERMANENT_HINTS, TRANSIENT_CODES, TRANSIENT_HINTS, TRANSIENT_STATUS

CELL = T.StructType([T.StructField(n, t) for n, t in (("row", T.IntegerType()), ("col", T.IntegerType()), ("text", T.StringType()), ("row_span", T.IntegerType()), ("col_span", T.IntegerType()))])
CONTENT = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("rows", T.IntegerType()), T.StructField("cols", T.IntegerType()), T.StructField("header_rows", T.IntegerType()),
    T.StructField("alt_text", T.StringType()), T.StructField("cells", T.ArrayType(CELL)),
])
ELEMENT = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("page_index", T.IntegerType()), T.StructField("seq", T.IntegerType()), T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("level", T.IntegerType()), T.StructField("content", CONTENT),
])

HEADINGS = {f"h{k}": k for k in range(1, 7)}
SKIPPED = {"script", "style", "head", "noscript", "template", "svg"}
BLOCKS = {"p", "div", "article", "section", "main", "body", "blockquote", "ul", "ol", "nav", "header", "footer", "br", "hr", "figure", "table", "tr", "form", "aside", "dl", "dt", "dd"}


class _Reader(HTMLParser):
    """Collects (type, text, level, content) in document order; unclosed tags end where the next block begins."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[tuple] = []
        self.text: list[str] = []
        self.kind, self.level, self.skip = "paragraph", None, 0
        self.cells: list[dict] | None = None
        self.row = self.col = -1
        self.heads: set[int] = set()

    def end_block(self) -> None:
        text = "".join(self.text)
        text = text.strip("\n") if self.kind == "code_block" else " ".join(text.split())
        self.text = []
        if self.cells is not None:
            if text and self.cells:
                self.cells[-1]["text"] = f"{self.cells[-1]['text']} {text}".strip()
        elif text:
            self.out.append((self.kind, text, self.level, None))
        self.kind, self.level = "paragraph", None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SKIPPED and tag != "head":
            self.skip += 1
        if self.skip:
            return
        if tag in HEADINGS or tag in BLOCKS or tag in ("li", "pre", "td", "th"):
            self.end_block()
        if tag in HEADINGS:
            self.kind, self.level = "heading", HEADINGS[tag]
        elif tag == "li":
            self.kind = "list_item"
        elif tag == "pre":
            self.kind = "code_block"
        elif tag == "table" and self.cells is None:
            self.cells, self.row, self.heads = [], -1, set()
        elif tag == "tr":
            self.row, self.col = self.row + 1, -1
        elif tag in ("td", "th") and self.cells is not None:
            self.row, self.col = max(self.row, 0), self.col + 1
            span = {k: int(v) for k, v in attrs if k in ("rowspan", "colspan") and (v or "").isdecimal() and 0 < int(v) < 1000}
            self.cells.append({"row": self.row, "col": self.col, "text": "", "row_span": span.get("rowspan", 1), "col_span": span.get("colspan", 1)})
            self.col += span.get("colspan", 1) - 1
            if tag == "th":
                self.heads.add(self.row)
        elif tag == "img":
            alt = " ".join((dict(attrs).get("alt") or "").split())
            if alt and self.cells is None:
                self.end_block()
                self.out.append(("figure", "", None, {"kind": "figure", "alt_text": alt}))

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIPPED and tag != "head":
            self.skip = max(0, self.skip - 1)
            return
        if self.skip:
            return
        if tag in HEADINGS or tag in BLOCKS or tag in ("li", "pre", "td", "th"):
            self.end_block()
        if tag == "table" and self.cells is not None:
            cells, self.cells = self.cells, None
            if cells:
                size = {"rows": max(c["row"] + c["row_span"] for c in cells), "cols": max(c["col"] + c["col_span"] for c in cells)}
                self.out.append(("table", "", None, {"kind": "table", **size, "header_rows": len(self.heads) or 1, "cells": cells}))

    def handle_data(self, data: str) -> None:
        if not self.skip and self.get_starttag_text() != "<title>":
            self.text.append(data)


def html_elements(html: str | None) -> list[tuple]:
    """(type, text, level, content) of an HTML text, malformed or not."""
    reader = _Reader()
    try:
        reader.feed(html or "")
        reader.close()
    except Exception as e:  # a broken input becomes a row, not a failure of the job
        return [("paragraph", f"unparseable: {e}", None, None)]
    if reader.cells is not None:
        reader.handle_endtag("table")
    reader.end_block()
    return reader.out


def from_html(pages: DataFrame, key: str = "doc_id", html: str = "html") -> DataFrame:
    """ELEMENT rows of HTML texts; each input is one page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [
                {"doc_id": d, "page_index": 0, "seq": k, "type": t, "text": x, "level": v, "content": c}
                for d, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for k, (t, x, v, c) in enumerate(html_elements(h))
            ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(ELEMENT)
    return pages.select(F.col(key).cast("string"), F.col(html).cast("string")).mapInArrow(run, ELEMENT)


def from_lines(texts: DataFrame, key: str = "doc_id", text: str = "text", page_lines: int = 4) -> DataFrame:
    """ELEMENT rows of plain texts: a paragraph for each line, page_lines of them on a page."""
    rows = texts.select(F.col(key).cast("string").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("at", "text"))
    n = F.lit(page_lines)
    return rows.select(
        "doc_id", F.floor(F.col("at") / n).cast("int").alias("page_index"), (F.col("at") % n).cast("int").alias("seq"), F.lit("paragraph").alias("type"), "text",
        F.lit(None).cast("int").alias("level"), F.lit(None).cast(CONTENT).alias("content"),
    )


def retried(call: Callable[[], dict], attempts: int = 3, base: float = 2.0, most: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """call() with retries of passing failures inside the task, so that Spark never has to repeat a paid call; errors become rows."""
    for k in range(1, attempts + 1):
        try:
            return call()
        except Exception as e:
            response = getattr(e, "response", None)
            code = response.get("Error", {}).get("Code") if isinstance(response, dict) else None
            passing = transient(code, getattr(e, "status_code", getattr(e, "http_status", None)), str(e))
            if not passing or k == attempts:
                return {"error": str(e) or type(e).__name__, "error_kind": "throttled" if passing else "permanent"}
            headers = getattr(response, "headers", None) or getattr(e, "headers", None) or {}
            try:
                wait = min(most, float(headers.get("Retry-After") or headers.get("retry-after")))
            except (AttributeError, TypeError, ValueError):
                wait = min(most, base**k) * random.uniform(0.5, 1)
            sleep(wait)
    return {"error": "no attempt", "error_kind": "permanent"}


def transient(code: str | None, status: int | None, message: str) -> bool:
    """As quire.functions.errors.is_transient, for one error."""
    if code in PERMANENT_CODES:
        return False
    if code in TRANSIENT_CODES:
        return True
    text = message.lower()
    if any(h in text for h in PERMANENT_HINTS):
        return False
    if isinstance(status, int):
        if status in TRANSIENT_STATUS or 500 <= status < 600:
            return True
        if 400 <= status < 500:
            return False
    return any(h in text for h in TRANSIENT_HINTS)


def engine_results(promoted: DataFrame, make_client: Callable[[], Callable[[dict], str]], attempts: int = 3, parallelism: int | None = None) -> DataFrame:
    """(doc_id, page_index, reply, error, error_kind): the engine's reply for each promoted page.

    make_client runs once in each task. Write the result before it is used twice, else pages are paid for again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client()
        for b in batches:
            rows = []
            for r in b.to_pylist():
                got = retried(lambda r=r: {"reply": client(r)}, attempts)
                rows.append({"doc_id": r["doc_id"], "page_index": r["page_index"], "reply": got.get("reply"), "error": got.get("error"), "error_kind": got.get("error_kind")})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.string()), ("page_index", pa.int32()), ("reply", pa.string()), ("error", pa.string()), ("error_kind", pa.string())]))

    rows = promoted.withColumns({"doc_id": F.col("doc_id").cast("string"), "page_index": F.col("page_index").cast("int")})
    rows = rows.repartition(parallelism) if parallelism else rows
    return rows.mapInArrow(run, "doc_id string, page_index int, reply string, error string, error_kind string")
