"""Elements to Markdown: blocks, tables, pages, documents, and the records around them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from quire.constants import FURNITURE
from quire.functions.text import strip

CELL = "array<struct<row:int,col:int,text:string,row_span:int,col_span:int>>"


def escaped_cell(text: Column) -> Column:
    """Cell text with escaped pipes, on one line. Backslashes stay as they are."""
    return strip(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" ")))


def table_markdown(cells: Column, rows: Column, cols: Column) -> Column:
    """A pipe table; the last of several cells at a place wins, spans are ignored.

    rows and cols of null or 0 are taken from the cells' largest places; a table without either is empty.
    """
    size = lambda given, key: F.when(F.coalesce(given, F.lit(0)) > 0, given).otherwise(F.coalesce(F.array_max(F.transform(cells, lambda c: c[key])) + 1, F.lit(0)))
    n, m = size(rows, "row"), size(cols, "col")
    at = lambda r, c: F.coalesce(F.get(F.reverse(F.filter(cells, lambda x: (x["row"] == r) & (x["col"] == c))), F.lit(0))["text"], F.lit(""))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(F.sequence(F.lit(0), m - 1), lambda c: escaped_cell(at(r, c))), " | "), F.lit(" |"))
    lines = F.transform(F.sequence(F.lit(0), n - 1), line)
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), m.cast("int")))
    return F.when((F.size(F.coalesce(cells, F.array().cast(CELL))) > 0) & (n > 0) & (m > 0), F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.greatest(n - 1, F.lit(0)))), "\n")).otherwise(F.lit(""))


def table_grid(cells: DataFrame, key: list[str]) -> DataFrame:
    """key and markdown from a row for each cell (key, row, col, seq, text): the form for tables too large for one array scan a cell.

    The last cell by seq at a place wins; two ordered aggregations on the same key, without any per-cell search.
    """
    last = cells.groupBy(*key, "row", "col").agg(F.max_by("text", "seq").alias("text"))
    size = last.groupBy(*key).agg(F.max("col").alias("_m"), F.max("row").alias("_n"), F.collect_list(F.struct("row", "col", escaped_cell(F.col("text")).alias("t"))).alias("_cells"))
    lookup = F.map_from_entries(F.transform("_cells", lambda c: F.struct((c["row"].cast("long") * 100_000 + c["col"]).alias("k"), c["t"].alias("v"))))
    out = size.withColumn("_map", lookup)
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(F.sequence(F.lit(0), F.col("_m")), lambda c: F.coalesce(F.try_element_at("_map", r.cast("long") * 100_000 + c), F.lit(""))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), F.col("_m") + 1))
    lines = F.transform(F.sequence(F.lit(0), F.col("_n")), line)
    return out.select(*key, F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.greatest(F.col("_n"), F.lit(0)))), "\n").alias("markdown"))


def block(kind: Column, text: Column, level: Column, alt: Column, table: Column) -> Column:
    """The Markdown of an element; empty for furniture, list containers and elements without text."""
    body = strip(F.coalesce(text, F.lit("")))
    depth = F.least(F.greatest(F.coalesce(level.try_cast("int"), F.lit(1)), F.lit(1)), F.lit(6))
    figure = F.when(body != "", body).when(strip(F.coalesce(alt, F.lit(""))) != "", F.concat(F.lit("!["), strip(alt), F.lit("]"))).otherwise(F.lit(""))
    return (
        F.when(kind.isin(*FURNITURE) | (kind == "list"), F.lit("")).when(kind == "table", F.coalesce(F.nullif(table, F.lit("")), body)).when(kind == "figure", figure).when(body == "", F.lit(""))
        .when(kind == "heading", F.concat(F.repeat(F.lit("#"), depth), F.lit(" "), body)).when(kind == "list_item", F.concat(F.lit("- "), body))
        .when(kind == "code_block", F.concat(F.lit("```\n"), body, F.lit("\n```"))).when(kind == "equation", F.concat(F.lit("$$\n"), body, F.lit("\n$$"))).otherwise(body)
    )


def ordered_join(value: str, order: str, separator: str) -> Column:
    """Aggregate: the non-empty values in order, joined."""
    kept = F.collect_list(F.when(F.coalesce(F.col(value), F.lit("")) != "", F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return F.array_join(F.sort_array(kept)["v"], separator)


def with_markdown(elements: DataFrame) -> DataFrame:
    """elements (type, text, level, content{...}) with _md, the Markdown of each."""
    content = F.col("content")
    table = F.when(F.col("type") == "table", table_markdown(content["cells"], content["rows"], content["cols"]))
    return elements.withColumn("_md", block(F.col("type"), F.col("text"), F.col("level").cast("string"), content["alt_text"], table))


def page_markdown(elements: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, page_index, markdown) and other aggregates of the pages' elements (doc_id, page_index, seq, type, text, level, content{...})."""
    rows = with_markdown(elements)
    return rows.groupBy("doc_id", "page_index").agg(strip(ordered_join("_md", "seq", "\n\n")).alias("markdown"), *more)


def page_both(elements: DataFrame) -> DataFrame:
    """(doc_id, page_index, markdown, page_text, n_elements): as page_markdown() and page_text() have them, from one list of the elements,
    which holds an element's Markdown only where it isn't its text."""
    part = F.struct("seq", F.col("text"), F.when(F.col("_md").eqNullSafe(F.col("text")), F.lit(None)).otherwise(F.coalesce("_md", F.lit(""))).alias("md"))
    pages = with_markdown(elements).groupBy("doc_id", "page_index").agg(F.collect_list(part).alias("_parts"), F.count("*").alias("n_elements"))

    def joined(value: Callable[[Column], Column], separator: str) -> Column:
        told = F.transform("_parts", lambda x: F.struct(x["seq"].alias("o"), F.coalesce(value(x), F.lit("")).alias("v")))
        return F.array_join(F.sort_array(F.filter(told, lambda x: x["v"] != ""))["v"], separator)

    markdown, text = strip(joined(lambda x: F.coalesce(x["md"], x["text"]), "\n\n")), joined(lambda x: x["text"], " ")
    return pages.select("doc_id", "page_index", markdown.alias("markdown"), text.alias("page_text"), "n_elements")


def document_markdown(pages: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, markdown) and other aggregates of pages (doc_id, page_index, markdown): those that aren't blank, in order."""
    told = pages.withColumn("_md", F.when(strip(F.col("markdown")) != "", F.col("markdown")))
    return told.groupBy("doc_id").agg(ordered_join("_md", "page_index", "\n\n").alias("markdown"), *more)


def expanded(elements: DataFrame) -> DataFrame:
    """Engine elements (key..., seq, type, text, level, table) as elements with seq and sub: lists become an item for each line.

    Bullets inside a line (U+2022, U+00B7) start a new one. A table with cells but no text mirrors their texts; others pass with their level.
    """
    items = F.filter(F.transform(F.split(F.translate("text", "•·", "\n\n"), r"\R"), lambda x: strip(F.regexp_replace(strip(x), "^[-*]+", ""))), lambda x: x != "")
    mirrored = F.array_join(F.transform("table.cells", lambda c: F.coalesce(c["text"], F.lit(""))), " ")
    is_table = (F.col("type") == "table") & (F.size(F.coalesce(F.col("table.cells"), F.array().cast(CELL))) > 0)
    parts = (
        F.when((F.col("type") == "list") & (F.size(items) > 0), F.transform(items, lambda t: F.struct(F.lit("list_item").alias("type"), t.alias("text"))))
        .when(is_table, F.array(F.struct(F.lit("table").alias("type"), F.coalesce(F.nullif("text", F.lit("")), mirrored).alias("text")))).otherwise(F.array(F.struct("type", F.col("text"))))
    )
    own = [c for c in elements.columns if c not in ("type", "text")]
    return elements.select(*own, F.posexplode(parts).alias("sub", "_p")).select(*own, "sub", F.col("_p.type").alias("type"), F.col("_p.text").alias("text"))


def element_id(ref: Column, number: Column) -> Column:
    """The extractor's reference without its leading marks, else a number."""
    return F.when(F.coalesce(ref, F.lit("")) != "", F.regexp_replace(ref, "^[#/]+", "")).otherwise(F.format_string("elem_%05d", number.cast("long")))


def engine_element_id(page: Column, seq: Column, sub: Column | None = None) -> Column:
    head = F.format_string("vlm_p%d_%04d", page.cast("long"), seq.cast("long"))
    return head if sub is None else F.when(sub.isNull(), head).otherwise(F.format_string("vlm_p%d_%04d_%02d", page.cast("long"), seq.cast("long"), sub.cast("long")))


def renumbered(elements: DataFrame, key: str = "doc_id", order=("page_index", "start", "seq")) -> DataFrame:
    """elements in order with contiguous char spans: span_start and span_end count the characters of the texts before and with each."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(*order)
    length = F.length(F.coalesce(F.col("text"), F.lit("")))
    end = F.sum(length).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return elements.withColumns({"span_start": (end - length).cast("long"), "span_end": end.cast("long"), "position": F.row_number().over(w)})


def source_record(path: Column, mime: Column, content: Column) -> Column:
    """(doc_id, filename, mime_type, sha256) of an input."""
    from quire.functions.text import name, stem

    return F.struct(stem(path).alias("doc_id"), name(path).alias("filename"), mime.alias("mime_type"), F.sha2(content, 256).alias("sha256"))


def envelope(markdown: Column, source: Column, version: str = "1.0.0") -> Column:
    """A document's Markdown as one paragraph element in a complete output record (JSON)."""
    return F.to_json(F.struct(
        F.lit(version).alias("schema_version"), source.alias("source"), F.array(F.struct(F.lit(0).alias("page_index"))).alias("pages"),
        F.array(F.struct(F.lit("md_0001").alias("element_id"), F.lit("paragraph").alias("type"), F.lit(0).alias("page_index"), F.array(F.lit(0), F.length(markdown)).alias("char_span"), markdown.alias("text"))).alias("elements"),
        F.array().cast("array<string>").alias("warnings"),
    ))
