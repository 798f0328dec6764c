"""Blocks of a recognition engine: the id graph, tables, columns and reading order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from quire.constants import COLUMN_TOLERANCE, FULL_WIDTH, LAYOUT_LEVELS, LAYOUT_TYPES, SCORE_LEAD, UPWARD
from quire.functions.media import lookup
from quire.sources.shared import materialised

BLOCK = """doc_id string, page int, id string, pos int, block_type string, text string, children array<string>, box struct<left:double,top:double,width:double,height:double>,
row int, col int, row_span int, col_span int, entity_types array<string>, selected boolean"""


def from_json_blocks(blocks: Column) -> Column:
    """An engine's Blocks array as BLOCK-like structs (without doc_id), in order, children from CHILD relations."""
    child = lambda b: F.flatten(F.transform(F.filter(b["Relationships"], lambda r: r["Type"] == "CHILD"), lambda r: r["Ids"]))
    g = lambda b, k: b["Geometry"]["BoundingBox"][k]
    return F.transform(blocks, lambda b, i: F.struct(
        F.coalesce(b["Page"], F.lit(1)).alias("page"), b["Id"].alias("id"), i.alias("pos"), b["BlockType"].alias("block_type"), b["Text"].alias("text"), child(b).alias("children"),
        F.struct(g(b, "Left").alias("left"), g(b, "Top").alias("top"), g(b, "Width").alias("width"), g(b, "Height").alias("height")).alias("box"),
        b["RowIndex"].alias("row"), b["ColumnIndex"].alias("col"), b["RowSpan"].alias("row_span"), b["ColumnSpan"].alias("col_span"), b["EntityTypes"].alias("entity_types"), (b["SelectionStatus"] == "SELECTED").alias("selected"),
    ))


CHUNK = 1 << 16  # blocks that a worker resolves at once, rounded up to whole documents


def whole_documents(batches: Iterator[pa.RecordBatch], rows: int = CHUNK) -> Iterator[pa.Table]:
    """Batches sorted by their first column as tables of about so many rows, none of which parts a document."""
    held, n, whole, last = [], 0, 0, None  # whole: rows of held before its last document
    for b in batches:
        if not b.num_rows:
            continue
        ends = pc.run_end_encode(b.column(0)).run_ends.to_numpy()
        if len(ends) > 1:
            whole = n + int(ends[-2])
        elif held and not b.column(0)[0] == last:
            whole = n
        held.append(b)
        n, last = n + b.num_rows, b.column(0)[-1]
        if whole >= rows:
            t = pa.Table.from_batches(held)
            yield t.slice(0, whole)
            held, n, whole = t.slice(whole).to_batches(), n - whole, 0
    if held:
        yield pa.Table.from_batches(held)


def _matches(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in wanted, in keys) of all equal pairs, in the order of wanted; keys below 0 equal none."""
    by_key = np.argsort(keys, kind="stable")
    found = keys[by_key]
    low, high = np.searchsorted(found, wanted, "left"), np.searchsorted(found, wanted, "right")
    n = np.where(wanted < 0, 0, high - low)
    left = np.repeat(np.arange(len(wanted)), n)
    return left, by_key[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(len(left))]


def _grouped(group: np.ndarray, at: np.ndarray, ties: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """The order by group, at and ties, and the first place of each group in it."""
    order = np.lexsort((at, group))
    g, a = group[order], at[order]
    if np.any((g[1:] == g[:-1]) & (a[1:] == a[:-1])):
        order = pc.sort_indices(pa.table([pa.array(group), pa.array(at), *ties], [str(k) for k in range(len(ties) + 2)]), [(str(k), "ascending") for k in range(len(ties) + 2)]).to_numpy()
        g = group[order]
    return order, np.flatnonzero(np.r_[True, g[1:] != g[:-1]][: len(g)])


def _lists(starts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def _rank(groups: np.ndarray, keys: np.ndarray) -> pa.Array:
    """The place of each key in the sorted groups, null if it is none of them."""
    place = np.searchsorted(groups, keys)
    known = place < len(groups)
    known[known] = groups[place[known]] == keys[known]
    return pa.array(place, mask=~known)


def _graph(t: pa.Table) -> tuple[dict[str, pa.Array], np.ndarray, np.ndarray, Callable]:
    """Of whole documents: their columns, the number of each block's document, a key for its id in it (-1 for none), and a function of
    two kinds to their resolved edges (row of the parent, at, row of the child)."""
    c = {n: t.column(n).combine_chunks() for n in t.column_names}
    ends = pc.run_end_encode(c["doc_id"]).run_ends.to_numpy()
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    n_kids = pc.fill_null(pc.list_value_length(c["children"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parent = np.repeat(np.arange(len(doc)), n_kids)
    at = np.arange(len(parent)) - np.repeat(np.cumsum(n_kids) - n_kids, n_kids)
    code = pc.dictionary_encode(pa.concat_arrays([c["id"], c["children"].flatten()]))
    n_ids, code = len(code.dictionary), pc.fill_null(code.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    both = np.where((code < 0) | np.r_[lost := c["doc_id"].is_null().to_numpy(zero_copy_only=False), lost[parent]], -1, np.r_[doc, doc[parent]] * n_ids + code)
    key, kid = both[: len(doc)], both[len(doc) :]
    kind = c["kind"].to_numpy()

    def edges(of: int, to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, some = np.flatnonzero(kind == to), np.flatnonzero((kind[parent] == of) & (key[parent] >= 0))
        left, right = _matches(key[rows], kid[some])
        return parent[some[left]], at[some[left]], rows[right]

    return c, doc, key, edges


def _joined_texts(c: dict[str, pa.Array], key: np.ndarray, edges: tuple[np.ndarray, np.ndarray, np.ndarray], separator: str) -> tuple[np.ndarray, pa.Array]:
    """(sorted keys of the parents, the texts of their children in order, joined)"""
    parent, at, row = edges
    texts = c["text"].cast(pa.string()).take(pa.array(row))
    order, starts = _grouped(key[parent], at, [texts])
    return key[parent][order][starts], pc.binary_join(_lists(starts, texts.take(pa.array(order))), separator)


def _grids(t: pa.Table) -> pa.RecordBatch:
    """The tables of whole documents; see tables()."""
    c, _, key, edges = _graph(t)
    kind = c["kind"].to_numpy()
    told, joined = _joined_texts(c, key, edges(CELLS, WORDS), " ")
    parent, place, row = edges(TABLES, CELLS)
    table = key[parent]
    number = {n: c[n].to_numpy(zero_copy_only=False)[row] for n in ("row", "col", "row_span", "col_span")}
    fields = {n: pa.array(v, pa.int32()) for n, v in number.items()} | {"text": pc.fill_null(joined.take(_rank(told, key[row])), "")}
    fields = [fields[n] for n in CELL_FIELDS]
    order, starts = _grouped(table, place, fields)
    lists = _lists(starts, pa.StructArray.from_arrays(fields, CELL_FIELDS).take(pa.array(order)))
    group = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(order)))
    most = lambda a, b: np.maximum.reduceat((number[a].astype(np.int64) + number[b])[order], starts) if len(starts) else np.zeros(0, np.int64)
    marked = c["header"].to_numpy(zero_copy_only=False)[row][order]
    heads = np.unique(np.stack([group[marked], number["row"][order][marked].astype(np.int64)]), axis=1)[0]
    heads = np.maximum(np.bincount(heads, minlength=len(starts)), 1)

    mine = np.flatnonzero(kind == TABLES)
    rank = _rank(table[order][starts], key[mine])
    size = lambda v: pc.fill_null(pa.array(v, pa.int32()).take(rank), 0)
    return pa.RecordBatch.from_arrays([c["doc_id"].take(pa.array(mine)), c["id"].take(pa.array(mine)), size(most("row", "row_span")), size(most("col", "col_span")), size(heads), lists.take(rank)], ["doc_id", "id", "rows", "cols", "header_rows", "cells"])


TABLES, CELLS, WORDS, LINES, LAYOUTS, PAGES = range(6)  # kinds of blocks
CELL_FIELDS = ["row", "col", "text", "row_span", "col_span"]


def _word() -> Column:
    """The text of a word, [X] or [ ] for a check box."""
    return F.when(F.col("block_type") == "WORD", F.col("text")).when(F.col("block_type") == "SELECTION_ELEMENT", F.when(F.col("selected"), "[X]").otherwise("[ ]"))


def tables(blocks: DataFrame) -> DataFrame:
    """(doc_id, id, rows, cols, header_rows, cells) of TABLE blocks: 0-based cells with spans of at least 1.

    header_rows is the number of rows with a column header, 1 if none is marked, 0 without cells. Blocks are dealt once by document
    (not at all if they lie so) and resolved in Arrow tables of whole documents, so a worker holds some 65,000 blocks, or those of its
    largest document if they are more.
    """
    one = lambda c: F.coalesce(F.col(c), F.lit(1))
    span = lambda c: F.greatest(one(c), F.lit(1)).cast("int").alias(c)
    kind = F.when(F.col("block_type") == "TABLE", TABLES).when(F.col("block_type") == "CELL", CELLS).when(F.col("block_type").isin("WORD", "SELECTION_ELEMENT"), WORDS)
    header = F.array_contains(F.coalesce(F.col("entity_types"), F.array().cast("array<string>")), "COLUMN_HEADER")
    slim = blocks.select(
        "doc_id", "id", kind.cast("int").alias("kind"), _word().alias("text"), F.when(kind != WORDS, F.col("children")).alias("children"), (one("row") - 1).cast("int").alias("row"), (one("col") - 1).cast("int").alias("col"),
        span("row_span"), span("col_span"), F.coalesce(header, F.lit(False)).alias("header"),
    ).where(f"kind < {WORDS} OR text <> ''").repartition("doc_id").sortWithinPartitions("doc_id")
    cell = T.StructType([T.StructField(n, T.StringType() if n == "text" else T.IntegerType()) for n in CELL_FIELDS])
    sizes = [T.StructField(n, T.IntegerType()) for n in ("rows", "cols", "header_rows")]
    schema = T.StructType([*(T.StructField(n, blocks.schema[n].dataType) for n in ("doc_id", "id")), *sizes, T.StructField("cells", T.ArrayType(cell))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_documents(batches):
            yield _grids(t)

    return slim.mapInArrow(run, schema)


def _layouts(t: pa.Table) -> pa.RecordBatch:
    """The layout and table blocks of whole documents; see resolved_layouts()."""
    c, doc, key, edges = _graph(t)
    kind = c["kind"].to_numpy()
    rows = np.flatnonzero((kind == LAYOUTS) | (kind == TABLES))
    mine, is_layout = key[rows], kind[rows] == LAYOUTS
    texts = [v.take(_rank(k, mine)) for k, v in (_joined_texts(c, key, edges(LAYOUTS, of), by) for of, by in ((LINES, "\n"), (WORDS, " ")))]

    parent, place, row = edges(LAYOUTS, TABLES)
    some = pc.fill_null(pc.equal(c["block_type"], "LAYOUT_TABLE"), False).to_numpy(zero_copy_only=False)[parent]
    parent, place, row = parent[some], place[some], row[some]
    order, starts = _grouped(key[parent], place, [c["id"].take(pa.array(row))])
    first, rank = row[order][starts], _rank(key[parent][order][starts], mine)

    # the children of one PAGE block after the other, each at its first place
    parent, place, row = edges(PAGES, LAYOUTS)
    pos = pc.fill_null(c["pos"].cast(pa.int64()), np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    kids = row[np.lexsort((place, pos[parent], doc[row]))]
    kids = kids[np.sort(np.unique(key[kids], return_index=True)[1])]
    seat = np.arange(len(kids)) - np.searchsorted(doc[kids], doc[kids])
    by_key = np.argsort(key[kids])
    seats = pa.array(seat[by_key], pa.int32()).take(_rank(key[kids][by_key], mine))
    lone = np.ones(doc[-1] + 1, bool)
    lone[doc[kids]] = False
    lone = lone[doc[rows]]
    laid = is_layout & (mine >= 0) & (lone | seats.is_valid().to_numpy(zero_copy_only=False))
    held = np.isin(mine, pa.array(key[first]).take(rank.filter(pa.array(laid))).drop_null().to_numpy()) & (mine >= 0)

    took = lambda n: c[n].take(pa.array(rows))
    out = {
        "doc_id": took("doc_id"), "id": took("id"), "pos": took("pos"), "block_type": took("block_type"), "layout_text": pc.coalesce(*texts, pa.scalar("")), "table_id": c["id"].take(pa.array(first)).take(rank),
        "place": seats, "lone": pa.array(lone), "laid": pa.array(laid), "held": pa.array(held), "left": took("left"), "top": took("top"), "width": took("width"),
    }
    return pa.RecordBatch.from_arrays(list(out.values()), list(out))


def resolved_layouts(blocks: DataFrame) -> DataFrame:
    """(doc_id, id, pos, block_type, layout_text, table_id, place, lone, laid, held, left, top, width) of layout and TABLE blocks.

    layout_text: the texts of its lines joined by line feeds, else its own words. table_id: the first table of a layout table. place: in
    the order of the PAGE blocks, null for what these don't hold; lone: they hold no layout block of the document. laid: has a place or
    is lone; held: a table that a laid block has first. Dealt and bounded as in tables().
    """
    t = F.col("block_type")
    kind = F.when(t == "TABLE", TABLES).when(t.isin("WORD", "SELECTION_ELEMENT"), WORDS).when(t == "LINE", LINES).when(t.startswith("LAYOUT_"), LAYOUTS).when(t == "PAGE", PAGES)
    double = lambda n: (F.col(f"box.{n}") if "box" in blocks.columns else F.lit(None)).cast("double").alias(n)
    slim = blocks.select(
        "doc_id", "id", kind.cast("int").alias("kind"), F.when(t == "LINE", F.col("text")).otherwise(_word()).alias("text"), F.when(kind.isin(LAYOUTS, PAGES), F.col("children")).alias("children"),
        F.col("pos").cast("int").alias("pos"), F.when(kind.isin(LAYOUTS, TABLES), t).alias("block_type"), double("left"), double("top"), double("width"),
    ).where(f"kind NOT IN ({WORDS}, {LINES}) OR text <> ''").repartition("doc_id").sortWithinPartitions("doc_id")
    kept = {n: blocks.schema[n].dataType for n in ("doc_id", "id")}
    types = {**kept, "pos": T.IntegerType(), "block_type": T.StringType(), "layout_text": T.StringType(), "table_id": kept["id"], "place": T.IntegerType()}
    types |= dict.fromkeys(("lone", "laid", "held"), T.BooleanType()) | dict.fromkeys(("left", "top", "width"), T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_documents(batches):
            yield _layouts(t)

    return slim.mapInArrow(run, T.StructType([T.StructField(n, v) for n, v in types.items()]))


def elements(blocks: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """(doc_id, seq, type, level, text, table_id) of the blocks of each document, in order (native order by default).

    The native order has the children of one PAGE block after the other, each at its first place. Documents whose PAGE blocks hold no
    layout block have the order that reconciled() finds by geometry; without boxes (no column box) the input order. Layout blocks of a
    known type give an element with their text; layout tables one for their first table; tables that no layout block holds come last, in
    input order. The resolved blocks are written to the shared folder at once, so that they are made once.
    """
    rows = materialised(resolved_layouts(blocks), "blocks")
    found = rows.where(F.col("block_type") != "TABLE")
    names = ["doc_id", "block_type", "layout_text", "table_id", "place"]
    if order is not None:
        laid = order.join(found.drop("place"), ["doc_id", "id"]).select(names)
        left = rows.where("block_type = 'TABLE'").select("doc_id", F.col("id").alias("table_id"), "pos").join(laid.where("table_id IS NOT NULL").select("doc_id", "table_id"), ["doc_id", "table_id"], "left_anti")
    else:
        lone = found.where("lone").drop("place")
        if "box" in blocks.columns:
            lone = reconciled(lone.withColumn("top", F.coalesce("top", F.lit(0.0))), "doc_id")
        else:
            lone = lone.withColumn("place", F.col("pos"))
        laid = found.where("laid AND NOT lone").select(names).unionByName(lone.where("laid").withColumn("place", F.col("place").cast("int")).select(names))
        left = rows.where("block_type = 'TABLE' AND NOT held").select("doc_id", F.col("id").alias("table_id"), "pos")
    kind = F.when(F.col("block_type") == "LAYOUT_TABLE", F.when(F.col("table_id").isNotNull(), "table")).otherwise(lookup(LAYOUT_TYPES, F.col("block_type")))
    told = laid.select("doc_id", F.lit(0).alias("_late"), F.col("place").alias("_at"), kind.alias("type"), lookup(LAYOUT_LEVELS, F.col("block_type")).alias("level"), F.when(kind == "table", "").otherwise(F.col("layout_text")).alias("text"), F.when(kind == "table", F.col("table_id")).alias("table_id"))
    told = told.where("type IS NOT NULL AND (type = 'table' OR text <> '')")
    late = left.select("doc_id", F.lit(1).alias("_late"), F.col("pos").alias("_at"), F.lit("table").alias("type"), F.lit(None).cast("int").alias("level"), F.lit("").alias("text"), "table_id")
    w = Window.partitionBy("doc_id").orderBy("_late", "_at")
    return told.unionByName(late).withColumn("seq", F.row_number().over(w) - 1).drop("_late", "_at")


def with_geometry(boxes: DataFrame) -> DataFrame:
    """boxes (left, top, width) with nulls as 0 and x_center."""
    z = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return boxes.withColumns({"left": z("left"), "top": z("top"), "width": z("width")}).withColumn("x_center", F.col("left") + F.col("width") / 2)


def banded(boxes: DataFrame, key: str = "page", tolerance: float = COLUMN_TOLERANCE) -> DataFrame:
    """boxes (key, pos, left, top, width) with is_full, band (null for full-width boxes) and n_bands.

    Boxes wider than 85 % divide the page. The others, by x center, join the band whose running mean is nearest within the
    tolerance of the last band, else open the next: a fold over the page's sorted centers, since each mean depends on who came before.
    """
    rows = with_geometry(boxes).withColumn("is_full", F.col("width") > FULL_WIDTH).withColumn("pos", F.col("pos").cast("long"))
    # bounded by the boxes of one page, which stay together: nothing is joined to its band
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in (key, "x_center", "pos")]
    pages = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("x_center", "pos", *rest))).alias("_c"))
    start = F.struct(F.lit(-1).alias("band"), F.lit(0.0).cast("double").alias("mean"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))

    def step(a: Column, c: Column) -> Column:
        joins = (a["n"] > 0) & (F.abs(c["x_center"] - a["mean"]) <= tolerance)
        band = F.when(joins, a["band"]).otherwise(a["band"] + 1)
        n = F.when(joins, a["n"] + 1).otherwise(F.lit(1))
        mean = F.when(joins, a["mean"] + (c["x_center"] - a["mean"]) / (a["n"] + 1)).otherwise(c["x_center"])
        own = F.struct(band.alias("band"), mean.alias("mean"), n.alias("n"), F.concat(a["out"], F.array(band)).alias("out"))
        return F.when(c["is_full"], F.struct(a["band"].alias("band"), a["mean"].alias("mean"), a["n"].alias("n"), F.concat(a["out"], F.array(F.lit(None).cast("int"))).alias("out"))).otherwise(own)

    folded = pages.withColumn("_f", F.aggregate("_c", start, step, lambda a: F.struct((a["band"] + 1).alias("n_bands"), a["out"].alias("out"))))
    out = folded.select(key, F.col("_f.n_bands").alias("n_bands"), F.inline(F.arrays_zip("_c", F.col("_f.out").alias("band"))).alias("_b", "band"))
    return out.select(key, "_b.*", "band", "n_bands")


def zoned(boxes: DataFrame, key: str) -> tuple[DataFrame, WindowSpec]:
    """boxes with bands and _zone, and the window of the column-aware order."""
    # a divider comes before what begins as high, so that all dividers down to a box's top have been counted at it
    above = Window.partitionBy(key).orderBy("top", F.col("is_full").desc(), "pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = banded(boxes, key).withColumn("_zone", F.count_if("is_full").over(above))
    many = F.col("n_bands") > 1
    return rows, Window.partitionBy(key).orderBy(F.when(many, F.col("_zone")), F.when(many, (~F.col("is_full")).cast("int")), F.when(many, F.col("band")), "top", "left", "pos")


def column_order(boxes: DataFrame, key: str = "page") -> DataFrame:
    """boxes with geo_place: dividers by top open zones; in a zone bands from left to right, each by (top, left). With at most one
    band all boxes by (top, left)."""
    rows, w = zoned(boxes, key)
    return rows.withColumn("geo_place", F.row_number().over(w) - 1).drop("_zone")


def good_step(x: Column, y: Column, tolerance: float = COLUMN_TOLERANCE) -> Column:
    """1 if the step from a box to that with x_center x and top y goes down a column or up to the next, else 0; null without a next one."""
    same = F.abs(x - F.col("x_center")) <= tolerance
    down, reset = same & (y >= F.col("top") - UPWARD), ~same & (x > F.col("x_center")) & (y < F.col("top") - UPWARD)
    return F.when(x.isNotNull(), (down | reset).cast("int"))


def order_score(boxes: DataFrame, place: str, key: str = "page", tolerance: float = COLUMN_TOLERANCE) -> DataFrame:
    """(key, score): the share of steps of the order that go down a column or up to the next; 0.5 for under two boxes."""
    w = Window.partitionBy(key).orderBy(place)
    rows = with_geometry(boxes).select(key, "x_center", "top", F.lead("x_center").over(w).alias("_x"), F.lead("top").over(w).alias("_y"))
    return rows.groupBy(key).agg(F.coalesce(F.avg(good_step(F.col("_x"), F.col("_y"), tolerance)), F.lit(0.5)).alias("score"))


def reconciled(boxes: DataFrame, key: str = "page", lead: float = SCORE_LEAD) -> DataFrame:
    """boxes with place and adopted: the column-aware order where it scores better than that by (top, left) by more than lead.

    The boxes of a page are dealt once; both orders and their scores are windows over them.
    """
    rows, by_column = zoned(boxes, key)
    by_top, page = Window.partitionBy(key).orderBy("top", "left", "pos"), Window.partitionBy(key)
    for w, place, score in ((by_column, "geo_place", "score_geo"), (by_top, "top_place", "score_given")):
        rows = rows.withColumns({place: F.row_number().over(w) - 1, "_x": F.lead("x_center").over(w), "_y": F.lead("top").over(w)})
        rows = rows.withColumn(score, F.coalesce(F.avg(good_step(F.col("_x"), F.col("_y"))).over(page), F.lit(0.5)))
    out = rows.drop("_zone", "_x", "_y").withColumn("adopted", F.col("score_geo") > F.col("score_given") + lead)
    return out.withColumn("place", F.when(F.col("adopted"), F.col("geo_place")).otherwise(F.col("top_place")))
