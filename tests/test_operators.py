"""Gate, rendering, layout, routing, roll-ups and reports on small frames with expectations worked out by hand."""

import random
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.constants import ROUTES, Config
from quire.operators import layout, quality, render, report, rollup, routing
from quire.plans import catalog
from quire.plans.parse import RESULTS, parse_documents, read_replies
from quire.sources import files
from quire.sources.extractors import ELEMENT, engine_results, from_html, html_elements

CELLS = "array<struct<row:int,col:int,text:string,row_span:int,col_span:int>>"


def test_first_gate_layer_decides(spark):
    pages = spark.createDataFrame([("d", k, t, n) for k, (t, n) in enumerate([("good words here", 3), ("a1 b2 c3", 3), ("good words", 2), ("fine words", 2), ("", 0)])], "doc_id string, page_index int, page_text string, extracted_tokens long")
    grades = spark.createDataFrame([("d", 1, "good", "good"), ("d", 2, "POOR", "fair"), ("d", 3, "good", "Fair")], "doc_id string, page_index int, low_grade string, mean_grade string")
    layers = spark.createDataFrame([("d", 0, 29), ("d", 2, 100), ("d", 4, 30)], "doc_id string, page_index int, text_layer_tokens long")
    got = {r["page_index"]: r["decision"] for r in quality.gated(pages, grades, layers).collect()}
    assert got[0]["action"] == "keep" and got[0]["layer"] is None
    assert got[1]["layer"] == 2 and got[1]["reason"].startswith("heuristic_failed: garbled_token_ratio")
    assert got[2]["reason"] == "docling_low_grade=POOR" and got[3]["reason"] == "docling_mean_grade=Fair"
    assert got[4]["reason"] == "low_coverage: extracted 0 of 30 text-layer tokens" and got[4]["layer"] == 1


def test_one_based_grades_fall_back_to_the_next_index(spark):
    pages = spark.createDataFrame([("d", 0, "fine words", 2)], "doc_id string, page_index int, page_text string, extracted_tokens long")
    grades = spark.createDataFrame([("d", 1, "poor", None)], "doc_id string, page_index int, low_grade string, mean_grade string")
    assert quality.gated(pages, grades).first()["decision"]["action"] == "keep"
    assert quality.gated(pages, grades, one_based_grades=True).first()["decision"]["reason"] == "docling_low_grade=poor"


@pytest.mark.parametrize("cells, rows, cols, want", [
    ([(0, 0, "a|b", 1, 1), (1, 1, " x\ny ", 1, 1)], 0, 0, "| a\\|b |  |\n| --- | --- |\n|  | x y |"), ([(0, 0, "old", 1, 1), (0, 0, "new", 1, 1)], None, None, "| new |\n| --- |"),
    ([], 2, 2, ""), (None, 2, 2, ""), ([(0, 0, None, 1, 1)], 2, 1, "|  |\n| --- |\n|  |"),
])
def test_tables(spark, cells, rows, cols, want):
    df = spark.createDataFrame([(cells, rows, cols)], f"c {CELLS}, r int, k int")
    assert df.select(render.table_markdown(F.col("c"), F.col("r"), F.col("k"))).first()[0] == want


@pytest.mark.parametrize("kind, text, level, alt, want", [
    ("heading", " T ", "0", None, "# T"), ("heading", "T", "9", None, "###### T"), ("heading", "T", "odd", None, "# T"), ("list_item", "x", None, None, "- x"), ("list", "x", None, None, ""),
    ("code_block", "x", None, None, "```\nx\n```"), ("equation", "x", None, None, "$$\nx\n$$"), ("figure", "", None, "alt", "![alt]"), ("figure", "t", None, "alt", "t"), ("footer", "x", None, None, ""),
    ("odd", " x ", None, None, "x"), ("paragraph", None, None, None, ""),
])
def test_blocks(spark, kind, text, level, alt, want):
    df = spark.createDataFrame([(kind, text, level, alt)], "k string, t string, l string, a string")
    assert df.select(render.block(F.col("k"), F.col("t"), F.col("l"), F.col("a"), F.lit(None).cast("string"))).first()[0] == want


def test_pages_keep_their_order(spark):
    rows = [("d", p, s, "paragraph", f"P{p}S{s}", None, None) for p in range(12) for s in range(11)]
    random.Random(1).shuffle(rows)
    got = render.document_markdown(render.page_markdown(spark.createDataFrame(rows, ELEMENT).repartition(5))).first()["markdown"]
    assert got.split("\n\n") == [f"P{p}S{s}" for p in range(12) for s in range(11)]


def test_engine_elements_are_expanded(spark):
    schema = f"seq int, type string, text string, level string, table struct<rows:int,cols:int,header_rows:int,cells:{CELLS}>"
    cells = (1, 2, 1, [(0, 0, "a", 1, 1), (0, 1, "b", 1, 1)])
    df = spark.createDataFrame([(0, "list", "- one\n* two • three", None, None), (1, "table", "", None, cells), (2, "table", "own", None, cells), (3, "heading", "H", "2", None), (4, "list", "  ", None, None)], schema)
    assert [(r["seq"], r["sub"], r["type"], r["text"]) for r in render.expanded(df).orderBy("seq", "sub").collect()] == [
        (0, 0, "list_item", "one"), (0, 1, "list_item", "two"), (0, 2, "list_item", "three"), (1, 0, "table", "a b"), (2, 0, "table", "own"), (3, 0, "heading", "H"), (4, 0, "list", "  "),
    ]


def test_ids_are_not_cut(spark):
    row = spark.range(1).select(render.element_id(F.lit(None).cast("string"), F.lit(1234567)), render.element_id(F.lit("#/texts/3"), F.lit(1)), render.engine_element_id(F.lit(2), F.lit(7), F.lit(3))).first()
    assert tuple(row) == ("elem_1234567", "texts/3", "vlm_p2_0007_03")


def python_order(boxes):
    """Places by the definition: dividers wider than 0.85 open zones; in each, bands by running mean from left to right."""
    x = {b[0]: b[1] + b[3] / 2 for b in boxes}
    band, last, mean, n = {}, -1, 0.0, 0
    for b in sorted((b for b in boxes if b[3] <= 0.85), key=lambda b: (x[b[0]], b[0])):
        if n and abs(x[b[0]] - mean) <= 0.10:
            mean, n = mean + (x[b[0]] - mean) / (n + 1), n + 1
        else:
            last, mean, n = last + 1, x[b[0]], 1
        band[b[0]] = last
    if last < 1:
        return [b[0] for b in sorted(boxes, key=lambda b: (b[2], b[1], b[0]))]
    out, rest = [], [b for b in boxes if b[3] <= 0.85]
    dividers = sorted((b for b in boxes if b[3] > 0.85), key=lambda b: (b[2], b[0]))
    for k in range(len(dividers) + 1):
        low, high = (dividers[k - 1][2] if k else float("-inf")), (dividers[k][2] if k < len(dividers) else float("inf"))
        out += [dividers[k - 1][0]] if k else []
        out += [b[0] for b in sorted((b for b in rest if low <= b[2] < high), key=lambda b: (band[b[0]], b[2], b[1], b[0]))]
    return out


def test_column_order_like_the_definition(spark):
    r = random.Random(3)
    pages = {p: [(k, r.choice([0.05, 0.1, 0.4, 0.55, 0.7]), r.randrange(8) / 8, r.choice([0.2, 0.3, 0.4, 0.9])) for k in range(r.randrange(1, 12))] for p in range(120)}
    df = spark.createDataFrame([(p, *b) for p, bs in pages.items() for b in bs], "page int, pos long, left double, top double, width double")
    got = {}
    for row in layout.column_order(df).orderBy("page", "geo_place").collect():
        got.setdefault(row["page"], []).append(row["pos"])
    assert got == {p: python_order(bs) for p, bs in pages.items()}


def test_order_score(spark):
    df = spark.createDataFrame([(1, 0, 0.1, 0.1, 0.2), (1, 1, 0.1, 0.5, 0.2), (1, 2, 0.6, 0.1, 0.2), (1, 3, 0.1, 0.05, 0.2), (2, 0, 0.1, 0.1, 0.2)], "page int, pos long, left double, top double, width double")
    got = {r["page"]: r["score"] for r in layout.order_score(df, "pos").collect()}
    assert got[1] == pytest.approx(2 / 3) and got[2] == 0.5


def test_block_graph(spark):
    text = """[{"Id":"p","BlockType":"PAGE","Relationships":[{"Type":"CHILD","Ids":["t","b","gone","t"]}]},
      {"Id":"b","BlockType":"LAYOUT_TEXT","Relationships":[{"Type":"CHILD","Ids":["l2","l1"]}]},{"Id":"t","BlockType":"LAYOUT_TITLE","Relationships":[{"Type":"CHILD","Ids":["w","s"]}]},
      {"Id":"l1","BlockType":"LINE","Text":"one"},{"Id":"l2","BlockType":"LINE","Text":"two"},{"Id":"w","BlockType":"WORD","Text":"Yes"},{"Id":"s","BlockType":"SELECTION_ELEMENT","SelectionStatus":"SELECTED"},
      {"Id":"tab","BlockType":"TABLE","Relationships":[{"Type":"CHILD","Ids":["c"]}]},{"Id":"c","BlockType":"CELL","RowIndex":2,"ColumnIndex":1,"ColumnSpan":3,"Relationships":[{"Type":"CHILD","Ids":["w"]}]}]"""
    schema = "array<struct<Id:string,BlockType:string,Text:string,Page:int,Geometry:struct<BoundingBox:struct<Left:double,Top:double,Width:double,Height:double>>,Relationships:array<struct<Type:string,Ids:array<string>>>,RowIndex:int,ColumnIndex:int,RowSpan:int,ColumnSpan:int,EntityTypes:array<string>,SelectionStatus:string>>"
    df = spark.createDataFrame([("d", text)], "doc_id string, j string").select("doc_id", F.explode(layout.from_json_blocks(F.from_json("j", schema))).alias("b")).select("doc_id", "b.*")
    got = [(r["type"], r["level"], r["text"], r["table_id"]) for r in layout.elements(df).orderBy("seq").collect()]
    assert got == [("heading", 1, "Yes [X]", None), ("paragraph", None, "two\none", None), ("table", None, "", "tab")]
    t = layout.tables(df).first()
    assert (t["rows"], t["cols"], t["header_rows"], t["cells"][0]["text"]) == (2, 3, 1, "Yes")


PAGE = "doc_id string, page_index int, kind string, markdown string, n_elements int, passes boolean, decision struct<action:string,reason:string,layer:int>"
KEEP, PROMOTE = ("keep", None, None), ("promote_to_vlm", "heuristic_failed: x", 2)


def run(spark, pages, results, **config):
    out = routing.routed(routing.intents(spark.createDataFrame(pages, PAGE), Config(**config)), spark.createDataFrame(results, RESULTS), Config(**config))
    return {r["page_index"]: r for r in out.collect()}


@pytest.mark.parametrize("engine", ["vlm", "textract"])
@pytest.mark.parametrize("result, route, reason", [
    (("err", "throttled", False, 0, None, None), "-fallback-docling", "throttled"), (("err", "permanent", False, 0, None, None), "-fallback-docling", PROMOTE[1]),
    ((None, None, False, 0, None, None), "-fallback-docling", PROMOTE[1]), ((None, None, True, 0, None, None), "-fallback-docling", PROMOTE[1]), ((None, None, True, 1, "  ", False), "-fallback-docling", PROMOTE[1]),
    ((None, None, True, 1, "text", True), "", PROMOTE[1]), ((None, None, True, 1, "text", False), "", PROMOTE[1]),
])
def test_fallback_triggers(spark, engine, result, route, reason):
    got = run(spark, [("d", 0, "pdf", "own", 1, True, PROMOTE)], [("d", 0, *result)], engine=engine)[0]
    assert (got["route"], got["reason"], got["markdown_out"]) == (engine + route, reason, "own" if route else "text")


@pytest.mark.parametrize("engine_ok, own, own_ok, reason, rejected", [
    (False, "own", True, "heuristic_failed: x", True), (True, "own", True, "heuristic_failed: x", False), (False, "", True, "heuristic_failed: x", False), (False, "own", False, "heuristic_failed: x", False),
    (False, "own", True, "low_coverage: extracted 1 of 99 text-layer tokens", False),
])
def test_arbitration(spark, engine_ok, own, own_ok, reason, rejected):
    page, result = [("d", 0, "pdf", own, 1, own_ok, ("promote_to_vlm", reason, 2))], [("d", 0, None, None, True, 1, "text", engine_ok)]
    assert run(spark, page, result, arbitration=True)[0]["route"] == ("vlm-rejected-kept-docling" if rejected else "vlm")
    assert run(spark, page, result)[0]["route"] == "vlm"


def test_intents(spark):
    pages = [("d", 0, "pdf", " ", 1, False, KEEP), ("d", 1, "image", " ", 1, False, KEEP), ("d", 2, "image", "", 0, False, KEEP), ("d", 3, "html", "", 0, False, PROMOTE), ("d", 4, "pdf", "x", 1, True, KEEP)]
    got = run(spark, pages, [])
    assert [got[k]["promote"] for k in range(5)] == [True, False, True, False, False] and got[0]["route"] == "vlm" and got[0]["engine_quality_passes"] is None
    off = run(spark, pages, [], escalate=False)
    assert not any(r["promote"] for r in off.values()) and off[0]["reason"] == "budget_exhausted_no_escalation" and off[4]["reason"] is None


@pytest.mark.parametrize("route, engine, vlm, score", [
    ("docling-kept", None, None, 0.95), ("vlm", True, False, 0.85), ("vlm", None, False, 0.60), ("textract", None, None, 0.15), ("vlm-rejected-kept-docling", None, None, 0.70), ("textract-fallback-docling", None, None, 0.50), ("odd", True, None, 0.15),
])
def test_page_confidence(spark, route, engine, vlm, score):
    df = spark.createDataFrame([(route, engine, vlm)], "r string, e boolean, v boolean")
    assert df.select(rollup.page_confidence(F.col("r"), F.col("e"), F.col("v"))).first()[0] == score


def test_document_confidence_weighs_by_characters(spark):
    df = spark.createDataFrame([("a", 0.95, 30), ("a", 0.15, 10), ("b", 0.95, 0)], "doc_id string, confidence double, n_chars long")
    assert {r[0]: round(r[1], 9) for r in rollup.document_confidence(df).collect()} == {"a": 0.75, "b": 0.0}


def test_route_records(spark):
    rows = [("a", 1, "vlm-fallback-docling", "throttled"), ("a", 0, "docling-kept", ""), ("b", 0, "textract-rejected-kept-docling", "r"), ("c", 0, "docling-kept", None), ("e", 0, "vlm", "x"), ("e", 1, "textract", "y")]
    df = spark.createDataFrame(rows, "doc_id string, page_index int, route string, reason string")
    got = {r["doc_id"]: (r["route"], r["pages"], r["vlm_pages"], r["throttled_pages"], r["routes"], r["reason"]) for r in rollup.route_records(df).collect()}
    assert got == {"a": ("vlm-failed", 2, 1, 1, "docling-kept,vlm-fallback-docling", "throttled"), "b": ("textract-failed", 1, 0, 0, "textract-rejected-kept-docling", "r"), "c": ("docling-kept", 1, 0, 0, "docling-kept", None), "e": ("vlm", 2, 2, 0, "vlm,textract", "x")}
    with pytest.raises(Exception, match="unknown route label"):
        rollup.route_records(spark.createDataFrame([("a", 0, "drifted", None)], df.schema)).collect()
    totals = rollup.summary(rollup.route_records(df).select("doc_id", "route", "pages", "vlm_pages", "throttled_pages", "routes", "reason").unionByName(rollup.error_records(spark.createDataFrame([("z", "x" * 300)], "doc_id string, reason string"))))
    assert rollup.totals_line(totals).first()[0].startswith("Total: 5 docs / 6 pages | used VLM: 1 | vlm-failed: 1 | used Textract: 0 | textract-failed: 1 | docling-kept: 1 | errors: 1 | escalated pages: 3")


@pytest.mark.parametrize("budget", [None, 0.0, 5.0, 1e9])
def test_budget_like_sequential_spending(spark, budget):
    r = random.Random(5)
    costs = [float(r.randrange(4)) for _ in range(60)]
    got = {x["file_index"]: (x["escalate"], x["is_trip"]) for x in routing.budgeted(spark.createDataFrame(list(enumerate(costs)), "file_index long, cost double"), budget).collect()}
    spent, tripped = 0.0, False
    for k, c in enumerate(costs):
        may = budget is None or spent < budget
        spent += c if may else 0
        trip = budget is not None and may and spent >= budget
        assert got[k] == (may, trip and not tripped)
        tripped |= trip


def test_costs(spark):
    row = rollup.cost_summary(spark.createDataFrame([(2, 1), (None, 3)], "vlm_calls long, textract_calls long")).first()
    assert (row["vlm_cost"], row["textract_cost"], row["total_cost"]) == (0.0252, 0.076, 0.1012)
    assert rollup.cost_summary(spark.createDataFrame([], "vlm_calls long, textract_calls long")).first()["total_cost"] == 0.0


def test_reports_join_in_full(spark):
    metrics = spark.createDataFrame([("vlm", "a", 0.5), ("textract", "b", None)], "engine string, doc_id string, ned double")
    routes = spark.createDataFrame([("vlm", "a", "vlm"), ("vlm", "x", "error"), ("textract", "q", "docling-kept")], "engine string, doc_id string, route string")
    times = spark.createDataFrame([("vlm", "z", 3.0), ("vlm", "a", 1.0)], "engine string, doc_id string, latency double")
    got = {r["doc_id"]: (r["ned_vlm"], r["ned_textract"], r["route_vlm"], r["latency_vlm"]) for r in report.comparison(metrics, routes, times, ["vlm", "textract"]).collect()}
    assert got == {"a": (0.5, None, "vlm", 1.0), "b": (None, None, None, None)}
    totals = {r["engine"]: (r["graded"], r["promoted"], r["routed"], r["total_latency"]) for r in report.engine_totals(metrics, routes, times).collect()}
    assert totals == {"vlm": (1, 1, 2, 4.0), "textract": (1, 0, 1, None)}


def test_log_lines(spark):
    lines = ['INFO {"event": "file_parsed", "filename": "x"}', 'T {"event":"file_parsed","filename":"a.pdf","parse_duration_s":1.5}', "junk", 'T {"event":"file_parsed","filename":"a.docx","parse_duration_s":2.5} ', '{"event":"other","filename":"b.pdf","parse_duration_s":1}', '{"event":"file_pa']
    df = spark.createDataFrame(list(enumerate(lines)), "line_no long, value string")
    assert [tuple(r) for r in report.file_latencies(df).where("parse_duration_s IS NOT NULL").collect()] == [("a", 2.5)]


def test_html_malformed():
    got = html_elements("<title>t</title><h1>A<p>one <b>two<li>x<li>y<script>no()</script><table><tr><th>h<th>i<tr><td colspan=2>c</table><img alt='pic'>")
    assert [(t, x) for t, x, *_ in got] == [("heading", "A"), ("paragraph", "one two"), ("list_item", "x"), ("list_item", "y"), ("table", ""), ("figure", "")]
    assert got[4][3]["rows"] == 2 and got[4][3]["cols"] == 2 and got[4][3]["header_rows"] == 1 and html_elements(None) == []


def test_engine_replies_end_to_end(spark):
    pages = spark.createDataFrame([("d", 0, "pdf", "own", 1, True, PROMOTE), ("d", 1, "pdf", "own text", 1, True, PROMOTE), ("d", 2, "pdf", "kept text", 1, True, KEEP)], PAGE)

    def client():
        def call(row):
            if row["page_index"]:
                raise RuntimeError("forbidden")
            return '{"elements":[{"type":"heading","text":"Engine title","level":2},{"type":"paragraph","text":"Some fine words"}]}'
        return call

    out = parse_documents(pages, lambda p: read_replies(engine_results(p, client)))
    assert [(r["route"], r["markdown_out"]) for r in out.pages.orderBy("page_index").collect()] == [("vlm", "## Engine title\n\nSome fine words"), ("vlm-fallback-docling", "own text"), ("docling-kept", "kept text")]
    assert {r["code"] for r in out.warnings.collect()} == {"vlm_promoted", "vlm_fallback_docling", "low_confidence_page"}


def test_an_engine_is_asked_once_a_page(spark, tmp_path):
    rows = [("d", 0, "pdf", "", 0, "promote_to_vlm"), ("d", 1, "pdf", "own text", 1, "promote_to_vlm"), ("e", 0, "pdf", "kept", 1, "keep"), (None, 0, "pdf", "no id", 1, "keep")]
    pages = spark.createDataFrame(rows, "doc_id string, page_index int, kind string, markdown string, n_elements int, action string")
    pages = pages.selectExpr("*", "struct(action, 'why' AS reason, 1 AS layer) AS decision", "true AS passes", "NULL AS untyped")

    def engine(promoted):
        def run(batches):
            for b in batches:
                for k in range(len(b)):
                    (tmp_path / f"{b['doc_id'][k]}-{b['page_index'][k]}-{uuid.uuid4().hex}").touch()
                n = len(b)
                yield b[["doc_id", "page_index"]].assign(error=None, error_kind=None, valid_shape=[True] * n, n_engine_elements=1, engine_markdown="told", engine_passes=[True] * n)

        return promoted.select("doc_id", "page_index").mapInPandas(run, RESULTS)

    out = parse_documents(pages, engine)
    assert out.pages.count() == 4 and out.warnings.count() == 2 and out.routes.count() == 3
    assert {r["doc_id"]: (r["markdown"], r["confidence"]) for r in out.documents.collect()} == {"d": ("told\n\ntold", 0.85), "e": ("kept", 0.95), None: ("no id", 0.95)}
    assert len(list(tmp_path.iterdir())) == 2


def test_files_round_trip(spark, tmp_path):
    for name, data in (("a.HTML", b"<p>hi"), ("b.txt", b"x"), ("c.pdf", b"1" * 3000)):
        (tmp_path / name).write_bytes(data)
    assert [r["filename"] for r in files.listed_files(spark, str(tmp_path)).collect()] == ["a.HTML", "c.pdf"]
    assert [r["path"].rsplit("/", 1)[1] for r in files.contents(spark, str(tmp_path), 0.001).collect()] == ["a.HTML"]
    got = {r["path"].rsplit("/", 1)[1]: r["rejection"] for r in files.admitted(files.listed_files(spark, str(tmp_path)), 0.001).collect()}
    assert got == {"a.HTML": None, "c.pdf": "input_too_large"}
    out = files.write_each(spark.createDataFrame([("x", "text é")], "doc_id string, markdown string"), f"file://{tmp_path}/out").collect()
    assert out[0]["bytes"] == 7 and (tmp_path / "out/x.md").read_text() == "text é"
    (tmp_path / "res").mkdir()
    (tmp_path / "res/d.json").write_text('{"markdown":"m","page_routes":[{"page_index":0,"route":"vlm","n_chars":3}]}')
    (tmp_path / "res/bad.json").write_text("{oops")
    (tmp_path / "res/failures.json").write_text("{}")
    good, skipped = files.read_results(spark, str(tmp_path / "res"))
    assert [(r["doc_id"], r["route"]) for r in good.collect()] == [("d", "vlm")] and [r["why"] for r in skipped.collect()] == ["bad_json"]
    records = rollup.route_records(good.select("doc_id", "page_index", "route", "reason"))
    files.write_route_csv(records, str(tmp_path / "csv"))
    assert [tuple(r) for r in files.read_route_csv(spark, str(tmp_path / "csv")).collect()] == [("d", "vlm")]


def test_empty_tables(spark):
    none = spark.createDataFrame([], ELEMENT)
    assert render.page_markdown(none).count() == quality.page_texts(none).count() == 0
    assert layout.reconciled(spark.createDataFrame([], "page int, pos long, left double, top double, width double")).count() == 0
    assert routing.budgeted(spark.createDataFrame([], "file_index long, cost double"), 1.0).count() == 0
    assert from_html(spark.createDataFrame([], "doc_id string, html string")).count() == 0


def test_all_routes_have_a_place(spark):
    df = spark.createDataFrame([(r, k, r, None) for k, r in enumerate(ROUTES)], "doc_id string, page_index int, route string, reason string")
    assert rollup.route_records(df).count() == 7


def test_report_lines_stand_under_their_heads(spark):
    df = spark.createDataFrame([("d" * 40, "vlm", 12, 3, "vlm," * 9, "why " * 30), ("e", "error", 0, 0, "-", None)], "doc_id string, route string, pages long, vlm_pages long, routes string, reason string")
    lines = [r["line"] for r in rollup.format_lines(df).orderBy("doc_id").collect()]
    head = rollup.report_header()
    assert head.index("pages") + 5 == lines[0].index("12") + 2 and head.index("vlm_pg") + 6 == lines[0].index(" 3 ") + 2 and head.index("reason") == lines[0].index("why")
    assert lines[1] == "e" + " " * 36 + "error" + " " * 8 + "    0      0 -" + " " * 22


def test_two_places_like_correct_rounding(spark):
    """Every ratio below 2 with a divisor up to 400: halfway cases go by the double's own error, exact ones to the even digit."""
    pairs = [(n, d) for d in range(1, 401) for n in range(2 * d)]
    df = spark.createDataFrame(pairs, "n long, d long").select("n", "d", quality.two_places(F.col("n"), F.col("d")).alias("t"))
    assert [(r["n"], r["d"], r["t"]) for r in df.collect() if r["t"] != f"{r['n'] / r['d']:.2f}"] == []


def test_reasons_have_values(spark):
    pages = spark.createDataFrame([("d", 0, "a1 b2 c3", 3), ("d", 1, "a b c ........", 4)], "doc_id string, page_index int, page_text string, extracted_tokens long")
    got = {r["page_index"]: r["decision"]["reason"] for r in quality.gated(pages).collect()}
    assert got == {0: "heuristic_failed: garbled_token_ratio=1.00, dict_hit_rate=0.00", 1: "heuristic_failed: repeated_char_run"}


def test_boxes_of_a_page_are_dealt_once(spark):
    df = spark.createDataFrame([(1, k, 0.05 + 0.4 * (k % 2), k / 8, 0.9 if k == 3 else 0.25) for k in range(8)], "page int, pos long, left double, top double, width double")
    out = layout.reconciled(df)
    assert "Join" not in (plan := out._jdf.queryExecution().executedPlan().toString()) and plan.count("Exchange hashpartitioning") == 1
    assert sorted(r["place"] for r in out.collect()) == list(range(8))


def test_blocks_of_a_graph_are_made_once(spark):
    rows = [("d", "b", 0, "LAYOUT_TEXT", None, ["l"], None), ("d", "l", 1, "LINE", "x", [], None)]
    df = spark.createDataFrame(rows, "doc_id string, id string, pos int, block_type string, text string, children array<string>, selected boolean")
    out = layout.elements(df.withColumn("text", F.when(F.col("text").isNotNull(), F.expr("uuid()"))))
    assert "uuid(" not in out._jdf.queryExecution().optimizedPlan().toString() and [r["type"] for r in out.collect()] == ["paragraph"]


def test_pages_of_texts_are_read_and_dealt_once(spark, tmp_path):
    spark.createDataFrame([(k, "one two\n\n three\nx1\nlast") for k in range(30)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = catalog.pages_of(spark, str(tmp_path))
    assert "Join" not in (plan := out._jdf.queryExecution().executedPlan().toString()) and plan.count("FileScan") == plan.count("Exchange hashpartitioning") == 1
    got = {(r["doc_id"], r["page_index"]): (r["low_grade"], r["mean_grade"], r["text_layer_tokens"]) for r in out.collect()}
    assert len(got) == 60 and got["7", 1] == ("POOR", None, None) and got["13", 0] == ("good", None, 13) and got["22", 0] == (None, "fair", 22)


def test_a_page_is_made_of_one_list(spark):
    r = random.Random(5)
    texts = [None, "", " ", "a b", " a b ", "x\ty", "Z"]
    rows = [(f"d{r.randrange(9)}", r.randrange(2), r.choice([None, 0, 0, 1, 2, 3]), r.choice(["paragraph", "heading", "footer", "list_item", "odd"]), r.choice(texts), 2, None) for _ in range(200)]
    elements = spark.createDataFrame(rows, ELEMENT)
    key = lambda df: {(p["doc_id"], p["page_index"]): tuple(p[c] for c in ("markdown", "page_text")) for p in df.collect()}
    assert key(render.page_both(elements)) == key(render.page_markdown(elements, quality.page_text()))


def test_texts_are_not_dealt_out_for_routes(spark):
    pages = spark.createDataFrame([(str(k), 0, "pdf", "own", 1, True, PROMOTE) for k in range(9)], PAGE)
    out = parse_documents(pages, lambda p: p.selectExpr("doc_id", "page_index", "NULL AS error", "NULL AS error_kind", "true AS valid_shape", "1 AS n_engine_elements", "'told' AS engine_markdown", "true AS engine_passes"))
    routes = out.pages.select("doc_id", "route", "n_chars")
    read = [x for x in routes._jdf.queryExecution().executedPlan().toString().split("FileScan")[1:] if "planned-pages" in x]
    assert len(read) == 1 and ",markdown" not in read[0].split("]")[0] and {tuple(r)[1:] for r in routes.collect()} == {("vlm", 4)}


def test_blocks_of_tables_are_made_and_dealt_once(spark, tmp_path):
    lines = [(k, 10 * k + n, n % 3 + 1, "AN"[n % 2]) for k in range(40) for n in range(4)] + [(40, 5, None, "A")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = catalog.cell_grid(spark, str(tmp_path))
    assert "Join" not in (plan := out._jdf.queryExecution().executedPlan().toString()) and plan.count("FileScan") == plan.count("Exchange hashpartitioning") == 1
    got = {r["doc_id"]: tuple(r)[1:] for r in out.collect()}
    assert len(got) == 41 and got[2] == (3, 1, 1, "0:A [X],1:N [ ],2:A [X]") and got[40] == (0, 0, 0, None)


def python_tables(rows):
    """Each document's tables, block by block."""
    out, docs = [], {}
    for r in rows:
        docs.setdefault(r["doc_id"], {})[r["id"]] = r
    for d, by_id in docs.items():
        kids = lambda b: [by_id[k] for k in b["children"] or [] if k is not None and k in by_id and d is not None]
        for t in (b for b in by_id.values() if b["block_type"] == "TABLE"):
            cells = []
            for c in (c for c in kids(t) if c["block_type"] == "CELL"):
                words = [w["text"] if w["block_type"] == "WORD" else "[X]" if w["selected"] else "[ ]" for w in kids(c) if w["block_type"] in ("WORD", "SELECTION_ELEMENT")]
                n = {f: 1 if c[f] is None else c[f] for f in ("row", "col", "row_span", "col_span")}
                cells.append((n["row"] - 1, n["col"] - 1, " ".join(w for w in words if w), max(n["row_span"], 1), max(n["col_span"], 1), "COLUMN_HEADER" in (c["entity_types"] or [])))
            heads = len({c[0] for c in cells if c[5]})
            out.append((d, t["id"], max((c[0] + c[3] for c in cells), default=0), max((c[1] + c[4] for c in cells), default=0), max(heads, 1) if cells else 0, [c[:5] for c in cells] or None))
    return sorted(out, key=repr)


def test_tables_like_a_walk_of_each_document(spark):
    r = random.Random(7)
    kinds, number = ["TABLE", "CELL", "CELL", "WORD", "WORD", "SELECTION_ELEMENT", "LINE", "PAGE", None], lambda: r.choice([None, -1, 0, 1, 2, 3])
    rows = []
    for d in [None, *(f"d{k}" for k in range(40))]:
        ids = [f"i{k}" for k in range(r.randrange(1, 25))]
        for pos, i in enumerate(ids):
            kids = None if r.random() < 0.1 else [r.choice([*ids, "gone", None]) for _ in range(r.randrange(6))]
            rows.append((d, i, pos, r.choice(kinds), r.choice([None, "", "x", "é z"]), kids, number(), number(), number(), number(), r.choice([None, [], ["COLUMN_HEADER"], ["X", "COLUMN_HEADER"]]), r.choice([None, True, False])))
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id string, id string, pos int, block_type string, text string, children array<string>, row int, col int, row_span int, col_span int, entity_types array<string>, selected boolean")
    got = [(*tuple(t)[:5], t["cells"] and [tuple(c) for c in t["cells"]]) for t in layout.tables(df).collect()]
    assert sorted(got, key=repr) == python_tables([x.asDict() for x in df.collect()]) and layout.tables(df.limit(0)).count() == 0


def test_batches_are_joined_to_whole_documents():
    r = random.Random(9)
    for _ in range(60):
        docs = sorted((r.randrange(r.choice([1, 4, 30])) for _ in range(r.randrange(80))), reverse=r.random() < 0.5)
        docs = [None if d == 0 else f"d{d}" for d in docs]
        cuts = sorted(r.randrange(len(docs) + 1) for _ in range(r.randrange(12)))
        batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array(docs[a:b], pa.string()), "n": pa.array(range(a, b), pa.int64())}) for a, b in zip([0, *cuts], [*cuts, len(docs)])]
        out = list(layout.whole_documents(iter(batches), 10))
        assert [n for t in out for n in t["n"].to_pylist()] == list(range(len(docs)))
        assert len({d for t in out for d in set(t["doc_id"].to_pylist())}) == sum(len(set(t["doc_id"].to_pylist())) for t in out)
        most = max([docs.count(d) for d in docs], default=0)
        assert all(len(t) < 10 + most + max(b.num_rows for b in batches) for t in out)


def python_elements(rows):
    """Elements of documents without boxes, block by block."""
    out, docs = [], {}
    for r in rows:
        docs.setdefault(r["doc_id"], {})[r["id"]] = r
    for d, by_id in docs.items():
        blocks = sorted(by_id.values(), key=lambda b: b["pos"])
        kids = lambda b, *kinds: [by_id[k] for k in b["children"] or [] if k in by_id and by_id[k]["block_type"] in kinds]
        layouts = [b for b in blocks if (b["block_type"] or "").startswith("LAYOUT_")]
        laid = {k["id"]: k for p in blocks if p["block_type"] == "PAGE" for k in kids(p, "LAYOUT_TEXT", "LAYOUT_TABLE", "LAYOUT_TITLE")}
        found, held = [], set()
        for b in laid.values() or layouts:
            lines = "\n".join(x["text"] for x in kids(b, "LINE") if x["text"])
            words = [w["text"] if w["block_type"] == "WORD" else "[X]" if w["selected"] else "[ ]" for w in kids(b, "WORD", "SELECTION_ELEMENT")]
            table = next((t["id"] for t in kids(b, "TABLE")), None) if b["block_type"] == "LAYOUT_TABLE" else None
            if table is not None:
                held.add(table)
                found.append(("table", None, "", table))
            elif b["block_type"] != "LAYOUT_TABLE" and (text := lines or " ".join(w for w in words if w)):
                found.append(("heading", 1, text, None) if b["block_type"] == "LAYOUT_TITLE" else ("paragraph", None, text, None))
        found += [("table", None, "", b["id"]) for b in blocks if b["block_type"] == "TABLE" and b["id"] not in held]
        out += [(d, k, *f) for k, f in enumerate(found)]
    return sorted(out, key=repr)


def test_elements_like_a_walk_of_each_document(spark):
    r = random.Random(11)
    kinds = ["PAGE", "LAYOUT_TEXT", "LAYOUT_TABLE", "LAYOUT_TITLE", "LINE", "LINE", "WORD", "SELECTION_ELEMENT", "TABLE", "CELL", None]
    rows = []
    for d in range(60):
        ids = [f"i{k}" for k in range(r.randrange(1, 25))]
        rows += [(f"d{d}", i, pos, r.choice(kinds), r.choice([None, "", "x", "é z"]), None if r.random() < 0.1 else [r.choice([*ids, "gone", None]) for _ in range(r.randrange(6))], r.choice([None, True, False])) for pos, i in enumerate(ids)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id string, id string, pos int, block_type string, text string, children array<string>, selected boolean")
    out, columns = layout.elements(df), ["doc_id", "seq", "type", "level", "text", "table_id"]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    want = python_elements([x.asDict() for x in df.collect()])
    assert sorted((tuple(x) for x in out.select(columns).collect()), key=repr) == want
    # in a given order, only what it names is laid out
    order = df.where("block_type LIKE 'LAYOUT%'").selectExpr("doc_id", "id", "-pos AS place")
    got = [tuple(x) for x in layout.elements(df, order).where("type <> 'table'").select("doc_id", "text").collect()]
    assert len(got) >= len([x for x in want if x[2] != "table"])
    none = layout.elements(df, order.limit(0)).select("doc_id", "type", "table_id").collect()
    assert sorted(tuple(x) for x in none) == sorted((x[0], "table", x[1]) for x in rows if x[3] == "TABLE")
