"""Records of a run, by file and as a whole, and its failures, on small frames with expectations worked out by hand."""

import json

from pyspark.sql import functions as F

from quire.operators import report, rollup, routing
from quire.plans.parse import measured_pages, page_cap_warnings
from quire.constants import Config, OCR_PAGE, PRICES, VLM_CALL
from quire.sources.extractors import from_lines

WARNED = "doc_id string, scope string, page_index int, element_id string, code string, message string"


def results(spark):
    records = spark.createDataFrame([("a", "vlm", 3, 2), ("b", "docling-kept", 1, 0), ("c", "error", 0, 0)], "doc_id string, route string, pages long, vlm_pages long")
    calls = spark.createDataFrame([("a", 2, 1), ("c", 5, 5)], "doc_id string, vlm_calls long, textract_calls long")
    texts = spark.createDataFrame([("a", "abcd"), ("b", "")], "doc_id string, markdown string")
    told = spark.createDataFrame([("a", "page", 0, None, "x", "m"), ("a", "page", 1, None, "x", "m"), ("c", "document", None, None, "y", "m")], WARNED)
    return rollup.file_results(records, calls, texts, told)


def test_file_results(spark):
    got = {r["doc_id"]: r for r in results(spark).collect()}
    assert [(k, got[k]["success"], got[k]["pages"], got[k]["vlm_calls"], got[k]["textract_calls"], got[k]["markdown_chars"], got[k]["warning_count"]) for k in "abc"] == [
        ("a", True, 3, 2, 1, 4, 2), ("b", True, 1, 0, 0, 0, 0), ("c", False, 0, 0, 0, 0, 1),
    ]
    assert got["a"]["cost"] == round(2 * VLM_CALL + OCR_PAGE, 6) and got["c"]["cost"] == 0


def test_batch_summary(spark):
    row = rollup.batch_summary(results(spark)).first()
    assert (row["total_files"], row["succeeded"], row["failed"], row["total_vlm_calls"], row["total_textract_calls"], row["total_pages"], row["vlm_routed_pages"], row["docs_using_vlm"], row["docs_docling_kept"]) == (3, 2, 1, 2, 1, 4, 2, 1, 1)
    assert row["estimated_cost"] == round(2 * VLM_CALL + OCR_PAGE, 6) and row["worst_cost"] == round(4 * PRICES["vlm"], 6)
    assert row["budget_exceeded"] is False and row["budget_tripped_at"] is None
    files = results(spark).withColumn("file_index", F.ascii("doc_id") - 97)
    tripped = rollup.batch_summary(routing.budgeted(files, VLM_CALL)).first()
    assert tripped["budget_exceeded"] is True and tripped["budget_tripped_at"] == 0
    empty = rollup.batch_summary(results(spark).where("false")).first()
    assert (empty["total_files"], empty["total_vlm_calls"], empty["estimated_cost"], empty["budget_exceeded"]) == (0, 0, 0.0, False)


def test_failures(spark):
    told = spark.createDataFrame([("a", "document", None, None, "y", "n"), ("a", "document", None, None, "x", "m"), ("a", "page", 1, None, "x", "m"), ("a", "page", 1, None, "z", None)], WARNED)
    got = [(r["scope"], r["page_index"], [w["code"] for w in json.loads(r["warnings"])]) for r in rollup.failure_entries(told).collect()]
    assert sorted(got, key=str) == [("document", None, ["x", "y"]), ("page", 1, ["x"]), ("page", 1, ["z"])]
    row = rollup.failures(told).first()
    assert [w["code"] for w in json.loads(row["document_failures"])] == ["x", "y"] and len(json.loads(row["page_failures"])) == 2
    assert rollup.failure_entries(told.where("false")).count() == 0


def test_page_cap(spark):
    elements = from_lines(spark.createDataFrame([("a", "\n".join("word" for _ in range(14))), ("b", "x")], "doc_id string, text string"))
    assert sorted(r["page_index"] for r in measured_pages(elements, config=Config(max_pages=2)).where("doc_id = 'a'").collect()) == [0, 1]
    (row,) = page_cap_warnings(elements, 2).collect()
    assert (row["doc_id"], row["page_index"], row["scope"], row["code"]) == ("a", 2, "page", "page_unparseable") and "2 pages" in row["message"]


def test_label_comparison(spark):
    told = spark.createDataFrame([("m2", "a", 0.5), ("m1", "a", 0.25), ("m2", "b", None)], "label string, doc_id string, ned double")
    routes = spark.createDataFrame([("m2", "a", "vlm"), ("m1", "a", None), ("m1", "c", "vlm")], "label string, doc_id string, route string")
    got = {r["doc_id"]: (r["route"], r["ned_m1"], r["ned_m2"]) for r in report.label_comparison(told, routes, ["m1", "m2"]).collect()}
    assert got == {"a": ("vlm", 0.25, 0.5), "b": (None, None, None)}


def test_table_crops(spark):
    shape = "struct<rows:int,cols:int,cells:string>"
    elements = spark.createDataFrame([("d", "1", "table", (1, 1, "own")), ("d", "2", "table", (1, 1, "own")), ("d", "3", "table", None), ("d", "4", "paragraph", None)], f"doc_id string, element_id string, type string, content {shape}")
    crops = spark.createDataFrame([("d", "1", (2, 2, "crop")), ("d", "2", (2, None, "crop")), ("d", "4", (2, 2, "crop"))], f"doc_id string, element_id string, content {shape}")
    got = {r["element_id"]: (r["content"] and r["content"]["cells"], r["warning"]) for r in routing.table_crops(elements, crops).collect()}
    assert got == {"1": ("crop", None), "2": ("own", "vlm_table_fallback"), "3": (None, None), "4": (None, None)}
