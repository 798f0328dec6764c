"""The streaming forms, driven to completion by an available-now trigger."""

from pyspark.sql import functions as F

from quire.sources.extractors import from_html
from quire.streaming.ingest import event_counts, incoming, parsed_stream


def test_new_files_are_parsed_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a.html", "b.txt"):
        (tmp_path / "in" / name).write_text("<h1>T</h1>")
    parse = lambda batch: from_html(batch.where("rejection IS NULL").select(F.col("path").alias("doc_id"), F.col("content").cast("string").alias("html")))
    run = lambda: parsed_stream(incoming(spark, str(tmp_path / "in")), parse, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    run()
    (tmp_path / "in" / "c.html").write_text("<p>x")
    run()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["type"], r["text"]) for r in rows) == [("heading", "T"), ("paragraph", "x")]


def test_event_counts(spark):
    rows = [("2024-01-01 00:01:00", "a", 1.0), ("2024-01-01 00:04:59", "a", 2.0), ("2024-01-01 00:05:00", "a", 4.0)]
    events = spark.createDataFrame(rows, "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert sorted((r["n"], r["total"]) for r in event_counts(events).collect()) == [(1, 4.0), (2, 3.0)]
