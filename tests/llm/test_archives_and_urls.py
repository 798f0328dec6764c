"""WARC archives as exact round trips, URL filters against brute force."""

import base64
import hashlib
import io
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import url_filter as uf, warc

from .helpers import SF, table

PAGES = "page_id long, url string, html string"


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def brute_records(pages):
    first = {}
    for p in pages:
        data = (p["html"] or "").encode()
        first[data] = min(first.get(data, p["page_id"]), p["page_id"])
    out = {}
    for p in pages:
        data = (p["html"] or "").encode()
        revisit = first[data] != p["page_id"]
        out[p["page_id"]] = (len(data), sha(data), "revisit" if revisit else "response", first[data] if revisit else None)
    return out


def test_whole_table(spark):
    got = {r["page_id"]: tuple(r)[1:] for r in warc.op3_warc(spark, SF).collect()}
    assert got == brute_records(table("pages"))


def test_payloads_round_trip_in_chunks(spark, tmp_path):
    rows = [(1, "http://a/", "é" * 50_000), (2, None, None), (3, "http://b/ x\n", ""), (4, "http://c/", "é" * 50_000), (5, "u", "WARC/1.1\r\n\r\nWARC-Type: x\r\n\r\n"), (6, "u", "x" * 4096)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("kind", F.lit("clash")).withColumn("digest", F.lit("clash"))
    folder = f"file://{tmp_path}/w"
    manifest = warc.written(warc.chunks_of(pages, 1024), folder, archive=512)
    assert manifest.agg(F.sum("records")).first()[0] == 6 and manifest.count() >= 2
    data = {}
    for r in warc.read_chunks(manifest, folder, 1024).orderBy("page_id", "chunk_no").collect():
        got = data.setdefault(r["page_id"], [b"", r["kind"], None])
        assert len(r["data"]) <= 1024
        got[0] += bytes(r["data"])
        if r["kind"] == "response":  # digests run along
            assert r["bytes_so_far"] == len(got[0]) and bytes(r["sha1_so_far"]) == hashlib.sha1(got[0]).digest()
    assert {k: (v[0].decode(), v[1]) for k, v in data.items()} == {1: ("é" * 50_000, "response"), 2: ("", "response"), 3: ("", "revisit"), 4: ("", "revisit"), 5: (rows[4][2], "response"), 6: ("x" * 4096, "response")}


def test_members_are_plain_gzip_records():
    head = warc.record_head(7, "http://a/", sha(b"hi"), 2, None, "response", "2024-01-01T00:00:00Z")
    member = zlib.compressobj(9, zlib.DEFLATED, 31)
    raw = member.compress(head + b"hi\r\n\r\n") + member.flush()
    assert [(r[0], r[5], r[8]) for r in warc.read_records(io.BytesIO(raw * 2))] == [(7, b"hi", True)] * 2
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(raw[: len(raw) // 2])))


def test_null_and_repeated_ids(spark):
    rows = [(None, "u", "a"), (None, "u", "a"), (3, "u", "a"), (3, "u", "a"), (None, "u", "b"), (None, "u", "b")]
    got = sorted(((r["page_id"], r["kind"], r["refers_to"]) for r in warc.archived(spark.createDataFrame(rows, PAGES)).collect()), key=repr)
    assert got == sorted([(3, "response", None)] * 2 + [(None, "revisit", 3)] * 2 + [(None, "response", None)] * 2, key=repr)
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0


def brute_verdict(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: next((k for k, c in enumerate(path) if c in "?#"), len(path))]
    for what, rule in sorted(uf.RULES, key=lambda x: -len(x[1])):
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            return host, path, rule, what
    bare = host.rpartition("@")[2]
    bare = bare.removeprefix("www.").partition(":")[0].rstrip(".")
    labels = bare.split(".") if bare else []
    hit = any(".".join(labels[k:]) + "/" + "".join(f"{s}/" for s in path.split("/")[1:][:n] ) in listed for k in range(len(labels)) for n in range(len(path.split("/")) - 1 or 1))
    return host, path, None, "block" if hit else "allow"


@pytest.mark.parametrize("most", [1, 1 << 20])  # a filter that lets nearly all pass changes nothing
def test_urls_like_brute_force(spark, most):
    r = random.Random(7)
    hosts = ["spam.org", "a.spam.org", "www.spam.org", "Shop.Net", "x.example.com", "www.example.com", "q.www.example.com", "deep.a.b.c.d.e.f.g.org", "notspam.org", "mine.org:8080", "com", ""]
    paths = ["", "/", "/en/", "/en/x", "/es/", "/fr/a?b", "/bad/x", "/bad/", "/bad", "/a/b/c/d/e/f/g/h/i", "#f", "?q=/bad/", "/a//b/"]
    urls = [f"{s}{h}{p}" for s in ("http://", "https://", "//", "odd://x://") for h in hosts for p in paths] + [None, "", "://", "no"]
    r.shuffle(urls)
    listed = ["spam.org/", "mine.org/bad/", "d.e.f.g.org/a/b/c/d/e/f/g/h/", "shop.net/bad/"] + [f"other{k}.org/" for k in range(500)]
    pages = spark.createDataFrame([(k, u, None) for k, u in enumerate(urls)], PAGES).withColumn("rule", F.lit("clash"))
    got = {x["page_id"]: (x["host"], x["path"], x["rule"], x["verdict"]) for x in uf.filtered(pages, spark.createDataFrame([(x,) for x in listed] + [(None,)], "entry string"), most=most).collect()}
    want = {k: brute_verdict(u, set(listed)) for k, u in enumerate(urls)}
    assert {k: (urls[k], got[k], want[k]) for k in want if got[k] != want[k]} == {}


def test_no_list_and_no_pages(spark):
    none = spark.createDataFrame([], "entry string")
    pages = spark.createDataFrame([(1, "http://a.org/", None), (1, "http://a.org/", None)], PAGES)
    assert [r["verdict"] for r in uf.filtered(pages, none).collect()] == ["allow"] * 2 and uf.filtered(pages.limit(0), none).count() == 0


def test_bloom_has_no_false_negatives():
    h = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000)
    block, words = uf.place(h, 64)
    bloom = np.zeros((64, 8), np.int64)
    np.bitwise_or.at(bloom, block, words)
    assert ((bloom[block] & words) == words).all()


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = con.execute(uf.OP7_SQL)
    names = [d[0] for d in want.description]
    assert sorted(map(repr, map(tuple, uf.op7_url_filter(spark, SF).select(*names).collect()))) == sorted(map(repr, want.fetchall()))
