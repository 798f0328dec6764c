"""Column expressions against plain Python, on texts that the test tables don't have."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quire import constants
from quire.functions import errors, media, text as tx
from quire.operators import quality, report
from quire.sources.extractors import retried, transient

TEXTS = [
    "", "   ", "\x1c\x1d", "plain words here", "a1 b2 c d", "x9y z", "aaaaaa", "aaaaaaa", "\r" * 7, "\n" * 7, "\xa0" * 8, "é é é", "¹ ② 3", "(12.5%) $3,000 -7",
    "a\x1cb\x1fc", "tab\tand\nline", "emoji 😀😀 x", "​zero", "private", "one two", "，。", "ends. with, marks!", "A1" * 30, None,
]


def python_counts(t):
    t = t or ""
    words = t.split()
    clean = lambda w: w.strip("()[].,%$:/+-").replace(",", "").replace(".", "").replace("/", "")
    adjacent = lambda w: any((x.isascii() and x.isalpha() and y.isdecimal()) or (x.isdecimal() and y.isascii() and y.isalpha()) for x, y in zip(w, w[1:]))
    run = any(len(set(t[k : k + 7])) == 1 and t[k] != "\n" for k in range(len(t) - 6))
    content = sum(w.isalpha() or (clean(w) != "" and clean(w).isdigit()) for w in words)
    return (len(words), sum(map(adjacent, words)), sum(map(len, words)), content, run, sum(c.isprintable() for c in t), len(t))


def test_text_counts(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, text string").withColumn("c", quality.text_counts(F.col("text")))
    for r in df.collect():
        assert tuple(r["c"]) == python_counts(TEXTS[r["k"]]), repr(TEXTS[r["k"]])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="aZé1²9 .,%()\n\t\x1c\xa0😀-", max_size=30), min_size=1, max_size=40))
def test_text_counts_property(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string").withColumn("c", quality.text_counts(F.col("text")))
    for r in df.collect():
        assert tuple(r["c"]) == python_counts(texts[r["k"]]), repr(texts[r["k"]])


@pytest.mark.parametrize("n_bad, n, fails", [(2, 10, False), (3, 10, True)])
def test_ratio_boundaries_are_strict(spark, n_bad, n, fails):
    text = " ".join(["ab1cd"] * n_bad + ["word"] * (n - n_bad))
    row = quality.with_signals(spark.createDataFrame([(text,)], "text string")).first()
    assert ("garbled_token_ratio" in row["signals"]["failing_signals"]) == fails


def test_blank_text_fails_as_empty(spark):
    rows = quality.with_signals(spark.createDataFrame([("",), (" \n",), (None,)], "text string")).collect()
    assert all(r["signals"]["failing_signals"] == ["empty_text"] and not r["passes"] and r["signals"]["garbled_token_ratio"] == 0 for r in rows)


def test_strip_like_python(spark):
    texts = [" \xa0a　", "\x1cb\x1f", "c​", "", "  d e \x85"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(tx.strip(F.col("t"))).collect()]
    assert got == [t.strip() for t in texts]


@pytest.mark.parametrize("path, kind, listed", [
    ("/a/B.PDF", "pdf", True), ("s3://b/x.JpG", "image", True), ("x.webp", "image", False), ("y.xlsm", "xlsx", True), ("z.htm", "html", True), ("n", "unknown", False), ("a.tar.gz", "unknown", False),
])
def test_kinds(spark, path, kind, listed):
    row = spark.createDataFrame([(path,)], "p string").select(media.kind_of(F.col("p")), media.is_listed(F.col("p"))).first()
    assert tuple(row) == (kind, listed)


def test_kind_by_mime_and_sniffing(spark):
    df = spark.createDataFrame([("x", "Text/HTML", bytearray(b"GIF89a")), ("x", "image/x-odd", bytearray(b"RIFF1234WEBP")), ("x", None, bytearray(b"\xff\xd8\xff"))], "p string, m string, c binary")
    assert [tuple(r) for r in df.select(media.kind_of(F.col("p"), F.col("m")), media.sniffed(F.col("c"))).collect()] == [("html", "image/gif"), ("image", "image/webp"), ("unknown", "image/jpeg")]


def test_stems_and_size_cap(spark):
    df = spark.createDataFrame([("/in/a.tar.gz", 10), ("/in/.hidden", 2_000_000), ("b", None)], "p string, n long")
    assert [tuple(r) for r in df.select(tx.stem(F.col("p")), media.too_large(F.col("n"), 1), media.too_large(F.col("n"), 0)).collect()] == [("a.tar", False, False), (".hidden", True, False), ("b", False, False)]


@pytest.mark.parametrize("code, status, message, passing", [
    ("ThrottlingException", None, "access denied", True), ("ValidationException", 503, "", False), (None, 503, "page 404", False), (None, 429, "", True), (None, 408, "", True),
    (None, 403, "timeout", False), (None, 500, "", True), (None, None, "Read timed out", True), (None, None, "odd", False), ("Other", None, "got 502 back", True), (None, None, None, False),
])
def test_transient(spark, code, status, message, passing):
    df = spark.createDataFrame([(code, status, message)], "c string, s int, m string")
    assert df.select(errors.is_transient(F.col("c"), F.col("s"), F.col("m"))).first()[0] == passing == transient(code, status, message or "")


def test_retry_stops_at_permanent_errors_and_waits_for_passing_ones():
    waits, calls = [], []

    def fails(message):
        def call():
            calls.append(message)
            raise RuntimeError(message)
        return call

    assert retried(fails("rate limit"), sleep=waits.append)["error_kind"] == "throttled" and len(calls) == 3 and len(waits) == 2 and all(0 < w <= 30 for w in waits)
    calls.clear()
    assert retried(fails("forbidden"), sleep=waits.append)["error_kind"] == "permanent" and len(calls) == 1
    assert retried(lambda: {"reply": "x"}) == {"reply": "x"}


def test_replies(spark):
    good = '{"elements":[{"type":"heading","text":"T","level":2}]}'
    replies = [good, f"```json\n{good}\n```", good + " tail", "", None, '{"error":"busy"}']
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(replies)], "k int, r string").select("k", errors.parsed_reply(F.col("r")).alias("p")).orderBy("k").collect()
    assert [r["p"]["error"] for r in rows] == [None, None, "invalid_json", "invalid_json", "invalid_json", None]
    assert rows[1]["p"]["value"]["elements"][0]["text"] == "T" and rows[5]["p"]["value"]["error"] == "busy"


@pytest.mark.parametrize("w, h, scale, most, want, clamped", [(100.0, 100.0, 2.0, 40_000.0, 2.0, False), (100.0, 100.0, 4.0, 40_000.0, 2.0, True), (0.0, 9.0, 2.0, 1.0, 2.0, False), (10.0, 10.0, 2.0, 0.0, 2.0, False)])
def test_scale_clamp(spark, w, h, scale, most, want, clamped):
    got = spark.range(1).select(media.clamped_scale(F.lit(w), F.lit(h), F.lit(scale), most).alias("c")).first()["c"]
    assert (round(got["scale"], 9), got["clamped"]) == (want, clamped)


def test_pixel_box(spark):
    box = lambda *a: tuple(spark.range(1).select(media.pixel_box(*(F.lit(float(x)) for x in a)).alias("b")).first()["b"])
    assert box(10, 20, 30, 60, 100, 2, 200, 200) == (20, 80, 60, 160, True)
    assert box(300, 20, 400, 60, 100, 2, 200, 200)[4] is False


def test_similarities(spark):
    df = spark.createDataFrame([("a  b", "a b"), ("", None), ("kitten", "sitting"), ("b a", "a b")], "x string, y string")
    rows = df.select(report.ned_similarity(F.col("x"), F.col("y")), report.unordered_ned(F.col("x"), F.col("y")), report.word_containment(F.col("x"), F.col("y"))).collect()
    assert [round(r[0], 4) for r in rows] == [1.0, 1.0, round(1 - 3 / 7, 4), round(1 - 2 / 3, 4)] and rows[3][1] == 1.0 and [r[2] for r in rows] == [1.0, 1.0, 0.0, 1.0]


def test_vocabularies_agree():
    assert set(constants.EXTRACTOR_TYPES.values()) | set(constants.LAYOUT_TYPES.values()) <= set(constants.ELEMENT_TYPES)
    assert len(constants.ROUTES) == len(set(constants.ROUTES)) == 7 and set(constants.LISTED_SUFFIXES) == set(constants.KIND_BY_SUFFIX) - {".webp"}
    assert all(constants.KIND_BY_MIME.get(m, "image") == constants.KIND_BY_SUFFIX[s] for s, m in constants.MIME_BY_SUFFIX.items())


def test_markdown_takes_the_counts_of_a_page_text_with_the_same_tokens(spark):
    rows = [(k, t, t if k % 2 else t.replace(" ", "\n\n")) for k, t in enumerate(["plain words a1 (12.5%)", "x" * 9, "a b 3 é3", "", "a\x1cb c", "       a"])] + [(9, "a b", "# a c1"), (10, "a", None)]
    df = spark.createDataFrame(rows, "k int, page_text string, markdown string")
    known = quality.with_signals(df, "page_text")
    got = {r["k"]: (tuple(r["counts"]), r["passes"]) for r in quality.with_signals(known, "markdown", like="page_text").collect()}
    assert {k: c for k, (c, _) in got.items()} == {k: python_counts(m) for k, _, m in rows}
    assert {k: p for k, (_, p) in got.items()} == {r["k"]: r["passes"] for r in quality.with_signals(df, "markdown").collect()}


def test_pages_are_split_into_tokens_once(spark):
    from quire.plans.parse import measured_pages
    from quire.sources.extractors import from_lines

    pages = measured_pages(from_lines(spark.createDataFrame([("d", "one two\n\n three\x1cfour\nx1")], "doc_id string, text string")))
    assert pages.first()["extracted_tokens"] == 5
    before = pages._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [doc_id")[-1]
    assert r"\p{IsWhite_Space}]+" not in before and "split(text" in before  # lines aren't split into tokens besides


def test_white_space_like_python(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    assert sorted(spaces) == sorted(tx.SPACES)
    texts = [f"{s}a{s}b{s}{s}" for s in spaces] + ["a​b", "c᠎d"]
    for t, words, own in spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.tokens(F.col("t")), tx.strip(F.col("t"))).collect():
        assert words == t.split() and own == t.strip(), repr(t)
