import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quire.llm.packing import WordIds, best_fit, op1_best_fit_packing, pack_documents, packed, tokenizer_path

from .helpers import ODD, SF, docs_frame, table

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def words():
    return WordIds(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aéÉñßÀ 's.,!?#%*|)(\"<>|1 2\t\n\x0b́ªºİſΣς日ا“”—😀‍$&;:", max_size=25))
def test_cached_words_like_the_tokenizer(words, text):
    assert words.encode(text.encode()) == words.whole(text)


def test_small_cache_like_the_tokenizer():
    w = WordIds(PATH, most=3)
    text = "Every word, again and again; the cache is full. " * 3
    assert w.encode(text.encode()) == w.whole(text)


def test_whole_table_round_trip(spark, words):
    rows = op1_best_fit_packing(spark, SF).collect()
    ids = {r["doc_id"]: words.whole(r["text"] or "") + bytes(4) for r in table("documents", "doc_id", "text")}
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_bin.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces))) and sum(r["length"] for r in pieces) == len(ids[d]) // 4
        assert all(r["start"] == 2048 * r["piece"] and (r["length"] == 2048 or r is pieces[-1]) for r in pieces)
        assert all(zlib.crc32(ids[d][4 * r["start"] : 4 * (r["start"] + r["length"])]) == r["ids_crc32"] for r in pieces)
    for pieces in by_bin.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == [sum(p["length"] for p in pieces[:k]) for k in range(len(pieces))] and sum(r["length"] for r in pieces) <= 2048
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert len(by_bin) <= least + 2


@pytest.mark.parametrize("by", ["norm", "dot"])
@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 64), max_size=60), docs=st.integers(1, 6), attention=st.integers(64 * 64, 3 * 64 * 64))
def test_every_capacity_holds(by, lengths, docs, attention):
    x = np.array(lengths, np.int64)
    bins, offsets = best_fit(x, 64, docs, float(attention), by=by)
    for b in set(bins.tolist()):
        own = np.flatnonzero(bins == b)
        assert x[own].sum() <= 64 and len(own) <= docs and (x[own] ** 2).sum() <= attention
        order = own[np.argsort(offsets[own])]
        assert offsets[order].tolist() == [int(x[order[:k]].sum()) for k in range(len(order))]


def test_best_fit_takes_the_tightest_bin():
    bins, _ = best_fit(np.array([60, 50, 14, 4]), 64, 10, 1e9)
    assert bins[2] == bins[1] and bins[3] == bins[0]


def test_too_large_a_piece_is_refused(spark):
    pieces = spark.createDataFrame([(0, 0, 100)], "row long, piece int, length long")
    with pytest.raises(Exception, match="larger than a sequence"):
        packed(pieces, 1, tokens=64).collect()


def test_odd_rows(spark, words):
    docs = docs_frame(spark, ODD, ids=[None, None, 1, 1, 1, 2, 2, 3, 4, 5]).withColumn("sequence_id", F.lit("clash")).withColumn("row", F.lit("clash"))
    rows = pack_documents(docs, shard=4).collect()
    assert len({r["row"] for r in rows}) == len(ODD)
    assert sorted(b"".join(bytes(r["ids"]) for r in sorted(rows, key=lambda r: (r["row"], r["piece"])) if r["row"] == n) for n in {r["row"] for r in rows}) == sorted(words.whole(t or "") + bytes(4) for t in ODD)
    assert pack_documents(docs.limit(0)).count() == 0
