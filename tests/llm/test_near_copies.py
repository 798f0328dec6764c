"""The pipeline's near-copies against all pairs of shingle sets."""

import random

import corpus_pipeline
import pytest

from quire.llm.near_copies import bands, shingles
from quire.llm.simhash import fingerprint, links

from .helpers import SF, docs_frame, table


def brute_pairs(texts, similar=0.8):
    """All pairs (i, j), i < j, of at least that Jaccard similarity of distinct five-word shingles."""
    sets, holders, pairs = [], {}, []
    for j, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        own = {b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
        both = {}
        for s in own:
            for i in holders.get(s, ()):
                both[i] = both.get(i, 0) + 1
        pairs += [(i, j) for i, n in both.items() if n >= similar * (len(own) + len(sets[i]) - n) - 1e-9]
        for s in own:
            holders.setdefault(s, []).append(j)
        sets.append(own)
    return pairs


def edited(words, r, changes):
    out = list(words)
    for k in range(changes):
        out[(2 * k + 1) * len(out) // (2 * changes)] = f"edit{r.random()}"
    return " ".join(out)


def test_edited_copies_go_and_others_stay(spark):
    r = random.Random(7)
    texts = []
    for _ in range(20):
        words = [f"w{r.randrange(5000)}" for _ in range(300)]
        texts += [" ".join(words), edited(words, r, 5), edited(words, r, 20)]  # about 0.84 and 0.5
    assert sum((fingerprint(texts[k].encode()) ^ fingerprint(texts[k + 1].encode())).bit_count() > 3 for k in range(0, 60, 3)) > 10
    assert brute_pairs(texts) == [(k, k + 1) for k in range(0, 60, 3)]
    got = sorted(x["doc_id"] for x in corpus_pipeline.near_dedup(spark, docs_frame(spark, texts), SF).collect())
    assert got == [k for k in range(60) if k % 3 != 1]


def test_no_similar_pair_of_the_table_stays(spark):
    docs = [d for d in table("documents", "doc_id", "text")]
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {x["doc_id"] for x in corpus_pipeline.near_dedup(spark, frame, SF).select("doc_id").collect()}
    pairs = brute_pairs([d["text"] for d in docs])
    assert pairs and not [p for p in pairs if docs[p[0]]["doc_id"] in kept and docs[p[1]]["doc_id"] in kept]


def test_anchors_refuse_a_larger_radius(spark):
    with pytest.raises(ValueError):
        links(spark.createDataFrame([(1,)], "fp long"), 4)


def test_odd_shingles():
    assert len(shingles(b" \n")) == 0 and len(bands(shingles(b""))) == 0
    assert len(shingles(b"a b")) == 1 and len(shingles(b"a b c d e f")) == 2 and (shingles(b"A b") == shingles(b"a  B")).all()


def test_repeated_and_null_ids(spark):
    r = random.Random(3)
    a, b, c = (" ".join(f"w{r.randrange(5000)}" for _ in range(100)) for _ in range(3))
    docs = docs_frame(spark, [a, b, b, c, c, b], ids=[1, 1, 2, None, None, 1])
    assert sorted(x["text"] for x in corpus_pipeline.near_dedup(spark, docs, SF).collect()) == sorted([a, b, c])


def test_split_buckets_lose_no_link(spark):
    """Buckets far beyond the bound of a task: a large group of near copies, and chains whose ends are unlike each other."""
    from quire.llm import near_copies as nc

    r = random.Random(11)
    base = [f"w{r.randrange(9000)}" for _ in range(200)]
    texts = [edited(base, r, 2) for _ in range(60)]
    for _ in range(3):
        words = [f"v{r.randrange(9000)}" for _ in range(120)]
        for _ in range(15):  # each like the one before it
            words = words[4:] + [f"v{r.randrange(9000)}" for _ in range(4)]
            texts.append(" ".join(words))
    marks = nc.marked(docs_frame(spark, texts))
    want = sorted(map(tuple, nc.named_roots(nc.similar_links(marks)).collect()))
    got = sorted(map(tuple, nc.named_roots(nc.similar_links(marks, members=4)).collect()))
    assert len(want) == len(texts) and len({x[1] for x in want}) == 4 and {frozenset(k for k, y in got if y == x) for _, x in got} == {frozenset(k for k, y in want if y == x) for _, x in want}
    pairs = {frozenset(p) for p in brute_pairs(texts)}
    assert pairs and all(x in pairs for x in ({k, k + 1} for k in range(60, 74)))


def test_clashing_columns_stay(spark):
    from pyspark.sql import functions as F

    docs = docs_frame(spark, ["a b c", "a b c", None]).withColumn("_n_row", F.lit("x")).withColumn("_n_key", F.lit(None).cast("string"))
    out = corpus_pipeline.near_dedup(spark, docs, SF)
    assert out.columns == docs.columns and [(x["doc_id"], x["_n_row"], x["_n_key"]) for x in out.orderBy("doc_id").collect()] == [(0, "x", None), (2, "x", None)]
