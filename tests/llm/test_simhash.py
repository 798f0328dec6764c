import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm.simhash import anchors_of, connected, fingerprint, links, near_duplicates, op10_simhash

from .helpers import ODD, SF, docs_frame, table


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(ids, fps):
    x = np.array(fps, np.uint64)
    root = list(range(len(x)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[k + 1 :] ^ x[k]) <= 3) + k + 1:
            root[find(int(j))] = find(k)
    best = {}
    for k in range(len(x)):
        if ids[k] is not None:
            best[find(k)] = min(best.get(find(k), ids[k]), ids[k])
    return [best.get(find(k)) for k in range(len(x))]


def test_whole_table_like_brute_force(spark):
    docs = table("documents", "doc_id", "text")
    fps = [brute_fingerprint(d["text"]) for d in docs]
    want = {d["doc_id"]: (f"{f:016x}", c) for d, f, c in zip(docs, fps, brute_components([d["doc_id"] for d in docs], fps))}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op10_simhash(spark, SF).collect()} == want


def test_anchors_cover_every_link():
    r = random.Random(2)
    for _ in range(3000):
        a = r.getrandbits(64)
        b = a
        for k in r.sample(range(64), r.randrange(1, 4)):
            b ^= 1 << k
        anchor, row, home = anchors_of(np.array([a, b], np.uint64))
        sets = [{int(x) for x, y in zip(anchor, row) if y == k} for k in (0, 1)]
        homes = [{int(x) for x, y, h in zip(anchor, row, home) if y == k and h} for k in (0, 1)]
        assert (homes[0] & sets[1]) | (homes[1] & sets[0])


def test_long_runs_and_chains(spark):
    r = random.Random(4)
    base = r.getrandbits(64)
    fps = {base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64) if a != b}  # one crowded neighbourhood
    at = r.getrandbits(64)
    for k in range(40):  # a chain
        at ^= (1 << (k % 64)) | (1 << ((k * 7 + 1) % 64))
        fps.add(at)
    fps |= {r.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    root = {x["node"]: x["root"] for x in connected(links(nodes)).collect()}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = brute_components(signed, fps)
    assert [root.get(f, f) if f not in root.values() else f for f in signed] == want


def test_odd_rows(spark):
    docs = docs_frame(spark, ODD, ids=[7, None, 5, 1, 9, 8, 8, 3, 4, 6]).withColumn("component_id", F.lit("clash")).withColumn("fp", F.lit("clash"))
    fps = [brute_fingerprint(t) for t in ODD]
    ids = [7, None, 5, 1, 9, 8, 8, 3, 4, 6]
    got = sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in near_duplicates(docs).collect()), key=repr)
    assert got == sorted(((i, f, c) for i, f, c in zip(ids, fps, brute_components(ids, fps))), key=repr)
    assert near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["", "one", "one two", "One  TWO\x0bthree", "a b c d e É"])
def test_fingerprints(text):
    assert fingerprint(text.encode()) == brute_fingerprint(text)
