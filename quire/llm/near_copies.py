"""Near copies by the similarity of their five-word shingles, for the pipeline's stage.

Two documents are near copies if the Jaccard similarity of their sets of distinct five-word shingles is at least 0.8, or if their
SimHash fingerprints are linked as in op10. SimHash distances don't reach that similarity (at 0.8 about 10 of 64 bits differ, and
a covering code of that radius sends a fingerprint to most anchors), so pairs are retrieved by 16 bands of 4 minhashes: at a
similarity of 0.8 a pair shares a band with probability 1 - (1 - 0.8^4)^16 = 0.9998. Every retrieved pair is then verified on the
shingles themselves. Sets that are equal are compared once, and buckets with the same members too.

A bucket with many members is split into shards of bounded size, each of which also gets one common member; so a large group of near
copies is linked through it, shard by shard. Where a bucket's members are then still in several components, all but those of
its largest component are compared with every shard, in blocks. No task holds more than two blocks of sets, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from .common import bytes_of, free, materialised, pinned, small
from .simhash import connected, fingerprint, links

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS = 16, 4
#: Members of a bucket that are compared in one task, and entries of a worker's cache of word hashes.
MEMBERS, CACHE = 1024, 200_000
SEED = 43
_ODD = np.random.default_rng(5).integers(1, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """XXH64 of words, filled on demand."""

    def __missing__(self, word: bytes) -> int:
        h = xxh64_intdigest(word, SEED)
        if len(self) < CACHE:
            self[word] = h
        return h


_hashes = WordHashes()


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the shingles of the lower-cased (A-Z) words; a shorter text is one shingle, an empty one none."""
    tokens = text.lower().split()
    n = len(tokens)
    if n == 0:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(_hashes.__getitem__, tokens), np.uint64, n)
    k = min(n, words)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = (h ^ each[i : n - k + 1 + i]) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
    return np.unique(h)


def bands(own: np.ndarray) -> np.ndarray:
    """The BANDS hashes of a shingle set's minhashes; none of an empty set."""
    if not len(own):
        return np.zeros(0, np.int64)
    low = np.full(BANDS * ROWS, ~np.uint64(0))
    for k in range(0, len(own), 1 << 10):
        x = own[k : k + (1 << 10)] * _ODD[:, None]
        np.minimum(low, x.min(1), out=low)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in low.reshape(BANDS, ROWS).T:
        h = (h ^ column) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def marked(docs: DataFrame) -> DataFrame:
    """docs with _n_row, _n_fp (SimHash), _n_key (hash of the shingle set) and _n_bands, written as a table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, place = b.num_rows, b.num_columns - 1
            fp, key, found = np.empty(n, np.uint64), np.empty(n, np.uint64), []
            for k in range(n):  # a text and its shingles at a time
                text = (b.column(place)[k].as_py() or "").encode()
                own = shingles(text)
                fp[k], key[k] = fingerprint(text), xxh64_intdigest(own.tobytes(), SEED)
                found.append(bands(own))
            more = [pa.array(fp.view(np.int64)), pa.array(key.view(np.int64)), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *more], [*b.schema.names[:-1], "_n_fp", "_n_key", "_n_bands"])

    numbered = docs.withColumn("_n_row", F.monotonically_increasing_id())  # numbered once, as the table is written
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema)
    return materialised(numbered.withColumn("_n_text", F.col("text").cast("string")).mapInArrow(run, f"{schema}, _n_fp long, _n_key long, _n_bands array<long>"), "near-copies")


def sets_of(marks: DataFrame, keys: DataFrame) -> DataFrame:
    """(_n_key, _n_set) of the keys: the shingles of one row of each, made anew from its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(x).tobytes() for x in bytes_of(b.column(1))], pa.binary())], ["_n_key", "_n_set"])

    first = marks.groupBy("_n_key").agg(F.min("_n_row").alias("_n_row")).join(keys, "_n_key", "left_semi").select("_n_row")
    rows = marks.join(small(pinned(first)), "_n_row", "left_semi")
    return rows.select("_n_key", F.col("text").cast("string")).mapInArrow(run, "_n_key long, _n_set binary")


def verified(keys: np.ndarray, sets: list[np.ndarray], similar: float = SIMILAR) -> tuple[list[int], list[int]]:
    """Links that span the groups of sets that are at least similar to each other: one for each member but the first."""
    left, right = [], []
    size = np.array([len(s) for s in sets])
    rest = np.arange(len(sets))
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        root = front[0]
        while front and len(rest):
            own = sets[front.pop()]
            near = rest[(size[rest] >= similar * len(own) * (1 - 1e-9)) & (size[rest] * similar * (1 - 1e-9) <= len(own))]
            if not len(near):
                continue
            flat = np.concatenate([sets[k] for k in near])
            at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            both = np.add.reduceat((own[at] == flat).astype(np.int64), np.r_[0, np.cumsum(size[near])[:-1]])
            found = near[both >= similar * (len(own) + size[near] - both) - 1e-9]
            if len(found):
                front.extend(found.tolist())
                left += [int(keys[root])] * len(found)
                right += keys[found].tolist()
                rest = rest[~np.isin(rest, found)]
    return left, right


def compared(groups: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Links (a, b) inside the groups (part, _n_key) of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, keys, own = None, [], []

        def done() -> pa.RecordBatch:
            a, b = verified(np.array(keys, np.int64), own, similar)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for b in batches:
            for part, key, raw in zip(*(c.to_pylist() for c in b.columns)):
                if part != last:
                    if len(keys) > 1:
                        yield done()
                    last, keys, own = part, [], []
                keys.append(key)
                own.append(np.frombuffer(raw, np.uint64))
        if len(keys) > 1:
            yield done()

    dealt = groups.join(sets, "_n_key").select("part", "_n_key", "_n_set").repartition("part").sortWithinPartitions("part", "_n_key")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def similar_links(marks: DataFrame, similar: float = SIMILAR, members: int = MEMBERS) -> DataFrame:
    """Spanning links (a, b) between the keys of shingle sets that share a band and are at least similar."""
    each = marks.select("_n_key", F.explode("_n_bands").alias("band")).distinct()
    buckets = each.groupBy("band").agg(F.count("*").alias("n"), F.min("_n_key").alias("lo"), F.max("_n_key").alias("hi"), F.bit_xor(F.xxhash64("_n_key")).alias("all")).where("n > 1")
    # one of the buckets with the same members
    one = pinned(buckets.groupBy("n", "lo", "hi", "all").agg(F.min("band").alias("band")).select("band", "lo", F.ceil(F.col("n") / members).cast("int").alias("shards")))
    held = pinned(each.join(small(one), "band").withColumn("shard", F.pmod(F.xxhash64("_n_key"), F.col("shards"))))
    sets = materialised(sets_of(marks, held.select("_n_key").distinct()), "near-sets")
    part = lambda *c: F.xxhash64("band", *c)
    common = one.where("shards > 1").select(F.col("lo").alias("_n_key"), "band", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    first = held.select("_n_key", part("shard").alias("part")).unionAll(common.select("_n_key", part("shard").alias("part"))).distinct()
    found = pinned(compared(first, sets, similar))
    large = held.where("shards > 1")
    if large.isEmpty():
        return found
    roots = named_roots(found)
    large = pinned(large.join(roots, "_n_key", "left").withColumn("root", F.coalesce("root", "_n_key")))
    most = large.groupBy("band", "root").agg(F.count("*").alias("n")).groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("root"), (F.sum("n") - F.max("n")).alias("others")).where("others > 0")
    most = pinned(most.select("band", "root", F.ceil(F.col("others") / members).cast("int").alias("blocks")))
    asked = large.join(most, ["band", "root"], "left_anti").join(most.select("band", "blocks"), "band").withColumn("block", F.pmod(F.xxhash64("_n_key", F.lit(1)), F.col("blocks")))
    asked = asked.select("_n_key", "band", "block", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    told = large.join(most.select("band", "blocks"), "band").select("_n_key", "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "shard")
    second = asked.select("_n_key", part("block", "shard", F.lit(2)).alias("part")).unionAll(told.select("_n_key", part("block", "shard", F.lit(2)).alias("part"))).distinct()
    return found.unionAll(compared(second, sets, similar))


def named_roots(edges: DataFrame) -> DataFrame:
    """(_n_key, root) of the keys in edges."""
    roots = connected(edges)
    return pinned(roots.unionAll(roots.select(F.col("root").alias("node"), "root")).distinct().select(F.col("node").alias("_n_key"), "root"))


def components(marks: DataFrame) -> DataFrame:
    """(_n_key, root) of the keys that are linked by similarity or by their fingerprints."""
    pairs = pinned(marks.select("_n_key", F.col("_n_fp").alias("fp")).distinct())
    named = pinned(pairs.groupBy("fp").agg(F.min("_n_key").alias("name")))
    same = pairs.join(named, "fp").where("name != _n_key").select(F.col("name").alias("a"), F.col("_n_key").alias("b"))
    bits = links(named).join(named.select(F.col("fp").alias("a"), F.col("name").alias("x")), "a").join(named.select(F.col("fp").alias("b"), F.col("name").alias("y")), "b")
    return named_roots(similar_links(marks).unionAll(same).unionAll(bits.select(F.col("x").alias("a"), F.col("y").alias("b"))))


def one_of_each_near(docs: DataFrame) -> DataFrame:
    """One row of docs of each component: that with the smallest doc_id, null ids last, and of equal ids the one read first.

    Empty and null texts are copies of each other. Other columns pass through whatever their names; an empty table gives none.
    """
    names = free(docs.columns, "_n_")
    marks = marked(docs.toDF(*names))
    rooted = marks.select("_n_row", "doc_id", "_n_key").join(components(marks), "_n_key", "left")
    first = rooted.groupBy(F.coalesce("root", "_n_key").alias("root")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_n_row")).alias("first"))
    keep = first.select(F.col("first._n_row").alias("_n_row"))
    gone = small(pinned(marks.select("_n_row").join(keep, "_n_row", "left_anti")))
    return marks.join(gone, "_n_row", "left_anti").select(*names).toDF(*docs.columns)
