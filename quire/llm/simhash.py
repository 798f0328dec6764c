"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has 64 bits, and a link is a distance of at most 3. Of two linked fingerprints, one 32-bit half differs in
at most 1 bit. In each half (of which 31 bits are used) the anchors are the codewords of the [31, 26] Hamming code, whose
covering radius is 1. Each fingerprint is sent to every anchor within covering radius plus threshold, 1 + 1 = 2: one anchor
if its half is a codeword, else 16. The nearest anchor of either of two linked fingerprints then holds both, so comparing
within anchors, where one side is at home (within the covering radius), finds every link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bytes_of, materialised, pinned

RADIUS = 3
SEED = 42
#: Runs of an anchor up to this length are compared row by row in one vector operation per distance.
SHORT = 16
#: Longer runs than this are first split by exact 16-bit quarters (3 differing bits leave one quarter equal).
WIDE = 2048


def fingerprint(text: bytes, words: int = 3, seed: int = SEED) -> int:
    """The majority bits of the XXH64 of each shingle of the lower-cased (A-Z) words; 0 without words."""
    from xxhash import xxh64_intdigest as xx

    tokens = text.lower().split()
    n = len(tokens)
    if n == 0:
        return 0
    line = b" ".join(tokens)
    if n <= words:
        return xx(line, seed)
    lengths = np.fromiter(map(len, tokens), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: n - words + 1], ends[words - 1 :]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(starts), 1 << 15):
        hashes = np.array([xx(line[a:b], seed) for a, b in zip(starts[k : k + (1 << 15)].tolist(), ends[k : k + (1 << 15)].tolist())], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for each row of docs; fp as a signed long. Null text counts as empty and has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(x) for x in bytes_of(b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def anchors_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, home) of uint64 fingerprints: all codewords within 2 of either half; home: within 1."""
    out = []
    rows = np.arange(len(fp))
    for half in (0, 1):
        x = ((fp >> np.uint64(32 * half)) & np.uint64(0x7FFFFFFF)).astype(np.int64)
        syndrome = np.zeros(len(fp), np.int64)
        for i in range(1, 32):
            syndrome ^= np.where((x >> (i - 1)) & 1, i, 0)
        flip = np.where(syndrome > 0, np.int64(1) << np.maximum(syndrome - 1, 0), 0)
        out.append((x ^ flip | half << 31, rows, np.ones(len(fp), bool)))
        for i in range(1, 32):
            j = i ^ syndrome
            ok = (syndrome > 0) & (j > i)  # also leaves out i == syndrome, for which j is 0
            out.append(((x[ok] ^ (1 << (i - 1)) ^ (np.int64(1) << (j[ok] - 1))) | half << 31, rows[ok], np.zeros(int(ok.sum()), bool)))
    return tuple(np.concatenate(x) for x in zip(*out))


def near(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= radius


def star_links(fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the linked groups of distinct fingerprints: one for each member but the first, not one for each pair."""
    left, right = [], []
    rest = fp.copy()
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        root = front[0]
        while front and len(rest):
            hit = near(rest, front.pop(), radius)
            if hit.any():
                found, rest = rest[hit], rest[~hit]
                front.extend(found)
                left.append(np.full(len(found), root, np.uint64))
                right.append(found)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left) if left else none), (np.concatenate(right) if right else none)


def wide_links(fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """As star_links, for long runs: only fingerprints that agree in one of four 16-bit quarters are compared."""
    if len(fp) <= WIDE:
        return star_links(fp, radius)
    left, right = [], []
    for q in range(4):
        part = (fp >> np.uint64(16 * q)) & np.uint64(0xFFFF)
        order = np.argsort(part, kind="stable")
        edges = np.flatnonzero(np.diff(part[order])) + 1
        for run in np.split(fp[order], edges):
            if len(run) > 1:
                a, b = star_links(run, radius)
                left.append(a)
                right.append(b)
    return np.concatenate(left), np.concatenate(right)


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints in column fp that are within radius (at most 3) of each other."""
    if radius > RADIUS:
        raise ValueError(f"the anchors reach {RADIUS} bits, not {radius}")

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for k in range(0, len(fp), 1 << 15):
                part = fp[k : k + (1 << 15)].view(np.uint64)
                anchor, row, home = anchors_of(part)
                yield pa.RecordBatch.from_arrays([pa.array((anchor << 1) | home), pa.array(part[row].view(np.int64))], ["anchor", "fp"])

    def compared(anchor: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        """anchor is sorted and ends at the end of a run; its lowest bit says whether fp is at home."""
        home, anchor = (anchor & 1).astype(bool), anchor >> 1
        starts = np.flatnonzero(np.r_[True, np.diff(anchor) != 0])
        lengths = np.diff(np.r_[starts, len(anchor)])
        left, right = [], []
        for s, n in zip(starts[lengths > SHORT].tolist(), lengths[lengths > SHORT].tolist()):
            if home[s : s + n].any():
                a, b = wide_links(fp[s : s + n], radius)
                left.append(a)
                right.append(b)
        short = np.repeat((lengths > 1) & (lengths <= SHORT), lengths)
        anchor, home, fp = anchor[short], home[short], fp[short]
        for k in range(1, SHORT):
            hit = (anchor[k:] == anchor[:-k]) & (home[k:] | home[:-k]) & near(fp[k:], fp[:-k], radius) if len(fp) > k else np.zeros(0, bool)
            if hit.any():
                left.append(fp[:-k][hit])
                right.append(fp[k:][hit])
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], ["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_a, held_f, last = [], [], None
        for b in batches:
            anchor, fp = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(anchor):
                continue
            if anchor[-1] >> 1 == last:  # the whole batch continues one run, or ends in it
                cut = 0
            else:
                last = anchor[-1] >> 1
                cut = int(np.searchsorted(anchor >> 1, last))
                yield from compared(np.concatenate([*held_a, anchor[:cut]]), np.concatenate([*held_f, fp[:cut]]))
                held_a, held_f = [], []
            held_a.append(anchor[cut:])
            held_f.append(fp[cut:])
        if held_a:
            yield from compared(np.concatenate(held_a), np.concatenate(held_f))

    replicas = nodes.select("fp").mapInArrow(replicate, "anchor long, fp long")
    dealt = replicas.repartition(F.shiftright("anchor", 1)).sortWithinPartitions("anchor")
    found = dealt.mapInArrow(compare, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()


def connected(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) for each node of the links (a, b): root is the smallest node that it reaches.

    Alternates large-star and small-star steps; each is a min-aggregation and an equi-join, so no neighbourhood is gathered. Both
    sides of the joins are pinned, so that AQE can split the rows of a node with many neighbours.
    """
    edges = pinned(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before = None
    for _ in range(most):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = pinned(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = pinned(both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        lower = pinned(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        edges = pinned(small.unionAll(lower.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components have not settled after {most} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs.

    component_id is the smallest doc_id that is reachable over links, the row's own included; null ids are passed over, and a
    component with null ids only has a null component_id. Empty and null texts share fingerprint 0 and so one component.
    Repeated rows and ties stay as they are, one result row each. Other columns of docs are not looked at.
    """
    fps = materialised(fingerprints(docs), "simhash")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected(links(nodes, radius))
    linked = roots.unionAll(roots.select(F.col("root").alias("node"), "root")).distinct()
    owned = linked.join(nodes, linked.node == nodes.fp).groupBy("root").agg(F.min("first_id").alias("component_id"))
    group = linked.join(owned, "root").select(F.col("node").alias("fp"), "component_id")
    # a table of its own, so that the last join's sides are plain exchanges, of which AQE splits a fingerprint with many copies
    ids = pinned(nodes.join(group, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id")))
    return fps.join(ids, "fp").select("doc_id", "fp", "component_id")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    from .common import documents

    return near_duplicates(documents(spark, sf_dir)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
