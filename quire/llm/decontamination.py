"""Benchmark decontamination: BM25 with block-max WAND, then verified overlap of question and answer.

The inverted index of the benchmark is built on the driver in shards of a bounded number of items and broadcast; every
passage of every document is a query. A score is given as a share of the item's score for its own text, so that one threshold
serves short and long items. Passages are pruned by the sum of their terms' largest impacts, then by the sums of their blocks'
largest impacts (block-max WAND, with the pivot tests of many passages made together); only what is left is scored in full,
and every item above the threshold is returned: no bound drops an item that reaches it. Retrieved items are verified by five-word shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import documents

K1, B = 1.2, 0.75
#: Share of an item's own score from which it is retrieved.
SHARE = 0.5
#: Least share of an item's five-word shingles, and of its answer's words, that verifies a leak.
SIMILAR, ANSWER = 0.8, 0.5
#: Items in a posting block, and in an index shard.
BLOCK, SHARD = 8, 20_000
#: ASCII other than letters and digits to spaces, A-Z to a-z; other letters are lower-cased before.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    if not text.isascii():
        text = text.decode().lower().encode()
    return text.translate(FOLD).split()


def shingles(words: list[bytes]) -> list[bytes]:
    """Five-word shingles; of fewer words all together, of none nothing."""
    return [b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], ..., start[0] + count[0] - 1, start[1], ..."""
    return np.repeat(start - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum()) if len(start) else np.zeros(0, np.int64)


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting is several times faster here than NumPy's hashing."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


class Index:
    """Postings of items (id, text), with impacts as a share of each item's own score."""

    def __init__(self, items: list[tuple[int, bytes]]):
        items = sorted(items, key=lambda x: (len(words_of(x[1])), x))  # like lengths, and so like impacts, share a block
        self.ids = [i for i, _ in items]
        words = [words_of(t) for _, t in items]
        self.longest = max(map(len, words), default=0)
        self.terms: dict[bytes, int] = {}
        rows = []
        for k, w in enumerate(words):
            for t in dict.fromkeys(w):
                rows.append((self.terms.setdefault(t, len(self.terms)), k, w.count(t), len(w)))
        term, item, tf, length = (np.array(x) for x in zip(*rows)) if rows else (np.zeros(0, int),) * 4
        df = np.bincount(term, minlength=len(self.terms))
        impact = np.log1p((len(items) - df[term] + 0.5) / (df[term] + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(1e-9, np.mean([len(w) for w in words]) if words else 1)))
        own = np.bincount(item, impact, len(items))
        impact = impact / own[item]
        order = np.lexsort((item, term))
        self.item, self.impact = item[order], impact[order]
        self.start = np.r_[0, np.cumsum(df)].astype(np.int64)
        self.top = np.zeros(len(self.terms))
        np.maximum.at(self.top, term, impact)
        self.blocks = -(-len(items) // BLOCK)
        posting_term = term[order]
        change = np.r_[True, (np.diff(posting_term) != 0) | (np.diff(self.item // BLOCK) != 0)] if len(term) else np.zeros(0, bool)
        self.b_from = np.r_[np.flatnonzero(change), len(term)]
        self.b_block = self.item[self.b_from[:-1]] // BLOCK
        self.b_top = np.maximum.reduceat(self.impact, self.b_from[:-1]) if len(term) else np.zeros(0)
        self.b_start = np.searchsorted(posting_term[self.b_from[:-1]], np.arange(len(self.terms) + 1))
        self.question = [set(shingles(w)) for w in words]
        self.answer = [set(w[-(-2 * len(w) // 3) :]) for w in words]

    def scored(self, ids: np.ndarray, passage: np.ndarray, n: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, score) of all items that score at least least; (passage, id) are distinct, passages 0 to n - 1.

        Block-max WAND over many queries at a time: the pivot test is made for every block of every passage at once, then the
        blocks that pass it are scored item by item. What the bounds rule out can't reach least.
        """
        count = self.b_start[ids + 1] - self.b_start[ids]
        entry = _ranges(self.b_start[ids], count)
        cell = np.repeat(passage, count) * self.blocks + self.b_block[entry]
        alive = np.bincount(cell, self.b_top[entry], n * self.blocks)[cell] >= least - 1e-9
        entry, passage = entry[alive], cell[alive] // self.blocks
        count = self.b_from[entry + 1] - self.b_from[entry]
        posting = _ranges(self.b_from[entry], count)
        key, place = np.unique(np.repeat(passage, count) * len(self.ids) + self.item[posting], return_inverse=True)
        score = np.bincount(place, self.impact[posting], len(key))
        found = score >= least - 1e-9
        return key[found] // len(self.ids), key[found] % len(self.ids), score[found]

    def search(self, texts: list[bytes], share: float = SHARE) -> list[tuple[int, int, int, float]]:
        """(text, item, passage start in words, score) for every passage of texts and every item above the share."""
        step = max(32, self.longest)  # a passage has 2 * step words and starts every step words: every item fits in one
        get, size = self.terms.get, max(1, len(self.terms))
        ids, segment, first, owner, pairs = [], [], [], [], []
        segments = n = 0
        for d, text in enumerate(texts):
            w = np.array(list(map(get, words_of(text), repeat(-1))), np.int64)
            k = max(1, -(-len(w) // step) - 1)
            hit = np.flatnonzero(w >= 0)
            ids.append(w[hit])
            segment.append(segments + hit // step)
            first.append(np.arange(k) * step)
            owner.append(np.full(k, d))
            pairs.append(segments + np.arange(k))  # passage: this segment and the next
            segments, n = segments + k + 1, n + k
        if not n:
            return []
        key = _distinct(np.concatenate(segment) * size + np.concatenate(ids))
        segment, ids = np.divmod(key, size)
        bound = np.bincount(segment, self.top[ids], segments)
        pairs = np.concatenate(pairs)
        alive = np.flatnonzero(bound[pairs] + bound[pairs + 1] >= share - 1e-9)  # a term of both segments only raises the bound
        from_ = np.searchsorted(segment, np.arange(segments + 2))
        count = from_[pairs[alive] + 2] - from_[pairs[alive]]
        key = _distinct(np.repeat(alive, count) * size + ids[_ranges(from_[pairs[alive]], count)])
        passage, ids = np.divmod(key, size)
        keep = np.bincount(passage, self.top[ids], n)[passage] >= share - 1e-9
        passage, ids = passage[keep], ids[keep]
        if not len(ids):
            return []
        number, dense = np.unique(passage, return_inverse=True)
        out, first, owner = [], np.concatenate(first), np.concatenate(owner)
        most = max(1, (1 << 21) // self.blocks)
        for a in range(0, len(number), most):  # some passages at a time, for bounded memory
            b = min(len(number), a + most)
            lo, hi = np.searchsorted(dense, [a, b])
            q, items, scores = self.scored(ids[lo:hi], dense[lo:hi] - a, b - a, share)
            q = number[a + q]
            out += zip(owner[q].tolist(), items.tolist(), first[q].tolist(), scores.tolist())
        return out

    def leaks(self, texts: list[bytes], share: float = SHARE) -> list[tuple[int, int, float, float, float]]:
        """(text, item, score, question overlap, answer overlap) of verified leaks, once for each text and item."""
        best: dict[tuple[int, int], tuple] = {}
        for d, i, start, score in self.search(texts, share):
            w = words_of(texts[d])[start : start + 2 * max(32, self.longest)]
            asked, answered = self.question[i], self.answer[i]
            has = asked & set(shingles(w)) if len(next(iter(asked)).split()) == 5 else {g for g in asked if b" " + g + b" " in b" " + b" ".join(w) + b" "}
            q, a = len(has) / len(asked), len(answered & set(w)) / len(answered) if answered else 1.0
            if q >= SIMILAR and a >= ANSWER:
                best[d, i] = max(best.get((d, i), (0.0, 0.0, 0.0)), (score, q, a))
        return [(d, i, *x) for (d, i), x in sorted(best.items())]


def indexes(benchmark: DataFrame, shard: int = SHARD) -> Iterator[Index]:
    """One index after the other over bounded shards of benchmark (item_id, text); items without words are passed over."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    n = max(1, -(-items.count() // shard))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        rows = [(r[0], r[1].encode()) for r in rows if words_of(r[1].encode())]
        if rows:
            yield Index(rows)


def _portions(texts: list[bytes], most: int = 1 << 22) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of together some MB, with the place of the first."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield at, texts[at : k + 1]
            at, size = k + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap): a row for each row of docs and item that it holds.

    Null and empty texts hold nothing, nor does anything match an empty benchmark; repeated rows and null ids are judged each by
    itself; extra columns are not looked at. score is the share of the item's own BM25 score.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    out = None
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, names = shared.value, ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
            for b in batches:
                doc = b.column(0).to_pylist()
                rows = [(doc[at + d], index.ids[i], *x) for at, part in _portions(_texts(b.column(1))) for d, i, *x in index.leaks(part)]
                if rows:
                    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        part = slim.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return spark.createDataFrame([], schema) if out is None else out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold an item of benchmark; nothing is shuffled."""
    for index in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        place = docs.columns.index("text")

        def run(batches: Iterator[pa.RecordBatch], shared=shared, place=place) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bad = {at + d for at, part in _portions(_texts(b.column(place))) for d, *_ in shared.value.leaks(part)}
                yield b.filter(pa.array([k not in bad for k in range(b.num_rows)], pa.bool_())) if bad else b

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
