"""A hashed maximum-entropy language model, and unigram scores beside it.

A frequent word ("head") is a leaf of a tree of classes three levels deep, and P(word | history) is the product of three softmaxes:
class, class within it, word within that. All other words end at the first level in tail classes by their shape. Each softmax
has weights of hashed features of the history, joined with the class that is being divided: the previous word, the two previous words
(n-grams), and the word before the previous one (skip). A bias feature alone has its maximum-likelihood weight, the log of a relative
frequency; it is all that tells the words of a tail class apart (add one; an unknown word takes the place of one more word).

Training is distributed gradient descent in rounds. Rows are dealt to buckets by a hash of id and text, and each bucket takes
gradient steps over its own rows, in a fixed order, from the round's common weights; then each row of weights moves by the mean of
the buckets' moves, weighed by how often they met its feature. Nothing depends on how the input is partitioned. Head, classes, rows of
weights and buckets follow from the counted corpus, up to bounds of what a worker holds.

Counts cover all training tokens. A dictionary of bounded size goes to the workers; words beyond it are looked up by a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import crc_mod, documents, materialised, short_batches

#: Words whose counts are sent to the workers, and how often a head word is found at least.
DICTIONARY, LEAST = 200_000, 8
#: Most classes of a node (so that the head has at most their cube), tail classes, features besides the bias, levels of the tree.
ARITY, TAILS, FEATURES, LEVELS = 20, 4, 3, 3
#: Training tokens for a row of a feature's weights; fewest and most rows (powers of two).
TOKENS_A_ROW, ROWS_LEAST, ROWS_MOST = 2048, 1 << 14, 1 << 17
#: Training tokens of a bucket at least; buckets until they hold BUCKET_MOST tokens, and how many after; rounds.
BUCKET, BUCKETS, BUCKET_MOST, ROUNDS = 1 << 18, 24, 1 << 24, 4
#: Tokens of a gradient step at most (fewer if the corpus has under STEPS of them), bytes of text tokenised at a time, distinct words held while counting, rows of weights in a message.
STEP, STEPS, SLICE, FLUSH, BLOCK = 1 << 14, 256, 1 << 23, 500_000, 1 << 12
#: Buckets of previous words by which head words are grouped, frequent ones with their own; children of a tree sum.
PREVIOUS, OWN, FAN = 256, 160, 64
END = b""


# ---- tokens and counts --------------------------------------------------------------------------------------------------------


def slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, pa.Array]]:
    """(first row, part) of a string column, parts of together about most bytes; null becomes empty."""
    column = pc.fill_null(column, "")
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, column.slice(at, to - at)
        at = to


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased (A-Z) words of texts, without ends, and the place of each word's text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    words = lists.flatten()
    some = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    return words.filter(pa.array(some)), doc[some]


def tails_of(words: pa.Array) -> np.ndarray:
    """The tail class of each word by its shape: letters, letters with a mark behind, not ASCII, others."""
    ascii_ = pc.string_is_ascii(words).to_numpy(zero_copy_only=False)
    letters = pc.ascii_is_alpha(words).to_numpy(zero_copy_only=False)
    begun = pc.ascii_is_alpha(pc.utf8_slice_codeunits(words, 0, -1)).to_numpy(zero_copy_only=False)
    return np.where(~ascii_, 2, np.where(letters, 0, np.where(begun, 1, 3)))


def counted(docs: DataFrame) -> DataFrame:
    """(word binary, n long) of the words of docs (column text), the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ends = [], 0, 0

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for b in batches:
            for _, part in slices(b.column(0)):
                found = pc.value_counts(words_of(part)[0])
                held.append(pa.table({"word": found.field(0).cast(pa.binary()), "n": found.field(1)}))
                size, ends = size + len(found), ends + len(part)
                if size > 2 * FLUSH:
                    held = [merged()]
                    size = held[0].num_rows
                    if size > FLUSH:
                        yield from held[0].to_batches()
                        held, size = [], 0
        held.append(pa.table({"word": pa.array([END], pa.binary()), "n": pa.array([ends], pa.int64())}))
        yield from merged().to_batches()

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary, n long")
    return found.where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The dictionary: the end, then words by falling count (ties in byte order), the first of them the head."""

    def __init__(self, values: pa.Array, counts: np.ndarray, head: int):
        self.values, self.counts, self.head = values, counts, head
        #: Whether the end, which is the empty word, was counted.
        self.has_end = len(values) > 0 and values[0].as_py() == ""

    @property
    def words(self) -> list[bytes]:
        return self.values.cast(pa.binary()).to_pylist()


def vocabulary_of(counts: DataFrame) -> tuple[Vocabulary, int, int]:
    """The dictionary (bounded), and the number of tokens and of distinct words in counts."""
    size = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    most = counts.groupBy("n").count().orderBy(F.desc("n"))
    least, held = 1, 0
    for r in most.toLocalIterator():  # as many words as the dictionary holds
        if held + r["count"] > DICTIONARY:
            least = r["n"] + 1
            break
        held += r["count"]
    rows = counts.where(F.col("n") >= least).select("word", "n", (F.length("word") == 0).alias("end")).toArrow()  # at most DICTIONARY
    rows = rows.sort_by([("end", "descending"), ("n", "descending"), ("word", "ascending")]).combine_chunks()
    n = rows.column("n").to_numpy().astype(np.int64)
    words = pa.array([], pa.string()) if not len(n) else rows.column("word").combine_chunks().cast(pa.string())
    words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
    frequent = int(((n >= LEAST) | rows.column("end").to_numpy()).sum())
    return Vocabulary(words, n, min(ARITY**3, frequent)), size["n"] or 0, size["v"]


def binaries(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """data cut into a binary column, lengths in items."""
    ends = np.r_[0, np.cumsum(lengths)] * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def encoded(docs: DataFrame, vocabulary: Vocabulary, held_out, rounds: int, buckets: int) -> DataFrame:
    """(row, doc_id, held_out, h, bucket, n_tokens, found, logs, tail_logs, ids, words, round) for each row of docs, written as a table.

    ids: the numbers of its tokens (head words, then tail classes) as uint16; found and logs: how many tokens are in the dictionary, and their
    log10(count + 1) summed, tail_logs without head words; words: those that aren't in it. h is a hash of id and text, round that of
    training or -1 for what is held out. Later passes read these, not the texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        log_count = np.log10(np.r_[v.counts + 1.0, 1.0])
        for b in batches:
            for start, part in slices(b.column(b.num_columns - 1)):
                words, doc = words_of(part)
                n = np.bincount(doc, minlength=len(part))
                at = pc.index_in(words, value_set=v.values.cast(words.type)).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                low = np.flatnonzero((at < 0) | (at >= v.head))
                ids = at.copy()
                ids[low] = v.head + tails_of(words.take(pa.array(low)))
                ends = np.cumsum(n + 1) - 1
                whole = np.empty(len(ids) + len(n), "<u2")
                whole[np.arange(len(ids)) + doc] = ids
                has_end = int(v.has_end)
                whole[ends] = 0 if has_end else v.head + TAILS - 1
                tail = np.bincount(doc[low], log_count[at[low]], len(n)).astype(float)  # of no words at all NumPy's sums are integers
                logs = np.bincount(doc, log_count[at], len(n)) + has_end * log_count[0]
                found = np.bincount(doc[at >= 0], minlength=len(n)) + has_end
                rare = np.flatnonzero(at < 0)
                offsets = np.r_[0, np.cumsum(np.bincount(doc[rare], minlength=len(n)))]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.take(pa.array(rare)).cast(pa.binary()))
                cut = b.slice(start, len(part))
                yield pa.RecordBatch.from_arrays(
                    [*cut.columns[:5], pa.array((n + 1).astype(np.int64)), pa.array(found), pa.array(logs), pa.array(tail), binaries(whole, n + 1), lists, cut.column(5)],
                    ["row", "doc_id", "held_out", "h", "bucket", "n_tokens", "found", "logs", "tail_logs", "ids", "words", "round"],
                )

    h = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    slim = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), h.alias("h"), F.pmod(h, F.lit(buckets)).cast("int").alias("bucket"),
        F.when(held_out, -1).otherwise(F.pmod(h, F.lit(buckets)) % rounds).cast("int").alias("round"), F.col("text").cast("string").alias("text"),
    )
    schema = "row long, doc_id long, held_out boolean, h long, bucket int, n_tokens long, found long, logs double, tail_logs double, ids binary, words array<binary>, round int"
    return materialised(slim.mapInArrow(run, schema), "maxent", "round")


def numbers_of(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers of several texts, each token's place in its text, and the texts' lengths."""
    n = np.array([len(x) // 2 for x in raw], np.int64)
    ids = np.frombuffer(b"".join(raw), "<u2").astype(np.int64)
    return ids, np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n), n


def portions(raw: list[bytes], most: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, texts): consecutive texts of together about most bytes."""
    at, size = 0, 0
    for k, x in enumerate(raw):
        size += len(x)
        if size >= most:
            yield at, raw[at : k + 1]
            at, size = k + 1, 0
    if at < len(raw):
        yield at, raw[at:]


# ---- the model ----------------------------------------------------------------------------------------------------------------


class Tree:
    """Classes of the head words, from an order of them in which like words are near each other; tail classes are outputs of the root."""

    def __init__(self, order: np.ndarray):
        head = len(order)
        self.head = head
        self.arity = k = max(2, int(np.ceil(round(max(head, 1) ** (1 / 3), 9))))
        leaf = np.empty(head, np.int64)
        leaf[order] = np.arange(head)
        wide = max(1, -(-head // k))
        narrow = -(-wide // k)
        at = [leaf // wide, leaf % wide // narrow, leaf % wide % narrow]
        #: At each level the target of each number, and the node that is divided there; tail classes have no node below the root.
        self.target = [np.r_[at[0], k + np.arange(TAILS)], at[1], at[2]]
        self.node = [np.zeros(head + TAILS, np.int64), at[0], at[0] * k + at[1]]
        self.width = [k + TAILS, k, k]

    def biases(self, counts: np.ndarray, tails: np.ndarray) -> list[np.ndarray]:
        """Logs of relative frequencies (node, output) from the counts of head words and tail classes; none where nothing was counted."""
        out = []
        for level, width in enumerate(self.width):
            n = np.zeros((self.arity**level, width))
            np.add.at(n, (self.node[level], self.target[level]), np.r_[counts, tails + 1.0] if level == 0 else counts)
            total = np.maximum(n.sum(1, keepdims=True), 1e-9)
            out.append(np.where(n > 0, np.log(np.maximum(n, 1e-9) / total), -30.0).astype(np.float32))
        return out


def histories(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One more than the two numbers before each token, 0 before a text's start; first: the token's place in its text."""
    out = []
    for k in (1, 2):
        h = np.zeros(len(ids), np.uint32)
        h[k:] = ids[:-k] + 1
        h[first < k] = 0
        out.append(h)
    return tuple(out)


def mixed(x: np.ndarray, odd: int) -> np.ndarray:
    x = x * np.uint32(odd)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    return x


def hashed(before: tuple[np.ndarray, np.ndarray], node: np.ndarray, rows: int) -> list[np.ndarray]:
    """The row of weights of each feature: previous word, both previous words, the one before the previous."""
    a, b = before
    s = node.astype(np.uint32) * np.uint32(0x165667B1)
    keys = (a * np.uint32(0x9E3779B1) + np.uint32(1), (a * np.uint32(0x85EBCA6B) + b) * np.uint32(0xC2B2AE35) + np.uint32(2), b * np.uint32(0x27D4EB2F) + np.uint32(3))
    shift = np.uint32(32 - rows.bit_length() + 1)
    return [(mixed(x ^ s, odd) >> shift).astype(np.uint16 if rows <= 1 << 16 else np.int32) for x, odd in zip(keys, (0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F))]


def logits(tables: list[np.ndarray], bias: np.ndarray, rows: list[np.ndarray], node: np.ndarray) -> np.ndarray:
    z = bias.take(node, 0)
    for t, r in zip(tables, rows):
        z += t.take(r, 0)
    return np.minimum(z, 80, out=z)  # so that no exponential overflows


def levels(tree: Tree, ids: np.ndarray, before: tuple[np.ndarray, np.ndarray]):
    """(level, places, node, target, histories) of the tokens that reach each level."""
    yield 0, np.arange(len(ids)), tree.node[0].take(ids), tree.target[0].take(ids), before
    at = np.flatnonzero(ids < tree.head)
    ids, before = ids.take(at), tuple(x.take(at) for x in before)
    for level in (1, 2):
        yield level, at, tree.node[level].take(ids), tree.target[level].take(ids), before


class Weights:
    """tables[level][feature] (rows, outputs) and biases[level] (nodes, outputs). They travel, and are held between rounds, as float16."""

    def __init__(self, tree: Tree, biases: list[np.ndarray], rows: int, tables: list[list[np.ndarray]] | None = None):
        self.tree, self.biases, self.rows = tree, biases, rows
        self.tables = tables or [[np.zeros((rows, w), np.float16) for _ in range(FEATURES)] for w in tree.width]

    def single(self) -> Weights:
        """A copy in single precision, to compute with."""
        return Weights(self.tree, self.biases, self.rows, [[t.astype(np.float32) for t in level] for level in self.tables])

    def log_probability(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Natural log of each token's probability: of the word if it is in the head, else of its tail class."""
        out = np.zeros(len(ids))
        for level, at, node, target, before in levels(self.tree, ids, histories(ids, first)):
            z = logits(self.tables[level], self.biases[level], hashed(before, node, self.rows), node)
            own = z[np.arange(len(z)), target].astype(float)
            out[at] += own - np.log(np.exp(z, out=z).sum(1, dtype=float))
        return out


def _order(rows: np.ndarray) -> np.ndarray:
    """A stable order; 16 bits at a time, which are sorted by radix."""
    if rows.dtype == np.uint16:
        return np.argsort(rows, kind="stable")
    order = np.argsort((rows & 0xFFFF).astype(np.uint16), kind="stable")
    return order.take(np.argsort((rows >> 16).astype(np.uint16).take(order), kind="stable"))


def descend(table: np.ndarray, squares: np.ndarray, times: np.ndarray, rows: np.ndarray, gradient: np.ndarray, rate: float, often: int = 24) -> None:
    """One step on the rows of a table by the summed gradient of their tokens, at a rate that falls with each row's past gradients."""
    order = _order(rows)
    rows = rows.take(order).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    n = np.diff(starts, append=len(rows))
    at, g = rows.take(starts), gradient.take(order.take(starts), 0)
    for k in np.flatnonzero(n > often).tolist():
        g[k] = gradient.take(order[starts[k] : starts[k] + n[k]], 0).sum(0)
    more, k = np.flatnonzero((n > 1) & (n <= often)), 1
    while len(more):  # the second token of each row, then the third, ...
        g[more] += gradient.take(order.take(starts.take(more) + k), 0)
        k += 1
        more = more[n.take(more) > k]
    squares[at] += (g * g).sum(1) / 4
    g *= (rate / np.sqrt(squares.take(at) + 1))[:, None]
    table[at] = table.take(at, 0) - g
    times[at] += n


class Learner:
    """Gradient steps of one bucket."""

    def __init__(self, start: Weights, rate: float, tokens: int = STEP):
        self.start, self.now, self.rate, self.tokens = start, start.single(), rate, tokens
        self.squares = [[np.zeros(start.rows, np.float32) for _ in level] for level in start.tables]
        self.times = [[np.zeros(start.rows, np.int32) for _ in level] for level in start.tables]
        self.held: list[bytes] = []
        self.size = 0

    def add(self, raw: bytes) -> None:
        self.held.append(raw)
        self.size += len(raw) // 2
        if self.size >= self.tokens:
            self.flush()

    def flush(self) -> None:
        if self.held:
            ids, first, _ = numbers_of(self.held)
            for k in range(0, len(ids), self.tokens):
                lo, to = max(0, k - 2), k + self.tokens
                before = tuple(h[k - lo :] for h in histories(ids[lo:to], first[lo:to]))
                self.step(ids[k:to], before)
        self.held, self.size = [], 0

    def step(self, ids: np.ndarray, before: tuple[np.ndarray, np.ndarray]) -> None:
        for level, _, node, target, h in levels(self.now.tree, ids, before):
            if not len(node):
                continue
            rows = hashed(h, node, self.now.rows)
            p = logits(self.now.tables[level], self.now.biases[level], rows, node)
            np.exp(p, out=p)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(p)), target] -= 1
            for k, r in enumerate(rows):
                descend(self.now.tables[level][k], self.squares[level][k], self.times[level][k], r, p, self.rate)

    def moves(self, bucket: int) -> Iterator[pa.RecordBatch]:
        """(bucket, block, times, moves) of the weights since the start, moves as float16."""
        self.flush()
        for block, (level, k, lo) in enumerate(blocks(self.start)):
            move = (self.now.tables[level][k][lo : lo + BLOCK] - self.start.tables[level][k][lo : lo + BLOCK]).astype("<f2")
            times = self.times[level][k][lo : lo + BLOCK].astype("<i8")
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([block], pa.int64()), pa.array([times.tobytes()], pa.binary()), pa.array([move.tobytes()], pa.binary())], ["part", "block", "times", "moves"])


def blocks(weights: Weights) -> list[tuple[int, int, int]]:
    """(level, feature, first row) of each block of rows that travels in one message."""
    return [(level, k, lo) for level in range(LEVELS) for k in range(FEATURES) for lo in range(0, weights.rows, BLOCK)]


# ---- distributed passes -------------------------------------------------------------------------------------------------------


def added(rows: DataFrame, parts: int) -> DataFrame:
    """Vectors (binary int64) in column v of (part, block, v) added up by block in a tree, so that no group is large."""

    def add(key: tuple, t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<i8") for x in t.column("v").to_pylist())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "block": pa.array([key[1].as_py()], pa.int64()), "v": pa.array([total.tobytes()], pa.binary())})

    while True:
        rows = rows.groupBy(F.expr(f"part div {FAN}").alias("_p"), "block").applyInArrow(add, "part long, block long, v binary")
        parts = -(-parts // FAN)
        if parts <= 1:
            return rows


def averaged(rows: DataFrame, parts: int) -> DataFrame:
    """Moves of the buckets averaged by block, each row weighed by its times; a tree, in the order of the buckets."""

    def add(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        times = [np.frombuffer(x, "<i8") for x in t.column("times").to_pylist()]
        total = sum(times)
        move = sum(np.frombuffer(x, "<f2").reshape(len(n), -1).astype(float) * n[:, None] for n, x in zip(times, t.column("moves").to_pylist()))
        mean = (move / np.maximum(total, 1)[:, None]).astype("<f2")
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "block": pa.array([key[1].as_py()], pa.int64()), "times": pa.array([total.tobytes()], pa.binary()), "moves": pa.array([mean.tobytes()], pa.binary())})

    while True:
        rows = rows.groupBy(F.expr(f"part div {FAN}").alias("_p"), "block").applyInArrow(add, "part long, block long, times binary, moves binary")
        parts = -(-parts // FAN)
        if parts <= 1:
            return rows


def tail_counts(counts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """(tail class; tokens, distinct words) of the counted words that aren't in the head."""
    shared = counts.sparkSession.sparkContext.broadcast(vocabulary.values.slice(0, vocabulary.head).cast(pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, head = np.zeros((TAILS, 2), np.int64), shared.value
        for b in batches:
            low = pc.invert(pc.is_in(b.column(0), value_set=head))
            tail, n = tails_of(b.column(0).filter(low).cast(pa.string())), b.column(1).filter(low).to_numpy()
            np.add.at(out, (tail, 0), n)
            np.add.at(out, (tail, 1), 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(TAILS), pa.int32()), pa.array(out[:, 0]), pa.array(out[:, 1])], ["tail", "n", "v"])

    out = np.zeros((TAILS, 2), np.int64)
    for r in counts.select("word", "n").mapInArrow(run, "tail int, n long, v long").groupBy("tail").agg(F.sum("n"), F.sum("v")).collect():
        out[r[0]] = r[1], r[2]
    return out


def like_order(train: DataFrame, head: int) -> np.ndarray:
    """An order of the head words in which words that follow the same words are near each other: halved again and again by the
    first principal direction of the root frequencies of what stands before them."""
    if head < 2:
        return np.arange(head)
    block = max(1, (1 << 16) // PREVIOUS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        k = np.arange(head + TAILS)
        bucket = np.where(k < OWN, k, OWN + (k * 2654435761 >> 7) % (PREVIOUS - OWN))
        flat = np.zeros(head * PREVIOUS, np.int64)
        for b in batches:
            for _, raw in portions(b.column(0).to_pylist(), 1 << 23):
                ids, first, _ = numbers_of(raw)
                ok = np.flatnonzero((ids < head) & (first > 0))
                flat += np.bincount(ids[ok] * PREVIOUS + bucket[ids[ok - 1]], minlength=len(flat))
        part = TaskContext.get().partitionId()
        for k in range(0, head, block):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([k // block], pa.int64()), pa.array([flat[k * PREVIOUS : (k + block) * PREVIOUS].tobytes()], pa.binary())], ["part", "block", "v"])

    seen = np.zeros((head, PREVIOUS))
    for r in added(train.select("ids").mapInArrow(run, "part long, block long, v binary"), train.rdd.getNumPartitions()).collect():
        seen[r["block"] * block : (r["block"] + 1) * block] = np.frombuffer(r["v"], "<i8").reshape(-1, PREVIOUS)
    x = np.sqrt(seen / np.maximum(seen.sum(1, keepdims=True), 1))
    todo, done = [np.arange(head)], []
    while todo:
        own = todo.pop()
        if len(own) <= 2:
            done.append(own)
            continue
        y = x[own] - x[own].mean(0)
        v = np.full(PREVIOUS, PREVIOUS**-0.5)
        for _ in range(6):
            v = y.T @ (y @ v)
            v /= max(np.linalg.norm(v), 1e-12)
        own = own[np.argsort(y @ v, kind="stable")]
        todo += [own[len(own) // 2 :], own[: len(own) // 2]]
    return np.concatenate(done)


class Model:
    """What scoring needs, of bounded size."""

    def __init__(self, vocabulary: Vocabulary, weights: Weights, total: int, distinct: int, tails: np.ndarray):
        self.vocabulary, self.weights, self.total, self.distinct, self.tails = vocabulary, weights, total, distinct, tails

    def log10_of(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 probability of each token; of a tail word without the logarithm of one more than its count."""
        if not hasattr(self, "_single"):
            self._single, self.weights = self.weights.single(), None
        z = self._single.log_probability(ids, first) / np.log(10)
        tail = ids >= self.vocabulary.head
        z[tail] -= np.log10(self.tails.sum(1) + 1.0)[ids[tail] - self.vocabulary.head]
        return z


def dealt(total: int) -> tuple[int, int]:
    """(buckets, rounds) for so many training tokens."""
    buckets = max(min(BUCKETS, total // BUCKET), total // BUCKET_MOST, 1)
    return buckets, min(ROUNDS, buckets)


def trained(table: DataFrame, counts: DataFrame, vocabulary: Vocabulary, total: int, distinct: int, rate: float = 0.3) -> Model:
    """A model of the rows of the table made by encoded() that aren't held out, whose words are counted in counts."""
    spark = table.sparkSession
    train = table.where("round >= 0")
    tails = tail_counts(counts, vocabulary)
    tree = Tree(like_order(train, vocabulary.head))
    rows = int(min(ROWS_MOST, max(ROWS_LEAST, 2 ** round(np.log2(max(total, 1) / TOKENS_A_ROW)))))
    weights = Weights(tree, tree.biases(vocabulary.counts[: vocabulary.head].astype(float), tails[:, 0].astype(float)), rows)
    buckets, rounds = dealt(total)
    tokens = int(min(STEP, max(64, total // STEPS)))
    for number in range(rounds if total else 0):
        start = spark.sparkContext.broadcast(weights)

        def steps(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            bucket, learner = None, None
            for b in batches:
                for k, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if k != bucket:
                        if learner:
                            yield from learner.moves(bucket)
                        bucket, learner = k, Learner(start.value, rate, tokens)
                    learner.add(raw)
            if learner:
                yield from learner.moves(bucket)

        own = table.where(F.col("round") == number).select("bucket", "ids", "doc_id", "h").repartition("bucket").sortWithinPartitions("bucket", "doc_id", "h").select("bucket", "ids")
        moves = own.mapInArrow(steps, "part long, block long, times binary, moves binary")
        got = averaged(moves, buckets).select("block", "moves").toArrow()  # the size of the weights
        where = blocks(weights)
        for block, move in zip(got.column(0).to_pylist(), got.column(1)):
            level, k, lo = where[block]
            t = weights.tables[level][k]  # changed in place: the workers have theirs
            t[lo : lo + BLOCK] = t[lo : lo + BLOCK].astype(np.float32) + np.frombuffer(move.as_buffer(), "<f2").reshape(-1, t.shape[1])
        start.unpersist()
        del got
    return Model(vocabulary, weights, total, distinct, tails)


def scored(table: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of the table made by encoded()."""
    shared = table.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "held_out", "n_tokens", "found", "logs", "tail_logs"]
        for b in batches:
            for start, raw in portions(b.column(7).to_pylist(), 2 * STEP):
                ids, first, n = numbers_of(raw)
                z = np.concatenate([np.zeros(0), *(shared.value.log10_of(ids[max(0, k - 2) : k + STEP], first[max(0, k - 2) : k + STEP])[min(k, 2) :] for k in range(0, len(ids), STEP))])
                cut = b.slice(start, len(raw))
                yield pa.RecordBatch.from_arrays([*cut.columns[:7], pa.array(np.bincount(np.repeat(np.arange(len(n)), n), z, len(n)))], [*names, "model"])

    rows = table.select("row", "doc_id", "held_out", "n_tokens", "found", "logs", "tail_logs", "ids").mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, found long, logs double, tail_logs double, model double")
    least = int(model.vocabulary.counts.min()) if len(model.vocabulary.counts) else 1 << 62
    each = table.select("row", F.explode("words").alias("word"))
    beyond = each.join(counts.where(F.col("n") < least), "word").groupBy("row").agg(F.sum(F.log10(F.col("n") + F.lit(1.0))).alias("more"), F.count("*").alias("known"))
    more = F.coalesce("more", F.lit(0.0))
    whole = F.lit(float(np.log10(model.total + model.distinct + 1.0)))
    return rows.join(beyond, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("found") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * whole).alias("base_score"), (F.col("model") + F.col("tail_logs") + more).alias("score"),
    )


def language_model(docs: DataFrame, held_out, **more) -> tuple[DataFrame, Model, DataFrame]:
    """(table of encoded rows, model of those that aren't held out, counted words)."""
    counts = materialised(counted(docs.where(~held_out)), "word-counts")
    vocabulary, total, distinct = vocabulary_of(counts)
    buckets, rounds = dealt(total)
    table = encoded(docs, vocabulary, held_out, rounds, buckets)
    return table, trained(table, counts, vocabulary, total, distinct, **more), counts


def language_model_scores(docs: DataFrame, held_out=None, **more) -> DataFrame:
    """Trains on the rows of docs that aren't held out and scores all; see scored().

    Null and empty texts have one token, the end. Repeated rows and null ids are scored each by itself; extra columns are not looked
    at. Without any training row the base gives every token probability 1, as its formula says, and the model is uniform.
    """
    held_out = (crc_mod("doc_id", 7) == 2) if held_out is None else held_out
    return scored(*language_model(docs, held_out, **more))


def op6_lm_scoring(spark, sf_dir: str) -> DataFrame:
    short_batches(spark)
    return language_model_scores(documents(spark, sf_dir))
