"""Toxicity from a learned lexicon, matched through Levenshtein automata.

Words and word beginnings that labelled toxic texts have and others don't make up a lexicon, kept as a trie. The Levenshtein
automata of all its terms, intersected with the trie, are one automaton: its states are sets of (trie node, errors), made when
first reached, so that a word costs a table lookup a letter and most words leave it after a few. Each hit is weighed by its context:
in quotation marks, or near a word of reporting, it counts as quotation. Counts of hits by kind go into a logistic model.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import crc_mod, documents, pinned

#: Labelled rows that are fitted on at most (a sample by hash), and terms of the lexicon.
SAMPLE, TERMS = 20_000, 4_000
#: Tokens on either side that are a hit's context, and entries of a worker's word cache.
CONTEXT, CACHE = 6, 400_000
OPEN, CLOSE = "\"'“„«‚‘‹", "\"'”“»’›"
REPORTING = frozenset("said says say quote quoted quotes called calls wrote writes word term reported dice dijo dit sagt sagte".split())
NONE, EXACT, STEM, NEAR = 0, 1, 2, 3


def bare(token: str) -> str:
    """token without the marks around it."""
    a, b = 0, len(token)
    while a < b and not token[a].isalnum():
        a += 1
    while b > a and not token[b - 1].isalnum():
        b -= 1
    return token[a:b]


def allowed(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class Lexicon:
    """words and stems as a trie, with the determinised union of their Levenshtein automata; a stem fits any word that begins with it."""

    def __init__(self, words: list[str], stems: list[str], benign: list[str] = (), states: int = 500_000):
        self.words, self.stems, self.benign, self.most = list(words), list(stems), frozenset(benign), states
        self.child: list[dict[str, int]] = [{}]
        self.term: list[int] = [-1]  # errors that a word ending here may have
        self.stem: list[bool] = [False]
        self.limit: list[int] = [0]  # most errors of any word below
        for w in self.words:
            self.term[self._add(w, allowed(len(w)))] = allowed(len(w))
        for w in self.stems:
            self.stem[self._add(w, 0)] = True
        self.reset()

    def _add(self, word: str, errors: int) -> int:
        node = 0
        self.limit[0] = max(self.limit[0], errors)
        for c in word:
            if c not in self.child[node]:
                self.child[node][c] = len(self.child)
                self.child.append({})
                self.term.append(-1)
                self.stem.append(False)
                self.limit.append(0)
            node = self.child[node][c]
            self.limit[node] = max(self.limit[node], errors)
        return node

    def reset(self) -> None:
        self.sets: list[frozenset] = []
        self.known: dict[frozenset, int] = {}
        self.step: list[dict[str, int]] = []
        self.final: list[int] = []
        self._state({0: 0})

    def _state(self, least: dict[int, int]) -> int:
        """The number of the state that has these nodes with their fewest errors, closed under letters that the word lacks."""
        todo = list(least.items())
        while todo:
            node, e = todo.pop()
            for c in self.child[node].values():
                if e < self.limit[c] and e + 1 < least.get(c, 99):
                    least[c] = e + 1
                    todo.append((c, e + 1))
        key = frozenset(least.items())
        if key not in self.known:
            self.known[key] = len(self.sets)
            self.sets.append(key)
            self.step.append({})
            ends = [e for n, e in key if 0 <= e <= self.term[n]]
            self.final.append((EXACT if min(ends) == 0 else NEAR) if ends else NONE)
        return self.known[key]

    def _next(self, state: int, c: str) -> int:
        """The state after c; -1: nothing fits any more, -2: a stem fits."""
        least: dict[int, int] = {}
        for node, e in self.sets[state]:
            for d, child in self.child[node].items():
                cost = e + (c != d)
                if cost <= self.limit[child] and cost < least.get(child, 99):
                    if cost == 0 and self.stem[child]:
                        return -2
                    least[child] = cost
            if e < self.limit[node] and e + 1 < least.get(node, 99):
                least[node] = e + 1
        return self._state(least) if least else -1

    def match(self, word: str) -> int:
        if len(self.sets) > self.most:
            self.reset()
        state = 0
        for c in word:
            to = self.step[state].get(c)
            if to is None:
                to = self.step[state][c] = self._next(state, c)
            if to < 0:
                return STEM if to == -2 else NONE
            state = to
        kind = self.final[state]
        return NONE if kind == NEAR and word in self.benign else kind


class Kinds(dict):
    """Kinds of tokens, found on demand."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def __missing__(self, token: str) -> int:
        kind = self.lexicon.match(bare(token))
        if len(self) < CACHE:
            self[token] = kind
        return kind


def quoted(tokens: list[str], at: int) -> bool:
    """Whether the token stands in quotation marks, or near a word of reporting."""
    before, after = tokens[max(0, at - CONTEXT) : at + 1], tokens[at : at + CONTEXT + 1]
    if any(t[0] in OPEN for t in before) and any(t.rstrip(".,;:!?")[-1:] in CLOSE and t.rstrip(".,;:!?") for t in after):
        return True
    return any(bare(t) in REPORTING for t in before + after)


def features(text: str, kinds: Kinds) -> list[float]:
    tokens = text.lower().split()
    found = list(map(kinds.__getitem__, tokens))
    n = [0, 0, 0, 0]
    in_quotes = 0
    if any(found):
        for at, kind in enumerate(found):
            if kind:
                n[kind] += 1
                in_quotes += quoted(tokens, at)
    hits = n[1] + n[2] + n[3]
    return [math.log1p(n[EXACT]), math.log1p(n[STEM]), math.log1p(n[NEAR]), math.log1p(in_quotes), float(n[1] + n[2] > 0), math.log1p(100 * hits / (len(tokens) + 20))]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights and bias by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w, penalty = np.zeros(x.shape[1]), np.r_[np.full(x.shape[1] - 1, ridge), 1e-3]
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, toxic) of at most about most labelled rows outside the held-out fold, chosen by a hash of the id."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(crc_mod("doc_id", 5) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = rows.count()
    if n > most:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * most / n)))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(rows), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def _frequencies(sample: DataFrame) -> DataFrame:
    """(term, stem, toxic, clean): in how many sampled texts of either label a word, or a beginning of 4 to 6 letters, stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = Counter(), Counter()

        def rows() -> pa.RecordBatch:
            keys = list(counts[0].keys() | counts[1].keys())
            out = pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), *(pa.array([counts[i][k] for k in keys], pa.int64()) for i in (1, 0))], ["term", "stem", "toxic", "clean"])
            counts[0].clear()
            counts[1].clear()
            return out

        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = {w for w in map(bare, set((text or "").lower().split())) if len(w) > 2}
                own = counts[int(toxic > 0)]
                own.update((w, False) for w in words)
                own.update({(w[:k], True) for w in words for k in (4, 5, 6) if len(w) >= k})
                if len(own) > CACHE:
                    yield rows()
        yield rows()

    return sample.mapInArrow(run, "term string, stem boolean, toxic long, clean long").groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


class Model:
    """A lexicon and the weights of its features; base is the score where there is nothing to learn from."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray | None, base: float = 0.0):
        self.lexicon, self.weights, self.base = lexicon, weights, base
        self.kinds = Kinds(lexicon)

    def __reduce__(self):
        return Model._made, (self.lexicon.words, self.lexicon.stems, sorted(self.lexicon.benign), self.weights, self.base)

    @staticmethod
    def _made(words, stems, benign, weights, base) -> Model:
        return Model(Lexicon(words, stems, benign), weights, base)

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.base
        x = float(np.dot(features(text, self.kinds), self.weights[:-1]) + self.weights[-1])
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def fitted(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, terms: int = TERMS, least: int = 3, share: float = 0.003, odds: float = 25.0) -> Model:
    """A model from at most most labelled rows. A term is in at least least and share of the toxic texts, and odds times likelier there."""
    spark = docs.sparkSession
    sample = pinned(_sample(docs, labels, most))
    size = {int(r[0] > 0): 0 for r in sample.select("toxic").distinct().collect()}
    for r in sample.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect():
        size[r[0]] = r[1]
    if not size.get(0) or not size.get(1):
        return Model(Lexicon([], []), None, float(bool(size.get(1))))
    counts = pinned(_frequencies(sample))
    least = max(least, math.ceil(share * size[1]))
    ratio = (F.col("toxic") / size[1]) / ((F.col("clean") + 0.5) / size[0])
    chosen = counts.where((F.col("toxic") >= least) & (ratio >= odds)).orderBy(F.desc("toxic"), "term", "stem").limit(terms).collect()
    stems = sorted({r["term"] for r in chosen if r["stem"] and r["toxic"] >= 2 * least}, key=len)
    stems = [s for k, s in enumerate(stems) if not any(s.startswith(t) for t in stems[:k])]
    words = [r["term"] for r in chosen if not r["stem"]]
    lexicon = spark.sparkContext.broadcast(Model(Lexicon(words, stems), None))

    def like(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = lexicon.value.lexicon.match
        for b in batches:
            yield b.filter(pa.array([match(w) == NEAR for w in b.column(0).to_pylist()], pa.bool_()))

    # words like a term that stand in clean texts are no misspellings of it
    benign = counts.where("NOT stem AND clean > 0").where(ratio < odds).select("term", "clean").mapInArrow(like, "term string, clean long").orderBy(F.desc("clean"), "term").limit(terms * 5).collect()
    model = Model(Lexicon(words, stems, [r[0] for r in benign]), None)
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t or "", shared.value.kinds) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1)], ["x", "toxic"])

    rows = sample.mapInArrow(measure, "x array<double>, toxic int").collect()  # at most `most`
    rows.sort(key=lambda r: (r["x"], r["toxic"]))
    model.weights = logistic(np.array([r["x"] for r in rows]), np.array([r["toxic"] > 0 for r in rows], float))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs; null and empty texts score as texts without a hit."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = np.array([shared.value.score(t or "") for t in b.column(2).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc_mod("doc_id", 5) == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(docs, fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
