"""The language model against a token-by-token version, as a distribution, over different layouts, and its gain on held-out rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import maxent

from .helpers import ODD, docs_frame

M32 = (1 << 32) - 1


def corpus(n=120, seed=1):
    r = random.Random(seed)
    words = [f"w{int(r.paretovariate(0.8))}" for _ in range(60)] + ["é1", "X,", "a-b"]
    out = []
    for _ in range(n):
        text = [r.choice(words)]
        while len(text) < r.randrange(2, 60):
            text.append(words[(words.index(text[-1]) * 7 + r.randrange(4)) % len(words)])
        out.append(" ".join(text))
    return out


def shape(word):
    if not word.isascii():
        return 2
    return 0 if word.isalpha() else 1 if word[:-1].isalpha() else 3


def mix(x, odd):
    x = x * odd & M32
    x ^= x >> 15
    return x * 0x2C1B3C6D & M32


def brute_log10(model, counts, history, word):
    """log10 P(word | history) by plain Python: history are words from a text's start, counts of all training words."""
    v, w, tree = model.vocabulary, model.weights, model.weights.tree
    number = {x: k for k, x in enumerate(v.words[: v.head])}
    of = lambda x: number.get(x.encode(), v.head + shape(x))
    a, b = ([0, 0] + [of(x) + 1 for x in history])[-1:-3:-1]
    out, i = 0.0, of(word)
    for level in range(3 if i < v.head else 1):
        node = int(tree.node[level][i])
        keys = (a * 0x9E3779B1 + 1, (a * 0x85EBCA6B + b) * 0xC2B2AE35 + 2, b * 0x27D4EB2F + 3)
        rows = [mix((k & M32) ^ (node * 0x165667B1 & M32), odd) >> (33 - w.rows.bit_length()) for k, odd in zip(keys, (0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F))]
        z = [float(w.biases[level][node, j]) + sum(float(t[r, j]) for t, r in zip(w.tables[level], rows)) for j in range(tree.width[level])]
        out += z[int(tree.target[level][i])] - math.log(sum(math.exp(x) for x in z))
    out /= math.log(10)
    if i >= v.head:
        n, distinct = model.tails[i - v.head]
        out += math.log10((counts.get(word, 0) + 1) / (n + distinct + 1))
    return out


@pytest.fixture(scope="module")
def fitted(spark):
    texts = corpus()
    docs = docs_frame(spark, texts + ["never seen Words,, 日本 x1", "", None])
    held_out = F.col("doc_id") % 5 == 1
    table, model, counts = maxent.language_model(docs, held_out)
    return texts, docs, held_out, model, {bytes(r["word"]).decode(): r["n"] for r in counts.collect()}


def test_scores_like_brute_force(spark, fitted):
    texts, docs, held_out, model, counts = fitted
    assert 1 < model.vocabulary.head < len(counts) and any(t.any() for level in model.weights.tables for t in level)
    rows = {r["doc_id"]: r["score"] for r in maxent.language_model_scores(docs, held_out).collect()}
    for r in docs.collect():
        tokens = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in (r["text"] or "").split()] + [""]
        assert rows[r["doc_id"]] == pytest.approx(sum(brute_log10(model, counts, tokens[:k], t) for k, t in enumerate(tokens)), rel=1e-4, abs=1e-4)


def test_probabilities_sum_to_one(fitted):
    _, _, _, model, counts = fitted
    for history in ([], ["w1"], ["w2", "w1"], ["é1", "unheard"], ["w1", "w3", "X,"]):
        unknown = ["zzz", "zz,", "zé", "9-9"]  # one of each shape
        assert {shape(x) for x in unknown} == {0, 1, 2, 3} and not set(unknown) & set(counts)
        total = sum(10 ** brute_log10(model, counts, history, w) for w in [*counts, *unknown])
        assert total == pytest.approx(1.0, abs=1e-5)


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(maxent, "BUCKET", 500)  # several buckets and rounds on a small corpus
    docs = docs_frame(spark, corpus(200, 2) + ODD)
    assert maxent.dealt(4000)[0] > 4
    one, many = ({r["doc_id"]: (r["base_score"], r["score"]) for r in maxent.language_model_scores(docs.repartition(n, *by)).collect()} for n, by in ((1, ()), (8, (F.rand(3),))))
    assert one == many


def test_gain_on_held_out_rows(spark):
    docs = docs_frame(spark, corpus(400, 3))
    rows = maxent.language_model_scores(docs).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert (rows[0] - rows[1]) / rows[2] > 0.2  # log10 a token: these words depend on the last


def test_steps_follow_the_gradient():
    """A step's gradient against differences of the loss, and rows that are met often against those summed one by one."""
    r = np.random.default_rng(4)
    tree = maxent.Tree(np.arange(30))
    weights = maxent.Weights(tree, tree.biases(np.ones(30), np.ones(4)), 64)
    for level in weights.tables:
        for t in level:
            t += r.normal(0, 0.3, t.shape).astype(t.dtype)
    ids, first = r.integers(0, 34, 400), np.arange(400)
    before = maxent.histories(ids, first)
    learner = maxent.Learner(weights, 1e-3)
    learner.step(ids, before)
    single = weights.single()
    loss = lambda: -single.log_probability(ids, first).sum()
    for level in range(3):
        for k in range(3):
            t, moved = single.tables[level][k], learner.now.tables[level][k] - weights.tables[level][k]
            for row, out in zip(r.integers(0, 64, 6), r.integers(0, tree.width[level], 6)):
                t[row, out] += 0.01
                up = loss()
                t[row, out] -= 0.02
                down = loss()
                t[row, out] += 0.01
                gradient = (up - down) / 0.02
                want = -1e-3 * gradient / math.sqrt(learner.squares[level][k][row] + 1)
                assert moved[row, out] == pytest.approx(want, rel=0.05, abs=2e-5)


def test_model_grows_with_the_corpus():
    assert maxent.dealt(0) == (1, 1) and maxent.dealt(1 << 20) == (4, 4) and maxent.dealt(1 << 40)[0] == 1 << 16
