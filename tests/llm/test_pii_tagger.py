"""The tagger's decoding against all paths, its windows, and what it adds to the patterns on disguised values."""

from __future__ import annotations

from itertools import product

import numpy as np
import pytest

from quire.llm import pii, pii_training as made_up

from .helpers import SF, table


def path_score(t: pii.Tagger, e: np.ndarray, tags: tuple[int, ...]) -> float:
    trans = t.p["t"] + t.illegal
    return (t.p["s"] + t.first)[tags[0]] + sum(e[k, y] for k, y in enumerate(tags)) + sum(trans[a, b] for a, b in zip(tags, tags[1:]))


def legal(tags: tuple[int, ...]) -> bool:
    return all(y == 0 or y % 2 == 1 or (k and tags[k - 1] in (y - 1, y)) for k, y in enumerate(tags))


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_and_posteriors_like_all_paths(seed):
    t, r = pii.Tagger(seed), np.random.default_rng(seed)
    t.p["t"], t.p["s"] = r.normal(0, 1, (pii.TAGS, pii.TAGS)), r.normal(0, 1, pii.TAGS)
    e = r.normal(0, 2, (4, pii.TAGS))
    paths = [p for p in product(range(pii.TAGS), repeat=4) if legal(p)]
    scores = np.array([path_score(t, e, p) for p in paths])
    assert tuple(t.viterbi(e)) == paths[scores.argmax()]
    weights = np.exp(scores - scores.max())
    want = np.zeros((4, pii.TAGS))
    for p, w in zip(paths, weights / weights.sum()):
        want[np.arange(4), p] += w
    post, _, z = t.marginals(e[:, None])
    assert np.allclose(post[:, 0], want, atol=1e-6) and z[0] == pytest.approx(np.log(weights.sum()) + scores.max())


def test_windows_are_merged_like_one_by_one():
    """Emissions of a stretch are the mean of its windows' emissions, weighted by the distance from the window's edge."""
    t, text = pii.Tagger(5), "".join(f" {k % 7}" for k in range(200))
    (stretch,) = pii.stretches(text)
    n, seen = len(text), []
    assert stretch == (0, n)
    want, weight = np.zeros((n, pii.TAGS)), np.zeros(n)
    for start in pii.windows(n):
        x = np.full((pii.WINDOW, 1), pii.SYMBOLS - 1)
        part = pii.symbols(text[start : start + pii.WINDOW])
        x[: len(part), 0] = part
        for k, e in enumerate(t.emissions(x)[: len(part), 0]):
            w = min(k + 1, pii.WINDOW - k)
            want[start + k] += w * e
            weight[start + k] += w
    assert weight.min() > 0
    keep = t.viterbi
    t.viterbi = lambda e: seen.append(e) or keep(e)
    pii.found([text], t)
    assert np.allclose(seen[0], want / weight[:, None])


def test_stretches_hold_every_mark():
    for text, marks in (("x" * 300 + "a (at) b" + "y" * 300, 1), ("n AT host DOT org", 1), ("look at me", 0), ("x" * 100 + "٣" + "x" * 100, 1), ("a＠b", 1), ("", 0)):
        assert len(pii.stretches(text)) == marks, text
    ((a, b),) = pii.stretches("x" * 300 + "7" + "y" * 300)
    assert b - a >= pii.WINDOW


def test_plausible():
    yes = [("email", "a (at) b (dot) c"), ("email", "a＠b.c"), ("ip", "1[.]2[.]3[.]255"), ("card", "4111/1111/1111/1111"), ("phone", "0049 30 1234567")]
    no = [("email", "a at b"), ("email", "@b.c"), ("ip", "1.2.3.256"), ("ip", "1.2.3"), ("card", "4111/1111/1111/1112"), ("phone", "12 34"), ("email", ""), ("ip", ""), ("card", ""), ("phone", "")]
    assert all(pii.plausible(*x) for x in yes) and not any(pii.plausible(*x) for x in no)


def test_made_values_are_what_they_are_called():
    r = np.random.default_rng(0)
    for _ in range(300):
        for kind, make in made_up.MAKERS.items():
            plain, hidden = make(r, False), make(r, True)
            assert (kind, 0, len(plain)) in pii.base_spans(plain), plain
            assert pii.plausible(kind, hidden), hidden


def test_tagger_adds_disguised_spans_and_leaves_clean_texts(spark):
    tagger = pii.fitted(spark.read.parquet(f"{SF}/documents.parquet"))
    texts = [x["text"] for x in table("documents", "doc_id", "text") if x["text"]]
    added = [s for t, g in zip(texts, pii.found(texts, tagger)) for s in set(pii.all_spans(t, pii.base_spans(t), g)) - set(pii.base_spans(t))]
    assert len(added) <= len(texts) / 200
    cases = made_up.made([t[:240] for t in texts if not pii.base_spans(t[:240])], 600, seed=4321)
    right = wrong = missed = 0
    for (text, own), got in zip(cases, pii.found([t for t, _ in cases], tagger)):
        base = pii.base_spans(text)
        more = set(pii.all_spans(text, base, got)) - set(base)
        right, wrong, missed = right + len(more & set(own)), wrong + len(more - set(own)), missed + len(set(own) - set(base) - more)
    assert right >= 0.75 * (right + missed) and right >= 0.95 * (right + wrong)
