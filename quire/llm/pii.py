"""Personal data: exact patterns, and a character tagger (bidirectional LSTM with CRF transitions) that adds to them.

The tagger is trained in numpy on labelled spans: those that the patterns verified in a bounded sample of texts, and made-up ones,
plain and disguised, set into such texts (pii_training.py). It reads overlapping windows around every digit of any script, every
at-sign and every spelled-out one, without which none of the four kinds is written; text further than MARGIN from all of these
isn't read. The windows' emissions are averaged by their distance from the window's edge, and one Viterbi pass over each stretch
of windows reconciles them globally. Spans of the patterns always stay; the tagger adds spans that touch none of them, of which it
is sure and whose digits can be what they are taken for.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import documents
from .pii_training import made

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
HIDDEN, WINDOW, STRIDE, MARGIN = 16, 96, 48, 48
#: Stretches of text that the tagger is trained on at most, windows of them, gradient steps of BATCH windows, how sure it must be of a span.
SAMPLE, WINDOWS, STEPS, BATCH, SURE = 12_000, 6_000, 700, 96, 0.8

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[\d@＠]")
AT = re.compile(r"[(\[{<]\s?+[Aa][Tt]\s?+[)\]}>]")
BARE_AT = re.compile(r"\b[Aa][Tt]\b(?=\s++[A-Za-z0-9-]++\s++[Dd][Oo][Tt]\b)")
DOT_WORD = re.compile(r"\b[Dd][Oo][Tt]\b")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the verified matches, by kind as in KINDS, then start. Linear in the text."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", at + 1)
    if TRIGGER.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x[-4:]) <= 255 and not x[:-4].strip("0") for x in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_SYMBOLS = {c: k for k, c in enumerate("abcdefghijklmnopqrstuvwxyz")} | {c: 26 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: 27 for c in "0123456789"} | {c: 28 + k for k, c in enumerate("@.-+_()% \n\"=/:,")}
_SYMBOLS |= {c: _SYMBOLS[like] for like, alike in {"(": "[{<", ")": "]}>", "@": "＠", " ": "\u00a0\t"}.items() for c in alike}
OTHER = max(_SYMBOLS.values()) + 1  # other characters; one more: beyond the text
SYMBOLS = OTHER + 2


def symbols(text: str) -> np.ndarray:
    return np.fromiter((_SYMBOLS[c] if c in _SYMBOLS else _SYMBOLS["0"] if c.isdecimal() else OTHER for c in text), np.int64, len(text))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Weights of the network, its forward pass, training and decoding."""

    def __init__(self, seed: int = 7):
        r, h = np.random.default_rng(seed), HIDDEN
        self.p = {
            **{f"x{d}": r.normal(0, 0.3, (SYMBOLS, 4 * h)) for d in "fb"}, **{f"h{d}": r.normal(0, 0.2, (h, 4 * h)) for d in "fb"},
            **{f"c{d}": np.r_[np.zeros(h), np.ones(h), np.zeros(2 * h)] for d in "fb"},  # the forget gates start open
            "o": r.normal(0, 0.2, (2 * h, TAGS)), "ob": np.zeros(TAGS), "t": np.zeros((TAGS, TAGS)), "s": np.zeros(TAGS),
        }
        legal = np.zeros((TAGS, TAGS), bool)
        for to in range(TAGS):
            legal[:, to] = to == 0 or to % 2 == 1
            if to and to % 2 == 0:
                legal[[to - 1, to], to] = True
        self.illegal = np.where(legal, 0.0, -1e4)
        self.first = np.where([t == 0 or t % 2 == 1 for t in range(TAGS)], 0.0, -1e4)

    def _lstm(self, d: str, x: np.ndarray, keep: bool):
        """Hidden states (time, batch, h) over x (time, batch), and what the backward pass needs."""
        h, c, n = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN)), HIDDEN
        out, tape = np.empty((*x.shape, n)), []
        for t in range(len(x)):
            z = self.p[f"x{d}"][x[t]] + h @ self.p[f"h{d}"] + self.p[f"c{d}"]
            g = _sigmoid(z[:, : 3 * n])
            u = np.tanh(z[:, 3 * n :])
            c_new = g[:, n : 2 * n] * c + g[:, :n] * u
            a = np.tanh(c_new)
            h_new = g[:, 2 * n :] * a
            if keep:
                tape.append((g, u, c, a, h))
            h, c, out[t] = h_new, c_new, h_new
        return out, tape

    def _lstm_back(self, d: str, x: np.ndarray, tape: list, dout: np.ndarray, grads: dict) -> None:
        n = HIDDEN
        dh, dc = np.zeros((x.shape[1], n)), np.zeros((x.shape[1], n))
        at_z = np.empty((*x.shape, 4 * n))
        for t in range(len(x) - 1, -1, -1):
            g, u, c, a, h = tape[t]
            dh = dh + dout[t]
            dc = dc + dh * g[:, 2 * n :] * (1 - a * a)
            dz = np.concatenate([dc * u, dc * c, dh * a], 1) * g * (1 - g)
            dz = np.concatenate([dz, dc * g[:, :n] * (1 - u * u)], 1)
            at_z[t] = dz
            dh, dc = dz @ self.p[f"h{d}"].T, dc * g[:, n : 2 * n]
        flat, before = at_z.reshape(-1, 4 * n), np.concatenate([step[4] for step in tape])
        grads[f"x{d}"], grads[f"h{d}"], grads[f"c{d}"] = (x.reshape(-1) == np.arange(SYMBOLS)[:, None]).astype(float) @ flat, before.T @ flat, flat.sum(0)

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(time, batch, tags) for symbols (time, batch)."""
        f, _ = self._lstm("f", x, False)
        b, _ = self._lstm("b", x[::-1], False)
        return np.concatenate([f, b[::-1]], 2) @ self.p["o"] + self.p["ob"]

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Posterior of each tag (time, batch, tags), expected transitions summed, and log normaliser, for emissions e."""
        trans, start = self.p["t"] + self.illegal, self.p["s"] + self.first
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + start
        for t in range(1, len(e)):
            alpha[t] = _lse(alpha[t - 1][:, :, None] + trans, 1) + e[t]
        z = _lse(alpha[-1], 1)
        pairs = np.zeros((TAGS, TAGS))
        for t in range(len(e) - 2, -1, -1):
            after = (e[t + 1] + beta[t + 1])[:, None, :] + trans
            pairs += np.exp(alpha[t][:, :, None] + after - z[:, None, None]).sum(0)
            beta[t] = _lse(after, 2)
        return np.exp(alpha + beta - z[None, :, None]), pairs, z

    def step(self, x: np.ndarray, y: np.ndarray, moments: dict, k: int, rate: float) -> float:
        """One Adam step on the CRF's negative log-likelihood of tags y (time, batch); returns the loss a window."""
        f, tape_f = self._lstm("f", x, True)
        b, tape_b = self._lstm("b", x[::-1], True)
        hidden = np.concatenate([f, b[::-1]], 2)
        e = hidden @ self.p["o"] + self.p["ob"]
        post, pairs, z = self.marginals(e)
        n = x.shape[1]
        gold = np.zeros_like(e)
        np.put_along_axis(gold, y[:, :, None], 1.0, 2)
        score = (e * gold).sum() + (self.p["s"] + self.first)[y[0]].sum() + (self.p["t"] + self.illegal)[y[:-1], y[1:]].sum()
        de, grads = (post - gold) / n, {}
        counts = np.zeros((TAGS, TAGS))
        np.add.at(counts, (y[:-1], y[1:]), 1)
        grads["t"], grads["s"] = (pairs - counts) / n, de[0].sum(0)
        grads["o"], grads["ob"] = hidden.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, TAGS), de.sum((0, 1))
        back = de @ self.p["o"].T
        self._lstm_back("f", x, tape_f, back[:, :, :HIDDEN], grads)
        self._lstm_back("b", x[::-1], tape_b, back[::-1, :, HIDDEN:], grads)
        norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
        for name, g in grads.items():
            m, v = moments.setdefault(name, [np.zeros_like(g), np.zeros_like(g)])
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            self.p[name] -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        return float(z.sum() - score) / n

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best tags of emissions (time, tags)."""
        trans = self.p["t"] + self.illegal
        best, back = e[0] + self.p["s"] + self.first, np.zeros((len(e), TAGS), np.int8)
        for t in range(1, len(e)):
            options = best[:, None] + trans
            back[t] = options.argmax(0)
            best = options[back[t], np.arange(TAGS)] + e[t]
        tags = np.empty(len(e), np.int64)
        tags[-1] = best.argmax()
        for t in range(len(e) - 1, 0, -1):
            tags[t - 1] = back[t, tags[t]]
        return tags


def stretches(text: str) -> list[tuple[int, int]]:
    """Merged stretches [a, b) of text around all digits, at-signs and spelled-out ones, MARGIN characters to either side: a window long, or up to an end of the text."""
    at = [m.start() for m in TRIGGER.finditer(text)] + [m.start() for m in AT.finditer(text)]
    if DOT_WORD.search(text):
        at += [m.start() for m in BARE_AT.finditer(text)]
    out: list[list[int]] = []
    for k in sorted(at):
        a, b = max(0, k - MARGIN), min(len(text), k + MARGIN + 1)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def windows(length: int) -> list[int]:
    """Starts of windows, STRIDE apart, that cover length."""
    return list(range(0, max(1, length - (WINDOW - STRIDE)), STRIDE))


_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(float)


def found(texts: list[str], tagger: Tagger, sure: float = SURE, batch: int = 1024) -> list[list[tuple[str, int, int]]]:
    """Spans that the tagger finds in each text, over the whole text."""
    jobs = [(d, a, b) for d, t in enumerate(texts) for a, b in stretches(t)]
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    held: list[tuple[int, int, int]] = []
    n = 0

    def flush() -> None:
        starts = [(k, w) for k, (_, a, b) in enumerate(held) for w in windows(b - a)]
        x = np.full((WINDOW, len(starts)), SYMBOLS - 1)
        for col, (k, w) in enumerate(starts):
            d, a, b = held[k]
            s = symbols(texts[d][a + w : min(b, a + w + WINDOW)])
            x[: len(s), col] = s
        e = np.concatenate([tagger.emissions(x[:, k : k + batch]) for k in range(0, len(starts), batch)], 1)
        total = {k: [np.zeros((b - a, TAGS)), np.zeros(b - a)] for k, (_, a, b) in enumerate(held)}
        for col, (k, w) in enumerate(starts):
            sums, weight = total[k]
            m = min(WINDOW, len(weight) - w)
            sums[w : w + m] += e[:m, col] * _WEIGHT[:m, None]
            weight[w : w + m] += _WEIGHT[:m]
        for k, (d, a, b) in enumerate(held):
            merged = total[k][0] / total[k][1][:, None]
            tags = tagger.viterbi(merged)
            if not tags.any():
                continue
            post = tagger.marginals(merged[:, None])[0][:, 0]
            at = 0
            while at < len(tags):
                if tags[at] % 2 == 1:
                    end = at + 1
                    while end < len(tags) and tags[end] == tags[at] + 1:
                        end += 1
                    if post[np.arange(at, end), tags[at:end]].min() >= sure:
                        out[d].append((KINDS[tags[at] // 2], a + at, a + end))
                    at = end
                else:
                    at += 1

    for job in jobs:
        held.append(job)
        n += job[2] - job[1]
        if n > 1 << 17:
            flush()
            held, n = [], 0
    if held:
        flush()
    return out


def plausible(kind: str, text: str) -> bool:
    """Whether the marks and digits of text can be those of its kind; cards pass Luhn, as those of the patterns do."""
    digits = "".join(str(int(c)) for c in text if c.isdecimal())
    if kind == "email":
        at = [m.start() for m in re.finditer(r"[@＠]|(?i:\bat\b)", text)]
        return bool(at) and at[0] > 0 and bool(re.search(r"\.|(?i:\bdot\b)", text[at[0] :]))
    if kind == "ip":
        parts = re.findall(r"\d++", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 7 <= len(digits) <= 15


def all_spans(text: str, base: list[tuple[str, int, int]], more: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """base and those of more that are plausible and touch none of base."""
    extra = [(k, a, b) for k, a, b in more if plausible(k, text[a:b]) and all(b <= x or a >= y for _, x, y in base)]
    return sorted(base + extra, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def training_windows(texts: list[str], most: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags (time, windows), at most most: half around made values; else around verified spans, other triggers and anywhere."""
    r = np.random.default_rng(seed)
    spans = [base_spans(t) for t in texts]
    at = [(d, a) for d, s in enumerate(spans) for _, a, _ in s]
    other = [(d, a) for d, t in enumerate(texts) for a, b in stretches(t) if all(b <= x or a >= y for _, x, y in spans[d])]
    at = [at[k] for k in r.permutation(len(at))[: most // 4]]
    other = [other[k] for k in r.permutation(len(other))[: most // 8]]
    free = [(d, int(r.integers(len(texts[d])))) for d in r.permutation(len(texts))[: most // 8] if texts[d]]
    rows = [(texts[d], spans[d], a) for d, a in at + other + free]
    bare = [t for t, s in zip(texts, spans) if not s]
    rows += [(t, s, s[0][1] if s else int(r.integers(len(t)))) for t, s in made(bare, most // 2, seed)]
    x, y = [], []
    for text, own, a in rows:
        start = max(0, a - int(r.integers(WINDOW)))
        s, tags = symbols(text[start : start + WINDOW]), np.zeros(WINDOW, np.int64)
        for kind, p, q in own:
            p, q = p - start, min(q - start, WINDOW)
            if q > 0 and p < WINDOW:
                tag = 1 + 2 * KINDS.index(kind)
                tags[max(p, 0) : q] = tag + 1
                tags[max(p, 0)] = tag
        x.append(np.r_[s, np.full(WINDOW - len(s), SYMBOLS - 1)])
        y.append(tags)
    return np.array(x, np.int64).reshape(-1, WINDOW).T, np.array(y, np.int64).reshape(-1, WINDOW).T


def contexts(docs: DataFrame, most: int = SAMPLE) -> list[str]:
    """At most most different stretches of up to 241 characters around digits and at-signs, chosen by hash from all texts."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    n = texts.count()
    if n > most:  # the least hashes of a part of the texts that holds most of them or so
        texts = texts.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < F.lit(max(1, int(1_000_000 * most / n))))
    near = r"(?s).{0,120}[0-9@].{0,120}"
    parts = texts.select(F.explode(F.regexp_extract_all("text", F.lit(near), F.lit(0))).alias("t")).distinct()
    return [r[0] for r in parts.orderBy(F.xxhash64("t"), "t").limit(most).collect()]


def fitted(docs: DataFrame, most: int = SAMPLE, steps: int = STEPS) -> Tagger | None:
    """A tagger trained on windows of at most most stretches of the corpus; None if no text holds a digit or an at-sign."""
    x, y = training_windows(contexts(docs, most), WINDOWS)
    if not x.size:
        return None
    tagger, moments, k, r = Tagger(), {}, 0, np.random.default_rng(3)
    while k < steps:
        order = r.permutation(x.shape[1])
        for a in range(0, len(order), BATCH):
            k += 1
            tagger.step(x[:, order[a : a + BATCH]], y[:, order[a : a + BATCH]], moments, k, 0.02 if k < steps // 2 else 0.006)
    return tagger


def tagged(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row of docs.

    The counts and the digest are of the patterns' spans; spans are all, kind:start:end in code points. Null and empty texts have
    none; repeated rows and null ids are looked at each by itself; extra columns are not.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            more = found(texts, shared.value) if shared.value is not None else [[] for _ in texts]
            counts = [[sum(s[0] == k for s in spans) for spans in base] for k in KINDS]
            digest = [hashlib.sha256(joined(s).encode()).hexdigest() for s in base]
            spans = [joined(all_spans(*x)) for x in zip(texts, base, more)]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()), pa.array(spans, pa.string())], names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def op8_pii(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return tagged(docs, fitted(docs))
