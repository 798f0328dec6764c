"""The pipeline against the brute-force versions of its stages."""

import corpus_pipeline
from quire.llm.decontamination import Index
from quire.llm.packing import WordIds, tokenizer_path

from .helpers import ODD, SF, docs_frame, table
from .test_near_copies import brute_pairs
from .test_simhash import brute_components, brute_fingerprint
from .test_text_operators import brute_counts, brute_dedup


def brute_hosts(rows, failed):
    n, f = {}, {}
    for r in rows:
        n[r["source"]] = n.get(r["source"], 0) + 1
        f[r["source"]] = f.get(r["source"], 0) + failed[r["doc_id"]]
    total, mean = sum(n.values()), sum(f.values()) / sum(n.values())
    spread = sum(n[h] * (f[h] / n[h] - mean) ** 2 for h in n) / total - mean * (1 - mean) * len(n) / total
    strength = min(1e6, max(1.0, mean * (1 - mean) / max(spread, 1e-9) - 1))
    return {h: (f[h] + mean * strength) / (n[h] + strength) for h in n}


def brute_near_copies(ids, texts):
    """The smallest id of each row's component: linked by fingerprints of at most 3 differing bits, or by five-word shingles with a similarity of at least 0.8."""
    root = brute_components(ids, [brute_fingerprint(t) for t in texts])
    links = [(root[i], root[j]) for i, j in brute_pairs(texts)]
    while True:
        name = {}
        for a, b in links:
            name[max(a, b)] = min(name.get(max(a, b), a), a, b)
        name = {a: b for a, b in name.items() if a != b}
        if not name:
            return root
        root = [name.get(r, r) for r in root]
        links = [(name.get(a, a), name.get(b, b)) for a, b in links]


def brute_pipeline(docs, items):
    failed = {}
    for d in docs:
        n, _, symbols, dup, _, base = brute_counts(d["text"])
        lines = sum(bool(x.strip(" \t\n\x0b\x0c\r")) for x in (d["text"] or "").split("\n"))
        failed[d["doc_id"]] = base or 100 * symbols > 30 * n or 100 * dup > 60 * lines
    rates = brute_hosts(docs, failed)
    kept = [d for d in docs if not failed[d["doc_id"]] and rates[d["source"]] <= 0.5]
    cut = brute_dedup([(d["doc_id"], d["text"], d["source"]) for d in kept], long_sites=2)
    ids = [d["doc_id"] for d in kept]
    roots = brute_near_copies(ids, [cut[i][0] for i in ids])
    index = Index(items)
    texts = {i: cut[i][0] or "" for i, r in zip(ids, roots) if i == r}
    return {i: t for i, t in texts.items() if not index.leaks([t.encode()])}


def test_pipeline_like_brute_force(spark):
    want = brute_pipeline(table("documents"), [(r["item_id"], r["text"].encode()) for r in table("benchmark")])
    words, rows = WordIds(tokenizer_path("word_bpe_49k.json")), corpus_pipeline.run(spark, SF).collect()
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert 0 < len(want) < 1000 and got == {i: len(words.whole(t)) // 4 + 1 for i, t in want.items()}
    size = {}
    for r in rows:
        size[r["sequence_id"]] = size.get(r["sequence_id"], 0) + r["length"]
    assert max(size.values()) <= 2048 and len(size) <= -(-sum(size.values()) // 2048) + 2


def test_stages_on_odd_and_empty_tables(spark):
    docs = docs_frame(spark, ODD + [" ".join(f"w{k}" for k in range(50))], [None, *"abcdefghij"], [None, 1, 1, 2, 3, 3, 4, 5, 6, 7, None])
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            assert name == "best_fit_packing" or out.columns == frame.columns, name
            assert out.count() <= frame.count() or name == "best_fit_packing"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "decontamination", "best_fit_packing"]
