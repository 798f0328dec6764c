"""Long lines on two sites in the pipeline's stage, where op2 keeps to the three of its SQL."""

import corpus_pipeline

from quire.llm.line_dedup import deduped

from .helpers import SF, docs_frame


def test_long_lines_on_two_sites(spark):
    long, short = " ".join(f"w{k}" for k in range(51)), " ".join(f"v{k}" for k in range(50))
    texts = [f"{long}\n{short}\none", f"two\n{long}\n{short}", f"{short}x\n{long} y", f"{short}x\n{long} y"]
    docs = docs_frame(spark, texts, ["a", "b", "a", "a"])
    got = {x["doc_id"]: x["text"] for x in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    assert got == {0: texts[0], 1: f"two\n{short}", 2: texts[2], 3: texts[3]}
    assert {x["doc_id"]: x["text"] for x in deduped(docs).collect()} == dict(enumerate(texts))
