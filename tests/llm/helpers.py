import pyarrow.parquet as pq

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, texts, sources=None, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources or ["a"] * len(texts))]
    return spark.createDataFrame(rows, SCHEMA)


def table(name, *columns):
    return pq.read_table(f"{SF}/{name}.parquet", columns=list(columns) or None).to_pylist()


#: Null, empty, blank, one word, repeated rows, marks, other scripts, a very long text.
ODD = [None, "", " \n\t", "word", "same text here", "same text here", "#$%&|<> !!", "éÑß 日本 İ ς", "<|endoftext|> x", "long words " * 20_000]
