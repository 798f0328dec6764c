"""Best-fit packing of token sequences under several capacities.

A sequence (bin) has three capacities: tokens, documents and attention cost, the sum of squared piece lengths. A piece goes to
the open bin that has room for it in all three and whose residual vector then has the smallest weighted norm (or whose residual
has the largest weighted dot product with the piece's demand); a new bin opens if none has room. Pieces come longest first.

Pieces are dealt over shards by a salt of their position in the input, never by a key of the data, so no shard depends on how
ids, sources or lengths are spread. Each shard is packed by one task, its size is bounded, and it wastes about one bin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import bytes_of, documents

#: Entries of a worker's word cache; later words are encoded each time.
CACHE = 600_000
#: Marks that often end a word; none of them can begin a contraction.
MARKS = b".,;:!?#*$%&|)"
#: How byte-level vocabularies write bytes that have no visible Latin-1 character: in order, from U+0100 on.
BYTES = {b: 256 + k for k, b in enumerate([*range(33), *range(127, 161), 173])}
#: Documents in a shard.
SHARD = 16_384


class WordIds(dict):
    """Ids (little-endian uint32) of space-free pieces of ASCII-lower-cased text, filled on demand.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its space-free pieces in order.
    """

    def __init__(self, path: str, most: int = CACHE):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.model = self.tokenizer.model
        self[b""] = b""

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, piece: bytes) -> bytes:
        core = piece.rstrip(MARKS)
        text = piece.decode()
        if core and core != piece and text[len(text) + len(core) - len(piece) - 1].lower().isalpha():  # letters never join marks
            ids = self[core] + self[piece[len(core) :]]
        elif text.isalpha() and max(text) < "\u0100":  # letters that are normalised by lower-casing alone
            ids = np.array([t.id for t in self.model.tokenize(text.lower().encode().decode("latin-1").translate(BYTES))], "<u4").tobytes()
        else:
            ids = self.whole(text)
        if len(self) < self.most:
            self[piece] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        if b"<|" in text:  # may hold a special token, which is matched before lower-casing
            return self.whole(text.decode())
        return b"".join(map(self.__getitem__, text.lower().replace(b"\n", b" ").split(b" ")))


def tokenizer_path(name: str) -> str:
    """The path itself, or that of a vocabulary file of the installed public tokenizers."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


_cached: dict[str, WordIds] = {}


def tokenised(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 0, most: int = 2048) -> DataFrame:
    """(doc_id, row, piece, start, length, ids): each text's ids and end_id, cut into pieces of at most most ids.

    ids are little-endian unsigned 32-bit. row numbers the rows of docs, so that repeated and null ids stay apart. A null text
    counts as empty and gives one piece, end_id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(tokenizer)
        words = _cached.get(path) or _cached.setdefault(path, WordIds(path))
        end, names = np.array([end_id], "<u4").tobytes(), ["doc_id", "row", "piece", "start", "length", "ids"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            out, size = [], 0
            for doc, row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), bytes_of(b.column(2))):
                ids = words.encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * most)):
                    part = ids[at : at + 4 * most]
                    out.append((doc, row, k, at // 4, len(part) // 4, part))
                size += len(ids)
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, row long, piece int, start long, length long, ids binary")


def best_fit(lengths: np.ndarray, tokens: int, docs: int, attention: float, weights=(1.0, 0.01, 0.01), by: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece. by: norm or dot."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room = np.empty((3, 1024))
    number = np.empty(1024, np.int64)
    least = lengths.min() if len(lengths) else 0
    w, cap = np.array(weights)[:, None], np.array([tokens, docs, attention], float)
    is_open = opened = 0
    for i in order:
        n = int(lengths[i])
        need = np.array([n, 1, float(n) * n])
        best = -1
        if is_open:
            now = room[:, :is_open]
            fits = np.flatnonzero((now[0] >= need[0]) & (now[1] >= need[1]) & (now[2] >= need[2]))
            if len(fits):
                if by == "dot":
                    best = fits[np.argmax((w * (now[:, fits] / cap[:, None]) * (need / cap)[:, None]).sum(0))]
                else:
                    best = fits[np.argmin((w * ((now[:, fits] - need[:, None]) / cap[:, None]) ** 2).sum(0))]
        if best < 0:
            if is_open == room.shape[1]:
                room = np.concatenate([room, np.empty_like(room)], 1)
                number = np.concatenate([number, np.empty_like(number)])
            best, number[is_open], room[:, is_open] = is_open, opened, cap
            is_open, opened = is_open + 1, opened + 1
        bins[i], offsets[i] = number[best], tokens - int(room[0, best])
        room[:, best] -= need
        if room[0, best] < least or room[1, best] < 1:  # full: the last open bin takes its place
            is_open -= 1
            room[:, best], number[best] = room[:, is_open], number[is_open]
    return bins, offsets


def packed(pieces: DataFrame, shards: int, tokens: int = 2048, docs: int = 2048, attention: float | None = None, weights=(1.0, 0.01, 0.01), by: str = "norm") -> DataFrame:
    """pieces (with row, piece and length) and their sequence_id and offset (long).

    shards: how many bounded groups to pack separately; about one bin is wasted in each. attention: the largest sum of squared
    lengths, tokens * tokens by default. A piece that exceeds a capacity alone raises an error.
    """
    attention = float(tokens) * tokens if attention is None else float(attention)
    kept = [f for f in pieces.schema.fields if f.name not in ("sequence_id", "offset", "_shard")]
    schema = T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(key: tuple, group: pa.Table) -> pa.Table:
        group = group.drop_columns(["_shard"]).sort_by([("row", "ascending"), ("piece", "ascending")])
        lengths = group.column("length").to_numpy()
        if len(lengths) and (lengths.max() > tokens or float(lengths.max()) ** 2 > attention):
            raise ValueError("a piece is larger than a sequence")
        bins, offsets = best_fit(lengths, tokens, docs, attention, weights, by)
        return group.append_column("sequence_id", pa.array((int(key[0].as_py()) << 40) + bins)).append_column("offset", pa.array(offsets))

    salted = pieces.select(*(f.name for f in kept), F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).alias("_shard"))
    return salted.groupBy("_shard").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", tokens: int = 2048, with_ids: bool = True, shard: int | None = None, **more) -> DataFrame:
    """Packs all docs into sequences: (doc_id, row, piece, start, length, ids_crc32, sequence_id, offset), and ids with_ids.

    Empty and null texts give one piece with the end id alone; null, repeated and tied ids each keep their rows; an empty table
    gives an empty result. Other columns are dropped. shard: documents in a group, fewer with ids, which are larger.
    """
    n = docs.count()
    shard = shard or (SHARD // 8 if with_ids else SHARD)
    pieces = tokenised(docs, tokenizer, most=tokens).withColumn("ids_crc32", F.crc32("ids"))
    return packed(pieces if with_ids else pieces.drop("ids"), max(1, -(-n // shard)), tokens, **more)


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return pack_documents(documents(spark, sf_dir), with_ids=False).select(*columns)
