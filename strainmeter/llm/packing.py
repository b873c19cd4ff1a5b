"""Packing along a space-filling curve.

Every document is a bag of hashed words, projected by hashed signs to
``DIMS`` dimensions (a random projection of its unit vector). The place of
that point on a Hilbert curve is its sort key: documents with similar words
are neighbours. A range shuffle by the key deals documents to tasks (ties are
split by id and text, so copies don't land in one task); each task tokenizes
its documents in order and lays them end to end, cut at the sequence length.
Only the end of a task's stream isn't a full sequence: it is cut into
sequences whose lengths are powers of two, which need no padding.

A task holds one Arrow batch of texts and one open sequence at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainmeter.llm import textvec as tv
from strainmeter.llm.tables import ship

LENGTH = 2048
DIMS, DEPTH = 3, 10
TASK_BYTES = 24 << 20
END = 1


def hilbert(axes: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits``-bit coordinates
    (points x dimensions), by Skilling's transform."""
    x = axes.astype(np.int64).copy()
    n = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[:, i] & q) > 0
            swap = (x[:, 0] ^ x[:, i]) & p
            x[:, 0] ^= np.where(high, p, swap)
            x[:, i] ^= np.where(high, 0, swap)
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[:, n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    out = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[:, i] >> b) & 1)
    return out


def places(texts: pa.Array) -> np.ndarray:
    """Hilbert keys of texts; one without words lies in the middle."""
    hashes, _, _, first = tv.words(texts)
    n = np.maximum(np.diff(first), 1)
    axes = []
    for d in range(DIMS):
        sign = 1.0 - 2.0 * (tv.seeded(hashes, 60 + d) >> np.uint64(63)).astype(np.float64)
        z = tv.segment_sums(sign, first) / np.sqrt(n)
        axes.append(np.clip(((np.tanh(z / 2) + 1) / 2 * (1 << DEPTH)).astype(np.int64), 0, (1 << DEPTH) - 1))
    return hilbert(np.stack(axes, axis=1), DEPTH)


def _keyer():
    def key(column: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], pa.int64()), *(pa.array(places(p)) for _, p in tv.slices(column))])

    return F.arrow_udf(key, "long")


def encoder(path: str):
    """Ids of ordinary text for a byte-level BPE in the tokenizers library's
    JSON format. The vocabulary's own ranks drive tiktoken, which gives the
    same ids several times faster (tested against the library)."""
    import json

    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = dict(zip(map(chr, printable), printable, strict=True))
    shown |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
    ranks = {bytes(shown[c] for c in t): i for t, i in vocab.items() if all(c in shown for c in t) and not t.startswith("<|")}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


_PIECE = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))])


def cuts(filled: int, n: int, length: int) -> list[int]:
    """Lengths of the pieces that lay ``n`` ids behind ``filled`` ones."""
    out = []
    while n:
        out.append(min(n, length - filled))
        filled = (filled + out[-1]) % length
        n -= out[-1]
    return out


def tail(n: int) -> list[int]:
    """The powers of two that make up ``n``, falling."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _packer(path: str, length: int, with_ids: bool, id_type: pa.DataType):
    schema = _PIECE.set(0, pa.field("key", id_type))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        sequence = TaskContext.get().partitionId() << 32
        open_pieces: list[tuple] = []  # of the sequence that isn't full
        filled = 0

        def batch(pieces: list[tuple]) -> pa.RecordBatch:
            rows = []
            for key, start, ids, total, seq, offset in pieces:
                rows.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, seq, offset, ids if with_ids else None))
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            full: list[tuple] = []
            for key, text in zip(b.column(0), b.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), END], np.int32)
                start = 0
                for n in cuts(filled, len(ids), length):
                    open_pieces.append((key.as_py(), start, ids[start : start + n], len(ids), sequence, filled))
                    start += n
                    filled += n
                    if filled == length:
                        full += open_pieces
                        open_pieces, filled, sequence = [], 0, sequence + 1
                if len(full) >= 4096:
                    yield batch(full)
                    full = []
            if full:
                yield batch(full)
        # the rest, in sequences of powers of two
        rest: list[tuple] = []
        sizes = tail(filled)
        offset = 0
        for key, start, ids, total, _, _ in open_pieces:
            while len(ids):
                n = min(len(ids), sizes[0] - offset)
                rest.append((key, start, ids[:n], total, sequence, offset))
                ids, start, offset = ids[n:], start + n, offset + n
                if offset == sizes[0]:
                    sizes, offset, sequence = sizes[1:], 0, sequence + 1
        if rest:
            yield batch(rest)

    return pack


def packed(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if asked for, ids. Pieces of a sequence lie in it
    by offset without gaps; ids of a document are its text's and then ``END``.

    A null text is empty (one id, the end). Rows with null or repeated ids are
    documents of their own. Other columns aren't read."""
    spark = docs.sparkSession
    ship(spark)
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    total = rows.agg(F.sum(F.octet_length("_text") + 16)).first()[0] or 0
    tasks = max(1, -(-int(total) // TASK_BYTES))
    order = ["_place", F.xxhash64("_id"), "_id", F.xxhash64("_text"), "_text"]
    placed = rows.withColumn("_place", _keyer()("_text")).repartitionByRange(tasks, *order[:4]).sortWithinPartitions(*order)
    kind = rows.schema["_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    out = placed.select("_id", "_text").mapInArrow(_packer(tokenizer, length, with_ids, to_arrow_type(kind)), f"key {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>")
    out = out.withColumnRenamed("key", id_col)
    return out if with_ids else out.drop("ids")
