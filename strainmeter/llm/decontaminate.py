"""Benchmark passages in documents, by the q-gram lemma.

Texts are compared on their bytes with ASCII letters lowered and white space
runs as one blank. An item of m bytes may be changed by k = ``RATE`` x m edits
(insert, delete, replace). By the q-gram lemma a text region within k edits
shares at least m + 1 - q - k q of the item's q-grams, and those lie on
neighbouring diagonals (place in text minus place in item), as k edits move
the diagonal by at most k. So shared q-grams are counted in diagonal bands
2 (k + 1) wide that overlap by half: one band holds all of them. Bands that
reach the bound are verified by a banded alignment (edit distance, item
whole, free ends in the text).

The items' q-grams are an index sent to the tasks; documents are read once
per index and no document is shuffled. An index holds at most
``INDEX_BYTES`` of items; a larger benchmark is cut into several by size, and
each goes over all documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainmeter.llm import textvec as tv
from strainmeter.llm.tables import fresh, ship, written

Q = 10
RATE = 0.08
INDEX_BYTES = 8 << 20

_FOLD = tv.lowered(np.arange(256, dtype=np.uint8))
_FOLD[:33] = 32


@dataclass
class Index:
    ids: list
    items: list[np.ndarray]
    edits: np.ndarray
    need: np.ndarray
    grams: np.ndarray  # distinct, sorted
    first: np.ndarray  # offsets into the two below
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray  # bit table over the top bits of grams


def folded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes of all texts, n + 1 offsets, the raw bytes left out
    and the raw offsets. Every text ends with a blank."""
    raw, offsets = tv.view(texts)
    out = _FOLD[raw]
    blank = out == 32
    drop = np.zeros(len(raw), bool)
    np.logical_and(blank[1:], blank[:-1], out=drop[1:])
    drop[offsets[:-1]] = False
    gone = np.flatnonzero(drop)
    return np.delete(out, gone) if len(gone) else out, offsets - np.searchsorted(gone, offsets), gone, offsets


def fold(text: str) -> np.ndarray:
    """One text folded, without blanks at its ends."""
    out, _, _, _ = folded(pa.array([text], pa.large_string()))
    return np.frombuffer(out.tobytes().strip(b" "), np.uint8)


def _grams(raw: np.ndarray, q: int) -> np.ndarray:
    if len(raw) < q:
        return np.zeros(0, np.uint64)
    sums = tv.Prefix(raw)
    out = sums.sums[q:] - sums.sums[:-q]
    out *= sums.down[: len(out)]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out


def index(rows: list[tuple], q: int = Q, rate: float = RATE) -> Index:
    """Index of (id, text) items; one with under q folded bytes matches
    nothing."""
    rows = [(i, fold(t)) for i, t in rows if t is not None]
    rows = [(i, t) for i, t in rows if len(t) >= q]
    size = np.array([len(t) for _, t in rows], np.int64)
    edits = np.minimum((size * rate).astype(np.int64), (size - q) // q)
    gram = np.concatenate([_grams(t, q) for _, t in rows] or [np.zeros(0, np.uint64)])
    n = np.maximum(size - q + 1, 0)
    item = np.repeat(np.arange(len(rows)), n)
    place = np.arange(len(gram)) - np.repeat(np.cumsum(n) - n, n)
    order = np.argsort(gram, kind="stable")
    grams, first = np.unique(gram[order], return_index=True)
    seen = np.zeros(1 << 22, bool)
    seen[(grams >> np.uint64(42)).astype(np.int64)] = True
    return Index([i for i, _ in rows], [t for _, t in rows], edits, size + 1 - q - edits * q, grams, np.append(first, len(gram)), item[order], place[order], seen)


def aligned(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best match of the whole ``item`` in ``text``
    along diagonals low..high (text place minus item place), if within
    ``most`` edits; the leftmost end among equals."""

    def ends(a: np.ndarray, b: np.ndarray, low: int, high: int) -> tuple[int, int]:
        # beyond the text lies padding that equals nothing: replacing it costs
        # what deleting the item's byte there does
        lane = np.arange(high - low + 1)
        left = max(0, -low)
        b = np.concatenate([np.full(left, -1, np.int16), b.astype(np.int16), np.full(max(0, len(a) + high - len(b)), -1, np.int16)])
        row = np.where((lane + low >= 0) & (lane + low <= len(text)), 0, len(a) + most + 1) - lane
        for i, byte in enumerate(a.astype(np.int16).tolist()):
            at = i + low + left
            now = row + (b[at : at + len(lane)] != byte)
            np.minimum(now[:-1], row[1:] + 2, out=now[:-1])
            row = np.minimum.accumulate(now)
        row = row + lane
        best = int(row.argmin())
        return int(row[best]), min(len(a) + best + low, len(text))

    near = text[max(0, low) : max(0, high + len(item))].tobytes().find(item.tobytes())
    if near >= 0:
        start = max(0, low) + near
        return 0, start, start + len(item)
    cost, end = ends(item, text, low, high)
    if cost > most:
        return None
    # the same from the end found, backwards, gives the start
    text = text[:end]
    _, length = ends(item[::-1], text[::-1], -(cost + 1), cost + 1)
    return cost, end - length, end


def matches(ix: Index, texts: pa.Array, q: int = Q) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of all verified regions; places in code
    points. Regions of one item in one text don't overlap: fewest edits
    first, then leftmost."""
    if not len(ix.grams):
        return []
    raw, first, gone, offsets = folded(texts)
    gram = _grams(raw, q)
    place = np.flatnonzero(ix.seen[(gram >> np.uint64(42)).astype(np.int64)])
    slot = np.minimum(np.searchsorted(ix.grams, gram[place]), len(ix.grams) - 1)
    hit = ix.grams[slot] == gram[place]
    place, slot = place[hit], slot[hit]
    text = np.searchsorted(first, place, "right") - 1
    whole = place + q <= first[text + 1]
    place, slot, text = place[whole], slot[whole], text[whole]
    n = ix.first[slot + 1] - ix.first[slot]
    where = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ix.first[slot], n)
    item, text = ix.item[where], np.repeat(text, n)
    diagonal = np.repeat(place, n) - first[text] - ix.place[where]
    step = ix.edits[item] + 1
    band = diagonal // step
    key = np.stack([np.concatenate([x, x]) for x in (text, item)] + [np.concatenate([band, band - 1])], axis=1)
    if not len(key):
        return []
    order = np.lexsort((key[:, 2], key[:, 1], key[:, 0]))
    key = key[order]
    new = np.flatnonzero(np.any(np.diff(key, axis=0, prepend=key[:1] - 1) != 0, axis=1))
    count = np.diff(new, append=len(key))
    found: dict[tuple[int, int], set] = {}
    for (t, i, b), c in zip(key[new].tolist(), count.tolist(), strict=True):
        if c < ix.need[i]:
            continue
        k = int(ix.edits[i])
        mine = raw[first[t] : first[t + 1]]
        got = aligned(ix.items[i], mine, b * (k + 1) - k, (b + 2) * (k + 1) + k, k)
        if got:
            found.setdefault((t, i), set()).add(got)
    out = []
    for (t, i), spots in sorted(found.items()):
        taken: list[tuple[int, int]] = []
        for cost, a, b in sorted(spots):
            if all(b <= x or a >= y for x, y in taken):
                taken.append((a, b))
                own = raw_bytes(texts, t)
                start = _unfolded(first[t] + a, gone) - offsets[t]
                end = _unfolded(first[t] + b - 1, gone) + 1 - offsets[t]
                out.append((t, i, len(own[:start].decode("utf-8", "ignore")), len(own[:end].decode("utf-8", "ignore")), cost))
    return out


def _unfolded(place: int, gone: np.ndarray) -> int:
    """The raw place of a folded byte."""
    return int(place + np.searchsorted(gone - np.arange(len(gone)), place, "right"))


def raw_bytes(texts: pa.Array, i: int) -> bytes:
    return texts[i].as_py().encode()


_HITS = "array<struct<item:long,start_char:long,end_char:long,edits:long>>"


def _finder(ix: Index, q: int):
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("item", "start_char", "end_char", "edits")]))

    def find(column: pa.Array) -> pa.Array:
        out = [None] * len(column)
        for row, piece in tv.slices(column):
            for t, *hit in matches(ix, piece, q):
                out[row + t] = (out[row + t] or []) + [dict(zip(("item", "start_char", "end_char", "edits"), hit, strict=True))]
        return pa.array(out, kind)

    return F.arrow_udf(find, _HITS)


def _indexes(benchmark: DataFrame, id_col: str, text_col: str, q: int, rate: float):
    """Bounded indexes over all items, by order of size and id."""
    items = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null")
    total = items.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    parts = -(-int(total) * 2 // INDEX_BYTES) if total > INDEX_BYTES else 1
    for p in range(parts):
        mine = items if parts == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p)
        yield index(sorted(map(tuple, mine.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])), q, rate)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", q: int = Q, rate: float = RATE) -> DataFrame:
    """One row per benchmark passage found: document id, item id, start_char,
    end_char (code points, end exclusive) and edits.

    Null and empty texts hold nothing; neither do items under q folded bytes.
    Rows with a null id take part. Repeated rows, of documents or items, are
    found each. Other columns aren't read; the result has only those named."""
    ship(docs.sparkSession)
    out = []
    for ix in _indexes(benchmark, item_col, item_text, q, rate):
        hits = docs.select(F.col(id_col).alias("_id"), F.explode(_finder(ix, q)(F.col(text_col))).alias("_h"))
        ids = F.array(*[F.lit(i).cast(benchmark.schema[item_col].dataType) for i in ix.ids]) if ix.ids else F.array(F.lit(None).cast(benchmark.schema[item_col].dataType))
        out.append(hits.select(F.col("_id").alias(id_col), ids[F.col("_h.item").cast("int")].alias(item_col), "_h.start_char", "_h.end_char", "_h.edits"))
    return reduce(DataFrame.unionByName, out)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", q: int = Q, rate: float = RATE) -> DataFrame:
    """The rows of ``docs``, all columns, without a benchmark passage."""
    ship(docs.sparkSession)
    new = fresh(docs, "_leaks")
    for k, ix in enumerate(_indexes(benchmark, item_col, item_text, q, rate)):
        if k:  # one index at a time in a task
            docs = written(docs, "decontaminate")
        docs = docs.withColumn(new, _finder(ix, q)(F.col(text_col))).where(F.col(new).isNull()).drop(new)
    return docs
