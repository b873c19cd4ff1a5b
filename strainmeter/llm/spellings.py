"""Spelling variants: words one edit apart, found over sorted vocabulary.

Words are counted over all texts (vectorised in tasks, partial counts by
Arrow batch and task, exact strings). Two words one edit apart share half of
their letters: with k = half the length of the shorter one, either the first
k code points are equal or the last k are. So a word of length l joins the
groups (k, its first k) and (k, its last k) for k = l // 2 and (l - 1) // 2,
and every near pair meets in one of them. A group above ``GROUP`` words is cut
again by the halves of what its words don't share yet, until none is above.

Within a group the rests of the words are a sorted list. The edit matrix is
kept to its band of three diagonals, with cells capped at two edits, so a row
is one of a few dozen states. The row of a word and a list entry's prefix is
computed once for the whole range of entries that share this prefix (their
adjacent LCPs) and dropped with the range as soon as all its cells exceed one
edit. All words of a batch go down their lists at once in numpy, prefix length
by prefix length, so nothing like all pairs of a group is ever made.

Forms are the near words of largest count; roots follow forms by pointer
doubling over written tables: counts grow at least five-fold a step, so the
chains are short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainmeter.llm import textvec as tv
from strainmeter.llm.tables import ship, small_or_shuffled, written

LEAST_POINTS = 6
LEAST_COUNT = 5
RATIO = 5
EDITED = 199
GROUP = 50_000
#: Rows of (word, prefix) states held at once in a task.
STATES = 1 << 20

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)


# -- words


def _crc(state: np.ndarray, data: np.ndarray) -> np.ndarray:
    return _CRC[(state ^ data) & 0xFF] ^ (state >> np.uint32(8))


def runs_of(texts: pa.Array, ids: list[str]) -> pa.Array:
    """Maximal letter runs of the texts, A-Z lowered, one code point deleted
    where 199 divides the crc32 of "id:run"; only those of at least
    ``LEAST_POINTS`` code points."""
    raw, offsets = tv.view(texts)
    low = tv.lowered(raw)
    lead = low == 0xC3  # U+00C0 to U+00FF: this byte and one more
    inside = ((low >= 97) & (low <= 122)) | lead
    inside[1:] |= lead[:-1]
    start, end = tv.runs(inside)
    doc = np.searchsorted(offsets, start, "right") - 1
    points = end - start - tv.segment_sums(lead.astype(np.int64), np.stack([start, end], axis=1).ravel())[::2] if len(start) else np.zeros(0, np.int64)
    keep = points >= LEAST_POINTS
    start, end, doc, points = start[keep], end[keep], doc[keep], points[keep]
    head = np.zeros(len(ids), np.uint32)
    for i, s in enumerate(ids):
        state = 0xFFFFFFFF
        for b in f"{s}:".encode():
            state = int(_CRC[(state ^ b) & 0xFF]) ^ state >> 8
        head[i] = state
    crc, size = head[doc], end - start
    order = np.argsort(-size, kind="stable")  # those with a byte at j come first
    by_size, left = size[order], len(order)
    for j in range(int(by_size[0]) if left else 0):
        while left and by_size[left - 1] <= j:
            left = int(np.searchsorted(-by_size, -j, "left"))
        at = order[:left]
        crc[at] = _crc(crc[at], low[start[at] + j].astype(np.uint32))
    crc ^= np.uint32(0xFFFFFFFF)
    cut = np.flatnonzero(crc % EDITED == 0)
    whole = np.ones(len(start), bool)
    whole[cut] = False
    edited = []
    for i in cut.tolist():
        if points[i] > LEAST_POINTS:
            word = low[start[i] : end[i]].tobytes().decode()
            at = int(crc[i]) % len(word)
            edited.append(word[:at] + word[at + 1 :])
    step = np.zeros(len(low) + 1, np.int8)
    step[start[whole]] += 1
    step[end[whole]] -= 1
    data = low[np.cumsum(step[:-1], dtype=np.int8).view(bool)]
    bounds = np.concatenate([[0], np.cumsum(size[whole])])
    kept = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data))
    return pa.concat_arrays([kept, pa.array(edited, pa.large_string())])


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column("id").cast(pa.string()).fill_null("").to_pylist()
        for a, texts in tv.slices(b.column("t"), 4 << 20):
            found = pc.value_counts(runs_of(texts, ids[a : a + len(texts)]))
            yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur at least ``least`` times."""
    parts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(_counter, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# -- near words: rows of the banded edit matrix as states


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state by state and equalities, and the edits of a word's end.

    A state is (a, b, c): the cells of one row of the matrix left of, on and
    right of the diagonal, each capped at 2. Equality bits tell whether the
    next letter of the list's prefix equals the word's letter at those three
    places of the next row. The cell right of the diagonal of the next row has
    nothing above it in the band."""
    states = [(a, b, c) for a in range(3) for b in range(3) for c in range(3)]
    code = {s: i for i, s in enumerate(states)}
    follow = np.zeros((27, 8), np.int8)
    for i, (a, b, c) in enumerate(states):
        for bits in range(8):
            left = min(a + 1 - (bits & 1), b + 1, 2)
            on = min(b + 1 - (bits >> 1 & 1), left + 1, c + 1, 2)
            right = min(c + 1 - (bits >> 2 & 1), on + 1, 2)
            follow[i, bits] = code[left, on, right]
    return follow, np.array(states, np.int8)


_FOLLOW, _CELLS = _transitions()
_START = 2 * 9 + 0 * 3 + 1  # nothing read: 0 on the diagonal, 1 right of it


def near_pairs(group: np.ndarray, rest: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ordered pairs (i, j) of rows of one group with rests one edit apart;
    rows are sorted by group, then rest."""
    n = len(rest)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.array([len(r) for r in rest], np.int64)
    flat = np.append(np.frombuffer("".join(rest).encode("utf-32-le"), np.uint32), np.uint32(0))
    start = np.cumsum(size) - size

    def letter(i: np.ndarray, d: int) -> np.ndarray:
        """Letter d of rows i; 0 outside the word."""
        return np.where((d >= 0) & (d < size[i]), flat[np.minimum(start[i] + max(d, 0), len(flat) - 1)], 0)

    # LCP of adjacent entries; -1 where a group begins
    lcp = np.full(n, -1, np.int64)
    both = np.minimum(size[1:], size[:-1])
    at = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
    differ = flat[np.repeat(start[1:], both) + at] != flat[np.repeat(start[:-1], both) + at]
    lcp[1:] = both
    some = np.flatnonzero(both)
    if len(some):
        lcp[1 + some] = np.minimum.reduceat(np.where(differ, at, np.repeat(both, both)), (np.cumsum(both) - both)[some])
    lcp[1:][group[1:] != group[:-1]] = -1
    first = np.flatnonzero(lcp < 0)
    own = np.cumsum(lcp < 0) - 1
    # a range [lo, hi) of entries that share their first d letters, per word
    stack = [(0, np.arange(n), first[own], np.append(first[1:], n)[own], np.full(n, _START, np.int8))]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while stack:
        d, word, lo, hi, state = stack.pop()
        # ranges of entries that share d + 1 letters are cut where the LCP is d
        cuts = np.append(np.flatnonzero(lcp <= d), n)
        a = np.searchsorted(cuts, lo, "right")
        many = np.searchsorted(cuts, hi, "left") - a + 1
        if len(word) > 1 and many.sum() > STATES:
            half = len(word) // 2
            stack += [(d, word[half:], lo[half:], hi[half:], state[half:]), (d, word[:half], lo[:half], hi[:half], state[:half])]
            continue
        who = np.repeat(np.arange(len(word)), many)
        step = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
        begin = np.where(step == 0, lo[who], cuts[np.maximum(a[who] + step - 1, 0)])
        end = np.where(step == many[who] - 1, hi[who], cuts[np.minimum(a[who] + step, len(cuts) - 1)])
        w, state = word[who], state[who]
        # the entry that ends here comes first, in a range of its own
        ends = size[begin] == d
        over, cells = size[w[ends]] - d, _CELLS[state[ends]]
        edits = np.where(over == 0, cells[:, 1], np.where(over == -1, cells[:, 0], np.where(over == 1, cells[:, 2], 2)))
        hit = (edits == 1) & (w[ends] != begin[ends])
        found.append((w[ends][hit], begin[ends][hit]))
        w, begin, end, state = w[~ends], begin[~ends], end[~ends], state[~ends]
        x = letter(begin, d)
        bits = (letter(w, d + 1) == x) * 4 + (letter(w, d) == x) * 2 + (letter(w, d - 1) == x)
        state = _FOLLOW[state, bits]
        alive = _CELLS[state].min(axis=1) <= 1
        if alive.any():
            stack.append((d + 1, w[alive], begin[alive], end[alive], state[alive]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _scanner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of sorted rows (key, rest, word, n), whole groups at a time:
    the last group of a batch waits for the next one."""

    def scan(t: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = t["key"].combine_chunks()
        group = np.concatenate([[0], np.cumsum(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False))]) if len(keys) else np.zeros(0, np.int64)
        i, j = near_pairs(group, t["rest"].to_pylist())
        for a in range(0, len(i), 50_000):
            u, v = pa.array(i[a : a + 50_000]), pa.array(j[a : a + 50_000])
            yield pa.RecordBatch.from_arrays([t["word"].take(u).combine_chunks(), t["word"].take(v).combine_chunks(), t["n"].take(v).combine_chunks()], ["word", "near", "near_n"])

    held: list[pa.RecordBatch] = []
    rows, least = 0, 20_000
    for b in batches:
        if not len(b):
            continue
        held.append(b)
        rows += len(b)
        if rows < least:
            continue
        t = pa.Table.from_batches(held)
        keys = t["key"].to_pylist()
        cut = keys.index(keys[-1])
        if cut:
            yield from scan(t.slice(0, cut))
        held, rows = t.slice(cut).combine_chunks().to_batches(), len(t) - cut
        least = max(20_000, 2 * rows)
    if held:
        yield from scan(pa.Table.from_batches(held))


def _halves(rows: DataFrame) -> DataFrame:
    """Rows (key, rest, word, n), each dealt to the groups of its halves: the
    rest that a group hasn't fixed loses its first or last k code points (a
    rest of one code point or none goes on whole)."""
    size = F.length("rest")
    k = F.explode(F.array_distinct(F.array((size / 2).cast("int"), F.greatest(((size - 1) / 2).cast("int"), F.lit(0)))))
    each = rows.select("*", k.alias("k"))
    first = F.struct(F.lit("<").alias("side"), F.expr("substring(rest, 1, k)").alias("half"), F.expr("substring(rest, k + 1)").alias("rest"))
    last = F.struct(F.lit(">").alias("side"), F.expr("right(rest, k)").alias("half"), F.expr("left(rest, length(rest) - k)").alias("rest"))
    part = F.explode(F.when(F.col("k") > 0, F.array(first, last)).otherwise(F.array(first)))
    each = each.select("key", "word", "n", "k", part.alias("p"))
    return each.select(F.concat("key", "p.side", F.col("k").cast("string"), F.lit(":"), "p.half").alias("key"), F.col("p.rest").alias("rest"), "word", "n")


def dealt(words: DataFrame, bound: int = GROUP) -> DataFrame:
    """(key, rest, word, n): every near pair shares a key. A key with more
    than ``bound`` words is cut again, which halves their rests; it ends where
    rests have at most two code points (then the alphabet bounds a key)."""
    rows = _halves(words.select(F.lit("").alias("key"), F.col("word").alias("rest"), "word", "n"))
    done = None
    while True:
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max(F.length("rest")).alias("longest"))
        hot = written(sizes.where((F.col("c") > bound) & (F.col("longest") > 2)).select("key"), "spelling-hot")
        count = hot.count()
        if not count:
            return rows if done is None else done.unionByName(rows)
        side = small_or_shuffled(hot, count)
        kept = rows.join(side, "key", "left_anti")
        done = kept if done is None else done.unionByName(kept)
        rows = _halves(written(rows.join(side, "key", "left_semi"), "spelling-rest"))


def near_words(words: DataFrame, bound: int = GROUP) -> DataFrame:
    """(word, near, near_n), each ordered pair once."""
    rows = dealt(words, bound).repartition("key").sortWithinPartitions("key", "rest")
    pairs = rows.mapInArrow(_scanner, "word string, near string, near_n long")
    return pairs.repartition("word").dropDuplicates(["word", "near"])


# -- forms and roots


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form, by pointer doubling."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        new = written(new, "spelling-roots")
        if not new.where("moved").limit(1).count():
            return new.select("word", "root")
        now = new.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT, ratio: int = RATIO, bound: int = GROUP) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    A null or empty text has no words; a null id counts as an empty one in
    the hash; repeated rows count each time. Ties between near words of equal
    count go to the smaller in code-point order. Very long texts and runs are
    taken whole. An empty table gives an empty result; other columns aren't
    read."""
    ship(docs.sparkSession)
    words = written(vocabulary(docs, id_col, text_col, least), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_words(words, bound).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    near = near.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.near").alias("form"))
    all_words = words.join(near, "word", "left")
    far = F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False))
    named = written(all_words.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(far, F.col("form")).alias("form"), F.when(far, F.col("form_n")).alias("form_n")), "spelling-forms")
    roots = _roots(named.where("form is not null"))
    out = named.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
