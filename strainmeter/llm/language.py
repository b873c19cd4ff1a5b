"""Language of whole texts by a linear-chain conditional random field.

Every word of a text (a run of letters) gets a language. Its features are
prefixes and suffixes, character n-grams and its membership in a lexicon of
the training words; weights sit in one hashed table. Transition weights
between the languages of neighbouring words are learned too, so a switch of
language inside a text is followed. Forward-backward gives each word's
posterior; a text's score for a language is the posterior mean over its
letters (words weighted by their length).

Training: a bounded sample (``SAMPLE`` documents, evenly by language, one
window of ``WINDOW`` characters each at a hashed place), joined in pairs so
that half of the sequences switch language. The fit is maximum likelihood
with an L2 term by Adam. Scoring covers every word of every text; chains are
cut into blocks whose transfer matrices are multiplied through, so a text of
20,000 words costs as many numpy steps as one of 200.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainmeter.llm import textvec as tv
from strainmeter.llm.tables import ship

SAMPLE = 1600
WINDOW = 500
BITS = 17
LEXICON = 20_000
ROUNDS = 60
CHAIN = 64
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[128:] = True
_LETTER[97:123] = True
_ASCII = np.zeros(256, bool)
_ASCII[97:123] = True
_AFFIXES = (1, 2, 3, 4)
_GRAMS = (2, 3)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # buckets x languages
    start: np.ndarray
    move: np.ndarray  # from x to
    lexicon: np.ndarray  # sorted word hashes


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowered bytes, word starts and ends, and n + 1 offsets of texts in words."""
    raw, offsets = tv.view(pc.utf8_lower(texts))
    start, end = tv.runs(_LETTER[raw])
    return raw, start, end, np.searchsorted(start, offsets)


def _buckets(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (tv.seeded(hashes, 40 + kind) >> np.uint64(64 - BITS)).astype(np.int32)


def _features(raw: np.ndarray, start: np.ndarray, end: np.ndarray, lexicon: np.ndarray):
    """(bucket, word) arrays by kind of feature; words in ascending order."""
    sums = tv.Prefix(raw)
    length = end - start
    for k in _AFFIXES:
        at = np.flatnonzero(length >= k)
        yield _buckets(sums.hash(start[at], start[at] + k), 2 * k), at
        yield _buckets(sums.hash(end[at] - k, end[at]), 2 * k + 1), at
    for k in _GRAMS:
        n = np.maximum(length - k + 1, 0)
        word = np.repeat(np.arange(len(start)), n)
        place = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)
        yield _buckets(sums.hash(place, place + k), 20 + k), word
    if len(lexicon):
        whole = sums.hash(start, end)
        at = np.flatnonzero(lexicon[np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)] == whole)
        yield _buckets(whole[at], 30), at


def _emissions(model: Model, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.zeros((len(start), len(model.langs)), np.float32)
    for bucket, word in _features(raw, start, end, model.lexicon):
        if not len(word):
            continue
        new = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[new]] += np.add.reduceat(model.weights[bucket], new, axis=0)
    return out


def _blocks(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of at most ``size`` words: first word and length of each, and
    n + 1 offsets of texts in blocks."""
    n = np.diff(first)
    per = -(-n // size)
    at = np.concatenate([[0], np.cumsum(per)])
    nth = np.arange(at[-1]) - np.repeat(at[:-1], per)
    begin = np.repeat(first[:-1], per) + nth * size
    return begin, np.minimum(size, np.repeat(first[1:], per) - begin), at


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def posteriors(score: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray, size: int = CHAIN, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all texts at once. ``score``: words x states;
    ``first``: offsets of texts. Returns the words' posteriors and, with ``pairs``, for each
    word but a text's first the joint posterior with its predecessor."""
    states = score.shape[1]
    begin, length, at = _blocks(first, size)
    grid = np.minimum(begin[:, None] + np.arange(size), max(len(score) - 1, 0))
    inside = np.arange(size) < length[:, None]
    gain = np.exp(score.astype(np.float64) - score.max(axis=1, keepdims=True)) if len(score) else np.zeros((0, states))
    gain = np.where(inside[..., None], gain[grid], 1.0)
    step = np.exp(move - move.max())
    opening = np.exp(start - start.max())

    def ahead(state: np.ndarray, t: int, heads: np.ndarray) -> np.ndarray:
        """One word on; a text's first word takes no transition."""
        moved = state @ step
        if t == 0:
            moved[heads] = state[heads]
        return _scaled(moved * gain[:, t].reshape(-1, *([1] * (state.ndim - 2)), states))

    heads = at[:-1][np.diff(at) > 0]
    # transfer matrices of whole blocks
    through = np.broadcast_to(np.eye(states), (len(begin), states, states)).copy()
    mass = np.ones((len(begin), states))
    for t in range(size):
        moved = through @ step
        if t == 0:
            moved[heads] = through[heads]
        moved = moved * gain[:, t, None, :]
        total = moved.sum(axis=2)
        on = inside[:, t]
        through = np.where(on[:, None, None], moved / np.maximum(total[..., None], 1e-300), through)
        mass = np.where(on[:, None], mass * total, mass)
        mass /= np.maximum(mass.max(axis=1, keepdims=True), 1e-300)
    through *= mass[..., None]
    # states before and after each block, text by text
    before = np.zeros((len(begin), states))
    after = np.ones((len(begin), states))
    per = np.diff(at)
    order = np.argsort(-per, kind="stable")
    live = per[order]
    now = np.broadcast_to(_scaled(opening), (len(per), states)).copy()
    for k in range(int(per.max()) if len(per) else 0):
        m = int(np.searchsorted(-live, -k, "left"))
        block = at[:-1][order[:m]] + k
        before[block] = now[:m]
        now[:m] = _scaled(np.einsum("bi,bij->bj", now[:m], through[block]))
    now = np.ones((len(per), states))
    for k in range(int(per.max()) if len(per) else 0):
        m = int(np.searchsorted(-live, -k, "left"))
        block = at[1:][order[:m]] - 1 - k
        after[block] = now[:m]
        now[:m] = _scaled(np.einsum("bij,bj->bi", through[block], now[:m]))
    # words inside the blocks
    forward = np.zeros((len(begin), size, states))
    prior = np.zeros((len(begin), size, states))
    state = before
    for t in range(size):
        prior[:, t] = state
        state = np.where(inside[:, t, None], ahead(state, t, heads), state)
        forward[:, t] = state
    post = np.zeros((len(begin), size, states))
    back = after
    joint = np.zeros((len(begin), size, states, states)) if pairs else None
    for t in range(size - 1, -1, -1):
        on = inside[:, t]
        post[:, t] = _scaled(forward[:, t] * back)
        ahead_of = gain[:, t] * back
        if joint is not None:
            j = prior[:, t, :, None] * step * ahead_of[:, None, :]
            joint[:, t] = j / np.maximum(j.sum(axis=(1, 2), keepdims=True), 1e-300)
        moved = ahead_of @ step.T
        if t == 0:
            moved[heads] = ahead_of[heads]
        back = np.where(on[:, None], _scaled(moved), back)
    keep = inside
    out = post[keep]
    if joint is None:
        return out, np.zeros((0, states, states))
    inner = keep.copy()
    inner[heads, 0] = False
    return out, joint[inner]


def fit(texts: list[str], langs: list[str], names: list[str], rounds: int = ROUNDS) -> Model:
    """Fit the field to labelled passages; neighbours in the list are joined
    in twos, so a sequence may change language between them."""
    code = {n: i for i, n in enumerate(names)}
    raw, start, end, first = _words(pa.array(texts, pa.large_string()))
    truth = np.repeat([code[x] for x in langs], np.diff(first)).astype(np.int64)
    seq = np.unique(np.concatenate([first[::2], first[-1:]]))
    hashes, times = np.unique(tv.Prefix(raw).hash(start, end), return_counts=True)
    often = np.flatnonzero(times >= 2)
    lexicon = np.sort(hashes[often[np.argsort(-times[often], kind="stable")[:LEXICON]]])
    k, n = len(names), len(start)
    feats = [(b, w) for b, w in _features(raw, start, end, lexicon)]
    bucket = np.concatenate([b for b, _ in feats])
    word = np.concatenate([w for _, w in feats])
    used, slot = np.unique(bucket, return_inverse=True)
    weights = np.zeros((len(used), k))
    chain = np.zeros((k + 1, k))  # start, then moves
    goal = np.eye(k)[truth]
    opens = seq[:-1]
    later = np.setdiff1d(np.arange(n), opens)
    moves_seen = np.zeros((k, k))
    np.add.at(moves_seen, (truth[later - 1], truth[later]), 1.0)
    m = [np.zeros_like(weights), np.zeros_like(chain)]
    v = [np.zeros_like(weights), np.zeros_like(chain)]
    order = np.argsort(word, kind="stable")
    bucket_of, word_of = slot[order], word[order]
    new = np.flatnonzero(np.diff(word_of, prepend=-1))
    for r in range(1, rounds + 1):
        score = np.zeros((n, k))
        score[word_of[new]] = np.add.reduceat(weights[bucket_of], new, axis=0)
        p, joint = _in_parts(score, seq, chain)
        miss = p - goal
        grads = [np.stack([np.bincount(bucket_of, miss[word_of, j], len(used)) for j in range(k)], axis=1) / n + 1e-6 * weights]
        grads.append(np.vstack([miss[opens].sum(axis=0), joint - moves_seen]) / n + 1e-6 * chain)
        for i, (x, g) in enumerate(((weights, grads[0]), (chain, grads[1]))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            x -= 0.1 * (m[i] / (1 - 0.9**r)) / (np.sqrt(v[i] / (1 - 0.99**r)) + 1e-8)
    full = np.zeros((1 << BITS, k), np.float32)
    full[used] = weights
    return Model(names, full, chain[0], chain[1:], lexicon)


def _in_parts(score: np.ndarray, seq: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors and summed joint posteriors, some sequences at a time."""
    ps, joint, a = [], np.zeros(chain[1:].shape), 0
    while a < len(seq) - 1:
        b = min(a + 100, len(seq) - 1)
        p, j = posteriors(score[seq[a] : seq[b]], seq[a : b + 1] - seq[a], chain[0], chain[1:], pairs=True)
        ps.append(p)
        joint += j.sum(axis=0)
        a = b
    return np.concatenate(ps), joint


def predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, words and switches of each text (no nulls)."""
    raw, start, end, first = _words(texts)
    n = np.diff(first)
    lang = np.full(len(n), -1)
    score = np.zeros(len(n))
    switches = np.zeros(len(n), np.int64)
    if len(start) and model.langs:
        p, _ = posteriors(_emissions(model, raw, start, end), first, model.start, model.move)
        size = (end - start).astype(np.float64)
        share = tv.segment_sums(p * size[:, None], first) / np.maximum(tv.segment_sums(size, first), 1)[:, None] if len(p) else np.zeros((len(n), len(model.langs)))
        best = p.argmax(axis=1)
        change = np.zeros(len(best), np.int64)
        change[1:] = best[1:] != best[:-1]
        change[first[:-1][n > 0]] = 0
        switches = tv.segment_sums(change, first)
        lang, score = share.argmax(axis=1), share.max(axis=1)
        plain = tv.segment_sums(np.add.reduceat(_ASCII[raw].astype(np.int64), start) if len(start) else np.zeros(0, np.int64), first)
        for i in np.flatnonzero((n > 0) & (plain == 0)):
            if not any(c.isalpha() for c in texts[int(i)].as_py()):
                lang[i], score[i] = -1, 0.0
        lang[n == 0], score[n == 0] = -1, 0.0
    return [model.langs[i] if i >= 0 else UNKNOWN for i in lang], np.clip(score, 0.0, 1.0), n, switches


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Fit on a hashed sample of the rows whose crc32(id) mod 4 isn't 2, at
    most ``sample`` documents, evenly by language."""
    key = F.crc32(F.col(id_col).cast("string").cast("binary"))
    rows = docs.select(key.alias("_k"), F.col(text_col).alias("_t"), F.col(lang_col).cast("string").alias("_l"))
    rows = rows.where("_k % 4 <> 2 and _l is not null and _t rlike '[A-Za-z\\\\x{80}-\\\\x{10FFFF}]'")
    seen = {r["_l"]: r["n"] for r in rows.groupBy("_l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "_l").limit(256).collect()}
    if not seen:
        return Model([], np.zeros((1, 0), np.float32), np.zeros(0), np.zeros((0, 0)), np.zeros(0, np.uint64))
    names, each = sorted(seen), -(-sample // len(seen))
    rank = F.pmod(F.xxhash64("_k"), F.lit(1 << 30))
    chance = F.create_map(*[F.lit(x) for n in names for x in (n, int(min(1.0, 1.3 * each / seen[n]) * (1 << 30)))])
    spare = F.greatest(F.length("_t") - WINDOW, F.lit(1))
    window = F.substr(F.col("_t"), F.pmod(F.xxhash64("_k", F.lit(5)), spare).cast("int") + 1, F.lit(WINDOW))
    picked = rows.where(rank < F.element_at(chance, F.col("_l"))).select("_l", rank.alias("_r"), window.alias("_w"))
    by: dict[str, list] = {n: [] for n in names}
    for r in sorted(picked.collect(), key=lambda r: (r["_r"], r["_w"])):
        if len(by[r["_l"]]) < each:
            by[r["_l"]].append(r["_w"])
    mixed = [(t, n) for n in names for t in by[n] if any(c.isalpha() for c in t)]
    order = np.random.default_rng(17).permutation(len(mixed))
    return fit([mixed[i][0] for i in order], [mixed[i][1] for i in order], names)


def _predictor(model: Model):
    def infer(column: pa.Array) -> pa.Array:
        parts = []
        for _, piece in tv.slices(column):
            lang, score, n, switches = predict(model, piece)
            parts.append(pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(n.astype(np.int64)), pa.array(switches.astype(np.int64))], ["lang_pred", "score", "n_words", "n_switches"]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("n_words", pa.int64()), ("n_switches", pa.int64())]))

    return F.arrow_udf(infer, "lang_pred string, score double, n_words long, n_switches long")


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score, n_words,
    n_switches (changes of language between neighbouring words).

    A null text or one without a letter is ``und`` with score 0, and so is
    every text if there is nothing to learn from. A null id is not held out
    and not learned from. Ties go to the first language by name. No column
    but the text enters a prediction; other columns aren't read."""
    ship(docs.sparkSession)
    model = trained(docs, id_col, text_col, lang_col)
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
    out = docs.select(F.col(id_col).alias("_id"), held.alias("held_out"), _predictor(model)(F.col(text_col)).alias("_p"))
    return out.select(F.col("_id").alias(id_col), "held_out", "_p.*")


def identified(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with a score
    of at least ``least``: mixed texts stay if one language has half of them."""
    from strainmeter.llm.tables import fresh

    ship(docs.sparkSession)
    model = trained(docs, id_col, text_col, lang_col)
    new = fresh(docs, "_language")
    return docs.withColumn(new, _predictor(model)(F.col(text_col))).where((F.col(new)["lang_pred"] != UNKNOWN) & (F.col(new)["score"] >= least)).drop(new)
