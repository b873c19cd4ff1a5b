"""Document quality from weak labels.

Eight heuristic labellers vote good, bad or nothing on every document. Their
accuracies are estimated without any truth by expectation-maximisation
(Dawid and Skene, 1979) over the counts of vote patterns of all documents: at
most 3^8 rows, whatever the corpus. The posterior of a document's pattern is
its soft label. A logistic scorer over hashed character 3-grams, word shapes
and the labellers' own numbers learns from the soft labels of a bounded sample
and scores every whole text. The decision is the scorer's.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainmeter.llm import textvec as tv
from strainmeter.llm.tables import fresh, ship

SAMPLE = 3000
BITS = 15
ROUNDS = 80
LEAST = 0.25

#: labeller: (number, bad below, good from, good to, bad above)
LABELLERS = {
    "symbols": ("symbol_share", None, 0.0, 0.01, 0.04),
    "word_length": ("word_length", 2.0, 3.0, 10.0, 15.0),
    "short_words": ("short_share", 0.01, 0.15, 0.8, None),
    "sentences": ("words_per_stop", None, 3.0, 60.0, 120.0),
    "lines": ("repeated_lines", None, 0.0, 0.1, 0.3),
    "phrases": ("repeated_phrases", None, 0.0, 0.15, 0.4),
    "letters": ("letter_share", 0.6, 0.9, 1.0, None),
    "size": ("log_words", 0.1, 3.4, 99.0, None),
}
NUMBERS = [n for n, *_ in LABELLERS.values()]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*b"#$%&*|~^<>{}\\[]=+@_"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[*b".!?"]] = True


def _distinct(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of distinct values text by text."""
    out = values.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        out[a:b].sort()
    new = np.ones(len(out), np.int64)
    new[1:] = out[1:] != out[:-1]
    new[first[:-1][first[:-1] < len(out)]] = 1
    return tv.segment_sums(new, first)


def numbers(texts: pa.Array) -> np.ndarray:
    """The labellers' numbers (texts x labellers); zeros for no words."""
    raw, offsets = tv.view(texts)
    hashes, start, end, first = tv.words(texts)
    n = np.diff(first)
    some = np.maximum(n, 1)
    length = (end - start).astype(np.int64)
    ink = np.maximum(tv.segment_sums(length, first), 1)
    per = lambda cls: tv.segment_sums(cls[raw].astype(np.int64), offsets)
    breaks = np.flatnonzero(raw == 10)
    line_first = np.searchsorted(breaks, offsets)
    begin = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else breaks
    full = breaks - begin > 0
    lines = tv.Prefix(raw).hash(begin[full], breaks[full]) if len(breaks) else np.zeros(0, np.uint64)
    kept = np.concatenate([[0], np.cumsum(full)])[line_first]
    n_lines = np.maximum(np.diff(kept), 1)
    phrases, phrase_first = tv.shingles(hashes, first, 3)
    n_phrases = np.maximum(np.diff(phrase_first), 1)
    out = np.stack(
        [
            per(_SYMBOL) / ink,
            ink / some,
            tv.segment_sums((length <= 3).astype(np.int64), first) / some,
            n / np.maximum(per(_STOP), 0.5),
            1 - np.minimum(_distinct(lines, kept), n_lines) / n_lines,
            1 - np.minimum(_distinct(phrases, phrase_first), n_phrases) / n_phrases,
            per(_LETTER) / ink,
            np.log1p(n),
        ],
        axis=1,
    )
    out[n == 0] = 0.0
    return out


def votes(x: np.ndarray) -> np.ndarray:
    """2 for good, 1 for bad, 0 for nothing (texts x labellers)."""
    out = np.zeros(x.shape, np.int64)
    for j, (_, low, a, b, high) in enumerate(LABELLERS.values()):
        out[:, j][(x[:, j] >= a) & (x[:, j] <= b)] = 2
        if low is not None:
            out[:, j][x[:, j] < low] = 1
        if high is not None:
            out[:, j][x[:, j] > high] = 1
    return out


def _codes(v: np.ndarray) -> np.ndarray:
    return v @ 3 ** np.arange(v.shape[1])


def posterior(patterns: dict[int, int], rounds: int = 200) -> dict[int, float]:
    """Probability of good for each vote pattern, by expectation-maximisation
    over the pattern counts, from the share of good votes."""
    m = len(LABELLERS)
    codes = np.array(sorted(patterns), np.int64)
    if not len(codes):
        return {}
    count = np.array([patterns[c] for c in codes.tolist()], float)
    v = codes[:, None] // 3 ** np.arange(m) % 3
    good = (0.5 + (v == 2).sum(axis=1)) / (1 + (v > 0).sum(axis=1))
    for _ in range(rounds):
        logs = []
        for p in (1 - good, good):
            w = count * p
            log = np.full(len(codes), np.log((w.sum() + 1) / (count.sum() + 2)))
            for j in range(m):
                each = np.bincount(v[:, j], w, 3) + 0.5
                log += np.log(each / each.sum())[v[:, j]]
            logs.append(log)
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return dict(zip(codes.tolist(), good.tolist(), strict=True))


@dataclass
class Scorer:
    weights: np.ndarray  # hashed 3-grams
    numbers: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    bias: float


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte 3-grams (letters as they are, digits alike) and
    n + 1 offsets."""
    raw, offsets = tv.view(texts)
    low = tv.lowered(raw).astype(np.uint32)
    key = low[:-2] | low[1:-1] << 8 | low[2:] << 16 if len(low) > 2 else np.zeros(0, np.uint32)
    key = np.concatenate([key * np.uint32(2654435761) >> np.uint32(32 - BITS), np.zeros(len(raw) - len(key), np.uint32)])
    return key.astype(np.int32), offsets


def fit(texts: pa.Array, label: np.ndarray, rounds: int = ROUNDS) -> Scorer:
    """Logistic regression on soft labels by Adam, classes of equal weight."""
    x = numbers(texts)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / scale, -4, 4)
    key, offsets = _grams(texts)
    text = np.repeat(np.arange(len(label)), np.diff(offsets))
    pair, count = np.unique(text.astype(np.int64) << BITS | key, return_counts=True)
    text, key = pair >> BITS, pair & (1 << BITS) - 1
    value = np.sqrt(count)
    value /= np.sqrt(np.bincount(text, value * value, len(label)))[text]
    weight = np.where(label >= 0.5, 0.5 / max((label >= 0.5).mean(), 1e-3), 0.5 / max((label < 0.5).mean(), 1e-3)) / len(label)
    params = np.zeros((1 << BITS) + z.shape[1] + 1)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for r in range(1, rounds + 1):
        logit = np.bincount(text, value * params[key], len(label)) + z @ params[1 << BITS : -1] + params[-1]
        miss = weight * (1 / (1 + np.exp(-logit)) - label)
        grad = np.concatenate([np.bincount(key, value * miss[text], 1 << BITS), z.T @ miss, [miss.sum()]]) + 1e-5 * params
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        params -= 0.1 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
    return Scorer(params[: 1 << BITS], params[1 << BITS : -1], mean, scale, float(params[-1]))


def score(s: Scorer, texts: pa.Array, x: np.ndarray) -> np.ndarray:
    key, offsets = _grams(texts)
    out = np.zeros(len(texts))
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        count = np.bincount(key[a:b])
        at = np.flatnonzero(count)
        root = np.sqrt(count[at])
        out[i] = root @ s.weights[at] / max(np.sqrt(count[at].sum()), 1.0)
    out += np.clip((x - s.mean) / s.scale, -4, 4) @ s.numbers + s.bias
    return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def _voter():
    def vote(column: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], pa.int64()), *(pa.array(_codes(votes(numbers(p)))) for _, p in tv.slices(column))])

    return F.arrow_udf(vote, "long")


def _scorer(s: Scorer | None, table: dict[int, float]):
    def rate(column: pa.Array) -> pa.Array:
        codes, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
        for _, p in tv.slices(column):
            x = numbers(p)
            codes.append(_codes(votes(x)))
            scores.append(score(s, p, x) if s else np.array([table.get(c, 0.5) for c in codes[-1].tolist()]))
        code = np.concatenate(codes)
        return pa.StructArray.from_arrays([pa.array([table.get(c, 0.5) for c in code.tolist()], pa.float64()), pa.array(np.concatenate(scores), pa.float64()), pa.array(code)], ["weak", "score", "votes"])

    return F.arrow_udf(rate, "weak double, score double, votes long")


def trained(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> tuple[Scorer | None, dict[int, float]]:
    """The labellers' posterior by pattern, from all documents, and the scorer
    from about ``sample`` hashed documents (none if they have one class)."""
    coded = docs.select(F.col(text_col).alias("t"), F.xxhash64(F.col(text_col)).alias("k"), _voter()(F.col(text_col)).alias("v"))
    table = posterior({r["v"]: r["n"] for r in coded.groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()})
    n = docs.count()
    share = min(1.0, sample / n) if n else 0.0
    # distinct texts in hash order: the same sample whatever copies there are,
    # and whichever partitions come first
    rows = docs.select(F.col(text_col).alias("t"), F.xxhash64(F.col(text_col)).alias("k")).where("t is not null")
    place = F.pmod("k", F.lit(1 << 30))
    near = rows.where(place < min(1 << 30, int(2 * share * (1 << 30)) + 1))
    keys = near.select("k").distinct().orderBy(F.pmod("k", F.lit(1 << 30)), "k").limit(sample)
    chosen = near.join(F.broadcast(keys), "k").dropDuplicates(["k"])  # at most ``sample`` keys
    texts = [r["t"] for r in sorted(chosen.collect(), key=lambda r: (r["k"], r["t"]))]
    if not texts:
        return None, table
    col = pa.array(texts, pa.large_string())
    label = np.array([table.get(c, 0.5) for _, p in tv.slices(col) for c in _codes(votes(numbers(p))).tolist()])
    if (label >= 0.5).all() or (label < 0.5).all():
        return None, table
    return fit(col, label), table


def rated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """One row per row of ``docs``: id, weak (posterior of its votes), score
    (of the linear model, 0 to 1), votes (base-3 code) and kept (score of at
    least ``least``).

    A null text counts as empty; both have no words and get the votes of
    that. Null ids and repeated rows are rows of their own; other columns
    aren't read. If the sample has one class only, the score is ``weak``."""
    ship(docs.sparkSession)
    model, table = trained(docs, text_col)
    out = docs.select(F.col(id_col).alias("_id"), _scorer(model, table)(F.col(text_col)).alias("_q"))
    return out.select(F.col("_id").alias(id_col), "_q.*", (F.col("_q.score") >= least).alias("kept"))


def good(docs: DataFrame, text_col: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``docs``, all columns, with a score of at least ``least``."""
    ship(docs.sparkSession)
    model, table = trained(docs, text_col)
    new = fresh(docs, "_quality")
    return docs.withColumn(new, _scorer(model, table)(F.col(text_col))).where(F.col(new)["score"] >= least).drop(new)
