"""Toxicity by weak supervision.

Twelve voters look at every whole text: seed lexicons by family, words learnt
from the labelled rows, and patterns (aimed at a reader, disguised spelling,
shouting, repetition, calm). Each fires or not, so there are at most 2^12 vote
patterns, whatever the corpus.

A generative label model gives every pattern its posterior. Per class it is a
tree of voters: each voter's firing depends on the class and on one other
voter, its parent, so both accuracies and correlations are estimated. The
parents are the maximum spanning tree over the conditional mutual information
of voter pairs (Chow and Liu, 1968; Friedman et al., 1997), and both are
re-estimated in expectation-maximisation over the pattern counts of all
documents. Known labels of training rows are clamped; all others are latent.

A linear classifier over word presence (hashed) and votes learns the posterior
labels of a bounded sample of training rows, with an L1 penalty, so that words
that carry nothing weigh exactly nothing and a long text doesn't gather noise.
The score is the classifier's.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainmeter.llm import textvec as tv
from strainmeter.llm.tables import fresh, ship, small_or_shuffled, written

LEAST = 0.7
#: Sampled training rows for the classifier, for each side of a posterior of
#: one half, and the (row, word) pairs taken from them at most.
SAMPLE = 3000
PAIRS = 6_000_000
#: Learnt words: least documents, share of toxic documents, odds, standard
#: errors of the log odds above 0, contexts by root of documents, and number.
#: Seeds in so many other documents need these odds too.
LEARNT = {"docs": 5, "share": 0.005, "odds": 8.0, "errors": 3.2, "contexts": 2.0, "most": 2000, "refuted": 3}
BITS = 18
ROUNDS = 150
L1 = 1e-3

# Insults of everyday language, by family.
SEEDS = {
    "intellect": "idiot idiots idiotic moron morons moronic stupid dumb dumbass imbecile cretin dimwit brainless fool fools dummkopf trottel crétin débile estúpido imbécil",
    "worth": "loser losers worthless scum trash garbage pathetic useless failure versager abschaum minable ordure basura escoria",
    "ridicule": "clown clowns freak weirdo laughable buffoon witzfigur bouffon payaso",
    "disgust": "disgusting disgrace filthy vile vermin repulsive revolting creep widerlich ekelhaft dégoûtant asqueroso",
    "profane": "bastard bitch asshole crap shit fuck fucking jerk arschloch scheiße connard merde cabrón mierda",
}
READER = "you your yours youre du dich dein deine dir tu toi vous votre usted ustedes"
FAMILIES = (*SEEDS, "learnt_a", "learnt_b")
VOTERS = (*FAMILIES, "repeated", "aimed", "disguised", "shouting", "calm")

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True
# Characters that stand for letters.
_STANDS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[ord(c) for c in _STANDS]] = [ord(c) for c in _STANDS.values()]
_STAND = np.zeros(256, bool)
_STAND[[ord(c) for c in _STANDS]] = True


def _lowered(raw: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the accented letters U+00C0 to U+00DE."""
    low = tv.lowered(raw).copy()
    accent = np.flatnonzero((low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E)) + 1
    low[accent] += 0x20
    return low


def _squeezed(low: np.ndarray) -> np.ndarray:
    """Bytes that aren't the one before them again."""
    keep = np.ones(len(low), bool)
    keep[1:] = low[1:] != low[:-1]
    return keep


def _hash(words: list[str], squeeze: bool = False) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    raw, offsets = tv.view(pa.array(words, pa.large_string()))
    if not squeeze:
        return tv.Prefix(raw).hash(offsets[:-1], offsets[1:] - 1)
    keep = _squeezed(raw)
    at = np.concatenate([[0], np.cumsum(keep)])
    return tv.Prefix(raw[keep]).hash(at[offsets[:-1]], at[offsets[1:] - 1])


class Lexicon:
    """Hashes of the words of each family, sorted."""

    def __init__(self, learnt: list[str], refuted: list[str] = ()) -> None:
        seeds = [(w, f) for f, words in enumerate(SEEDS.values()) for w in words.split() if w not in refuted]
        known = {w for w, _ in seeds}
        words = seeds + [(w, len(SEEDS) + i % 2) for i, w in enumerate(sorted(set(learnt) - known - set(refuted)))]
        self.words = [w for w, _ in words]
        hashes, family = _hash(self.words), np.array([f for _, f in words])
        order = np.argsort(hashes)
        self.hashes, self.family = hashes[order], family[order]
        self.squeezed = np.unique(_hash(self.words, True))
        self.reader = np.unique(_hash(READER.split()))

    def families(self, hashes: np.ndarray) -> np.ndarray:
        """Family of each word; -1 for none."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.family[at], -1)


def _in(sorted_set: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_set, x), len(sorted_set) - 1)
    return sorted_set[at] == x


def _letter_runs(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start, end = tv.runs(_LETTER[low])
    return start, end, np.searchsorted(start, offsets)


def _disguised(low: np.ndarray, offsets: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """Texts with a lexicon word written with other characters (1d10t), drawn
    out (stuuupid) or letter by letter (i d i o t)."""
    found = np.zeros(len(offsets) - 1, bool)
    text = lambda at: np.searchsorted(offsets, at, "right") - 1
    a, b = tv.runs(_LETTER[low] | _STAND[low])
    other = np.concatenate([[0], np.cumsum(_STAND[low])])
    mixed = (other[b] > other[a]) & (b - a > 3)
    a, b = a[mixed], b[mixed]
    if len(a):
        prefix, plain = tv.Prefix(_PLAIN[low]), lambda x: _LETTER[low[x]]
        for c, d in ((a, b), (a, np.maximum(b - ~plain(b - 1), a + 1))):  # a last ! may be a stop
            hit = (lexicon.families(prefix.hash(c, d)) >= 0) & (other[d] > other[c])
            found[text(c[hit])] = True
    triple = np.zeros(len(low) + 1, np.int64)
    triple[3:] = np.cumsum((low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & _LETTER[low[2:]])
    long = triple[end] > triple[np.minimum(start + 2, end)]
    if long.any():
        keep = _squeezed(low)
        at = np.concatenate([[0], np.cumsum(keep)])
        hit = _in(lexicon.squeezed, tv.Prefix(low[keep]).hash(at[start[long]], at[end[long]]))
        found[text(start[long][hit])] = True
    single = end - start == 1
    chain = np.zeros(len(start) + 1, bool)
    if len(start) > 1:
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        chain[: len(start) - 1] = single[:-1] & single[1:] & (start[1:] == end[:-1] + 1) & (doc[1:] == doc[:-1])
    a, b = tv.runs(chain)
    a, b = a[b - a >= 3], b[b - a >= 3] + 1
    if len(a):
        hit = lexicon.families(tv.Prefix(low[start]).hash(a, b)) >= 0
        found[text(start[a[hit]])] = True
    return found


def votes(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """Which voters fire (texts x voters, bool)."""
    raw, offsets = tv.view(texts)
    low = _lowered(raw)
    start, end, first = _letter_runs(low, offsets)
    n, size = np.diff(first), end - start
    hashes = tv.Prefix(low).hash(start, end) if len(start) else np.zeros(0, np.uint64)
    family = lexicon.families(hashes)
    hit = family >= 0
    out = np.zeros((len(n), len(VOTERS)), bool)
    per = lambda x: tv.segment_sums(x.astype(np.int64), first)
    for f in range(len(FAMILIES)):
        out[:, f] = per(family == f) > 0
    hits = per(hit)
    doc = np.repeat(np.arange(len(n)), n)
    reader = _in(lexicon.reader, hashes)
    aimed = np.zeros(len(hashes), bool)
    for s in (1, 2, 3):
        same = doc[s:] == doc[:-s]
        aimed[s:] |= same & hit[s:] & reader[:-s]
        aimed[:-s] |= same & hit[:-s] & reader[s:]
    upper = np.concatenate([[0], np.cumsum((raw >= 65) & (raw <= 90))])
    loud = (upper[end] - upper[start] == size) & (size >= 4)
    stops = np.zeros(len(raw), bool)
    stops[2:] = (raw[2:] == 33) & (raw[1:-1] == 33) & (raw[:-2] == 33)
    disguised = _disguised(low, offsets, start, end, first, lexicon)
    out[:, VOTERS.index("repeated")] = hits >= 3
    out[:, VOTERS.index("aimed")] = per(aimed) > 0
    out[:, VOTERS.index("disguised")] = disguised
    out[:, VOTERS.index("shouting")] = (per(loud) >= np.maximum(5, 0.3 * n)) | (tv.segment_sums(stops.astype(np.int64), offsets) > 0)
    out[:, VOTERS.index("calm")] = (hits == 0) & ~disguised & (n >= 20)
    return out


def codes(v: np.ndarray) -> np.ndarray:
    return v.astype(np.int64) @ (1 << np.arange(v.shape[1]))


# -- the generative label model


@dataclass
class LabelModel:
    prior: float  # of class 1
    parent: list[int]  # of each voter; -1 for the root
    fires: np.ndarray  # [class, voter, parent's state]: probability of firing

    def posterior(self, code: np.ndarray) -> np.ndarray:
        """Probability of class 1 for vote patterns."""
        v = np.asarray(code, np.int64)[:, None] >> np.arange(len(self.parent)) & 1
        logs = []
        for y in (0, 1):
            log = np.full(len(v), np.log(self.prior if y else 1 - self.prior))
            for j, k in enumerate(self.parent):
                p = self.fires[y, j, v[:, k] if k >= 0 else 0]
                log += np.log(np.where(v[:, j] == 1, p, 1 - p))
            logs.append(log)
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def _tree(v: np.ndarray, weight: np.ndarray) -> list[int]:
    """Parents of the maximum spanning tree over the mutual information of
    voter pairs given the class; ``weight`` is [class, pattern]."""
    m = v.shape[1]
    gain = np.zeros((m, m))
    for w in weight:
        total = w.sum() + 2
        on = (w @ v + 1) / total
        both = (v.T @ (w[:, None] * v) + 0.5) / total
        for a, b in ((0, 0), (0, 1), (1, 0), (1, 1)):
            p = both if a and b else (on[:, None] - both if a else (on[None, :] - both if b else 1 - on[:, None] - on[None, :] + both))
            q = (on if a else 1 - on)[:, None] * (on if b else 1 - on)[None, :]
            p = np.maximum(p, 1e-12)
            gain += total / weight.sum() * p * np.log(p / q)
    parent, best = [-1] * m, gain[0].copy()
    source, left = np.zeros(m, int), set(range(1, m))
    while left:
        j = max(left, key=lambda i: (best[i], -i))
        left.remove(j)
        parent[j] = int(source[j])
        closer = gain[j] > best
        best[closer], source[closer] = gain[j][closer], j
    return parent


def _maximised(v: np.ndarray, weight: np.ndarray) -> LabelModel:
    parent = _tree(v, weight)
    fires = np.zeros((2, v.shape[1], 2))
    for y in (0, 1):
        for j, k in enumerate(parent):
            for s in (0, 1):
                w = weight[y] * (v[:, k] == s) if k >= 0 else weight[y]
                alone = (weight[y] @ v[:, j] + 0.5) / (weight[y].sum() + 1)  # rare parent states lean on this
                fires[y, j, s] = (w @ v[:, j] + alone) / (w.sum() + 1)
    prior = (weight[1].sum() + 1) / (weight.sum() + 2)
    return LabelModel(float(prior), parent, np.clip(fires, 1e-6, 1 - 1e-6))


def label_model(counts: dict[tuple[int, int | None], int], rounds: int = 100) -> LabelModel | None:
    """Expectation-maximisation over counts of (vote pattern, known label or
    None). It starts from the known labels if both classes have some, else
    from whether a voter other than ``calm`` fires."""
    if not counts:
        return None
    keys = sorted(counts, key=lambda k: (k[0], -1 if k[1] is None else k[1]))
    code = np.array([k[0] for k in keys], np.int64)
    label = np.array([-1 if k[1] is None else k[1] for k in keys])
    n = np.array([counts[k] for k in keys], float)
    v = (code[:, None] >> np.arange(len(VOTERS)) & 1).astype(float)
    q = np.where(label >= 0, label, np.where(v[:, : VOTERS.index("calm")].any(axis=1), 0.8, 0.05))
    if (label == 0).any() and (label == 1).any():
        start = n * (label >= 0)
        q = np.where(label >= 0, label, _maximised(v, np.stack([start * (1 - q), start * q])).posterior(code))
    model = None
    for _ in range(rounds):
        model = _maximised(v, np.stack([n * (1 - q), n * q]))
        new = np.where(label >= 0, label, model.posterior(code))
        if np.abs(new - q).max() < 1e-7:
            break
        q = new
    return model


# -- the linear classifier


@dataclass
class Classifier:
    words: np.ndarray
    votes: np.ndarray
    bias: float


def _buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word buckets of each text and n + 1 offsets."""
    raw, offsets = tv.view(texts)
    low = _lowered(raw)
    start, end, first = _letter_runs(low, offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    bucket = (tv.Prefix(low).hash(start, end) >> np.uint64(64 - BITS)).astype(np.int64)
    pair = np.unique(np.repeat(np.arange(len(texts)), np.diff(first)) << BITS | bucket)
    return pair & (1 << BITS) - 1, np.searchsorted(pair >> BITS, np.arange(len(texts) + 1))


def fit(key: np.ndarray, offsets: np.ndarray, v: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> Classifier:
    """Logistic regression on soft labels by proximal Adagrad: L1 on words."""
    row = np.repeat(np.arange(len(label)), np.diff(offsets))
    weight = weight / weight.sum()
    w, u, bias = np.zeros(1 << BITS), np.zeros(v.shape[1]), float(np.log((weight @ label + 1e-3) / (1 - weight @ label + 1e-3)))
    gw, gu, gb = np.full(len(w), 1e-8), np.full(len(u), 1e-8), 1e-8
    x = v.astype(float)
    for _ in range(rounds):
        logit = np.bincount(row, w[key], len(label)) + x @ u + bias
        miss = weight * (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - label)
        dw, du, db = np.bincount(key, miss[row], len(w)), x.T @ miss + 1e-5 * u, miss.sum()
        gw, gu, gb = gw + dw * dw, gu + du * du, gb + db * db
        step = 0.5 / np.sqrt(gw)
        w = w - step * dw
        w = np.sign(w) * np.maximum(np.abs(w) - step * L1, 0.0)
        u, bias = u - 0.5 * du / np.sqrt(gu), bias - 0.5 * db / np.sqrt(gb)
    return Classifier(w, u, float(bias))


def score(c: Classifier, texts: pa.Array, v: np.ndarray) -> np.ndarray:
    key, offsets = _buckets(texts)
    logit = tv.segment_sums(c.words[key], offsets) + v @ c.votes + c.bias
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


# -- on Spark


def held_out(id_col: str):
    """Rows whose labels are never read: crc32 of the id as text, modulo 3,
    is 1. A null id isn't held out (and has no label)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def known_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(id, y) of training rows; an id with different labels has none."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
    rows = rows.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("z"))
    return rows.where("y = z").select("id", F.col("y").cast("int").alias("y"))


def learnt_words(known: DataFrame) -> tuple[list[str], list[str]]:
    """From ``known`` (t, y): words that labelled toxic documents have far
    more often than others, by smoothed odds of document counts and by the
    number of different words before them, which a passage that is copied many
    times doesn't raise; and the seeds that these rows refute, such as one
    that is an ordinary word of some language."""
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(1):
        return [], []
    words = known.select("y", F.expr(r"regexp_extract_all(lower(t), '\\p{L}+', 0)").alias("ws"))
    pairs = F.expr("zip_with(ws, concat(array(''), slice(ws, 1, size(ws) - 1)), (w, p) -> struct(w, p))")
    toxic = words.where("y = 1 and size(ws) > 0")
    contexts = toxic.select(F.explode(F.array_distinct(pairs)).alias("x")).select("x.w", "x.p").distinct().groupBy("w").agg(F.count(F.lit(1)).alias("contexts"))
    docs = toxic.select(F.explode(F.array_distinct("ws")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n1"))
    least = max(LEARNT["docs"], LEARNT["share"] * counts[1])
    seeds = sorted({w for family in SEEDS.values() for w in family.split()})
    often = docs.where((F.col("n1") >= least) | F.col("w").isin(seeds)).join(contexts, "w")
    often = written(often, "toxic-words")
    # a document has a bounded number of words on average, so few reach the share
    side = often.select("w").unionByName(known.sparkSession.createDataFrame([(w,) for w in seeds], "w string")).distinct()
    side = small_or_shuffled(side, often.count() + len(seeds))
    other = words.where("y = 0").select(F.explode(F.array_distinct("ws")).alias("w")).join(side, "w", "left_semi").groupBy("w").agg(F.count(F.lit(1)).alias("n0"))
    n0, n1 = F.coalesce("n0", F.lit(0)) + 0.5, F.coalesce("n1", F.lit(0)) + 0.5
    odds = (n1 / (counts[1] + 1)) / (n0 / (counts.get(0, 0) + 1))
    sure = F.log(odds) >= LEARNT["errors"] * F.sqrt(1 / n0 + 1 / n1)
    told = written(often.join(other, "w", "full").withColumn("odds", odds).withColumn("sure", sure), "toxic-odds")
    wide = (F.col("n1") >= least) & (F.col("contexts") >= LEARNT["contexts"] * F.sqrt("n1"))
    best = told.where(wide & F.col("sure") & (F.col("odds") >= LEARNT["odds"])).orderBy((F.col("odds") * F.col("n1")).desc(), "w").limit(LEARNT["most"])
    refuted = told.where(F.col("w").isin(seeds) & (F.coalesce("n0", F.lit(0)) >= LEARNT["refuted"]) & (F.col("odds") < LEARNT["odds"]))
    return sorted(r["w"] for r in best.select("w").collect()), sorted(r["w"] for r in refuted.select("w").collect())


def _voter(lexicon: Lexicon):
    def vote(column: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], pa.int64()), *(pa.array(codes(votes(p, lexicon))) for _, p in tv.slices(column))])

    return F.arrow_udf(vote, "long")


def _bucketer():
    def run(column: pa.Array) -> pa.Array:
        parts = [tv.lists(*_buckets(p), pa.int32()) for _, p in tv.slices(column)]
        return pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *parts])

    return F.arrow_udf(run, "array<int>")


def _scorer(c: Classifier | None, model: LabelModel | None, lexicon: Lexicon):
    def rate(column: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for _, p in tv.slices(column):
            v = votes(p, lexicon)
            out.append(score(c, p, v) if c else model.posterior(codes(v)) if model else np.zeros(len(p)))
        return pa.array(np.concatenate(out))

    return F.arrow_udf(rate, "double")


@dataclass
class Trained:
    lexicon: Lexicon
    model: LabelModel | None
    classifier: Classifier | None

    def voters(self) -> list[tuple[str, float, float, str | None]]:
        """(voter, firing with class 1, with class 0, parent), each for a
        parent that doesn't fire."""
        m = self.model
        return [(v, float(m.fires[1, j, 0]), float(m.fires[0, j, 0]), VOTERS[m.parent[j]] if m.parent[j] >= 0 else None) for j, v in enumerate(VOTERS)] if m else []


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Trained:
    """Learnt words and label model over all rows, the classifier over a
    bounded sample of training rows."""
    known = written(known_labels(labels, id_col), "toxic-labels")
    known = small_or_shuffled(known, known.count())
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), held_out(id_col).alias("held"))
    lexicon = Lexicon(*learnt_words(rows.where("not held").join(known, "id").select("t", "y")))
    voted = written(rows.select("id", "held", F.xxhash64("t").alias("k"), _voter(lexicon)("t").alias("code")), "toxic-votes")
    counts = voted.join(known, "id", "left").groupBy("code", "y").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3 x 2^12 rows
    model = label_model({(r["code"], r["y"]): r["n"] for r in counts})
    if model is None:
        return Trained(lexicon, None, None)
    # texts by hash, the same number from either side of a posterior of 1/2
    sure = [r["code"] for r in counts]
    sure = sorted({c for c, p in zip(sure, model.posterior(np.array(sure)).tolist(), strict=True) if p >= 0.5})
    one = F.col("code").isin(sure) if sure else F.lit(False)
    texts = voted.where("not held").select("k", one.alias("one")).distinct()
    sizes = {r["one"]: r["n"] for r in texts.groupBy("one").agg(F.count(F.lit(1)).alias("n")).collect()}
    keys = {one: [r["k"] for r in texts.where(F.col("one") == one).orderBy("k").limit(sample).collect()] for one in sizes}
    if not all(keys.get(o) for o in (False, True)):
        return Trained(lexicon, model, None)
    chosen = F.broadcast(docs.sparkSession.createDataFrame([(k,) for ks in keys.values() for k in ks], "k long"))  # 2 x sample rows
    found = rows.where("not held").select("t", F.xxhash64("t").alias("k")).join(chosen, "k").select("k", _voter(lexicon)("t").alias("code"), _bucketer()("t").alias("b"))
    found = written(found.dropDuplicates(["k"]), "toxic-sample")
    total, last = 0, {}
    sizes_of = {r["k"]: r["n"] for r in found.select("k", F.size("b").alias("n")).collect()}
    kept: dict[bool, list[int]] = {False: [], True: []}
    for pair in zip(*(keys[o] + [None] * (max(map(len, keys.values())) - len(keys[o])) for o in (False, True)), strict=True):
        for o, k in zip((False, True), pair, strict=True):
            if k is not None and total + sizes_of[k] <= PAIRS:
                total += sizes_of[k]
                kept[o].append(k)
                last[k] = sizes[o]
    if not all(kept.values()):
        return Trained(lexicon, model, None)
    keep = F.broadcast(docs.sparkSession.createDataFrame([(k,) for k in last], "k long"))
    t = found.join(keep, "k").toArrow().sort_by("k")
    code = t["code"].to_numpy()
    b = t["b"].combine_chunks()
    label = model.posterior(code)
    side = {k: sizes[o] / len(ks) for o, ks in kept.items() for k in ks}  # texts that a sampled one stands for
    weight = np.array([side[k] for k in t["k"].to_pylist()])
    v = (code[:, None] >> np.arange(len(VOTERS)) & 1).astype(bool)
    offsets = b.offsets.to_numpy().astype(np.int64)
    return Trained(lexicon, model, fit(b.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64), offsets - offsets[0], v, label, weight))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score and predicted.

    A null text counts as empty; both get the score of a text without words.
    Very long texts are read whole. Null ids aren't held out and have no
    label; repeated rows are rows of their own (copies of a text are one for
    the classifier's sample); an id with different labels has none. Without
    both classes among the posteriors the score is the label model's; without
    rows the result is empty. Other columns aren't read."""
    ship(docs.sparkSession)
    t = trained(docs, labels, id_col, text_col)
    out = docs.select(F.col(id_col).alias("_id"), held_out(id_col).alias("held_out"), _scorer(t.classifier, t.model, t.lexicon)(F.col(text_col)).alias("score"))
    return out.select(F.col("_id").alias(id_col), "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``docs``, all columns, with a score below ``least``."""
    ship(docs.sparkSession)
    t = trained(docs, labels, id_col, text_col)
    new = fresh(docs, "_toxicity")
    return docs.withColumn(new, _scorer(t.classifier, t.model, t.lexicon)(F.col(text_col))).where(F.col(new) < least).drop(new)
