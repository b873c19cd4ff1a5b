import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strainmeter.llm import spellings

from .conftest import collected

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def words_of(key, text):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
        h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
        if h % 199 == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= 6:
            yield run


def near(u, v):
    if abs(len(u) - len(v)) > 1 or u == v:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def brute(rows):
    n = {w: c for w, c in Counter(w for key, t in rows for w in words_of(key, t)).items() if c >= 5}
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    links = {w: [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size.get(size, []) if near(w, v)] for w in n}
    form = {}
    for w, vs in links.items():
        if vs:
            best = min(vs, key=lambda v: (-n[v], v))
            if n[best] >= 5 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(links[w]), n[form[w]] if w in form else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def noisy():
    """Texts over variants of few stems, counts falling by powers."""
    rng = np.random.default_rng(4)
    letters = list("abcdeéÿÀ")
    stems = ["".join(rng.choice(letters, 7)) for _ in range(12)] + ["abcabca", "abcabcaa", "aaaaaa", "aaaaaaa"]
    pool = list(stems)
    for _ in range(500):
        w = list(pool[rng.integers(len(pool))])
        kind, at = rng.integers(3), int(rng.integers(len(w) + 1))
        w[at : at + (kind > 0)] = [] if kind == 1 else [str(rng.choice(letters))]
        pool.append("".join(w))
    rank = np.arange(1, len(pool) + 1)
    share = 1 / rank**1.3
    texts = []
    for _ in range(500):
        some = rng.choice(len(pool), int(rng.integers(0, 90)), p=share / share.sum())
        texts.append(" ".join(pool[i].upper() if rng.random() < 0.2 else pool[i] for i in some) + "0x×ābc")
    return [(int(i) - 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("bound,states", [(50_000, 1 << 20), (5, 64), (1, 1 << 20)])
def test_variants_equal_brute_force(spark, monkeypatch, noisy, bound, states):
    monkeypatch.setattr(spellings, "STATES", states)
    want = brute(noisy)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] and r[1] != r[2] for r in want)
    df = spark.createDataFrame(noisy, "doc_id long, text string").repartition(7)
    assert collected(spellings.variants(df, bound=bound), *COLUMNS) == want


def test_documents_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert collected(spellings.variants(df), *COLUMNS) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_runs_and_their_edits():
    rng = np.random.default_rng(1)
    alphabet = list("abZÀÿ×¿Āẞ\U0001f642 -9")
    texts = ["".join(rng.choice(alphabet, int(rng.integers(0, 60)), p=[0.2, 0.2, 0.1, 0.1, 0.1, 0.1, *[0.2 / 7] * 7])) for _ in range(3000)] + ["", "x" * 5000]
    ids = [str(i * 7919) for i in range(len(texts))]
    got = Counter(spellings.runs_of(pa.array(texts, pa.large_string()), ids).to_pylist())
    assert got == Counter(w for i, t in zip(ids, texts) for w in words_of(i, t))


def test_band_states_equal_the_edit_matrix():
    rng = np.random.default_rng(6)
    rest = sorted({"".join(rng.choice(list("abc"), int(rng.integers(0, 6)))) for _ in range(150)})
    group = np.zeros(len(rest), np.int64)
    i, j = spellings.near_pairs(group, rest)
    assert sorted(zip(i.tolist(), j.tolist())) == [(a, b) for a, u in enumerate(rest) for b, v in enumerate(rest) if near(u, v)]
    assert len(spellings.near_pairs(group[:0], [])[0]) == 0


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(None, "banana banana")] * 3
    df = odd.unionByName(spark.createDataFrame(rows[-3:], "doc_id long, text string"), allowMissingColumns=True)
    got = collected(spellings.variants(df.withColumnRenamed("lang", "word").withColumnRenamed("source", "key")), *COLUMNS)
    assert got == brute(rows) and any(r[0] == "banana" for r in got)
    assert spellings.variants(df.limit(0)).collect() == []
    long = [(i, "ab" * 30_000 + " " + "ab" * 29_999 + "a") for i in range(5)]
    got = spellings.variants(spark.createDataFrame(long, "doc_id long, text string")).collect()
    assert sorted((len(r.word), r.n_near) for r in got) == sorted((len(w), k) for w, _, _, _, k, _ in brute(long))
