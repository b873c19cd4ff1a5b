import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strainmeter.llm import toxicity

from .conftest import collected

SF = "/root/testdata/sf0.1"


def fired(text, learnt=(), refuted=()):
    v = toxicity.votes(pa.array([text], pa.large_string()), toxicity.Lexicon(list(learnt), list(refuted)))[0]
    return {name for name, on in zip(toxicity.VOTERS, v) if on}


def test_voters():
    calm = "words about the weather in the north and what the farmers say of it, with some rain to come and more wind later on"
    assert fired(calm) == {"calm"}
    assert fired("") == fired("1234 !!") == fired("a b c d") == set()
    assert fired("What an Idiot, a CLOWN and a loser") == {"intellect", "ridicule", "worth", "repeated"}
    assert fired("you are such a clown") == {"ridicule"}  # four words apart
    assert fired("you silly clown") == {"ridicule", "aimed"}
    assert fired("Dégoûtant") == fired("DÉGOÛTANT") == {"disgust"}
    for text in ("an 1d10t", "st*pid stuuuupid", "i d i o t", "I.D.I.O.T", "1d10t!", "cl0wn", "a$$hole"):
        assert "disguised" in fired(text), text
    for text in ("an ox", "2021 items", "wooooords", "a b c d e f", "idio t", "trash1", "clown5!!"):
        assert "disguised" not in fired(text), text
    assert fired("HELLO THIS TEXT SHOUTS VERY LOUD") == {"shouting"} and "shouting" in fired("no!!!")
    assert fired("zorbly", ["zorbly"]) == {"learnt_a"} and fired("trash", refuted=["trash"]) == set()
    texts = ["you silly", "clown", "i d", "i o t"]  # nothing runs from one text into the next
    assert not toxicity.votes(pa.array(texts, pa.large_string()), toxicity.Lexicon([]))[:, toxicity.VOTERS.index("aimed") :].any()


def test_label_model_finds_accuracies_and_correlations():
    """Votes drawn from a known model: voter 1 copies voter 0 nine times of
    ten, so the two together mean little more than one of them."""
    rng = np.random.default_rng(3)
    n, m = 60_000, len(toxicity.VOTERS)
    y = rng.random(n) < 0.2
    hit, false = np.linspace(0.75, 0.45, m), np.linspace(0.03, 0.12, m)
    v = rng.random((n, m)) < np.where(y[:, None], hit, false)
    v[:, 1] = np.where(rng.random(n) < 0.9, v[:, 0], v[:, 1])
    known = [int(a) if b else None for a, b in zip(y, rng.random(n) < 0.02)]
    code = toxicity.codes(v)
    model = toxicity.label_model(dict(Counter(zip(code.tolist(), known))))
    assert abs(model.prior - y.mean()) < 0.02
    assert 0 in (model.parent[1], *(j for j, p in enumerate(model.parent) if p == 1))
    for j in range(2, m):
        for c in (0, 1):
            assert np.abs(model.fires[c, j].mean() - v[y == c, j].mean()) < 0.08
    p = model.posterior(code)
    assert ((p >= 0.5) == y).mean() > 0.97
    both = int(toxicity.codes(np.arange(m)[None] < 2)[0])
    naive = np.log(hit[0] * hit[1] / (false[0] * false[1])) + np.log((1 - hit[2:]) / (1 - false[2:])).sum() + np.log(0.25)
    truth = np.log(hit[0] / false[0]) + np.log((0.9 + 0.1 * hit[1]) / (0.9 + 0.1 * false[1])) + np.log((1 - hit[2:]) / (1 - false[2:])).sum() + np.log(0.25)
    got = model.posterior(np.array([both]))[0]
    assert abs(np.log(got / (1 - got)) - truth) < abs(np.log(got / (1 - got)) - naive) / 3
    assert toxicity.label_model({}) is None
    alone = toxicity.label_model({(int(c), None): k for c, k in Counter(code.tolist()).items()})
    assert ((alone.posterior(code) >= 0.5) == y).mean() > 0.95


def test_posterior_equals_the_product_of_its_factors():
    model = toxicity.LabelModel(0.3, [-1, 0, 1], np.array([[[0.1, 0.1], [0.2, 0.6], [0.3, 0.4]], [[0.7, 0.7], [0.5, 0.9], [0.8, 0.2]]]))
    for code in range(8):
        v = [code >> j & 1 for j in range(3)]
        p = [1 - model.prior, model.prior]
        for y in (0, 1):
            for j, k in enumerate(model.parent):
                f = model.fires[y, j, v[k] if k >= 0 else 0]
                p[y] *= f if v[j] else 1 - f
        assert model.posterior(np.array([code]))[0] == pytest.approx(p[1] / sum(p))


def test_held_out_rows_and_their_labels(spark):
    ids = [*range(-5, 400), 10**12]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "doc_id long")
    got = {r.doc_id: r.h for r in df.select("doc_id", toxicity.held_out("doc_id").alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in ids} | {None: False}
    labels = spark.createDataFrame([(i, 1) for i in ids] + [(None, 1), (2, 0), (3, None), (4, 7)], "doc_id long, toxic int")
    assert {r.id for r in toxicity.known_labels(labels).collect()} == {i for i in ids if not got[i]} - {2}


def test_held_out_accuracy_and_labels_of_held_out_rows_unread(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    out = toxicity.scored(docs, labels)
    rows = out.join(docs.select("doc_id", "text"), "doc_id").join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    told = "loser idiot pathetic scum worthless moron trash clown disgusting stupid".split()  # what marks toxic texts of these tables
    marked = {r.doc_id for r in rows if any(w in told for w in (r.text or "").lower().replace(".", " ").replace(",", " ").split())}
    held = [r for r in rows if r.held_out and r.toxic is not None]
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted for r in held if r.toxic and r.doc_id in marked) >= 0.97 * sum(1 for r in held if r.toxic and r.doc_id in marked)
    assert sum(r.predicted for r in held if not r.toxic) <= 0.005 * sum(1 for r in held if not r.toxic)
    flipped = labels.select("doc_id", toxicity.F.when(toxicity.held_out("doc_id"), 1 - labels["toxic"]).otherwise(labels["toxic"]).alias("toxic"))
    again = {r.doc_id: r.score for r in toxicity.scored(docs.repartition(13), flipped).collect()}
    assert again == pytest.approx({r.doc_id: r.score for r in rows}, abs=1e-9)


def test_learnt_words_and_refuted_seeds(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 4))
    text = lambda extra: " ".join([word() for _ in range(30)] + [x for e in extra for x in (word(), e)])
    rows = [(text(["grumbo"] + ["vile"] * (i % 4 == 0)), 1) for i in range(60)] + [(text(["vile"] * (i % 3 == 0)), 0) for i in range(300)]
    rows += [(text([]) + " copied passage zibzab here", 1)] * 40
    df = spark.createDataFrame(rows, "t string, y int")
    learnt, refuted = toxicity.learnt_words(df)
    assert "grumbo" in learnt and not {"zibzab", "copied", "passage"} & set(learnt) and refuted == ["vile"]
    assert toxicity.learnt_words(df.limit(0)) == ([], [])


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (5, 0, 1), (7, 1, 0), (None, 1, 1), (9, None, 0)], "doc_id long, toxic int, id int")
    got = toxicity.scored(odd, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert by[1] == by[2] and by[4] == by[5] and len(by[6]) == 1
    assert toxicity.scored(odd.limit(0), labels).collect() == []
    assert len(toxicity.scored(odd, labels.limit(0)).collect()) == odd.count()
    kept = toxicity.clean(odd, labels.limit(0))
    assert kept.columns == odd.columns
    assert collected(kept, "doc_id") == collected(odd, "doc_id")
    shown = spark.createDataFrame([(i, "you stupid clown, pathetic loser") if i % 4 == 0 else (i, f"a quiet text number {i} that says what it says about one thing and then ends without saying any more at all") for i in range(400)], "doc_id long, text string")
    scores = {r.doc_id: r.predicted for r in toxicity.scored(shown, labels.limit(0)).collect()}
    assert all(p == (i % 4 == 0) for i, p in scores.items())
