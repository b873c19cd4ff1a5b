import hashlib

import corpus_pipeline
import __spark_entry__ as entry
from strainmeter.llm import bagminhash, catalog, decontaminate, language, packing, secretscan
from strainmeter.llm.tables import written

from .conftest import collected

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, docs):
    """Each stage's effect on its own input, and the rows of run()."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, written(stage(spark, now, SF), "test-stage")
        assert now.columns == docs.columns, name
        kept = {r.doc_id for r in now.collect()}
        if name == "language":
            want = {r.doc_id for r in language.languages(before).where("lang_pred <> 'und' and score >= 0.5").collect()}
        elif name == "near_duplicates":
            want = {r.doc_id for r in bagminhash.near_duplicates(before).where("kept").collect()}
        elif name == "decontamination":
            want = {r.doc_id for r in before.collect()} - {r.doc_id for r in decontaminate.contaminated(before, bench).collect()}
        else:
            want = {r.doc_id for r in before.collect()}
            assert not any(secretscan.spans(r.text) for r in now.collect())
        assert kept == want, name
    want = collected(packing.packed(now, with_ids=False), "doc_id", "start", "length", "ids_crc32")
    got = corpus_pipeline.run(spark, SF)
    assert {x[0] for x in want} == {r.doc_id for r in got.collect()}
    tokens = lambda df: collected(df.groupBy("doc_id").sum("length"), "doc_id", "sum(length)")
    assert tokens(got) == tokens(packing.packed(now, with_ids=False))


def test_pipeline_takes_odd_rows(spark, odd):
    for docs in (odd, odd.limit(0)):
        now = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = written(stage(spark, now, SF), "odd-stage")
            assert now.columns == odd.columns
        corpus_pipeline.STAGES[-1][1](spark, now, SF).count()


def test_queries_are_registered():
    found = entry.queries()
    assert set(catalog.QUERIES) | {"pipeline"} <= set(found)
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))


def test_digest_columns(spark):
    want = {
        "op1_secretscan": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
        "op5_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
        "op7_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
        "op8_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
        "op9_language": {"doc_id", "held_out", "lang_pred", "score"},
        "op10_vectors": {"vec_id", "n_links", "component_id", "kept"},
        "op11_toxicity": {"doc_id", "held_out", "score", "predicted"},
        "op12_centroids": {"vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"},
        "op13_spellings": {"word", "form", "root", "n", "n_near", "form_n"},
    }
    for name, cols in want.items():
        assert cols <= set(entry.queries()[name](spark, SF).columns), name
    assert hashlib.sha256(b"").hexdigest() in {r.base_sha256 for r in entry.queries()["op1_secretscan"](spark, SF).collect()}
