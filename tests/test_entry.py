"""Driver contract: entry, queries, oracle names."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 50


def test_oracles_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_corpus_queries_come_with_their_subpackage_only():
    from strainmeter.plans import catalog

    corpus = {n for n in E.queries() if n == "pipeline" or n.startswith("op")}
    assert bool(corpus) == bool(E.llm)
    assert not corpus & set(catalog.queries())
