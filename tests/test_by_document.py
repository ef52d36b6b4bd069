"""Storage by document: same rows, no exchange of facts, large documents and rows without an id apart."""

import pytest

import __spark_entry__ as entry
from marginloom.plans import pnl
from marginloom.plans.bindings import Sources
from marginloom.sources.by_document import over_documents, store_by_document


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As at scale: nothing but what is known to be small is broadcast."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "30k")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


FACTS = [("a", n) for n in range(50)] + [("b", 1), ("c", 2), ("c", 3), (None, 4), (None, 5), ("x", 6)]
DOCS = [("a", "A"), ("b", "B"), ("c", "C"), ("d", "D"), (None, "N")]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("buckets", [1, 4])
def test_large_documents_are_kept_apart(make, got, how, buckets):
    facts, docs = make("k STRING, v INT", FACTS), make("k STRING, name STRING", DOCS)
    stored = store_by_document(facts, "k", buckets)
    known = store_by_document(docs, "k", buckets, stored.large)
    assert [r.k for r in stored.large.collect()] == ["a"] * (buckets > 1)
    assert got(stored.all()) == got(facts) and got(known.all()) == got(docs)
    found = over_documents(stored, known, lambda f, d, few: f.join(d, "k", how))
    assert got(found, "k", "v", "name") == got(facts.join(docs, "k", how), "k", "v", "name")


def test_tables_must_be_stored_alike(make):
    facts, docs = make("k STRING, v INT", FACTS), make("k STRING, name STRING", DOCS)
    with pytest.raises(ValueError, match="buckets"):
        over_documents(store_by_document(facts, "k", 2), store_by_document(docs, "k", 3), lambda f, d, few: f)


def test_documents_with_several_rows_of_a_large_id(make, got):
    facts, docs = make("k STRING, v INT", FACTS), make("k STRING, name STRING", DOCS + [("a", str(n)) for n in range(9)])
    stored = store_by_document(facts, "k", 4)
    found = over_documents(stored, store_by_document(docs, "k", 4, stored.large), lambda f, d, few: f.join(d, "k", "left"))
    assert got(found, "k", "v", "name") == got(facts.join(docs, "k", "left"), "k", "v", "name")


def test_ledger_meets_its_bridge_without_an_exchange(spark, no_broadcast):
    s = Sources(spark, "/root/testdata/sf0.01")
    usual = plan(pnl.channel_revenue(s.ledger, s.accounts, entry._bridge(s), s.rules))
    assert "Exchange hashpartitioning(entity_id" in usual
    text = plan(entry._revenue_by_document(s))
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" in text


def test_lines_meet_their_headers_without_an_exchange(spark, no_broadcast):
    s = Sources(spark, "/root/testdata/sf0.01")
    text = plan(entry._invoiced_by_document(s))
    docs = text.split("by_document_")[0]
    assert "Exchange hashpartitioning" not in docs and "SortMergeJoin" in text
