"""The registered queries on the small tables: against SQL, against plain Python, or by what they promise."""

import re

import pytest

import corpus_pipeline
from granero.llm import stages
from granero.llm.oracle import ORACLE
from granero.llm.queries import QUERIES, table
from oracle.compare import connect, difference
from tests.conftest import plan


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_one_query_per_operator():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES] == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, small, con, name):
    assert difference(QUERIES[name](spark, small), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op5_pii"])
def test_native_queries_run_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small), "simple")
    for unwanted in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert unwanted not in text


def test_learned_queries_score_every_document(spark, small):
    documents = {r["doc_id"]: r for r in table(spark, small, "documents").collect()}
    toxic = QUERIES["op3_toxicity"](spark, small).collect()
    assert sorted(r["doc_id"] for r in toxic) == sorted(documents)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in toxic)
    found = QUERIES["op4_language_id"](spark, small).collect()
    aside = [r for r in found if r["held_out"]]
    assert sorted(r["doc_id"] for r in found) == sorted(documents)
    assert sum(r["lang_pred"] == documents[r["doc_id"]]["lang"] for r in aside) >= 0.9 * len(aside)


def test_pipeline_keeps_columns_and_clean_documents(spark, small):
    docs = table(spark, small, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, small)
        assert docs.columns == columns and docs.dtypes == table(spark, small, "documents").dtypes, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.4 * sizes[0]
    assert sizes[1] == sizes[2]  # line dedup keeps all rows
    packed = stages.pack(spark, docs, small)
    assert packed.select("doc_id").distinct().count() == sizes[-1]


def test_pipeline_on_empty_documents(spark, small):
    docs = table(spark, small, "documents").limit(0)
    for _, apply in corpus_pipeline.STAGES:
        docs = apply(spark, docs, small)
    assert docs.count() == 0
