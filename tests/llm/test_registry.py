"""The registered queries against their SQL on the smallest tables, and against the contract where there is none."""

import pytest

import corpus_pipeline
from remitlens.llm import registry
from remitlens.verification.compare import connect, difference
from tests.llm import brute


@pytest.fixture(scope="module")
def db(tables):
    return connect(tables)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, tables, db, name):
    assert difference(registry.QUERIES[name](spark, tables), db.execute(registry.ORACLE[name])) is None


def documents(spark, tables):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]


def test_license_query(spark, tables):
    got = {r.doc_id: r for r in registry.QUERIES["op3_license_scan"](spark, tables).collect()}
    for i, text in documents(spark, tables):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licenses(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_personal_data_query(spark, tables):
    got = {r.doc_id: r for r in registry.QUERIES["op5_personal_data"](spark, tables).collect()}
    for i, text in documents(spark, tables):
        spans, r = brute.personal(text), got[i]
        listed = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(k == s[0] for s in spans) for k in ("email", "ip", "card", "phone")]
        assert r.base_sha256 == brute.sha(",".join(listed)) and set(listed) <= set(r.spans.split(",")) | {""}


def test_suffix_query(spark, tables):
    given = documents(spark, tables)
    got = {r.doc_id: tuple(r)[1:] for r in registry.QUERIES["op7_suffix_dedup"](spark, tables).collect()}
    assert got == {i: want for (i, _), want in zip(given, brute.repeats([t for _, t in given], 400), strict=True)}


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
