"""The registered text queries over whole tables: against SQL or brute force, and the pipeline."""

import hashlib

import oracle
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from layerwright.llm import bpe, langid
from layerwright.llm import queries as text_queries

import test_dedup
import test_near_copies
import test_scans


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connection(folder)


@pytest.fixture(scope="module")
def docs(con):
    return con.sql("SELECT doc_id, text, lang FROM documents").fetchall()


def rows(spark, folder, name):
    return text_queries.QUERIES[name](spark, folder).collect()


def test_all_thirteen_and_the_pipeline_are_registered():
    names = entry.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14))
    assert names["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(text_queries.ORACLES))
def test_query_matches_sql(spark, folder, con, name):
    found = text_queries.QUERIES[name](spark, folder).toArrow()
    expected = con.sql(text_queries.ORACLES[name]).to_arrow_table()
    assert oracle.differences(found, expected) == []


def test_op1(spark, folder, docs):
    found = {r["doc_id"]: r["base_sha256"] for r in rows(spark, folder, "op1_secret_scan")}
    for doc_id, text, _ in docs:
        joined = ",".join(f"{k}:{s}:{e}" for s, e, k in test_scans.brute_spans(text or ""))
        assert found[doc_id] == hashlib.sha256(joined.encode()).hexdigest()


def test_op3(spark, folder, docs):
    found = rows(spark, folder, "op3_quality_score")
    assert len(found) == len(docs) and all(0 <= r["score"] <= 1 for r in found)


def test_op5(spark, folder, docs):
    found = {r["doc_id"]: tuple(r)[1:6] for r in rows(spark, folder, "op5_license_scan")}
    assert found == {doc_id: test_scans.brute_licence(text or "") for doc_id, text, _ in docs}


def test_op6(spark, folder, docs):
    found = rows(spark, folder, "op6_simhash_components")
    prints = {doc_id: test_dedup.plain_fingerprint(text or "") for doc_id, text, _ in docs}
    assert {r["doc_id"]: r["fingerprint"] for r in found} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in found} == test_dedup.brute_components(prints)


def test_op7(spark, con):
    folder = "/root/testdata/sf0.001"
    given = con.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall()
    found = [tuple(r) for r in rows(spark, folder, "op7_repeated_bytes")]
    assert sorted(found, key=str) == test_dedup.brute_removed(given)


def test_op10(spark, folder, docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = bpe.read_ranks(file)
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r["doc_id"]: r["ids_sha256"] for r in rows(spark, folder, "op10_byte_bpe")}
    for doc_id, text, _ in docs:
        ids = ",".join(map(str, other.encode_ordinary(text or "")))
        assert found[doc_id] == hashlib.sha256(ids.encode()).hexdigest()


def test_pipeline_against_its_definition(spark, folder, docs):
    """Each stage's decisions made again without Spark, but for the language model."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    known = {r["doc_id"] for r in langid.known_rows(frame, langid.train(frame)).collect()}
    left = [(i, t) for i, t, _ in docs if i in known]
    first = {min(ids) for ids in test_dedup.brute_groups(left).values()}
    left = [(i, t) for i, t in left if i in first]
    first = test_near_copies.brute_firsts(left)
    left = [(i, t) for i, t in left if i in first]
    texts = dict(left)
    whole = [" ".join(r["text"].lower().split()) for r in items]
    leaked = {i for i, t in texts.items() if any(w in " ".join((t or "").lower().split()) for w in whole)}
    found = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(found) == set(texts) - leaked
    assert all(found[i] == hashlib.sha256((texts[i] or "").encode()).hexdigest() for i in found)


def test_pipeline_odd_rows(spark, make_docs, odd_rows, folder):
    docs = make_docs(odd_rows + [(i, "und der die das " + "zwei drei " * i, "de") for i in range(20, 40)])
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, folder)
        if name != "tokens":
            assert found.columns == docs.columns
            docs = found
        found.collect()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, make_docs([]), folder).collect() == []
