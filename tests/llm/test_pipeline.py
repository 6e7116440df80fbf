"""The corpus pipeline stage by stage on awkward tables, and its whole run against brute force."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from upkeep.llm.support import shared_folder, stored

FILTERS = corpus_pipeline.STAGES[:-1]
WHITE = {ord(c): None for c in " \t\n\v\f\r"}


@pytest.fixture(scope="module")
def documents(spark):
    """Documents with nulls, empties, repeated rows and further columns whose names the operators use themselves."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = [(None, "no id at all but some words"), (900001, None), (900002, ""), (900003, "x " * 50_000)]
    odd += [(900004, "a row that is repeated as it is"), (900004, "a row that is repeated as it is")]
    odd = spark.createDataFrame(odd, "doc_id long, text string")
    odd = odd.withColumns({n: F.lit(None).cast(docs.schema[n].dataType) for n in docs.columns if n not in ("doc_id", "text")})
    rows = docs.unionByName(odd.select(docs.columns)).withColumns(
        {n: F.lit("own") for n in ("score", "kept", "row", "key", "digest", "print", "bands", "group", "start", "ids", "label")}
    )
    return stored(rows, shared_folder(spark), "documents")


@pytest.fixture(scope="module")
def sf_dir(spark, documents, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.01/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("name, stage", FILTERS)
def test_stages_keep_columns_and_rows_unchanged(spark, documents, sf_dir, name, stage):
    kept = stage(spark, documents, sf_dir)
    assert kept.columns == documents.columns
    assert kept.exceptAll(documents).count() == 0 and 0 < kept.count() <= documents.count()
    assert stage(spark, documents.limit(0), sf_dir).count() == 0


def test_a_repeated_row_stays_once(spark, documents, sf_dir):
    for name in ("exact_dedup", "near_dedup"):
        kept = dict(FILTERS)[name](spark, documents, sf_dir)
        assert kept.where("doc_id = 900004").count() == 1, name


def test_exact_stage_against_brute_force(spark, documents, sf_dir):
    first = {}
    for row in documents.select("doc_id", "text").collect():
        plain = hashlib.sha256((row.text or "").translate(WHITE).encode()).digest()
        rank = (-len(row.text or ""), row.doc_id is None, row.doc_id or 0)
        first[plain] = min(rank, first.get(plain, rank))
    kept = dict(FILTERS)["exact_dedup"](spark, documents, sf_dir).select("doc_id").collect()
    want = sorted(None if none else key for _, none, key in first.values() if not none)
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == want


def test_whole_run_packs_what_is_left(spark, sf_dir):
    pieces = corpus_pipeline.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert 0 < pieces.select("doc_id").distinct().count() < docs.count()
    whole = pieces.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n"))
    assert whole.where("doc_id is not null and n <> doc_tokens").count() == 0
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
