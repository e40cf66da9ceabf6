"""The registered queries against their SQL, and the pipeline against a plain version."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import check  # noqa: E402
import corpus_pipeline  # noqa: E402
from hydrolens.llm import bpe, mixing, quality, queries  # noqa: E402
from tests.llm import brute  # noqa: E402
from tests.llm.test_operators import AWKWARD, DOCS, awkward, library_once  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle()))
def test_query_equals_sql(spark, name):
    assert check.compare(spark, check.duck(SMALL), queries.queries()[name], queries.oracle()[name], SMALL) is None


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle())))
def test_query_returns_each_row(spark, name):
    table = "embeddings" if name == "op6_cover_tree" else "documents"
    rows = queries.queries()[name](spark, SMALL)
    assert rows.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_every_operator_has_a_query():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)}
    assert names >= set(queries.queries()) | {"pipeline"}


def test_pipeline_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    vectors = quality.with_statistics(docs.select("doc_id", "text")).drop("text")
    model = quality.train(vectors, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = {r.doc_id: r for r in docs.collect()}
    import numpy as np

    kept = [i for i in sorted(rows) if model.score(np.array([quality.statistics(rows[i].text)]))[0] >= corpus_pipeline.LEAST_SCORE]
    cut = brute.line_dedup([(i, rows[i].text) for i in kept], 50)
    cut = {i: text for i, (text, _, emptied) in cut.items() if not emptied}
    texts = {i: cut[i] for i, c in brute.near_duplicates(cut, corpus_pipeline.LEAST_PERCENT).items() if i == c}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert sorted(got) == sorted(texts)
    for i, text in texts.items():
        assert got[i].ids == library_once().encode(text, add_special_tokens=False).ids
        assert got[i].decoded_sha256 == brute.sha(text) and got[i].source == rows[i].source


def test_pipeline_returns_rows_in_the_order_of_the_mix(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files
    try:
        rows = corpus_pipeline.run(spark, SMALL).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    places = [(r.mix_slot, r.mix_offset) for r in rows]
    assert places == sorted(places) and len({r.source for r in rows}) > 1
    sizes = {r.doc_id: len(r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    totals, offsets = {}, {}
    for r in rows:
        text = library_once().decode(r.ids, skip_special_tokens=False)
        assert brute.sha(text) == r.decoded_sha256 and len(text) <= sizes[r.doc_id]
        assert r.mix_offset == offsets.get(r.source, 0)  # the documents of a source follow each other
        totals[r.source] = offsets[r.source] = r.mix_offset + len(text)
    whole, cycle = mixing.shares(mixing.tempered({f"={s}": n for s, n in totals.items()}))
    for r in rows:
        share, block = whole[f"={r.source}"], r.mix_offset // mixing.BLOCK_CHARS
        assert block * cycle // share <= r.mix_slot < -(-(block + 1) * cycle // share)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name


def test_stages_with_awkward_tables(spark):
    full, empty = awkward(spark), awkward(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0, name
        assert stage(spark, full, SMALL).count() <= len(AWKWARD), name
    assert [f.name for f in spark.createDataFrame([], DOCS).schema] == corpus_pipeline.COLUMNS


def test_mixing_keeps_every_row(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(r.doc_id for r in corpus_pipeline.mixed_sources(spark, docs, SMALL).collect()) == sorted(r.doc_id for r in docs.collect())
    assert bpe.public_path().endswith("byte_bpe_50k.json")
