"""The registered queries against their SQL, and the pipeline's stages on the smallest tables."""

import corpus_pipeline
import pytest
from compare import compare, connect

import __spark_entry__ as entry
from millrace.llm import toxicity
from millrace.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", SQL)
def test_query(spark, name):
    assert compare(spark, connect(SF_DIR), QUERIES[name], SQL[name], SF_DIR) is None


def test_pipeline(spark, tmp_path):
    docs = first = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in first.schema]
            counts.append(docs.count())
        if i == 0:
            labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
            scores = {r.doc_id: r.score for r in toxicity.score(first, toxicity.fit(first, labels)).collect()}
            assert {r.doc_id for r in docs.collect()} == {d for d, s in scores.items() if s < toxicity.THRESHOLD}
        if i == 1:
            assert all(r.n_chars == len(r.text) for r in docs.collect() if r.text is not None)
    assert counts == sorted(counts, reverse=True) and counts[1] == counts[2]
    kept = {r.doc_id for r in spark.read.parquet(str(tmp_path / "3")).collect()}
    assert {r.doc_id for r in docs.collect()} == kept and {"sequence_id", "offset", "length"} <= set(docs.columns)
