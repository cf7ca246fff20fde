"""The pipeline against its stages on a small corpus, and the registered queries' names."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from fernwell.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def test_names():
    assert [k.split("_")[0] for k in sorted(QUERIES, key=lambda k: int(k[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 11)]
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no data")
def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, n = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.stash(stage(spark, docs, DATA), "t")
        assert docs.columns == columns
        n.append(docs.count())
    assert n == sorted(n, reverse=True) and n[0] > n[1] and n[3] == n[4] > 0
    pieces = corpus_pipeline.packed(spark, docs, DATA)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_components_pass_nothing_through_the_driver(spark, monkeypatch):
    from fernwell.llm import shared

    plans, real = [], shared.stash

    def kept(df, label):  # noqa: ANN001, ANN202
        df.collect()  # the plan that ran is known after it
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(shared, "stash", kept)
    edges = spark.range(300).selectExpr("id AS a", "CASE WHEN id % 30 = 0 THEN id ELSE id - 1 END AS b")
    assert {(r.node, r.component) for r in shared.components(edges).collect()} == {(k, k // 30 * 30) for k in range(300)}
    assert len(plans) > 2 and "SortMergeJoin" in "".join(plans) and "BroadcastExchange" not in "".join(plans)
