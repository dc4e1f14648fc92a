from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from llm_helpers import clashing, edge_docs, empty_docs
from pyspark.sql import functions as F

from assay.llm import quality_fm as fm
from assay.llm.text import fold


def test_margin_is_the_sum_over_pairs():
    random = np.random.default_rng(1)
    texts = ["one two three. four", "", "A | b | c\nA | b | c", "word " * 50]
    found = [fm.features(t, None) for t in texts]
    statistics = np.array([s for _, s in found])
    machine = fm.fit([w for w, _ in found], statistics, np.array([1.0, 0.0, 0.0, 1.0]))
    machine.weight[:] = random.normal(size=machine.weight.shape)
    machine.vector[:] = random.normal(size=machine.vector.shape)
    places, values, heads, counts = machine.coordinates([w for w, _ in found], statistics)
    got, _ = machine.margins(places, values, heads)
    for margin, head, count in zip(got, heads, counts):
        own, x = places[head : head + count], values[head : head + count]
        pairs = sum(
            machine.vector[own[i]] @ machine.vector[own[j]] * x[i] * x[j]
            for i, j in combinations(range(count), 2)
        )
        assert margin == pytest.approx(machine.bias + machine.weight[own] @ x + pairs)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id < 4000")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held_out = fold(F.col("doc_id"), 5) == 0
    machine = fm.train(docs, labels, ~held_out)
    found = (
        fm.score(docs.filter(held_out), machine)
        .join(labels, F.col("row.doc_id") == labels["doc_id"])
        .select("quality", "score")
        .collect()
    )
    right = sum((row["score"] >= 0.3) == (row["quality"] == 1) for row in found)
    assert len(found) > 100 and right >= 0.95 * len(found)


def test_edge_rows(spark):
    docs = clashing(edge_docs(spark), "row", "body", "length", "score", "label", "sample_id", "id")
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, None), (None, 1), (5, 1), (7, 0), (99, 0)], "doc_id bigint, quality int"
    )
    machine = fm.train(docs, labels, F.lit(True))
    found = fm.score(docs, machine).collect()
    assert len(found) == docs.count() and all(0 <= row["score"] <= 1 for row in found)
    assert len({row["score"] for row in found if row["row"]["text"] == "One plain line of text."}) == 1
    assert fm.score(empty_docs(spark), machine).count() == 0


def test_without_labels_the_score_is_one_half(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    machine = fm.train(edge_docs(spark), labels, F.lit(True))
    assert {round(row["score"], 9) for row in fm.score(edge_docs(spark), machine).collect()} == {0.5}
    assert fm.train(empty_docs(spark), labels, F.lit(True)).bias == 0


def test_the_sample_is_bounded_and_repeatable(spark):
    docs = spark.createDataFrame([(i, f"text {i}", None) for i in range(50)], "doc_id bigint, text string, n_chars bigint")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id bigint, quality int")
    a = fm.train(docs, labels, F.lit(True), rows=10)
    b = fm.train(docs.repartition(3), labels.repartition(5), F.lit(True), rows=10)
    assert a.bias == b.bias and (a.vector == b.vector).all()


def test_an_id_of_many_documents_is_learnt_from_once(spark, monkeypatch):
    seen = []
    fit = fm.fit
    monkeypatch.setattr(fm, "fit", lambda words, *rest: seen.append(len(words)) or fit(words, *rest))
    docs = spark.range(600).select(
        F.when(F.col("id") < 300, 1).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("text "), "id").alias("text"),
        F.lit(None).cast("bigint").alias("n_chars"),
    )
    labels = spark.createDataFrame([(1, 1)] * 20 + [(400, 0)] * 20, "doc_id bigint, quality int")
    machines = [
        fm.train(frame, labels, F.lit(True), rows=2) for frame in (docs, docs.repartition(7, "text"))
    ]
    assert seen == [2, 2]
    assert machines[0].bias == machines[1].bias and (machines[0].vector == machines[1].vector).all()
