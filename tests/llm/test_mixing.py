from __future__ import annotations

import pytest
from llm_helpers import clashing, edge_docs, empty_docs
from pyspark.sql import functions as F

from assay.llm.mixing import mix, mixed


def _by_source(docs):
    return {
        row["source"]: row
        for row in mix(docs)
        .groupBy("row.source")
        .agg(
            F.first("source_size").alias("size"),
            F.first("target").alias("target"),
            F.sum(F.col("size") * F.col("copies")).alias("taken"),
            F.max("copies").alias("most"),
        )
        .collect()
    }


@pytest.fixture(scope="module")
def sources(spark):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 5 if i % 3 else 0}") for i in range(3000)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_targets_fill_the_budget_under_their_caps(sources):
    found = _by_source(sources)
    total = sum(row["size"] for row in found.values())
    assert sum(row["target"] for row in found.values()) == pytest.approx(1.5 * total)
    weights = dict(zip(sorted(found), (5, 2, 1, 5, 2)))
    free = [name for name, row in found.items() if row["target"] < 2 * row["size"] - 1e-6]
    levels = {round(found[name]["target"] / weights[name], 6) for name in free}
    assert len(levels) == 1
    for name in set(found) - set(free):
        assert found[name]["target"] <= weights[name] * levels.copy().pop() + 1e-6


def test_each_source_comes_near_its_target(sources):
    for row in _by_source(sources).values():
        assert abs(row["taken"] - row["target"]) <= 10
        assert row["most"] <= 2


def test_reruns_agree_at_any_partitioning(sources):
    first = sorted(map(tuple, mix(sources).select("row.doc_id", "copies").collect()))
    again = sorted(map(tuple, mix(sources.repartition(7)).select("row.doc_id", "copies").collect()))
    assert first == again


def test_edge_rows(spark):
    docs = clashing(edge_docs(spark), "size", "key", "range", "row", "cut", "last", "copies", "target")
    found = mix(docs).select("row.*", F.col("copies").alias("n")).collect()
    assert len(found) == docs.count()
    assert all(row["n"] == 0 for row in found if not (row["text"] or "").split())
    assert mixed(docs).columns == docs.columns
    total = sum(row["n"] * len((row["text"] or "").split()) for row in found)
    assert total <= 1.5 * sum(len((row["text"] or "").split()) for row in found)


def test_empty_table_and_empty_texts(spark):
    assert mix(empty_docs(spark)).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id bigint, text string, source string")
    assert [row["copies"] for row in mix(blank).collect()] == [0, 0]


def _skewed(spark):
    """Sources of one repeated id, of null ids, of equal rows, and an ordinary one."""
    rows = [(7, f"{'w ' * (1 + i % 9)}", "one id") for i in range(300)]
    rows += [(None, f"{'w ' * (1 + i % 7)}", "no id") for i in range(300)]
    rows += [(5, "w w w", "equal") for _ in range(300)]
    rows += [(i, "w " * (1 + i % 5), None) for i in range(100)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_sources_of_one_id_or_none_come_within_a_document(spark):
    found = _by_source(_skewed(spark))
    assert len(found) == 4
    for row in found.values():
        assert abs(row["taken"] - row["target"]) <= 9 and row["most"] <= 2


def test_against_a_plain_queue(spark):
    """The mix by a heap-free scan over all copies, in Python."""
    import hashlib

    docs = _skewed(spark)
    targets = {(row["source"] or ""): row["target"] for row in _by_source(docs).values()}
    queues: dict = {}
    for doc_id, text, source in docs.collect():
        key = int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16)
        tie = hashlib.md5(text.encode()).hexdigest()
        queues.setdefault(source, []).append((key, doc_id or 0, tie, len(text.split())))
    copies, words = [], {}
    for source, queue in queues.items():
        total, upto, name = sum(q[3] for q in queue), 0, "" if source is None else f"={source}"
        for place, (key, doc_id, tie, size) in enumerate(sorted(queue)):
            upto += size
            for lap in (0, 1):
                time = (upto + lap * total) / targets[source or ""]
                copies.append((time, name, key, doc_id, tie, place, lap, size))
    left = sum(targets.values())
    served = 0
    for _, name, *_, size in sorted(copies):
        served += size
        if served <= left:
            words[name] = words.get(name, 0) + size
    got = {("" if k is None else f"={k}"): row["taken"] for k, row in _by_source(docs).items()}
    assert got == words


def test_few_shuffles_in_the_stage(spark):
    plan = mixed(_skewed(spark))._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.count("Exchange ") < 30
