"""The manifest against a plain Merkle tree in Python."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from llm_helpers import clashing, edge_docs, empty_docs
from pyspark.sql import functions as F

from assay.llm import merkle


def _h(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _leaf(*values) -> str:
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _tree(leaves: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for each leaf the siblings left and right at each level."""
    ways: list[list[tuple[str, str]]] = [[] for _ in leaves]
    under = [[i] for i in range(len(leaves))]
    nodes = leaves
    while len(nodes) > 1:
        upper, covered = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for k in range(len(run)):
                for i in under[at + k]:
                    ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            upper.append(_h(*run))
            covered.append([i for k in range(len(run)) for i in under[at + k]])
        nodes, under = upper, covered
    return nodes[0], ways


def _plain(rows: list[tuple], fanout: int) -> Counter:
    """(doc_id, leaf, subroot, root, proof) of (doc_id, source, leaf) rows."""
    by_source = defaultdict(list)
    for doc_id, source, leaf in rows:
        by_source[source].append((doc_id is not None, doc_id or 0, leaf, doc_id))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [_tree([r[2] for r in sorted(by_source[name], key=lambda r: r[:3])], fanout) for name in names]
    root, upper = _tree([subroot for subroot, _ in trees], fanout) if trees else ("", [])
    out = Counter()
    for name, (subroot, ways), above in zip(names, trees, upper):
        for row, way in zip(sorted(by_source[name], key=lambda r: r[:3]), ways):
            proof = _h(*[side for step in [*way, *above] for side in step])
            out[(row[3], row[2], subroot, root, proof)] += 1
    return out


def _found(docs, fanout: int) -> Counter:
    leaf = merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    found = merkle.manifest(docs, leaf, F.col("source"), [F.col("doc_id")], fanout=fanout)
    back = merkle.folded(F.col("leaf"), F.col("path"))
    assert found.filter(back != F.col("root")).count() == 0
    forged = merkle.folded(F.sha2(F.lit(b"forged"), 256), F.col("path"))
    assert found.filter(forged == F.col("root")).count() == 0
    rows = found.select("row.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path"))).collect()
    return Counter(tuple(row) for row in rows)


def _leaves(docs) -> list[tuple]:
    return [
        (r["doc_id"], r["source"], _leaf(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]))
        for r in docs.collect()
    ]


@pytest.mark.parametrize("fanout, largest", [(2, 9), (16, 257)])
def test_trees_of_all_heights(spark, fanout, largest):
    sizes = {"a": 1, "b": 2, "é": 16, "c": 17, "B": 40, None: 33, "z": 257}
    sizes = {name: min(n, largest) for name, n in sizes.items()}
    rows = [(i * 7 % 500, source, "x", 1, f"t{i}") for source, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    docs = docs.repartition(7)
    assert _found(docs, fanout) == _plain(_leaves(docs), fanout)


def test_edge_rows(spark):
    docs = clashing(edge_docs(spark), "row", "tree", "lo", "digest", "slot", "part", "path", "leaf", "root")
    assert _found(docs, 3) == _plain(_leaves(docs), 3)


def test_an_empty_table(spark):
    assert _found(empty_docs(spark), 16) == Counter()


def test_a_node_needs_two_children(spark):
    with pytest.raises(ValueError):
        merkle.manifest(empty_docs(spark), F.lit(""), F.col("source"), [], fanout=1)


def test_many_equal_rows_are_spread(spark):
    """A third of the rows are one row; their tree is still right, and no partition holds them all."""
    from assay.llm.ranked import stored_in_order

    ids = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id"))
    docs = spark.range(0, 600, 1, 6).select(
        ids.alias("doc_id"), F.lit("s").alias("source"), F.lit("l").alias("lang"), ids.alias("n_chars"), ids.cast("string").alias("text")
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = stored_in_order(docs, ["doc_id"])
        largest = stored.groupBy("part").count().agg(F.max("count")).first()[0]
        assert largest < 200
        assert _found(docs, 16) == _plain(_leaves(docs), 16)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
