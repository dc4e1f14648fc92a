from __future__ import annotations

import pytest
from llm_helpers import clashing, edge_docs, empty_docs, random_docs
from pyspark.sql import functions as F

from assay.llm.blocks import blocked
from assay.llm.substrings import repeats, without_repeats


def _brute(rows, window):
    """(id, text) to (words, removed flags), windows judged on the input."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            part = tuple(words[i : i + window])
            if part in seen:
                gone[i : i + window] = [True] * window
            seen.add(part)
        out.setdefault((doc_id, text), []).append((words, gone))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_removed_words_by_brute_force(spark, seed, block_bytes):
    docs = random_docs(spark, seed)
    want = _brute([(r["doc_id"], r["text"]) for r in docs.collect()], 6)
    removed = 0
    for row in repeats(docs, window=6, anchor=3, block_bytes=block_bytes).collect():
        ((words, gone),) = want[row["row"]["doc_id"], row["row"]["text"]]
        assert row["n_words"] == len(words) and row["n_removed"] == sum(gone)
        assert row["kept"] == b" ".join(w for w, g in zip(words, gone) if not g).decode()
        covered = {i for span in row["spans"] for i in range(span["start"], span["end"])}
        assert covered == {i for i, g in enumerate(gone) if g}
        removed += sum(gone)
    assert removed > 100


def test_a_third_of_all_rows_share_a_passage(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("x"), "id", F.lit(f" {passage} y"), "id"))
        .otherwise(F.concat(F.lit("own "), "id"))
        .alias("text"),
    )
    found = repeats(docs, block_bytes=2000).filter("n_removed > 0").collect()
    assert len(found) == 99 and {row["n_removed"] for row in found} == {60}


def test_edge_rows(spark):
    docs = clashing(edge_docs(spark), "row", "id", "body", "block", "kept", "n_words", "spans")
    found = {
        row["row"]["doc_id"]: row["n_removed"]
        for row in repeats(docs, block_bytes=1000).collect()
    }
    assert found[5] == 30_000 - 977 - 19 + 19 or found[5] > 0
    assert found[6] == 30_000
    assert found[2] == found[3] == found[4] == found[1] == 0
    kept = without_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert repeats(empty_docs(spark)).count() == 0


def test_equal_rows_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(1, text)] * 3 + [(None, text)], "doc_id bigint, text string")
    assert sorted(r["n_removed"] for r in repeats(docs).collect()) == [0, 25, 25, 25]


@pytest.mark.parametrize("same", ["id", "row", "neither"])
def test_a_third_of_all_rows_share_an_id(spark, same):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit(None if same == "neither" else 7)).otherwise(1000 + F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("own "), "id"))
        .when(F.lit(same == "id"), F.concat(F.lit(passage), F.lit(" own"), "id"))
        .otherwise(passage)
        .alias("text"),
    )
    source = blocked(docs, docs["doc_id"], docs["text"], 2000)
    blocks = [row["count"] for row in source.groupBy("block").count().collect()]
    assert sum(blocks) == 300 and max(blocks) < 50
    lost = sorted(row["n_removed"] for row in repeats(docs, block_bytes=2000).collect())
    assert lost == [0] * 201 + [60] * 99


def test_shared_ids_by_brute_force(spark):
    docs = random_docs(spark, 9).withColumn(
        "doc_id", F.when(F.col("doc_id") % 3 == 0, 5).when(F.col("doc_id") % 3 == 1, F.col("doc_id"))
    )
    placed = blocked(docs, docs["doc_id"], docs["text"], 300).collect()
    place = {(r["id"], r["row"]["text"]): r["block"] for r in placed}
    rows = sorted(place, key=lambda r: (r[0] is None, r[0] or 0, place[r], r[1]))
    order = {row: i for i, row in enumerate(rows)}
    want = _brute([(order[row], row[1]) for row in rows], 6)
    for row in repeats(docs, window=6, anchor=3, block_bytes=300).collect():
        key = row["row"]["doc_id"], row["row"]["text"]
        ((_, gone),) = want[order[key], key[1]]
        assert row["n_removed"] == sum(gone)
