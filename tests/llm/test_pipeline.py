"""The pipeline against a plain version of each stage on a small input."""

from __future__ import annotations

import base64
import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from llm_helpers import edge_docs, empty_docs
from pyspark.sql import functions as F

from assay.llm import mixing, rules, simhash

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs.toPandas())
    return out


def test_columns(stages):
    for frame in stages[:-1]:
        assert sorted(frame.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars"])
        assert (frame["n_chars"] == frame["text"].str.len()).all()


def test_rejected_documents_go(spark, stages):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r[0] for r in rules.measure(docs).filter("kept").select("row.doc_id").collect()}
    assert set(stages[1]["doc_id"]) == kept and 0 < len(kept) < len(stages[0])


def test_one_document_of_each_group_stays(stages):
    ids, prints = stages[1]["doc_id"].tolist(), [simhash.fingerprint(t) for t in stages[1]["text"]]
    group = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, x in zip(ids, prints):
            for b, y in zip(ids, prints):
                if group[a] < group[b] and (x ^ y).bit_count() <= 3:
                    group[b], changed = group[a], True
    assert sorted(stages[2]["doc_id"]) == sorted(set(group.values()))


def test_no_window_starts_twice(stages):
    before = stages[2].sort_values("doc_id")
    after = stages[3].set_index("doc_id")["text"]
    seen = set()
    for doc_id, text in zip(before["doc_id"], before["text"]):
        words = text.encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        want = b" ".join(w for w, g in zip(words, gone) if not g).decode() if any(gone) else text
        assert after[doc_id] == want


def test_documents_come_as_often_as_the_mix_takes_them(spark, stages):
    want = {
        r["doc_id"]: r["copies"]
        for r in mixing.mix(spark.createDataFrame(stages[3])).select("row.doc_id", "copies").collect()
        if r["copies"]
    }
    assert stages[4]["doc_id"].value_counts().to_dict() == want


def test_ids_decode_to_the_texts(stages):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = stages[4].drop_duplicates("doc_id").set_index("doc_id")["text"]
    last = stages[5]
    for doc_id, ids, offsets, digest in zip(last["doc_id"], last["ids"], last["offsets"], last["decoded_sha256"]):
        assert list(ids) == encoding.encode_ordinary(texts[doc_id])
        raw = texts[doc_id].encode()
        assert digest == hashlib.sha256(raw).hexdigest()
        ends = [*list(offsets)[1:], len(raw)]
        assert b"".join(raw[a:b] for a, b in zip(offsets, ends)) == raw


def test_edge_rows_go_through_every_stage(spark, tmp_path):
    for label, docs in (("edge", edge_docs(spark)), ("empty", empty_docs(spark))):
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / label / name)
            stage(spark, docs.withColumn("row", F.lit("mine")), SF_DIR).write.parquet(path)
            docs = spark.read.parquet(path).drop("row")
        assert docs.filter("size(ids) != n_tokens").count() == 0
