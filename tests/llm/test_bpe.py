from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from llm_helpers import clashing, edge_docs, empty_docs

from assay.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = [
    *("'" * 6), *"stmdrevlaZ", *"stmdrevl", *(" " * 6), "\n", "\t", " ", " ", "1", "23", ".", "!",
    "é", "ß", "汉", "😀", "́", "½", "\x1c", "\x85", "\r\n",
]


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _texts():
    pick = random.Random(5)
    made = ["".join(pick.choices(ALPHABET, k=pick.randint(0, 50))) for _ in range(4000)]
    return made + ["", " ", "'s", "'re'll", " 's", "a" * 3000, " " * 200, "!" * 500, "ab" * 400]


def test_boundaries_are_those_of_the_pattern():
    pattern = regex.compile(public_tokenizers.PATTERN)
    texts = _texts()
    pieces, counts = bpe.slices(texts)
    want = [m.encode() for text in texts for m in pattern.findall(text)]
    assert pieces == want
    assert counts.tolist() == [len(pattern.findall(text)) for text in texts]


def test_ids_are_those_of_the_library(reference):
    texts = _texts()
    flat, counts = bpe.encode_texts(texts, PATH)
    ends = np.cumsum(counts)
    for text, end, count in zip(texts, ends, counts):
        assert flat[end - count : end].tolist() == reference.encode_ordinary(text)


def test_a_small_cache_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_SLICES", 4)
    ranks = bpe.Ranks(PATH)
    for _ in range(3):
        for text in ("one two three", "four five two", "zzzqq xxyy"):
            pieces, _ = bpe.slices([text])
            ids = np.frombuffer(b"".join(ranks.ids(pieces)), np.int32).tolist()
            assert ids == reference.encode_ordinary(text)


def test_edge_rows_offsets_and_round_trip(spark, reference):
    docs = clashing(edge_docs(spark), "ids", "offsets", "row", "text_in", "decoded")
    tokens = bpe.encode(docs, PATH)
    found = bpe.decode(tokens, PATH).collect()
    assert len(found) == docs.count()
    for row in found:
        text = row["text"] or ""
        assert row["ids"] == reference.encode_ordinary(text)
        assert bytes(row["decoded"]).decode() == text
        sizes = [len(reference.decode_single_token_bytes(i)) for i in row["ids"]]
        assert row["offsets"] == [sum(sizes[:i]) for i in range(min(len(sizes), 50))] + row["offsets"][50:]
    both = bpe.encode(docs, PATH, decoded=True).collect()
    assert [row["decoded"] for row in both] == [row["decoded"] for row in found]
    assert bpe.encode(empty_docs(spark), PATH).count() == 0
