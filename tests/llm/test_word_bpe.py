"""The word BPE against the tokenizers library, and its checks against exact merging."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import clashing, edge_docs, empty_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assay.llm import word_bpe
from assay.llm.queries import WORD_FILE

PATH = public_tokenizers.path(WORD_FILE)
SYLLABLES = ["the", "ing", "in", "er", "a", "e", "th", "he", "re", "o", "n", "xq", "z"]


@pytest.fixture(scope="module")
def words():
    return word_bpe.vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _random_text(pick: random.Random, names: list[str]) -> str:
    kinds = [
        lambda: "".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randint(1, 30))),
        lambda: "".join(pick.choice(SYLLABLES) for _ in range(pick.randint(1, 9))),
        lambda: pick.choice(names),
        lambda: pick.choice(["<|startoftext|>", "<|endoftext|>", "'s", "'LL", "İ", "ΑΣ", "é", "​"]),
        lambda: "".join(chr(pick.randint(1, 0x2FFF)) for _ in range(pick.randint(1, 6))),
        lambda: pick.choice([" ", "\n", "\x85", " ", "\x1c"]),
    ]
    return "".join(pick.choice(kinds)() for _ in range(pick.randint(0, 7)))


def test_random_texts_as_the_library(words, library):
    pick = random.Random(5)
    texts = [_random_text(pick, words.names) for _ in range(3000)]
    flat, counts = words.encode(texts)
    ends = np.cumsum(counts)
    for text, end, count in zip(texts, ends, counts):
        ids = flat[end - count : end].tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert words.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_code_points_of_any_age(words, library):
    for point in [*range(1, 0xD800, 41), *range(0xE000, 0x110000, 2503), 0x1C89, 0xA7CB, 0x88F]:
        text = f"A{chr(point)}B x{chr(point)}"
        assert words.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids, hex(point)


def test_a_sequence_holds_if_and_only_if_its_seams_do(words):
    """Any cut of a word into tokens: all seams hold exactly for the cut that the merges make."""
    pick = random.Random(6)
    for _ in range(300):
        raw = "".join(pick.choice(SYLLABLES) for _ in range(pick.randint(1, 4))).encode() + b"\xff"
        exact = words.merge(raw)
        cuts = [words.propose(raw), exact]
        for _ in range(5):
            cut, at = [], 0
            while at < len(raw):
                ends = [e for e in range(at + 1, len(raw) + 1) if e != len(raw) - 1 and raw[at:e] in words._proposed]
                end = pick.choice(ends)
                cut.append(words._proposed[raw[at:end]])
                at = end
            cuts.append(cut)
        for cut in cuts:
            ids = np.array(cut, np.int64)
            assert words.apart(ids[:-1], ids[1:]).all() == (cut == exact)


def test_long_and_failing_words(words, library):
    for text in ("ab" * 5000, "the" * 300, "x" * 1000, "aaaaaaa" * 9):
        assert words.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_small_cache_gives_the_same(words, library, monkeypatch):
    monkeypatch.setattr(word_bpe, "CACHED_WORDS", 4)
    fresh = word_bpe.Words(PATH)
    texts = ["one two three <|endoftext|>", "two four five six", "one six", ""] * 3
    for text in texts:
        assert fresh.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_edge_rows(spark, library):
    docs = clashing(edge_docs(spark), "row", "text_in", "extra")
    found = word_bpe.encode(docs, PATH, decoded=True)
    assert found.columns == [*docs.columns, "ids", "decoded"]
    rows = found.collect()
    assert len(rows) == docs.count()
    for row in rows:
        want = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == want and row["decoded"] == library.decode(want, skip_special_tokens=False)
        assert row["row"] == "mine" and row["extra"] == "mine"
    assert word_bpe.encode(empty_docs(spark), PATH).count() == 0


def test_decode_of_a_table(spark, library):
    docs = edge_docs(spark)
    tokens = word_bpe.encode(docs, PATH).withColumn("ids", F.when(F.col("doc_id") != 4, F.col("ids")))
    for row in word_bpe.decode(tokens, PATH).collect():
        assert row["decoded"] == library.decode(row["ids"] or [], skip_special_tokens=False)


def test_another_kind_of_file_is_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        word_bpe.Words(public_tokenizers.path("byte_bpe_50k.json"))
