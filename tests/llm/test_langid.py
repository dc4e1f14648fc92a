from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import public_tokenizers
import pytest
from llm_helpers import clashing, edge_docs, empty_docs
from pyspark.sql import functions as F

from assay.llm import langid
from assay.llm.text import fold

PATH = public_tokenizers.path("piece_bpe_32k.model")
KNOWN = {"▁": 1, "▁a": 2, "a": 3, "b": 4, "ab": 5, "▁ab": 6, "ba": 7}


def _segmentations(word, known):
    if not word:
        yield []
    for end in range(1, len(word) + 1):
        piece = known.get(word[:end])
        if piece is None and end == 1:
            piece = None if any(word[0:1] == k for k in known) else 0
        if piece is not None:
            for rest in _segmentations(word[end:], known):
                yield [piece, *rest]


def test_forward_sums_all_segmentations():
    random = np.random.default_rng(1)
    probability = random.random((len(KNOWN) + 1, 2))
    words = ["a", "ab", "abab", "bbaab", "axb", "xx"]
    got = langid.Lattice.of(words, KNOWN).log_probability(probability)
    for word, row in zip(words, got):
        for language in range(2):
            total = sum(
                math.prod(probability[p, language] for p in pieces)
                for pieces in _segmentations("▁" + word, KNOWN)
            )
            assert row[language] == pytest.approx(math.log(total))


def test_expected_uses_by_enumeration():
    probability = np.random.default_rng(2).random(len(KNOWN) + 1)
    words, counts = ["ab", "baab"], np.array([3.0, 2.0])
    want = np.zeros(len(KNOWN) + 1)
    for word, count in zip(words, counts):
        ways = list(_segmentations("▁" + word, KNOWN))
        weights = [math.prod(probability[p] for p in way) for way in ways]
        for way, weight in zip(ways, weights):
            for p in way:
                want[p] += count * weight / sum(weights)
    got = langid.Lattice.of(words, KNOWN).expected(probability, counts)
    assert got == pytest.approx(want)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = langid.train(docs, PATH, ~held_out, rows=100)
    found = langid.predict(docs.filter(held_out), model).select("row.lang", "lang_pred", "score").collect()
    right = sum(row["lang"] == row["lang_pred"] for row in found)
    assert right >= 0.98 * len(found)
    assert all(0 <= row["score"] <= 1 for row in found)


def test_edge_rows(spark):
    docs = clashing(edge_docs(spark), "row", "body", "lang_pred", "score", "learn", "id", "word")
    model = langid.train(docs, PATH, F.lit(True))
    assert model.languages == ["de", "en", "fr"]
    found = langid.predict(docs, model).collect()
    assert len(found) == docs.count()
    for row in found:
        silent = not any(c.isalpha() for c in row["row"]["text"] or "")
        assert (row["lang_pred"] == "und") == silent and (row["score"] == 0) == silent
    assert langid.predict(empty_docs(spark), model).count() == 0
    none = langid.train(empty_docs(spark), PATH, F.lit(True))
    assert {row["lang_pred"] for row in langid.predict(docs, none).collect()} == {"und"}


def test_a_long_run_of_letters_stays_whole():
    words = langid.text_words("x" * 1000 + " y")
    assert words == ["x" * 1000, "y"]
    scores = langid.Lattice.of(words, langid.pieces(PATH)).log_probability(
        np.full((len(langid.pieces(PATH)) + 1, 1), 1e-7)
    )
    assert np.isfinite(scores).all()


def test_no_language_is_left_out(spark):
    pairs = itertools.combinations("abcdefghijklmnopqrstuvw", 2)
    texts = {a + b: f"{a}{b}{a}{b}{b} {b}{a}{a} " * 50 for a, b in pairs}
    assert len(texts) > 200 + langid.BLOCK // 2
    rows = [(i, text, name) for i, (name, text) in enumerate(sorted(texts.items()) * 2)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    silent = spark.createDataFrame([(-1, "123", "zz")], docs.schema)
    model = langid.train(docs.unionByName(silent), PATH, F.lit(True))
    assert model.languages == [*sorted(texts), "zz"]
    found = langid.predict(docs, model).select("row.lang", "lang_pred").collect()
    assert [row["lang_pred"] for row in found] == [row["lang"] for row in found]


def test_blocks_of_languages_give_the_scores_of_one(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.train(docs, PATH, F.lit(True), rows=20)
    texts = [row["text"] for row in docs.select("text").collect()]
    one = langid.Predictor(model)
    monkeypatch.setattr(langid, "BLOCK", 1)
    many = langid.Predictor(model)
    assert (len(one.blocks), len(many.blocks)) == (1, len(model.languages))
    assert one.predict(texts)[0] == many.predict(texts)[0]
    assert one.predict(texts)[1] == pytest.approx(many.predict(texts)[1])


def test_rows_without_an_id_are_sampled_like_others(spark):
    """Many rows of no id, of one id, and copies: about ``rows`` of each language are learnt from."""
    def own(lang, i):
        return "".join(chr(97 + int(c, 16)) for c in hashlib.md5(f"{lang}{i}".encode()).hexdigest()[:14])

    rows = [(None, f"{own('de', i)} der mann", "de") for i in range(400)]
    rows += [(7, f"{own('fr', i)} le chat", "fr") for i in range(400)]
    rows += [(i, f"{own('en', i)} the man", "en") for i in range(400)]
    rows += [(None, "siempre lo mismo", "es")] * 400
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(docs, PATH, F.lit(True), rows=40)
    used = {name: len(pieces) for name, pieces in zip(model.languages, model.used)}
    assert set(used) == {"de", "en", "es", "fr"}
    whole = langid.train(docs, PATH, F.lit(True), rows=4000)
    for name, pieces in zip(whole.languages, whole.used):
        # A tenth of the rows holds far fewer different words than all of them.
        assert name == "es" or used[name] < 0.8 * len(pieces)


def test_pieces_of_any_length_are_used():
    known = langid.pieces(PATH)
    assert known.longest == max(map(len, known)) > 12
    word = max((p for p in known if p[0] == "▁" and p[1:].isalpha()), key=len)
    assert len(word) > 12
    assert known[word] in langid.Lattice.of([word[1:]], known).piece


def test_long_words_sum_like_short_ones():
    random = np.random.default_rng(5)
    probability = random.random((len(KNOWN) + 1, 2)) / 3
    words = ["a", "abab", "bbaab" * 5, "axb", "xx" * 30]
    counts = np.array([2.0, 1.0, 3.0, 1.0, 5.0])
    lattice = langid.Lattice.of(words, KNOWN)
    assert lattice.long_log_probability(probability) == pytest.approx(lattice.log_probability(probability))
    own = probability[:, 0]
    assert lattice.long_expected(own, counts) == pytest.approx(lattice.expected(own, counts))


def test_long_words_do_not_vanish():
    probability = np.full((len(KNOWN) + 1, 2), [1e-6, 1e-3])
    lattice = langid.Lattice.of(["x" * 2000, "x" * 1500], KNOWN)
    got = lattice.long_log_probability(probability)
    # The mark before a word is a piece as well.
    for row, letters in zip(got, (2001, 1501)):
        assert row == pytest.approx(letters * np.log([1e-6, 1e-3]))
    uses = lattice.long_expected(probability[:, 0], np.array([1.0, 2.0]))
    assert uses[0] == pytest.approx(5000) and uses[1] == pytest.approx(3)


def test_languages_without_blanks(spark):
    pick = np.random.default_rng(6)
    rows = [
        (i, "".join(pick.choice(list("abcde" if i % 2 else "deabz"), 500)), "xy"[i % 2], None, None)
        for i in range(60)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    model = langid.train(docs, PATH, F.col("doc_id") < 40)
    found = langid.predict(docs.filter("doc_id >= 40"), model).collect()
    assert all(row["lang_pred"] == row["row"]["lang"] for row in found)
    groups = list(langid.long_groups(["a" * 50, "a", "b" * 90, "c" * 300, "d" * 500_000, "e" * 450]))
    assert groups == [[0, 2], [3, 5], [4]]
