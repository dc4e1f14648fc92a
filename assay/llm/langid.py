"""Language identification by unigram piece models, summed over all segmentations.

The pieces are those of a fixed public vocabulary. Per language each piece has a probability, found by
expectation maximisation over the words of a bounded sample. A word's probability is the sum over all
ways to cut it into pieces, by the forward algorithm; a text's is the product over its words, which are
runs of letters in lower case. Bayes' rule over the languages gives the prediction and its probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

UNKNOWN = "und"
#: Expected number of rows a language is learnt from.
TRAIN_ROWS = 2_000
#: Languages that are summed at once.
BLOCK = 64
ROUNDS = 4
SMOOTHING = 0.1

#: Words of more letters are summed position by position; the sums are the same.
LONG_WORD = 40
_STRANGE = 1e-7
_WORD_START = "▁"
_LETTERS = re.compile(r"[^\W\d_]+")
_CACHED_SCORES = 2_400_000
_CACHED_LETTERS = 20_000_000
_CHUNK_CHARS = 1_000_000
_LONG_LETTERS = 400_000
# Sums below the first are multiplied by the second, and the factor is remembered.
_SMALL, _LIFT = 1e-100, 1e100


def text_words(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return _LETTERS.findall(text.lower())


def long_groups(words: list[str]) -> Iterator[list[int]]:
    """Places of the words of more than ``LONG_WORD`` letters, in groups of like length and bounded size."""
    group, letters = [], 0
    for place in sorted((i for i, w in enumerate(words) if len(w) > LONG_WORD), key=lambda i: len(words[i])):
        size = len(words[place])
        if group and (letters + size > _LONG_LETTERS or size > 2 * len(words[group[0]])):
            yield group
            group, letters = [], 0
        group.append(place)
        letters += size
    if group:
        yield group


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Pieces(dict):
    """Numbers of pieces, and a table to look many up at once."""

    @cached_property
    def longest(self) -> int:
        return max(map(len, self), default=1)

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of all pieces and of all their beginnings, with the number, or -1 for those
        that only begin a piece."""
        starts = {piece[:n]: -1 for piece in self for n in range(1, len(piece))}
        found = {}
        for piece, number in {**starts, **self}.items():
            key = 0
            for letter in piece:
                key = (key * int(_SPREAD) + ord(letter)) % (1 << 64)
            if found.setdefault(key, number) != number:
                raise ValueError("two pieces share a hash")
        keys = np.array(sorted(found), np.uint64)
        return keys, np.array([found[int(key)] for key in keys], np.int32)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The vocabulary's pieces, numbered from 1; number 0 is any single unknown letter."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known = (
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    )
    return Pieces((piece, i) for i, piece in enumerate(dict.fromkeys(known), 1))


@dataclass
class Lattice:
    """Edges of the segmentations of many words, by their ends: word, start, end and piece."""

    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, words: list[str], known: dict[str, int]) -> Lattice:
        known = known if isinstance(known, Pieces) else Pieces(known)
        keys, numbers = known.table
        joined = "".join(_WORD_START + word for word in words)
        letters = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
        lengths = np.fromiter(map(len, words), np.int32, len(words)) + 1
        ends = np.repeat(np.cumsum(lengths), lengths)
        # All places at once, a letter longer each time, for as long as some piece begins like this.
        place = np.arange(len(letters))
        key = np.zeros(len(letters), np.uint64)
        starts, stops, found = [], [], []
        for size in range(1, known.longest + 1):
            inside = place + size <= ends[place]
            place, key = place[inside], key[inside]
            if not len(place):
                break
            key = key * _SPREAD + letters[place + size - 1]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            number = np.where(keys[at] == key, numbers[at], 0)
            whole = number > 0
            if size == 1:  # a letter that is no piece counts as piece 0
                whole = np.ones(len(place), bool)
            starts.append(place[whole])
            stops.append(place[whole] + size)
            found.append(np.maximum(number[whole], 0))
            place, key = place[number != 0], key[number != 0]
        start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        stop = np.concatenate(stops) if stops else np.zeros(0, np.int64)
        piece = np.concatenate(found) if found else np.zeros(0, np.int32)
        word = np.repeat(np.arange(len(words)), lengths)[start]
        head = (np.cumsum(lengths) - lengths)[word]
        order = np.argsort(stop - head, kind="stable")
        columns = (word, start - head, stop - head, piece)
        return cls(*(column[order].astype(np.int32) for column in columns), lengths)

    def _steps(self) -> list[slice]:
        last = int(self.length.max(initial=0))
        cuts = np.searchsorted(self.end, np.arange(1, last + 2))
        return [slice(a, b) for a, b in zip(cuts, cuts[1:])]

    def forward(self, probability: np.ndarray) -> np.ndarray:
        """Sums over the segmentations of each word's beginnings: word, position, language."""
        total = np.zeros((len(self.length), int(self.length.max(initial=0)) + 1, probability.shape[1]))
        total[:, 0] = 1.0
        for position, edges in enumerate(self._steps(), 1):
            word = self.word[edges]
            part = total[word, self.start[edges]] * probability[self.piece[edges]]
            for language in range(probability.shape[1]):
                total[:, position, language] = np.bincount(
                    word, part[:, language], len(self.length)
                )
        return total

    def rolled(
        self, probability: np.ndarray, backward: bool = False
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Position by position the sums over the ways to its beginning, or ``backward`` to its end: the
        position, the sums by word and language, and the logarithms to add to theirs.

        Only as many positions are held as the longest edge spans, so words may be of any length; sums
        are lifted before they vanish.
        """
        last = int(self.length.max(initial=0))
        at, reached = (self.start, self.end) if backward else (self.end, self.start)
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(last + 2))
        held = int((self.end - self.start).max(initial=0)) + 1
        shape = len(self.length), probability.shape[1]
        ring, scale = np.zeros((held, *shape)), np.zeros(shape)
        origin = self.length if backward else np.zeros_like(self.length)
        for position in range(last, -1, -1) if backward else range(last + 1):
            edges = order[cuts[position] : cuts[position + 1]]
            word = self.word[edges]
            now = np.zeros(shape)
            now[origin == position] = 1.0
            np.add.at(now, word, ring[reached[edges] % held, word] * probability[self.piece[edges]])
            ring[position % held] = now
            small = (now > 0) & (now < _SMALL)
            if small.any():
                ring[:, small] *= _LIFT
                scale[small] -= np.log(_LIFT)
            yield position, ring[position % held], scale

    def long_log_probability(self, probability: np.ndarray) -> np.ndarray:
        """Like :meth:`log_probability`, for words of any length."""
        out = np.zeros((len(self.length), probability.shape[1]))
        for position, sums, scale in self.rolled(probability):
            done = self.length == position
            if done.any():
                out[done] = np.log(np.maximum(sums[done], 1e-300)) + scale[done]
        return out

    def long_expected(self, probability: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Like :meth:`expected`, for words of any length."""
        logs = np.zeros((2, len(self.length), int(self.length.max(initial=0)) + 1))
        for side, log in enumerate(logs):
            for position, sums, scale in self.rolled(probability[:, None], backward=side == 1):
                log[:, position] = np.log(np.maximum(sums[:, 0], 1e-300)) + scale[:, 0]
        alpha, beta = logs
        whole = alpha[np.arange(len(self.length)), self.length]
        used = np.exp(
            alpha[self.word, self.start]
            + np.log(np.maximum(probability[self.piece], 1e-300))
            + beta[self.word, self.end]
            - whole[self.word]
        )
        return np.bincount(self.piece, used * counts[self.word], len(probability))

    def log_probability(self, probability: np.ndarray) -> np.ndarray:
        """Of each word, by language."""
        total = self.forward(probability)[np.arange(len(self.length)), self.length]
        return np.log(np.maximum(total, 1e-300))

    def expected(self, probability: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in ``counts`` copies of the words; one language."""
        alpha = self.forward(probability[:, None])[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[np.arange(len(self.length)), self.length] = 1.0
        for edges in reversed(self._steps()):
            word = self.word[edges]
            part = beta[word, self.end[edges]] * probability[self.piece[edges]]
            np.add.at(beta, (word, self.start[edges]), part)
        whole = np.maximum(alpha[np.arange(len(self.length)), self.length], 1e-300)
        used = (
            alpha[self.word, self.start]
            * probability[self.piece]
            * beta[self.word, self.end]
            * (counts / whole)[self.word]
        )
        return np.bincount(self.piece, used, len(probability))


def _smoothed(uses: np.ndarray) -> np.ndarray:
    uses = uses + SMOOTHING
    uses[0] = 0.0
    out = uses / uses.sum()
    out[0] = _STRANGE
    return out


def fit(
    lattice: Lattice,
    counts: np.ndarray,
    pieces: int,
    rounds: int,
    long: Sequence[tuple[Lattice, np.ndarray]] = (),
) -> np.ndarray:
    """Piece probabilities from word counts; ``long`` holds groups of long words and their counts."""
    weight = np.bincount(lattice.piece, counts[lattice.word], pieces + 1)
    for group, own in long:
        weight = weight + np.bincount(group.piece, own[group.word], pieces + 1)
    probability = _smoothed(weight)
    for _ in range(rounds):
        uses = lattice.expected(probability, counts)
        for group, own in long:
            uses = uses + group.long_expected(probability, own)
        probability = _smoothed(uses)
    return probability


@dataclass
class Model:
    """Of each language the pieces it uses, with their probabilities; all others share one."""

    languages: list[str]
    used: list[np.ndarray]
    probability: list[np.ndarray]
    other: list[float]
    log_prior: np.ndarray
    path: str

    def block(self, languages: slice, pieces: int) -> np.ndarray:
        """Probabilities of all pieces and number 0, by language."""
        out = np.tile(self.other[languages], (pieces + 1, 1))
        out[0] = _STRANGE
        for column, (used, own) in enumerate(zip(self.used[languages], self.probability[languages])):
            out[used, column] = own
        return out


def _fitted(words: list[str], counts: np.ndarray, path: str, rounds: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The pieces a language uses, their probabilities, and that of any other piece."""
    known = pieces(path)
    short = [i for i, word in enumerate(words) if len(word) <= LONG_WORD]
    lattice = Lattice.of([words[i] for i in short], known)
    long = [
        (Lattice.of([words[i] for i in group], known), counts[group]) for group in long_groups(words)
    ]
    probability = fit(lattice, counts[short], len(known), rounds, long)
    used = np.unique(np.concatenate([each.piece for each in (lattice, *(group for group, _ in long))]))
    used = used[used > 0]
    unused = np.ones(len(probability), bool)
    unused[0] = unused[used] = False
    return used, probability[used], float(probability[unused].max(initial=0.0))


def train(
    docs: DataFrame,
    path: str,
    learn: Column,
    *,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    rows: int = TRAIN_ROWS,
    rounds: int = ROUNDS,
) -> Model:
    """A model of the languages of the rows that ``learn`` marks.

    Each language is learnt from about ``rows`` rows, chosen by a hash of id and text, in a task of its
    own that holds the words of these rows; copies of a row count once there, and priors count all
    marked rows. Every language is learnt. What reaches the driver is a row a language, of the pieces that it uses.
    """
    labelled = docs.select(
        docs[lang].cast("string").alias("lang"),
        docs[text].cast("string").alias("body"),
        docs[doc_id].cast("string").alias("id"),
        learn.alias("learn"),
    ).filter(F.col("learn") & F.col("lang").isNotNull() & F.col("body").isNotNull())
    sizes = labelled.groupBy("lang").count().collect()
    if not sizes:
        return Model([], [], [], [], np.zeros(0), path)
    languages = sorted(row["lang"] for row in sizes)
    count_of = {row["lang"]: row["count"] for row in sizes}
    shares = docs.sparkSession.createDataFrame(
        [(name, min(1.0, rows / count_of[name])) for name in languages], "lang string, share double"
    )
    place = F.pmod(F.xxhash64("id", "body"), F.lit(1_000_000)) / F.lit(1e6)
    sample = (
        labelled.join(F.broadcast(shares), "lang")
        .filter(place < F.col("share"))
        .select("lang", "id", "body")
        .dropDuplicates()
        .select("lang", "body")
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str], int] = {}
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist()):
                for word in text_words(body):
                    found[name, word] = found.get((name, word), 0) + 1
            names, words = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(words, pa.string()), pa.array(found.values(), pa.int64())],
                names=["lang", "word", "n"],
            )

    totals = sample.mapInArrow(counted, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    def fit_language(key: tuple, words: pd.DataFrame) -> pd.DataFrame:
        words = words.sort_values(["n", "word"], ascending=[False, True])
        used, own, other = _fitted(
            words["word"].tolist(), words["n"].to_numpy(np.float64), path, rounds
        )
        return pd.DataFrame(
            {
                "lang": [key[0]],
                "used": [used.astype(np.int32).tobytes()],
                "own": [own.tobytes()],
                "other": [other],
            }
        )

    found = {
        row["lang"]: row
        for row in totals.groupBy("lang")
        .applyInPandas(fit_language, "lang string, used binary, own binary, other double")
        .collect()
    }
    silent = _fitted([], np.zeros(0), path, rounds)
    columns = [
        (
            np.frombuffer(found[name]["used"], np.int32),
            np.frombuffer(found[name]["own"], np.float64),
            found[name]["other"],
        )
        if name in found
        else silent
        for name in languages
    ]
    every = np.array([count_of[name] for name in languages], np.float64)
    return Model(languages, *map(list, zip(*columns)), np.log(every / every.sum()), path)


class Scorer:
    """A block of a model's languages on an executor, with the words that it has summed already."""

    def __init__(self, model: Model, languages: slice, blocks: int):
        self.model = model
        self.languages = languages
        self.width = len(model.languages[languages])
        self.known = pieces(model.path)
        self.most = _CACHED_SCORES // blocks
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.letters = 0
        self.scores = np.zeros((1024, self.width))

    def word_scores(self, words: list[str]) -> np.ndarray:
        new = [word for word in dict.fromkeys(words) if word not in self.rows]
        at = len(self.rows)
        while at + len(new) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        size = min(50_000, max(1, 400_000 // self.width))
        probability = self.model.block(self.languages, len(self.known)) if new else None
        short = [i for i, word in enumerate(new) if len(word) <= LONG_WORD]
        for i in range(0, len(short), size):
            part = short[i : i + size]
            found = Lattice.of([new[k] for k in part], self.known).log_probability(probability)
            self.scores[at + np.array(part)] = found
        for group in long_groups(new) if len(short) < len(new) else ():
            found = Lattice.of([new[k] for k in group], self.known).long_log_probability(probability)
            self.scores[at + np.array(group)] = found
        self.letters += sum(map(len, new))
        self.rows.update(zip(new, range(at, at + len(new))))
        out = self.scores[np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))]
        if len(self.rows) * self.width > self.most or self.letters > _CACHED_LETTERS:
            self._forget()
        return out

    def sums(self, words: list[str], heads: np.ndarray) -> np.ndarray:
        """Scores of texts whose words begin at ``heads``."""
        return np.add.reduceat(self.word_scores(words), heads)


class Predictor:
    """A model on an executor, in blocks of languages."""

    def __init__(self, model: Model):
        self.model = model
        starts = range(0, len(model.languages), BLOCK)
        self.blocks = [Scorer(model, slice(at, at + BLOCK), len(starts)) for at in starts]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        split = [text_words(text) if text else [] for text in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        names = np.array([*self.model.languages, UNKNOWN], object)
        if not self.model.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        total = np.zeros((len(texts), len(self.model.languages)))
        spoken = np.flatnonzero(counts)
        if len(spoken):
            heads = (np.cumsum(counts) - counts)[spoken]
            words = [word for own in split for word in own]
            for block in self.blocks:
                total[spoken, block.languages] = block.sums(words, heads)
        total += self.model.log_prior
        total -= total.max(axis=1, keepdims=True)
        share = np.exp(total)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        best[counts == 0] = len(names) - 1
        top = np.where(counts > 0, share.max(axis=1), 0.0)
        return names[best].tolist(), top


def predict(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``row``, ``lang_pred`` and ``score``, the probability of that language given the text.

    A null text and one without a letter are ``und`` with score 0, as are all texts if nothing was
    learnt. Ties go to the language first in code point order. Columns of ``docs`` stay inside ``row``,
    so none can clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"), docs[text].cast("string").alias("body"))
    schema = StructType(
        [rows.schema["row"], StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            scorer = scorer or Predictor(shared.value)
            body = batch.column("body")
            sizes = np.cumsum([len(x) if x else 1 for x in body.to_pylist()])
            at = 0
            while at < len(batch):
                most = _CHUNK_CHARS + (sizes[at - 1] if at else 0)
                end = max(int(np.searchsorted(sizes, most, "right")), at + 1)
                names, top = scorer.predict(body.slice(at, end - at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(at, end - at), pa.array(names, pa.string()), pa.array(top)],
                    names=schema.names,
                )
                at = end

    return rows.mapInArrow(run, schema)
