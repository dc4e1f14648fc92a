"""Quality classification by a factorisation machine.

A document is a sparse vector: its hashed distinct words, and the quantile bins of structure statistics
and metadata. Each coordinate has a weight and a short vector; the score adds the weights and the inner
products of all pairs of vectors, the latter in linear time, as half of the square of the sum less the
sum of the squares. The machine is fitted with the logistic loss on a bounded sample of labelled rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: Most labelled rows that the machine is fitted on, chosen by a hash of their id.
TRAIN_ROWS = 10_000
WORD_BITS = 16
FACTORS = 8
BINS = 10
#: Passes over the sample; more of them over a small one, for so many steps at least.
EPOCHS, FEWEST_STEPS = 8, 400
#: Lengths of the two parts of a vector: words, of which most are rare, may say less than structure.
WORD_LENGTH, STATISTICS_LENGTH = 0.5, 2.0
_BATCH = 200
_RATE = 0.1
_DECAY = 1e-4
_SEED = 7

# The bytes that structure statistics count.
_GROUPS = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "symbols": b"#*$%&|<>{}[]^~=_\\@",
    "stops": b".!?",
    "other_points": b",;:'\"()-",
}
_KIND = np.zeros(256, np.uint8)
for _number, _members in enumerate(_GROUPS.values(), 1):
    _KIND[list(_members)] = _number
STATISTICS = (
    "words", "chars", "word_length", "long_words", "distinct_words", "distinct_pairs",
    "lines", "line_words", "distinct_lines", "open_lines", *_GROUPS,
)


def features(text: str | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct word buckets of a text, and its statistics in the order of ``STATISTICS``.

    ``chars`` is the metadata column if there is one, else the length of the text.
    """
    raw = (text or "").encode()
    words = raw.lower().split()
    n = len(words)
    hashes = np.fromiter(map(zlib.crc32, words), np.int64, n)
    lengths = np.fromiter(map(len, words), np.int64, n)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=len(_GROUPS) + 1)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    whole = max(n, 1)
    pairs = hashes[:-1] * 1_000_003 + hashes[1:]
    open_ends = sum(line.rstrip()[-1:] not in (b".", b"!", b"?", b":", b'"') for line in lines)
    statistics = np.array(
        [
            np.log1p(n),
            np.log1p(len(raw) if n_chars is None else max(n_chars, 0)),
            lengths.mean() if n else 0.0,
            (lengths > 15).sum() / whole,
            len(np.unique(hashes)) / whole,
            len(np.unique(pairs)) / max(len(pairs), 1),
            np.log1p(len(lines)),
            n / max(len(lines), 1),
            len(set(lines)) / max(len(lines), 1),
            open_ends / max(len(lines), 1),
            *(kinds[1:] / whole),
        ]
    )
    return np.unique(hashes & ((1 << WORD_BITS) - 1)).astype(np.int32), statistics


@dataclass
class Machine:
    edges: np.ndarray  # of the bins, by statistic
    bias: float
    weight: np.ndarray
    vector: np.ndarray

    def coordinates(self, words: list[np.ndarray], statistics: np.ndarray):
        """Places, values and heads of the sparse vectors; words and bins have a fixed length each."""
        places, values, counts = [], [], []
        width = len(STATISTICS)
        bins = (statistics[:, :, None] > self.edges[None]).sum(axis=2)
        bins += (1 << WORD_BITS) + np.arange(width) * BINS
        for own, bin_ in zip(words, bins):
            places += (own, bin_)
            values += (
                np.full(len(own), WORD_LENGTH / np.sqrt(max(len(own), 1))),
                np.full(width, STATISTICS_LENGTH / np.sqrt(width)),
            )
            counts.append(len(own) + width)
        counts = np.array(counts)
        return np.concatenate(places), np.concatenate(values), np.cumsum(counts) - counts, counts

    def margins(self, places, values, heads) -> tuple[np.ndarray, np.ndarray]:
        """The score before the logistic function, and the sums that its gradient needs."""
        scaled = self.vector[places] * values[:, None]
        sums = np.add.reduceat(scaled, heads)
        squares = np.add.reduceat(scaled * scaled, heads)
        linear = np.add.reduceat(self.weight[places] * values, heads)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def scores(self, words: list[np.ndarray], statistics: np.ndarray) -> np.ndarray:
        places, values, heads, _ = self.coordinates(words, statistics)
        margins, _ = self.margins(places, values, heads)
        return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def fit(words: list[np.ndarray], statistics: np.ndarray, labels: np.ndarray) -> Machine:
    """Fitted by AdaGrad in fixed order, so that reruns agree. Labels of one kind leave the bias alone."""
    size = (1 << WORD_BITS) + len(STATISTICS) * BINS
    random = np.random.default_rng(_SEED)
    shares = np.arange(1, BINS) / BINS
    edges = (
        np.quantile(statistics, shares, axis=0).T
        if len(labels)
        else np.zeros((len(STATISTICS), BINS - 1))
    )
    share = (labels.sum() + 1) / (len(labels) + 2)
    machine = Machine(
        edges, float(np.log(share / (1 - share))), np.zeros(size), random.normal(0, 0.05, (size, FACTORS))
    )
    if len(set(labels.tolist())) < 2:
        machine.vector[:] = 0.0
        return machine
    squared = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2)
    steps = -(-len(labels) // _BATCH)
    for _ in range(max(EPOCHS, -(-FEWEST_STEPS // steps))):
        order = random.permutation(len(labels))
        for at in range(0, len(order), _BATCH):
            rows = order[at : at + _BATCH]
            places, values, heads, counts = machine.coordinates([words[i] for i in rows], statistics[rows])
            margins, sums = machine.margins(places, values, heads)
            off = 1 / (1 + np.exp(-np.clip(margins, -30, 30))) - labels[rows]
            machine.bias -= 0.02 * off.mean()
            each = np.repeat(off, counts)[:, None] * values[:, None]
            own = machine.vector[places]
            slope = each * (np.repeat(sums, counts, axis=0) - own * values[:, None])
            touched, which = np.unique(places, return_inverse=True)
            by_place = np.argsort(which, kind="stable")
            starts = np.searchsorted(which[by_place], np.arange(len(touched)))
            gradient = np.add.reduceat(np.hstack([each, slope])[by_place], starts)
            for target, total, grad in (
                (machine.weight, squared[0], gradient[:, 0]),
                (machine.vector, squared[1], gradient[:, 1:]),
            ):
                grad = grad + _DECAY * target[touched]
                total[touched] += grad * grad
                target[touched] -= _RATE * grad / np.sqrt(total[touched])
    return machine


def _measured(docs: DataFrame, text: str, n_chars: str | None, *kept: Column) -> DataFrame:
    length = docs[n_chars].cast("double") if n_chars else F.lit(None).cast("double")
    return docs.select(*kept, docs[text].cast("string").alias("body"), length.alias("length"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    n_chars: str | None = "n_chars",
    label: str = "quality",
    rows: int = TRAIN_ROWS,
) -> Machine:
    """A machine fitted on at most ``rows`` rows of ``labels`` (``doc_id`` and ``label``, 0 or 1).

    ``learn`` picks rows of ``labels``; repeated ones count once. The sample, bounded by ``rows``, is
    broadcast to the documents, and one document a row of it, of equal ids that with the least hash of
    its text, sends its features to the driver. Rows without label, id or document are passed over;
    without any the machine scores one half.
    """
    sample = (
        labels.filter(learn & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("sample_id"), F.col(label).cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("sample_id"), "sample_id", "label")
        .limit(rows)
    )
    known = _measured(docs, text, n_chars, docs[doc_id].cast("bigint").alias("id"))
    joined = (
        known.join(F.broadcast(sample), F.col("id") == F.col("sample_id"))
        .groupBy("id", "label")
        .agg(F.min(F.struct(F.xxhash64("body").alias("place"), "body", "length")).alias("first"))
        .select("id", "label", "first.body", "first.length")
        .repartition(docs.sparkSession.sparkContext.defaultParallelism, "id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, n) for t, n in zip(batch.column("body").to_pylist(), batch.column("length").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([w for w, _ in found], pa.list_(pa.int32())),
                    pa.array([s for _, s in found], pa.list_(pa.float64())),
                    batch.column("label"),
                ],
                names=["id", "words", "statistics", "label"],
            )

    found = (
        joined.select("id", "body", "length", "label")
        .mapInArrow(run, "id bigint, words array<int>, statistics array<double>, label int")
        .toArrow()
        .sort_by([("id", "ascending"), ("label", "ascending")])
    )
    words = [np.array(x.as_py(), np.int32) for x in found.column("words")]
    statistics = np.array(found.column("statistics").to_pylist(), float).reshape(-1, len(STATISTICS))
    return fit(words, statistics, found.column("label").to_numpy().astype(float))


def score(
    docs: DataFrame, machine: Machine, *, text: str = "text", n_chars: str | None = "n_chars"
) -> DataFrame:
    """``row`` and ``score``, the probability of label 1. A null text is scored like an empty one.

    Equal texts of equal ``n_chars`` have equal scores; a null ``n_chars`` stands for the bytes of the
    text. Columns of ``docs`` stay inside ``row``, so none can clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    rows = _measured(docs, text, n_chars, F.struct("*").alias("row"))
    schema = StructType([rows.schema["row"], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                found = [features(t, n) for t, n in zip(part.column("body").to_pylist(), part.column("length").to_pylist())]
                scores = machine.scores([w for w, _ in found], np.array([s for _, s in found]))
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(scores)], names=schema.names)

    return rows.mapInArrow(run, schema)
