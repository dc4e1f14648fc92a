"""Language-model scoring by context-tree weighting, and a word unigram to compare with.

A text is its bytes and one end mark. Each byte is eight binary decisions, and each decision has a
Krichevsky-Trofimov estimate after every one of the contexts of 0 to ``DEPTH`` bytes before it. The
tree of contexts weighs each node's own estimate half against the product of its children; the weights
that follow from the training counts mix the estimates of all depths when a text is scored. A context
that training never saw lends its parent's estimate.

Counts of all grams (contexts of full depth with the byte that follows) come from all training texts.
The tree is worked out in groups of equal last two bytes: sums over the groups give the upper levels,
which are at most 256 * 255 nodes, and with these every group rates its grams. The commonest grams are
broadcast, a fixed number; for all others, and for words, each block of documents asks once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.blocks import block_of, blocked, signed, texts_of, unsigned, with_row
from assay.workspace import new_folder

DEPTH = 5
#: Larger than elsewhere: the larger a block, the fewer blocks ask for one gram.
BLOCK_BYTES = 16 << 20
ADDED = 0.1
#: No byte of UTF-8: what stands before a text and ends it.
_MARK = b"\xff"
_WORD, _GRAM = 0, 1
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_CHUNK_BYTES = 512 << 10
_WORD_BITS = 21
#: Grams that a group of the tree holds on average.
GROUP_GRAMS = 200_000
#: The commonest grams, of which most texts consist, are broadcast: so many, 16 bytes each, and no more.
HEAD_GRAMS = 1 << 18


def _table_of(function, most: int) -> np.ndarray:
    return np.array([function(n) for n in range(most)])


_HALVES = _table_of(lambda n: lgamma(n + 0.5) - lgamma(0.5), 4096)
_WHOLES = _table_of(lambda n: lgamma(n + 1.0), 4096)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, for arguments above a few thousand."""
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def _log_half(n: np.ndarray) -> np.ndarray:
    small = np.minimum(n, len(_HALVES) - 1)
    return np.where(n < len(_HALVES), _HALVES[small], _log_gamma(np.maximum(n, 1) + 0.5) - lgamma(0.5))


def _log_whole(n: np.ndarray) -> np.ndarray:
    small = np.minimum(n, len(_WHOLES) - 1)
    return np.where(n < len(_WHOLES), _WHOLES[small], _log_gamma(n + 1.0))


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that the estimator gives a sequence of so many zeros and ones."""
    return _log_half(zeros) + _log_half(ones) - _log_whole(zeros + ones)


def gram_keys(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A key for each byte and end mark of the texts, and how many each text has.

    From its top byte down a key has the byte before, the one before that, and so on; the byte itself
    is the lowest.
    """
    joined = b"".join(_MARK * depth + text + _MARK for text in texts)
    counts = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    # Eight bytes from each place on, the first of them lowest.
    eight = np.ndarray(len(joined) - depth, "<u8", joined + b"\0" * 8, strides=(1,))
    context = eight & np.uint64((1 << 8 * depth) - 1)
    keys = (context << np.uint64(8)) | ((eight >> np.uint64(8 * depth)) & np.uint64(255))
    # Left out: the marks before all texts but the first.
    inside = np.ones(len(keys), bool)
    heads = np.cumsum(counts + depth)[:-1] - depth
    for k in range(depth):
        inside[heads + k] = False
    return keys[inside], counts


class KeyIndex:
    """Places of known 64-bit keys by a table of their hashes, many at a time.

    Where two keys share a slot the later one has it; :meth:`find` misses the other.
    """

    def __init__(self, bits: int = 20):
        self._shift = np.uint64(64 - bits)
        self._slots = np.zeros(1 << bits, np.int32)
        self.keys = np.zeros(1 << 10, np.uint64)
        self.size = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _SPREAD) >> self._shift

    def add(self, keys: np.ndarray) -> None:
        end = self.size + len(keys)
        while end > len(self.keys):
            self.keys = np.concatenate([self.keys, np.zeros_like(self.keys)])
        self.keys[self.size : end] = keys
        self._slots[self._slot(keys)] = np.arange(self.size, end)
        self.size = end

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each key, and whether it is the right one."""
        at = self._slots[self._slot(keys)]
        return at, (self.keys[at] == keys) & (self.size > 0)


class KeyCounts:
    """Distinct keys and how often they came. A key may be listed in parts, to be added up."""

    def __init__(self, bits: int = 20):
        self.index = KeyIndex(bits)
        self._counts = np.zeros(1 << 10, np.int64)

    def add(self, keys: np.ndarray) -> None:
        at, known = self.index.find(keys)
        if len(self._counts) < len(self.index.keys):
            self._counts = np.append(self._counts, np.zeros(len(self.index.keys) - len(self._counts), np.int64))
        self._counts[: self.index.size] += np.bincount(at[known], minlength=self.index.size)[: self.index.size]
        new, counts = np.unique(keys[~known], return_counts=True)
        start = self.index.size
        self.index.add(new)
        if len(self._counts) < len(self.index.keys):
            self._counts = np.append(self._counts, np.zeros(len(self.index.keys) - len(self._counts), np.int64))
        self._counts[start : self.index.size] = counts

    def add_once(self, key: np.uint64, times: int) -> None:
        """One key that came so many times, perhaps none."""
        self.add(np.full(1, key, np.uint64))
        at, _ = self.index.find(np.full(1, key, np.uint64))
        self._counts[at[0]] += times - 1

    def listed(self) -> tuple[np.ndarray, np.ndarray]:
        return self.index.keys[: self.index.size], self._counts[: self.index.size]

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        """Each key once, in order, with its count."""
        keys, which = np.unique(self.listed()[0], return_inverse=True)
        return keys, np.bincount(which, self.listed()[1], len(keys)).astype(np.int64)


class Levels:
    """Nodes of one bit position, from full contexts up, for sorted distinct grams of a group."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bit: int, depth: int, top: int):
        low = keys & np.uint64(255)
        prefix = (low >> np.uint64(8 - bit)) | np.uint64(1 << bit)
        nodes = (keys & ~np.uint64(255)) | prefix
        self.bit = ((low >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        self.to_node: list[np.ndarray] = []
        self.zeros: list[np.ndarray] = []
        self.ones: list[np.ndarray] = []
        self.log_weighted: list[np.ndarray] = []
        self.own_share: list[np.ndarray] = []
        zeros, ones = np.where(self.bit, 0, counts), np.where(self.bit, counts, 0)
        below = None
        for length in range(depth, top - 1, -1):
            unique, which = np.unique(nodes, return_inverse=True)
            zeros = np.bincount(which, zeros, len(unique)).astype(np.int64)
            ones = np.bincount(which, ones, len(unique)).astype(np.int64)
            own = log_kt(zeros, ones)
            weighted = own
            if below is not None:
                weighted = np.logaddexp(own, np.bincount(which, below, len(unique))) - np.log(2)
            self.own_share.append(np.exp(own - np.log(2) - weighted))
            self.to_node.append(which)
            self.zeros.append(zeros)
            self.ones.append(ones)
            self.log_weighted.append(weighted)
            self.nodes = unique
            below = weighted
            # One context byte less: drop the lowest, which lies just above the prefix.
            cleared = np.uint64(0xFF) << np.uint64(8 * (depth - length + 1))
            nodes = unique & ~cleared

    def estimates(self) -> tuple[np.ndarray, np.ndarray]:
        """For each gram the mixed probability of its bit down from the group's top, and whether
        training saw the top node."""
        at = [self.to_node[0]]
        for which in self.to_node[1:]:
            at.append(which[at[-1]])
        mixed = seen = None
        for level, node in enumerate(at):
            total = (self.zeros[level] + self.ones[level])[node]
            hits = np.where(self.bit, self.ones[level][node], self.zeros[level][node])
            own = (hits + 0.5) / (total + 1.0)
            if mixed is None:
                mixed = own
            else:
                share = self.own_share[level][node]
                mixed = np.where(seen, share * own + (1 - share) * mixed, own)
            seen = total > 0
        return mixed, seen


class Top:
    """The levels of no and one context byte, from sums over all groups."""

    def __init__(self, rows: list):
        shape = (256, 256)
        self.zeros, self.ones = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        below = np.zeros(shape)
        for row in rows:
            at = (row["last"], row["node"])
            self.zeros[at], self.ones[at], below[at] = row["zeros"], row["ones"], row["below"]
        own = log_kt(self.zeros, self.ones)
        weighted = np.logaddexp(own, below) - np.log(2)
        self.share = np.exp(own - np.log(2) - weighted)
        self.all_zeros, self.all_ones = self.zeros.sum(axis=0), self.ones.sum(axis=0)
        own = log_kt(self.all_zeros, self.all_ones)
        self.all_share = np.exp(own - np.log(2) - (np.logaddexp(own, weighted.sum(axis=0)) - np.log(2)))

    def mix(self, last: np.ndarray, node: np.ndarray, bit: np.ndarray, mixed: np.ndarray, seen: np.ndarray):
        for zeros, ones, share in (
            (self.zeros[last, node], self.ones[last, node], self.share[last, node]),
            (self.all_zeros[node], self.all_ones[node], self.all_share[node]),
        ):
            total = zeros + ones
            own = (np.where(bit, ones, zeros) + 0.5) / (total + 1.0)
            mixed = np.where(seen, share * own + (1 - share) * mixed, own)
            seen = total > 0
        return mixed


def _byte(keys: np.ndarray, at: int) -> np.ndarray:
    """Byte ``at`` of the keys, counted from the lowest."""
    return ((keys >> np.uint64(8 * at)) & np.uint64(255)).astype(np.int32)


# The six bytes between words, and the mark that ends a text here.
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E), 0xFF]] = True
_LETTER = np.random.default_rng(1).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xC2B2AE3D27D4EB4F
#: The key of a text's end: no word hashes to it but by chance.
END_KEY = np.uint64(0)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return tuple(out)


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key for each word of the texts, in a row, and the text that it is in.

    A word's hash is the difference of two prefix sums over the bytes, so no word is taken apart.
    """
    joined = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    powers, inverse = _powers(1 << max(20, len(joined).bit_length()))
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_LETTER[joined] * powers[: len(joined)], out=sums[1:])
    inside = ~_GAP[joined]
    edges = np.diff(inside.view(np.int8), prepend=np.int8(0))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    keys = (sums[stops] - sums[starts]) * inverse[starts]
    keys ^= keys >> np.uint64(32)
    keys *= _SPREAD
    keys ^= keys >> np.uint64(29)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return keys, np.searchsorted(ends, starts, "right")


def _chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    chunk, size = [], 0
    for text in texts:
        chunk.append(text)
        size += len(text) + 1
        if size >= _CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _lowered(texts: list[str | None]) -> list[bytes]:
    return [(text or "").encode().lower() for text in texts]


def train_counts(docs: DataFrame, text: Column, held_out: Column, depth: int) -> DataFrame:
    """``kind``, ``key`` and ``n``: training counts of words and grams. Grams that only held-out texts
    have are listed with 0, for the tree rates them too."""

    def listed(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(np.full(len(keys), kind, np.int32)), signed(keys), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, names=["kind", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            texts = _lowered(batch.column("body").to_pylist())
            for own in (False, True):
                part = [t for t, h in zip(texts, held) if bool(h) == own]
                grams, words = KeyCounts(), KeyCounts(_WORD_BITS)
                for chunk in _chunks(part):
                    grams.add(gram_keys(chunk, depth)[0])
                    if not own:
                        words.add(word_keys(chunk)[0])
                keys, counts = grams.summed()
                yield listed(_GRAM, keys, np.zeros_like(counts) if own else counts)
                if part and not own:
                    words.add_once(END_KEY, len(part))
                    yield listed(_WORD, *words.summed())

    rows = docs.select(text.cast("string").alias("body"), held_out.alias("held_out"))
    counted = rows.mapInArrow(run, "kind int, key bigint, n bigint")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def rated_grams(grams: DataFrame, depth: int) -> DataFrame:
    """``key``, ``n`` and ``value``, the log10 probability of each gram's last byte after its context.

    ``grams`` has ``key`` and ``n``. Grams of equal last two context bytes share a group.
    """
    if not 2 <= depth <= 7:
        raise ValueError("keys hold contexts of two to seven bytes")
    groups = max(1, -(-grams.count() // GROUP_GRAMS))
    last_two = F.shiftrightunsigned("key", 8 * (depth - 1))
    grouped = grams.withColumn("group", F.pmod(F.xxhash64(last_two), F.lit(groups)))

    def sums(table: pa.Table) -> pa.Table:
        keys = unsigned(table.column("key"))
        counts = table.column("n").to_numpy()
        out = []
        for bit in range(8):
            levels = Levels(keys, counts, bit, depth, 2)
            out.append(
                pa.table(
                    {
                        "last": pa.array(_byte(levels.nodes, depth)),
                        "node": pa.array(_byte(levels.nodes, 0)),
                        "zeros": pa.array(levels.zeros[-1]),
                        "ones": pa.array(levels.ones[-1]),
                        "below": pa.array(levels.log_weighted[-1]),
                    }
                )
            )
        return pa.concat_tables(out)

    by_group = grouped.groupBy("group")
    summed = by_group.applyInArrow(sums, "last int, node int, zeros bigint, ones bigint, below double")
    # At most 256 * 255 rows, whatever the corpus.
    rows = (
        summed.groupBy("last", "node")
        .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below"))
        .collect()
    )
    top = Top(rows)

    def rate(table: pa.Table) -> pa.Table:
        keys = unsigned(table.column("key"))
        counts = table.column("n").to_numpy()
        last, low = _byte(keys, depth), _byte(keys, 0)
        value = np.zeros(len(keys))
        for bit in range(8):
            levels = Levels(keys, counts, bit, depth, 2)
            node = (low >> (8 - bit)) | (1 << bit)
            value += np.log10(top.mix(last, node, levels.bit, *levels.estimates()))
        return pa.table({"key": signed(keys), "n": pa.array(counts), "value": pa.array(value)})

    return by_group.applyInArrow(rate, "key bigint, n bigint, value double")


def score(
    docs: DataFrame,
    held_out: Column,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    depth: int = DEPTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``row``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``held_out`` marks the rows that are scored without being learnt from; null means false. Texts are
    lower-cased in A to Z and a null text is empty: one end, which is scored like any token or byte.
    ``score`` is the log10 probability of the text's bytes and their end; divided by the bytes and by
    -log10(2) it is a code length in bits per byte. Without any training text the base score is 0 a
    token and a bit costs a bit. Words are told apart by a 64-bit hash. Columns of ``docs`` stay inside
    ``row``, so none can clash; equal rows get equal scores.
    """
    spark = docs.sparkSession
    folder = new_folder(spark)
    marked = docs.select(F.struct("*").alias("doc"), F.coalesce(held_out, F.lit(False)).alias("held"))
    body, ident = marked["doc"][text], marked["doc"][doc_id]
    train_counts(marked, body, marked["held"], depth).write.partitionBy("kind").parquet(f"{folder}/counts")
    counts = spark.read.schema("key bigint, n bigint, kind int").parquet(f"{folder}/counts")
    words = counts.filter(F.col("kind") == _WORD).select("key", "n")
    train, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    floor = np.log10(train + ADDED * (distinct + 1))

    grams = counts.filter(F.col("kind") == _GRAM).select("key", "n")
    rated_grams(grams, depth).write.parquet(f"{folder}/rated")
    rated = spark.read.parquet(f"{folder}/rated")
    commonest = rated.orderBy(F.desc("n"), "key").limit(HEAD_GRAMS).select("key", "value").toArrow()
    head_keys = unsigned(commonest.column("key"))
    order = np.argsort(head_keys)
    head = spark.sparkContext.broadcast(
        (head_keys[order], commonest.column("value").to_numpy()[order])
    )
    values = (
        rated.select(F.lit(_GRAM).alias("kind"), "key", "value")
        .union(words.select(F.lit(_WORD).alias("kind"), "key", F.col("n").cast("double")))
    )

    source = blocked(marked, ident, body, block_bytes)
    by_block = source.groupBy("block")

    def asked_of(table: pa.Table) -> pa.Table:
        texts = _lowered(texts_of(table, "doc", text))
        held = np.array(pc.struct_field(table.column("row"), "held").to_pylist(), bool)
        grams, words, learnt = KeyCounts(), KeyCounts(_WORD_BITS), KeyCounts(_WORD_BITS)
        words.add_once(END_KEY, 1)
        learnt.add_once(END_KEY, int((~held).sum()))
        for flag in (False, True):
            for chunk in _chunks([t for t, h in zip(texts, held) if h == flag]):
                grams.add(gram_keys(chunk, depth)[0])
                (words if flag else learnt).add(word_keys(chunk)[0])
        keys = np.setdiff1d(grams.summed()[0], head.value[0], assume_unique=True)
        # Of words also the training count in this block: where that is all of it, none is sent back.
        known, counts = learnt.summed()
        strange = np.setdiff1d(words.summed()[0], known)
        named = np.concatenate([known, strange])
        own = np.concatenate([np.full(len(keys), -1), counts, np.zeros(len(strange), np.int64)])
        return pa.table(
            {
                "block": block_of(table, len(own)),
                "kind": pa.array(np.repeat([_GRAM, _WORD], [len(keys), len(named)]).astype(np.int32)),
                "key": signed(np.concatenate([keys, named])),
                "own": pa.array(own),
            }
        )

    asked = by_block.applyInArrow(asked_of, "block bigint, kind int, key bigint, own bigint")
    told = (
        asked.join(values, ["kind", "key"])
        .filter((F.col("kind") == _GRAM) | (F.col("own") != F.col("value")))
        .select("block", "kind", "key", "value")
    )

    def rate(table: pa.Table, told: pa.Table) -> pa.Table:
        kinds = told.column("kind").to_numpy()
        keys, found = unsigned(told.column("key")), told.column("value").to_numpy()

        asked_grams = keys[kinds == _GRAM]
        gram_score = np.append(found[kinds == _GRAM], head.value[1])
        kinds = np.append(kinds, np.full(len(head.value[0]), _GRAM))
        keys, found = np.append(keys, head.value[0]), np.append(found, head.value[1])
        by_kind = {}
        for kind in (_WORD, _GRAM):
            order = np.flatnonzero(kinds == kind)
            order = order[np.argsort(keys[order])]
            by_kind[kind] = keys[order], found[order]

        def look_up(kind: int, wanted: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
            listed, values = by_kind[kind]
            if not len(listed):
                return otherwise
            at = np.minimum(np.searchsorted(listed, wanted), len(listed) - 1)
            return np.where(listed[at] == wanted, values[at], otherwise)

        texts = _lowered(texts_of(table, "doc", text))
        held = np.array(pc.struct_field(table.column("row"), "held").to_pylist(), bool)

        # The commonest come last, so that no other gram takes their slots.
        grams = KeyIndex()
        grams.add(asked_grams)
        grams.add(head.value[0])
        learnt, spoken, scores = KeyCounts(_WORD_BITS), [], []
        for chunk in _chunks(texts):
            spoken.append(word_keys(chunk))

            wanted, sizes = gram_keys(chunk, depth)
            at, known = grams.find(wanted)
            value = gram_score[at] if len(gram_score) else np.zeros(len(wanted))
            missed = np.flatnonzero(~known)
            value[missed] = look_up(_GRAM, wanted[missed], np.zeros(len(missed)))
            scores.append(np.add.reduceat(value, np.cumsum(sizes) - sizes))

        # A word's count is that of this block unless another was sent.
        past = 0
        owners = []
        for (words, owner), chunk in zip(spoken, _chunks(texts)):
            owners.append(owner + past)
            learnt.add(words[~held[owners[-1]]])
            past += len(chunk)
        learnt.add_once(END_KEY, int((~held).sum()))
        word = np.concatenate([words for words, _ in spoken])
        owner = np.concatenate(owners)
        listed, counts = learnt.summed()
        counts = look_up(_WORD, listed, counts.astype(np.float64))
        # Words that no text of this block is learnt from: what was sent, or never seen.
        sent, values = by_kind[_WORD]
        strange = ~np.isin(sent, listed)
        listed, counts = np.append(listed, sent[strange]), np.append(counts, values[strange])
        order = np.argsort(listed)
        listed, counts = listed[order], counts[order]
        index = KeyIndex(_WORD_BITS)
        index.add(listed)

        def count_of(keys: np.ndarray) -> np.ndarray:
            at, known = index.find(keys)
            count = np.where(known, counts[at], 0.0)
            missed = np.flatnonzero(~known)
            at = np.minimum(np.searchsorted(listed, keys[missed]), len(listed) - 1)
            count[missed] = np.where(listed[at] == keys[missed], counts[at], 0.0)
            return count

        end = count_of(np.full(1, END_KEY, np.uint64))[0]
        count = count_of(word)
        n_words = np.bincount(owner, minlength=len(texts))
        base = np.bincount(owner, np.log10(count + ADDED) - floor, len(texts))
        return pa.table(
            {
                "row": table.column("row"),
                "n_tokens": pa.array(n_words + 1),
                "n_known": pa.array(np.bincount(owner[count > 0], minlength=len(texts)) + int(end > 0)),
                "base": pa.array(base + (np.log10(end + ADDED) - floor)),
                "score": pa.array(np.concatenate(scores)),
            }
        )

    scored = by_block.cogroup(told.groupBy("block")).applyInArrow(
        rate, with_row(source, "n_tokens bigint, n_known bigint, base double, score double")
    )
    return scored.select(
        F.col("row.doc").alias("row"),
        F.col("row.held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(train)).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
    )
